"""Duplicates and what has been seen before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from phonoloom.functions.ids import base_id, raw_id


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order, which should be unique for a defined result.

    A minimum over structs is combined before the shuffle, so a key with a third of all rows does no harm; rows whose
    keys are null are rows of one key. Columns keep their order.
    """
    rest = [c for c in df.columns if c not in keys + order]
    one = df.groupBy(*keys).agg(F.min(F.struct(*[c for c in order if c not in keys])).alias("_o"), F.min_by(F.struct(*(rest or order)), F.struct(*order)).alias("_r"))
    picked = one.select(*keys, *[F.col(f"_o.{c}") for c in order if c not in keys], *[F.col(f"_r.{c}") for c in rest])
    return picked.select(*df.columns)


def with_original(df: DataFrame, content: str, key: str) -> DataFrame:
    """``df`` with original: the smallest key of the rows with the same content, and is_duplicate. Rows with null
    content are their own originals."""
    first = df.where(F.col(content).isNotNull()).groupBy(content).agg(F.min(key).alias("original"))
    out = df.join(first, content, "left")
    original = F.coalesce("original", key)
    return out.withColumns({"original": original, "is_duplicate": original != F.col(key)}).select(*df.columns, "original", "is_duplicate")


def seen_keys(item_id: Column) -> Column:
    """The forms under which an accepted id is remembered: itself, its base, and platform and number."""
    raw = raw_id(item_id)
    prefix = F.coalesce(F.nullif(F.regexp_extract(item_id, "^(tt_|fb_)", 1), F.lit("")), F.lit(""))
    return F.array_distinct(F.array_compact(F.array(item_id, base_id(item_id), F.when(raw.rlike("^[0-9]+$"), F.concat(prefix, raw)))))


def asked_keys(item_id: Column) -> Column:
    """The forms under which an id may have been seen: as above, and for bare digits either platform."""
    raw = raw_id(item_id)
    prefix = F.nullif(F.regexp_extract(item_id, "^(tt_|fb_)", 1), F.lit(""))
    bare = item_id.rlike("^[0-9]+$")
    forms = [item_id, base_id(item_id), F.when(prefix.isNotNull() & raw.rlike("^[0-9]+$"), F.concat(prefix, raw)), F.when(bare, F.concat(F.lit("tt_"), item_id)), F.when(bare, F.concat(F.lit("fb_"), item_id))]
    return F.array_distinct(F.array_compact(F.array(*forms)))


def remember(seen: DataFrame, accepted: DataFrame, item_id: str = "item_id") -> DataFrame:
    """(key): the seen set with the forms of newly accepted ids; null ids add nothing."""
    new = accepted.where(F.col(item_id).isNotNull()).select(F.explode(seen_keys(F.col(item_id))).alias("key"))
    return seen.select("key").unionByName(new).distinct()


def unseen(df: DataFrame, seen: DataFrame, item_id: str = "item_id") -> DataFrame:
    """Rows of ``df`` none of whose forms is in the seen set (key). Rows with a null id are kept.

    The forms are exploded and joined by equality, which any distribution of keys can be shuffled for.
    """
    ids = df.select(item_id).where(F.col(item_id).isNotNull()).distinct()
    hit = ids.withColumn("key", F.explode(asked_keys(F.col(item_id)))).join(seen.select("key"), "key", "left_semi").select(item_id).distinct()
    return df.join(hit, item_id, "left_anti")


def retry_candidates(errors: DataFrame, done: DataFrame, seen: DataFrame, platform: str | None = None) -> DataFrame:
    """Failed rows to try again: of the platform, without addresses that are done, without ids that are seen."""
    rows = errors if platform is None else errors.where(F.col("platform") == platform)
    return unseen(rows.join(done.select("url"), "url", "left_anti"), seen)


def latest_status(log: DataFrame, key: str = "url", at: str = "ts") -> DataFrame:
    """The last status of each key; a later done clears a failure, a failure doesn't clear done."""
    w = F.max(F.struct((F.col("status") == "done").cast("int").alias("d"), F.col(at), F.col("status"), F.col("error"))).alias("_l")
    return log.groupBy(key).agg(w).select(key, "_l.status", F.col(f"_l.{at}"), "_l.error")


def largest(df: DataFrame, keys: list[str], order: list[Column], k: int, blocks: int = 64) -> DataFrame:
    """The first ``k`` rows of each key in the given order. The rows of a key are ranked in ``blocks`` parts first and
    only the first ``k`` of each part go on, so that a key with a third of all rows is ranked by many tasks."""
    part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(blocks))
    first = df.withColumn("_part", part).withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))).where(F.col("_n") <= k)
    return first.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= k).select(*df.columns)


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str = "n") -> DataFrame:
    """``df`` with the row's number within its keys."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
