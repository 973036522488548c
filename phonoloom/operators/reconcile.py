"""Joins of listings, records and sources that should agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from phonoloom.functions.ids import base_id, platform
from phonoloom.functions.numbers import rounded
from phonoloom.operators.dedup import keep_first

HEADER, BYTES_A_SECOND = 44, 32000


def seconds_of_size(size: Column, least: float = 3.0, digits: int = 2) -> Column:
    """Duration of a PCM file by its size."""
    return F.greatest(F.lit(least), rounded((size - HEADER) / BYTES_A_SECOND, digits))


def match_status(left: DataFrame, right: DataFrame, key: str, names: tuple[str, str] = ("left_only", "right_only")) -> DataFrame:
    """(key, status) of every key on either side: matched, or on which side only. Null keys match nothing."""
    a = left.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_a", F.lit(True))
    b = right.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_b", F.lit(True))
    status = F.when(F.col("_a").isNull(), F.lit(names[1])).when(F.col("_b").isNull(), F.lit(names[0])).otherwise(F.lit("matched"))
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def fill_missing(listing: DataFrame, records: DataFrame, as_of: str) -> DataFrame:
    """Records for listed files that have none, with defaults: platform and number from the id, region mixed, duration
    by size without the header, all times ``as_of``."""
    lost = listing.join(records.select("item_id"), "item_id", "left_anti")
    return lost.select(
        "item_id",
        platform(F.col("item_id")).alias("platform"),
        F.regexp_extract("item_id", "_(.*)", 1).alias("platform_video_id"),
        F.round(F.col("length") / BYTES_A_SECOND, 3).alias("duration_seconds"),
        F.lit("mixed").alias("language_region"),
        F.lit(as_of).cast("timestamp").alias("crawled_at"),
    )


def audit_listing(listing: DataFrame, records: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """(item_id, path, length, duration_seconds, imputed, known): listed files with their records by path.

    Files below ``least_bytes`` go before duplicates do; of several files of an id the first by path stays; of several
    records of a path the last id. A duration that is missing, not above 0 or above 60 comes from the size.
    """
    by_path = records.where(F.col("audio_path").isNotNull()).groupBy(F.col("audio_path").alias("path")).agg(F.max(F.struct("item_id", "duration_seconds")).alias("_r"))
    files = listing.where(F.col("length") >= least_bytes).join(by_path, "path", "left")
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^.]*)?$", 1)
    d = F.col("_r.duration_seconds")
    bad = d.isNull() | F.isnan(d) | (d <= 0) | (d > 60)
    rows = files.select(F.coalesce("_r.item_id", stem).alias("item_id"), "path", "length", rounded(F.when(bad, seconds_of_size(F.col("length"))).otherwise(d), 2).alias("duration_seconds"), bad.alias("imputed"), F.col("_r").isNotNull().alias("known"))
    return keep_first(rows, ["item_id"], ["path"])


def join_by_id_or_base(left: DataFrame, right: DataFrame, value: str, key: str = "item_id") -> DataFrame:
    """``left`` with ``value`` of the right row with its id, else of the one with its base id; the smallest value where
    a key comes more than once."""
    one = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))
    exact = one.select(F.col(key).alias("_k"), F.col(value).alias("_exact"))
    fallback = one.select(F.col(key).alias("_b"), F.col(value).alias("_base"))
    out = left.join(exact, left[key] == exact["_k"], "left").withColumn("_bk", base_id(F.col(key)))
    out = out.join(fallback, out["_bk"] == fallback["_b"], "left")
    return out.select(*left.columns, F.coalesce("_exact", "_base").alias(value), F.when(F.col("_exact").isNotNull(), "id").when(F.col("_base").isNotNull(), "base").otherwise("none").alias("found_by"))


def first_source(sources: list[DataFrame], key: str, values: list[str]) -> DataFrame:
    """Per key the values of the first source that has it; sources come in order of preference."""
    parts = [s.select(key, *values, F.lit(k).alias("_p")) for k, s in enumerate(sources)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    best = whole.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct("_p", *values)).alias("_v"))
    return best.select(key, F.col("_v._p").alias("source_no"), *[F.col(f"_v.{v}") for v in values])


def overlapping(left: DataFrame, right: DataFrame, key: str, bucket: float = 30.0) -> DataFrame:
    """(key, l_start, l_end, r_start, r_end): intervals (start, end) of the same key that overlap.

    Both sides are cut into buckets of time and joined by key and bucket; a pair is taken in the first bucket that both
    reach, so it comes once and no key's intervals are crossed in full.
    """

    def cut(df: DataFrame, p: str) -> DataFrame:
        rows = df.where("end > start").select(key, F.col("start").alias(f"{p}_start"), F.col("end").alias(f"{p}_end"))
        return rows.withColumn("_b", F.explode(F.sequence(F.floor(F.col(f"{p}_start") / bucket), F.floor(F.col(f"{p}_end") / bucket))))

    both = cut(left, "l").join(cut(right, "r"), [key, "_b"]).where("l_start < r_end and r_start < l_end")
    return both.where(F.col("_b") == F.floor(F.greatest("l_start", "r_start") / bucket)).select(key, "l_start", "l_end", "r_start", "r_end")


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, value: str, bucket: str = "HOUR") -> DataFrame:
    """``left`` with the value of the right row of its key with the latest time not after its own; times of the right
    side that equal a left time count.

    Both sides are cut into buckets of time and go through one window by key and bucket; what a key's earlier buckets
    end with is a small table of its own, one row a bucket. So a key with a third of all rows is spread over its hours.
    """
    cell = F.date_trunc(bucket, F.col(at))
    a = left.select(*left.columns, cell.alias("_b"), F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.lit(1).alias("_s"))
    b = right.where(F.col(value).isNotNull()).select(*[F.col(c) if c in (key, at) else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns], cell.alias("_b"), F.col(value).alias("_v"), F.lit(0).alias("_s"))
    w = Window.partitionBy(key, "_b").orderBy(at, "_s").rowsBetween(Window.unboundedPreceding, 0)
    inside = a.unionByName(b).withColumn("_in", F.last("_v", ignorenulls=True).over(w)).where("_s = 1")
    ends = b.groupBy(key, "_b").agg(F.max_by("_v", at).alias("_e"))
    # every bucket of either side, with what the key's buckets before it end with
    cells = ends.unionByName(a.select(key, "_b", F.lit(None).cast(right.schema[value].dataType).alias("_e")).distinct()).groupBy(key, "_b").agg(F.max("_e").alias("_e"))
    before = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = cells.withColumn("_c", F.last("_e", ignorenulls=True).over(before)).select(F.col(key).alias("_k"), F.col("_b").alias("_kb"), "_c")
    out = inside.join(carried, F.col(key).eqNullSafe(F.col("_k")) & F.col("_b").eqNullSafe(F.col("_kb")), "left")
    return out.select(*left.columns, F.coalesce("_in", "_c").alias(value))
