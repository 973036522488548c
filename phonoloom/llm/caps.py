"""Problem 7: at most so many records of one contributor, the best remaining."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from phonoloom.plans.cluster import stored

#: Hex digits of a key that one pass counts: two bytes, so a contributor has at most 65,536 counts in a pass.
DIGIT = 4
_LOWEST = -(2**63)


def handle(column: str = "uploader") -> Column:
    """A handle without case, outer spaces and a leading @; null where nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(F.trim(F.col(column))), r"^@+", "")), F.lit(""))


def score_bytes(column: str) -> Column:
    """A double as 16 hex digits whose order is descending by value; null and NaN come last. -0.0 equals 0.0.

    The bits of a positive double, read as a number, keep its order; they are put together here from exponent
    and fraction by exact arithmetic, mirrored for negatives, and turned over for the descending order.
    """
    x = F.col(column).cast("double")
    size = F.abs(x)
    guess = F.floor(F.log2(size))
    guess = F.when(F.pow(F.lit(2.0), guess) > size, guess - 1).when(F.pow(F.lit(2.0), guess + 1) <= size, guess + 1).otherwise(guess)
    power = F.greatest(guess, F.lit(-1022).cast("bigint"))
    bits = (power + 1022) * F.lit(2**52) + (size / F.pow(F.lit(2.0), power) * F.lit(float(2**52))).cast("bigint")
    bits = F.when(size == 0, F.lit(0).cast("bigint")).when(size == float("inf"), F.lit(0x7FF << 52).cast("bigint")).otherwise(bits)
    falling = F.when(x < 0, bits).otherwise(-bits)
    coded = F.lpad(F.hex(falling.bitwiseXOR(F.lit(_LOWEST))), 16, "0")
    return F.when(x.isNull() | F.isnan(x), F.lit("F" * 16)).otherwise(coded)


def _common(a: str, b: str) -> Column:
    """The common beginning of two hex strings."""
    differs = F.array_position(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x != y, F.lit(True))), True)
    return F.when(differs > 0, F.substring(F.col(a), 1, differs.cast("int") - 1)).otherwise(F.col(a))


def cutoffs(keyed: DataFrame, keep: int) -> DataFrame:
    """(contributor, cutoff): the keep-th smallest key of every contributor that has more than ``keep``.

    Method: radix selection. A pass counts, per contributor, the rows at each value of the next two bytes
    (combined before the shuffle), finds the byte pair at which the sum reaches what is still to be kept,
    and fixes it; bytes that all rows left have in common are skipped. Only rows at an open cutoff are counted
    again. No contributor's rows are ever brought together.
    """
    totals = keyed.groupBy("contributor").agg(F.count("*").alias("_n"), F.min("key").alias("_low"), F.max("key").alias("_high")).where(F.col("_n") > keep)
    open_ = stored(totals.select("contributor", _common("_low", "_high").alias("_prefix"), F.lit(keep).cast("bigint").alias("_left")), "p7-open")
    rows = stored(keyed.join(open_.select("contributor"), "contributor"), "p7-rows")
    done = None
    running = Window.partitionBy("contributor").orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
    while not open_.isEmpty():
        at = rows.join(open_, "contributor").where(F.col("key").startswith(F.col("_prefix")))
        digits = at.groupBy("contributor", "_left", F.expr(f"substring(key, length(_prefix) + 1, {DIGIT})").alias("_digit")).agg(F.count("*").alias("_n"), F.min("key").alias("_low"), F.max("key").alias("_high"))
        cut = digits.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0))).where("_before < _left and _before + _n >= _left").withColumn("_left", F.col("_left") - F.col("_before"))
        cut = stored(cut, "p7-cut")
        now = cut.where("_n = _left").select("contributor", F.col("_high").alias("cutoff"))
        done = now if done is None else done.unionByName(now)
        open_ = stored(cut.where("_n > _left").select("contributor", _common("_low", "_high").alias("_prefix"), "_left"), "p7-open")
    return done if done is not None else totals.select("contributor", F.col("_low").alias("cutoff"))


def beyond_cap(df: DataFrame, keep: int, contributor: Column, item_id: str = "item_id", score: str = "snr_estimate_db") -> DataFrame:
    """(item_id) of the records that go when every contributor keeps its ``keep`` best.

    Highest score first, null and NaN last, ties by smaller id (bytes). Repeated rows of an id count once, with
    their best score. Records without a contributor, and rows without an id, are all kept. ``keep`` of 0 drops
    every record that has a contributor.
    """
    key = F.concat(score_bytes(score), F.hex(F.col(item_id)))
    rows = df.where(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item_id"), F.struct(key.alias("key"), contributor.alias("contributor")).alias("_r"))
    keyed = rows.where("_r.contributor is not null").groupBy("item_id").agg(F.min("_r").alias("_r")).select("item_id", "_r.contributor", "_r.key")
    if keep <= 0:
        return keyed.select("item_id")
    keyed = stored(keyed, "p7-keyed")
    return keyed.join(cutoffs(keyed.select("contributor", "key"), keep), "contributor").where("key > cutoff").select("item_id")


def within_share(df: DataFrame, share: float, contributor: Column, item_id: str = "item_id", score: str = "snr_estimate_db") -> DataFrame:
    """As :func:`beyond_cap`, where no contributor may have more than ``share`` of all records before the cut."""
    n = df.where(F.col(item_id).isNotNull()).select(item_id).distinct().count()
    return beyond_cap(df, max(1, int(n * share)), contributor, item_id, score)
