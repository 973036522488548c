"""Running sums over a global order, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from phonoloom.plans.cluster import stored


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the rows of the same ``keys`` up to and with this row.

    Rows are range-sorted by keys and order; a partition's own running sum is shifted by what earlier
    partitions hold of the same keys (one row per key and partition). A key with any share of the rows is thus
    spread over as many tasks as the range partitioning gives it. ``order`` must be unique within the keys
    for a defined result. Null values count as zero.
    """
    parts = stored(
        df.repartitionByRange(*[F.col(c) for c in keys + order]).withColumn("_part", F.spark_partition_id()),
        "running",
    )
    value_or_zero = F.coalesce(F.col(value), F.lit(0))
    totals = parts.groupBy(*keys, "_part").agg(F.sum(value_or_zero).alias("_total"))
    before = totals.withColumn(
        "_before", F.coalesce(F.sum("_total").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("_total")
    inside = F.sum(value_or_zero).over(Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*keys, "_part"]]
    on = same[0]
    for c in same[1:]:
        on = on & c
    joined = parts.withColumn(out, inside).alias("a").join(before.alias("b"), on)
    return joined.select(*[F.col(f"a.{c}") for c in df.columns], (F.col(f"a.{out}") + F.col("b._before")).alias(out))
