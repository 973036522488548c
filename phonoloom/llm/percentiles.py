"""Problem 2: percentiles with a stated error, from counts that can be added up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from phonoloom.operators.running import running_sum

#: Grid of each number: a percentile is off by at most half of it.
GRID = {"duration_seconds": 0.01, "snr_estimate_db": 0.01}
PERCENTS = (1, 5, 25, 50, 75, 95, 99)


def model_name(column: str = "separation_model") -> Column:
    """Spellings of a model as one: trimmed, lower case; null and blank are ``unknown``."""
    return F.coalesce(F.nullif(F.lower(F.trim(F.col(column))), F.lit("")), F.lit("unknown"))


def records_once(df: DataFrame, item_id: str = "item_id") -> DataFrame:
    """One row of each item_id (the first in the order of all columns used); rows without an id all stay."""
    own = [c for c in df.columns if c != item_id]
    one = df.where(F.col(item_id).isNotNull()).groupBy(item_id).agg(F.min(F.struct(*own)).alias("_row")).select(item_id, "_row.*")
    return one.unionByName(df.where(F.col(item_id).isNull()).select(item_id, *own))


def value_counts(df: DataFrame, groups: list[str], grids: dict[str, float]) -> DataFrame:
    """The mergeable summary: (groups, metric, bin, n), values on the grid of their metric.

    Summaries of days or partitions are combined by adding up n, and percentiles of the sum are those of the
    whole. A summary has at most range / grid bins a group, whatever the number of rows. Nulls, NaN and
    infinities are no values: their bin is null, so that their number stays known.
    """
    grid = F.create_map(*[F.lit(x) for metric, g in grids.items() for x in (metric, 1.0 / g)])
    long = df.select(*groups, F.explode(F.create_map(*[x for m in grids for x in (F.lit(m), F.col(m).cast("double"))])).alias("metric", "_x"))
    ok = F.col("_x").isNotNull() & ~F.isnan("_x") & (F.abs("_x") < 1e15)
    bins = F.when(ok, F.floor(F.col("_x") * grid[F.col("metric")] + 0.5))
    return long.groupBy(*groups, "metric", bins.cast("bigint").alias("bin")).agg(F.count("*").alias("n"))


def combined(summary: DataFrame, groups: list[str]) -> DataFrame:
    """A summary brought to fewer groups."""
    return summary.groupBy(*groups, "metric", "bin").agg(F.sum("n").alias("n"))


def percentiles(summary: DataFrame, groups: list[str], grids: dict[str, float], percents: tuple[int, ...] = PERCENTS) -> DataFrame:
    """(groups, metric, n, n_missing, pNN...) of a summary: pNN is the smallest value that at least NN % reach.

    Method: cumulative frequencies. Counts are range-sorted, every partition's running sum is shifted by what
    comes before it, and the first bin whose sum reaches a percentile's rank is taken. The error is at most
    half the grid of the metric. A group without values has null percentiles and n = 0.
    """
    keys = [*groups, "metric"]
    sums = summary.groupBy(*keys).agg(F.sum(F.when(F.col("bin").isNotNull(), F.col("n")).otherwise(0)).alias("_all"), F.sum(F.when(F.col("bin").isNull(), F.col("n")).otherwise(0)).alias("n_missing"))
    ran = running_sum(summary.where("bin is not null"), keys, ["bin"], "n", "_upto")
    grid = F.create_map(*[F.lit(x) for metric, g in grids.items() for x in (metric, 1.0 / g)])
    same = None
    for k in keys:
        c = F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}"))
        same = c if same is None else same & c
    ranked = ran.alias("r").join(sums.alias("s"), same, "right").select(*[F.col(f"s.{k}") for k in keys], "s._all", "s.n_missing", "r.bin", "r._upto")
    first = [F.min(F.when(F.col("_upto") >= F.ceil(F.col("_all") * p / 100), F.col("bin"))).alias(f"_p{p}") for p in percents]
    found = ranked.groupBy(*keys, "_all", "n_missing").agg(*first)
    return found.select(*keys, F.col("_all").alias("n"), "n_missing", *[F.round(F.col(f"_p{p}") / grid[F.col("metric")], 6).alias(f"p{p:02d}") for p in percents])
