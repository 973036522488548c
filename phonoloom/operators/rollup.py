"""Day and week summaries, funnels and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from phonoloom.functions.dates import week_number


def day_summary(records: DataFrame, day: Column, errors: DataFrame | None = None, error_day: Column | None = None) -> DataFrame:
    """(day, items, unique_items, total_hours, errors) per day; days with errors only have no items."""
    d = F.coalesce(F.nanvl(F.col("duration_seconds"), F.lit(None)), F.lit(0.0))
    out = records.groupBy(day.alias("day")).agg(F.count("*").alias("items"), F.countDistinct("item_id").alias("unique_items"), F.round(F.sum(d) / 3600, 2).alias("total_hours"))
    if errors is None:
        return out.withColumn("errors", F.lit(0).cast("bigint"))
    failed = errors.groupBy(error_day.alias("day")).agg(F.count("*").alias("errors"))
    zero = {"items": F.coalesce("items", F.lit(0)), "unique_items": F.coalesce("unique_items", F.lit(0)), "total_hours": F.coalesce("total_hours", F.lit(0.0)), "errors": F.coalesce("errors", F.lit(0))}
    return out.join(failed, "day", "full_outer").withColumns(zero)


def yield_funnel(summary: DataFrame) -> DataFrame:
    """``summary`` with attempted and the share of it that came through, as text with one decimal; 0 of 0 is 0.0 %."""
    attempted = F.col("items") + F.col("errors")
    rate = F.when(attempted > 0, F.round(F.col("items") / attempted * 100, 1)).otherwise(F.lit(0.0))
    return summary.withColumns({"attempted": attempted, "yield_rate": F.concat(F.format_string("%.1f", rate), F.lit("%"))})


def stage_funnel(rows: DataFrame, stages: list[tuple[str, Column]], by: list[str] | None = None) -> DataFrame:
    """Rows in all, and left after each stage; a row counts for a stage if it passed all tests so far. A test on null
    isn't passed."""
    ok, counts = F.lit(True), [F.count("*").alias("total")]
    for name, test in stages:
        ok = ok & F.coalesce(test, F.lit(False))
        counts.append(F.count_if(ok).alias(name))
    return rows.groupBy(*(by or [])).agg(*counts)


def week_rollup(days: DataFrame) -> DataFrame:
    """(week, days, files, hours) per week and, with a null week, in all; hours are sums of the days' rounded hours."""
    weeks = days.where(F.col("day").isNotNull()).withColumn("week", week_number(F.col("day").cast("date")))
    return weeks.rollup("week").agg(F.count("*").alias("days"), F.sum("items").alias("files"), F.round(F.sum("total_hours"), 2).alias("hours"))


def distribution(records: DataFrame, by: str, column: str, values: list[str]) -> DataFrame:
    """Rows of each value of ``column`` as columns, the rest as ``other``, per value of ``by``."""
    counts = [F.count_if(F.col(column) == v).alias(v) for v in values]
    return records.groupBy(by).agg(F.count("*").alias("items"), *counts, F.count_if(F.col(column).isNull() | ~F.col(column).isin(*values)).alias("other"))


def audit(records: DataFrame, duration: str = "duration_seconds") -> DataFrame:
    """One row: files, those without a usable duration, total, shortest, longest and mean duration, and the share that
    lies in 4.5 to 35 seconds."""
    d = F.when(F.col(duration).isNotNull() & ~F.isnan(F.col(duration)), F.col(duration))
    fit = d.between(4.5, 35.0)
    whole = F.count("*")
    return records.agg(
        whole.alias("files"),
        F.count_if(d.isNull()).alias("corrupt"),
        F.round(F.coalesce(F.sum(d), F.lit(0.0)) / 3600, 3).alias("hours"),
        F.min(d).alias("shortest"),
        F.max(d).alias("longest"),
        F.round(F.avg(d), 3).alias("mean"),
        F.count_if(F.coalesce(fit, F.lit(False))).alias("fit"),
        F.when(whole > 0, F.round(F.count_if(F.coalesce(fit, F.lit(False))) / whole * 100, 2)).otherwise(F.lit(0.0)).alias("fit_percent"),
    )


def duplicate_rate(rows: DataFrame, duplicate: Column) -> DataFrame:
    """One row: rows, duplicates and their share in percent, 0 for an empty table."""
    return rows.agg(F.count("*").alias("rows"), F.count_if(duplicate).alias("duplicates"), F.round(F.count_if(duplicate) / F.greatest(F.lit(1), F.count("*")) * 100, 2).alias("duplicate_percent"))
