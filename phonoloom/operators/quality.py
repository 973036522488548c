"""Quality control: keep-first cleaning with reasons, its summary and report; run states; funnels of the real stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from phonoloom.functions.numbers import rounded


def cleaned(files: DataFrame, key: str, content: str, low_voice: Column, duration: str = "duration_seconds") -> DataFrame:
    """``files`` with reason: low_voice, duplicate, or null for those kept, and original: what a duplicate repeats.

    Too little voice is looked at first, so that such a file is nobody's original; of the others the smallest key of a
    content stays. Files without content can't be read: their reason is unreadable, and they are in no other bucket.
    """
    rows = files.withColumn("_low", F.coalesce(low_voice, F.lit(False)))
    first = rows.where(F.col(content).isNotNull() & ~F.col("_low")).groupBy(F.col(content).alias("_c")).agg(F.min(key).alias("_first"))
    out = rows.join(first, rows[content] == first["_c"], "left")
    duplicate = F.col("_first") != F.col(key)
    reason = F.when(F.col(content).isNull(), F.lit("unreadable")).when(F.col("_low"), F.lit("low_voice")).when(duplicate, F.lit("duplicate"))
    columns = [c for c in files.columns if c not in ("reason", "original")]
    return out.select(*columns, reason.alias("reason"), F.when(reason == "duplicate", F.col("_first")).alias("original"))


def quality_summary(rows: DataFrame, duration: str = "duration_seconds", name: str = "dataset") -> DataFrame:
    """One row over cleaned files: all, delivered, hours, removed by reason, and the rate that passed as text; an empty
    table has 0.0 %."""
    kept, whole = F.count_if(F.col("reason").isNull()), F.count("*")
    d = F.when(F.col("reason").isNull(), F.coalesce(F.nanvl(F.col(duration), F.lit(None)), F.lit(0.0)))
    rate = F.when(whole > 0, rounded(kept / whole * 100, 1)).otherwise(F.lit(0.0))
    return rows.agg(
        F.lit(name).alias("dataset_name"),
        whole.alias("total_initial_files"),
        kept.alias("clean_files_delivered"),
        F.round(F.coalesce(F.sum(d), F.lit(0.0)) / 3600, 2).alias("total_hours"),
        F.count_if(F.col("reason") == "duplicate").alias("quarantined_duplicates"),
        F.count_if(F.col("reason") == "low_voice").alias("quarantined_low_voice"),
        F.concat(F.format_string("%.1f", rate), F.lit("%")).alias("qc_passed_rate"),
    )


def removed_rows(rows: DataFrame, key: str) -> DataFrame:
    """(key, reason, original) of the files that were removed: the report's lists as a table."""
    return rows.where("reason is not null").select(key, "reason", "original")


def run_stats(statuses: DataFrame, status: str = "status") -> DataFrame:
    """One row: addresses that ended as done, skipped, rejected and error; other states count in total only."""
    s = F.col(status)
    return statuses.agg(F.count("*").alias("total"), *[F.count_if(s == v).alias(v) for v in ("done", "skipped", "rejected", "error")])


def corpus_funnel(items: DataFrame, segments: DataFrame) -> DataFrame:
    """One row: crawled and separated items; segments, those removed as duplicates, approved ones and their seconds.

    ``items`` have found and separated, ``segments`` is_duplicate and duration_seconds. Counts are null-safe and an
    empty table gives zeros.
    """
    told = lambda c: F.coalesce(F.col(c), F.lit(False))
    left = items.agg(F.count_if(told("found")).alias("crawled"), F.count_if(told("found") & told("separated")).alias("separated"))
    d = F.when(~told("is_duplicate"), F.coalesce(F.nanvl(F.col("duration_seconds"), F.lit(None)), F.lit(0.0)))
    right = segments.agg(F.count("*").alias("sliced_segments"), F.count_if(told("is_duplicate")).alias("duplicates_removed"), F.count_if(~told("is_duplicate")).alias("gold_approved"), F.round(F.coalesce(F.sum(d), F.lit(0.0)), 2).alias("total_seconds"))
    return left.crossJoin(right)  # one row each


def format_audit(headers: DataFrame, seconds: tuple[float, float] = (4.5, 35.0)) -> DataFrame:
    """One row over sound headers (sample_rate, channels, sample_bytes, duration; all null if unreadable): files,
    corrupt ones, lengths, and how many have the rate, the channel, the width and the length that are wanted."""
    rate, channels, width, d = (F.col(c) for c in ("sample_rate", "channels", "sample_bytes", "duration"))
    whole, held = F.count("*"), lambda t: F.count_if(F.coalesce(t, F.lit(False)))
    return headers.agg(
        whole.alias("total_files"),
        F.count_if(rate.isNull()).alias("corrupt_files"),
        held(rate == 16000).alias("sr_16k"),
        held(channels == 1).alias("mono"),
        held(width == 2).alias("pcm16"),
        held(d.between(*seconds)).alias("fit"),
        F.when(whole > 0, rounded(held(d.between(*seconds)) / whole * 100, 1)).otherwise(F.lit(0.0)).alias("fit_percent"),
        F.round(F.coalesce(F.sum(d), F.lit(0.0)), 3).alias("seconds"),
        F.round(F.min(d), 3).alias("shortest"),
        F.round(F.max(d), 3).alias("longest"),
        F.round(F.avg(d), 3).alias("mean"),
    )


def week_totals(days: DataFrame, week: Column) -> DataFrame:
    """(week, files, hours) of days (files, hours) as the preferred sources tell them, and with week 0 in all."""
    return days.withColumn("_w", week).rollup("_w").agg(F.sum("files").alias("files"), F.round(F.sum("hours"), 2).alias("hours")).select(F.coalesce("_w", F.lit(0)).alias("week"), "files", "hours")
