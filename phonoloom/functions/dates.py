"""Weeks, local time and subtitle time, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: The zone of the crawl: UTC+07:00 all year.
OFFSET_HOURS = 7
#: The first day of week 2; all days before are week 1.
ANCHOR = "2026-08-24"


def local_time(at: Column) -> Column:
    """The crawl's local time of a UTC timestamp."""
    return at + F.expr(f"INTERVAL {OFFSET_HOURS} HOURS")


def week_number(day: Column, anchor: str = ANCHOR) -> Column:
    """1 before the anchor, else 2 and one more for each seven days since."""
    return F.when(day < F.lit(anchor).cast("date"), F.lit(1)).otherwise(2 + F.floor(F.datediff(day, F.lit(anchor).cast("date")) / 7)).cast("int")


def day_folder(day: Column, quarantine: bool = False) -> Column:
    """``Week<n>/<day>`` with the folder for rejected items if asked."""
    return F.concat(F.lit("Week"), week_number(day).cast("string"), F.lit("/"), F.date_format(day, "yyyy-MM-dd"), F.lit("/quarantine" if quarantine else "/audio"))


def iso_local(at: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS+07:00`` of a UTC timestamp."""
    return F.concat(F.date_format(local_time(at), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(f"+{OFFSET_HOURS:02d}:00"))


def iso_of_epoch(seconds: Column) -> Column:
    """The same of seconds since 1970."""
    return iso_local(F.timestamp_seconds(seconds))


def week_of_path(path: Column, ranges: list[tuple[str, str, int]]) -> Column:
    """The week a path tells: ``Week<n>`` in it, else that of the first range (first day, last day, week) in which the
    first date in it lies; null if neither tells."""
    day = F.nullif(F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))
    named = F.nullif(F.regexp_extract(path, r"Week(\d+)", 1), F.lit("")).cast("int")
    return F.coalesce(named, *[F.when(day.between(a, z), F.lit(w)) for a, z, w in ranges])


def subtitle_time(seconds: Column) -> Column:
    """``HH:MM:SS,mmm``; milliseconds are cut, not rounded. Null, NaN and negative seconds give null."""
    ms = F.floor(seconds * 1000).cast("bigint")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    hours = F.floor(ms / 3600000)
    text = F.concat(F.when(hours < 100, two(hours)).otherwise(hours.cast("string")), F.lit(":"), two(F.floor(ms / 60000) % 60), F.lit(":"), two(F.floor(ms / 1000) % 60), F.lit(","), F.lpad((ms % 1000).cast("string"), 3, "0"))
    return F.when((seconds >= 0) & ~F.isnan(seconds), text)


def subtitles(segments: Column) -> Column:
    """A subtitle file from an array of (id, start, end, text)."""
    return F.array_join(F.transform(segments, lambda s: F.concat(s["id"].cast("string"), F.lit("\n"), subtitle_time(s["start"]), F.lit(" --> "), subtitle_time(s["end"]), F.lit("\n"), F.trim(s["text"]), F.lit("\n"))), "\n")
