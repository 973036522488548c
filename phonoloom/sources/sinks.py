"""Where results go: partitioned tables, JSON lines, summaries, reports, quarantine, subtitle and sound files.

A table that is replaced is written beside the old one first and named by a small pointer file only when it is whole, so
that a reader or a retry never meets half of it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from phonoloom.functions.dates import subtitles, week_number
from phonoloom.operators.reconcile import BYTES_A_SECOND
from phonoloom.sources.landing import GOLD_SCHEMA, RECORD_SCHEMA, encode_sound

# The columns of a delivered record and of a gold record, in their order.
SPEC = ["item_id", "platform", "platform_video_id", "video_url", "title", "description", "posted_at", "language_raw", "audio_path", "duration_seconds", "crawl_batch", "crawled_at", "platform_meta", "language_region"]
GOLD = ["audio_path", "item_id", "duration_seconds", "spectral_flatness", "snr_estimate_db", "source_url", "separation_model", "label", "processed_at"]
LICENSE, USE = "research_only", "ASR_speech_recognition_training"


def _typed(df: DataFrame, schema: str, names: list[str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in T.StructType.fromDDL(schema).fields}
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in names])


def spec_columns(df: DataFrame) -> DataFrame:
    """The fourteen columns of a delivered record in their types; those that are missing are null."""
    return _typed(df, RECORD_SCHEMA, SPEC)


def extended(df: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """Records with the constants of the extended form and ``extra`` columns; an extra of the same name wins where it
    isn't null."""
    out = df.withColumns({"legal_license": F.lit(LICENSE), "intended_use": F.lit(USE)})
    return out.withColumns({k: F.coalesce(v, F.col(k)) if k in out.columns else v for k, v in (extra or {}).items()})


def write_records(df: DataFrame, path: str, day: Column, mode: str = "append") -> None:
    """Records as a table partitioned by week and day. Overwriting replaces only the days that have rows, others
    stay as they are; a job's commit makes a batch visible as a whole. A day is spread over as many files as its size asks for."""
    rows = df.withColumns({"week": week_number(day), "crawl_date": day})
    rows.hint("rebalance", "week", "crawl_date").write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("week", "crawl_date").parquet(path)


def write_quarantine(df: DataFrame, path: str, crawled_at: str = "crawled_at", reason: str = "reject_reason") -> None:
    """Rejected records below the day they were crawled on, whatever day it is now, with their reason."""
    write_records(df.where(F.col(reason).isNotNull() & F.col(crawled_at).isNotNull()), path, F.to_date(crawled_at))


def gold_columns(df: DataFrame) -> DataFrame:
    """The nine columns of a gold record; the label is that of the license."""
    return _typed(df.withColumn("label", F.lit(LICENSE)), GOLD_SCHEMA, GOLD)


def write_json_lines(df: DataFrame, path: str) -> None:
    """Gold records as JSON lines."""
    gold_columns(df).write.mode("overwrite").json(path)


def write_summary(row: DataFrame, path: str) -> None:
    """A table of one row, or of one a group, as one JSON-lines file."""
    row.coalesce(1).write.mode("overwrite").json(path)


def accepted_and_rejected(df: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Rows without and with a reason to reject; instead of moving files, the reason goes along."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


def without_done(errors: DataFrame, done: DataFrame) -> DataFrame:
    """An error log without the addresses that are done by now; rows without an address stay."""
    return errors.join(done.select("url").distinct(), "url", "left_anti")


class Versioned:
    """A table that is replaced as a whole: versions below ``path``, the last one that was finished is current."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _current(self) -> str | None:
        found = self.spark.read.format("text").option("recursiveFileLookup", "true")
        try:
            rows = found.load(f"{self.path}/current").orderBy(F.desc("value")).limit(1).collect()
        except Exception as e:  # nothing was written yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None
        return json.loads(rows[0]["value"])["version"] if rows else None

    def read(self) -> DataFrame:
        """The current version, or an empty table; a version that can't be read is an error, not an empty table."""
        version = self._current()
        return self.spark.createDataFrame([], self.schema) if version is None else self.spark.read.schema(self.schema).parquet(f"{self.path}/{version}")

    def replace(self, df: DataFrame) -> None:
        """``df``, which may come from the current version, becomes the table."""
        number = self._current()
        turn = int(number.split("-")[1]) + 1 if number else 0
        version = f"version-{turn:08d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self.path}/{version}")
        pointer = json.dumps({"turn": f"{turn:08d}", "version": version})
        self.spark.createDataFrame([(pointer,)], "value string").coalesce(1).write.mode("append").text(f"{self.path}/current")


class SeenSet(Versioned):
    """Keys under which accepted items are remembered, sorted, each once."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, "key string")

    def add(self, accepted: DataFrame, item_id: str = "item_id") -> None:
        from phonoloom.operators.dedup import remember

        self.replace(remember(self.read(), accepted, item_id).orderBy("key"))


def rewrite_errors(log: Versioned, done: DataFrame) -> None:
    """The error log without what is done: written anew, then swapped in."""
    log.replace(without_done(log.read(), done))


def transcript_files(rows: DataFrame, segments: str = "segments", text: str = "text") -> DataFrame:
    """``rows`` with txt, json and srt: the three forms of a transcript, as columns. Segments are (id, start, end, text)."""
    told = F.coalesce(F.col(text), F.lit(""))
    return rows.withColumns({"txt": F.concat(F.trim(told), F.lit("\n")), "json": F.to_json(F.struct(F.col(text).alias("text"), F.col(segments).alias("segments"))), "srt": subtitles(F.col(segments))})


def segment_sounds(pieces: DataFrame, samples: str = "samples", start: str = "start_sec", end: str = "end_sec", rate: int = BYTES_A_SECOND // 2) -> DataFrame:
    """``pieces`` with content: the part of the samples between two times as a 16-bit sound file. The samples stay a
    column; nothing is read or written per file."""
    from phonoloom.functions.signal import clip_seconds

    return pieces.withColumn("content", encode_sound(clip_seconds(F.col(samples), F.col(start), F.col(end), rate), rate)).drop(samples)
