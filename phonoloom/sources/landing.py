"""What lands: manifests, listings, record files, error logs, sound files, topics."""

from __future__ import annotations

import io
import struct
import wave

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ERROR_SCHEMA = "url string, item_id string, platform string, error string, failed_at timestamp"
RECORD_SCHEMA = (
    "item_id string, platform string, platform_video_id string, video_url string, title string, description string, posted_at timestamp, language_raw string, audio_path string, duration_seconds double, "
    "crawl_batch string, crawled_at timestamp, platform_meta struct<music_is_original: boolean, is_duet: boolean, is_stitch: boolean, has_platform_captions: boolean>, language_region string"
)
GOLD_SCHEMA = "audio_path string, item_id string, duration_seconds double, spectral_flatness double, snr_estimate_db double, source_url string, separation_model string, label string, processed_at timestamp"


def manifest_rows(lines: DataFrame, line: str = "value", photos: bool = False) -> DataFrame:
    """Rows whose line names an address: not blank, no comment. A byte order mark at the start goes, spaces around go;
    whether a line is a comment is seen before spaces go. Photo posts are left out unless asked for."""
    bare = F.regexp_replace(F.col(line), r"^\x{feff}", "")
    keep = (F.length(F.trim(bare)) > 0) & ~bare.startswith("#")
    if not photos:
        keep = keep & ~F.contains(bare, F.lit("/photo/"))
    return lines.where(keep).withColumn(line, F.trim(bare))


def manifest(spark: SparkSession, path: str, limit: int = 0, photos: bool = False) -> DataFrame:
    """(url) of a manifest file in the order of its lines; a limit of 0 takes all."""
    rows = manifest_rows(spark.read.text(path), photos=photos).select(F.col("value").alias("url"))
    return rows.limit(limit) if limit > 0 else rows


def expanded(rows: DataFrame, channels: DataFrame, url: str = "url") -> DataFrame:
    """Manifest rows in which an address of a channel is replaced by the channel's videos.

    ``channels`` (channel, video_url) holds what is known of them; a channel is an address whose last part is a handle
    or that has no number. Channels that nothing is known of stay as they are.
    """
    key = F.regexp_replace(F.split_part(F.col(url), F.lit("?"), F.lit(1)), "/+$", "")
    named = key.rlike(r"/@[^/]+$")
    known = channels.select(F.regexp_replace("channel", "/+$", "").alias("_channel"), "video_url").where("video_url is not null").distinct()
    out = rows.withColumn("_k", F.when(named, key)).join(known, F.col("_k") == F.col("_channel"), "left")
    return out.withColumn(url, F.coalesce("video_url", url)).drop("_k", "_channel", "video_url")


def channel_listing(parts: list[DataFrame], limit: int | None = None) -> DataFrame:
    """(url) of what several extractions of a channel found, each once, in the order of the addresses; ``None`` takes
    all. Nulls are left out."""
    whole = parts[0].select("url")
    for p in parts[1:]:
        whole = whole.unionByName(p.select("url"))
    out = whole.where("url is not null").distinct().orderBy("url")
    return out if limit is None else out.limit(limit)


def merged_folders(parts: list[DataFrame], name: str = "name") -> DataFrame:
    """Files of several folders as one: of equal names that of the first folder stays. Folders have the same columns."""
    whole = parts[0].withColumn("_folder", F.lit(0))
    for k, p in enumerate(parts[1:], 1):
        whole = whole.unionByName(p.withColumn("_folder", F.lit(k)))
    rest = [c for c in parts[0].columns if c != name]
    best = whole.groupBy(name).agg(F.min(F.struct("_folder", *rest)).alias("_r"))
    return best.select(name, *[F.col(f"_r.{c}").alias(c) for c in rest])


def listing(spark: SparkSession, path: str, pattern: str = "*.wav") -> DataFrame:
    """(path, length, item_id) of the files below a folder; their content isn't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("item_id"))


def record_files(spark: SparkSession, glob: str, schema: str = RECORD_SCHEMA, lines: bool = False) -> DataFrame:
    """Records of JSON-array files, or of JSON lines; files and records that can't be read give no row."""
    raw = spark.read.schema(f"{schema}, _bad string").option("multiLine", str(not lines).lower()).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(glob)
    return raw.where("_bad is null").drop("_bad")


def error_log(spark: SparkSession, path: str, platform: str | None = None) -> DataFrame:
    """Rows of a JSON-lines error log; lines that can't be read give no row."""
    rows = spark.read.schema(ERROR_SCHEMA).option("mode", "DROPMALFORMED").json(path)
    return rows if platform is None else rows.where(F.col("platform") == platform)


def table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one where nothing was written yet; files that can't be read give no rows."""
    try:
        return spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def topics(spark: SparkSession, path: str) -> DataFrame:
    """(topic, ordinal, kind, query) of a topic file: each topic's channels, then its keywords, in order."""
    raw = spark.read.option("wholetext", "true").text(path)
    parsed = raw.select(F.explode(F.from_json("value", "map<string, struct<name: string, channels: array<string>, keywords: array<string>>>")).alias("topic", "t"))
    both = F.concat(F.transform(F.coalesce("t.channels", F.array().cast("array<string>")), lambda c: F.struct(F.lit("channel").alias("kind"), c.alias("query"))), F.transform(F.coalesce("t.keywords", F.array().cast("array<string>")), lambda k: F.struct(F.lit("keyword").alias("kind"), k.alias("query"))))
    return parsed.select("topic", F.posexplode(both).alias("ordinal", "_q")).select("topic", "ordinal", "_q.kind", "_q.query")


SOUND = "struct<sample_rate: int, channels: int, sample_bytes: int, duration: double, samples: array<float>>"


def _decoded(content: bytes, mono: str) -> tuple | None:
    try:
        with wave.open(io.BytesIO(content)) as w:
            rate, channels, width, n = w.getframerate(), w.getnchannels(), w.getsampwidth(), w.getnframes()
            raw = w.readframes(n)
    except (wave.Error, EOFError, struct.error, TypeError):
        return None
    raw = raw[: len(raw) // (width * channels) * width * channels]
    if width == 3:
        # the missing low byte is zero
        wide = np.zeros((len(raw) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
        x = wide.view("<i4").ravel() / 2.0**31
    elif width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(float) - 128) / 128
    else:
        x = np.frombuffer(raw, f"<i{width}") / 2.0 ** (8 * width - 1)
    x = x.astype(np.float32)
    if channels > 1 and len(x):
        x = x.reshape(-1, channels)
        x = x.mean(axis=1) if mono == "mean" else x[:, 0]
    return rate, channels, width, n / rate if rate else 0.0, x


def decode_sound(content: Column, mono: str = "mean") -> Column:
    """Header and samples of a PCM sound file; null if it can't be read. Samples of 8, 16, 24 and 32 bits come
    as numbers in -1..1; several channels become their mean, or the first."""

    @F.pandas_udf(SOUND)
    def run(files: pd.Series) -> pd.DataFrame:
        rows = [_decoded(f, mono) if f is not None else None for f in files]
        return pd.DataFrame([r if r is not None else (None, None, None, None, None) for r in rows], columns=["sample_rate", "channels", "sample_bytes", "duration", "samples"])

    out = run(content)
    return F.when(out["sample_rate"].isNotNull(), out)


def encode_sound(samples: Column, rate: int = 16000) -> Column:
    """A 16-bit mono sound file of samples in -1..1."""

    @F.pandas_udf("binary")
    def run(arrays: pd.Series) -> pd.Series:
        out = []
        for x in arrays:
            if x is None:
                out.append(None)
                continue
            buffer = io.BytesIO()
            with wave.open(buffer, "wb") as w:
                w.setnchannels(1)
                w.setsampwidth(2)
                w.setframerate(rate)
                w.writeframes((np.clip(np.asarray(x, dtype=float), -1, 1) * 32767).astype("<i2").tobytes())
            out.append(buffer.getvalue())
        return pd.Series(out)

    return run(samples)


def sound_errors(rate: Column, channels: Column, width: Column, duration: Column) -> Column:
    """What is wrong with a sound file for the landing format, joined by ``; ``; null if nothing is."""
    tests = [
        (rate.isNull(), F.lit("unreadable")),
        (rate != 16000, F.concat(F.lit("sample_rate="), rate.cast("string"))),
        (channels != 1, F.concat(F.lit("channels="), channels.cast("string"))),
        (width != 2, F.concat(F.lit("sample_bytes="), width.cast("string"))),
        (duration <= 0, F.lit("empty")),
    ]
    return F.nullif(F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), m) for t, m in tests])), "; "), F.lit(""))
