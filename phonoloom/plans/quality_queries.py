"""Queries of sources and sinks, gates, scores, reports and the mastering plan, with their SQL.

Those of sinks write, read again and are compared with SQL over what went in. The SQL states its own limits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from phonoloom.functions import classify, dates, scores, signal, spectral, text
from phonoloom.functions.numbers import rounded
from phonoloom.operators import cache, dedup, gates, quality, reconcile, rollup, segment
from phonoloom.plans import mastering, pipeline, queries as base
from phonoloom.plans.cluster import own_dir, table
from phonoloom.plans.registry import Registry
from phonoloom.sources import landing, sinks
from phonoloom.streaming import events as streams

REGISTRY = Registry()
query, queries, oracle_sql = REGISTRY.query, REGISTRY.queries, REGISTRY.oracle_sql

_local, _day, _nan, _words, _week = base._local, base._day, base._nan, base._words, base._week


def _known(column: str) -> Column:
    return F.nanvl(column, F.lit(None))


# --- sources --------------------------------------------------------------------------------------------------------


@query("SELECT source_url AS url FROM metadata WHERE source_url IS NOT NULL UNION SELECT source_url FROM metadata_incoming WHERE source_url IS NOT NULL UNION SELECT url FROM error_log WHERE url IS NOT NULL")
def channel_listing(spark: SparkSession, sf: str) -> DataFrame:
    parts = [table(spark, sf, t).select(F.col(c).alias("url")) for t, c in (("metadata", "source_url"), ("metadata_incoming", "source_url"), ("error_log", "url"))]
    return landing.channel_listing(parts)


@query("SELECT DISTINCT url FROM error_log WHERE url IS NOT NULL ORDER BY url LIMIT 40")
def first_addresses(spark: SparkSession, sf: str) -> DataFrame:
    """The limit is what is shown: the first addresses in order; without one all come."""
    return landing.channel_listing([table(spark, sf, "error_log").select("url")], 40)


_CHANNEL = "nullif(regexp_extract(source_url, '^(.*/@[^/?#]+)/', 1), '')"


@query(
    f"""WITH c AS (SELECT DISTINCT {_CHANNEL} AS channel, source_url AS video FROM metadata WHERE source_url IS NOT NULL AND {_CHANNEL} IS NOT NULL), l AS (SELECT DISTINCT channel AS url FROM c UNION SELECT url FROM error_log WHERE url IS NOT NULL)
SELECT coalesce(c.video, l.url) AS url, count(*) AS n FROM l LEFT JOIN c ON c.channel = regexp_replace(split_part(l.url, '?', 1), '/+$', '') AND regexp_matches(regexp_replace(split_part(l.url, '?', 1), '/+$', ''), '/@[^/]+$') GROUP BY 1"""
)
def channel_expand(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "metadata").where("source_url is not null").select(F.nullif(F.regexp_extract("source_url", r"^(.*/@[^/?#]+)/", 1), F.lit("")).alias("channel"), F.col("source_url").alias("video_url")).where("channel is not null").distinct()
    lines = known.select(F.col("channel").alias("url")).union(table(spark, sf, "error_log").where("url is not null").select("url")).distinct()
    return landing.expanded(lines, known).groupBy("url").agg(F.count("*").alias("n"))


@query("SELECT platform, count(*) AS n, count(DISTINCT url) AS urls, count(error) AS told FROM error_log GROUP BY platform")
def error_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The error log as JSON lines among lines that can't be read."""
    path = own_dir(spark, "errors")
    lines = table(spark, sf, "error_log").select(F.to_json(F.struct("*")).alias("value"))
    broken = table(spark, sf, "error_log").select(F.concat(F.lit('{"url": '), F.coalesce("platform", F.lit(""))).alias("value"))
    lines.unionByName(broken).write.text(path)
    return landing.error_log(spark, path).groupBy("platform").agg(F.count("*").alias("n"), F.countDistinct("url").alias("urls"), F.count("error").alias("told"))


@query("SELECT platform, count(*) AS n, count(DISTINCT item_id) AS items, round(sum(CASE WHEN isnan(duration_seconds) THEN 0.0 ELSE coalesce(duration_seconds, 0.0) END), 2) AS seconds, count(platform_meta.is_duet) AS told FROM metadata_extended WHERE item_id IS NOT NULL GROUP BY platform")
def record_files(spark: SparkSession, sf: str) -> DataFrame:
    """Delivered records as JSON, read again with their schema."""
    path = own_dir(spark, "records")
    sinks.spec_columns(table(spark, sf, "metadata_extended").where("item_id is not null")).write.json(path)
    rows = landing.record_files(spark, path, lines=True)
    seconds = F.round(F.sum(F.coalesce(_known("duration_seconds"), F.lit(0.0))), 2)
    return rows.groupBy("platform").agg(F.count("*").alias("n"), F.countDistinct("item_id").alias("items"), seconds.alias("seconds"), F.count("platform_meta.is_duet").alias("told"))


@query("SELECT item_id, coalesce(max(a.d), max(b.d), -1.0) AS seconds FROM (SELECT item_id, min(coalesce(CASE WHEN isnan(duration_seconds) THEN NULL ELSE duration_seconds END, -1.0)) AS d FROM metadata_extended WHERE item_id IS NOT NULL GROUP BY 1) a FULL JOIN (SELECT item_id, min(coalesce(CASE WHEN isnan(duration_seconds) THEN NULL ELSE duration_seconds END, -1.0)) AS d FROM metadata WHERE item_id IS NOT NULL GROUP BY 1) b USING (item_id) GROUP BY item_id")
def merged_folders(spark: SparkSession, sf: str) -> DataFrame:
    parts = [table(spark, sf, t).where("item_id is not null").select("item_id", F.coalesce(_known("duration_seconds"), F.lit(-1.0)).alias("seconds")) for t in ("metadata_extended", "metadata")]
    return landing.merged_folders(parts, "item_id")


@query("SELECT count(*) AS total_files, count(*) FILTER (WHERE embedding[1] > 0.1) AS corrupt_files, count(*) FILTER (WHERE NOT embedding[1] > 0.1) AS sr_16k, count(*) FILTER (WHERE NOT embedding[1] > 0.1) AS mono, count(*) FILTER (WHERE NOT embedding[1] > 0.1) AS pcm16, round(sum(CASE WHEN embedding[1] > 0.1 THEN 0 ELSE len(embedding) / 16000 END), 3) AS seconds FROM embeddings")
def decode_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Sound files, some of them broken, decoded; what can't be read is counted, not raised."""
    whole = landing.encode_sound(F.col("embedding"))
    files = table(spark, sf, "embeddings").select(F.when(F.col("embedding")[0] > 0.1, F.substring(whole, 1, 20)).otherwise(whole).alias("content"))
    heads = files.select(landing.decode_sound(F.col("content")).alias("s")).select("s.sample_rate", "s.channels", "s.sample_bytes", "s.duration")
    return quality.format_audit(heads).select("total_files", "corrupt_files", "sr_16k", "mono", "pcm16", "seconds")


@query(
    f"""WITH h AS (SELECT {_nan('duration_seconds')} AS d, separation_model IS NOT NULL AS known FROM metadata)
SELECT count(*) AS total_files, count(*) FILTER (WHERE NOT known) AS corrupt_files, count(*) FILTER (WHERE known AND d < 60) AS sr_16k, count(*) FILTER (WHERE known AND d BETWEEN 4.5 AND 35.0) AS fit, floor(count(*) FILTER (WHERE known AND d BETWEEN 4.5 AND 35.0) / count(*) * 100 * 10 + 0.5::double) / 10 AS fit_percent,
round(min(d) FILTER (WHERE known), 3) AS shortest, round(max(d) FILTER (WHERE known), 3) AS longest FROM h"""
)
def format_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Headers by rule from metadata: without a model unreadable, long ones at another rate."""
    d, known = _known("duration_seconds"), F.col("separation_model").isNotNull()
    heads = table(spark, sf, "metadata").select(F.when(known, F.when(d < 60, F.lit(16000)).otherwise(F.lit(44100))).alias("sample_rate"), F.when(known, F.lit(1)).alias("channels"), F.when(known, F.lit(2)).alias("sample_bytes"), F.when(known, d).alias("duration"))
    return quality.format_audit(heads).select("total_files", "corrupt_files", "sr_16k", "fit", "fit_percent", "shortest", "longest")


# --- sinks ----------------------------------------------------------------------------------------------------------


@query(f"SELECT {_week('cast(' + _day('crawled_at') + ' AS date)')} AS week, {_day('crawled_at')} AS day, count(*) AS n, count(DISTINCT item_id) AS items, 'research_only' AS legal_license FROM metadata_extended WHERE crawled_at IS NOT NULL GROUP BY 1, 2")
def written_records(spark: SparkSession, sf: str) -> DataFrame:
    path = own_dir(spark, "table")
    rows = table(spark, sf, "metadata_extended").where("crawled_at is not null")
    sinks.write_records(sinks.extended(sinks.spec_columns(rows), {"transcript_raw": F.lit(None).cast("string")}), path, base.day_of("crawled_at"))
    back = spark.read.parquet(path)
    return back.groupBy("week", F.date_format("crawl_date", "yyyy-MM-dd").alias("day"), "legal_license").agg(F.count("*").alias("n"), F.countDistinct("item_id").alias("items"))


@query("SELECT separation_model, 'research_only' AS label, count(*) AS n, count(duration_seconds) AS durations, count(processed_at) AS times FROM metadata GROUP BY separation_model")
def gold_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = own_dir(spark, "gold")
    sinks.write_json_lines(table(spark, sf, "metadata"), path)
    back = spark.read.schema(landing.GOLD_SCHEMA).json(path)
    return back.groupBy("separation_model", "label").agg(F.count("*").alias("n"), F.count("duration_seconds").alias("durations"), F.count("processed_at").alias("times"))


@query(f"WITH {base._DAYS} SELECT day, items, total_hours, errors, items + errors AS attempted, printf('%.1f', CASE WHEN items + errors > 0 THEN round(items / (items + errors) * 100, 1) ELSE 0.0 END) || '%' AS yield_rate FROM days")
def summary_files(spark: SparkSession, sf: str) -> DataFrame:
    path = own_dir(spark, "summary")
    sinks.write_summary(rollup.yield_funnel(base.day_summary(spark, sf)), path)
    return spark.read.json(path).select("day", "items", "total_hours", "errors", "attempted", "yield_rate")


_GATES = f"""g AS (SELECT crawled_at, item_id, CASE WHEN d < 5.0 THEN 'too_short' WHEN d > 7200.0 THEN 'too_long' WHEN m >= 0.70 THEN 'music_quarantine' WHEN s > 0.70 THEN 'synthetic' WHEN (snr < 12.0 OR sr < 0.25) AND snr < 10.0 THEN 'low_quality' WHEN m >= 0.30 THEN 'residual_music' WHEN w < 3 THEN 'no_speech' WHEN cd = 'REJECT' THEN 'content' END AS reason
FROM (SELECT crawled_at, item_id, {_nan('snr_db')} AS snr, {_nan('duration_seconds')} AS d, {_nan('music_prob')} AS m, {_nan('synthetic_prob')} AS s, {_nan('speech_ratio')} AS sr, {_words('transcript_raw')} AS w, content_decision AS cd FROM metadata_extended))"""


def _gated(spark: SparkSession, sf: str) -> DataFrame:
    used = ["snr_db", "duration_seconds", "music_prob", "synthetic_prob", "speech_ratio"]
    return table(spark, sf, "metadata_extended").withColumns({c: _known(c) for c in used}).withColumn("reject_reason", gates.item_gates())


@query(f"WITH {_GATES} SELECT strftime(crawled_at, '%Y-%m-%d') AS day, reason, count(*) AS n FROM g WHERE reason IS NOT NULL AND crawled_at IS NOT NULL GROUP BY 1, 2")
def quarantine_by_day(spark: SparkSession, sf: str) -> DataFrame:
    path = own_dir(spark, "quarantine")
    sinks.write_quarantine(_gated(spark, sf).select("item_id", "crawled_at", "reject_reason"), path)
    return spark.read.parquet(path).groupBy(F.date_format("crawl_date", "yyyy-MM-dd").alias("day"), F.col("reject_reason").alias("reason")).agg(F.count("*").alias("n"))


@query(
    f"""WITH {_GATES}, k AS (SELECT DISTINCT cast(crawled_at AS date) AS d FROM g WHERE crawled_at >= TIMESTAMP '2026-09-10 00:00:00' AND reason IS NULL)
SELECT strftime(crawled_at, '%Y-%m-%d') AS day, count(*) AS n FROM g LEFT JOIN k ON k.d = cast(crawled_at AS date) WHERE crawled_at IS NOT NULL AND (k.d IS NULL OR reason IS NULL) GROUP BY 1"""
)
def day_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """A table of days of which the later ones are written anew without rejected records; the others stay, and so do
    days of which nothing is written."""
    path = own_dir(spark, "days")
    rows = _gated(spark, sf).where("crawled_at is not null").select("item_id", "crawled_at", "reject_reason")
    sinks.write_records(rows, path, F.to_date("crawled_at"))
    later = rows.where("crawled_at >= timestamp '2026-09-10 00:00:00'")
    sinks.write_records(later.where("reject_reason is null"), path, F.to_date("crawled_at"), mode="overwrite")
    return spark.read.parquet(path).groupBy(F.date_format("crawl_date", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


@query(f"SELECT key FROM ({base._seen('metadata')} UNION {base._seen('metadata_incoming')}) WHERE key IS NOT NULL")
def seen_persisted(spark: SparkSession, sf: str) -> DataFrame:
    seen = sinks.SeenSet(spark, own_dir(spark, "seen"))
    for name in ("metadata", "metadata_incoming"):
        seen.add(table(spark, sf, name))
    return seen.read()


@query("SELECT platform, error, count(*) AS n FROM error_log WHERE url IS NULL OR url NOT IN (SELECT source_url FROM metadata WHERE source_url IS NOT NULL) GROUP BY 1, 2")
def errors_rewritten(spark: SparkSession, sf: str) -> DataFrame:
    log = sinks.Versioned(spark, own_dir(spark, "log"), landing.ERROR_SCHEMA)
    log.replace(table(spark, sf, "error_log").select("url", "item_id", "platform", "error", F.col("failed_at").cast("timestamp").alias("failed_at")))
    sinks.rewrite_errors(log, table(spark, sf, "metadata").select(F.col("source_url").alias("url")).where("url is not null"))
    return log.read().groupBy("platform", "error").agg(F.count("*").alias("n"))


@query(
    f"""WITH s AS (SELECT DISTINCT item_id, duration_seconds AS x, transcript_raw, trim(transcript_raw, ' ') AS t FROM metadata_extended WHERE item_id IS NOT NULL AND transcript_raw IS NOT NULL AND duration_seconds >= 0 AND NOT isnan(duration_seconds)),
m AS (SELECT *, cast(floor(x * 1000) AS bigint) AS ms FROM s)
SELECT item_id, md5(t || chr(10)) AS txt_md5, md5('1' || chr(10) || '00:00:00,000 --> ' || ({base._STAMP}) || chr(10) || t || chr(10)) AS srt_md5, true AS json_same FROM m"""
)
def transcript_forms(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "metadata_extended").where("item_id is not null and transcript_raw is not null and duration_seconds >= 0 and not isnan(duration_seconds)").select("item_id", "duration_seconds", F.col("transcript_raw").alias("text")).distinct()
    one = F.array(F.struct(F.lit(1).alias("id"), F.lit(0.0).alias("start"), F.col("duration_seconds").alias("end"), F.col("text").alias("text")))
    made = sinks.transcript_files(rows.withColumn("segments", one))
    again = F.from_json("json", "text string, segments array<struct<id: int, start: double, end: double, text: string>>")
    return made.select("item_id", F.md5("txt").alias("txt_md5"), F.md5("srt").alias("srt_md5"), (again["text"] == F.col("text")).alias("json_same"))


@query("SELECT vec_id, cast(floor((0.5 + abs(embedding[1])) * 16) - floor(0.5 * 16) AS int) AS n FROM embeddings")
def segment_sounds(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of sounds as files of their own, read again."""
    pieces = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("samples"), F.lit(0.5).alias("start_sec"), (0.5 + F.abs(F.col("embedding")[0].cast("double"))).alias("end_sec"))
    files = sinks.segment_sounds(pieces, rate=16)
    return files.select("vec_id", F.size(landing.decode_sound(F.col("content"))["samples"]).alias("n"))


# --- dates, keys, limits --------------------------------------------------------------------------------------------


@query(f"SELECT event_id, strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '+07:00' AS iso, strftime(to_timestamp(event_id * 86400) AT TIME ZONE 'UTC' + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '+07:00' AS epoch_iso FROM events WHERE event_id < 4000000")
def iso_dates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").where("event_id < 4000000").select("event_id", dates.iso_local(F.col("ts")).alias("iso"), dates.iso_of_epoch(F.col("event_id") * 86400).alias("epoch_iso"))


@query(
    """WITH p AS (SELECT CASE WHEN duration_seconds < 10 THEN 'Week7/' ELSE '' END || strftime(processed_at, '%Y-%m-%d') || '/audio/' || item_id AS path FROM metadata WHERE item_id IS NOT NULL AND processed_at IS NOT NULL),
d AS (SELECT path, regexp_extract(path, '([0-9]{4}-[0-9]{2}-[0-9]{2})', 1) AS d FROM p)
SELECT CASE WHEN starts_with(path, 'Week7/') THEN 7 WHEN d BETWEEN '2026-08-24' AND '2026-08-30' THEN 2 WHEN d BETWEEN '2026-08-31' AND '2026-09-06' THEN 3 WHEN d BETWEEN '2026-09-07' AND '2026-09-13' THEN 4 ELSE 0 END AS week, count(*) AS n FROM d GROUP BY 1"""
)
def week_of_path(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "metadata").where("item_id is not null and processed_at is not null")
    path = F.concat(F.when(F.col("duration_seconds") < 10, F.lit("Week7/")).otherwise(F.lit("")), F.date_format("processed_at", "yyyy-MM-dd"), F.lit("/audio/"), F.col("item_id"))
    weeks = [("2026-08-24", "2026-08-30", 2), ("2026-08-31", "2026-09-06", 3), ("2026-09-07", "2026-09-13", 4)]
    return rows.groupBy(F.coalesce(dates.week_of_path(path, weeks), F.lit(0)).alias("week")).agg(F.count("*").alias("n"))


@query(f"WITH {base._X} SELECT round(len(x) / 16.0, 1) AS seconds, round(sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x)), 3) AS level, count(*) AS n, min(vec_id) AS first FROM x GROUP BY 1, 2")
def coarse_key(spark: SparkSession, sf: str) -> DataFrame:
    """Sounds by length and level, as a rough key for near copies."""
    rows = base._samples(spark, sf).select("vec_id", signal.coarse_key(F.size("x") / 16.0, signal.rms(F.col("x"))).alias("k"))
    return rows.groupBy("k.seconds", "k.level").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))


@query("SELECT coalesce(platform, '?') AS platform, count(*) AS n FROM metadata_extended WHERE lower(trim(uploader, ' ')) IN (SELECT lower(trim(uploader, ' ')) FROM metadata_extended WHERE item_id = (SELECT min(item_id) FROM metadata_extended WHERE uploader IS NOT NULL)) GROUP BY 1")
def allow_list(spark: SparkSession, sf: str) -> DataFrame:
    """Records of the users who may ask: here the one of the smallest id."""
    rows = table(spark, sf, "metadata_extended").withColumn("_u", F.lower(F.trim("uploader")))
    one = [r[0] for r in rows.where("uploader is not null").agg(F.min_by("_u", "item_id")).collect()]
    return rows.where(scores.allowed(F.col("_u"), one)).groupBy(F.coalesce("platform", F.lit("?")).alias("platform")).agg(F.count("*").alias("n"))


# --- gates and scores -----------------------------------------------------------------------------------------------


@query(
    """SELECT CASE WHEN platform = 'tiktok' AND platform_meta.music_is_original = false AND lower(trim(coalesce(title, ''), ' ')) NOT IN ('', 'original sound', 'am thanh goc', 'tieng dong goc') THEN 'named' ELSE 'unknown' END AS track, count(*) AS n FROM metadata_extended GROUP BY 1"""
)
def named_track(spark: SparkSession, sf: str) -> DataFrame:
    named = scores.named_track(F.col("platform"), F.col("platform_meta.music_is_original"), F.col("title"))
    return table(spark, sf, "metadata_extended").groupBy(F.when(named, F.lit("named")).otherwise(F.lit("unknown")).alias("track")).agg(F.count("*").alias("n"))


@query(
    f"""WITH e AS (SELECT {_nan('music_prob')} AS m, {_nan('speech_ratio')} AS sr FROM metadata_extended)
SELECT coalesce(m >= 0.30 AND m < 0.70, false) AS separated, coalesce(m >= 0.30 AND m < 0.70 AND m * (1 - sr) > 0.20, false) AS rejected, count(*) AS n FROM e GROUP BY 1, 2"""
)
def residual_music(spark: SparkSession, sf: str) -> DataFrame:
    """Music after separation is taken as what was there times the share without speech."""
    m, sr = _known("music_prob"), _known("speech_ratio")
    separated = F.coalesce(classify.music_status(m) == "music", F.lit(False))
    return table(spark, sf, "metadata_extended").groupBy(separated.alias("separated"), scores.residual_music(m * (1 - sr), separated).alias("rejected")).agg(F.count("*").alias("n"))


_HEARD = f"""h AS (SELECT transcript_raw AS t, {_words('transcript_raw')} AS w, -1 + coalesce({_nan('quality_score')}, 0) AS lp, 1 - coalesce({_nan('speech_ratio')}, 0) AS ns, content_decision IS NOT NULL AS ok FROM metadata_extended)"""
_EMPTY = "length(trim(coalesce(t, ''), ' ')) = 0"


def _heard(spark: SparkSession, sf: str) -> DataFrame:
    """Records as recognised ones: how sure and how silent from their quality and speech."""
    lp, ns = -1 + F.coalesce(_known("quality_score"), F.lit(0.0)), 1 - F.coalesce(_known("speech_ratio"), F.lit(0.0))
    return table(spark, sf, "metadata_extended").select(F.col("transcript_raw").alias("t"), text.word_count(F.col("transcript_raw")).alias("w"), lp.alias("lp"), ns.alias("ns"), F.col("content_decision").isNotNull().alias("ok"))


@query(
    f"""WITH {_HEARD} SELECT CASE WHEN {_EMPTY} THEN 'empty_transcript' WHEN ns > 0.50 THEN 'no_speech' WHEN lp < -0.5 THEN 'low_quality' ELSE 'pass' END AS post, w < 3 OR ns > 0.50 AS hard,
CASE WHEN NOT ok OR {_EMPTY} THEN 'none' WHEN lp >= -0.5 AND ns <= 0.3 THEN 'good' WHEN lp >= -0.8 AND ns <= 0.6 THEN 'degraded' ELSE 'none' END AS grade, ok AND length(trim(coalesce(t, ''), ' ')) >= 5 AND lp >= -0.7 AND ns <= 0.4 AS usable, count(*) AS n FROM h GROUP BY 1, 2, 3, 4"""
)
def recognition_gates(spark: SparkSession, sf: str) -> DataFrame:
    t, w, lp, ns, ok = (F.col(c) for c in ("t", "w", "lp", "ns", "ok"))
    post = F.coalesce(scores.speech_post_gate(t, lp, ns), F.lit("pass"))
    return _heard(spark, sf).groupBy(post.alias("post"), scores.recognition_gate(w, ns).alias("hard"), scores.transcript_grade(ok, t, lp, ns).alias("grade"), scores.is_good_quality(ok, t, lp, ns).alias("usable")).agg(F.count("*").alias("n"))


@query(
    f"""SELECT item_id, count(*) AS n_segments, round(avg(lp), 6) AS avg_logprob, round(avg(ns), 6) AS no_speech_prob FROM (SELECT item_id, -1 + coalesce({_nan('quality_score')}, 0) AS lp, 1 - coalesce({_nan('speech_ratio')}, 0) AS ns FROM metadata_extended WHERE item_id IS NOT NULL) GROUP BY item_id"""
)
def segment_means(spark: SparkSession, sf: str) -> DataFrame:
    lp, ns = -1 + F.coalesce(_known("quality_score"), F.lit(0.0)), 1 - F.coalesce(_known("speech_ratio"), F.lit(0.0))
    rows = table(spark, sf, "metadata_extended").where("item_id is not null").groupBy("item_id").agg(F.collect_list(F.struct(lp.alias("avg_logprob"), ns.alias("no_speech_prob"))).alias("s"))
    return rows.withColumn("m", scores.segment_means(F.col("s"))).select("item_id", F.size("s").cast("bigint").alias("n_segments"), F.round("m.avg_logprob", 6).alias("avg_logprob"), F.round("m.no_speech_prob", 6).alias("no_speech_prob"))


@query(
    f"""WITH m AS (SELECT spectral_flatness <= 0.15 AND NOT isnan(spectral_flatness) AND snr_estimate_db >= 10.0 AND NOT isnan(snr_estimate_db) AS gold FROM metadata) SELECT coalesce(gold, false) AS is_gold, count(*) AS n FROM m GROUP BY 1"""
)
def gold_gate(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.gold_gate(table(spark, sf, "metadata")).groupBy("is_gold").agg(F.count("*").alias("n"))


_CLAMP = "least(1.0::double, greatest(0.0::double, {}))"


def _clamped(x: str) -> str:
    return _CLAMP.format(x)


@query(
    f"""WITH e AS (SELECT DISTINCT item_id, {_nan('duration_seconds')} AS d, coalesce({_nan('music_prob')}, 0.0) AS h, coalesce({_nan('snr_db')}, 0.0) AS c, 0.03::double * coalesce({_nan('speech_ratio')}, 0.0) AS f FROM metadata_extended WHERE item_id IS NOT NULL),
s AS (SELECT *, 0.0::double AS w1, greatest(0.0::double, d / 2 - 10) AS w2, greatest(0.0::double, d - 20) AS w3 FROM e WHERE d >= 0),
w AS (SELECT *, w1 AS w0 FROM s UNION ALL SELECT *, w2 FROM s WHERE round_even(w2 * 10, 0) <> 0 UNION ALL SELECT *, w3 FROM s WHERE round_even(w3 * 10, 0) <> 0 AND round_even(w3 * 10, 0) <> round_even(w2 * 10, 0)),
p AS (SELECT item_id, w0, CASE WHEN least(20.0::double, d - w0) < 2 THEN 0.0::double ELSE 0.5 * {_clamped('(h - 0.25) / 0.20')} + 0.3 * {_clamped('(c + w0 / 10 - 10) / 10')} + 0.2 * {_clamped('(0.015 - f) / 0.015')} END AS p FROM w)
SELECT item_id, count(*) AS windows, round(max(p), 8) AS music_prob, max(p) >= 0.30 AS is_music FROM p GROUP BY item_id"""
)
def music_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Measures by rule from the record's columns; later windows have more contrast."""
    d, zero = _known("duration_seconds"), F.lit(0.0)
    rows = table(spark, sf, "metadata_extended").where("item_id is not null").select("item_id", d.alias("d"), F.coalesce(_known("music_prob"), zero).alias("h"), F.coalesce(_known("snr_db"), zero).alias("c"), (0.03 * F.coalesce(_known("speech_ratio"), zero)).alias("f")).distinct()
    each = rows.withColumn("at", F.explode(scores.music_windows(F.col("d"))))
    p = scores.music_window(F.col("h"), F.col("c") + F.col("at") / 10, F.col("f"), F.least(F.lit(20.0), F.col("d") - F.col("at")))
    return each.groupBy("item_id").agg(F.count("*").alias("windows"), F.max(p).alias("_p")).select("item_id", "windows", F.round("_p", 8).alias("music_prob"), (F.col("_p") >= 0.30).alias("is_music"))


_FEATURES = "f AS (SELECT vec_id, abs(embedding[1]::double) * 4 AS h, 10 + abs(embedding[2]::double) * 40 AS c, abs(embedding[3]::double) / 10 AS f, abs(embedding[4]::double) AS z, 1 + abs(embedding[5]::double) * 20 AS s FROM embeddings)"


@query(
    f"""WITH {_FEATURES}, m AS (SELECT *, {_clamped(f"0.45 * {_clamped('(h - 0.20) / 0.35')} + 0.35 * {_clamped('(c - 12.0) / 12.0')} + 0.20 * {_clamped('(0.02 - f) / 0.02')}")} AS m FROM f), p AS (SELECT *, {_clamped('0.6 * (1 - least(1.0::double, abs(z - 0.08) / 0.08)) + 0.4 * (1 - m)')} AS sp FROM m)
SELECT vec_id, round(CASE WHEN s < 1.5 THEN 0.0 ELSE m END, 4) AS music_prob, round(CASE WHEN s < 1.5 THEN 1.0 ELSE sp END, 4) AS speech_prob, s >= 1.5 AND m > 0.70 AND sp < 0.25 AS is_pure_music FROM p"""
)
def prefilter_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of the vectors stand for the measures."""
    x = lambda k: F.abs(F.col("embedding")[k].cast("double"))
    return table(spark, sf, "embeddings").select("vec_id", scores.prefilter(x(0) * 4, 10 + x(1) * 40, x(2) / 10, x(3), 1 + x(4) * 20).alias("p")).select("vec_id", "p.*")


@query(
    f"""WITH e AS (SELECT vec_id, CASE WHEN embedding[1] > 0 THEN abs(embedding[2]::double) / 20 END AS j, abs(embedding[3]::double) / 100 AS fx, abs(embedding[4]::double) * 200 AS mf, abs(embedding[5]::double) * 60 AS ph, 1 + abs(embedding[6]::double) * 20 AS s FROM embeddings)
SELECT vec_id, round(CASE WHEN s < 2 THEN 0.0 ELSE {_clamped(f"(CASE WHEN j IS NULL THEN 0.0 ELSE 0.40 * {_clamped('1 - j / 0.008')} END + 0.25 * {_clamped('1 - fx / 0.002')} + 0.20 * {_clamped('1 - mf / 15.0')} + 0.15 * CASE WHEN ph > 8.0 OR ph < 0.5 THEN 0.75 ELSE 0.0 END) / CASE WHEN j IS NULL THEN 0.60::double ELSE 1.0::double END")} END, 4) AS score FROM e"""
)
def synthetic_score(spark: SparkSession, sf: str) -> DataFrame:
    x = lambda k: F.abs(F.col("embedding")[k].cast("double"))
    score = scores.synthetic(F.when(F.col("embedding")[0] > 0, x(1) / 20), x(2) / 100, x(3) * 200, x(4) * 60, 1 + x(5) * 20)
    return table(spark, sf, "embeddings").select("vec_id", F.round(score, 4).alias("score"))


@query(
    f"""WITH {base._E}, r AS (SELECT vec_id, list_transform(e, lambda v: sqrt(v)) AS r FROM e), d AS (SELECT vec_id, r, list_transform(range(2, len(r) + 1), lambda i: r[i] - r[i - 1]) AS d FROM r)
SELECT vec_id, round(sqrt(list_sum(list_transform(d, lambda v: pow(v - list_sum(d) / len(d), 2))) / len(d)) / (list_sum(r) / len(r)), 6) AS jitter, round(list_sum(list_transform(d, lambda v: v * v)) / len(d), 9) AS flux FROM d"""
)
def level_jitter(spark: SparkSession, sf: str) -> DataFrame:
    rows = base._samples(spark, sf).withColumn("r", F.transform("e", lambda e: F.sqrt(e)))
    return rows.select("vec_id", F.round(scores.jitter(F.col("r")), 6).alias("jitter"), F.round(scores.flux(F.col("r")), 9).alias("flux"))


@query(f"WITH {base._X} SELECT vec_id, round(list_sum(list_transform(range(1, len(x)), lambda i: CASE WHEN x[i] * x[i + 1] < 0 THEN 1.0::double ELSE 0.0::double END)) / (len(x) - 1), 6) AS zcr, true AS in_range FROM x")
def sound_measures(spark: SparkSession, sf: str) -> DataFrame:
    """The spectral measures of short sounds: crossings, and whether the others lie where they can."""
    m = spectral.measures(signal.doubles(F.col("embedding")), F.lit(16000.0), 32, 16)
    rows = table(spark, sf, "embeddings").where("embedding is not null").select("vec_id", m.alias("m"))
    held = F.col("m.harmonic_ratio").between(0, 1) & F.col("m.flatness").between(0, 1 + 1e-9) & (F.col("m.contrast") >= 0) & (F.col("m.flux") >= 0) & (F.col("m.mfcc_variance") >= 0) & F.col("m.jitter").isNull()
    return rows.select("vec_id", F.round("m.zcr", 6).alias("zcr"), held.alias("in_range"))


@query(
    f"""WITH {base._X}, u AS (SELECT vec_id, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS i FROM x), q AS (SELECT vec_id, i, i - row_number() OVER (PARTITION BY vec_id ORDER BY i) AS island FROM u WHERE abs(v) <= pow(10, -18 / 20.0::double)),
s AS (SELECT vec_id, min(i) / 16.0::double AS a, (max(i) + 1) / 16.0::double AS b FROM q GROUP BY vec_id, island) SELECT vec_id, a AS start, b AS "end", round((a + b) / 2, 3) AS mid FROM s WHERE b - a >= 0.35 - 1e-9::double"""
)
def silence_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors as sounds of 16 samples a second, silent at -18 dB."""
    rows = table(spark, sf, "embeddings").where("embedding is not null").select("vec_id", F.explode(spectral.silences(signal.doubles(F.col("embedding")), F.lit(16.0), -18.0)).alias("s"))
    return rows.select("vec_id", "s.*")


@query(
    f"""WITH {base._TALK}, l AS (SELECT user_id, d, list(e ORDER BY s, e) AS starts, list(s ORDER BY s, e) AS nexts FROM t GROUP BY 1, 2), p AS (SELECT user_id, d, unnest(range(1, len(starts))) AS i, starts, nexts FROM l)
SELECT user_id, strftime(d, '%Y-%m-%d') AS day, count(*) AS pauses, round(sum(nexts[i + 1] - starts[i]), 3) AS seconds FROM p WHERE nexts[i + 1] > starts[i] GROUP BY 1, 2"""
)
def paired_silences(spark: SparkSession, sf: str) -> DataFrame:
    """Pauses of a user's day from two lists, paired by place; the day bounds the lists."""
    days = base._talk(spark, sf).groupBy("user_id", "d").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("i"))
    lists = days.select("user_id", "d", F.transform(F.slice("i", 1, F.size("i") - 1), lambda x: x["end"]).alias("a"), F.transform(F.slice("i", 2, F.size("i")), lambda x: x["start"]).alias("b"))
    rows = lists.select("user_id", F.date_format("d", "yyyy-MM-dd").alias("day"), F.explode(segment.paired_silences(F.col("a"), F.col("b"))).alias("g"))
    return rows.groupBy("user_id", "day").agg(F.count("*").alias("pauses"), F.round(F.sum(F.col("g.end") - F.col("g.start")), 3).alias("seconds"))


@query(
    f"""WITH r AS (SELECT DISTINCT item_id, coalesce(transcript_raw, '') AS b, coalesce({_nan('quality_score')}, 0.0) * 60 AS sd, 100 + coalesce({_nan('snr_db')}, 0.0) * 4 AS mean, coalesce(platform_meta.is_duet, false) AS sev FROM metadata_extended WHERE item_id IS NOT NULL), n AS (SELECT *, {base._worded('b')} AS w FROM r),
h AS (SELECT item_id, sd, mean, sev, {', '.join(f"{base._present('w', v, True)} AS {k}" for k, v in base.lexicons.VOCABULARY.items())} FROM n)
SELECT CASE WHEN sev AND ((central > 0 AND (south > 0 OR north > 0)) OR (south > 0 AND north > 0)) THEN 'Mixed' WHEN (central >= 1 AND south >= 1) OR (central >= 1 AND north >= 1) OR (south >= 2 AND north >= 2) THEN 'Mixed' WHEN central >= 1 THEN 'Central' WHEN south >= 1 THEN 'South' WHEN north >= 1 THEN 'North'
WHEN sd >= 38.0 THEN 'South' WHEN sd > 0 AND sd <= 20.0 AND mean < 170.0 THEN 'Central' ELSE 'North' END AS dialect, count(*) AS n FROM h GROUP BY 1"""
)
def dialect_with_pitch(spark: SparkSession, sf: str) -> DataFrame:
    """The whole ladder; pitch by rule from quality and level, several voices in duets."""
    rows = table(spark, sf, "metadata_extended").where("item_id is not null").select("item_id", F.coalesce("transcript_raw", F.lit("")).alias("b"), (F.coalesce(_known("quality_score"), F.lit(0.0)) * 60).alias("sd"), (100 + F.coalesce(_known("snr_db"), F.lit(0.0)) * 4).alias("mean"), F.coalesce("platform_meta.is_duet", F.lit(False)).alias("sev")).distinct()
    hits = classify.dialect_hits(F.col("w"))
    held = rows.withColumn("w", text.worded(F.col("b"))).select("sd", "mean", "sev", *[c.alias(k) for k, c in hits.items()])
    return held.groupBy(classify.dialect_class({k: F.col(k) for k in hits}, F.col("sd"), F.col("mean"), F.col("sev")).alias("dialect")).agg(F.count("*").alias("n"))


@query(
    f"""WITH i AS (SELECT source_url AS url, true AS found, source_url IN (SELECT source_url FROM metadata WHERE source_url IS NOT NULL) AS seen, {_nan('snr_estimate_db')} < 10 AS rejected, CASE WHEN {_nan('duration_seconds')} >= 3 THEN 1 ELSE 0 END AS segments, NULL AS error FROM metadata_incoming WHERE source_url IS NOT NULL
UNION ALL SELECT url, false, false, false, 0, error FROM error_log WHERE url IS NOT NULL),
s AS (SELECT CASE WHEN error IS NOT NULL THEN 'error' WHEN NOT found THEN 'rejected' WHEN seen THEN 'skipped' WHEN coalesce(rejected, false) OR segments = 0 THEN 'rejected' ELSE 'done' END AS s FROM i)
SELECT count(*) AS total, count(*) FILTER (WHERE s = 'done') AS done, count(*) FILTER (WHERE s = 'skipped') AS skipped, count(*) FILTER (WHERE s = 'rejected') AS rejected, count(*) FILTER (WHERE s = 'error') AS error FROM s"""
)
def run_stats(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "metadata").where("source_url is not null").select(F.col("source_url").alias("url")).distinct().withColumn("seen", F.lit(True))
    new = table(spark, sf, "metadata_incoming").where("source_url is not null").select(F.col("source_url").alias("url"), F.lit(True).alias("found"), (_known("snr_estimate_db") < 10).alias("rejected"), F.when(_known("duration_seconds") >= 3, F.lit(1)).otherwise(F.lit(0)).alias("segments"), F.lit(None).cast("string").alias("error")).join(known, "url", "left")
    failed = table(spark, sf, "error_log").where("url is not null").select("url", F.lit(False).alias("found"), F.lit(False).alias("rejected"), F.lit(0).alias("segments"), "error", F.lit(False).alias("seen"))
    status = scores.terminal_status(F.lit(False), F.col("found"), F.col("seen"), F.col("rejected"), F.col("segments"), F.col("error"))
    return quality.run_stats(new.unionByName(failed).select(status.alias("status")))


@query("SELECT CASE WHEN separation_model LIKE 'mel%' THEN 'fast_spectral' WHEN platform_known THEN 'cascade' WHEN long THEN 'spectral' ELSE 'none' END AS engine, count(*) AS n FROM (SELECT coalesce(separation_model, '') AS separation_model, item_id LIKE 'tt\\_%' ESCAPE '\\' AS platform_known, coalesce(duration_seconds > 10, false) AS long FROM metadata WHERE item_id IS NOT NULL) GROUP BY 1")
def separation_choice(spark: SparkSession, sf: str) -> DataFrame:
    mode = F.when(F.coalesce("separation_model", F.lit("")).startswith("mel"), F.lit("cloud")).otherwise(F.lit("local"))
    engine = scores.separation_engine(mode, F.col("item_id").startswith("tt_"), F.col("duration_seconds") > 10)
    return table(spark, sf, "metadata").where("item_id is not null").groupBy(engine.alias("engine")).agg(F.count("*").alias("n"))


@query(
    """WITH r AS (SELECT vec_id, CASE WHEN embedding[1] > 0.15 THEN '' ELSE 'nghe rõ' END AS t, round(-0.5 + embedding[2]::double, 3) AS lp, round(0.4 + embedding[3]::double, 3) AS ns FROM embeddings),
q AS (SELECT *, CASE WHEN t = '' OR ns > 0.60 THEN 'none' WHEN lp >= -0.45 AND ns < 0.35 THEN 'good' ELSE 'degraded' END AS q FROM r),
g AS (SELECT *, CASE WHEN q = 'good' THEN NULL WHEN t = '' THEN 'empty_transcript' WHEN ns > 0.50 THEN 'no_speech' WHEN lp < -0.5 THEN 'low_quality' END AS reason FROM q)
SELECT vec_id, q AS raw_quality, reason IS NULL AS passed, reason, 'pre_gate(quality=' || q || ',lp=' || printf('%.3f', lp) || ') > ' || CASE WHEN q = 'good' THEN 'separation_skipped' ELSE 'separation(spectral)' END || ' > denoise(' || CASE WHEN q = 'degraded' THEN 'full' ELSE 'light' END || ') > loudness > recognition(' || CASE WHEN q = 'good' THEN 'reused' WHEN reason IS NULL THEN 'pass' ELSE 'fail' END || ')' AS trace,
64 AS n, true AS level_ok FROM g"""
)
def mastering_trace(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors as short sounds through all stages; the level is the target's, or the peak its limit."""
    x = F.col("embedding")
    records = table(spark, sf, "embeddings").select("vec_id", signal.doubles(x).alias("samples"), F.lit(16000.0).alias("sample_rate"), F.when(x[0] > 0.15, F.lit("")).otherwise(F.lit("nghe rõ")).alias("transcript"), F.round(-0.5 + x[1].cast("double"), 3).alias("avg_logprob"), F.round(0.4 + x[2].cast("double"), 3).alias("no_speech_prob"))
    out = mastering.master(records)
    level, peak = spectral.loudness(F.col("mastered"), F.col("sample_rate")), F.array_max(F.transform("mastered", lambda v: F.abs(v)))
    fine = level.isNull() | (F.abs(level + 16) < 0.5) | (F.abs(peak - 10 ** (-1 / 20)) < 1e-6) | (level < -16)
    return out.select("vec_id", "raw_quality", "passed", "reason", F.array_join("stages_applied", " > ").alias("trace"), F.size("mastered").alias("n"), (fine & (peak <= 10 ** (-1 / 20) + 1e-6)).alias("level_ok"))


# --- reports --------------------------------------------------------------------------------------------------------

_CLEANED = f"""f AS (SELECT doc_id, text, {_words('text')} < 3 AS low, n_chars / 15.0::double AS d FROM documents), o AS (SELECT text, min(doc_id) AS first FROM f WHERE text IS NOT NULL AND NOT low GROUP BY text),
c AS (SELECT f.doc_id, f.d, o.first, CASE WHEN f.text IS NULL THEN 'unreadable' WHEN f.low THEN 'low_voice' WHEN o.first <> f.doc_id THEN 'duplicate' END AS reason FROM f LEFT JOIN o ON o.text = f.text)"""


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as files: texts as content, few words as little voice."""
    files = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("content"), (text.word_count(F.col("text")) < 3).alias("low"), (F.col("n_chars") / 15.0).alias("duration_seconds"))
    return quality.cleaned(files, "doc_id", "content", F.col("low"))


@query(f"WITH {_CLEANED} SELECT doc_id, reason, CASE WHEN reason = 'duplicate' THEN first ELSE -1 END AS original FROM c WHERE reason IS NOT NULL")
def qc_report(spark: SparkSession, sf: str) -> DataFrame:
    path = own_dir(spark, "report")
    quality.removed_rows(_cleaned(spark, sf), "doc_id").write.parquet(path)
    return spark.read.parquet(path).withColumn("original", F.coalesce("original", F.lit(-1)))


@query(
    f"""WITH {_CLEANED} SELECT 'documents' AS dataset_name, count(*) AS total_initial_files, count(*) FILTER (WHERE reason IS NULL) AS clean_files_delivered, round(coalesce(sum(CASE WHEN reason IS NULL THEN coalesce(d, 0) END), 0) / 3600, 2) AS total_hours, count(*) FILTER (WHERE reason = 'duplicate') AS quarantined_duplicates,
count(*) FILTER (WHERE reason = 'low_voice') AS quarantined_low_voice, printf('%.1f', floor(count(*) FILTER (WHERE reason IS NULL) / count(*) * 100 * 10 + 0.5::double) / 10) || '%' AS qc_passed_rate FROM c"""
)
def qc_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_summary(_cleaned(spark, sf), name="documents")


@query(
    f"""WITH i AS (SELECT url, bool_or(found) AS found, bool_or(sep) AS sep FROM (SELECT source_url AS url, true AS found, coalesce(lower(trim(separation_model, ' ')), 'none') NOT IN ('none', '') AS sep FROM metadata WHERE source_url IS NOT NULL UNION ALL SELECT url, false, false FROM error_log WHERE url IS NOT NULL) GROUP BY url),
o AS (SELECT item_id, min(record_no) AS first FROM metadata_incoming WHERE item_id IS NOT NULL GROUP BY 1), s AS (SELECT coalesce(o.first <> m.record_no, false) AS dup, coalesce({_nan('duration_seconds')}, 0.0) AS d FROM metadata_incoming m LEFT JOIN o ON o.item_id = m.item_id)
SELECT (SELECT count(*) FROM i WHERE found) AS crawled, (SELECT count(*) FROM i WHERE found AND sep) AS separated, count(*) AS sliced_segments, count(*) FILTER (WHERE dup) AS duplicates_removed, count(*) FILTER (WHERE NOT dup) AS gold_approved, round(sum(CASE WHEN NOT dup THEN d END), 2) AS total_seconds FROM s"""
)
def corpus_funnel(spark: SparkSession, sf: str) -> DataFrame:
    model = F.coalesce(F.lower(F.trim("separation_model")), F.lit("none"))
    landed = table(spark, sf, "metadata").where("source_url is not null").select(F.col("source_url").alias("url"), F.lit(True).alias("found"), (~model.isin("none", "")).alias("separated"))
    failed = table(spark, sf, "error_log").where("url is not null").select("url", F.lit(False).alias("found"), F.lit(False).alias("separated"))
    items = landed.unionByName(failed).groupBy("url").agg(F.bool_or("found").alias("found"), F.bool_or("separated").alias("separated"))
    segments = dedup.with_original(table(spark, sf, "metadata_incoming").select("item_id", "record_no", "duration_seconds"), "item_id", "record_no")
    return quality.corpus_funnel(items, segments)


_SOURCE_DAYS = f"""s AS (SELECT {_day('crawled_at')} AS day, 0 AS p, count(*) AS n, round(sum(coalesce({_nan('duration_seconds')}, 0.0)) / 3600, 2) AS h FROM metadata_extended WHERE crawled_at IS NOT NULL GROUP BY 1
UNION ALL SELECT {_day('processed_at')}, 1, count(*), round(sum(coalesce({_nan('duration_seconds')}, 0.0)) / 3600, 2) FROM metadata WHERE processed_at IS NOT NULL GROUP BY 1)"""


@query(
    f"""WITH {_SOURCE_DAYS}, d AS (SELECT {_week('cast(day AS date)')} AS week, n, h FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY p) AS rn FROM s) WHERE rn = 1)
SELECT coalesce(week, 0) AS week, cast(sum(n) AS bigint) AS files, round(sum(h), 2) AS hours FROM d GROUP BY ROLLUP (week)"""
)
def week_totals(spark: SparkSession, sf: str) -> DataFrame:
    """A day's figures come from the extended records, else from the others; week 0 is the sum of all."""

    def days(name: str, at: str) -> DataFrame:
        hours = F.round(F.sum(F.coalesce(_known("duration_seconds"), F.lit(0.0))) / 3600, 2)
        return table(spark, sf, name).where(F.col(at).isNotNull()).groupBy(F.date_format(base.day_of(at), "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("files"), hours.alias("hours"))

    best = reconcile.first_source([days("metadata_extended", "crawled_at"), days("metadata", "processed_at")], "day", ["files", "hours"])
    return quality.week_totals(best, dates.week_number(F.col("day").cast("date")))


@query("SELECT platform, count(*) AS items, printf('%.1f', floor(count(*) FILTER (WHERE music_prob >= 0.30 AND NOT isnan(music_prob)) / greatest(1, count(*)) * 100 * 10 + 0.5::double) / 10) || '%' AS separated_share FROM metadata_extended GROUP BY platform")
def separated_share(spark: SparkSession, sf: str) -> DataFrame:
    share = rounded(F.count_if(F.coalesce(_known("music_prob") >= 0.30, F.lit(False))) / F.greatest(F.lit(1), F.count("*")) * 100, 1)
    return table(spark, sf, "metadata_extended").groupBy("platform").agg(F.count("*").alias("items"), F.concat(F.format_string("%.1f", share), F.lit("%")).alias("separated_share"))


@query("SELECT doc_id, cast(generate_subscripts(w, 1) AS int) AS n, unnest(w) AS word FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '" + text.SPACES + "+'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL AND n_chars < 2000) WHERE len(w) > 0")
def numbered_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words with their numbers in texts that are said to be short."""
    words = F.filter(F.split("text", f"{text.SPACES}+"), lambda w: w != "")
    return table(spark, sf, "documents").where("text is not null and n_chars < 2000").select("doc_id", F.posexplode(words).alias("i", "word")).select("doc_id", (F.col("i") + 1).alias("n"), "word")


# --- state ----------------------------------------------------------------------------------------------------------


@query("SELECT url, strftime(min(failed_at), '%Y-%m-%d %H:%M:%S') AS first_failed FROM error_log WHERE url IS NOT NULL AND failed_at IS NOT NULL GROUP BY url")
def stream_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """The first failure of each address from a stream whose batches may come again."""
    schema = "url string, item_id string, platform string, error string, failed_at timestamp"
    stream = streams.read_stream(spark, sf, "error_log", schema, at="failed_at").where("failed_at is not null")
    return streams.keep_by_key(stream, "url", ["failed_at"], own_dir(spark, "stream")).select("url", F.date_format("failed_at", "yyyy-MM-dd HH:mm:ss").alias("first_failed"))


@query("SELECT DISTINCT audio_path AS path, 'small' AS model, 30.0::double AS max_seconds, md5(audio_path) AS transcript FROM metadata WHERE audio_path IS NOT NULL")
def transcript_cache(spark: SparkSession, sf: str) -> DataFrame:
    """Transcripts made in two turns, of which the second makes only what is missing."""
    held = cache.TranscriptCache(spark, own_dir(spark, "cache"))
    make = lambda keys: keys.withColumn("transcript", F.md5("path"))
    asked = [table(spark, sf, t).select(F.col("audio_path").alias("path"), F.lit("small").alias("model"), F.lit(30.0).alias("max_seconds")) for t in ("metadata_extended", "metadata")]
    held.get(asked[0], make)
    return held.get(asked[1], make)
