"""Registered queries of the core and the SQL they are compared with.

Each query stands beside its SQL. All of them run over whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from phonoloom.functions import classify, dates, ids, lexicons, scores, signal, text
from phonoloom.functions.numbers import rounded
from phonoloom.operators import dedup, reconcile, rollup, segment
from phonoloom.operators.gates import item_gates, low_voice
from phonoloom.plans import pipeline
from phonoloom.plans.cluster import table
from phonoloom.plans.registry import Registry
from phonoloom.sources import landing
from phonoloom.streaming import events as streams

REGISTRY = Registry()
query, queries, oracle_sql = REGISTRY.query, REGISTRY.queries, REGISTRY.oracle_sql


def day_of(column: str) -> Column:
    """The local day of a UTC timestamp."""
    return F.to_date(dates.local_time(F.col(column)))


def _local(column: str) -> str:
    return f"(make_timestamp(epoch_us({column})) + INTERVAL 7 HOUR)"


def _day(column: str) -> str:
    return f"strftime({_local(column)}, '%Y-%m-%d')"


def _week(day: str) -> str:
    return f"cast(CASE WHEN {day} < DATE '2026-08-24' THEN 1 ELSE 2 + floor(date_diff('day', DATE '2026-08-24', {day}) / 7.0) END AS int)"


def _nan(column: str) -> str:
    return f"(CASE WHEN isnan({column}) THEN NULL ELSE {column} END)"


# --- ids, addresses, dates, text ------------------------------------------------------------------------------------


@query(
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents WHERE text IS NOT NULL),
b AS (SELECT doc_id, line_no, regexp_replace(line, '^\\x{feff}', '') AS line FROM l)
SELECT doc_id, cast(line_no AS int) AS line_no, trim(line, ' ') AS url FROM b WHERE length(trim(line, ' ')) > 0 AND NOT starts_with(line, '#') AND NOT contains(line, '/photo/')"""
)
def manifest_filter(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "url"))
    return landing.manifest_rows(lines, "url")


_FB = [p for p, _ in ids.FACEBOOK_PATTERNS]


@query(
    f"""SELECT DISTINCT source_url,
CASE WHEN NOT contains(source_url, '/photo/') THEN 'tt_' || coalesce({', '.join(f"nullif(regexp_extract(source_url, '{p}', 1), '')" for p in ids.TIKTOK_PATTERNS)}) END AS tiktok_id,
'fb_' || coalesce({', '.join(f"nullif(regexp_extract(source_url, '{p}', 1), '')" for p in _FB)}) AS facebook_id,
CASE {' '.join(f"WHEN regexp_matches(source_url, '{p}') THEN '{k}'" for p, k in ids.FACEBOOK_PATTERNS)} ELSE 'video' END AS facebook_kind
FROM metadata WHERE source_url IS NOT NULL"""
)
def video_id_extract(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("source_url")
    urls = table(spark, sf, "metadata").where("source_url is not null").select("source_url").distinct()
    return urls.select("source_url", ids.tiktok_id(u).alias("tiktok_id"), ids.facebook_id(u).alias("facebook_id"), ids.facebook_kind(u).alias("facebook_kind"))


@query(
    """WITH u AS (SELECT DISTINCT url, regexp_replace(split_part(url, '?', 1), '/+$', '') AS p FROM error_log WHERE url IS NOT NULL)
SELECT url, 'tt_' || CASE WHEN regexp_matches(split_part(p, '/', -1), '^[0-9]+$') THEN split_part(p, '/', -1) ELSE substr(md5(url), 1, 16) END AS item_id FROM u"""
)
def address_ids(spark: SparkSession, sf: str) -> DataFrame:
    urls = table(spark, sf, "error_log").where("url is not null").select("url").distinct()
    return urls.select("url", ids.address_id(F.col("url")).alias("item_id"))


@query(
    r"""SELECT doc_id, cast(generate_subscripts(u, 1) - 1 AS int) AS n, unnest(u) AS url
FROM (SELECT doc_id, regexp_extract_all(text, '(?i)(https?://(?:[a-z]+\.)?(?:vidtok\.example|fbclips\.example)/[^\x{09}-\x{0d}\x{20}]+)', 1) AS u FROM documents WHERE text IS NOT NULL) WHERE len(u) > 0"""
)
def addresses_in_text(spark: SparkSession, sf: str) -> DataFrame:
    found = ids.addresses_in(F.col("text"), ("vidtok.example", "fbclips.example"))
    return table(spark, sf, "documents").where("text is not null").select("doc_id", F.posexplode(found).alias("n", "url"))


@query(
    r"""WITH t AS (SELECT doc_id, replace(text, '\/', '/') AS t, text FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, list_distinct(regexp_extract_all(t, '/@[A-Za-z0-9._%-]+/video/(\d{8,19})', 1)) AS a, list_distinct(regexp_extract_all(t, '/video/(\d{15,})', 1)) AS b, list_distinct(regexp_extract_all(t, '"id"\s*:\s*"(\d{15,})"', 1)) AS c,"""
    + " || ".join(f"""list_distinct(list_transform(regexp_extract_all(text, '{p}', 1), lambda v: 'https://www.fbclips.example/{'reel/' if k == 'reel' else 'watch?v='}' || v))""" for p, k in ids.FACEBOOK_PATTERNS)
    + """ AS f FROM t)
SELECT doc_id, array_to_string(list_sort(CASE WHEN len(a) > 0 THEN a WHEN len(b) > 0 THEN b ELSE c END), ' ') AS links, array_to_string(list_sort(list_distinct(f)), ' ') AS links_all FROM p"""
)
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf, "documents").where("text is not null").select("doc_id", F.array_join(F.array_sort(ids.page_links(t)), " ").alias("links"), F.array_join(F.array_sort(ids.page_links_all(t, 100000, "https://www.fbclips.example/reel/", "https://www.fbclips.example/watch?v=")), " ").alias("links_all"))


_BASE = r"CASE WHEN regexp_matches(item_id, '^(tt|fb)_\d{1,7}$') THEN item_id ELSE regexp_replace(item_id, '_\d{1,3}$', '') END"


@query(
    rf"""SELECT DISTINCT item_id, {_BASE} AS base_id, regexp_extract(item_id, '^(?:tt_|fb_)?([^_]*)', 1) AS raw_id,
CASE WHEN starts_with(item_id, 'tt_') THEN 'tiktok' WHEN starts_with(item_id, 'fb_') THEN 'facebook' ELSE 'unknown' END AS platform,
({_BASE}) || '_07' AS segment FROM metadata WHERE item_id IS NOT NULL"""
)
def item_id_parts(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("item_id")
    rows = table(spark, sf, "metadata").where("item_id is not null").select("item_id").distinct()
    return rows.select("item_id", ids.base_id(i).alias("base_id"), ids.raw_id(i).alias("raw_id"), ids.platform(i).alias("platform"), ids.segment_id(ids.base_id(i), F.lit(7), F.lit(9)).alias("segment"))


@query(
    f"""WITH d AS (SELECT cast({_local('processed_at')} AS date) AS d FROM metadata WHERE processed_at IS NOT NULL)
SELECT strftime(d, '%Y-%m-%d') AS day, {_week('d')} AS week, 'Week' || {_week('d')} || '/' || strftime(d, '%Y-%m-%d') || '/quarantine' AS folder, count(*) AS n FROM d GROUP BY d"""
)
def week_bucket(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "metadata").where("processed_at is not null").groupBy(day_of("processed_at").alias("d")).agg(F.count("*").alias("n"))
    return rows.select(F.date_format("d", "yyyy-MM-dd").alias("day"), dates.week_number(F.col("d")).alias("week"), dates.day_folder(F.col("d"), quarantine=True).alias("folder"), "n")


@query(
    f"""SELECT (CASE WHEN platform = 'tiktok' THEN 'tt' ELSE 'fb' END) || '_' || strftime({_local('crawled_at')}, '%Y%m%d') || '_' || lpad(cast(hour({_local('crawled_at')}) + 1 AS varchar), 2, '0') AS batch, count(*) AS n
FROM metadata_extended WHERE crawled_at IS NOT NULL AND platform IS NOT NULL GROUP BY 1"""
)
def batch_ids(spark: SparkSession, sf: str) -> DataFrame:
    at = dates.local_time(F.col("crawled_at"))
    rows = table(spark, sf, "metadata_extended").where("crawled_at is not null and platform is not null")
    return rows.groupBy(ids.batch_id(F.col("platform"), at, F.hour(at) + 1).alias("batch")).agg(F.count("*").alias("n"))


_STAMP = "CASE WHEN x >= 0 THEN (CASE WHEN ms // 3600000 < 100 THEN lpad(cast(ms // 3600000 AS varchar), 2, '0') ELSE cast(ms // 3600000 AS varchar) END) || ':' || lpad(cast((ms // 60000) % 60 AS varchar), 2, '0') || ':' || lpad(cast((ms // 1000) % 60 AS varchar), 2, '0') || ',' || lpad(cast(ms % 1000 AS varchar), 3, '0') END"


@query(f"SELECT event_id, {_STAMP} AS stamp FROM (SELECT event_id, value AS x, cast(floor(value * 1000) AS bigint) AS ms FROM events)")
def srt_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", dates.subtitle_time(F.col("value")).alias("stamp"))


@query(
    f"""WITH s AS (SELECT DISTINCT item_id, duration_seconds AS x, trim(transcript_raw, ' ') AS t FROM metadata_extended WHERE item_id IS NOT NULL AND transcript_raw IS NOT NULL AND duration_seconds >= 0 AND NOT isnan(duration_seconds)),
m AS (SELECT *, cast(floor(x * 1000) AS bigint) AS ms FROM s)
SELECT item_id, md5('1' || chr(10) || '00:00:00,000 --> ' || ({_STAMP}) || chr(10) || t || chr(10)) AS subtitle_md5 FROM m"""
)
def subtitle_files(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "metadata_extended").where("item_id is not null and transcript_raw is not null and duration_seconds >= 0 and not isnan(duration_seconds)").select("item_id", "duration_seconds", "transcript_raw").distinct()
    one = F.array(F.struct(F.lit(1).alias("id"), F.lit(0.0).alias("start"), F.col("duration_seconds").alias("end"), F.col("transcript_raw").alias("text")))
    return rows.select("item_id", F.md5(dates.subtitles(one)).alias("subtitle_md5")).distinct()


def _words(column: str) -> str:
    return f"coalesce(len(list_filter(regexp_split_to_array({column}, '{text.SPACES}+'), lambda w: w <> '')), 0)"


@query(f"SELECT doc_id, cast({_words('text')} AS int) AS words FROM documents")
def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.word_count(F.col("text")).alias("words"))


@query("SELECT doc_id, md5(nfc_normalize(text)) AS composed_md5 FROM documents WHERE text IS NOT NULL")
def composed_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where("text is not null").select("doc_id", F.md5(text.composed("text")).alias("composed_md5"))


@query(
    """SELECT item_id, coalesce(nullif(title, ''), nullif(description, ''), nullif(uploader, ''), '') AS heading, lower(trim(coalesce(title, ''), ' ')) IN ('original sound', 'am thanh goc', 'tieng dong goc', '') AS music_is_original,
contains(lower(coalesce(description, '')), 'duet') AS is_duet, contains(lower(coalesce(description, '')), 'stitch') AS is_stitch, coalesce(platform_meta.has_platform_captions, false) AS has_captions
FROM metadata_extended WHERE item_id IS NOT NULL"""
)
def platform_meta(spark: SparkSession, sf: str) -> DataFrame:
    about = F.lower(F.coalesce("description", F.lit("")))
    return (
        table(spark, sf, "metadata_extended")
        .where("item_id is not null")
        .select(
            "item_id",
            text.first_filled(F.col("title"), F.col("description"), F.col("uploader")).alias("heading"),
            scores.own_sound(F.col("title")).alias("music_is_original"),
            F.contains(about, F.lit("duet")).alias("is_duet"),
            F.contains(about, F.lit("stitch")).alias("is_stitch"),
            F.coalesce("platform_meta.has_platform_captions", F.lit(False)).alias("has_captions"),
        )
    )


# --- lexicons and classifiers ---------------------------------------------------------------------------------------


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _score(phrases: list[tuple[str, float]]) -> str:
    known = ", ".join(f"{{'k': {_quoted(' ' + p.replace(' ', '  ') + ' ')}, 'w': {w}::double}}" for p, w in phrases)
    return f"coalesce(list_sum(list_transform([{known}], lambda p: p.w * least(2, (length(t) - length(replace(t, p.k, ''))) // length(p.k)))), 0)::double"


def _present(column: str, phrases: list[str], word: bool) -> str:
    known = ", ".join(_quoted(f" {p.replace(' ', '   ')} " if word else p) for p in phrases)
    return f"coalesce(len(list_filter([{known}], lambda p: contains({column}, p))), 0)"


_PADDED = f"""' ' || regexp_replace(regexp_replace(replace(lower(c), ' ', '  '), '({text.OTHER_SPACES})', ' ' || chr(10) || ' ', 'g'), '([.,!?;:"])', ' \\1', 'g') || ' '"""
_SCORED = f"""r AS (SELECT DISTINCT item_id, transcript_raw AS tr, coalesce(nullif(title, ''), nullif(description, ''), '') AS ti FROM metadata_extended WHERE item_id IS NOT NULL),
c AS (SELECT item_id, tr, concat_ws(' ', ti, tr, ti) AS c FROM r),
p AS (SELECT item_id, tr, {_PADDED} AS t FROM c),
s AS (SELECT item_id, tr, {', '.join(f'{_score(v)} AS {k}' for k, v in lexicons.CONTENT.items())} FROM p)"""


def _scored(spark: SparkSession, sf: str) -> tuple[DataFrame, dict[str, Column]]:
    rows = table(spark, sf, "metadata_extended").where("item_id is not null").select("item_id", "transcript_raw", text.first_filled(F.col("title"), F.col("description")).alias("heading")).distinct()
    return rows.withColumn("_t", classify.content_text(F.col("transcript_raw"), F.col("heading"))), classify.content_scores(F.col("_t"))


@query(f"WITH {_SCORED} SELECT item_id, {', '.join(lexicons.CONTENT)} FROM s")
def lexicon_scores(spark: SparkSession, sf: str) -> DataFrame:
    rows, scores = _scored(spark, sf)
    return rows.select("item_id", *[c.alias(k) for k, c in scores.items()])


@query(
    f"""WITH {_SCORED}, b AS (SELECT *, greatest(news, law, edu) AS best, {_words('tr')} AS words FROM s),
k AS (SELECT *, CASE WHEN words < 3 THEN 1 WHEN gambling >= 3.5 THEN 2 WHEN ads >= 3.5 THEN 3 WHEN junk >= 3.5 THEN 4 WHEN best >= 2.0 THEN 5 ELSE 6 END AS step FROM b)
SELECT item_id, CASE step WHEN 1 THEN 'TRANSCRIPT_QUA_NGAN' WHEN 2 THEN 'SPAM_CO_BAC_DOC_HAI' WHEN 3 THEN 'QUANG_CAO_TIEP_THI' WHEN 4 THEN 'NHAC_TREND_VO_NGHIA' WHEN 5 THEN CASE best WHEN news THEN 'TIN_TUC_THOI_SU' WHEN law THEN 'PHAP_LUAT' ELSE 'HOC_ONLINE_GIAO_DUC' END ELSE 'HOI_THOAI_DOI_SONG' END AS category,
round(CASE step WHEN 1 THEN 1.0::double WHEN 2 THEN 0.95::double WHEN 3 THEN least(1.0::double, ads / (3.5::double * 1.5::double)) WHEN 4 THEN least(1.0::double, junk / (3.5::double * 1.5::double)) WHEN 5 THEN least(1.0::double, 0.7::double + best * 0.1::double) ELSE 0.85::double END, 4) AS confidence,
CASE WHEN step <= 4 THEN 'REJECT' ELSE 'ACCEPT' END AS action FROM k"""
)
def content_classify(spark: SparkSession, sf: str) -> DataFrame:
    rows, scores = _scored(spark, sf)
    held = rows.select("item_id", "transcript_raw", *[c.alias(k) for k, c in scores.items()])
    return held.select("item_id", classify.content_class(F.col("transcript_raw"), {k: F.col(k) for k in scores}).alias("c")).select("item_id", "c.category", "c.confidence", "c.action")


def _region(column: str, region: str) -> str:
    worded = f"w_{column}"
    return f"({_present(worded, lexicons.DIALECT[region], True)} * 6.0::double + {_present(f'l_{column}', lexicons.PLACES[region], False)} * 1.0::double)"


_CHANNEL = "CASE " + " ".join(f"WHEN contains(ch, '{m}') OR starts_with(ch, '{m.lstrip('@')}') THEN '{r}'" for m, r in lexicons.CHANNELS) + " END"


def _worded(column: str) -> str:
    return f"' ' || regexp_replace(lower({column}), '{text.NOT_WORD}', ' \\1 ', 'g') || ' '"



@query(
    f"""WITH r AS (SELECT DISTINCT item_id, concat_ws(' ', title, description) AS a, coalesce(transcript_raw, '') AS b, lower(trim(coalesce(uploader, ''), ' ')) AS ch FROM metadata_extended WHERE item_id IS NOT NULL),
n AS (SELECT item_id, {_worded('a')} AS w_a, lower(a) AS l_a, {_worded('b')} AS w_b, lower(b) AS l_b, {_CHANNEL} AS known FROM r),
s AS (SELECT item_id, {', '.join(f"coalesce(CASE WHEN known = '{x}' THEN 3.0::double END, 0.0::double) + {_region('a', x)} + 3.0::double * {_region('b', x)} AS {x}" for x in lexicons.REGIONS)} FROM n),
t AS (SELECT *, greatest(northern, southern, central) AS top, northern + southern + central - greatest(northern, southern, central) - least(northern, southern, central) AS second FROM s)
SELECT item_id, northern, southern, central, CASE WHEN top = 0 THEN 'mixed' WHEN second >= 4.0 AND second / top >= 0.45::double THEN 'mixed' WHEN northern = top THEN 'northern' WHEN southern = top THEN 'southern' ELSE 'central' END AS region FROM t"""
)
def region_classify(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "metadata_extended").where("item_id is not null").select("item_id", F.concat_ws(" ", "title", "description").alias("a"), F.coalesce("transcript_raw", F.lit("")).alias("b"), F.coalesce("uploader", F.lit("")).alias("ch")).distinct()
    rows = rows.withColumns({x: f(F.col(c)) for c in "ab" for x, f in ((f"w_{c}", text.worded), (f"l_{c}", F.lower))})
    a, b = (classify.text_region_scores(F.col(f"w_{c}"), F.col(f"l_{c}")) for c in "ab")
    known = classify.channel_region(F.col("ch"))
    held = rows.select("item_id", *[(F.coalesce(F.when(known == r, F.lit(3.0)), F.lit(0.0)) + a[r] + b[r] * 3.0).alias(r) for r in lexicons.REGIONS])
    return held.withColumn("region", classify.region_class({r: F.col(r) for r in lexicons.REGIONS}))


@query(
    f"""WITH r AS (SELECT DISTINCT item_id, coalesce(transcript_raw, '') AS b FROM metadata_extended WHERE item_id IS NOT NULL), n AS (SELECT item_id, {_worded('b')} AS w FROM r),
h AS (SELECT item_id, {', '.join(f"{_present('w', v, True)} AS {k}" for k, v in lexicons.VOCABULARY.items())} FROM n)
SELECT item_id, CASE WHEN (central >= 1 AND south >= 1) OR (central >= 1 AND north >= 1) OR (south >= 2 AND north >= 2) THEN 'Mixed' WHEN central >= 1 THEN 'Central' WHEN south >= 1 THEN 'South' ELSE 'North' END AS dialect FROM h"""
)
def dialect_classify(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "metadata_extended").where("item_id is not null").select("item_id", F.coalesce("transcript_raw", F.lit("")).alias("b")).distinct()
    rows = rows.withColumn("w", text.worded(F.col("b")))
    hits = classify.dialect_hits(F.col("w"))
    held = rows.select("item_id", *[c.alias(k) for k, c in hits.items()])
    return held.select("item_id", classify.dialect_class({k: F.col(k) for k in hits}, F.lit(0.0), F.lit(0.0), F.lit(False)).alias("dialect"))


@query(
    """SELECT CASE WHEN music_prob >= 0.70 THEN 'quarantine' WHEN music_prob >= 0.30 THEN 'music' ELSE 'clean' END AS music, CASE WHEN synthetic_prob > 0.70 THEN 'rejected' WHEN synthetic_prob > 0.30 THEN 'flagged' ELSE 'real' END AS synthetic, count(*) AS n
FROM (SELECT CASE WHEN isnan(music_prob) THEN NULL ELSE music_prob END AS music_prob, CASE WHEN isnan(synthetic_prob) THEN NULL ELSE synthetic_prob END AS synthetic_prob FROM metadata_extended) GROUP BY 1, 2"""
)
def music_and_synthetic(spark: SparkSession, sf: str) -> DataFrame:
    m, s = F.nanvl("music_prob", F.lit(None)), F.nanvl("synthetic_prob", F.lit(None))
    return table(spark, sf, "metadata_extended").groupBy(classify.music_status(m).alias("music"), classify.synthetic_status(s).alias("synthetic")).agg(F.count("*").alias("n"))


@query(
    """WITH e AS (SELECT item_id, transcript_raw AS t, -1 + coalesce(CASE WHEN isnan(quality_score) THEN NULL ELSE quality_score END, 0) AS lp, 1 - coalesce(CASE WHEN isnan(speech_ratio) THEN NULL ELSE speech_ratio END, 0) AS ns FROM metadata_extended WHERE item_id IS NOT NULL)
SELECT item_id, CASE WHEN length(trim(coalesce(t, ''), ' ')) = 0 OR ns > 0.60::double THEN 'none' WHEN lp >= -0.45::double AND ns < 0.35::double THEN 'good' ELSE 'degraded' END AS gate FROM e"""
)
def transcript_gate(spark: SparkSession, sf: str) -> DataFrame:
    lp = -1 + F.coalesce(F.nanvl("quality_score", F.lit(None)), F.lit(0.0))
    ns = 1 - F.coalesce(F.nanvl("speech_ratio", F.lit(None)), F.lit(0.0))
    return table(spark, sf, "metadata_extended").where("item_id is not null").select("item_id", classify.speech_pre_gate(F.col("transcript_raw"), lp, ns).alias("gate"))


@query(
    f"""WITH e AS (SELECT DISTINCT item_id, {_nan('snr_db')} AS snr, {_nan('duration_seconds')} AS d, {_nan('music_prob')} AS m, {_nan('synthetic_prob')} AS s, {_nan('speech_ratio')} AS sr, {_words('transcript_raw')} AS w, content_decision AS cd FROM metadata_extended WHERE item_id IS NOT NULL),
g AS (SELECT CASE WHEN d < 5.0 THEN 'too_short' WHEN d > 7200.0 THEN 'too_long' WHEN m >= 0.70 THEN 'music_quarantine' WHEN s > 0.70 THEN 'synthetic' WHEN (snr < 12.0 OR sr < 0.25) AND snr < 10.0 THEN 'low_quality' WHEN m >= 0.30 THEN 'residual_music' WHEN w < 3 THEN 'no_speech' WHEN cd = 'REJECT' THEN 'content' END AS reason FROM e)
SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n FROM g GROUP BY 1"""
)
def gate_reasons(spark: SparkSession, sf: str) -> DataFrame:
    used = ["snr_db", "duration_seconds", "music_prob", "synthetic_prob", "speech_ratio"]
    rows = table(spark, sf, "metadata_extended").where("item_id is not null").select("item_id", *[F.nanvl(c, F.lit(None)).alias(c) for c in used], "transcript_raw", "content_decision").distinct()
    return rows.groupBy(F.coalesce(item_gates(), F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


# --- duplicates and seen sets ---------------------------------------------------------------------------------------


@query("SELECT min(doc_id) AS doc_id, md5(text) AS text_md5 FROM documents WHERE text IS NOT NULL GROUP BY text")
def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").where("text is not null").select(F.md5("text").alias("text_md5"), "doc_id")
    return dedup.keep_first(rows, ["text_md5"], ["doc_id"])


@query("SELECT doc_id, CASE WHEN text IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY text) END AS original, text IS NOT NULL AND doc_id <> min(doc_id) OVER (PARTITION BY text) AS is_duplicate FROM documents")
def dup_of_original(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return dedup.with_original(rows, "h", "doc_id").select("doc_id", "original", "is_duplicate")


@query("SELECT count(*) AS rows, cast(count(*) FILTER (WHERE dup) AS bigint) AS duplicates, round(count(*) FILTER (WHERE dup) / greatest(1, count(*)) * 100, 2) AS duplicate_percent FROM (SELECT text IS NOT NULL AND row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS dup FROM documents)")
def duplicate_rate(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.duplicate_rate(dup_of_original(spark, sf), F.col("is_duplicate"))


_RAW = "regexp_extract(item_id, '^(?:tt_|fb_)?([^_]*)', 1)"
_PRE = "regexp_extract(item_id, '^(tt_|fb_)', 1)"


def _seen(source: str) -> str:
    return f"""SELECT DISTINCT unnest([item_id, {_BASE}, CASE WHEN regexp_matches({_RAW}, '^[0-9]+$') THEN {_PRE} || {_RAW} END]) AS key FROM {source} WHERE item_id IS NOT NULL"""


@query(f"SELECT key FROM ({_seen('metadata')}) WHERE key IS NOT NULL")
def seen_key_expand(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.remember(spark.createDataFrame([], "key string"), table(spark, sf, "metadata"))


def _unseen(source: str, columns: str) -> str:
    asked = f"unnest([item_id, {_BASE}, CASE WHEN {_PRE} <> '' AND regexp_matches({_RAW}, '^[0-9]+$') THEN {_PRE} || {_RAW} END, CASE WHEN regexp_matches(item_id, '^[0-9]+$') THEN 'tt_' || item_id END, CASE WHEN regexp_matches(item_id, '^[0-9]+$') THEN 'fb_' || item_id END])"
    return f"""SELECT {columns} FROM {source} WHERE item_id IS NULL OR item_id NOT IN (SELECT item_id FROM (SELECT item_id, {asked} AS key FROM {source} WHERE item_id IS NOT NULL) WHERE key IN (SELECT key FROM seen WHERE key IS NOT NULL))"""


@query(f"WITH seen AS ({_seen('metadata')}) {_unseen('metadata_incoming', 'record_no')}")
def seen_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.unseen(table(spark, sf, "metadata_incoming"), seen_key_expand(spark, sf)).select("record_no")


@query(
    f"""WITH seen AS ({_seen('metadata')}), failed AS (SELECT * FROM error_log WHERE platform = 'tiktok' AND (url IS NULL OR url NOT IN (SELECT source_url FROM metadata WHERE source_url IS NOT NULL)))
SELECT url, item_id, error, cast(count(*) AS bigint) AS n FROM ({_unseen('failed', 'url, item_id, error')}) GROUP BY ALL"""
)
def retry_candidates(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "metadata").select(F.col("source_url").alias("url")).distinct()
    rows = dedup.retry_candidates(table(spark, sf, "error_log"), done, seen_key_expand(spark, sf), "tiktok")
    return rows.groupBy("url", "item_id", "error").agg(F.count("*").alias("n"))


@query(
    f"""SELECT platform, NOT coalesce(regexp_matches(lower(error), '{'|'.join(classify.UNRECOVERABLE)}'), false) AS retryable, count(*) AS n, count(DISTINCT url) AS urls FROM error_log GROUP BY 1, 2"""
)
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "error_log").groupBy("platform", classify.retryable(F.col("error")).alias("retryable")).agg(F.count("*").alias("n"), F.countDistinct("url").alias("urls"))


@query(
    """WITH log AS (SELECT url, 'failed' AS status, error, epoch_us(failed_at) AS ts FROM error_log WHERE url IS NOT NULL UNION ALL SELECT source_url, 'done', NULL, epoch_us(processed_at) FROM metadata WHERE source_url IS NOT NULL)
SELECT status, count(*) AS n FROM (SELECT url, CASE WHEN bool_or(status = 'done') THEN 'done' ELSE 'failed' END AS status FROM log GROUP BY url) GROUP BY status"""
)
def checkpoint_state(spark: SparkSession, sf: str) -> DataFrame:
    failed = table(spark, sf, "error_log").where("url is not null").select("url", F.lit("failed").alias("status"), "error", F.col("failed_at").alias("ts"))
    done = table(spark, sf, "metadata").where("source_url is not null").select(F.col("source_url").alias("url"), F.lit("done").alias("status"), F.lit(None).cast("string").alias("error"), F.col("processed_at").alias("ts"))
    return dedup.latest_status(failed.unionByName(done)).groupBy("status").agg(F.count("*").alias("n"))


# --- joins of sources -----------------------------------------------------------------------------------------------


@query(
    """SELECT status, count(*) AS n FROM (SELECT CASE WHEN a.item_id IS NULL THEN 'extended_only' WHEN b.item_id IS NULL THEN 'metadata_only' ELSE 'matched' END AS status
FROM (SELECT DISTINCT item_id FROM metadata WHERE item_id IS NOT NULL) a FULL OUTER JOIN (SELECT DISTINCT item_id FROM metadata_extended WHERE item_id IS NOT NULL) b ON a.item_id = b.item_id) GROUP BY status"""
)
def reconcile_outer(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.match_status(table(spark, sf, "metadata"), table(spark, sf, "metadata_extended"), "item_id", ("metadata_only", "extended_only")).groupBy("status").agg(F.count("*").alias("n"))


_SIZE = "cast(44 + floor(coalesce(CASE WHEN isnan(duration_seconds) OR duration_seconds < 0 THEN NULL ELSE duration_seconds END, 0) * 32000) AS bigint)"


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    """The accepted segments as files: their paths, and sizes of their durations."""
    d = F.nanvl("duration_seconds", F.lit(None))
    size = (44 + F.floor(F.coalesce(F.when(d >= 0, d), F.lit(0.0)) * 32000)).cast("bigint")
    return table(spark, sf, "metadata").where("item_id is not null and audio_path is not null").select(F.col("audio_path").alias("path"), size.alias("length"), "item_id")


@query(
    f"""WITH l AS (SELECT DISTINCT item_id, {_SIZE} AS length FROM metadata WHERE item_id IS NOT NULL AND audio_path IS NOT NULL)
SELECT item_id, CASE WHEN starts_with(item_id, 'tt_') THEN 'tiktok' WHEN starts_with(item_id, 'fb_') THEN 'facebook' ELSE 'unknown' END AS platform, regexp_extract(item_id, '_(.*)', 1) AS platform_video_id, round(length / 32000, 3) AS duration_seconds, 'mixed' AS language_region
FROM l WHERE item_id NOT IN (SELECT item_id FROM metadata_extended WHERE item_id IS NOT NULL)"""
)
def fill_missing(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.fill_missing(_listing(spark, sf).select("item_id", "length").distinct(), table(spark, sf, "metadata_extended"), "2026-10-01 00:00:00").drop("crawled_at")


@query(
    f"""WITH l AS (SELECT replace(audio_path, 'gold/', 'audio/') AS path, {_SIZE} AS length FROM metadata WHERE item_id IS NOT NULL AND audio_path IS NOT NULL),
m AS (SELECT audio_path AS path, max({{'item_id': item_id, 'd': duration_seconds}}) AS r FROM metadata_extended WHERE audio_path IS NOT NULL AND item_id IS NOT NULL GROUP BY 1),
f AS (SELECT l.path, l.length, coalesce(m.r.item_id, regexp_extract(l.path, '([^/]+?)(?:\\.[^.]*)?$', 1)) AS item_id, m.r.d AS d, m.r IS NOT NULL AS known FROM l LEFT JOIN m ON l.path = m.path WHERE l.length >= 1000),
g AS (SELECT item_id, length, CASE WHEN d IS NULL OR isnan(d) OR d <= 0 OR d > 60 THEN floor(greatest(3.0::double, floor((length - 44) / 32000 * 100 + 0.5::double) / 100) * 100 + 0.5::double) / 100 ELSE floor(d * 100 + 0.5::double) / 100 END AS duration_seconds, d IS NULL OR isnan(d) OR d <= 0 OR d > 60 AS imputed, known FROM f)
SELECT known, imputed, count(*) AS files, round(sum(duration_seconds), 2) AS seconds FROM (SELECT DISTINCT * FROM g) GROUP BY 1, 2"""
)
def listing_left_join(spark: SparkSession, sf: str) -> DataFrame:
    files = _listing(spark, sf).withColumn("path", F.replace("path", F.lit("gold/"), F.lit("audio/")))
    rows = reconcile.audit_listing(files, table(spark, sf, "metadata_extended").where("item_id is not null"))
    return rows.groupBy("known", "imputed").agg(F.count("*").alias("files"), F.round(F.sum("duration_seconds"), 2).alias("seconds"))


@query(
    rf"""WITH r AS (SELECT item_id, min(language_region) AS v FROM metadata_extended WHERE item_id IS NOT NULL GROUP BY 1), m AS (SELECT DISTINCT item_id, {_BASE} AS b FROM metadata WHERE item_id IS NOT NULL)
SELECT CASE WHEN x.v IS NOT NULL THEN 'id' WHEN y.v IS NOT NULL THEN 'base' ELSE 'none' END AS found_by, coalesce(x.v, y.v) AS language_region, count(*) AS n FROM m LEFT JOIN r x ON x.item_id = m.item_id LEFT JOIN r y ON y.item_id = m.b GROUP BY 1, 2"""
)
def fallback_key_join(spark: SparkSession, sf: str) -> DataFrame:
    left = table(spark, sf, "metadata").where("item_id is not null").select("item_id").distinct()
    return reconcile.join_by_id_or_base(left, table(spark, sf, "metadata_extended"), "language_region").groupBy("found_by", "language_region").agg(F.count("*").alias("n"))


@query(
    f"""WITH s AS (SELECT {_day('failed_at')} AS day, 0 AS p, count(*) AS n FROM error_log WHERE failed_at IS NOT NULL GROUP BY 1 UNION ALL SELECT {_day('crawled_at')}, 1, count(*) FROM metadata_extended WHERE crawled_at IS NOT NULL GROUP BY 1
UNION ALL SELECT {_day('processed_at')}, 2, count(*) FROM metadata WHERE processed_at IS NOT NULL GROUP BY 1)
SELECT day, p AS source_no, n FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY p) AS rn FROM s) WHERE rn = 1"""
)
def priority_source(spark: SparkSession, sf: str) -> DataFrame:
    def days(name: str, at: str) -> DataFrame:
        return table(spark, sf, name).where(F.col(at).isNotNull()).groupBy(F.date_format(day_of(at), "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))

    return reconcile.first_source([days("error_log", "failed_at"), days("metadata_extended", "crawled_at"), days("metadata", "processed_at")], "day", ["n"])


@query(
    """WITH t AS (SELECT user_id, epoch_us(ts) / 1000000.0::double AS s, epoch_us(ts) / 1000000.0::double + value * 60.0::double AS e, event_type FROM events WHERE value > 0)
SELECT a.user_id, round(a.s, 3) AS l_start, round(b.s, 3) AS r_start, count(*) AS n FROM t a JOIN t b ON a.user_id = b.user_id AND a.event_type = 'view' AND b.event_type = 'purchase' AND a.s < b.e AND b.s < a.e GROUP BY ALL"""
)
def interval_overlap(spark: SparkSession, sf: str) -> DataFrame:
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0
    rows = table(spark, sf, "events").where("value > 0").select("user_id", "event_type", at.alias("start"), (at + F.col("value") * 60.0).alias("end"))
    both = reconcile.overlapping(rows.where("event_type = 'view'"), rows.where("event_type = 'purchase'"), "user_id", 3600.0)
    return both.groupBy("user_id", F.round("l_start", 3).alias("l_start"), F.round("r_start", 3).alias("r_start")).agg(F.count("*").alias("n"))


@query(
    """WITH p AS (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'click' GROUP BY 1, 2), e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT e.event_id, coalesce(p.event_id, -1) AS last_click FROM e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts >= p.ts"""
)
def as_of_join(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    clicks = events.where("event_type = 'click'").groupBy("user_id", "ts").agg(F.max("event_id").alias("last_click"))
    return reconcile.as_of(events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), clicks, "user_id", "ts", "last_click").select("event_id", F.coalesce("last_click", F.lit(-1)).alias("last_click"))


# --- rollups --------------------------------------------------------------------------------------------------------

_DAYS = f"""days AS (SELECT coalesce(a.day, b.day) AS day, coalesce(items, 0) AS items, coalesce(unique_items, 0) AS unique_items, coalesce(total_hours, 0.0) AS total_hours, coalesce(errors, 0) AS errors
FROM (SELECT {_day('processed_at')} AS day, count(*) AS items, count(DISTINCT item_id) AS unique_items, round(sum(coalesce({_nan('duration_seconds')}, 0.0)) / 3600, 2) AS total_hours FROM metadata WHERE processed_at IS NOT NULL GROUP BY 1) a
FULL OUTER JOIN (SELECT {_day('failed_at')} AS day, count(*) AS errors FROM error_log WHERE failed_at IS NOT NULL GROUP BY 1) b ON a.day = b.day)"""


@query(f"WITH {_DAYS} SELECT day, items, unique_items, total_hours, errors FROM days")
def day_summary(spark: SparkSession, sf: str) -> DataFrame:
    def text_day(at: str) -> Column:
        return F.date_format(day_of(at), "yyyy-MM-dd")

    return rollup.day_summary(table(spark, sf, "metadata").where("processed_at is not null"), text_day("processed_at"), table(spark, sf, "error_log").where("failed_at is not null"), text_day("failed_at"))


@query(f"WITH {_DAYS} SELECT day, items, unique_items, total_hours, errors, items + errors AS attempted, printf('%.1f', CASE WHEN items + errors > 0 THEN round(items / (items + errors) * 100, 1) ELSE 0.0 END) || '%' AS yield_rate FROM days")
def yield_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.yield_funnel(day_summary(spark, sf))


@query(
    f"""WITH {_DAYS}, w AS (SELECT {_week('cast(day AS date)')} AS week, items, total_hours FROM days)
SELECT coalesce(week, 0) AS week, count(*) AS days, cast(sum(items) AS bigint) AS files, round(sum(total_hours), 2) AS hours FROM w GROUP BY ROLLUP (week)"""
)
def week_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Week 0 is the sum of all."""
    return rollup.week_rollup(day_summary(spark, sf)).withColumn("week", F.coalesce("week", F.lit(0)))


@query(
    f"""WITH f AS (SELECT min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY text),
r AS (SELECT d.source, d.source IS NOT NULL AS a, f.doc_id IS NOT NULL AS b, {_words('d.text')} >= 3 AS c, coalesce(d.lang IN ('vi', 'en'), false) AS e FROM documents d LEFT JOIN f ON f.doc_id = d.doc_id)
SELECT source, count(*) AS total, cast(count(*) FILTER (WHERE a) AS bigint) AS with_source, cast(count(*) FILTER (WHERE a AND b) AS bigint) AS first_of_text, cast(count(*) FILTER (WHERE a AND b AND c) AS bigint) AS enough_words, cast(count(*) FILTER (WHERE a AND b AND c AND e) AS bigint) AS known_language FROM r GROUP BY source"""
)
def stage_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.text_funnel(table(spark, sf, "documents"))


@query(
    """SELECT platform, count(*) AS items, cast(count(*) FILTER (WHERE language_region = 'northern') AS bigint) AS northern, cast(count(*) FILTER (WHERE language_region = 'southern') AS bigint) AS southern,
cast(count(*) FILTER (WHERE language_region = 'central') AS bigint) AS central, cast(count(*) FILTER (WHERE language_region = 'mixed') AS bigint) AS mixed, cast(count(*) FILTER (WHERE language_region IS NULL OR language_region NOT IN ('northern', 'southern', 'central', 'mixed')) AS bigint) AS other FROM metadata_extended GROUP BY platform"""
)
def region_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.distribution(table(spark, sf, "metadata_extended"), "platform", "language_region", ["northern", "southern", "central", "mixed"])


@query(
    f"""WITH d AS (SELECT {_nan('duration_seconds')} AS d FROM metadata)
SELECT count(*) AS files, cast(count(*) FILTER (WHERE d IS NULL) AS bigint) AS corrupt, round(coalesce(sum(d), 0.0) / 3600, 3) AS hours, min(d) AS shortest, max(d) AS longest, round(avg(d), 3) AS mean, cast(count(*) FILTER (WHERE d BETWEEN 4.5 AND 35.0) AS bigint) AS fit,
CASE WHEN count(*) > 0 THEN round(count(*) FILTER (WHERE d BETWEEN 4.5 AND 35.0) / count(*) * 100, 2) ELSE 0.0 END AS fit_percent FROM d"""
)
def audit_stats(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.audit(table(spark, sf, "metadata"))


@query("SELECT doc_id, greatest(3.0::double, floor((coalesce(n_chars, 0) * 100 - 44) / 32000 * 100 + 0.5::double) / 100) AS seconds FROM documents")
def size_duration(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", reconcile.seconds_of_size(F.coalesce("n_chars", F.lit(0)) * 100).alias("seconds"))


@query(
    """SELECT uploader, item_id, duration_seconds FROM (SELECT *, row_number() OVER (PARTITION BY uploader ORDER BY duration_seconds DESC, item_id) AS rn FROM (SELECT DISTINCT uploader, item_id, duration_seconds FROM metadata WHERE uploader IS NOT NULL AND item_id IS NOT NULL AND duration_seconds IS NOT NULL AND NOT isnan(duration_seconds))) WHERE rn <= 3"""
)
def longest_of_uploader(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "metadata").where("uploader is not null and item_id is not null and duration_seconds is not null and not isnan(duration_seconds)").select("uploader", "item_id", "duration_seconds").distinct()
    return dedup.largest(rows, ["uploader"], [F.col("duration_seconds").desc(), F.col("item_id")], 3)


# --- signals (embeddings stand for sample arrays: windows of 8, every 4) --------------------------------------------

_X = "x AS (SELECT vec_id, list_transform(embedding, lambda v: v::double) AS x FROM embeddings)"
_E = f"{_X}, e AS (SELECT vec_id, x, list_transform(range(0, len(x) - 8, 4), lambda i: list_sum(list_transform(x[i + 1:i + 8], lambda v: v * v)) / 8) AS e FROM x)"
_N = f"""{_E}, n AS (SELECT *, list_sort(e) AS s, len(e) AS n FROM e), k AS (SELECT *, list_sum(s[1:greatest(1, cast(floor(n * 0.15) AS int))]) / greatest(1, cast(floor(n * 0.15) AS int)) AS noise, list_sum(s[cast(floor(n * 0.6) AS int) + 1:n]) / (n - cast(floor(n * 0.6) AS int)) AS speech FROM n),
q AS (SELECT *, CASE WHEN noise <= 1e-9 THEN 35.0::double WHEN speech <= noise THEN 0.0::double ELSE round(10 * log10(speech / noise), 2) END AS snr, round(len(list_filter(e, lambda v: v >= greatest(noise * 3.5::double, 1e-4::double))) / n, 3) AS ratio, round(20 * log10(greatest(list_max(list_transform(x, lambda v: abs(v))), 1e-5::double)), 2) AS peak_db FROM k)"""


def _samples(spark: SparkSession, sf: str) -> DataFrame:
    x = signal.doubles(F.col("embedding"))
    return table(spark, sf, "embeddings").where("embedding is not null").select("vec_id", x.alias("x")).withColumn("e", signal.energies(signal.frames(F.col("x"), 8, 4)))


def _measured(spark: SparkSession, sf: str) -> DataFrame:
    noise, speech = signal.noise_and_speech(F.col("e"))
    rows = _samples(spark, sf).withColumns({"noise": noise, "speech": speech})
    return rows.withColumns({"snr": signal.snr_db(F.col("noise"), F.col("speech")), "ratio": signal.speech_ratio(F.col("e"), F.col("noise")), "peak_db": signal.dbfs(signal.peak(F.col("x")))})


@query(f"WITH {_E} SELECT vec_id, cast(len(e) AS int) AS n_frames, round(list_sum(e), 9) AS energy, round(list_max(e), 9) AS loudest FROM e")
def frame_energy(spark: SparkSession, sf: str) -> DataFrame:
    return _samples(spark, sf).select("vec_id", F.size("e").alias("n_frames"), F.round(signal.total(F.col("e")), 9).alias("energy"), F.round(F.array_max("e"), 9).alias("loudest"))


@query(f"WITH {_N} SELECT vec_id, snr FROM q")
def snr_db(spark: SparkSession, sf: str) -> DataFrame:
    return _measured(spark, sf).select("vec_id", "snr")


@query(f"WITH {_N} SELECT vec_id, ratio FROM q")
def speech_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return _measured(spark, sf).select("vec_id", "ratio")


@query(f"WITH {_N} SELECT vec_id, snr, ratio, peak_db, floor((0.6::double * least(1, greatest(0, snr / 24)) + 0.3::double * least(1, greatest(0, ratio / 0.7::double)) + 0.1::double * CASE WHEN peak_db > -0.5 THEN 0.8::double ELSE 1.0::double END) * 1000 + 0.5::double) / 1000 AS score, snr >= 12 AND ratio >= 0.25 AND peak_db < 0 AS is_clean FROM q")
def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    s, r, p = F.col("snr"), F.col("ratio"), F.col("peak_db")
    return _measured(spark, sf).select("vec_id", "snr", "ratio", "peak_db", signal.quality(s, r, p).alias("score"), ((s >= 12) & (r >= 0.25) & (p < 0)).alias("is_clean"))


@query(f"""WITH {_E}, s AS (SELECT vec_id, list_sort(list_transform(e, lambda v: sqrt(v))) AS s, len(e) AS n, greatest(1, len(e) // 3) AS k FROM e), m AS (SELECT vec_id, list_sum(s[1:k]) / k AS lo, list_sum(s[n - k + 1:n]) / k AS hi FROM s)
SELECT vec_id, CASE WHEN lo <= 1e-9 THEN 45.0::double ELSE round(20 * log10(hi / lo), 2) END AS snr FROM m""")
def third_snr(spark: SparkSession, sf: str) -> DataFrame:
    return _samples(spark, sf).select("vec_id", signal.third_snr(F.col("e")).alias("snr"))


@query(f"""WITH {_X}, b AS (SELECT vec_id, x, list_transform(range(0, len(x) // 8), lambda i: sqrt(list_sum(list_transform(x[i * 8 + 1:i * 8 + 8], lambda v: v * v)) / 8)) AS r FROM x), s AS (SELECT *, list_sort(r) AS s, len(r) AS n, (len(r) - 1) * 0.2::double AS pos FROM b),
p AS (SELECT *, s[cast(floor(pos) AS int) + 1] + (s[least(cast(floor(pos) AS int) + 2, n)] - s[cast(floor(pos) AS int) + 1]) * (pos - floor(pos)) AS p20 FROM s), q AS (SELECT vec_id, sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x)) AS rms, len(list_filter(r, lambda v: v > greatest(0.008::double, p20 * 1.8::double))) / n AS ratio, len(x) / 16.0::double AS seconds FROM p)
SELECT vec_id, round(rms, 6) AS rms, round(ratio, 4) AS ratio, rms < 0.004 OR ratio * seconds < 1.8 OR ratio < 0.15 AS low_voice FROM q""")
def low_voice_filter(spark: SparkSession, sf: str) -> DataFrame:
    levels = F.transform(signal.energies(signal.blocks(F.col("x"), 8)), lambda e: F.sqrt(e))
    rows = _samples(spark, sf).withColumn("r", levels)
    limit = F.greatest(F.lit(0.008), signal.percentile(F.col("r"), 0.2) * 1.8)
    rows = rows.withColumn("limit", limit).withColumns({"rms": signal.rms(F.col("x")), "ratio": F.size(F.expr("filter(r, v -> v > limit)")) / F.size("r")})
    seconds = F.size("x") / 16.0
    return rows.select("vec_id", F.round("rms", 6).alias("rms"), F.round("ratio", 4).alias("ratio"), low_voice(F.col("rms"), F.col("ratio") * seconds, F.col("ratio")).alias("low_voice"))


@query(f"""WITH {_X}, f AS (SELECT vec_id, list_transform(range(0, len(x) - 8, 8), lambda i: x[i + 1:i + 8]) AS f FROM x),
m AS (SELECT vec_id, list_transform(f, lambda w: sqrt(list_sum(list_transform(w, lambda v: v * v)) / 8)) AS r, list_transform(f, lambda w: list_sum(list_transform(range(1, 8), lambda j: CASE WHEN w[j] * w[j + 1] < 0 THEN 1.0::double ELSE 0.0::double END)) / 8) AS z FROM f),
v AS (SELECT vec_id, list_sum(list_transform(r, lambda v: pow(v - list_sum(r) / len(r), 2))) / len(r) AS vr, list_sum(list_transform(z, lambda v: pow(v - list_sum(z) / len(z), 2))) / len(z) AS vz FROM m)
SELECT vec_id, round(0.6 * least(1, greatest(0, 1 - vr / 0.001::double)) + 0.4 * least(1, greatest(0, 1 - vz / 0.01::double)), 4) AS score FROM v""")
def synthetic_dsp_score(spark: SparkSession, sf: str) -> DataFrame:
    f = signal.frames(F.col("x"), 8, 8)
    z = F.transform(f, lambda w: F.aggregate(F.zip_with(F.slice(w, 2, 7), F.slice(w, 1, 7), lambda a, b: F.when(a * b < 0, F.lit(1.0)).otherwise(F.lit(0.0))), F.lit(0.0), lambda s, v: s + v) / 8)
    rows = _samples(spark, sf).withColumns({"r": F.transform(signal.energies(f), lambda e: F.sqrt(e)), "z": z})
    return rows.select("vec_id", F.round(scores.synthetic_by_levels(F.col("r"), F.col("z")), 4).alias("score"))


@query(f"WITH {_X} SELECT vec_id, round(list_sum(list_transform(range(1, len(x)), lambda i: CASE WHEN x[i] * x[i + 1] < 0 THEN 1.0::double ELSE 0.0::double END)) / (len(x) - 1), 6) AS zcr FROM x")
def zero_crossing(spark: SparkSession, sf: str) -> DataFrame:
    return _samples(spark, sf).select("vec_id", F.round(signal.zero_crossing(F.col("x")), 6).alias("zcr"))


@query(f"WITH {_X} SELECT vec_id, sha256(array_to_string(list_transform(x, lambda v: cast(trunc(greatest(-1.0::double, least(1.0::double, v)) * 32767) AS int)), ',')) AS fingerprint FROM x")
def fingerprint_sha256(spark: SparkSession, sf: str) -> DataFrame:
    return _samples(spark, sf).select("vec_id", signal.pcm_fingerprint(F.col("x")).alias("fingerprint"))


@query(f"WITH {_X} SELECT vec_id, md5(array_to_string(list_transform(x, lambda v: cast(round_even(v * 1000, 0) AS int)), ',')) AS fingerprint, round(sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x)), 3) AS rms FROM x")
def fingerprint_md5_coarse(spark: SparkSession, sf: str) -> DataFrame:
    return _samples(spark, sf).select("vec_id", signal.coarse_fingerprint(F.col("x")).alias("fingerprint"), F.round(signal.rms(F.col("x")), 3).alias("rms"))


@query(f"WITH {_X}, g AS (SELECT vec_id, x, sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x)) AS r FROM x), s AS (SELECT vec_id, list_transform(x, lambda v: least(1.0::double, greatest(-1.0::double, v * (CASE WHEN r > 0 THEN 0.1::double / r ELSE 1.0::double END)))) AS y FROM g) SELECT vec_id, round(list_sum(list_transform(y, lambda v: v * v)), 6) AS power, round(list_sum(y[9:24]), 6) AS part FROM s")
def loudness_scale(spark: SparkSession, sf: str) -> DataFrame:
    rows = _samples(spark, sf).withColumn("y", signal.scaled(F.col("x")))
    part = signal.clip_seconds(F.col("y"), F.lit(0.5), F.lit(1.5), 16)
    return rows.select("vec_id", F.round(signal.total(F.transform("y", lambda v: v * v)), 6).alias("power"), F.round(signal.total(part), 6).alias("part"))


_HANN = "(0.5::double - 0.5::double * cos(2 * pi() * (j - 1) / 31))"


@query(
    f"""WITH {_X}, w AS (SELECT vec_id, unnest(range(0, len(x) - 31, 16)) AS i, x FROM x), h AS (SELECT vec_id, i, list_transform(range(1, 33), lambda j: x[i + j] * {_HANN}) AS h FROM w),
p AS (SELECT vec_id, i, list_transform(range(0, 17), lambda k: pow(list_sum(list_transform(range(1, 33), lambda j: h[j] * cos(2 * pi() * k * (j - 1) / 32))), 2) + pow(list_sum(list_transform(range(1, 33), lambda j: h[j] * sin(2 * pi() * k * (j - 1) / 32))), 2) + 1e-12::double) AS p FROM h)
SELECT vec_id, round(avg(exp(list_sum(list_transform(p, lambda v: ln(v))) / 17) / (list_sum(p) / 17)), 4) AS flatness FROM p GROUP BY vec_id"""
)
def spectral_flatness(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").where("embedding is not null").select("vec_id", F.round(signal.spectral_flatness("embedding"), 4).alias("flatness"))


@query(
    f"""WITH {_N}, u AS (SELECT vec_id, unnest(e) AS v, generate_subscripts(e, 1) - 1 AS i, noise FROM q), a AS (SELECT vec_id, i, i - row_number() OVER (PARTITION BY vec_id ORDER BY i) AS island FROM u WHERE v >= noise * 1.5::double),
s AS (SELECT vec_id, min(i) * 0.25::double AS a, (max(i) + 1) * 0.25::double AS b FROM a GROUP BY vec_id, island), g AS (SELECT *, CASE WHEN a - lag(b) OVER w <= 0.25::double THEN 0 ELSE 1 END AS new FROM s WINDOW w AS (PARTITION BY vec_id ORDER BY a)),
joined AS (SELECT *, sum(new) OVER (PARTITION BY vec_id ORDER BY a ROWS UNBOUNDED PRECEDING) AS part FROM g) SELECT vec_id, min(a) AS start, max(b) AS "end" FROM joined GROUP BY vec_id, part HAVING max(b) - min(a) >= 0.5::double"""
)
def energy_speech(spark: SparkSession, sf: str) -> DataFrame:
    """Stretches of windows with at least 1.5 times the noise, 0.25 s a window step; pauses of one window are closed,
    stretches of less than half a second go."""
    rows = _measured(spark, sf).withColumn("s", segment.active_stretches(F.col("e"), F.col("noise") * 1.5, 0.25))
    return rows.select("vec_id", F.explode(segment.joined_stretches(F.col("s"), 0.25, 0.5)).alias("s")).select("vec_id", "s.start", "s.end")


@query("SELECT vec_id, 16000 AS sample_rate, 1 AS channels, cast(len(embedding) AS int) AS n, '' AS errors, true AS same FROM embeddings")
def sound_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Samples written as sound files and read again: header, what is wrong with it, and whether samples are the same."""
    files = table(spark, sf, "embeddings").select("vec_id", "embedding", landing.encode_sound(F.col("embedding")).alias("content"))
    read = files.withColumn("s", landing.decode_sound(F.col("content")))
    same = F.forall(F.zip_with("embedding", "s.samples", lambda a, b: F.abs(a - b) < 1e-4), lambda v: v)
    return read.select("vec_id", "s.sample_rate", "s.channels", F.size("s.samples").alias("n"), F.coalesce(landing.sound_errors(F.col("s.sample_rate"), F.col("s.channels"), F.col("s.sample_bytes"), F.col("s.duration")), F.lit("")).alias("errors"), same.alias("same"))


# --- segments -------------------------------------------------------------------------------------------------------

_TALK = "t AS (SELECT user_id, cast(ts AS date) AS d, epoch_us(ts) / 1000000.0::double AS s, epoch_us(ts) / 1000000.0::double + least(value, 300.0::double) AS e, event_id FROM events WHERE value > 0)"


def _talk(spark: SparkSession, sf: str) -> DataFrame:
    """A user's events of a day as speech intervals."""
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0
    return table(spark, sf, "events").where("value > 0").select("user_id", F.to_date("ts").alias("d"), at.alias("start"), (at + F.least("value", F.lit(300.0))).alias("end"), "event_id")


@query(
    f"""WITH {_TALK}, g AS (SELECT user_id, d, e AS a, lead(s) OVER (PARTITION BY user_id, d ORDER BY s, e) AS b FROM t)
SELECT user_id, strftime(d, '%Y-%m-%d') AS day, floor(a * 1000 + 0.5::double) / 1000 AS gap_start, floor(b * 1000 + 0.5::double) / 1000 AS gap_end, round((a + b) / 2, 3) AS mid FROM g WHERE round(b - a, 6) >= 0.35"""
)
def silence_gaps(spark: SparkSession, sf: str) -> DataFrame:
    rows = segment.silence_gaps(_talk(spark, sf), ["user_id", "d"], 0.35)
    return rows.select("user_id", F.date_format("d", "yyyy-MM-dd").alias("day"), rounded(F.col("start"), 3).alias("gap_start"), rounded(F.col("end"), 3).alias("gap_end"), "mid")


@query(
    f"""WITH {_TALK}, w AS (SELECT *, s - lag(e) OVER (PARTITION BY user_id, d ORDER BY s, e) AS gap FROM t)
SELECT user_id, strftime(d, '%Y-%m-%d') AS day, count(*) AS n_segments, CASE WHEN count(*) >= 4 AND coalesce(max(gap) > 1.2, false) THEN 'dialogue' ELSE 'monologue' END AS speaker_type FROM w GROUP BY user_id, d"""
)
def speaker_type(spark: SparkSession, sf: str) -> DataFrame:
    return segment.speaker_type(_talk(spark, sf), ["user_id", "d"]).select("user_id", F.date_format("d", "yyyy-MM-dd").alias("day"), "n_segments", "speaker_type")


_SPLIT = f"""{_TALK}, gap AS (SELECT user_id, d, e AS a, lead(s) OVER (PARTITION BY user_id, d ORDER BY s, e) AS b FROM t),
mid AS (SELECT user_id, d, list(m ORDER BY m) AS mids FROM (SELECT user_id, d, round(round((a + b) / 2, 3) - epoch(d), 3) AS m FROM gap WHERE round(b - a, 6) >= 0.35) GROUP BY user_id, d),
item AS (SELECT cast(user_id AS varchar) || ' ' || strftime(d, '%Y-%m-%d') AS item_id, 86400.0::double AS total, coalesce(mids, []) AS mids FROM (SELECT DISTINCT user_id, d FROM t) LEFT JOIN mid USING (user_id, d)),
walk AS (SELECT item_id, total, mids, 0.0::double AS a, coalesce(list_filter(mids, lambda m: m >= 600 AND m <= 3600)[-1], 3600.0::double) AS b, false AS last, 1 AS k FROM item
UNION ALL SELECT item_id, total, mids, b, CASE WHEN total - b <= 3600 THEN total ELSE coalesce(list_filter(mids, lambda m: m >= walk.b + 600 AND m <= walk.b + 3600)[-1], b + 3600) END, total - b <= 3600, k + 1 FROM walk WHERE NOT last),
pieces AS (SELECT item_id, total, k, round(a, 3) AS s, round(b, 3) AS e FROM walk WHERE NOT last OR b - a >= 600)"""


def _split(spark: SparkSession, sf: str) -> DataFrame:
    """Days of users as items, cut at the pauses between their events into pieces of 10 to 60 minutes."""
    talk = _talk(spark, sf)
    gaps = segment.silence_gaps(talk, ["user_id", "d"], 0.35).select("user_id", "d", F.round(F.col("mid") - F.unix_date("d") * 86400.0, 3).alias("m"))
    # a day has room for so many pauses of this length and no more
    mids = gaps.groupBy("user_id", "d").agg(F.sort_array(F.collect_list("m")).alias("mids"))
    items = talk.select("user_id", "d").distinct().join(mids, ["user_id", "d"], "left").select(F.concat_ws(" ", F.col("user_id").cast("string"), F.date_format("d", "yyyy-MM-dd")).alias("item_id"), F.lit(86400.0).alias("total"), "mids")
    return items.select("item_id", "total", segment.greedy_split(F.col("total"), F.col("mids"), 600.0, 3600.0).alias("pieces"))


@query(f"WITH RECURSIVE {_SPLIT} SELECT item_id, cast(row_number() OVER (PARTITION BY item_id ORDER BY k) AS int) AS n, s AS start_sec, e AS end_sec FROM pieces")
def greedy_split(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).select("item_id", F.posexplode("pieces").alias("i", "p")).select("item_id", (F.col("i") + 1).alias("n"), F.col("p.start").alias("start_sec"), F.col("p.end").alias("end_sec"))


@query(
    f"""WITH RECURSIVE {_SPLIT}, n AS (SELECT *, cast(row_number() OVER (PARTITION BY item_id ORDER BY k) AS int) AS i, cast(count(*) OVER (PARTITION BY item_id) AS int) AS m FROM pieces), p AS (SELECT item_id, i, m, greatest(0.0::double, round(s - 0.20::double, 3)) AS a, least(total, round(e + 0.25::double, 3)) AS b FROM n)
SELECT item_id, m AS total_segments, i AS segment_index, a AS start_sec, b AS end_sec, round(b - a, 3) AS duration_seconds FROM p WHERE round(b - a, 3) >= 600"""
)
def pad_clamp(spark: SparkSession, sf: str) -> DataFrame:
    return segment.padded_pieces(_split(spark, sf), "total", "pieces", 600.0).drop("total")


@query(
    f"""WITH RECURSIVE {_TALK}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id, d ORDER BY s, e) AS k FROM t),
walk AS (SELECT user_id, d, k, s AS a, e AS b FROM r WHERE k = 1 UNION ALL SELECT r.user_id, r.d, r.k, CASE WHEN r.e - walk.a <= 900 THEN walk.a ELSE r.s END, r.e FROM walk JOIN r ON r.user_id = walk.user_id AND r.d = walk.d AND r.k = walk.k + 1),
ends AS (SELECT *, lead(a) OVER (PARTITION BY user_id, d ORDER BY k) AS next_a FROM walk)
SELECT user_id, strftime(d, '%Y-%m-%d') AS day, floor(a * 1000 + 0.5::double) / 1000 AS start_sec, floor(b * 1000 + 0.5::double) / 1000 AS end_sec FROM ends WHERE (next_a IS NULL OR next_a <> a) AND b - a >= 3"""
)
def greedy_merge(spark: SparkSession, sf: str) -> DataFrame:
    rows = segment.greedy_merge(_talk(spark, sf), ["user_id", "d"], 3.0, 900.0)
    return rows.select("user_id", F.date_format("d", "yyyy-MM-dd").alias("day"), rounded(F.col("start"), 3).alias("start_sec"), rounded(F.col("end"), 3).alias("end_sec"))


# --- event time -----------------------------------------------------------------------------------------------------

_MINUTE = "yyyy-MM-dd HH:mm:ss"


@query("SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def tumbling_events(spark: SparkSession, sf: str) -> DataFrame:
    return streams.tumbling(table(spark, sf, "events")).withColumn("start", F.date_format("start", _MINUTE))


@query("SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 1 HOUR, ts), time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR]) AS b, event_type FROM events) GROUP BY 1, 2")
def sliding_events(spark: SparkSession, sf: str) -> DataFrame:
    return streams.sliding(table(spark, sf, "events")).withColumn("start", F.date_format("start", _MINUTE))


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS "end", count(*) AS n FROM s GROUP BY user_id, k"""
)
def session_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = streams.sessions(table(spark, sf, "events"))
    return rows.withColumns({"start": F.date_format("start", _MINUTE), "end": F.date_format("end", _MINUTE)})


@query("SELECT event_type, count(*) AS n, count(DISTINCT cast(json_extract(props, '$.k') AS bigint)) AS kinds FROM events GROUP BY event_type")
def event_props(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("p", F.from_json("props", "k bigint")).groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("p.k").alias("kinds"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return streams.funnel_of_stream(spark, sf)


@query("SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1, 2")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = streams.once(streams.read_stream(spark, sf), ["user_id", "event_type"], "3650 days")
    return streams.run_to_table(rows.select("user_id", "event_type")).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def stream_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    return streams.tumbling_of_stream(spark, sf).withColumn("start", F.date_format("start", _MINUTE))


@query(
    f"""WITH r AS (SELECT * FROM metadata_extended WHERE item_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY crawled_at NULLS FIRST) = 1),
seen AS (SELECT key FROM ({_seen("(SELECT * FROM metadata WHERE processed_at < TIMESTAMP '2026-09-10 00:00:00')")}) WHERE key IS NOT NULL), u AS ({_unseen('r', '*')}),
e AS (SELECT platform, {_nan('snr_db')} AS snr, {_nan('duration_seconds')} AS d, {_nan('music_prob')} AS m, {_nan('synthetic_prob')} AS s, {_nan('speech_ratio')} AS sr, {_words('transcript_raw')} AS w, content_decision AS cd FROM u)
SELECT platform, CASE WHEN d < 5.0 THEN 'too_short' WHEN d > 7200.0 THEN 'too_long' WHEN m >= 0.70 THEN 'music_quarantine' WHEN s > 0.70 THEN 'synthetic' WHEN (snr < 12.0 OR sr < 0.25) AND snr < 10.0 THEN 'low_quality' WHEN m >= 0.30 THEN 'residual_music' WHEN w < 3 THEN 'no_speech' WHEN cd = 'REJECT' THEN 'content' END AS reject_reason, count(*) AS n FROM e GROUP BY 1, 2"""
)
def curation_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Extended records through dedup, the seen set of the first half of the crawl's days, and the gates."""
    used = ["snr_db", "duration_seconds", "music_prob", "synthetic_prob", "speech_ratio"]
    records = table(spark, sf, "metadata_extended").withColumns({c: F.nanvl(c, F.lit(None)) for c in used})
    earlier = table(spark, sf, "metadata").where("processed_at < timestamp '2026-09-10 00:00:00'")
    seen = dedup.remember(spark.createDataFrame([], "key string"), earlier)
    return pipeline.curate(records, seen).groupBy("platform", "reject_reason").agg(F.count("*").alias("n"))
