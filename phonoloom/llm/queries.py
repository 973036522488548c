"""Queries pN_... of the training-data operators, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from phonoloom.llm import caps, encoding, incremental, lookalike, mixing, neardup, percentiles, pii, splits, toxicity
from phonoloom.plans.cluster import own_dir, stored, table

#: Records an uploader keeps in p7_found.
KEEP = 60


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return splits.video_groups(table(spark, sf, "metadata")).select("item_id", "group_id")


def p1_splits(spark: SparkSession, sf: str) -> DataFrame:
    records, _ = splits.split_records(table(spark, sf, "metadata"))
    return records.select("item_id", "split")


def p1_split_report(spark: SparkSession, sf: str) -> DataFrame:
    """Records and labels of every split."""
    records, _ = splits.split_records(table(spark, sf, "metadata"))
    return records.groupBy("split").agg(F.count("*").alias("records"), *[F.count_if(F.col("label") == k).alias(k) for k in ("demucs", "melband", "none", "other")])


def p1_split_check(spark: SparkSession, sf: str) -> DataFrame:
    """One row: records, those without a split, videos in more than one, and whether every split has its share to a
    thousandth of the records or to ten of them."""
    records, _ = splits.split_records(table(spark, sf, "metadata"))
    videos = records.groupBy("component").agg(F.countDistinct("split").alias("s"), F.count("*").alias("n"), F.count_if(F.col("split").isNull()).alias("none"), *[F.count_if(F.col("split") == k).alias(k) for k in splits.SPLITS])
    whole = F.sum("n")
    near = [F.abs(F.sum(k) - share * whole) <= F.greatest(F.lit(10.0), whole / 1000) for k, share in zip(splits.SPLITS, (0.9, 0.05, 0.05))]
    return videos.agg(whole.alias("records"), F.sum("none").alias("unplaced"), F.count_if(F.col("s") > 1).alias("torn_videos"), (near[0] & near[1] & near[2]).alias("near_targets"))


def _p2_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = percentiles.records_once(table(spark, sf, "metadata").select("item_id", "duration_seconds", "snr_estimate_db", "separation_model", "processed_at"))
    rows = rows.select(percentiles.model_name().alias("separation_model"), F.date_format("processed_at", "yyyy-MM-dd").alias("day"), "duration_seconds", "snr_estimate_db")
    return percentiles.value_counts(rows, ["separation_model", "day"], percentiles.GRID)


def p2_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _p2_summary(spark, sf)


def _p2(groups: list[str]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return percentiles.percentiles(percentiles.combined(_p2_summary(spark, sf), groups), groups, percentiles.GRID)

    return query


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """The batches, as a backlog, against a history of chunks that metadata began."""
    history = incremental.start_history(spark, own_dir(spark, "history"), table(spark, sf, "metadata"))
    return incremental.repeated_records(history, table(spark, sf, "metadata_incoming"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return lookalike.not_canonical(table(spark, sf, "metadata_extended"))


def p4_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return lookalike.canonical(table(spark, sf, "metadata_extended"), keep=["item_id"]).select("item_id", "canonical")


def p4_check(spark: SparkSession, sf: str) -> DataFrame:
    """One row: transcripts, and those whose consistent form isn't composed, has odd spaces or changes once more."""
    once = lookalike.canonical(table(spark, sf, "metadata_extended"), keep=["item_id"]).select("item_id", F.col("canonical").alias("transcript_raw"))
    twice = lookalike.canonical(stored(once, "p4-once"), keep=["item_id", "transcript_raw"])
    odd = F.coalesce(F.col("transcript_raw").rlike(r"[\x{00a0}\x{2000}-\x{200a}\x{202f}\x{3000}\x{ff01}-\x{ff5e}]"), F.lit(False))
    return twice.agg(F.count("transcript_raw").alias("transcripts"), F.count_if(odd).alias("odd"), F.count_if(F.coalesce(F.col("canonical") != F.col("transcript_raw"), F.lit(False))).alias("changing"))


def p5_check(spark: SparkSession, sf: str) -> DataFrame:
    """One row: records, scores outside 0..1, kinds that don't go with the score, flagged records without a span."""
    scored = p5_scores(spark, sf)
    return scored.agg(
        F.count("*").alias("records"),
        F.count_if(~F.col("score").between(0, 1) | (F.greatest("p_abusive", "p_hateful", "p_sexual") > F.col("score") + 1e-6)).alias("outside"),
        F.count_if(((F.col("score") >= toxicity.CUT) & F.col("kind").isNull()) | ((F.col("score") < toxicity.SHORT_CUT) & F.col("kind").isNotNull())).alias("contradicting"),
        F.count_if(F.col("kind").isNotNull() & (F.size("spans") == 0)).alias("without_span"),
    )


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf, "metadata_extended").where("item_id is not null"), table(spark, sf, "content_labels"), spans=False)
    return scored.where("kind is not null").select("item_id").distinct()


def p5_scores(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score(table(spark, sf, "metadata_extended"), table(spark, sf, "content_labels"))


def p5_rates(spark: SparkSession, sf: str) -> DataFrame:
    records = table(spark, sf, "metadata_extended")
    return toxicity.rates(records, toxicity.score(records, table(spark, sf, "content_labels"), spans=False), ["uploader", "platform", "content_category"])


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_copies(table(spark, sf, "metadata_extended"))


def p6_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Records of one text, which p6_found gives as pairs with the smallest where they are many."""
    return neardup.exact_copies(table(spark, sf, "metadata_extended"))


def p6_groups(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.copy_groups(table(spark, sf, "metadata_extended"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return caps.beyond_cap(table(spark, sf, "metadata"), KEEP, caps.handle())


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.encode(table(spark, sf, "documents"))


def p8_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the ids of every document decode to its text."""
    documents = table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    back = encoding.decode(encoding.encode(documents), out="decoded")
    return documents.join(back, "doc_id").select("doc_id", (F.col("text") == F.col("decoded")).alias("same"))


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))[1]


def p9_check(spark: SparkSession, sf: str) -> DataFrame:
    """One row: texts used more often than their source allows, texts of no target, and whether positions run on without
    gap or overlap."""
    mixed = stored(p9_mix(spark, sf), "p9-mixed")
    allowed = table(spark, sf, "mix_targets").groupBy("source").agg(F.max("max_repeats").alias("most"))
    used = mixed.groupBy("source", "doc_id").agg(F.count("*").alias("n")).join(allowed, "source", "left")
    ends = mixed.select("position", (F.col("position") + F.col("n_tokens")).alias("end"))
    joints = ends.select(F.col("position").alias("at"), F.lit(1).alias("d")).unionByName(ends.select(F.col("end").alias("at"), F.lit(-1).alias("d"))).groupBy("at").agg(F.sum("d").alias("d"))
    open_ = joints.agg(F.count_if(F.col("d") != 0).alias("breaks"))
    return used.agg(F.count_if(F.col("n") > F.col("most")).alias("too_often"), F.count_if(F.col("most").isNull()).alias("without_target")).join(open_).select("too_often", "without_target", (F.col("breaks") == 2).alias("gapless"))  # one row each


def p10_check(spark: SparkSession, sf: str) -> DataFrame:
    """One row: documents, and those whose text without what was found isn't their redacted text without placeholders,
    by length."""
    documents = table(spark, sf, "documents")
    kinds = F.length(F.concat(F.lit("["), "pii_kind", F.lit("]")))
    change = pii.find(documents).groupBy("doc_id").agg(F.sum(kinds - (F.col("end_char") - F.col("start_char"))).alias("more"))
    both = documents.select("doc_id", F.length("text").alias("n")).join(pii.redact(documents).select("doc_id", F.length("redacted").alias("r")), "doc_id").join(change, "doc_id", "left")
    return both.agg(F.count("*").alias("documents"), F.count_if(F.coalesce(F.col("n") + F.coalesce("more", F.lit(0)) != F.col("r"), F.lit(False))).alias("changed"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return pii.find(table(spark, sf, "documents")).select("doc_id", "pii_kind", "start_char")


def p10_redacted(spark: SparkSession, sf: str) -> DataFrame:
    return pii.redact(table(spark, sf, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found,
        "p1_splits": p1_splits,
        "p1_split_report": p1_split_report,
        "p1_split_check": p1_split_check,
        "p2_percentiles": _p2(["separation_model", "day"]),
        "p2_by_model": _p2(["separation_model"]),
        "p2_by_day": _p2(["day"]),
        "p2_summary": p2_summary,
        "p3_found": p3_found,
        "p4_found": p4_found,
        "p4_canonical": p4_canonical,
        "p4_check": p4_check,
        "p5_found": p5_found,
        "p5_scores": p5_scores,
        "p5_rates": p5_rates,
        "p5_check": p5_check,
        "p6_found": p6_found,
        "p6_copies": p6_copies,
        "p6_groups": p6_groups,
        "p7_found": p7_found,
        "p8_ids": p8_ids,
        "p8_round_trip": p8_round_trip,
        "p9_mix": p9_mix,
        "p9_shares": p9_shares,
        "p9_check": p9_check,
        "p10_found": p10_found,
        "p10_redacted": p10_redacted,
        "p10_check": p10_check,
    }


_KEYS = r"""
keyed AS (
  SELECT *, CASE WHEN num IS NOT NULL THEN coalesce(pre, site) || ':' || num END AS id_key,
    CASE WHEN url_num IS NOT NULL THEN coalesce(site, host) || ':' || url_num
         WHEN length(base) > 0 THEN 'a:' || regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '') END AS address_key
  FROM (SELECT *, coalesce(nullif(regexp_extract(regexp_replace(path, '/@[^/]*', '/', 'g'), '(?:^|[^0-9])([0-9]{19}|[0-9]{15})(?:[^0-9]|$)', 1), ''),
                           nullif(regexp_extract(url, '[?&]v=([0-9]{19}|[0-9]{15})(?:&|$)', 1), '')) AS url_num,
               CASE WHEN host LIKE '%vidtok.example' THEN 'tt' WHEN host LIKE '%fbclips.example' THEN 'fb' END AS site
        FROM (SELECT *, lower(split_part(base, '/', 1)) AS host, replace(regexp_replace(base, '^[^/]*', ''), '%40', '@') AS path
              FROM (SELECT *, split_part(url, '?', 1) AS base,
                           nullif(regexp_extract(low, '^(?:(tt|fb)_)?(?:([0-9]{19}|[0-9]{15})|([0-9a-f]{16}))(?:_([0-9]+))?$', 1), '') AS pre,
                           nullif(regexp_extract(low, '^(?:(tt|fb)_)?(?:([0-9]{19}|[0-9]{15})|([0-9a-f]{16}))(?:_([0-9]+))?$', 2), '') AS num,
                           cast(nullif(regexp_extract(low, '^(?:(tt|fb)_)?(?:([0-9]{19}|[0-9]{15})|([0-9a-f]{16}))(?:_([0-9]+))?$', 4), '') AS bigint) AS seg
                    FROM (SELECT *, lower(trim(item_id)) AS low, regexp_replace(split_part(trim(source_url), '#', 1), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS url FROM base_rows))))
)"""

_WALK = """
edges AS (SELECT DISTINCT a, b FROM (SELECT 'i:' || item_id AS a, id_key AS b FROM keyed WHERE id_key IS NOT NULL UNION ALL SELECT 'i:' || item_id, address_key FROM keyed WHERE address_key IS NOT NULL
  UNION ALL SELECT id_key, address_key FROM keyed WHERE id_key IS NOT NULL AND address_key IS NOT NULL)),
keys AS (SELECT DISTINCT b AS k FROM edges),
pairs AS (SELECT DISTINCT x.b AS p, y.b AS q FROM edges x JOIN edges y ON x.a = y.a WHERE x.b <> y.b),
links AS (SELECT p, q FROM pairs UNION SELECT q, p FROM pairs),
walk AS (SELECT k AS n, k AS r FROM keys UNION SELECT links.q, walk.r FROM walk JOIN links ON links.p = walk.n WHERE walk.r < links.q),
label AS (SELECT n, least(n, min(r)) AS video FROM walk GROUP BY n)"""

_P1 = (
    "WITH RECURSIVE base_rows AS (SELECT DISTINCT item_id, source_url FROM metadata WHERE item_id IS NOT NULL),"
    + _KEYS
    + ","
    + _WALK
    + """,
item AS (SELECT e.a AS item, min(l.video) AS video FROM edges e JOIN label l ON l.n = e.b WHERE e.a LIKE 'i:%' GROUP BY e.a),
grp AS (SELECT video, min(substr(item, 3)) AS group_id, count(*) AS n FROM item GROUP BY video)
SELECT substr(item.item, 3) AS item_id, grp.group_id FROM item JOIN grp USING (video) WHERE grp.n > 1"""
)

_P3 = (
    """WITH RECURSIVE base_rows AS (SELECT NULL::bigint AS record_no, 0 AS batch_no, item_id, source_url FROM metadata
  UNION ALL SELECT record_no, batch_no, item_id, source_url FROM metadata_incoming),"""
    + _KEYS
    + """,
pairs AS (SELECT DISTINCT id_key AS p, address_key AS q FROM keyed WHERE id_key <> address_key),
links AS (SELECT p, q FROM pairs UNION SELECT q, p FROM pairs),
keys AS (SELECT id_key AS k FROM keyed WHERE id_key IS NOT NULL UNION SELECT address_key FROM keyed WHERE address_key IS NOT NULL),
walk AS (SELECT k AS n, k AS r FROM keys UNION SELECT links.q, walk.r FROM walk JOIN links ON links.p = walk.n WHERE walk.r < links.q),
label AS (SELECT n, least(n, min(r)) AS video FROM walk GROUP BY n),
rec AS (SELECT record_no, batch_no, seg, video FROM keyed JOIN label ON label.n = coalesce(id_key, address_key)),
first AS (SELECT video, min(batch_no) AS b FROM rec GROUP BY video),
low AS (SELECT batch_no, video, coalesce(seg, -1) AS seg, min(record_no) AS no FROM rec WHERE record_no IS NOT NULL GROUP BY ALL)
SELECT rec.record_no FROM rec JOIN first USING (video) JOIN low ON low.batch_no = rec.batch_no AND low.video = rec.video AND low.seg = coalesce(rec.seg, -1)
WHERE rec.record_no IS NOT NULL AND (first.b < rec.batch_no OR low.no < rec.record_no)"""
)


def _p2_sql(groups: str) -> str:
    named = ", ".join(f"g.{c.strip()}" for c in groups.split(","))
    on = " AND ".join(f"g.{c.strip()} IS NOT DISTINCT FROM v.{c.strip()}" for c in groups.split(","))
    picks = ", ".join(f"round(min(v.bin) FILTER (WHERE v.upto >= ceil(g.n * {p} / 100.0)) / 100.0, 6) AS p{p:02d}" for p in percentiles.PERCENTS)
    return f"""WITH rec AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY duration_seconds NULLS FIRST, snr_estimate_db NULLS FIRST, separation_model NULLS FIRST, processed_at NULLS FIRST) AS rn FROM metadata),
one AS (SELECT coalesce(nullif(lower(trim(separation_model)), ''), 'unknown') AS separation_model, strftime(processed_at, '%Y-%m-%d') AS day, duration_seconds, snr_estimate_db FROM rec WHERE rn = 1 OR item_id IS NULL),
long AS (SELECT separation_model, day, 'duration_seconds' AS metric, duration_seconds AS x FROM one UNION ALL SELECT separation_model, day, 'snr_estimate_db', snr_estimate_db FROM one),
bins AS (SELECT {groups}, metric, CASE WHEN x IS NOT NULL AND NOT isnan(x) AND abs(x) < 1e15 THEN cast(floor(x * 100.0::double + 0.5::double) AS bigint) END AS bin, count(*) AS n FROM long GROUP BY ALL),
g AS (SELECT {groups}, metric, coalesce(sum(n) FILTER (WHERE bin IS NOT NULL), 0) AS n, coalesce(sum(n) FILTER (WHERE bin IS NULL), 0) AS n_missing FROM bins GROUP BY ALL),
v AS (SELECT *, sum(n) OVER (PARTITION BY {groups}, metric ORDER BY bin) AS upto FROM bins WHERE bin IS NOT NULL)
SELECT {named}, g.metric, cast(g.n AS bigint) AS n, cast(g.n_missing AS bigint) AS n_missing, {picks} FROM g LEFT JOIN v ON {on} AND g.metric = v.metric GROUP BY {named}, g.metric, g.n, g.n_missing"""


_P7 = f"""WITH rec AS (SELECT item_id, nullif(trim(regexp_replace(lower(trim(uploader)), '^@+', '')), '') AS handle, snr_estimate_db AS snr FROM metadata WHERE item_id IS NOT NULL),
one AS (SELECT item_id, handle, CASE WHEN isnan(snr) THEN NULL ELSE snr END AS snr FROM (SELECT DISTINCT * FROM rec WHERE handle IS NOT NULL)),
best AS (SELECT item_id, handle, max(snr) AS snr FROM one GROUP BY ALL)
SELECT item_id FROM (SELECT item_id, row_number() OVER (PARTITION BY handle ORDER BY snr DESC NULLS LAST, item_id) AS rn FROM best) WHERE rn > {KEEP}"""


_P6 = """WITH t AS (SELECT DISTINCT item_id, transcript_raw FROM metadata_extended WHERE item_id IS NOT NULL AND transcript_raw IS NOT NULL),
w AS (SELECT item_id, regexp_extract_all(lower(transcript_raw), '[\\p{L}\\p{M}\\p{N}]+') AS ws FROM t),
g AS (SELECT DISTINCT item_id, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram FROM w, unnest(range(1, len(ws) - 1)) AS r(i) WHERE len(ws) >= 40),
n AS (SELECT item_id, count(*) AS n FROM g GROUP BY item_id),
p AS (SELECT a.item_id AS x, b.item_id AS y, count(*) AS o FROM g a JOIN g b ON a.gram = b.gram AND a.item_id < b.item_id GROUP BY ALL)
SELECT x AS item_id_a, y AS item_id_b FROM p JOIN n nx ON nx.item_id = x JOIN n ny ON ny.item_id = y WHERE o >= 0.6 * (nx.n + ny.n - o) - 1e-9"""


_P6_GROUPS = r"""WITH RECURSIVE ids AS (SELECT DISTINCT item_id FROM metadata_extended WHERE item_id IS NOT NULL),
w AS (SELECT DISTINCT item_id, regexp_extract_all(lower(transcript_raw), '[\p{L}\p{N}]+') AS ws FROM metadata_extended WHERE item_id IS NOT NULL AND transcript_raw IS NOT NULL),
g AS (SELECT DISTINCT item_id, array_to_string(ws[i:i + 4], ' ') AS gram FROM w, unnest(range(1, len(ws) - 3)) AS r(i) WHERE len(ws) >= 5 UNION SELECT item_id, '=' || array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4),
n AS (SELECT item_id, count(*) AS n FROM g GROUP BY item_id),
p AS (SELECT a.item_id AS x, b.item_id AS y, count(*) AS o FROM g a JOIN g b ON a.gram = b.gram AND a.item_id <> b.item_id GROUP BY ALL),
links AS (SELECT x AS p, y AS q FROM p JOIN n nx ON nx.item_id = x JOIN n ny ON ny.item_id = y WHERE o >= 0.8 * (nx.n + ny.n - o) - 1e-9),
walk AS (SELECT item_id AS n, item_id AS r FROM ids UNION SELECT links.q, walk.r FROM walk JOIN links ON links.p = walk.n WHERE walk.r < links.q),
label AS (SELECT n, least(n, min(r)) AS group_id FROM walk GROUP BY n), d AS (SELECT p, count(*) AS n_links FROM links GROUP BY p)
SELECT label.n AS item_id, group_id, coalesce(n_links, 0) AS n_links FROM label LEFT JOIN d ON d.p = label.n"""

_P6_COPIES = r"""WITH t AS (SELECT DISTINCT item_id, transcript_raw FROM metadata_extended WHERE item_id IS NOT NULL AND len(regexp_extract_all(lower(transcript_raw), '[\p{L}\p{N}]+')) >= 40)
SELECT item_id, min(item_id) OVER (PARTITION BY transcript_raw) AS representative, md5(transcript_raw) AS text_id FROM t"""

_P2_SUMMARY = """WITH rec AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY duration_seconds NULLS FIRST, snr_estimate_db NULLS FIRST, separation_model NULLS FIRST, processed_at NULLS FIRST) AS rn FROM metadata),
one AS (SELECT coalesce(nullif(lower(trim(separation_model)), ''), 'unknown') AS separation_model, strftime(processed_at, '%Y-%m-%d') AS day, duration_seconds, snr_estimate_db FROM rec WHERE rn = 1 OR item_id IS NULL),
long AS (SELECT separation_model, day, 'duration_seconds' AS metric, duration_seconds AS x FROM one UNION ALL SELECT separation_model, day, 'snr_estimate_db', snr_estimate_db FROM one)
SELECT separation_model, day, metric, CASE WHEN x IS NOT NULL AND NOT isnan(x) AND abs(x) < 1e15 THEN cast(floor(x * 100.0::double + 0.5::double) AS bigint) END AS bin, count(*) AS n FROM long GROUP BY ALL"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _P1,
        "p2_percentiles": _p2_sql("separation_model, day"),
        "p2_by_model": _p2_sql("separation_model"),
        "p2_by_day": _p2_sql("day"),
        "p1_split_check": "SELECT count(DISTINCT item_id) AS records, 0 AS unplaced, 0 AS torn_videos, true AS near_targets FROM metadata",
        "p2_summary": _P2_SUMMARY,
        "p3_found": _P3,
        "p4_check": "SELECT count(transcript_raw) AS transcripts, 0 AS odd, 0 AS changing FROM metadata_extended",
        "p5_check": "SELECT count(*) AS records, 0 AS outside, 0 AS contradicting, 0 AS without_span FROM metadata_extended",
        "p6_found": _P6,
        "p6_groups": _P6_GROUPS,
        "p6_copies": _P6_COPIES,
        "p7_found": _P7,
        "p8_round_trip": "SELECT doc_id, true AS same FROM documents",
        "p9_check": "SELECT 0 AS too_often, 0 AS without_target, true AS gapless",
        "p10_check": "SELECT count(*) AS documents, 0 AS changed FROM documents",
    }
