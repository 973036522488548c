"""Duplicates, seen sets, reconciling, rollups, streams, and the registry."""

import datetime
import random
import glob
import importlib
import json
import os
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from phonoloom.operators import components, dedup, gates, reconcile, rollup, running
from phonoloom.plans import pipeline
from phonoloom.sources import landing, sinks
from phonoloom.streaming import events as streams


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_keep_first(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 5, "z"), (None, 4, None)], "k string, o int, v string")
    assert rows(dedup.keep_first(df, ["k"], ["o"])) == rows(spark.createDataFrame([("a", 1, "y"), (None, 4, None)], "k string, o int, v string"))
    assert dedup.keep_first(df.limit(0), ["k"], ["o"]).count() == 0


def test_originals(spark):
    df = spark.createDataFrame([(1, "h"), (2, "h"), (3, None), (4, None)], "id int, h string")
    assert rows(dedup.with_original(df, "h", "id").select("id", "original", "is_duplicate")) == [(1, 1, False), (2, 1, True), (3, 3, False), (4, 4, False)]


def test_seen_set(spark):
    seen = dedup.remember(spark.createDataFrame([], "key string"), spark.createDataFrame([("tt_12345678_01",), (None,)], "item_id string"))
    assert {r[0] for r in seen.collect()} == {"tt_12345678_01", "tt_12345678"}
    asked = spark.createDataFrame([("tt_12345678_07",), ("fb_12345678",), ("12345678",), (None,), ("tt_99999999",)], "item_id string")
    assert {r[0] for r in dedup.unseen(asked, seen).collect()} == {"fb_12345678", None, "tt_99999999"}
    assert dedup.unseen(asked, seen.limit(0)).count() == 5


def test_latest_status(spark):
    t = datetime.datetime
    log = spark.createDataFrame([("u", "failed", "e", t(2026, 1, 2)), ("u", "done", None, t(2026, 1, 1)), ("v", "failed", "e", t(2026, 1, 1))], "url string, status string, error string, ts timestamp")
    assert {(r["url"], r["status"]) for r in dedup.latest_status(log).collect()} == {("u", "done"), ("v", "failed")}


def test_components(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e"), ("f", "f"), (None, "x"), ("e", "d")], "src string, dst string")
    for small in (0, 50_000):
        assert rows(components.connected_components(edges, small=small)) == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "d")]
    chain = spark.range(300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert components.connected_components(chain, small=0).select("component").distinct().count() == 1
    assert components.connected_components(edges.limit(0)).count() == components.connected_components(edges.limit(0), small=-1).count() == 0
    rng = random.Random(4)
    many = spark.createDataFrame([(rng.randrange(400), rng.randrange(400)) for _ in range(330)], "src int, dst int")
    assert rows(components.connected_components(many, small=0)) == rows(components.connected_components(many))


def test_running_sum(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"), F.lit(1).alias("n"))
    got = running.running_sum(df, ["k"], ["o"], "n", "upto")
    assert got.where(F.col("upto") != F.floor(F.col("o") / 3) + 1).count() == 0 and got.count() == 1000
    assert running.running_sum(df, [], ["o"], "n", "upto").where(F.col("upto") != F.col("o") + 1).count() == 0


def test_reconcile(spark):
    a = spark.createDataFrame([("1",), ("2",), (None,)], "item_id string")
    b = spark.createDataFrame([("2",), ("3",)], "item_id string")
    assert rows(reconcile.match_status(a, b, "item_id")) == [("1", "left_only"), ("2", "matched"), ("3", "right_only")]
    listing = spark.createDataFrame([("d/a.wav", 500), ("d/b.wav", 64044), ("e/b.wav", 64044), ("d/c.wav", 999999)], "path string, length bigint")
    records = spark.createDataFrame([("c", "d/c.wav", 5.0)], "item_id string, audio_path string, duration_seconds double")
    got = rows(reconcile.audit_listing(listing, records).select("item_id", "duration_seconds", "imputed", "known"))
    assert got == [("b", 3.0, True, False), ("c", 5.0, False, True)]


def test_intervals(spark):
    a = spark.createDataFrame([(1, 0.0, 100.0), (1, 200.0, 201.0)], "k int, start double, end double")
    b = spark.createDataFrame([(1, 50.0, 250.0), (1, 100.0, 110.0), (2, 0.0, 1.0)], "k int, start double, end double")
    assert reconcile.overlapping(a, b, "k").count() == 2


def test_rollups(spark):
    records = spark.createDataFrame([("a", 120.0, "2026-08-20"), ("a", float("nan"), "2026-08-20"), ("b", None, "2026-08-25")], "item_id string, duration_seconds double, day string")
    days = rollup.yield_funnel(rollup.day_summary(records, F.col("day")))
    assert rows(days.select("day", "items", "unique_items", "total_hours", "yield_rate")) == [("2026-08-20", 2, 1, 0.03, "100.0%"), ("2026-08-25", 1, 1, 0.0, "100.0%")]
    assert rows(rollup.week_rollup(days).select("week", "files")) == [(1, 2), (2, 1), (None, 3)]
    one = rollup.audit(records).first()
    assert (one["files"], one["corrupt"], one["fit"]) == (3, 2, 0)
    assert rollup.audit(records.limit(0)).first()["fit_percent"] == 0.0


def test_gates_take_the_first_reason(spark):
    kind = "snr_db double, duration_seconds double, music_prob double, synthetic_prob double, speech_ratio double, transcript_raw string, content_decision string"
    df = spark.createDataFrame([(20.0, 10.0, 0.8, 0.9, 0.5, "a b c", "REJECT"), (9.0, 10.0, 0.0, 0.0, 0.5, "a b c", "ACCEPT"), (11.0, 10.0, 0.0, 0.0, 0.1, "a b c", "ACCEPT"), (None, None, None, None, None, None, None)], kind)
    assert [r[0] for r in df.select(gates.item_gates()).collect()] == ["music_quarantine", "low_quality", None, "no_speech"]


def test_gold_gate_is_off_unless_enforced(spark):
    df = spark.createDataFrame([(0.1, 20.0), (0.9, 20.0), (None, None)], "spectral_flatness double, snr_estimate_db double")
    assert pipeline.gold_gate(df).count() == 3
    assert pipeline.gold_gate(df, pipeline.Settings(enforce_gate=True)).count() == 1


def test_files(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text('{"url": "u", "platform": "tiktok", "error": "x"}\nbroken\n{"url": "v", "platform": "facebook"}\n')
    assert [r["url"] for r in landing.error_log(spark, str(tmp_path / "e.jsonl"), "tiktok").collect()] == ["u"]
    (tmp_path / "topics.json").write_text(json.dumps({"news": {"name": "n", "channels": ["@a"], "keywords": ["k1", "k2"]}}))
    assert [(r["ordinal"], r["query"]) for r in landing.topics(spark, str(tmp_path / "topics.json")).orderBy("ordinal").collect()] == [(0, "@a"), (1, "k1"), (2, "k2")]
    assert landing.table_or_empty(spark, str(tmp_path / "none"), "key string").count() == 0
    df = spark.createDataFrame([("a", datetime.date(2026, 8, 25), None), ("b", datetime.date(2026, 8, 20), "x")], "item_id string, d date, reject_reason string")
    good, bad = sinks.accepted_and_rejected(df)
    assert good.count() == bad.count() == 1
    sinks.write_records(sinks.extended(good), str(tmp_path / "out"), F.col("d"))
    assert glob.glob(f"{tmp_path}/out/week=2/crawl_date=2026-08-25/*.parquet")


def test_sessions_and_windows(spark):
    t = datetime.datetime
    df = spark.createDataFrame([(1, t(2024, 1, 1, 0, 0), 1, "a", 1.0), (2, t(2024, 1, 1, 0, 20), 1, "a", 1.0), (3, t(2024, 1, 1, 2, 0), 1, "b", None)], "event_id int, ts timestamp, user_id int, event_type string, value double")
    assert streams.sessions(df).count() == 2
    assert streams.tumbling(df).count() == 2
    assert streams.sliding(df).count() == 4


def test_stream_of_windows_has_the_last_and_the_late_ones(spark, tmp_path):
    t = datetime.datetime
    files = [[(1, t(2024, 1, 2, 0, 0), 1.25), (2, t(2024, 1, 2, 0, 50), None)], [(3, t(2024, 1, 1, 0, 10), 2.5), (4, t(2024, 1, 2, 0, 20), 0.5)], [(5, t(2024, 1, 2, 1, 59), None)]]
    for f in files:
        part = spark.createDataFrame([(i, ts, 1, "a", v, "{}") for i, ts, v in f], streams.EVENTS.replace("timestamp_ntz", "timestamp"))
        part.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    got = streams.tumbling_of_stream(spark, str(tmp_path), files_at_once=1)
    assert rows(got) == rows(streams.tumbling(spark.read.parquet(f"{tmp_path}/events.parquet"))) and got.count() == 3
    spark.createDataFrame([], streams.EVENTS).write.parquet(f"{tmp_path}/none/events.parquet")
    assert streams.tumbling_of_stream(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_stream_tumbling_equals_the_sql_of_the_table(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW events AS SELECT * FROM '/root/testdata/sf0.001/events.parquet'")
    want = con.execute(__spark_entry__.oracle_sql()["tumbling_events"]).fetchall()
    got = __spark_entry__.queries()["stream_tumbling"](spark, "/root/testdata/sf0.001").withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))
    near = lambda found: sorted((*r[:3], None if r[3] is None else round(r[3], 1)) for r in found)
    assert near(got.collect()) == near(want)


def test_registry_names_agree():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_core_stands_alone(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("phonoloom.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "phonoloom.llm", None)
    import phonoloom

    monkeypatch.delattr(phonoloom, "llm", raising=False)
    alone = importlib.reload(importlib.import_module("__spark_entry__"))
    assert alone.llm is None and alone.queries()
    monkeypatch.undo()
    importlib.reload(alone)


DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_some_queries_equal_their_sql(spark):
    import duckdb

    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    for name in ("stage_funnel", "seen_anti_join", "greedy_split", "content_classify", "session_events", "listing_left_join"):
        got = queries[name](spark, DATA)
        want = c.sql(sql[name])
        order = sorted(got.columns)
        assert order == sorted(want.columns), name
        mine = sorted(str(tuple(r[x] for x in order)) for r in got.collect())
        theirs = sorted(str(tuple(r)) for r in want.project(", ".join(f'"{x}"' for x in order)).fetchall())
        assert mine == theirs, name


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
