"""Percentiles, caps and mixing."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from phonoloom.llm import caps, mixing, percentiles


def test_percentiles_against_sorting(spark):
    rng = np.random.default_rng(2)
    rows = [("hot", float(x)) for x in rng.normal(10, 30, 3000)] + [("cold", 1.0), ("cold", 2.0), ("void", None), ("void", float("nan")), (None, 5.0), ("inf", float("inf"))]
    df = spark.createDataFrame([(*r, "m", 1) for r in rows], "g string, x double, metric string, bin int").select("g", "x")
    summary = percentiles.value_counts(df, ["g"], {"x": 0.5})
    got = {r["g"]: r for r in percentiles.percentiles(summary, ["g"], {"x": 0.5}).collect()}
    v = sorted(x for g, x in rows if g == "hot")
    for p in percentiles.PERCENTS:
        assert abs(got["hot"][f"p{p:02d}"] - v[math.ceil(len(v) * p / 100) - 1]) <= 0.25 + 1e-9
    assert got["cold"]["p50"] == 1.0 and got[None]["p99"] == 5.0
    assert (got["void"]["n"], got["void"]["n_missing"], got["void"]["p50"]) == (0, 2, None)
    assert got["inf"]["n_missing"] == 1


def test_summaries_add_up(spark):
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("g"), (F.col("id") % 2).alias("d"), (F.col("id") / 3).alias("x"))
    whole = percentiles.value_counts(df, ["g"], {"x": 0.01})
    parts = percentiles.value_counts(df.where("d = 0"), ["g"], {"x": 0.01}).unionByName(percentiles.value_counts(df.where("d = 1"), ["g"], {"x": 0.01}))
    a, b = (percentiles.percentiles(s, ["g"], {"x": 0.01}) for s in (whole, percentiles.combined(parts, ["g"])))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert percentiles.percentiles(whole.limit(0), ["g"], {"x": 0.01}).count() == 0


def test_rows_of_a_record_count_once(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), (None, 2.0), (None, 2.0)], "item_id string, x double")
    assert percentiles.records_once(df).count() == 3


def test_score_bytes_order(spark):
    values = [0.0, -0.0, 1.0, -1.0, 45.0, 44.99, 1e-310, -1e-310, 5e-324, float("inf"), float("-inf"), 1.7e308, -1.7e308, 0.1, 8.0, 7.999999999999999]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "s double").withColumn("k", caps.score_bytes("s"))
    ordered = [r["s"] for r in df.orderBy("k").collect()]
    assert ordered[:-2] == sorted(values, reverse=True)
    assert all(x is None or math.isnan(x) for x in ordered[-2:])
    keys = {r["s"]: r["k"] for r in df.where("s = 0").collect()}
    assert len(set(keys.values())) == 1


def plain_cap(rows, keep):
    best = {}
    for i, u, s in rows:
        if i is None or u is None:
            continue
        h = u.strip().lower().lstrip("@").strip()
        if not h:
            continue
        s = -math.inf if s is None or math.isnan(s) else s
        best[i] = max(best.get(i, (h, -math.inf)), (h, s), key=lambda x: x[1])
    by = {}
    for i, (h, s) in best.items():
        by.setdefault(h, []).append((-s, i))
    return {i for v in by.values() for _, i in sorted(v)[keep:]}


@pytest.mark.parametrize("keep", [0, 1, 5, 60])
def test_caps_against_sorting(spark, keep):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(900):
        u = rng.choice(["Anna", "anna ", "@ANNA", "bo", "c" + str(k % 90)])
        rows.append((f"tt_{k:04d}", str(u), float(rng.choice([45.0, 20.5, 20.25, np.nan, -3.0]))))
    rows += [("tt_0000", rows[0][1], rows[0][2]), ("n1", None, 1.0), ("n2", " @ ", 1.0), (None, "anna", 99.0), ("tt_x", "anna", None)]
    df = spark.createDataFrame([(*r, "c", "k") for r in rows], "item_id string, uploader string, snr_estimate_db double, contributor string, key string")
    got = [r[0] for r in caps.beyond_cap(df, keep, caps.handle()).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_cap(rows, keep)
    assert caps.beyond_cap(df.limit(0), keep, caps.handle()).count() == 0


def test_fill_gives_what_capped_sources_leave():
    s = [mixing.Source("a", 0.5, 1, 1, 100), mixing.Source("b", 0.3, 9, 1, 1000), mixing.Source("c", 0.2, 9, 1, 1000), mixing.Source("d", 0.4, 9, 0, 0)]
    mixing.fill(s, 1000)
    assert s[0].amount == 100 and s[1].amount == pytest.approx(540) and s[2].amount == pytest.approx(360) and s[3].amount == 0
    schedule = mixing.default_schedule(s)
    assert sum(w[0][1] for w in schedule.values()) == pytest.approx(1) and all(x >= -1e-12 for w in schedule.values() for _, x in w)


def test_mix(spark):
    docs = [(k, "một hai ba bốn " * (1 + k % 4), "big") for k in range(120)] + [(1000 + k, "xin chào", "small") for k in range(5)] + [(2000, None, "big"), (2001, "", "small"), (2002, "x", None), (2003, "x", "unwanted")]
    documents = spark.createDataFrame([(*d, "p", 1) for d in docs], "doc_id bigint, text string, source string, position string, time int")
    targets = spark.createDataFrame([("big", 0.5, 2), ("small", 0.3, 3), ("absent", 0.1, 5), ("odd", None, 1), ("unwanted", 0.0, 4), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    mixed, shares = mixing.mix(documents, targets)
    rows = mixed.orderBy("position").collect()
    assert rows[0]["position"] == 0 and all(b["position"] == a["position"] + a["n_tokens"] for a, b in zip(rows, rows[1:]))
    uses = {}
    for r in rows:
        uses[r["doc_id"]] = uses.get(r["doc_id"], 0) + 1
    assert max(v for k, v in uses.items() if k < 1000) <= 2 and max(v for k, v in uses.items() if 1000 <= k < 2000) == 3
    assert not {2000, 2001, 2002, 2003} & set(uses)
    got = {r["source"]: r for r in shares.collect()}
    assert got["absent"]["used_tokens"] == 0 and got["big"]["actual_share"] + got["small"]["actual_share"] == pytest.approx(1, abs=1e-5)
    assert mixing.mix(documents.limit(0), targets)[0].count() == 0
    assert mixing.mix(documents, targets.limit(0))[0].count() == 0


def test_schedule_moves_sources_in_time(spark):
    documents = spark.createDataFrame([(k, "một hai ba", "ab"[k % 2]) for k in range(400)], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    late = {"a": [(0.0, 1.0), (1.0, 0.0)], "b": [(0.0, 0.0), (1.0, 1.0)]}
    mixed, _ = mixing.mix(documents, targets, schedule=late)
    means = {r["source"]: r["m"] for r in mixed.groupBy("source").agg(F.avg("position").alias("m")).collect()}
    assert means["a"] < means["b"]


def test_share_of_exactly_counted_records(spark):
    df = spark.range(5000).selectExpr("lpad(id, 5, '0') item_id", "cast(id % 977 as double) snr_estimate_db", "'x' uploader").unionAll(spark.createDataFrame([("00001", 1.0, "x"), (None, 9.0, "x")], "item_id string, snr_estimate_db double, uploader string"))
    order = sorted(range(5000), key=lambda i: (-(i % 977), i))
    got = {r["item_id"] for r in caps.within_share(df, 0.5, F.col("uploader")).collect()}
    assert got == {f"{i:05d}" for i in order[2500:]}
