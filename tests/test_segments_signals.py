import math

import numpy as np
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from phonoloom.functions import signal
from phonoloom.operators import segment
from phonoloom.sources import landing


def plain_split(total, mids, least, most):
    cur, out = 0.0, []
    while cur < total:
        rest = total - cur
        if rest <= most:
            if rest >= least:
                out.append((cur, total))
            break
        ahead = [m for m in mids if cur + least <= m <= cur + most]
        cut = ahead[-1] if ahead else cur + most
        out.append((cur, cut))
        cur = cut
    return [(round(a, 3), round(b, 3)) for a, b in out]


def plain_merge(intervals, least, most):
    out, a, b = [], None, None
    for s, e in intervals:
        if a is None:
            a, b = s, e
        elif e - a <= most:
            b = e
        else:
            if b - a >= least:
                out.append((a, b))
            a, b = s, e
    if a is not None and b - a >= least:
        out.append((a, b))
    return out


def test_greedy_split_against_a_loop(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(120):
        total = float(rng.integers(1, 2000) / 8)
        mids = sorted(float(x) for x in rng.integers(1, int(total * 8) + 2, size=int(rng.integers(0, 30))) / 8)
        rows.append((total, mids))
    rows += [(3.0, []), (20.0, []), (20.125, [10.0]), (2.9, [1.0]), (None, [1.0]), (float("nan"), [])]
    df = spark.createDataFrame(rows, "total double, mids array<double>")
    got = df.select("total", "mids", segment.greedy_split(F.col("total"), F.col("mids"), 3.0, 20.0).alias("p")).collect()
    for r in got:
        usable = r["total"] is not None and not math.isnan(r["total"])
        want = plain_split(r["total"], r["mids"], 3.0, 20.0) if usable else []
        assert [(p["start"], p["end"]) for p in r["p"]] == want


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 200), st.integers(1, 40)), max_size=25))
def test_greedy_merge_against_a_loop(spark, raw):
    intervals = sorted((float(a), float(a + d)) for a, d in raw)
    df = spark.createDataFrame([("a", *i) for i in intervals], "k string, start double, end double")
    got = segment.greedy_merge(df, ["k"], 3.0, 15.0).collect()
    assert sorted((p["start"], p["end"]) for p in got) == plain_merge(intervals, 3.0, 15.0)


def test_padding_keeps_numbers_of_dropped_pieces(spark):
    df = spark.createDataFrame([("a", 30.0, [(0.0, 10.0), (10.0, 12.0), (12.0, 30.0)])], "item_id string, total double, pieces array<struct<start:double,end:double>>")
    got = segment.padded_pieces(df, "total", "pieces", 3.0).orderBy("segment_index").collect()
    assert [(r["segment_index"], r["total_segments"], r["start_sec"], r["end_sec"]) for r in got] == [(1, 3, 0.0, 10.25), (3, 3, 11.8, 30.0)]


def test_gaps_and_speakers(spark):
    rows = [("a", 0.0, 1.0), ("a", 1.2, 2.0), ("a", 4.0, 5.0), ("a", 5.1, 6.0), ("b", 0.0, 1.0), ("b", None, 2.0)]
    df = spark.createDataFrame(rows, "k string, start double, end double")
    assert [(r["k"], r["mid"]) for r in segment.silence_gaps(df, ["k"], 0.35).collect()] == [("a", 3.0)]
    kinds = {r["k"]: r["speaker_type"] for r in segment.speaker_type(df, ["k"]).collect()}
    assert kinds == {"a": "dialogue", "b": "monologue"}
    pairs = spark.createDataFrame([([1.0, 5.0, 9.0], [2.0, 4.0])], "a array<double>, b array<double>")
    assert [(g["start"], g["mid"]) for g in pairs.select(segment.paired_silences(F.col("a"), F.col("b")).alias("g")).first()["g"]] == [(1.0, 1.5)]


def test_quality_of_a_signal(spark):
    t = np.arange(32000) / 16000
    x = np.where(t < 1.2, 0.5 * np.sin(2 * np.pi * 300 * t) + 0.3 * np.sin(2 * np.pi * 1000 * t), 1e-4 * np.sin(2 * np.pi * 5000 * t))
    df = spark.createDataFrame([(x.tolist(),), ([],), (None,)], "x array<double>")
    e = signal.energies(signal.frames(F.col("x"), 480, 240))
    noise, speech = signal.noise_and_speech(e)
    rows = df.select(signal.snr_db(noise, speech).alias("snr"), signal.speech_ratio(e, noise).alias("ratio"), signal.dbfs(signal.peak(F.col("x"))).alias("peak")).collect()
    assert rows[0]["snr"] > 5 and rows[0]["ratio"] > 0 and rows[0]["peak"] < 0
    assert rows[1]["snr"] is None


def test_fingerprints_and_flatness(spark):
    t = np.arange(2000) / 16000
    tone, other = (0.4 * np.sin(2 * np.pi * 440 * t)).tolist(), (0.4 * np.sin(2 * np.pi * 660 * t)).tolist()
    noise = np.random.default_rng(0).normal(0, 0.1, 2000).tolist()
    df = spark.createDataFrame([(tone,), (tone,), (other,), (noise,)], "x array<double>")
    h = [r[0] for r in df.select(signal.pcm_fingerprint(F.col("x"))).collect()]
    assert h[0] == h[1] != h[2]
    flat = [r[0] for r in df.select(signal.spectral_flatness("x")).collect()]
    assert flat[0] < flat[3]


def test_sound_files(spark):
    df = spark.createDataFrame([([0.0, 0.5, -0.5],), (None,)], "x array<float>")
    files = df.select(landing.encode_sound(F.col("x")).alias("content")).unionByName(spark.createDataFrame([(bytearray(b"no sound"),)], "content binary"))
    got = files.select(landing.decode_sound(F.col("content")).alias("s")).collect()
    assert got[0]["s"]["sample_rate"] == 16000 and len(got[0]["s"]["samples"]) == 3
    assert got[1]["s"] is None and got[2]["s"] is None
