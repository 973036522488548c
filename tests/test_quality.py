import math

import numpy as np
from pyspark.sql import functions as F

from phonoloom.functions import scores, spectral
from phonoloom.operators import cache, dedup, quality, reconcile, segment
from phonoloom.plans import mastering
from phonoloom.sources import landing, sinks


def tone(hz, seconds=1.0, rate=16000, level=0.4):
    return (level * np.sin(2 * np.pi * hz * np.arange(int(seconds * rate)) / rate)).tolist()


def test_measures_tell_a_tone_from_noise(spark):
    noise = np.random.default_rng(0).normal(0, 0.1, 16000).tolist()
    df = spark.createDataFrame([(0, tone(440)), (1, noise), (2, []), (3, None)], "k int, x array<double>")
    got = {r["k"]: r["m"] for r in df.select("k", spectral.measures(F.col("x"), F.lit(16000.0)).alias("m")).collect()}
    assert got[0]["harmonic_ratio"] > 0.9 > 0.5 > got[1]["harmonic_ratio"]
    assert got[0]["flatness"] < 0.01 < 0.3 < got[1]["flatness"] and got[0]["contrast"] > got[1]["contrast"]
    assert abs(got[0]["zcr"] - 880 / 16000) < 0.002 and got[2]["flatness"] is None and got[3]["zcr"] is None


def test_prosody(spark):
    two = sum((tone(120 if k % 2 else 280, 0.16) for k in range(16)), [])
    df = spark.createDataFrame([(0, tone(200)), (1, two), (2, [0.0] * 16000), (3, None)], "k int, x array<double>")
    got = {r["k"]: r["p"] for r in df.select("k", spectral.prosody(F.col("x"), F.lit(16000.0)).alias("p")).collect()}
    assert abs(got[0]["pitch_mean"] - 200) < 5 and got[0]["pitch_std"] < 5 and not got[0]["is_multispeaker"]
    assert got[1]["is_multispeaker"] and got[1]["pitch_std"] > 38
    assert tuple(got[2]) == tuple(got[3]) == (0.0, 0.0, False, 0)


def test_pitches_against_plain_correlation():
    x = np.random.default_rng(1).normal(0, 0.05, 8000) + np.array(tone(150, 0.5))
    size, hop, want = 640, 1280, []
    for i in range(0, len(x) - size, hop):
        w = x[i : i + size]
        c = [float(w[: size - k] @ w[k:]) for k in range(201)]
        k = 45 + int(np.argmax(c[45:200]))
        if max(abs(w)) >= 0.02 and c[k] > 0.3 * c[0]:
            want.append(16000 / k)
    assert np.allclose(spectral._pitches(x, 16000.0), want)


def test_loudness_and_mastering(spark):
    df = spark.createDataFrame([(0, tone(997, 3.0, level=1.0)), (1, tone(997, 3.0, level=0.01)), (2, [0.0] * 16000), (3, None), (4, [])], "k int, x array<double>")
    rate = F.lit(16000.0)
    rows = df.withColumn("y", spectral.treated(spectral.mastered())(F.col("x"), rate))
    got = {r["k"]: r for r in rows.select("k", spectral.loudness(F.col("x"), rate).alias("before"), spectral.loudness(F.col("y"), rate).alias("after"), F.size("y").alias("n")).collect()}
    assert abs(got[0]["before"] + 3.01) < 0.2  # a full-scale tone at 997 Hz
    assert abs(got[0]["after"] + 16) < 0.1 and abs(got[1]["after"] + 16) < 0.1
    assert got[2]["before"] is None and got[2]["n"] == 16000 and got[3]["before"] is None and got[4]["n"] == 0


def test_filters():
    x = np.array(tone(40, 2.0)) + np.array(tone(1000, 2.0))
    y = spectral.band_pass(x, 16000.0, 75.0, 7600.0)
    assert abs(y.std() - np.std(tone(1000, 2.0))) < 0.01
    louder = spectral.equalized(np.array(tone(3000)), 16000.0, 3000.0, 1.0, 6.0)
    assert abs(20 * math.log10(louder.std() / np.std(tone(3000))) - 6) < 0.1
    rng = np.random.default_rng(2)
    gate = np.repeat(np.arange(20) % 2, 1600)
    noisy = rng.normal(0, 0.01, 32000) + np.array(tone(500, 2.0)) * gate
    clean = spectral.denoised(noisy, 16000.0, 18.0)
    assert clean[gate == 0].std() < 0.6 * noisy[gate == 0].std() and clean[gate == 1].std() > 0.9 * noisy[gate == 1].std()
    assert len(spectral.voice_mask(noisy, 16000.0)) == len(noisy)
    assert np.allclose(spectral._masked(noisy, np.ones_like), noisy, atol=1e-9)


def test_silences(spark):
    x = [0.5] * 8 + [0.0] * 8 + [0.5] + [0.0] * 4 + [0.5] + [0.0] * 16
    df = spark.createDataFrame([(x,), (None,), ([],), ([0.0] * 16,)], "x array<double>")
    got = [[tuple(s) for s in r[0]] for r in df.select(spectral.silences(F.col("x"), F.lit(16.0))).collect()]
    assert got == [[(0.5, 1.0, 0.75), (22 / 16, 38 / 16, 1.875)], [], [], [(0.0, 1.0, 0.5)]]


def test_music_windows(spark):
    df = spark.createDataFrame([(0.0,), (15.0,), (20.0,), (20.12,), (30.0,), (100.0,), (None,), (float("nan"),)], "d double")
    got = [r[0] for r in df.select(scores.music_windows(F.col("d"))).collect()]
    assert got[:3] == [[0.0]] * 3 and got[4] == [0.0, 5.0, 10.0] and got[5] == [0.0, 40.0, 80.0] and got[6:] == [[], []]
    assert len(got[3]) == 3 or len(got[3]) == 2


def test_synthetic_without_a_pitch(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 9.0, 5.0), (None, 0.0, 0.0, 1.0, 5.0), (0.1, 1.0, 99.0, 1.0, 5.0), (0.0, 0.0, 0.0, 9.0, 1.0)], "j double, f double, m double, p double, s double")
    got = [round(r[0], 6) for r in df.select(scores.synthetic(*map(F.col, "jfmps"))).collect()]
    assert got == [round(0.85 + 0.15 * 0.75, 6), 0.75, 0.0, 0.0]


def test_gates_and_states(spark):
    df = spark.createDataFrame([(True, "rõ lắm", -0.4, 0.2), (True, "rõ", -0.4, 0.2), (True, "rõ lắm", -0.75, 0.5), (True, " ", -0.1, 0.1), (None, "rõ lắm", -0.1, 0.1), (True, "rõ lắm", None, None)], "s boolean, t string, l double, n double")
    s, t, lp, n = map(F.col, "stln")
    got = [tuple(r) for r in df.select(scores.transcript_grade(s, t, lp, n), scores.is_good_quality(s, t, lp, n), scores.speech_post_gate(t, lp, n)).collect()]
    assert got == [("good", True, None), ("good", False, None), ("degraded", False, "low_quality"), ("none", False, "empty_transcript"), ("none", False, None), ("none", False, None)]
    rows = [(True, None, None, None, 0, None), (False, True, False, False, 2, "x"), (False, None, None, None, 0, None), (False, True, True, False, 1, None), (False, True, False, True, 1, None), (False, True, False, False, 0, None), (False, True, None, None, 2, None)]
    states = spark.createDataFrame(rows, "d boolean, f boolean, s boolean, r boolean, n int, e string").select(scores.terminal_status(*map(F.col, "dfsrne")).alias("status"))
    assert [r[0] for r in states.collect()] == ["skipped", "error", "rejected", "skipped", "rejected", "rejected", "done"]
    assert tuple(quality.run_stats(states).first()) == (7, 1, 2, 3, 1)
    assert tuple(quality.run_stats(states.limit(0)).first()) == (0, 0, 0, 0, 0)


def test_cleaning(spark):
    rows = [("b", "x", False, 3600.0), ("a", "x", True, 1.0), ("c", "x", False, 5.0), ("d", None, False, 5.0), ("e", "y", None, float("nan"))]
    df = spark.createDataFrame(rows, "k string, c string, low boolean, duration_seconds double")
    out = quality.cleaned(df, "k", "c", F.col("low"))
    assert {r["k"]: (r["reason"], r["original"]) for r in out.collect()} == {"a": ("low_voice", None), "b": (None, None), "c": ("duplicate", "b"), "d": ("unreadable", None), "e": (None, None)}
    assert tuple(quality.quality_summary(out).first())[1:] == (5, 2, 1.0, 1, 1, "40.0%")
    assert quality.quality_summary(out.limit(0)).first()["qc_passed_rate"] == "0.0%"


def test_greedy_merge_holds_over_batches(spark):
    rng = np.random.default_rng(5)
    rows = [(int(k), float(t), float(t + d)) for k, t, d in zip(rng.integers(0, 3, 3000), rng.integers(0, 10**6, 3000), rng.integers(1, 500, 3000))] + [(1, None, 3.0), (None, 1.0, 9.0)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = sorted(map(tuple, segment.greedy_merge(spark.createDataFrame(rows, "k int, start double, end double"), ["k"], 3.0, 900.0).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = []
    for key in (0, 1, 2, None):
        held = None
        for _, a, b in sorted((r for r in rows if r[0] == key and r[1] is not None), key=lambda r: r[1:]):
            if held and b - held[1] <= 900:
                held = (key, held[1], b)
                continue
            want += [held] if held and held[2] - held[1] >= 3 else []
            held = (key, a, b)
        want += [held] if held and held[2] - held[1] >= 3 else []
    assert got == sorted(want, key=str)


def test_joined_stretches(spark):
    df = spark.createDataFrame([([(0.0, 1.0), (1.2, 2.0), (3.0, 3.1)],), ([],)], "s array<struct<start: double, end: double>>")
    got = [[tuple(p) for p in r[0]] for r in df.select(segment.joined_stretches(F.col("s"), 0.25, 0.5)).collect()]
    assert got == [[(0.0, 2.0)], []]


def test_largest_and_as_of_against_plain(spark):
    rng = np.random.default_rng(6)
    rows = [(int(k), int(v), n) for n, (k, v) in enumerate(zip(rng.integers(0, 3, 400) ** 2, rng.integers(0, 50, 400)))]
    got = dedup.largest(spark.createDataFrame(rows, "k int, v int, n int"), ["k"], [F.col("v").desc(), F.col("n")], 5).collect()
    want = [r for k in {r[0] for r in rows} for r in sorted((r for r in rows if r[0] == k), key=lambda r: (-r[1], r[2]))[:5]]
    assert sorted(map(tuple, got)) == sorted(want)
    left = [(int(k), f"2024-01-01 {h:02d}:{m:02d}:00", n) for n, (k, h, m) in enumerate(zip(rng.integers(0, 2, 60), rng.integers(0, 24, 60), rng.integers(0, 60, 60)))] + [(None, "2024-01-01 00:00:00", -1)]
    right = [(int(k), f"2024-01-01 {h:02d}:{m:02d}:00", f"v{n}") for n, (k, h, m) in enumerate(zip(rng.integers(0, 2, 12), rng.integers(0, 24, 12), rng.integers(0, 60, 12)))]
    a = spark.createDataFrame(left, "k int, t string, n int").withColumn("t", F.to_timestamp("t"))
    b = spark.createDataFrame(right, "k int, t string, v string").withColumn("t", F.to_timestamp("t"))
    got = {r["n"]: r["v"] for r in reconcile.as_of(a, b, "k", "t", "v").collect()}
    for k, t, n in left:
        before = [(u, v) for j, u, v in right if j == k and u <= t]
        assert got[n] == (max(before)[1] if before else None) or len({v for u, v in before if u == max(before)[0]}) > 1


def test_sounds_of_every_width(spark):
    import io
    import wave

    def sound(width, channels=1):
        x = [0.5, -0.5, 0.25, 0.0]
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(channels)
            w.setsampwidth(width)
            w.setframerate(8000)
            raw = b"".join((int(v * 127) + 128).to_bytes(1, "little") if width == 1 else int(v * (2 ** (8 * width - 1) - 1)).to_bytes(width, "little", signed=True) for v in x for _ in range(channels))
            w.writeframes(raw)
        return bytearray(out.getvalue())

    df = spark.createDataFrame([(w, c, sound(w, c)) for w in (1, 2, 3, 4) for c in (1, 2)], "w int, c int, content binary")
    for r in df.select("w", landing.decode_sound(F.col("content")).alias("s")).collect():
        assert r["s"]["sample_bytes"] == r["w"] and np.allclose(r["s"]["samples"], [0.5, -0.5, 0.25, 0.0], atol=0.01)


def test_versioned_tables(spark, tmp_path):
    seen = sinks.SeenSet(spark, str(tmp_path / "seen"))
    assert seen.read().count() == 0
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "item_id string")
    seen.add(ids("tt_123456789012345_01", None))
    seen.add(ids("fb_5"))
    assert [r[0] for r in seen.read().collect()] == sorted({"tt_123456789012345_01", "tt_123456789012345", "fb_5"} | {r[0] for r in seen.read().collect()})
    log = sinks.Versioned(spark, str(tmp_path / "log"), landing.ERROR_SCHEMA)
    log.replace(spark.createDataFrame([("a", "1", "tiktok", "x", None), ("b", "2", "tiktok", "", None), (None, "3", None, None, None)], landing.ERROR_SCHEMA))
    sinks.rewrite_errors(log, spark.createDataFrame([("a",)], "url string"))
    assert sorted(r["item_id"] for r in log.read().collect()) == ["2", "3"]
    held = cache.TranscriptCache(spark, str(tmp_path / "cache"))
    made = []

    def make(keys):
        made.append(keys.count())
        return keys.withColumn("transcript", F.col("path"))

    ask = spark.createDataFrame([("d/1", "m", 1.0), ("d/2", "m", 1.0), (None, "m", 1.0)], "path string, model string, max_seconds double")
    assert held.get(ask, make).count() == held.get(ask, make).count() == 2 and made == [2]
    held.invalidate("d/1")
    assert held.read().count() == 1


def test_sources(spark, tmp_path):
    known = spark.createDataFrame([("https://h/@a/", "https://h/@a/video/1"), ("https://h/@a", "https://h/@a/video/2")], "channel string, video_url string")
    lines = spark.createDataFrame([("https://h/@a?x=1",), ("https://h/@b",), ("https://h/@a/video/9",)], "url string")
    assert sorted(r[0] for r in landing.expanded(lines, known).collect()) == ["https://h/@a/video/1", "https://h/@a/video/2", "https://h/@a/video/9", "https://h/@b"]
    parts = [spark.createDataFrame([("b",), ("a",), (None,)], "url string"), spark.createDataFrame([("a",), ("c",)], "url string")]
    assert [r[0] for r in landing.channel_listing(parts).collect()] == ["a", "b", "c"] and [r[0] for r in landing.channel_listing(parts, 2).collect()] == ["a", "b"]
    folders = [spark.createDataFrame([("x", 1)], "name string, n int"), spark.createDataFrame([("x", 2), ("y", 3)], "name string, n int")]
    assert sorted(map(tuple, landing.merged_folders(folders).collect())) == [("x", 1), ("y", 3)]
    (tmp_path / "a.wav").write_bytes(b"12345")
    (tmp_path / "b.txt").write_bytes(b"1")
    assert [tuple(r)[1:] for r in landing.listing(spark, str(tmp_path)).collect()] == [(5, "a")]
    (tmp_path / "Week1" / "d").mkdir(parents=True)
    (tmp_path / "Week1" / "d" / "metadata.json").write_text('[{"item_id": "a", "duration_seconds": 2.5}]')
    (tmp_path / "Week1" / "e").mkdir()
    (tmp_path / "Week1" / "e" / "metadata.json").write_text('[{"item_id": ')
    assert [(r["item_id"], r["duration_seconds"]) for r in landing.record_files(spark, str(tmp_path / "Week*/*/metadata.json")).collect()] == [("a", 2.5)]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part.parquet").write_bytes(b"no table")
    assert landing.table_or_empty(spark, str(tmp_path / "t"), "key string").count() == landing.table_or_empty(spark, str(tmp_path / "no"), "key string").count() == 0


def test_sinks_keep_types_and_extras(spark):
    df = spark.createDataFrame([("a", "x")], "item_id string, title string")
    spec = sinks.spec_columns(df)
    assert dict(spec.dtypes)["platform_meta"].startswith("struct") and dict(spec.dtypes)["posted_at"] == "timestamp" and spec.columns == sinks.SPEC
    row = sinks.extended(df, {"title": F.lit(None).cast("string"), "snr_db": F.lit(3.0)}).first()
    assert (row["title"], row["snr_db"], row["legal_license"]) == ("x", 3.0, "research_only")
    assert sinks.gold_columns(df).first()["label"] == "research_only"


def test_mastering(spark):
    rows = [(tone(300, 0.5), 16000.0, "nghe rõ", -0.2, 0.1), (tone(300, 0.5), 16000.0, "mờ", -0.9, 0.4), (None, 16000.0, None, None, None), ([], 16000.0, "rõ", -0.1, 0.1)]
    df = spark.createDataFrame(rows, "samples array<double>, sample_rate double, transcript string, avg_logprob double, no_speech_prob double")
    got = mastering.master(df).collect()
    assert [(r["raw_quality"], r["passed"], r["reason"]) for r in got] == [("good", True, None), ("degraded", False, "low_quality"), ("none", False, "empty_transcript"), ("good", True, None)]
    assert got[0]["stages_applied"][1] == "separation_skipped" and got[1]["stages_applied"][2] == "denoise(full)" and got[2]["mastered"] is None
    loaded = mastering.Loaded("half", lambda: 0.5, lambda model, x, rate: np.asarray(x) * model)
    out = df.limit(1).select(loaded.column(F.col("samples"), F.col("sample_rate")).alias("y")).first()["y"]
    assert np.allclose(out, np.array(rows[0][0]) / 2)
    cascade = mastering.master(df, mastering.Stages(cascade=[loaded, loaded])).collect()
    assert cascade[1]["stages_applied"][1] == "separation(half+half)"
