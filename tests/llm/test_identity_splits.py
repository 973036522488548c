import numpy as np
from pyspark.sql import functions as F

from phonoloom.llm import splits
from phonoloom.llm.identity import with_video_keys

N = "7433901544671112778"
S = "123456789012345"


def keys(spark, item_id, url):
    df = spark.createDataFrame([(item_id, url, "clash")], "item_id string, source_url string, _parts string")
    r = with_video_keys(df.drop("_parts")).first()
    return r["id_key"], r["address_key"], r["segment"]


def test_keys_however_written(spark):
    v = f"tt:{N}"
    assert keys(spark, f"tt_{N}_01", f"https://www.vidtok.example/@a/video/{N}") == (v, v, 1)
    assert keys(spark, f"TT_{N}", f"HTTPS://WWW.VIDTOK.EXAMPLE/@a/video/{N}?t=1#c{S}") == (v, v, None)
    assert keys(spark, f"{N}_003", f"https://m.vidtok.example/v/{N}.html") == (v, v, 3)
    assert keys(spark, f"{N}_003", None) == (None, None, 3)
    assert keys(spark, f"fb_{S}", f"https://www.fbclips.example/watch/?v={S}&ref_id={N}") == (f"fb:{S}", f"fb:{S}", None)
    assert keys(spark, f"tt_{S}_1", f"https://www.vidtok.example/%40a/video/{S}/share-12345") == (f"tt:{S}", f"tt:{S}", 1)
    assert keys(spark, "tt_ad5c83e07a81285c_04", "https://vt.vidtok.example/Zdn8f/") == (None, "a:vt.vidtok.example/Zdn8f", 4)
    assert keys(spark, "x", f"https://www.vidtok.example/@{N}/profile?id={N}#{N}")[1] == f"a:vidtok.example/@{N}/profile"
    assert keys(spark, None, None) == (None, None, None)
    assert keys(spark, "", "")[:2] == (None, None)
    assert keys(spark, "tt_" + "9" * 400, "x" * 5000)[0] is None


def groups(spark, rows):
    df = spark.createDataFrame([(*r, "c") for r in rows], "item_id string, source_url string, component string")
    return {r["item_id"]: r["group_id"] for r in splits.video_groups(df).collect()}


def test_chains_of_ids_and_addresses(spark):
    short = "https://vt.vidtok.example/Zq/"
    got = groups(spark, [(f"tt_{N}_01", None), (f"tt_{N}_01", None), ("tt_ad5c83e07a81285c_02", short), ("tt_bbbbbbbbbbbbbbbb_03", f"https://vidtok.example/@u/video/{N}"), (f"{N}_04", short), ("fb_" + S, None), ("tt_" + S, None), (None, short)])
    assert got == {i: f"{N}_04" for i in (f"tt_{N}_01", "tt_ad5c83e07a81285c_02", "tt_bbbbbbbbbbbbbbbb_03", f"{N}_04")}
    assert groups(spark, []) == {}


def test_splits_keep_videos_together_and_near_the_targets(spark):
    rng = np.random.default_rng(0)
    rows = []
    for v in range(1500):
        number = f"{10**18 * 7 + v}"
        for k in range(int(rng.pareto(1.3)) + 1):
            rows.append((f"tt_{number}_{k:02d}", f"https://vidtok.example/@u/video/{number}", rng.choice(["demucs", "none", "DEMUCS ", None, "melband"])))
    df = spark.createDataFrame(rows, "item_id string, source_url string, separation_model string")
    records, chosen = splits.split_records(df, (0.8, 0.1, 0.1))
    assert records.count() == len(rows)
    assert records.groupBy("component").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    n = {r["split"]: r["count"] for r in records.groupBy("split").count().collect()}
    for name, share in zip(splits.SPLITS, (0.8, 0.1, 0.1)):
        assert abs(n[name] / len(rows) - share) < 0.01
    again, _ = splits.split_records(df, (0.8, 0.1, 0.1))
    assert records.join(again.withColumnRenamed("split", "other"), "item_id").where("split <> other").count() == 0


def test_one_video_with_most_records(spark):
    rows = [(f"tt_{N}_{k}", None, "none") for k in range(300)] + [(f"tt_{10**18 * 7 + k}_1", None, "none") for k in range(300)]
    records, _ = splits.split_records(spark.createDataFrame(rows, "item_id string, source_url string, separation_model string"), (0.8, 0.1, 0.1))
    n = {r["split"]: r["count"] for r in records.groupBy("split").count().collect()}
    assert n["train"] == 480 and n["validation"] == n["test"] == 60


def test_splits_of_nothing(spark):
    records, _ = splits.split_records(spark.createDataFrame([], "item_id string, source_url string, separation_model string"))
    assert records.count() == 0
