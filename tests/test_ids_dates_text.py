import datetime

from pyspark.sql import functions as F

from phonoloom.functions import classify, dates, ids, lexicons, text
from phonoloom.sources import landing


def one(df):
    return df.first()[0]


def col(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def values(df):
    return [r[0] for r in df.collect()]


def test_video_ids(spark):
    df = col(spark, ["https://h/@user/video/7123456789012345678", "https://h/@user/photo/7123456789012345678", "https://h/nothing", None])
    assert values(df.select(ids.tiktok_id(F.col("x")))) == ["tt_7123456789012345678", None, None, None]
    df = col(spark, ["https://h/reel/123456789012345", "https://h/watch/?v=123456789012345", "https://h/x/videos/vb.1/123456789012345"])
    assert values(df.select(ids.facebook_id(F.col("x")))) == ["fb_123456789012345"] * 3
    assert values(df.select(ids.facebook_kind(F.col("x")))) == ["reel", "video", "video"]


def test_address_id_takes_number_or_digest(spark):
    df = col(spark, ["https://h/a/123456789/?q=1", "https://h/abc"])
    got = values(df.select(ids.address_id(F.col("x"))))
    assert got[0] == "tt_123456789" and len(got[1]) == 19


def test_parts_of_an_id(spark):
    df = col(spark, ["tt_7123456789012345678_01", "fb_123456789012345", "tt_123", "7123456789012345678_003"])
    assert values(df.select(ids.base_id(F.col("x")))) == ["tt_7123456789012345678", "fb_123456789012345", "tt_123", "7123456789012345678"]
    assert values(df.select(ids.platform(F.col("x")))) == ["tiktok", "facebook", "tiktok", "unknown"]


def test_addresses_in_messages(spark):
    df = col(spark, ["xem https://www.vidtok.example/@a/video/1 va\nHTTPS://fbclips.example/reel/2 https://other.example/3", None, ""])
    assert values(df.select(F.size(F.coalesce(ids.addresses_in(F.col("x"), ("vidtok.example", "fbclips.example")), F.array())))) == [2, 0, 0]


def test_weeks(spark):
    df = col(spark, [datetime.date(2026, 8, 20), datetime.date(2026, 8, 24), datetime.date(2026, 8, 31)], "date")
    assert values(df.select(dates.week_number(F.col("x")))) == [1, 2, 3]
    assert values(df.select(dates.day_folder(F.col("x"))))[1] == "Week2/2026-08-24/audio"


def test_subtitle_time_cuts_milliseconds(spark):
    df = col(spark, [0.0, 3661.9999, None, -1.0, float("nan")], "double")
    assert values(df.select(dates.subtitle_time(F.col("x")))) == ["00:00:00,000", "01:01:01,999", None, None, None]


def test_word_count(spark):
    df = col(spark, [None, "", "   ", "a b", "a b　c\n"])
    assert values(df.select(text.word_count(F.col("x")))) == [0, 0, 0, 2, 3]


def test_phrase_score_boundaries_and_cap(spark):
    lexicon = [("chốt đơn", 3.0)]
    df = col(spark, ["chốt đơn chốt đơn, chốt đơn", "(chốt đơn)", "chốt  đơn", "Chốt đơn!", "#chốt đơn", None]).withColumn("p", text.padded(F.col("x")))
    assert values(df.select(text.phrase_score(F.col("p"), lexicon))) == [6.0, 0.0, 0.0, 3.0, 0.0, 0.0]


def content(spark, transcript, title=""):
    df = spark.createDataFrame([(transcript, title)], "t string, h string").withColumn("p", classify.content_text(F.col("t"), F.col("h")))
    return df.select(classify.content_class(F.col("t"), classify.content_scores(F.col("p"))).alias("c")).first()["c"]


def test_content_ladder(spark):
    assert content(spark, None)["category"] == "TRANSCRIPT_QUA_NGAN"
    assert content(spark, "chơi tài xỉu đi mọi người")["category"] == "SPAM_CO_BAC_DOC_HAI"
    assert content(spark, "chốt đơn đi chốt đơn đi nào")["action"] == "REJECT"
    assert content(spark, "hôm nay biến hình nhạc nền hay")["category"] == "NHAC_TREND_VO_NGHIA"
    assert content(spark, "phóng viên ghi nhận tại hiện trường")["category"] == "TIN_TUC_THOI_SU"
    assert content(spark, "tòa án mở phiên xử")["category"] == "PHAP_LUAT"
    assert content(spark, "hôm nay trời đẹp quá")["category"] == "HOI_THOAI_DOI_SONG"
    assert content(spark, "một hai ba", "chốt đơn")["category"] == "QUANG_CAO_TIEP_THI"  # a title counts twice


def region(spark, title, forced=None, channel=""):
    df = spark.createDataFrame([(title, forced, channel)], "t string, f string, c string").withColumns({"w": text.worded(F.col("t")), "l": F.lower("t")})
    scores = classify.text_region_scores(F.col("w"), F.col("l"))
    known = classify.channel_region(F.col("c"))
    held = df.select("f", *[(scores[r] + F.coalesce(F.when(known == r, F.lit(3.0)), F.lit(0.0))).alias(r) for r in lexicons.REGIONS])
    return one(held.select(classify.region_class({r: F.col(r) for r in lexicons.REGIONS}, F.col("f"))))


def test_regions(spark):
    assert region(spark, "đi ăn phở hà nội nhé") == "northern"
    assert region(spark, "bữa nay nhậu nghen") == "southern"
    assert region(spark, "mần chi rứa hè") == "central"
    assert region(spark, "xin chào") == "mixed"
    assert region(spark, "đi nhé", forced="SOUTHERN") == "southern"
    assert region(spark, "", channel="@htv9") == "southern"


def test_error_retry(spark):
    df = col(spark, ["HTTP Error 404 not found", "connection reset", None, ""])
    assert values(df.select(classify.retryable(F.col("x")))) == [False, True, True, True]


def test_manifest(spark, tmp_path):
    (tmp_path / "m.txt").write_text("﻿https://a/video/1\n# c\n\n  https://a/video/2  \nhttps://a/photo/3\n #x\n", encoding="utf-8")
    got = values(landing.manifest(spark, str(tmp_path / "m.txt")))
    assert got == ["https://a/video/1", "https://a/video/2", "#x"]
    assert values(landing.manifest(spark, str(tmp_path / "m.txt"), limit=1)) == ["https://a/video/1"]
    assert len(values(landing.manifest(spark, str(tmp_path / "m.txt"), photos=True))) == 4
