import numpy as np
import pytest
from pyspark.sql import functions as F

from phonoloom.llm import incremental as I

COLUMNS = "record_no bigint, batch_no int, item_id string, source_url string"


def brute(history, batches):
    """Batch by batch: records whose video, by chains of keys shared so far, was seen before; and repeats inside a batch."""
    out = set()
    for b in sorted({r[1] for r in batches}):
        out |= {no for no in whole(history, [r for r in batches if r[1] <= b]) if no in {r[0] for r in batches if r[1] == b}}
    return out


def whole(history, batches):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for _, _, keys, _ in history + batches:
        for k in keys:
            parent[find(keys[0])] = find(k)
    first, low = {}, {}
    for no, batch, keys, seg in history + batches:
        if keys:
            v = find(keys[0])
            first[v] = min(first.get(v, 99), batch)
            if no is not None:
                low[batch, v, seg] = min(low.get((batch, v, seg), 10**9), no)
    return {no for no, b, keys, seg in batches if keys and (first[find(keys[0])] < b or low[b, find(keys[0]), seg] < no)}


def made(rng, n, first_no, batches):
    rows = []
    for k in range(n):
        v, b = int(rng.integers(0, 120)), int(rng.choice(batches))
        number, short = f"{7 * 10**18 + v}", f"https://vt.vidtok.example/Z{v}/"
        item = rng.choice([f"tt_{number}_{k % 5:02d}", f"TT_{number}", f"{number}_{k % 5}", f"tt_{'%016x' % (v * 977 + 11)}_{k % 3:02d}", None])
        url = rng.choice([f"https://www.vidtok.example/@u/video/{number}", short, None, f"https://m.vidtok.example/v/{number}.html?x=1"])
        rows.append((first_no + k, b, item, url))
    return rows


def keyed(spark, rows):
    from phonoloom.llm.identity import with_video_keys

    df = with_video_keys(spark.createDataFrame(rows, COLUMNS)).collect()
    return [(r["record_no"], r["batch_no"], [k for k in (r["id_key"], r["address_key"]) if k], r["segment"]) for r in df]


def test_batches_against_brute_force(spark, tmp_path):
    """A backlog at once, and batches that come one by one: each looked up in what those before left."""
    rng = np.random.default_rng(5)
    old, new = made(rng, 40, 0, [0]), made(rng, 150, 1000, [1, 2, 3])
    df = spark.createDataFrame([(*r, "c") for r in new], COLUMNS + ", content string")
    history, batches = [(None, b, k, s) for _, b, k, s in keyed(spark, old)], keyed(spark, new)
    got = {r[0] for r in I.repeated_records(I.start_history(spark, f"file://{tmp_path}/a", spark.createDataFrame(old, COLUMNS)), df).collect()}
    assert got == whole(history, batches)
    step = I.start_history(spark, f"file://{tmp_path}/b", spark.createDataFrame(old, COLUMNS))
    got = {r[0] for b in (1, 2, 3) for r in I.repeated_records(step, df.where(F.col("batch_no") == b)).collect()}
    assert got == brute(history, batches) and list(step.commits()) == [0, 1, 2, 3]


def test_a_batch_taken_in_again_changes_nothing(spark, tmp_path):
    rng = np.random.default_rng(6)
    old, new = made(rng, 40, 0, [0]), made(rng, 80, 1000, [1, 2])
    h = I.start_history(spark, f"file://{tmp_path}/h", spark.createDataFrame(old, COLUMNS))
    df = spark.createDataFrame(new, COLUMNS)
    one, two = df.where("batch_no = 1"), df.where("batch_no = 2")
    first = sorted(r[0] for r in I.repeated_records(h, one).collect())
    # a run that failed before its commit leaves folders behind
    (tmp_path / "h" / "chunks" / "batch=2").mkdir()
    size = h.contents(h.commits()).count()
    assert sorted(r[0] for r in I.repeated_records(h, one).collect()) == first and h.contents(h.commits()).count() == size
    second = sorted(r[0] for r in I.repeated_records(h, two).collect())
    assert sorted(r[0] for r in I.repeated_records(h, two).collect()) == second and list(h.commits()) == [0, 1, 2]
    assert {*first, *second} == brute([(None, b, k, s) for _, b, k, s in keyed(spark, old)], keyed(spark, new))


def test_lines_are_cut_and_most_of_one_is_not_all(spark):
    line, near = "tt:7123456789012345678", "tt:7123456789012345679"
    df = lambda *x: spark.createDataFrame([(v,) for v in x], "content string")
    chunks = I.content_chunks(df(line), **I.LINE_CUT)
    assert chunks.count() > 1
    long, other = "a:host.example/" + "0123456789abcdef" * 6, "a:host.example/" + "0123456789abcdef" * 6 + "/x"
    got = {(r["content"], r["match"]) for r in I.covered(I.content_chunks(df(line, long), **I.LINE_CUT), I.content_chunks(df(line, near, other), **I.LINE_CUT), I.LINE_COVERAGE).collect()}
    assert (line, line) in got and (long, other) in got and (line, other) not in got


def test_nothing_in_nothing(spark, tmp_path):
    none = spark.createDataFrame([], COLUMNS)
    h = I.start_history(spark, f"file://{tmp_path}/h", none)
    assert list(h.commits()) == [0]
    assert I.repeated_records(h, none).count() == 0
    two = spark.createDataFrame([(1, 1, None, None), (2, 1, None, None), (3, 1, "tt_" + "7" * 19, None), (4, 1, "tt_" + "7" * 19, None), (5, None, "tt_" + "7" * 19, None)], COLUMNS)
    assert [r[0] for r in I.repeated_records(h, two).collect()] == [4]


@pytest.mark.parametrize("n", [0, 1, 23, 24, 25, 300, 5000])
def test_chunks_cover_the_content(n):
    data = np.random.default_rng(n).integers(97, 123, n).astype(np.uint8).tobytes()
    ends = I.chunk_ends(data)
    assert (ends[-1] == n if n else ends == []) and all(0 < b - a <= I.MOST for a, b in zip([0, *ends], ends))
    assert all(b - a >= I.LEAST for a, b in zip([0, *ends], ends[:-1]))


def test_boundaries_follow_the_content():
    data = np.random.default_rng(1).integers(97, 123, 20000).astype(np.uint8).tobytes()
    a, b = I.chunk_ends(data), I.chunk_ends(b"something before " + data)
    same = {e + 17 for e in a} & set(b)
    assert len(same) > 0.9 * len(a)


def test_coverage_finds_edited_texts(spark):
    rng = np.random.default_rng(2)
    text = " ".join(rng.choice(["mưa", "nắng", "gió", "sông", "núi", "làng", "chợ", "đò"]) + str(rng.integers(0, 999)) for _ in range(400))
    edited = text[:1500] + " thêm vài chữ " + text[1500:]
    other = " ".join(str(rng.integers(0, 10**6)) for _ in range(400))
    df = spark.createDataFrame([("old", text), ("far", other), ("none", None), ("empty", "")], "content string, t string")
    old = I.content_chunks(df, "content", "t")
    new = I.content_chunks(spark.createDataFrame([("new", edited)], "content string, t string"), "content", "t")
    got = I.covered(new, old, 0.8).collect()
    assert [(r["content"], r["match"]) for r in got] == [("new", "old")] and got[0]["shared"] <= got[0]["total"]
    assert I.covered(new, old.where(F.lit(False)), 0.8).count() == 0
