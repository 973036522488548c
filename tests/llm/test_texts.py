"""Look-alike text, encoding, near copies."""

import itertools
import random
import unicodedata

import numpy as np
import pytest

from phonoloom.llm import encoding, lookalike, neardup

PLAIN = "Nhà tôi ở thôn Láng Dừa có bảy người, ai cũng thích bún riêu với cơm cháy. Chuyện là cô giáo quên chiếc ghe nhỏ."


@pytest.fixture(scope="module")
def scores():
    from collections import Counter

    low = f" {PLAIN.lower()} "
    return lookalike.NgramScores({k: float(v) for k, v in Counter(zip(low, low[1:])).items()})


@pytest.mark.parametrize(
    "text, want",
    [
        ("ոhà", "nhà"),
        ("сhợ ðúng Кhe cháο", "chợ đúng Khe cháo"),
        (unicodedata.normalize("NFD", "tiếng Việt"), "tiếng Việt"),
        ("ｎｈà　tôi ở đây", "nhà tôi ở đây"),
        ("𝗁𝖺𝗂 𝚗𝚊𝚢", "hai nay"),
        ("ki﻿ểm­ tr​a‎", "kiểm tra"),
        ("привет всем α ευχαριστώ 谢谢 ขอบคุณ", "привет всем α ευχαριστώ 谢谢 ขอบคุณ"),
        ("👨‍👩‍👧 ❤️ 1️⃣", "👨‍👩‍👧 ❤️ 1️⃣"),
        ("a‍b c️d", "ab cd"),
        ("a  b", "a  b"),
        ("a\tb\nc d", "a b c d"),
        ("mười m² ½ №", "mười m² ½ №"),
        ("", ""),
    ],
)
def test_canonical(text, want, scores):
    got = lookalike.canonical_text(text, scores)
    assert got == want
    assert lookalike.canonical_text(got, scores) == got


def test_canonical_of_a_table(spark, scores):
    long = PLAIN * 3000
    rows = [("a", PLAIN), ("b", PLAIN.replace("n", "ո", 3)), ("c", None), ("d", ""), ("e", long), ("f", long + "​"), ("b", PLAIN.replace("n", "ո", 3)), (None, "a b")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "item_id string, transcript_raw string, canonical string")
    got = {r["item_id"]: r["canonical"] for r in lookalike.canonical(df).where("item_id is not null").collect()}
    assert got["a"] == got["b"] == PLAIN and got["c"] is None and got["d"] == "" and got["f"] == long
    assert sorted(r[0] for r in lookalike.not_canonical(df).collect()) == ["b", "f"]
    assert lookalike.not_canonical(df.limit(0)).count() == 0


def test_encoding_round_trip(spark):
    texts = [PLAIN, "", None, "👨‍👩‍👧 emoji \u0000 ok", "<|endoftext|> is text", "a" * 300_000, "é" + unicodedata.normalize("NFD", "é"), "\r\n\t  x"]
    df = spark.createDataFrame([(k, t, [1]) for k, t in enumerate(texts)], "doc_id bigint, text string, ids array<int>")
    ids = {r["doc_id"]: r["ids"] for r in encoding.encode(df).collect()}
    assert ids[1] == [] and ids[2] == [] and 50256 not in ids[4]
    back = {r["doc_id"]: r["text"] for r in encoding.decode(encoding.encode(df)).collect()}
    assert back == {k: t or "" for k, t in enumerate(texts)}
    counts = {r["doc_id"]: r["n"] for r in encoding.encode(df, out="n", only_count=True).collect()}
    assert counts == {k: len(v) for k, v in ids.items()}
    assert encoding.encode(df.limit(0)).count() == 0


def test_ids_equal_those_of_another_library(spark):
    import base64
    import os

    import tiktoken

    from phonoloom.plans.cluster import tokenizer_dir

    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    with open(os.path.join(tokenizer_dir(), "byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame([(1, PLAIN), (2, "👍🏽 I'll go\n\n ok")], "doc_id bigint, text string")
    assert {r["doc_id"]: r["ids"] for r in encoding.encode(df).collect()} == {1: other.encode_ordinary(PLAIN), 2: other.encode_ordinary("👍🏽 I'll go\n\n ok")}


def test_spans_of_split_characters(spark):
    df = spark.createDataFrame([(1, "a👍🏽b"), (2, None)], "doc_id bigint, text string")
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in encoding.token_spans(df).collect()}
    assert spans[1][0] == (0, 1) and spans[1][-1][1] == 4 and all(a < b for a, b in spans[1]) and spans[2] == []


def test_encoding_by_parts_is_that_of_whole_texts():
    import os

    from phonoloom.plans.cluster import tokenizer_dir

    path = os.path.join(tokenizer_dir(), "byte_bpe_50k.json")
    rng = random.Random(3)
    bits = [" ", "  ", "\n", "\t", " \n", "\u00a0", "\u3000", "\x1c", "\u200b", "a", "Xin", "chào", "'s", "12", "3,5", "!", "...", "đ\u0323", "👩‍👧", "<|endoftext|>", "\r\n", "_", "日本"]
    texts = ["", " ", "  ", " a", "a ", "a  b", "a   b", "a \n b", "x\n y", "x\n \ny"] + ["".join(rng.choices(bits, k=rng.randint(1, 14))) for _ in range(4000)]
    whole = encoding.tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)
    pieces = encoding.Pieces(path, most=50)
    for a in range(0, len(texts), 700):
        flat, offsets = pieces.encode(texts[a : a + 700])
        assert [flat[i:j].tolist() for i, j in zip(offsets, offsets[1:])] == [e.ids for e in whole[a : a + 700]]
        assert pieces.encode(texts[a : a + 700], True)[1].tolist() == offsets.tolist()


def brute(rows, n, t, least):
    sets = {}
    for k, text in rows:
        if k is None or text is None:
            continue
        w = neardup.WORD.findall(text.lower())
        if len(w) >= least:
            sets[k] = set(zip(*[w[i:] for i in range(n)]))
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-9}


def edited(rng, words):
    w = list(words)
    for _ in range(rng.randint(0, 5)):
        at = rng.randrange(len(w))
        w[at : at + 1] = rng.choice([["thay"], [], [w[at], "thêm"], ["x", "y"]])
    if rng.random() < 0.3:
        a = rng.randrange(len(w))
        w = w[a:] + w[:a]
    return " ".join(w)


@pytest.mark.parametrize("n, t, least, vocabulary, size", [(3, 0.6, 40, 60, 60), (3, 0.6, 40, 4, 45), (5, 0.8, 5, 30, 30), (5, 0.8, 5, 2, 9)])
def test_near_copies_against_all_pairs(spark, n, t, least, vocabulary, size):
    rng = random.Random(vocabulary)
    rows = []
    for g in range(25):
        base = [f"w{rng.randrange(vocabulary)}" for _ in range(size + rng.randrange(15))]
        rows += [(f"{g:02d}-{k}", edited(rng, base)) for k in range(rng.randint(1, 6))]
    rows += [("copy-1", rows[0][1].upper()), ("copy-2", rows[0][1] + " !"), ("short", "a b"), ("none", None), ("blank", ""), (None, rows[0][1]), ("same", "la " * 50), ("same2", "la, " * 60)]
    df = spark.createDataFrame([(*r, 1) for r in rows + rows[:3]], "item_id string, transcript_raw string, set_id int")
    got = {tuple(r) for r in neardup.near_copies(df, n=n, threshold=t, least_words=least).collect()}
    assert got == brute(rows, n, t, least)
    groups = {r["item_id"]: r for r in neardup.copy_groups(df, n=n, threshold=t, least_words=least).collect()}
    links = brute(rows, n, t, least)
    short = {k for k, text in rows if k and text and len(neardup.WORD.findall(text.lower())) < least}
    assert set(groups) == {k for k, _ in rows if k}
    for k, r in groups.items():
        if k not in short:
            assert r["n_links"] == sum(k in p for p in links)
    assert all(groups[a]["group_id"] == groups[b]["group_id"] for a, b in links)


def test_many_equal_texts_come_as_a_star(spark):
    text = " ".join(f"từ{k}" for k in range(60))
    near = text.replace("từ30", "khác")
    df = spark.createDataFrame([(f"a{k:03d}", text) for k in range(90)] + [("b", near)], "item_id string, transcript_raw string")
    got = {tuple(r) for r in neardup.near_copies(df).collect()}
    assert got == {("a000", f"a{k:03d}") for k in range(1, 90)} | {(f"a{k:03d}", "b") for k in range(90)}


def test_all_pairs_between_different_texts_of_large_groups(spark):
    words = [f"từ{k}" for k in range(60)]
    text, other = " ".join(words), " ".join(words).replace("từ30", "khác")
    rows = [(f"a{k:03d}", text) for k in range(90)] + [(f"b{k:03d}", text.upper()) for k in range(3)] + [(f"c{k:03d}", text + " " + "!" * (k + 1)) for k in range(70)]
    rows += [(f"d{k:03d}", other) for k in range(80)]
    df = spark.createDataFrame(rows, "item_id string, transcript_raw string")
    got = {tuple(r) for r in neardup.near_copies(df).collect()}
    texts, want = dict(rows), brute(rows, 3, 0.6, 40)
    stars = {(a, b) for a, b in want if texts[a] == texts[b] and a[0] in "ad" and a[1:] != "000"}
    assert got == want - stars and len(want) == 243 * 242 // 2
    copies = neardup.exact_copies(df).collect()
    assert {(r["item_id"], r["representative"]) for r in copies} == {(k, f"{k[0]}000" if k[0] != "c" else k) for k in texts}
    one = {}
    for r in copies:
        one.setdefault(r["text_id"], []).append(r["item_id"])
    assert got | {p for ids in one.values() for p in itertools.combinations(sorted(ids), 2)} == want


def test_a_key_with_several_texts_has_the_pairs_of_each(spark):
    one, two = ([f"{w}{k}" for k in range(60)] for w in ("từ", "lời"))
    texts = [("a", ""), ("a", " ".join(one)), ("a", " ".join(two)), ("b", " ".join(one[:-1])), ("c", " ".join(two[:-1])), ("d", "")]
    df = spark.createDataFrame(texts, "item_id string, transcript_raw string")
    assert {tuple(r) for r in neardup.near_copies(df).collect()} == {("a", "b"), ("a", "c")}
    groups = {r["item_id"]: tuple(r)[1:] for r in neardup.copy_groups(df).collect()}
    assert [groups[k] for k in "abc"] == [("a", 1)] * 3


def test_hot_signs_lose_nothing(spark):
    rng = random.Random(9)
    shared = [f"chung{k}" for k in range(45)]
    rows = [(f"{k:04d}", " ".join(shared + [f"r{rng.randrange(40)}" for _ in range(rng.choice([6, 14, 30]))])) for k in range(330)]
    df = spark.createDataFrame(rows, "item_id string, transcript_raw string")
    assert {tuple(r) for r in neardup.near_copies(df).collect()} == brute(rows, 3, 0.6, 40)


def test_edges_in_blocks_lose_nothing():
    rng = np.random.default_rng(3)
    ids = rng.integers(-(2**62), 2**62, 60)
    edge = np.array([5] * 50 + [9] * 10, dtype=np.uint64)
    bits = [np.zeros(60, np.int64)] * 3
    size = np.full(60, 7)
    blocks = np.array([4] * 50 + [1] * 10)
    e, owner, s = neardup._in_blocks(edge, np.arange(60), size, ids, blocks)
    order = np.argsort(e, kind="stable")
    assert np.bincount(owner)[:50].tolist() == [4] * 50 and len(np.unique(e)) == 11
    got = neardup._meet(e[order], ids[owner][order], s[order], [b[owner][order] for b in bits], 0.6)
    want = neardup._meet(edge, ids, size, bits, 0.6)
    assert len(want[0]) == 50 * 49 // 2 + 45 and np.array_equal(got, want)


def test_counts_as_bytes():
    counts = np.unique(np.concatenate([np.arange(5000), 2 ** np.arange(12, 30)]))
    back = neardup._count(neardup._code(counts))
    assert (back >= counts).all() and (back <= counts * 1.1 + 1).all() and (back[:17] == counts[:17]).all()


def test_short_texts_have_groups(spark):
    rows = [("a", "la"), ("b", "la la la la la"), ("c", "La!"), ("d", "hai ba"), ("e", "ba hai"), ("f", None), ("g", "  "), ("h", "...")]
    groups = neardup.copy_groups(spark.createDataFrame(rows, "item_id string, transcript_raw string")).collect()
    assert sorted(map(tuple, groups)) == [("a", "a", 1), ("b", "b", 0), ("c", "a", 1), *((k, k, 0) for k in "defgh")]


def test_no_texts(spark):
    df = spark.createDataFrame([], "item_id string, transcript_raw string")
    assert neardup.near_copies(df).count() == 0 and neardup.copy_groups(df).count() == 0


def test_prefix_tree_against_sets():
    rng = np.random.default_rng(4)
    sets = [sorted(set(rng.integers(0, 40, rng.integers(1, 30)).tolist())) for _ in range(60)]
    tree = neardup.PrefixTree()
    for k, s in enumerate(sets):
        tree.add(s, k)
    for probe in sets:
        want = [k for k, s in enumerate(sets) if len(set(s) & set(probe)) >= 0.6 * len(set(s) | set(probe)) - 1e-9]
        assert sorted(tree.similar(probe, 0.6)) == want
