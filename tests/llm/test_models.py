"""Offensive spans and personal information: fields, held-out accuracy, tables."""

import itertools
import os

import numpy as np
import pytest

from phonoloom.llm import pii, toxicity
from phonoloom.llm.crf import Chunks, Crf, Words

LABELS = "/root/testdata/sf0.001/content_labels.parquet"


def test_marginals_and_best_path_against_enumeration():
    rng = np.random.default_rng(0)
    m = Crf(["O", "A", "B"])
    m.moves, m.first = rng.normal(size=(3, 3)), rng.normal(size=3)
    scores = rng.normal(size=(7, 3)).astype(np.float32)
    lengths = np.array([4, 3])
    gamma, best = m._forward_backward(scores, lengths), m._best(scores, lengths)
    exact, xi, _ = m._expected(scores.astype(float), lengths)
    at = 0
    for n in lengths:
        s = scores[at : at + n]
        weight = {p: m.first[p[0]] + sum(s[i, y] for i, y in enumerate(p)) + sum(m.moves[a, b] for a, b in zip(p, p[1:])) for p in itertools.product(range(3), repeat=int(n))}
        z = np.array(list(weight.values()))
        p = np.exp(z - z.max())
        p /= p.sum()
        want = np.zeros((n, 3))
        for path, q in zip(weight, p):
            for i, y in enumerate(path):
                want[i, y] += q
        assert np.allclose(gamma[at : at + n], want, atol=1e-4) and np.allclose(exact[at : at + n], want, atol=1e-9)
        assert tuple(best[at : at + n]) == max(weight, key=weight.get)
        at += n
    assert np.isclose(xi.sum(), 5)


def test_long_sequences_are_decoded_whole():
    words = Words(lambda w: [w])
    m = Crf(["O", "A"], offsets=(0,), joint=())
    m.fit(words, [words.numbers(["x", "y"] * 5)] * 4, [[0, 1] * 5] * 4, epochs=5)
    long = words.numbers(["x", "y"] * 3000)
    assert m.viterbi(words, [long, [], words.numbers(["y"])])[0].tolist() == [0, 1] * 3000
    assert m.marginals(words, [long])[0].shape == (6000, 2)
    # a label that never changes back is carried from the first token to the last
    m.moves, m.first = np.array([[0.0, -50.0], [-50.0, 0.0]]), np.array([0.0, 3.0])
    m.weights[:] = 0
    assert m.viterbi(words, [long])[0].tolist() == [1] * 6000 and m.marginals(words, [long])[0][-1, 1] > 0.9


def test_chunks_are_numbered_like_tokens():
    text = "Ai? ai 0912.345,67\n(ai)  @x_y  m\u0301ẹ²"
    chunks = Chunks(Words(pii.attributes), pii.cut, most=3)
    for _ in range(3):
        (numbers,) = chunks.sequences([text])
        assert numbers.tolist() == chunks.words.numbers(pii.located(text)[0])
    assert [len(s) for s in chunks.sequences(["", " ", "a b"])] == [0, 0, 2] and chunks.sequences([]) == []


def test_masked_words_have_one_form():
    assert toxicity.tokens("đồ h ã m t à i, r*** và n.g.u") == ["đồ", "h ã m t à i", ",", "r***", "và", "n.g.u"]
    assert toxicity.attributes("n.g.u")[0] == toxicity.attributes("ngu")[0] == toxicity.attributes("nguuuu")[0]


@pytest.mark.skipif(not os.path.exists(LABELS), reason="no test data")
def test_held_out_offence():
    import duckdb

    rows = duckdb.sql(f"select transcript_raw, label from '{LABELS}' where label is not null order by label_id").fetchall()
    _, scores = None, toxicity.NgramScores({})
    field = toxicity.train(rows[:800], scores)
    words, hit, wrong, n = Words(toxicity.attributes), 0, 0, 0
    for (text, label), p in zip(rows[800:], field.marginals(words, [words.numbers(toxicity.tokens(t)) for t, _ in rows[800:]])):
        found = toxicity.peak(1 - p[:, 0]) >= toxicity.CUT
        n += label != "clean"
        hit += found and label != "clean"
        wrong += found and label == "clean"
    print("held out:", hit, n, wrong)
    assert hit / n > 0.93 and wrong < 0.08 * n


@pytest.mark.skipif(not os.path.exists(LABELS), reason="no test data")
def test_scores_of_a_table(spark):
    bad, good = "Hôm qua mưa to. Thằng kia đúng là đồ óc chó nói hoài không hiểu. Rồi ai về nhà nấy.", "Con chó nhà bà mối ở xã Bến Sậy đẻ được ba con, con nào cũng mập."
    rows = [("a", bad, "u1"), ("a", bad, "u1"), ("b", good, "u1"), ("c", None, None), ("d", "", "u2"), (None, bad, "u2"), ("e", good * 400 + bad, "u2")]
    df = spark.createDataFrame([(*r, 0.1, "k") for r in rows], "item_id string, transcript_raw string, uploader string, score double, kind string")
    scored = toxicity.score(df, spark.read.parquet(LABELS)).cache()
    got = {r["item_id"]: r for r in scored.where("item_id is not null").collect()}
    assert got["a"]["kind"] == got["e"]["kind"] == "abusive" and got["b"]["kind"] is None and got["c"]["score"] == got["d"]["score"] == 0
    s = got["a"]["spans"][0]
    assert "óc chó" in bad[s["start"] : s["end"]] and "mưa" not in bad[s["start"] : s["end"]]
    rates = {r["value"]: (r["records"], r["offending"]) for r in toxicity.rates(df, scored, ["uploader"]).collect()}
    assert rates == {"u1": (2, 1), "u2": (2, 1), None: (1, 0)}
    assert toxicity.score(df.limit(0), spark.read.parquet(LABELS)).count() == 0


def test_personal_information_held_out(monkeypatch):
    """Sentences, names and places that training has not seen: what is found against what was put in."""
    from phonoloom.llm import pii_labels as t

    # every fifth sentence is kept back, and with it its fillings
    unseen = t.PERSONAL[::5] + t.ORDINARY[::5]
    monkeypatch.setattr(t, "PERSONAL", [s for k, s in enumerate(t.PERSONAL) if k % 5])
    monkeypatch.setattr(t, "ORDINARY", [s for k, s in enumerate(t.ORDINARY) if k % 5])
    pii.trained.cache_clear()
    field = pii.trained()
    pii.trained.cache_clear()
    others = {"GIVEN": "Thục Nhẫn Xoan Quế Sang Lượng Toại Vĩ Oanh Thơ", "MIDDLES": "Bá Cát Hoàng Mạnh Như Tấn Thế", "ENGLISH_FIRST": "Brian Clara Doris Frank", "ENGLISH_LAST": "Ashby Colburn Deane Hartwell"}
    for name, words in others.items():
        monkeypatch.setattr(t, name, words.split())
    monkeypatch.setattr(t, "PLACES", ["Yên Thế", "Cẩm Khê", "Lộc Ninh", "Ba Tri", "Nước Hai"])
    monkeypatch.setattr(t, "STREETS", ["Cách Mạng", "Hàm Nghi", "Tô Hiến Thành", "Hoa Lan"])
    monkeypatch.setattr(t, "DOMAINS", ["nha-toi.example", "khac.test"])
    f = pii._Filler(99)
    right = found_n = want_n = 0
    cases = [f.fill(s) for s in unseen for _ in range(20)]
    for (text, spans), own in zip(cases, pii._found([x for x, _ in cases], field, Chunks(Words(pii.attributes), pii.cut))):
        want = {(a, k) for a, _, k in spans}
        got = {(a, k) for a, _, k in own}
        right += len(want & got)
        found_n += len(got)
        want_n += len(want)
    print("held out:", right, want_n, found_n)
    assert right / want_n > 0.7 and right / found_n > 0.9


def test_spoken_addresses():
    for s in ("an.b41 [a còng] nha-toi chấm example", "an.b41 @ nha-toi.example", "an.b41(at)nha-toi.example", "AN.B41 a còng nha-toi chấm vn chấm example"):
        text = f"Thư gửi về {s} nhé."
        assert pii.checked(text, text.index(s), text.index(s) + len(s), "email") == (11, 11 + len(s))


def test_places_of_personal_information(spark):
    text = "Họ tên: Lục Văn Soan\nmailto:ung-soan.1990@hopthu.example hoặc (065) 610-9397. CCCD: 099 609 512 240 . Nhận hàng tại 7/28 đường Thuyền Nan, xã Gò Trầm, gọi trước nửa tiếng. Mã đơn 406140700732 đang xử lý. Kênh @hoc_doc vừa đăng tập 9."
    rows = [(1, text), (2, None), (3, ""), (4, "🙂" * 5 + " " + text), (5, text * 60)]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id bigint, text string, pii_kind string")
    found = pii.find(df).collect()
    got = {(r["pii_kind"], text[r["start_char"] : r["end_char"]]) for r in found if r["doc_id"] == 1}
    assert got == {("person_name", "Lục Văn Soan"), ("email", "ung-soan.1990@hopthu.example"), ("phone", "(065) 610-9397"), ("id_number", "099 609 512 240"), ("address", "7/28 đường Thuyền Nan, xã Gò Trầm")}
    assert {r["start_char"] - 6 for r in found if r["doc_id"] == 4} == {r["start_char"] for r in found if r["doc_id"] == 1}
    assert not [r for r in found if r["doc_id"] in (2, 3)]
    red = {r["doc_id"]: r["redacted"] for r in pii.redact(df).collect()}
    assert red[1].startswith("Họ tên: [PERSON_NAME]\nmailto:[EMAIL] hoặc [PHONE]. CCCD: [ID_NUMBER] .") and red[2] is None and red[3] == "" and "406140700732" in red[1]
    assert pii.find(df.limit(0)).count() == 0


def test_peak_of_few_tokens_is_their_mean():
    assert toxicity.peak(np.array([0.9])) == 0.9 and toxicity.peak(np.array([0.9, 0.5])) == pytest.approx(0.7)
    assert toxicity.peak(np.array([])) == 0.0 and toxicity.peak(np.array([0.0, 1.0, 1.0, 1.0, 1.0])) == 1.0


@pytest.mark.skipif(not os.path.exists(LABELS), reason="no test data")
def test_an_insult_of_two_words_is_flagged(spark):
    df = spark.createDataFrame([("b", "đồ ngu"), ("c", "cảm ơn"), ("d", "rồi")], "item_id string, transcript_raw string")
    assert {r["item_id"] for r in toxicity.score(df, spark.read.parquet(LABELS)).where("kind is not null").collect()} == {"b"}


@pytest.mark.skipif(not os.path.exists(LABELS), reason="no test data")
def test_clean_rows_have_the_scores_of_each_kind(spark):
    df = spark.createDataFrame([("d", "rồi")], "item_id string, transcript_raw string")
    r = toxicity.score(df, spark.read.parquet(LABELS)).first()
    assert 0 < r["score"] <= 0.02 and r["p_abusive"] + r["p_hateful"] + r["p_sexual"] == pytest.approx(r["score"], abs=3e-6)
