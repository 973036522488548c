"""Problem 5: offensive spans by a linear-chain conditional random field, scores of documents from its marginals."""

from __future__ import annotations

import random
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from phonoloom.llm import toxicity_labels as extra
from phonoloom.llm.crf import Crf, Words
from phonoloom.llm.lookalike import _NOT_PLAIN, NgramScores, canonical_text
from phonoloom.plans.cluster import spread

LABELS = ["O", "abusive", "hateful", "sexual"]
#: Labelled transcripts that training reads at most, in the order of label_id.
SAMPLE = 20_000
#: A document offends if so many tokens in a row do, on average, with at least this probability; one of fewer tokens, which
#: has no context that could speak against it, with the lower one.
SPAN, CUT, SHORT_CUT = 4, 0.95, 0.5

_L = r"[^\W\d_]"
#: Letters spelled one by one, words with stars inside, words, other signs.
_TOKEN = re.compile(rf"(?<!\w){_L}(?:([ .\-_]){_L})(?:\1{_L})+(?![\w])|\w+(?:\*+\w*)+|\w+|[^\w\s]")
_SIMPLE = re.compile(r"\w+(?:\*+\w*)+|\w+|[^\w\s]")
_SPELLED = re.compile(rf"(?<!\w){_L}([ .\-_]){_L}\1{_L}(?!\w)")
_RUN = re.compile(r"(.)\1{2,}")
_STRANGE = re.compile(_NOT_PLAIN)
# Words of numbers, which all count as one.
NUMBERS = "không một hai ba bốn năm sáu bảy tám chín mười mươi trăm lẻ lăm mốt tư nghìn ngàn triệu".split()
_NUMBERS = frozenset(NUMBERS)
_NUMBER_RUN = re.compile(rf"\b(?:{'|'.join(NUMBERS)})(?: (?:{'|'.join(NUMBERS)}))*\b")
_PLACE = re.compile(r"\b(?:thôn|xã|ấp|bến|chợ|phường|thị trấn|khu phố)((?: [A-ZĐÁÀẢÃẠÂĂÊÔƠƯỐỒỔỖỘỚỜỞỠỢỨỪỬỮỰẤẦẨẪẬẮẰẲẴẶẾỀỂỄỆÍÌỈĨỊÓÒỎÕỌÚÙỦŨỤÝỲỶỸỴÉÈẺẼẸ]\w*)+)")


def _bare(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word.replace("đ", "d")) if not unicodedata.combining(c))


def attributes(token: str) -> list[str]:
    """Form, form without accents, and how it is masked; the same for stretched and spelled-out words."""
    form, masked = token.lower(), ""
    if len(form) > 4 and not form[1].isalnum() and form[1] != "*" and len(set(form[1::2])) == 1:
        form, masked = form[::2], "spelled"
    elif "*" in form and len(form) > 1:
        form = re.sub(r"\*+", "*", form)
        masked = "starred"
    if _RUN.search(form):
        form, masked = _RUN.sub(r"\1", form), masked or "stretched"
    if form in _NUMBERS or form.isdigit():
        form = "0"
    return [form, _bare(form), masked]


def tokens(text: str) -> list[str]:
    return [m[0] for m in _TOKEN.finditer(text)] if _SPELLED.search(text) else _SIMPLE.findall(text)


def _sentences(words: list[str]) -> list[tuple[int, int]]:
    """Stretches between full stops; a long one without any is cut every dozen tokens."""
    out, a = [], 0
    for k, w in enumerate(words):
        if w in ".!?…" or k == len(words) - 1:
            b = k + 1
            if b - a > 45:
                out += [(x, min(x + 12, b)) for x in range(a, b, 12)]
            elif b > a:
                out.append((a, b))
            a = b
    return out


def span_labels(rows: list[tuple[str, str]]) -> list[tuple[list[str], list[int]]]:
    """Token labels from document labels: (tokens, tags) of the documents whose label their words bear out.

    A run of words is as offensive as it is more frequent in documents of a label than in clean ones (log ratio of
    document shares of word pairs and triples). In a document with that label its most offensive sentence, and those
    nearly so, get the label. Documents whose label is contradicted, about as many as are mislabelled, are left out.
    """
    docs = [([attributes(t)[1] for t in tokens(x)], tokens(x), LABELS.index(y) if y != "clean" else 0) for x, y in rows]
    counts: dict[int, Counter] = defaultdict(Counter)
    size = Counter()
    for bare, _, y in docs:
        size[y] += 1
        counts[y].update({g for n in (2, 3) for g in zip(*[bare[k:] for k in range(n)])})

    def strength(bare: list[str], y: int) -> np.ndarray:
        s, w = np.zeros(len(bare)), np.zeros(len(bare))
        for n in (2, 3):
            for k, g in enumerate(zip(*[bare[k:] for k in range(n)])):
                v = np.log((counts[y][g] + 0.1) / (size[y] + 0.2)) - np.log((counts[0][g] + 1.0) / (size[0] + 2.0))
                v *= counts[y][g] / (counts[y][g] + 3.0) if v > 0 else 1.0  # what was seen once or twice says little
                s[k : k + n] += min(max(v, -4.0), 4.0)
                w[k : k + n] += 1
        return s / np.maximum(w, 1)

    out = []
    for bare, words, y in docs:
        parts = _sentences(words)
        tags = [0] * len(words)
        if y:
            s = strength(bare, y)
            marks = [(float(s[a:b].mean()), a, b) for a, b in parts if b - a >= 3]
            top = max(marks, default=(0.0, 0, 0))[0]
            if top < 0.6:
                continue
            for v, a, b in marks:
                if v >= max(0.6, 0.65 * top):
                    tags[a:b] = [y] * (b - a)
        elif any(strength(bare, c)[a:b].mean() > 1.2 for c in (1, 2, 3) for a, b in parts if b - a >= 5):
            continue
        out.append((words, tags))
    return out


def extra_labels(places: list[str], copies: int = 16, seed: int = 3) -> list[tuple[list[str], list[int]]]:
    """The sentences labelled by hand, each with several fillings: names of places, other numbers."""
    rng = random.Random(seed)
    lists = {"who": extra.WHO, "slur": extra.SLUR, "group": extra.GROUP, "curse": extra.CURSE, "do": extra.DO, "name": places}
    kinds = [p.split(" ")[0] if not p.startswith(("khu phố", "thị trấn")) else " ".join(p.split(" ")[:2]) for p in extra.PLACE]
    out = []

    def number(_) -> str:
        return " ".join(rng.choice(NUMBERS) for _ in range(rng.randint(1, 5)))

    def slot(m) -> str:
        return f"{rng.choice(kinds)} {rng.choice(places)}" if m[1] == "place" else rng.choice(lists[m[1]])

    for label, sentence in extra.SENTENCES:
        for _ in range(copies if "{" in sentence else copies // 2):
            text = re.sub(r"\{(\w+)\}", slot, _NUMBER_RUN.sub(number, sentence))
            words = tokens(text[0].upper() + text[1:])
            out.append((words, [0 if label == "clean" else LABELS.index(label)] * len(words)))
    return out


def train(rows: list[tuple[str, str]], scores: NgramScores, seed: int = 5) -> Crf:
    """The field, from labelled transcripts and the sentences labelled by hand.

    Sentences by hand are also set between others, so that ends of sentences don't decide.
    """
    known: dict[str, str] = {}
    labelled = span_labels([(canonical_text(x, scores, known), y) for x, y in rows if x and y in ("clean", *LABELS[1:])])
    rng = random.Random(seed)
    places = sorted({m.strip() for x, _ in rows if x for m in _PLACE.findall(x)} | {"An Phú", "Gò Công"})
    own = extra_labels(places)
    calm = [(w[a:b], t[a:b]) for w, t in labelled if not any(t) for a, b in _sentences(w)]
    joined = []
    for w, t in own:
        before, after = rng.choice(calm) if calm else ([], []), rng.choice(calm) if calm else ([], [])
        if rng.random() < 0.3:  # transcripts without full stops
            strip = [(a, b) for a, b in zip([*before[0], *w, *after[0]], [*before[1], *t, *after[1]]) if a not in ".,!?"]
            joined.append(([a for a, _ in strip], [b for _, b in strip]))
        else:
            joined.append(([*before[0], *w, *after[0]], [*before[1], *t, *after[1]]))
    data = labelled + joined
    words = Words(attributes)
    model = Crf(LABELS, joint=(((-1, 0), 1), ((0, 1), 1), ((-1, 0, 1), 1), ((-2, -1, 0), 1), ((0, 1, 2), 1)))
    return model.fit(words, [words.numbers(w) for w, _ in data], [t for _, t in data], epochs=8)


def trained(labels: DataFrame, sample: int = SAMPLE) -> tuple[Crf, NgramScores]:
    """The field and the letters' scores from at most ``sample`` labelled transcripts, in the order of label_id."""
    rows = [(r[0], r[1]) for r in labels.orderBy("label_id").limit(sample).select("transcript_raw", "label").collect()]
    counts: Counter = Counter()
    for text, _ in rows:
        low = f" {(text or '').lower()} "
        counts.update(zip(low, low[1:]))
    scores = NgramScores({k: float(n) for k, n in counts.items()})
    known = hash(tuple(rows))
    if known not in _TRAINED:
        _TRAINED.clear()
        _TRAINED[known] = (train(rows, scores), scores)
    return _TRAINED[known]


#: The field last trained, by the labelled rows.
_TRAINED: dict[int, tuple[Crf, NgramScores]] = {}


def peak(p: np.ndarray, span: int = SPAN) -> float:
    """The largest mean of ``span`` values in a row (of all, if there are fewer)."""
    if not len(p):
        return 0.0
    if len(p) <= span:
        return float(p.mean())
    c = np.cumsum(np.concatenate([[0.0], p]))
    return float((c[span:] - c[:-span]).max() / span)


SCORE_COLUMNS = "score double, kind string, p_abusive double, p_hateful double, p_sexual double, spans array<struct<start:int,end:int,kind:string>>"


def score(df: DataFrame, labels: DataFrame, key: str = "item_id", text: str = "transcript_raw", sample: int = SAMPLE, spans: bool = True) -> DataFrame:
    """(key, score, kind, p_abusive, p_hateful, p_sexual, spans) of every row.

    Method: token marginals of the field (forward-backward); a document's score is the largest mean probability of
    SPAN tokens in a row to offend in any way, the p of a kind the same for that kind; ``kind`` is the largest of
    these where the score reaches CUT (SHORT_CUT for fewer than SPAN tokens), else null. Spans are half-open code points of the text in its consistent
    form (:func:`lookalike.canonical_text`). Null and empty texts score 0 and have no spans. Whole texts are read.
    """
    model, scores = trained(labels, sample)
    kind_of_key = df.schema[key].dataType.simpleString()
    cast = df.sparkSession.sparkContext.broadcast((model, scores))
    struct = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, letters = cast.value
        words, known = Words(attributes), {}
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            texts = [canonical_text(x, letters, known) if _STRANGE.search(x) else x for x in texts]
            if len(words.hashes) > 200_000:
                words.clear()
            sequences = [words.numbers(tokens(x)) for x in texts]
            best, kinds, by_kind, found = [], [], [], []
            for x, p in zip(texts, field.marginals(words, sequences)):
                bad = 1.0 - p[:, 0]
                s = peak(bad)
                per = [peak(p[:, k]) for k in (1, 2, 3)]
                best.append(round(s, 6))
                by_kind.append([round(v, 6) for v in per])
                flagged = s >= (CUT if len(bad) >= SPAN else SHORT_CUT)
                kinds.append(LABELS[1 + int(np.argmax(per))] if flagged else None)
                own = []
                if spans and flagged:
                    at, k = list(_TOKEN.finditer(x)), 0
                    while k < len(bad):
                        if bad[k] >= 0.5:
                            end = k
                            while end + 1 < len(bad) and bad[end + 1] >= 0.5:
                                end += 1
                            own.append({"start": at[k].start(), "end": at[end].end(), "kind": LABELS[1 + int(p[k : end + 1, 1:].sum(axis=0).argmax())]})
                            k = end
                        k += 1
                found.append(own)
            three = list(zip(*by_kind)) if by_kind else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.float64()), pa.array(kinds, pa.string()), *[pa.array(v, pa.float64()) for v in three], pa.array(found, pa.list_(struct))],
                names=[key, "score", "kind", "p_abusive", "p_hateful", "p_sexual", "spans"],
            )

    return spread(df.select(key, text)).mapInArrow(run, f"`{key}` {kind_of_key}, {SCORE_COLUMNS}")


def rates(df: DataFrame, scored: DataFrame, groups: list[str], key: str = "item_id") -> DataFrame:
    """(level, value, records, offending, rate, abusive, hateful, sexual) for every value of every group column.

    Repeated rows of an id count once, null values of a group are a group of their own.
    """
    one = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*groups)).alias("_g")).select(key, "_g.*")
    marks = scored.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("score").alias("score"), F.max("kind").alias("kind"))
    long = one.join(marks, key).select("kind", F.explode(F.array(*[F.struct(F.lit(g).alias("level"), F.col(g).alias("value")) for g in groups])).alias("_l")).select("kind", "_l.*")
    out = long.groupBy("level", "value").agg(F.count("*").alias("records"), F.count("kind").alias("offending"), *[F.count_if(F.col("kind") == k).alias(k) for k in LABELS[1:]])
    return out.withColumn("rate", F.round(F.col("offending") / F.col("records"), 6))
