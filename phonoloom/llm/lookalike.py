"""Problem 4: one consistent form of texts that look the same.

Compatibility forms, invisible characters and odd spaces go by rule; letters that only resemble a Latin or Vietnamese
one are replaced along the best path through the lattice of what each could stand for.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

# Letters of other scripts, and Latin ones foreign to Vietnamese, with what they look like.
LOOKS_LIKE = {
    # Cyrillic
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "и": "u", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "Ү": "Y", "ү": "y",
    # Greek
    "α": "a", "β": "b", "ϲ": "c", "ε": "e", "η": "n", "ι": "i", "ϳ": "j", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "uv", "χ": "x", "γ": "y", "ω": "w",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    # Armenian
    "ո": "n", "օ": "o", "ս": "u", "հ": "h", "ց": "g", "զ": "q", "ք": "p", "Տ": "S", "Լ": "L", "Օ": "O", "Ս": "U",
    # Latin letters that no Vietnamese word has
    "ð": "đ", "Ð": "Đ", "ɖ": "đ", "Ɖ": "Đ", "ƌ": "đ", "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʏ": "y", "ⅼ": "l", "ƅ": "b", "ǎ": "ă", "Ǎ": "Ă",
}

_BASE = "aăâbcdđeêfghijklmnoôơpqrstuưvwxyz"
_TONES = ["", "́", "̀", "̉", "̃", "̣"]
#: Every letter a Vietnamese or English word has, composed.
LETTERS = sorted({c for b in _BASE for t in (_TONES if b in "aăâeêioôơuưy" else [""]) for c in (unicodedata.normalize("NFC", b + t), unicodedata.normalize("NFC", b + t).upper())})
PLAIN = frozenset(LETTERS)


def _ranges(characters: str) -> str:
    """Characters as ranges of a class: a pattern tries its parts one by one, for every character of a text."""
    out, codes = [], sorted({ord(c) for c in characters})
    for code in codes:
        if out and code == out[-1][1] + 1:
            out[-1][1] = code
        else:
            out.append([code, code])
    out.sort(key=lambda r: r[0] - r[1])  # the widest first
    return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in out)


#: A text of these characters only is in the consistent form already.
PLAIN_CLASS = " -~" + _ranges("".join(c for c in LETTERS if ord(c) > 126) + "–—…“”‘’«»•·°£€₫©®")
_NOT_PLAIN = f"[^{PLAIN_CLASS}]"

_WORD = regex.compile(r"[\p{L}\p{M}]+")
_EMOJI = regex.compile(r"[\p{Extended_Pictographic}\p{Emoji_Modifier}\p{Regional_Indicator}]")
_JOINERS = regex.compile(r"[‍︎️‌]")
#: Scripts in whose words a joiner or non-joiner changes the shape and so stays.
_JOINED = regex.compile(r"[\p{Arabic}\p{Devanagari}\p{Bengali}\p{Malayalam}\p{Sinhala}\p{Khmer}\p{Mongolian}]")
_BLANK_LETTERS = frozenset("ᅟᅠㅤﾠ͏឴឵᠋᠌᠍᠎")
_KINDS = frozenset(["<wide>", "<narrow>", "<font>", "<noBreak>"])


class _Characters(dict):
    """What a single character becomes, found when first asked for."""

    def __missing__(self, code: int):
        c = chr(code)
        cat = unicodedata.category(c)
        if cat in ("Zs", "Zl", "Zp") or c in "\t\n\r\x0b\x0c\x85":
            out = " "
        elif c in "‍︎️‌" or 0xE0020 <= code <= 0xE007F:
            out = c  # judged by their neighbours
        elif cat in ("Cf", "Cc") or c in _BLANK_LETTERS or 0xFE00 <= code <= 0xFE0D or 0xE0100 <= code <= 0xE01EF:
            out = ""
        else:
            kind = unicodedata.decomposition(c).split(" ")[0]
            out = unicodedata.normalize("NFKC", c) if kind in _KINDS or (kind == "<compat>" and cat[0] == "L") else c
        self[code] = out
        return out


_CHARACTERS = _Characters()


def _joiner_kept(text: str, at: int) -> bool:
    c, before, after = text[at], text[at - 1 : at], text[at + 1 : at + 2]
    if c in "︎️":
        return bool(before) and (bool(_EMOJI.match(before)) or unicodedata.category(before)[0] == "S" or (before in "#*0123456789" and after == "⃣"))
    if _JOINED.match(before or " ") and _JOINED.match(after or " "):
        return True
    if c == "‍":
        k = at - 1
        while k >= 0 and text[k] in "️":
            k -= 1
        return k >= 0 and bool(_EMOJI.match(text[k])) and bool(_EMOJI.match(after or " "))
    return False


def _tag_kept(text: str, at: int) -> bool:
    """A tag character belongs to a flag: after the black flag and other tags."""
    k = at
    while k >= 0 and 0xE0020 <= ord(text[k]) <= 0xE007F:
        k -= 1
    return k >= 0 and text[k] == "\U0001f3f4"


class NgramScores:
    """Character bigram scores of words, a script at a time; words end in a boundary."""

    def __init__(self, counts: dict[tuple[str, str], float], smooth: float = 0.5):
        rows: dict[str, float] = {}
        for (a, _), n in counts.items():
            rows[a] = rows.get(a, 0.0) + n
        self.counts, self.rows, self.smooth, self.size = counts, rows, smooth, len(LETTERS) + 1

    def __call__(self, a: str, b: str) -> float:
        a, b = a.lower(), b.lower()
        return math.log((self.counts.get((a, b), 0.0) + self.smooth) / (self.rows.get(a, 0.0) + self.smooth * self.size))


#: Log score of a change of script inside a word, and of a letter of another script beside its own.
SWITCH, FOREIGN = -12.0, -3.5


def _choices(c: str) -> list[str]:
    if c in PLAIN:
        return [c]
    base, marks = c, ""
    if c not in LOOKS_LIKE:
        parts = unicodedata.normalize("NFD", c)
        base, marks = parts[0], parts[1:]
    return [c, *(unicodedata.normalize("NFC", x + marks) for x in LOOKS_LIKE.get(base, ""))]


def read_word(word: str, scores: NgramScores) -> str:
    """The most likely reading of a word: Viterbi over what each letter is or looks like.

    A path pays for every change between Latin and another script, and for letters outside the alphabet, so a
    mixed word becomes Latin where all its strangers have a look-alike, and a word wholly of another script stays.
    """
    if not any(c in PLAIN or (c in LOOKS_LIKE and "LATIN" in unicodedata.name(c, "")) for c in word):
        return word
    lattice = [_choices(c) for c in word]
    if all(len(x) == 1 for x in lattice):
        return word
    best = {("", True): (0.0, "")}
    for options in lattice:
        now: dict[tuple[str, bool], tuple[float, str]] = {}
        for o in options:
            latin = all(x in PLAIN or unicodedata.category(x)[0] == "M" for x in o)
            for (last, was), (score, path) in best.items():
                s = score + (scores(last or " ", o[-1:]) if latin and was else FOREIGN + (0.0 if latin == was else SWITCH))
                if (o, latin) not in now or s > now[o, latin][0]:
                    now[o, latin] = (s, path + o)
        best = now
    end = {k: (s + (scores(k[0], " ") if k[1] else FOREIGN), path) for k, (s, path) in best.items()}
    return max(end.values())[1]


def canonical_text(text: str, scores: NgramScores, known: dict[str, str] | None = None) -> str:
    """``text`` in the consistent form: composed letters, ordinary width, U+0020 as the only space, nothing
    invisible, no look-alike letters. Emoji keep their joiners and selectors, words wholly of another script and
    runs of ordinary spaces stay. ``known`` remembers words already read."""
    out = text.translate(_CHARACTERS)
    if _JOINERS.search(out):
        out = "".join(c for k, c in enumerate(out) if c not in "‍︎️‌" or _joiner_kept(out, k))
    if "\U000e0020" <= max(out, default="") <= "\U000e007f":
        out = "".join(c for k, c in enumerate(out) if not 0xE0020 <= ord(c) <= 0xE007F or _tag_kept(out, k))
    out = unicodedata.normalize("NFC", out)
    if not _STRANGE.search(out):
        return out
    known = {} if known is None else known

    def read(m) -> str:
        word = m[0]
        if word not in known:
            if len(known) > 100_000:
                known.clear()
            known[word] = unicodedata.normalize("NFC", read_word(word, scores))
        return known[word]

    return _MIXED.sub(read, out)


_plain_run = "".join(LETTERS)
_STRANGE = regex.compile(f"[^\\P{{L}}{_plain_run}]")
#: Words that hold a letter outside the alphabet.
_MIXED = regex.compile(f"[{_plain_run}\\p{{M}}]*+[^\\P{{L}}{_plain_run}][\\p{{L}}\\p{{M}}]*+")


@lru_cache(maxsize=1)
def _index() -> np.ndarray:
    """Letter numbers by code point, in lower case; 0 ends a word."""
    table = np.zeros(0x1F00, dtype=np.int64)
    low = sorted({c.lower() for c in LETTERS})
    for c in LETTERS:
        table[ord(c)] = low.index(c.lower()) + 1
    return table


def ngram_scores(df: DataFrame, text: str = "transcript_raw") -> NgramScores:
    """Bigram scores counted over all texts of ``df``. Every partition counts into a table of letters x letters, the
    sums of which come to the driver: at most as many rows as the alphabet squared, however large the input."""
    low = " " + "".join(sorted({c.lower() for c in LETTERS}))
    k = len(low)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = _index(), np.zeros(k * k, dtype=np.int64)
        for batch in batches:
            joined = " ".join(x for x in batch.column(0).to_pylist() if x)
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            letters = np.where(codes < len(table), table[np.minimum(codes, len(table) - 1)], 0)
            if len(letters) > 1:
                total += np.bincount(letters[:-1] * k + letters[1:], minlength=k * k)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["pair", "n"])

    sums = df.select(text).mapInArrow(count, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    return NgramScores({(low[r["pair"] // k], low[r["pair"] % k]): float(r["n"]) for r in sums})


def _read_again(rows: DataFrame, text: str, out: str, scores: NgramScores) -> DataFrame:
    """``rows`` with ``out``, the consistent form of ``text``, which is the last column, by :func:`canonical_text`."""
    names = [*rows.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        for batch in batches:
            fixed = [None if x is None else canonical_text(x, scores, known) for x in batch.column(len(names) - 2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fixed, pa.string())], names=names)

    return rows.mapInArrow(run, rows.withColumn(out, F.col(text)).schema)


def canonical(df: DataFrame, text: str = "transcript_raw", out: str = "canonical", scores: NgramScores | None = None, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all but ``out`` if not given), the text and ``out``, its consistent form. Null stays null.

    Texts of ordinary characters only are in that form and stay in the JVM; the others, whole, go through
    :func:`canonical_text` in Arrow batches.
    """
    scores = scores or ngram_scores(df, text)
    kept = [c for c in (keep if keep is not None else df.columns) if c not in (text, out)]
    rows = df.select(*kept, text)
    odd = F.coalesce(F.col(text).rlike(_NOT_PLAIN), F.lit(False))
    return rows.where(~odd).withColumn(out, F.col(text)).unionByName(_read_again(rows.where(odd), text, out, scores))


def not_canonical(df: DataFrame, key: str = "item_id", text: str = "transcript_raw") -> DataFrame:
    """(key) of the records that have a transcript which isn't in the consistent form; null ids give no row."""
    odd = df.where(F.col(key).isNotNull() & F.col(text).rlike(_NOT_PLAIN)).select(key, text)
    return _read_again(odd, text, "_form", ngram_scores(df, text)).where(F.col("_form") != F.col(text)).select(key).distinct()
