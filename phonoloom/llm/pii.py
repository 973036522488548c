"""Problem 10: personal information in free text, found by a linear-chain conditional random field and replaced by
placeholders of its kind."""

from __future__ import annotations

import random
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from phonoloom.llm import pii_labels as table_
from phonoloom.llm.crf import Chunks, Crf, Words
from phonoloom.plans.cluster import spread

KINDS = ["email", "phone", "id_number", "address", "person_name"]
LABELS = ["O"] + [f"{b}-{k}" for k in KINDS for b in "BI"]
#: Words, numbers, single signs. A letter may carry combining marks.
TOKEN = re.compile(r"(?:[^\W\d_][̀-ͯ]*)+|\d+|_|[^\w\s]")
# Number words, as telephone numbers are read out.
DIGIT_WORDS = "không một hai ba bốn năm sáu bảy tám chín".split()
_DIGIT_WORDS = frozenset(DIGIT_WORDS)
_EMAIL_BODY = re.compile(r"[\w.+\-]+$")
#: How the sign and the dots of an address are written, or spoken.
_AT = re.compile(r"@|[(\[]\s*(?:at|a\s+c[òo]ng)\s*[)\]]|\ba\s+c[òo]ng\b", re.I)
_DOMAIN = re.compile(r"\s*[\w\-]+(?:(?:\.|\s+(?:chấm|cham|dot)\s+|\s*[(\[](?:chấm|dot)[)\]]\s*)[\w\-]+)+", re.I)
#: Parameters of the training table: fillings of a sentence with personal information, of one without.
FILLINGS, FILLINGS_PLAIN = 36, 20


def _bare(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word.replace("đ", "d").replace("Đ", "D")) if not unicodedata.combining(c))


def attributes(token: str) -> list[str]:
    """Form, form without accents, shape of a token; a leading \x01 says that nothing stands before it."""
    glued = token[0] == "\x01"
    word = unicodedata.normalize("NFKC", token[1:] if glued else token)
    g = "g" if glued else ""
    if word[:1].isdigit():
        kind = f"d{min(len(word), 20)}"
        return [f"{kind}:{word[:2] if len(word) > 2 else ''}", kind, f"{g}{kind}"]
    low = word.lower()
    if not word[:1].isalpha():
        return [low, low, g + low]
    bare = _bare(low)
    shape = "XX" if word.isupper() and len(word) > 1 else "X" if word.isupper() else "Xx" if word[0].isupper() else "xx"
    accents = "a" if bare != low else ""
    return [low, bare, g + shape + accents]


def located(text: str) -> tuple[list[str], list[int], list[int]]:
    """Tokens (marked where they touch the one before), their starts and ends."""
    words, starts, ends, last = [], [], [], -1
    for m in TOKEN.finditer(text):
        a, b = m.span()
        words.append("\x01" + m[0] if a == last else m[0])
        starts.append(a)
        ends.append(b)
        last = b
    return words, starts, ends


def cut(chunk: str) -> list[str]:
    """The tokens of a stretch without white space, as :func:`located` marks them."""
    found = TOKEN.findall(chunk)
    return found[:1] + ["\x01" + t for t in found[1:]]


class _Filler:
    """Fillings of the labelled sentences, by rule from a seeded generator."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def digits(self, n: int, first: str = "") -> str:
        return first + "".join(self.r.choice("0123456789") for _ in range(n - len(first)))

    def written(self, name: str) -> str:
        x = self.r.random()
        return name.upper() if x < 0.12 else name.lower() if x < 0.27 else _bare(name) if x < 0.43 else name

    def made(self) -> str:
        """A syllable by rule, which no list holds."""
        return self.r.choice(table_.ONSETS) + self.r.choice(table_.RIMES)

    def name(self) -> str:
        r = self.r
        own = r.random() < 0.4
        pick = (lambda known: self.made().capitalize()) if own else r.choice
        name = " ".join([r.choice(table_.SURNAMES), *[pick(table_.MIDDLES) for _ in range(r.choice([1, 1, 2]))], pick(table_.GIVEN)])
        # syllables by rule are only known by their capitals
        return (name if r.random() < 0.8 else _bare(name)) if own else self.written(name)

    def role(self) -> str:
        """What somebody does: not a name, though a title may stand before it."""
        r = self.r
        return r.choice(table_.ROLES) if r.random() < 0.6 else " ".join([r.choice(table_.TITLES), *[self.made() for _ in range(r.choice([1, 2, 2, 3]))]])

    def thing(self) -> str:
        r = self.r
        return r.choice(table_.THINGS) if r.random() < 0.6 else " ".join(self.made() for _ in range(r.choice([2, 3])))

    def somewhere(self, known: list[str]) -> str:
        """The name of a place or street, from a list or by rule."""
        r = self.r
        return r.choice(known) if r.random() < 0.5 else " ".join(self.made().capitalize() for _ in range(r.choice([2, 2, 3])))

    def ename(self) -> str:
        x = f"{self.r.choice(table_.ENGLISH_FIRST)} {self.r.choice(table_.ENGLISH_LAST)}"
        return x.upper() if self.r.random() < 0.15 else x

    def email(self) -> str:
        r = self.r
        a, b = _bare(r.choice(table_.SURNAMES)).lower(), _bare(r.choice(table_.GIVEN)).lower()
        body = r.choice([f"{a}{b}{self.digits(2)}", f"{b}.{a}", f"{b}_{a}", f"{a}-{b}.{r.randint(1960, 2009)}", f"{b}+clip", f"{b}.{a}+mic", f"{a}.{b}{self.digits(2)}"])
        sign = r.choice(["@", "@", "@", "@", "@", "(at)", " (at) ", "[at]", " @ ", " [a còng] ", " a còng ", " (a còng) "])
        domain = r.choice(table_.DOMAINS)
        if "còng" in sign:
            domain = domain.replace(".", r.choice([" chấm ", " chấm ", " (chấm) ", "."]))
        out = f"{body}{sign}{domain}"
        return out.upper() if r.random() < 0.1 else out

    def phone(self) -> str:
        r = self.r
        head = r.choice(["03", "04", "05", "06", "07", "08", "09", "04", "06"])
        n = self.digits(10, head)
        if r.random() < 0.2:
            return " ".join(DIGIT_WORDS[int(c)] for c in n)
        return r.choice([n, f"{n[:4]}.{n[4:7]}.{n[7:]}", f"{n[:4]}-{n[4:7]}-{n[7:]}", f"{n[:3]} {n[3:6]} {n[6:]}", f"+84 {n[1:3]} {n[3:6]} {n[6:]}", f"+84{n[1:]}", f"({n[:3]}) {n[3:6]}-{n[6:]}", f"0084-{n[1:3]}-{n[3:]}", f"{n[:4]} {n[4:7]} {n[7:]}"])

    def idnum(self) -> str:
        r = self.r
        if r.random() < 0.35:
            return self.digits(9, r.choice(["00", "02", "21", "36", ""]))
        n = self.digits(12, r.choice(["0", "09", "09", "097", "099"]))
        return r.choice([n, n, f"{n[:3]} {n[3:6]} {n[6:9]} {n[9:]}", f"{n[:3]}.{n[3:6]}.{n[6:9]}.{n[9:]}", f"{n[:4]}-{n[4:8]}-{n[8:]}"])

    def address(self) -> str:
        r = self.r
        n = r.randint(1, 399)
        house = r.choice([f"{n}", f"{n}{r.choice('ABCb')}", f"{n % 90 + 1}/{r.randint(1, 60)}", f"{n % 60 + 1} ngõ {r.randint(1, 399)}", f"{n % 60 + 1} hẻm {r.randint(1, 399)}", f"{n % 60 + 1}, ngách {r.randint(1, 99)}"])
        road = r.choice(["đường ", "đường ", "đường ", "đ. ", "phố ", ""])
        area = r.choice([f", phường {self.somewhere(table_.PLACES)}", f", P. {self.somewhere(table_.PLACES)}", f", xã {self.somewhere(table_.PLACES)}", f", thị trấn {self.somewhere(table_.PLACES)}", "", ""])
        out = f"{house} {road}{self.somewhere(table_.STREETS)}"
        x = r.random()
        if x < 0.2 and road:
            return out.lower()
        out += area
        return _bare(out) if x > 0.82 else out

    def eaddress(self) -> str:
        return f"{self.r.randint(1, 999)} {self.r.choice(table_.ENGLISH_STREETS)} {self.r.choice(['Street', 'Rd.', 'Road', 'Alley', 'Lane', 'Ave', 'St.'])}"

    def number(self) -> str:
        w = "một hai ba bốn năm sáu bảy tám chín mươi trăm lẻ lăm".split()
        return " ".join(self.r.choice(w) for _ in range(self.r.randint(1, 5)))

    def one(self, slot: str) -> str:
        r, t = self.r, table_
        if hasattr(self, slot) and slot in ("name", "ename", "email", "phone", "idnum", "address", "eaddress", "role", "thing"):
            return getattr(self, slot)()
        if slot[0] == "d" and slot[1:].isdigit():
            n = int(slot[1:])
            return self.digits(n, r.choice(["74", "75", "1", "4", "8", "2"]) if n > 2 else "")
        lists = {"feel": t.FEELINGS, "time": t.TIMES, "weather": t.WEATHER, "dish": t.DISHES, "good": t.GOODS, "handle": t.HANDLES, "street": t.STREETS, "pl": t.PLACES, "erole": t.EN_ROLES, "ething": t.EN_THINGS, "eplace": t.EN_PLACES, "etime": t.EN_TIMES}
        if slot in ("pl", "street"):
            return self.somewhere(lists[slot])
        if slot in lists:
            return r.choice(lists[slot])
        return {
            "place": lambda: f"{r.choice(t.KINDS)} {self.somewhere(t.PLACES)}",
            "org": lambda: f"{r.choice(t.ORGS)} {self.somewhere(t.PLACES)}",
            "n": self.number,
            "d": lambda: str(r.randint(1, 999)),
            "price": lambda: f"{r.randint(1, 9)}.{r.randint(100, 999)}.{r.randint(100, 999)}",
            "date": lambda: f"{r.randint(1, 28):02d}/{r.randint(1, 12):02d}/2026",
            "clock": lambda: f"00:{r.randint(0, 59):02d}:{r.randint(0, 59):02d},{r.randint(0, 999):03d}",
        }[slot]()

    def fill(self, sentence: str) -> tuple[str, list[tuple[int, int, str]]]:
        """The sentence filled, and its (start, end, kind)."""
        text, spans = "", []
        for m in re.finditer(r"\[(\w+)\|(.*?)\]|\{(\w+)\}|[^\[{]+|.", sentence, re.S):
            if m[1] in KINDS:
                inner = self.fill(m[2])[0]
                spans.append((len(text), len(text) + len(inner), m[1]))
                text += inner
            else:
                text += self.one(m[3]) if m[3] else m[0]
        # a sentence begins with a capital
        if text[:1].islower() and not (spans and spans[0][0] == 0) and self.r.random() < 0.9:
            text = text[0].upper() + text[1:]
        return text, spans


def labelled(seed: int = 11) -> list[tuple[list[str], list[int]]]:
    """The labelled table as tokens and tags: sentences filled, shuffled and set together, a few at a time."""
    f = _Filler(seed)
    filled = [f.fill(s) for s in table_.PERSONAL for _ in range(FILLINGS)] + [f.fill(s) for s in table_.ORDINARY for _ in range(FILLINGS_PLAIN)]
    f.r.shuffle(filled)
    out, k = [], 0
    while k < len(filled):
        n = f.r.randint(1, 4)
        text, spans = "", []
        for s, own in filled[k : k + n]:
            if f.r.random() < 0.15 and s.endswith("."):
                s = s[:-1] if not own or own[-1][1] < len(s) else s
            spans += [(a + len(text), b + len(text), c) for a, b, c in own]
            text += s + f.r.choice(table_.AROUND)
        k += n
        words, starts, ends = located(text)
        tags = [0] * len(words)
        for a, b, c in spans:
            inside = [i for i in range(len(words)) if starts[i] >= a and ends[i] <= b]
            for i in inside:
                tags[i] = LABELS.index(("B-" if i == inside[0] else "I-") + c)
        out.append((words, tags))
    return out


@lru_cache(maxsize=1)
def trained(seed: int = 11) -> Crf:
    """The field, from the labelled table."""
    data = labelled(seed)
    words = Words(attributes)
    model = Crf(
        LABELS,
        offsets=(-3, -2, -1, 0, 1, 2, 3),
        joint=(((-1, 0), 1), ((0, 1), 1), ((-1, 0), 2), ((0, 1), 2), ((-1, 0, 1), 2), ((-2, -1), 1)),
        forbidden=lambda a, b: b.startswith("I-") and a[2:] != b[2:],
    )
    return model.fit(words, [words.numbers(w) for w, _ in data], [t for _, t in data], epochs=7, batch=32)


def checked(text: str, a: int, b: int, kind: str) -> tuple[int, int] | None:
    """A found span, moved to where its kind begins and ends, or None if it can't be of that kind."""
    while a < b and text[a].isspace():
        a += 1
    s = text[a:b]
    digits = sum(c.isdigit() for c in s)
    if kind == "email":
        at = _AT.search(s)
        if not at:
            return None
        before = text[max(0, a + at.start() - 80) : a + at.start()]
        body = _EMAIL_BODY.search(before.rstrip())
        after = _DOMAIN.match(text, a + at.end())
        if not body or not after:
            return None
        start = a + at.start() - (len(before) - len(before.rstrip())) - len(body[0])
        if text[start - 1 : start] == "/":
            return None
        return start, after.end()
    if kind == "phone":
        spoken = sum(w.lower() in _DIGIT_WORDS for w in s.split())
        return (a, b) if 9 <= digits + spoken <= 15 else None
    if kind == "id_number":
        return (a, b) if digits in (9, 12) else None
    if kind == "address":
        # an address stands on one line, and no digits touch its house number
        alone = not re.search(r"[\r\n]", s) and text[a - 1 : a] not in (":", ",", ".") if a else True
        return (a, b) if s[:1].isdigit() and alone and re.search(r"[^\W\d_]{2}", s) else None
    return (a, b) if " " in s and not digits else None


def spans_of(text: str, starts: list[int], ends: list[int], tags: np.ndarray) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, in order, of the tags of a text's tokens."""
    out, k, n = [], 0, len(tags)
    marked = np.flatnonzero(tags)
    if not len(marked):
        return out
    for k in marked[(tags[marked] % 2) == 1]:  # B- tags have odd numbers
        end = int(k)
        while end + 1 < n and tags[end + 1] == tags[k] + 1:
            end += 1
        kind, a = LABELS[tags[k]][2:], starts[k]
        while a < ends[end]:
            found = checked(text, a, ends[end], kind)
            if found and (not out or found[0] >= out[-1][1]):
                out.append((*found, kind))
            if kind != "email" or not found or found[1] <= a:
                break
            a = found[1]  # addresses one after another may come as one span
    return out


def _found(texts: list[str], model: Crf, chunks: Chunks) -> list[list[tuple[int, int, str]]]:
    tags = model.viterbi(chunks.words, chunks.sequences(texts))
    # places in the text are only looked for where something was found
    return [spans_of(x, *located(x)[1:], t) if t.any() else [] for x, t in zip(texts, tags)]


def _slices(texts: list[str], chars: int = 3_000_000) -> Iterator[tuple[int, int]]:
    start = size = 0
    for k, x in enumerate(texts):
        if size and size + len(x) > chars:
            yield start, k
            start, size = k, 0
        size += len(x)
    if start < len(texts):
        yield start, len(texts)


def find(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, pii_kind, start_char, end_char): a row for every occurrence, half open, in code points.

    Method: the field over word shapes, decoded by Viterbi in numpy batches of tokens; a check then drops spans that
    can't be of their kind (an e-mail without @, a number with a wrong number of digits) and sets the exact ends.
    Whole texts are read; null and empty texts give no row; a key that comes twice gives the rows of each.
    """
    kind = df.schema[key].dataType.simpleString()
    held = df.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks(Words(attributes), cut)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for a, b in _slices(texts):
                rows, kinds, starts, ends = [], [], [], []
                for k, own in enumerate(_found(texts[a:b], held.value, chunks)):
                    for s, e, c in own:
                        rows.append(a + k)
                        kinds.append(c)
                        starts.append(s)
                        ends.append(e)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=[key, "pii_kind", "start_char", "end_char"])

    return spread(df.select(key, text)).mapInArrow(run, f"`{key}` {kind}, pii_kind string, start_char bigint, end_char bigint")


def redact(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "redacted") -> DataFrame:
    """(key, out): every text with its personal information replaced by ``[EMAIL]``, ``[PHONE]``, ``[ID_NUMBER]``,
    ``[ADDRESS]`` or ``[PERSON_NAME]``; all other characters stay. Null stays null."""
    kind = df.schema[key].dataType.simpleString()
    held = df.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks(Words(attributes), cut)
        for batch in batches:
            raw = batch.column(1).to_pylist()
            texts = [x or "" for x in raw]
            for a, b in _slices(texts):
                done = []
                for x, own, was in zip(texts[a:b], _found(texts[a:b], held.value, chunks), raw[a:b]):
                    parts, last = [], 0
                    for s, e, c in own:
                        parts += [x[last:s], f"[{c.upper()}]"]
                        last = e
                    done.append(None if was is None else "".join(parts) + x[last:])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(done, pa.string())], names=[key, out])

    return spread(df.select(key, text)).mapInArrow(run, f"`{key}` {kind}, `{out}` string")
