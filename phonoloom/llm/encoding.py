"""Problem 8: the ids of a public tokenizer for every text, and texts and offsets back from ids."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from phonoloom.plans.cluster import spread, tokenizer_dir

#: Texts that go to the library at once, by characters: keeps a task's memory flat over very long texts.
CHARS = 2_000_000


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    t.no_truncation()
    t.no_padding()
    return t


def byte_table() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next
    free one from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return table | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=4)
def id_bytes(path: str) -> dict[int, bytes]:
    """The bytes of every id."""
    table = byte_table()
    t = tokenizer(path)
    special = {i for i, a in t.get_added_tokens_decoder().items() if a.special}
    return {i: s.encode() if i in special else bytes(table[c] for c in s) for s, i in t.get_vocab().items()}


def decode_ids(ids, path: str) -> str:
    """The text of ids: their bytes one after another, read as UTF-8; a character split over several ids comes
    out whole, bytes that are no UTF-8 become U+FFFD. Unknown ids count as no bytes."""
    known = id_bytes(path)
    return b"".join(known.get(int(i), b"") for i in ids).decode("utf-8", errors="replace")


def byte_spans(ids, path: str) -> list[tuple[int, int]]:
    """(first, last + 1) code point that each id has a byte of; ids that share a character overlap there."""
    known = id_bytes(path)
    parts = [known.get(int(i), b"") for i in ids]
    raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
    starts = (raw & 0xC0) != 0x80
    char = np.cumsum(starts) - 1
    ends = np.cumsum([len(p) for p in parts]) if parts else np.array([], dtype=int)
    spans, at = [], 0
    for end in ends:
        spans.append((int(char[at]), int(char[end - 1]) + 1) if end > at else (0, 0))
        at = end
    return spans


# A space between two characters that are none begins a piece of its own in byte-level vocabularies: no piece spans it,
# whatever stands around. So texts can be cut there and each different part goes to the library once.
_CUT, _AROUND = re.compile(r"(?<=\S)(?= \S)"), re.compile(r"[^\S ] [^\S ]")


def parts(text: str) -> list[str]:
    """The text cut before spaces that stand between other characters."""
    words = text.split(" ")
    if "" in words or _AROUND.search(text):
        return _CUT.split(text)
    return [words[0], *map(" ".__add__, words[1:])]


class Pieces:
    """Ids of parts that have been met, each encoded by the library once. Holds at most about ``most`` parts."""

    def __init__(self, path: str, most: int = 400_000):
        self.tokenizer, self.most = tokenizer(path), most
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.begin, self.length = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str], only_count: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, where each text begins, with the end behind); with ``only_count`` the
        ids are left out."""
        cut = list(map(parts, texts))
        words = list(chain.from_iterable(cut))
        if len(self.number) > self.most:
            self._clear()
        new = list(set(words).difference(self.number))
        if new:
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
            length = np.fromiter(map(len, lists), np.int64, len(lists))
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(length) - length])
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(lists), np.int32, int(length.sum()))])
            self.length = np.concatenate([self.length, length])
        codes = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        length = self.length[codes]
        ends = np.cumsum(length)
        upto = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))  # a text has one part at least
        offsets = np.concatenate([[0], ends[upto - 1]]) if len(upto) else np.zeros(1, np.int64)
        if only_count:
            return np.zeros(0, np.int32), offsets
        at = np.repeat(self.begin[codes] - (ends - length), length) + np.arange(int(offsets[-1]))
        return self.flat[at], offsets


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > CHARS:
            yield start, k
            start, size = k, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "ids", vocabulary: str = "byte_bpe_50k.json", only_count: bool = False) -> DataFrame:
    """(key, out): the ids of every text without special tokens; with ``only_count`` their number instead.

    Null and empty texts have no ids: an empty list (count 0). Strings of special tokens in a text are encoded as
    ordinary text. Every row gives one row; other columns are not read. No shuffle, except of inputs too small to keep
    all cores busy: Arrow batches are encoded where they lie, in slices of at most about CHARS characters (one longer
    text goes whole). The vocabulary is a byte-level one, in which no piece spans a space between two words: a part
    between such spaces goes to the library when a task first meets it.
    """
    path = os.path.join(tokenizer_dir(), vocabulary)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for batch in batches:
            keys, texts = batch.column(0), [x or "" for x in batch.column(1).to_pylist()]
            for a, b in _slices(texts):
                flat, offsets = pieces.encode(texts[a:b], only_count)
                value = pa.array(np.diff(offsets)) if only_count else pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), value], names=[key, out])

    return spread(df.select(key, F.col(text).alias("_text"))).mapInArrow(run, f"`{key}` {kind}, `{out}` {'bigint' if only_count else 'array<int>'}")


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", out: str = "text", vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """(key, out): the text of every list of ids; an empty or null list gives the empty text."""
    path = os.path.join(tokenizer_dir(), vocabulary)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode_ids(x or (), path) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, out])

    return df.select(key, ids).mapInArrow(run, f"`{key}` {kind}, `{out}` string")


def token_spans(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """(key, spans): for every id of a text the code points it covers, half open; a character whose bytes
    fall into several ids is in each of their spans."""
    path = os.path.join(tokenizer_dir(), vocabulary)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1).to_pylist()
            spans = [[{"start": a, "end": b} for a, b in byte_spans(x or (), path)] for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], names=[key, "spans"])

    return encode(df, key, text, "ids", vocabulary).mapInArrow(run, f"`{key}` {kind}, spans array<struct<start:int,end:int>>")
