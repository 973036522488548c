"""Problem 6: records whose texts differ by small edits, by a prefix-tree join of n-gram sets.

A plain prefix tree over all sets, or prefix lists of single n-grams, grow with the square of a corpus that keeps
using the same phrases. So the trees are partitioned by their edges: sets are written in one global order (by hash),
and if two sets are similar enough, the merged order must hold neighbours that are neighbours in both. With sizes a and
b, overlap o >= t/(1+t)(a+b) and d = a+b-2o strangers cut the merged order into d+1 stretches at most, which leaves at
least o-d-1 shared neighbour pairs. These pairs are far rarer than n-grams. They are ordered by how many sets hold them
(a table of counters of fixed size), and only so many of a set's rarest are looked up that a similar set must hold one.
Sets that meet at an edge are bounded by their sizes and a bitmap; every pair that is left is decided in a prefix tree
of the partners' whole sets, in the global order, with bounds on what a branch can still bring.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from phonoloom.operators.components import connected_components
from phonoloom.plans.cluster import stored

WORD = re.compile(r"[^\W_]+")
#: Counters of edges, a byte each: 16 MB at most are sent to the tasks, whatever the input. Too few only cost look-ups.
COUNTERS, SLICES = 1 << 24, 64
#: An edge held by more sets than this is met in blocks of about so many sets, two by two.
HOT = 4096
#: Records of one text, byte by byte, are written out in all pairs up to this many pairs; more of them as pairs with their smallest.
EXPAND = 4096
#: Records of a set that meet those of another in one piece, about.
BLOCK = 64
#: Texts that are read again are named to the scan by broadcast up to this many bytes, else by a shuffle.
BROADCAST_BYTES, BYTES_A_ROW = 8 << 20, 32
BITS = ("bits0", "bits1", "bits2")
#: Bits of an n-gram's hash. Texts of an Arrow batch are numbered in the other 20.
GRAM_BITS = np.uint64(44)
GRAM_MASK = (np.uint64(1) << GRAM_BITS) - np.uint64(1)
#: Bits of an edge's hash.
EDGE_BITS = np.uint64(40)
#: The size of a set stands below; of an edge in blocks, bit 29 marks the first block's sets and bit 30 the second's.
SIDES = 29
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    return x ^ (x >> np.uint64(29))


class Sets:
    """n-gram sets of a batch of texts: ``grams`` in the global order, text by text, ``sizes``, and ``rows`` of each.
    The order is that of the n-grams' hashes; their 44 bits also tell them apart.

    Texts with fewer than ``least_words`` words have no set, or with ``short`` one n-gram of all their words.
    """

    def __init__(self, texts: list, n: int, least_words: int, numbers: dict[str, int], short: bool = False):
        words, lengths, rows, least = [], [], [], max(least_words, n)
        for row, text in enumerate(texts):
            own = WORD.findall(text.lower()) if text else []
            if len(own) < least and own and short:
                own = ["\0" + " ".join(own)] * n
            if len(own) >= (n if short else least):
                words += own
                lengths.append(len(own))
                rows.append(row)
        if len(numbers) > 500_000:
            numbers.clear()
        for w in set(words).difference(numbers):
            numbers[w] = xxhash.xxh3_64_intdigest(w)
        codes = np.fromiter(map(numbers.__getitem__, words), dtype=np.uint64, count=len(words))
        self.rows = np.array(rows, dtype=np.int64)
        owner = np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths)
        with np.errstate(over="ignore"):
            g = np.zeros(max(len(codes) - n + 1, 0), dtype=np.uint64)
            for k in range(n):
                g = _mix(g * _M1 + codes[k : len(codes) - n + 1 + k])
        if len(g):
            inside = owner[: len(g)] == owner[n - 1 :]
            # text and n-gram in one number, so that a plain sort orders both
            key = np.sort((owner[: len(g)][inside] << GRAM_BITS) | (g[inside] >> (np.uint64(64) - GRAM_BITS)))
            new = np.ones(len(key), dtype=bool)
            new[1:] = key[1:] != key[:-1]
            key = key[new]
            self.grams, self.owner = key & GRAM_MASK, (key >> GRAM_BITS).astype(np.int64)
        else:
            self.grams, self.owner = g, np.zeros(0, dtype=np.int64)
        self.sizes = np.bincount(self.owner, minlength=len(lengths)).astype(np.int64)
        self.ends = np.cumsum(self.sizes)

    def ids(self) -> np.ndarray:
        """A 64-bit number of every set."""
        raw, out, a = self.grams.tobytes(), np.empty(len(self.sizes), dtype=np.int64), 0
        for k, b in enumerate(self.ends):
            out[k] = np.uint64(xxhash.xxh3_64_intdigest(raw[8 * a : 8 * b])).astype(np.int64)
            a = int(b)
        return out

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """(pair, owner) of every two n-grams that follow each other in a set."""
        if len(self.grams) < 2:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        same = self.owner[1:] == self.owner[:-1]
        with np.errstate(over="ignore"):
            pair = _mix(self.grams[:-1] * _M1 + self.grams[1:])
        return pair[same], self.owner[1:][same]

    def bitmaps(self) -> np.ndarray:
        """192 bits a set (three numbers): a bit for each n-gram. Two sets differ in at least as many n-grams as bits."""
        flags = np.zeros((len(self.sizes), 192), dtype=np.uint8)
        flags[self.owner, (self.grams % np.uint64(192)).astype(np.int64)] = 1
        return np.packbits(flags, axis=1, bitorder="little").view(np.int64)


def _code(counts: np.ndarray) -> np.ndarray:
    """Counts as a byte: exact up to 16, from there on eighths of powers of two, rounded up."""
    with np.errstate(divide="ignore"):
        above = 16 + np.ceil(8 * np.log2(np.maximum(counts, 1) / 16.0) - 1e-9)
    return np.where(counts <= 16, counts, np.minimum(above, 255)).astype(np.uint8)


def _count(codes: np.ndarray) -> np.ndarray:
    """The largest count with this code."""
    c = codes.astype(np.float64)
    return np.where(c <= 16, c, np.floor(16 * np.exp2((c - 16) / 8) + 1e-6)).astype(np.int64)


def _packed(codes: np.ndarray) -> bytes | None:
    """A slice's counters above zero: steps from one to the next, and codes."""
    at = np.flatnonzero(codes)
    steps = np.diff(at, prepend=0).astype("<u4").tobytes()
    return zlib.compress(np.frombuffer(steps, np.uint8).reshape(-1, 4).T.tobytes() + codes[at].tobytes(), 6) if len(at) else None


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(places, codes) of a packed slice."""
    data = np.frombuffer(zlib.decompress(raw), np.uint8)
    n = len(data) // 5
    steps = np.ascontiguousarray(data[: 4 * n].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(steps.astype(np.int64)), data[4 * n :]


def _edges(sets: Sets, fresh: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(edge, owner) of the fresh sets: their neighbour pairs, and the n-grams of those that are too small for pairs to
    be certain."""
    pair, owner = sets.neighbours()
    use = fresh[owner]
    edge, owner = pair[use] >> (np.uint64(64) - EDGE_BITS), owner[use]
    small = (fresh & (sets.sizes <= _small(threshold)))[sets.owner]
    if small.any():
        edge = np.concatenate([edge, _mix(sets.grams[small] * _M1) >> (np.uint64(64) - EDGE_BITS)])
        owner = np.concatenate([owner, sets.owner[small]])
    return edge, owner


def _fresh(ids: np.ndarray, seen: set) -> np.ndarray:
    """Which sets this task sees for the first time."""
    fresh = np.zeros(len(ids), dtype=bool)
    for k, i in enumerate(ids.tolist()):
        if i not in seen:
            seen.add(i)
            fresh[k] = True
    return fresh


def _least_shared(size: np.ndarray, t: float) -> np.ndarray:
    """Neighbour pairs that a set of this size shares with any similar set; below 1 nothing is certain.

    o - d - 1 is smallest for the smallest similar set, which has t times the size.
    """
    whole = size * (1 + t)
    overlap = t / (1 + t) * whole
    return np.ceil(overlap - (whole - 2 * overlap) - 1 - 1e-9)


def _meet(edge: np.ndarray, set_id: np.ndarray, size: np.ndarray, bits: list[np.ndarray], t: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets that stand at the same edge, as far as their sizes and bitmaps allow the threshold. Rows come by edge."""
    side, size = size >> SIDES, (size & ((1 << SIDES) - 1)).astype(np.int64)
    ends = np.flatnonzero(np.append(edge[1:] != edge[:-1], True)) + 1
    end_of = np.repeat(ends, np.diff(ends, prepend=0))
    left, right, at, step = [], [], np.arange(len(edge)), 1
    while len(at := at[end_of[at] > at + step]):
        with_ = at + step
        a, b = size[at], size[with_]
        ok = (a >= b * t - 1e-6) & (b >= a * t - 1e-6) & (set_id[at] != set_id[with_])
        ok &= (side[at] == 0) | (side[at] != side[with_])
        i, j = at[ok], with_[ok]
        strangers = sum(np.bitwise_count((x[i] ^ x[j]).view(np.uint64)).astype(np.int64) for x in bits)
        ok = strangers <= (size[i] + size[j]) * ((1 - t) / (1 + t)) + 1e-6
        i, j = i[ok], j[ok]
        left.append(np.minimum(set_id[i], set_id[j]))
        right.append(np.maximum(set_id[i], set_id[j]))
        step += 1
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], axis=1), axis=0)
    return both[:, 0], both[:, 1]


def similar_sets(df: DataFrame, key: str, text: str, n: int = 3, threshold: float = 0.6, least_words: int = 40, short: bool = False) -> tuple[DataFrame, DataFrame]:
    """(members: key, set_id, text_id), (pairs: set_a, set_b): all sets with their records and the numbers of their texts,
    as often as they come, and all pairs of similar sets.

    Sets are those of n successive words (runs of letters and digits, without case) of texts with at least
    ``least_words`` words; with ``short``, shorter texts have one n-gram of all their words. Similar is a Jaccard index of
    at least ``threshold`` (above 0.5). Equal sets are one.
    """
    if threshold <= 0.5:
        raise ValueError("neighbours are only certain above 0.5")
    spark = df.sparkSession
    rows = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, text, F.xxhash64(text).alias("text_id"))
    kind = rows.schema[key].dataType.simpleString()
    width = COUNTERS // SLICES

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, numbers, seen, kinds = np.zeros(COUNTERS, dtype=np.uint32), {}, set(), None
        names = [key, "set_id", "text_id", "slice", "counts"]
        for batch in batches:
            kinds = batch.column(0).type
            sets = Sets(batch.column(1).to_pylist(), n, least_words, numbers, short)
            ids = sets.ids()
            edge, _ = _edges(sets, _fresh(ids, seen), threshold)
            np.add.at(counts, (edge % np.uint64(COUNTERS)).astype(np.int64), np.uint32(1))
            at, nothing = pa.array(sets.rows), pa.nulls(len(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(ids), batch.column(2).take(at), nothing.cast(pa.int32()), nothing.cast(pa.binary())], names=names)
        for k in range(SLICES if kinds else 0):
            raw = _packed(_code(counts[k * width : (k + 1) * width]))
            if raw:
                yield pa.RecordBatch.from_arrays([pa.nulls(1, kinds), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([k], pa.int32()), pa.array([raw], pa.binary())], names=names)

    seen_once = stored(rows.mapInArrow(survey, f"`{key}` {kind}, set_id bigint, text_id bigint, slice int, counts binary"), "p6-survey")
    members = seen_once.where("slice is null").select(key, "set_id", "text_id")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, codes = _unpacked(raw)
                sums.setdefault(k, np.zeros(width, dtype=np.int64))[at] += _count(codes)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([_packed(_code(s)) for s in sums.values()], pa.binary())], names=["slice", "counts"])

    # a table of fixed size: COUNTERS bytes and steps at most, whatever the input
    parts = seen_once.where("slice is not null").select("slice", "counts").mapInArrow(add, "slice int, counts binary")
    slices = parts.repartition("slice").mapInArrow(add, "slice int, counts binary").collect()
    held = spark.sparkContext.broadcast({r["slice"]: bytes(r["counts"]) for r in slices})

    def look_ups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, numbers, seen = np.zeros(COUNTERS, dtype=np.uint8), {}, set()
        for k, raw in held.value.items():
            at, c = _unpacked(raw)
            codes[k * width + at] = c
        for batch in batches:
            sets = Sets(batch.column(0).to_pylist(), n, least_words, numbers, short)
            ids = sets.ids()
            edge, owner = _edges(sets, _fresh(ids, seen), threshold)
            if not len(edge):
                continue
            rarity = codes[(edge % np.uint64(COUNTERS)).astype(np.int64)]
            # neighbour pairs by set and rarity; of sets with n-grams among them all are looked up
            order = np.lexsort((edge, rarity, owner))
            edge, owner, rarity = edge[order], owner[order], rarity[order]
            per = np.bincount(owner, minlength=len(ids))
            rank = np.arange(len(edge)) - np.repeat(np.cumsum(per) - per, per)
            certain = np.where(sets.sizes <= _small(threshold), 1, np.maximum(_least_shared(sets.sizes.astype(float), threshold), 1))
            keep = (rank < (per - certain + 1)[owner]) & (rarity > 1)
            edge, owner, rarity = edge[keep], owner[keep], rarity[keep]
            size = sets.sizes[owner]
            hot = rarity > _HOT_CODE
            if hot.any():
                edge, owner, size = _in_blocks(edge, owner, size, ids[owner], np.where(hot, -(-_count(rarity) // HOT), 1))
            bits = sets.bitmaps()
            yield pa.RecordBatch.from_arrays([pa.array(edge.view(np.int64)), pa.array(ids[owner]), pa.array(size.astype(np.int32)), *[pa.array(bits[owner, k]) for k in range(len(BITS))]], names=["edge", "set_id", "size", *BITS])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[np.ndarray]] = []

        def pairs(columns: list[np.ndarray]) -> pa.RecordBatch:
            a, b = _meet(columns[0], columns[1], columns[2], columns[3:], threshold)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["set_a", "set_b"])

        for batch in batches:
            kept.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if sum(len(c[0]) for c in kept) < 100_000:
                continue
            columns = [np.concatenate(c) for c in zip(*kept)]
            # the last edge may go on in the next batch
            whole = int(np.searchsorted(columns[0], columns[0][-1]))
            kept = [[c[whole:] for c in columns]]
            yield pairs([c[:whole] for c in columns])
        if kept:
            yield pairs([np.concatenate(c) for c in zip(*kept)])

    edges = rows.select(text).mapInArrow(look_ups, "edge bigint, set_id bigint, size int, bits0 bigint, bits1 bigint, bits2 bigint")
    candidates = stored(edges.repartition("edge").sortWithinPartitions("edge").mapInArrow(meet, "set_a bigint, set_b bigint").distinct(), "p6-candidates")
    wanted = candidates.select(F.explode(F.array("set_a", "set_b")).alias("set_id")).distinct()
    owners = stored(members.join(wanted, "set_id", "left_semi").groupBy("set_id").agg(F.min("text_id").alias("text_id")), "p6-owners")
    again = F.broadcast(owners) if owners.count() * BYTES_A_ROW <= BROADCAST_BYTES else owners
    texts = stored(rows.select("text_id", text).join(again, "text_id").groupBy("set_id").agg(F.min(text).alias("_text")), "p6-texts")
    both = candidates.join(texts.select(F.col("set_id").alias("set_a"), F.col("_text").alias("text_a")), "set_a").join(texts.select(F.col("set_id").alias("set_b"), F.col("_text").alias("text_b")), "set_b")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, int] = {}
        for batch in batches:
            yield _decide(batch, n, least_words, threshold, short, numbers)

    # the last join has brought the partners of a right set together
    pairs = both.sortWithinPartitions("set_b", "set_a").select("set_a", "set_b", "text_a", "text_b").mapInArrow(decide, "set_a bigint, set_b bigint")
    return members, pairs


_HOT_CODE = int(_code(np.array([HOT]))[0])


def _in_blocks(edge: np.ndarray, owner: np.ndarray, size: np.ndarray, ids: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of an edge that stands in several blocks, once for each block they meet, their own among them. Every two
    blocks have an edge of their own, on which only the two meet each other."""
    row = np.repeat(np.arange(len(edge)), blocks)
    other = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    with np.errstate(over="ignore"):
        own = ((_mix(ids.view(np.uint64) * _M1) >> np.uint64(20)) % blocks.astype(np.uint64)).astype(np.int64)[row]
        low, high = np.minimum(own, other), np.maximum(own, other)
        salted = _mix((edge[row] * _M1 + low.astype(np.uint64)) * _M1 + high.astype(np.uint64)) >> (np.uint64(64) - EDGE_BITS)
    side = np.where(own == other, 0, np.where(own < other, 1, 2))
    return np.where(blocks[row] > 1, salted, edge[row]), owner[row], size[row] | (side << SIDES)


def _small(t: float) -> int:
    """Sets up to this size may have a similar partner with which no shared neighbours are certain: together
    they are below a bound, and the larger has at most 1 / t times the n-grams of the smaller."""
    together = 2 / (3 * t / (1 + t) - 1)  # o - d - 1 >= 1 from this sum of sizes on
    return math.ceil(together / (1 + t)) + 1


class PrefixTree:
    """Ordered sets as paths; a node knows how long the longest path below it still is, and the smallest set.

    A node is a list: what follows by n-gram, names that end here with their sizes, longest rest, smallest size.
    """

    def __init__(self):
        self.root: list = [{}, [], 0, 1 << 30]

    def add(self, items: list, name: int) -> None:
        node, size = self.root, len(items)
        for k, item in enumerate(items):
            if node[2] < size - k:
                node[2] = size - k
            if node[3] > size:
                node[3] = size
            nxt = node[0].get(item)
            if nxt is None:
                nxt = node[0][item] = [{}, [], 0, size]
            node = nxt
        node[1].append((name, size))
        node[3] = min(node[3], size)

    def similar(self, probe: list, threshold: float) -> list[int]:
        """Names of the sets whose Jaccard index with the probe reaches the threshold. Sets with the same beginning
        share its overlap; a branch is left when even its longest rest can't bring the overlap that is needed."""
        place = {x: k for k, x in enumerate(probe)}
        size, found = len(probe), []
        share = threshold / (1 + threshold)
        stack = [(self.root, 0, -1)]
        while stack:
            node, overlap, last = stack.pop()
            below, ends, longest, least = node
            for name, length in ends:
                if overlap >= threshold * (size + length - overlap) - 1e-9:
                    found.append(name)
            rest = size - 1 - last
            if not below or overlap + (longest if longest < rest else rest) < share * (size + least) - 1e-9:
                continue
            for x, child in below.items():
                at = place.get(x)
                stack.append((child, overlap, last) if at is None else (child, overlap + 1, at))
        return found


def _decide(batch: pa.RecordBatch, n: int, least_words: int, threshold: float, short: bool, numbers: dict[str, int]) -> pa.RecordBatch:
    """The pairs of a batch that are similar: the partners of each right set are a prefix tree, which it goes down."""
    left, right = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    names, at = np.unique(np.concatenate([left, right]), return_index=True)
    texts = pa.concat_arrays([batch.column(2), batch.column(3)]).take(pa.array(at)).to_pylist()
    sets = Sets(texts, n, least_words, numbers, short)
    grams, begins = sets.grams.tolist(), (sets.ends - sets.sizes).tolist()
    ends, place, kept = sets.ends.tolist(), np.searchsorted(names[sets.rows], np.stack([left, right])), []
    first = np.flatnonzero(np.append(True, right[1:] != right[:-1])) if len(left) else np.zeros(0, np.int64)
    for k, end in zip(first.tolist(), [*first[1:].tolist(), len(left)]):
        tree = PrefixTree()
        for i in range(k, end):
            j = place[0, i]
            tree.add(grams[begins[j] : ends[j]], i)
        j = place[1, k]
        kept += tree.similar(grams[begins[j] : ends[j]], threshold)
    kept.sort()
    return pa.RecordBatch.from_arrays([pa.array(left[kept], pa.int64()), pa.array(right[kept], pa.int64())], names=["set_a", "set_b"])


def near_copies(df: DataFrame, key: str = "item_id", text: str = "transcript_raw", n: int = 3, threshold: float = 0.6, least_words: int = 40) -> DataFrame:
    """(key_a, key_b) with key_a < key_b: pairs of records whose texts' n-gram sets are similar.

    All pairs of records with different texts are written out. Records with the same text, byte by byte, are too while
    they make at most EXPAND pairs; beyond, they come as pairs of each with the smallest, and ``exact_copies`` tells
    which records have one text. Null keys and texts and texts that are too short give no row; a key with several
    texts has those of each.
    """
    members, pairs = similar_sets(df, key, text, n, threshold, least_words)
    pairs = stored(pairs, "p6-pairs")
    # most sets stand alone: only those with a copy or a partner go on
    copies = members.groupBy("set_id").agg(F.count("*").alias("_m")).where("_m > 1").select("set_id")
    involved = copies.unionByName(pairs.select(F.explode(F.array("set_a", "set_b")).alias("set_id"))).distinct()
    members = stored(members.join(involved, "set_id", "left_semi").distinct(), "p6-involved")
    texts = members.groupBy("set_id", "text_id").agg(F.count("*").alias("_n"), F.min(key).alias("_least"))
    large = texts.where(F.col("_n") * F.col("_n") > EXPAND)
    star = members.join(large, ["set_id", "text_id"]).select(F.col("_least").alias("x"), F.col(key).alias("y"))
    # records of a large text stand in blocks of their own, the others of the set share blocks
    units = large.select("set_id", F.col("text_id").alias("_of"), "_n").unionByName(
        texts.where(F.col("_n") * F.col("_n") <= EXPAND).groupBy("set_id").agg(F.sum("_n").alias("_n")).withColumn("_of", F.lit(None).cast("bigint"))
    )
    units = stored(units.withColumn("_blocks", F.ceil(F.col("_n") / BLOCK)), "p6-units")
    owned = members.join(large.select("set_id", "text_id", F.col("text_id").alias("_of")), ["set_id", "text_id"], "left").select("set_id", "_of", key)
    m, u = owned.alias("m"), units.alias("u")
    at = m.join(u, (F.col("m.set_id") == F.col("u.set_id")) & F.col("m._of").eqNullSafe(F.col("u._of")))
    block = F.struct(F.col("u.set_id"), F.col("u._of").isNull().alias("_mixed"), F.coalesce("u._of", F.lit(0)).alias("_of"), F.pmod(F.xxhash64(f"m.{key}"), "u._blocks").alias("_no"))
    placed = stored(at.select(block.alias("block"), F.col(f"m.{key}").alias("x")), "p6-placed")
    blocks = units.select("set_id", "_of", "_n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1)).alias("_no"))
    blocks = blocks.select("set_id", "_of", "_n", F.struct("set_id", F.col("_of").isNull().alias("_mixed"), F.coalesce("_of", F.lit(0)).alias("_of"), "_no").alias("block"))
    a, b = blocks.alias("a"), blocks.alias("b")
    same_text = F.coalesce(F.col("a._of") == F.col("b._of"), F.lit(False))
    alone = (F.col("a.block") == F.col("b.block")) & (F.col("a._n") == 1)
    meet = (F.col("a.set_id") == F.col("b.set_id")) & (F.col("a.block") <= F.col("b.block")) & ~same_text & ~alone
    inside = a.join(b, meet).select(F.col("a.block").alias("block_a"), F.col("b.block").alias("block_b"))
    between = pairs.join(blocks.select(F.col("set_id").alias("set_a"), F.col("block").alias("block_a")), "set_a").join(blocks.select(F.col("set_id").alias("set_b"), F.col("block").alias("block_b")), "set_b").select("block_a", "block_b")
    met = inside.unionByName(between)
    written = met.join(placed.select(F.col("block").alias("block_a"), "x"), "block_a").join(placed.select(F.col("block").alias("block_b"), F.col("x").alias("y")), "block_b").select("x", "y")
    every = written.unionByName(star).where("x <> y")
    return every.select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b")).distinct()


def exact_copies(df: DataFrame, key: str = "item_id", text: str = "transcript_raw", n: int = 3, least_words: int = 40) -> DataFrame:
    """(key, representative, text_id): every record with a text that ``near_copies`` compares, the smallest key that has
    the same text, byte by byte, and the text's MD5. Records of one text_id are pairs of each other, so that with the rows of
    ``near_copies`` all pairs follow. A key with several texts has a row for each."""

    def long_enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [len(WORD.findall(t.lower())) >= max(least_words, n) for t in batch.column(2).to_pylist()]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    rows = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, F.md5(text).alias("text_id"), text)
    kind = rows.schema[key].dataType.simpleString()
    kept = stored(rows.mapInArrow(long_enough, f"`{key}` {kind}, text_id string").distinct(), "p6-exact")
    return kept.join(kept.groupBy("text_id").agg(F.min(key).alias("representative")), "text_id").select(key, "representative", "text_id")


def copy_groups(df: DataFrame, key: str = "item_id", text: str = "transcript_raw", n: int = 5, threshold: float = 0.8, least_words: int = 5) -> DataFrame:
    """(key, group_id, n_links): every key, the smallest key of the records it is linked with through similar texts
    (itself, if none), and the number of other records it is similar to.

    A text of fewer than ``least_words`` words is one n-gram, so that it is similar to those with the same words only.
    Records whose texts have no words, empty and null ones among them, are groups of their own with 0 links; null keys
    have no row. A key with several texts is in the group of the smallest key any of them leads to.
    """
    members, pairs = similar_sets(df, key, text, n, threshold, least_words, short=True)
    members = members.select(key, "set_id").distinct()
    pairs = stored(pairs, "p6-pairs")
    labels = connected_components(pairs, "set_a", "set_b")
    sizes = members.groupBy("set_id").agg(F.count("*").alias("_m"))
    both = pairs.select("set_a", "set_b").unionByName(pairs.select(F.col("set_b").alias("set_a"), F.col("set_a").alias("set_b")))
    others = both.join(sizes.withColumnRenamed("set_id", "set_b"), "set_b").groupBy(F.col("set_a").alias("set_id")).agg(F.sum("_m").alias("_others"))
    named = sizes.join(labels, sizes.set_id == labels.node, "left").select("set_id", "_m", F.coalesce("component", "set_id").alias("_class"))
    named = named.join(others, "set_id", "left").withColumn("_links", F.col("_m") - 1 + F.coalesce("_others", F.lit(0)))
    at = members.join(named, "set_id")
    heads = at.groupBy("_class").agg(F.min(key).alias("group_id"))
    grouped = at.join(heads, "_class").groupBy(key).agg(F.min("group_id").alias("group_id"), F.max("_links").alias("n_links"))
    every = df.where(F.col(key).isNotNull()).select(key).distinct()
    return every.join(grouped, key, "left").select(key, F.coalesce("group_id", F.col(key)).alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
