"""Problem 3: new batches checked against everything before them, over a table of chunks that only grows.

Content is cut where a rolling hash of its last bytes says so, so that equal stretches give equal chunks
wherever they stand. A persistent table says which contents hold a chunk; the bytes a new content shares with an
old one are those of the chunks they share. For records, the contents are what their ids and addresses name
(:mod:`identity`), a line each in its one canonical spelling, cut fine enough that a line is several chunks; a line
that shares most of its bytes with an old one is a candidate, and an exact check follows.

The history knows each line's video by a label. A batch reads the table's rows of its own chunks and the lines they
lead to, never the records or links behind them; labels that a batch shows to be one video are merged in a small table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from phonoloom.llm.identity import with_video_keys
from phonoloom.operators.components import connected_components
from phonoloom.plans.cluster import stored

#: Bytes the rolling hash looks back, the least and the largest chunk, and one boundary in so many places.
WINDOW, LEAST, MOST, ONE_IN = 8, 24, 256, 16
#: The same for lines that name a video, and the share of a line's bytes that makes a candidate.
LINE_CUT, LINE_COVERAGE = {"least": 6, "most": 64, "one_in": 4}, 0.8
_BASE = np.uint64(0x9E3779B97F4A7C15)


def chunk_ends(data: bytes, least: int = LEAST, most: int = MOST, one_in: int = ONE_IN) -> list[int]:
    """Where the chunks of ``data`` end. An end lies where the hash of the last WINDOW bytes falls on the mask,
    at least ``least`` bytes after the one before, and after ``most`` bytes at the latest."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    raw = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    roll = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        power = np.uint64(1)
        for k in range(min(WINDOW, n)):
            roll[k:] += raw[: n - k] * power
            power *= _BASE
        roll ^= roll >> np.uint64(31)
        roll *= _BASE
    cuts = np.flatnonzero((roll >> np.uint64(40)) % np.uint64(one_in) == 0) + 1
    ends, at, k = [], 0, 0
    while at < n:
        k = int(np.searchsorted(cuts, at + least))
        end = min(int(cuts[k]) if k < len(cuts) else n, at + most, n)
        ends.append(end)
        at = end
    return ends


def content_chunks(contents: DataFrame, key: str = "content", text: str | None = None, least: int = LEAST, most: int = MOST, one_in: int = ONE_IN) -> DataFrame:
    """(content, chunk_no, chunk, n_bytes): a row for every chunk of every content; ``chunk`` is its hash.

    ``text`` is the column that is cut, the key itself if it isn't given. Null and empty contents have no chunks.
    Whole contents are cut, whatever their length.
    """
    import xxhash

    kind = contents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, numbers, hashes, sizes = [], [], [], []
            for row, value in enumerate(batch.column(1).to_pylist()):
                data = (value or "").encode("utf-8", "surrogatepass")
                at = 0
                for no, end in enumerate(chunk_ends(data, least, most, one_in)):
                    owners.append(row)
                    numbers.append(no)
                    hashes.append(np.uint64(xxhash.xxh3_64_intdigest(data[at:end])).astype(np.int64))
                    sizes.append(end - at)
                    at = end
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owners, pa.int64())), pa.array(numbers, pa.int32()), pa.array(hashes, pa.int64()), pa.array(sizes, pa.int32())], names=["content", "chunk_no", "chunk", "n_bytes"])

    return contents.select(F.col(key), F.col(text or key).alias("_text")).mapInArrow(run, f"content {kind}, chunk_no int, chunk bigint, n_bytes int")


def covered(new: DataFrame, old: DataFrame, coverage: float = 1.0) -> DataFrame:
    """(content, match, shared, total): pairs of a new and an old content that share ``coverage`` of the new one's bytes.

    Both are tables of :func:`content_chunks`. Only the old rows of the new contents' chunks are read. Only chunks that
    must contain a match are looked up: a new content's rarest chunks, until the rest alone could no longer reach the
    coverage. Nothing is lost by that, and a chunk that very many contents hold is not looked up unless a content has
    nothing rarer.
    """
    own = new.groupBy("content", "chunk").agg(F.sum("n_bytes").alias("n_bytes"))
    touched = old.select("content", "chunk").join(own.select("chunk").distinct(), "chunk", "left_semi")
    seen = touched.groupBy("chunk").agg(F.count("*").alias("_held"))
    ranked = own.join(seen, "chunk", "left").withColumn("_held", F.coalesce("_held", F.lit(0)))
    w = Window.partitionBy("content")
    ranked = ranked.withColumn("total", F.sum("n_bytes").over(w)).withColumn("_before", F.coalesce(F.sum("n_bytes").over(w.orderBy("_held", "chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # chunks from here on hold less than the coverage: a match must hold one of those before
    probes = ranked.where((F.col("total") - F.col("_before") >= F.col("total") * coverage) & (F.col("_held") > 0))
    pairs = probes.join(touched.withColumnRenamed("content", "match"), "chunk").select("content", "match", "total").distinct()
    both = pairs.join(own, "content").join(touched.select(F.col("content").alias("match"), "chunk").distinct(), ["match", "chunk"])
    return both.groupBy("content", "match").agg(F.sum("n_bytes").alias("shared"), F.first("total").alias("total")).where(F.col("shared") >= F.col("total") * coverage)


class ChunkHistory:
    """What has been accepted so far, below ``path``: a folder a batch with its new lines (contents), their chunks by
    bucket, and how labels were merged up to then; a batch counts once its commit is written.

    Batches that are taken in again, after a failure or by mistake, replace their own folders before their commit and
    change nothing after it; either way their result is that against the batches below them.
    """

    CHUNKS, CONTENTS, MERGES = "chunk bigint, content bigint, n_bytes int", "content bigint, line string, label string", "label string, into string"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 8):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def commits(self, before: int | None = None) -> dict[int, int]:
        """Batches taken in, in order, with the batch whose table of merges was the current one after it."""
        try:
            rows = self.spark.read.schema("batch int, merges int").option("recursiveFileLookup", "true").json(f"{self.path}/commits").collect()  # one row a batch
        except Exception as e:  # nothing was taken in yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return {}
        return {r["batch"]: r["merges"] for r in sorted(rows) if before is None or r["batch"] < before}

    def _read(self, name: str, schema: str, batches: list[int]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*[f"{self.path}/{name}/batch={b}" for b in batches])

    def chunks(self, commits: dict[int, int], of: DataFrame | None = None) -> DataFrame:
        """Chunks of the batches, of the buckets that the chunks of ``of`` fall into."""
        rows = self._read("chunks", f"{self.CHUNKS}, bucket int", list(commits))
        if of is not None and commits:
            used = [r[0] for r in of.select(self._bucket()).distinct().collect()]  # at most as many as there are buckets
            rows = rows.where(F.col("bucket").isin(used)) if len(used) < self.buckets else rows
        return rows.drop("bucket")

    def contents(self, commits: dict[int, int]) -> DataFrame:
        return self._read("contents", self.CONTENTS, list(commits))

    def merges(self, commits: dict[int, int]) -> DataFrame:
        """(label, into): what every label that was merged is now."""
        current = list(commits.values())[-1:]
        return self._read("merges", self.MERGES, [b for b in current if b is not None])

    def _bucket(self):
        return F.pmod(F.col("chunk"), F.lit(self.buckets)).cast("int").alias("bucket")

    def commit(self, batch: int, merges: int | None) -> None:
        """From here on the batch counts."""
        row = self.spark.range(1, numPartitions=1).select(F.lit(batch).cast("int").alias("batch"), F.lit(merges).cast("int").alias("merges"))
        row.write.mode("overwrite").json(f"{self.path}/commits/batch={batch}")

    def ingest(self, numbers: list[int], keyed: DataFrame) -> DataFrame:
        """Takes in the keys (id_key, address_key, batch_no) of the records of batches ``numbers``, as one step; gives
        (line, video, first_batch) for every line they name: the label of its video as of now, and the lowest batch that
        knows the video, which is below all ``numbers`` where the history does.

        A video is known through any chain of links that these batches or lower ones tell of.
        """
        last = max(numbers)
        every = self.commits()
        commits = {b: m for b, m in every.items() if b < min(numbers)}
        pairs = keyed.groupBy("id_key", "address_key").agg(F.min("batch_no").alias("batch_no"))
        lines = pairs.select(F.explode(F.array("id_key", "address_key")).alias("line"), "batch_no").where("line is not null").groupBy("line").agg(F.min("batch_no").alias("batch_no")).withColumn("content", F.xxhash64("line"))
        chunks = stored(content_chunks(lines, "content", "line", **LINE_CUT), "p3-chunks")
        near = covered(chunks, self.chunks(commits, chunks), LINE_COVERAGE)
        old = self.contents(commits).select(F.col("content").alias("match"), F.col("line").alias("_line"), "label")
        exact = near.join(old, "match").join(lines, "content").where("line = _line")  # coverage says most bytes agree; this, all of them
        known = exact.select("line", "label").join(self.merges(commits), "label", "left").select("line", F.coalesce("into", "label").alias("label"))
        # the graph of these batches: old labels and new lines
        first = F.when(F.col("label").isNotNull(), F.lit(min(numbers) - 1)).otherwise(F.col("batch_no"))
        node = lines.join(known, "line", "left").select("line", "content", F.coalesce("label", "line").alias("node"), F.col("label").isNotNull().alias("old"), first.alias("first_batch"))
        node = stored(node, "p3-nodes")
        at = lambda c: node.select(F.col("line").alias(c), F.col("node").alias(f"_{c}"))
        edges = pairs.where("id_key <> address_key").join(at("id_key"), "id_key").join(at("address_key"), "address_key")
        labels = connected_components(edges.where("_id_key <> _address_key"), "_id_key", "_address_key")
        joined = node.join(labels, "node", "left").withColumn("video", F.coalesce("component", "node")).drop("component")
        lowest = joined.groupBy("video").agg(F.min("first_batch").alias("first_batch"))
        result = stored(joined.drop("first_batch").join(lowest, "video").select("line", "content", "node", "old", "video", "first_batch"), "p3-result")
        if last not in every:
            fresh = result.where("not old").select("content", "line", F.col("video").alias("label"))
            fresh.write.mode("overwrite").parquet(f"{self.path}/contents/batch={last}")
            new = chunks.join(fresh, "content", "left_semi").select("chunk", "content", "n_bytes", self._bucket())
            new.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/chunks/batch={last}")
            self.commit(last, self._merge(last, commits, result))
        return result.select("line", "video", "first_batch")

    def _merge(self, batch: int, commits: dict[int, int], result: DataFrame) -> int | None:
        """Writes the table of merges anew if the batch has merged any; the batch that has the current one."""
        moved = result.where("old and node <> video").select(F.col("node").alias("label"), F.col("video").alias("into")).distinct()
        if moved.isEmpty():
            return list(commits.values())[-1] if commits else None
        before = self.merges(commits).withColumnRenamed("into", "_i").join(moved.withColumnRenamed("label", "_i").withColumnRenamed("into", "_j"), "_i", "left")
        before.select("label", F.coalesce("_j", "_i").alias("into")).unionByName(moved).write.mode("overwrite").parquet(f"{self.path}/merges/batch={batch}")
        return batch


def repeated_records(history: ChunkHistory, batches: DataFrame, number: str = "record_no", batch: str = "batch_no") -> DataFrame:
    """(number) of the records that bring nothing new: their video is in the history or a lower batch, or a lower
    number of their batch has the same video and segment (no segment number equals no segment number).

    The batches at hand are taken in as one step against what was left in the history; a batch that comes alone is
    looked up in the chunks of all before it. Links count when a batch tells of them, so that in a backlog a later batch
    may show that two earlier records are of one video. Records that name no video are new; records without a batch
    number have no place in the order and no row. Records are taken into the history whether or not they repeat one:
    repeating says nothing new, so nothing is appended for them. An empty table gives an empty result.
    """
    keyed = with_video_keys(batches.where(F.col(batch).isNotNull()).select(F.col(number).alias("_no"), F.col(batch).cast("int").alias("batch_no"), "item_id", "source_url"))
    keyed = stored(keyed.select("_no", "batch_no", "id_key", "address_key", "segment"), "p3-keyed").where("id_key is not null or address_key is not null")
    numbers = [r[0] for r in keyed.select("batch_no").distinct().collect()]  # one row a batch
    if not numbers:
        return keyed.select(F.col("_no").alias(number)).limit(0)
    at = keyed.withColumn("line", F.coalesce("id_key", "address_key")).join(history.ingest(numbers, keyed), "line")
    lowest = at.groupBy("batch_no", "video", "segment").agg(F.min("_no").alias("_lowest"))
    same = (F.col("a.batch_no") == F.col("l.batch_no")) & (F.col("a.video") == F.col("l.video")) & F.col("a.segment").eqNullSafe(F.col("l.segment"))
    return at.alias("a").join(lowest.alias("l"), same).where("a.first_batch < a.batch_no or l._lowest < a._no").select(F.col("a._no").alias(number))


def start_history(spark: SparkSession, path: str, accepted: DataFrame) -> ChunkHistory:
    """A history that holds the accepted records, as batch 0. This once, all of them are read and linked."""
    history = ChunkHistory(spark, path)
    keyed = with_video_keys(accepted.select("item_id", "source_url")).select("id_key", "address_key")
    # parsed once: a filter on parsed columns would be planned below the projection and parse again
    keyed = stored(keyed.distinct(), "p3-history").where("id_key is not null or address_key is not null")
    history.ingest([0], keyed.withColumn("batch_no", F.lit(0)))
    return history
