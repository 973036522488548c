"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from phonoloom.plans.cluster import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("low"))
    hung = down.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return hung.unionByName(low.select("u", F.col("low").alias("v"))).where("u <> v").distinct()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all edges that come, by joining trees; the smaller root stays."""
    above: dict = {}

    def root(x):
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(above.setdefault(u, u)), root(above.setdefault(v, v))
            above[max(a, b)] = min(a, b)
    if above:
        kind = batch.schema.field(0).type
        yield pa.RecordBatch.from_arrays([pa.array(list(above), kind), pa.array([root(x) for x in above], kind)], names=["node", "component"])


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", rounds: int = 50, small: int = 50_000) -> DataFrame:
    """(node, component) of every node of ``edges``; the component is its smallest node.

    Up to ``small`` edges, some megabytes, are joined in one task; more of them go by stars. There every step is a min-aggregation (combined before the shuffle) and an equi-join, so a hub with a third of
    all edges is split by the skew join and no neighbourhood is gathered in a task. Edges with a null end and
    loops are dropped; an empty edge table gives an empty result.
    """
    now = stored(
        edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc"
    )
    if now.count() <= small:
        kind = now.schema["u"].dataType.simpleString()
        return stored(now.coalesce(1).mapInArrow(_joined, f"node {kind}, component {kind}"), "cc")
    mark = None
    for _ in range(rounds):
        now = stored(_small_star(_large_star(now)), "cc")
        n, h = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, h) == mark:
            break
        mark = (n, h)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    star = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.unionByName(star.select(F.col("component").alias("node"), "component").distinct())
