"""Problem 1: splits in which the records of one video stay together.

Records are linked by what their ids and addresses name (:mod:`identity`); the linked groups are the units that a
component swap search then spreads over the splits.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from phonoloom.llm.identity import with_video_keys
from phonoloom.operators.components import connected_components
from phonoloom.plans.cluster import stored

SPLITS = ("train", "validation", "test")
#: Components above this share of all records are placed first; there are at most 1 / share of them.
HEAVY_SHARE = 0.002
#: Components of one annealing task; with five numbers each this is about a megabyte.
BUCKET = 20_000


def linked_records(df: DataFrame, item_id: str = "item_id", address: str = "source_url") -> DataFrame:
    """(item_id, component) of every distinct id: equal components are one video, null says nothing links it.

    Null ids are no records and give no row. Repeated rows count once. The link graph holds keys, not records:
    only records that name two different keys add an edge.
    """
    keyed = with_video_keys(df.select(F.col(item_id).alias("item_id"), F.col(address).alias("_address")).where("item_id is not null"), "item_id", "_address")
    # parsed once: a filter on parsed columns would be planned below the projection and parse again
    keyed = stored(keyed.select("item_id", "id_key", "address_key"), "p1-keyed").where("id_key is not null or address_key is not null")
    items = keyed.groupBy("item_id").agg(F.min(F.least("id_key", "address_key")).alias("home"))
    # the rows of one id name one key, unless the id says nothing or takes its platform from the address
    loose = ~F.lower("item_id").rlike(r"^\s*(tt|fb)_(\d{19}|\d{15})(_\d+)?\s*$")
    inside = keyed.where("id_key <> address_key").select(F.col("id_key").alias("src"), F.col("address_key").alias("dst"))
    across = keyed.where(loose).join(items, "item_id").select(F.col("home").alias("src"), F.explode(F.array("id_key", "address_key")).alias("dst")).where("dst is not null and src <> dst")
    labels = connected_components(inside.unionByName(across).distinct())
    return items.join(labels, items.home == labels.node, "left").select("item_id", F.coalesce("component", "home").alias("component"))


def anneal(sizes: np.ndarray, targets: np.ndarray, start: np.ndarray, seed: int, steps: int) -> tuple[np.ndarray, float]:
    """Splits of components by annealed moves and swaps, and the deviation of the best assignment seen.

    ``sizes`` (components x measures: records, then records of each label), ``targets`` (splits x measures).
    The deviation is the sum of squared differences, each measure taken against its total.
    """
    rng = np.random.default_rng(seed)
    n, splits = len(sizes), len(targets)
    scale = 1.0 / np.maximum(targets.sum(axis=0), 1.0)
    got = np.zeros_like(targets)
    np.add.at(got, start, sizes)
    weight = [1.0] + [0.25] * (sizes.shape[1] - 1)
    off = ((got - targets) * scale).tolist()
    rel = (sizes * scale).tolist()
    cost = sum(w * x * x for row in off for w, x in zip(weight, row))
    if n == 0 or splits < 2:
        return start.copy(), cost
    # an average component's move sets the first temperature
    heat = max(sum(w * x * x for row in rel for w, x in zip(weight, row)) / n, 1e-18)
    first, second = rng.integers(0, n, size=(2, steps)).tolist()
    to, luck, swap = rng.integers(0, splits, size=steps).tolist(), rng.random(steps).tolist(), (rng.random(steps) < 0.5).tolist()
    at, measures = start.tolist(), range(sizes.shape[1])
    # what was moved, so that the best assignment is found by going back to it
    moved: list[tuple[int, int]] = []
    best_cost, best_at = cost, 0
    for k in range(steps):
        i = first[k]
        a, j = at[i], second[k] if swap[k] else -1
        b = at[j] if j >= 0 else to[k]
        if a == b:
            continue
        shift = [x - y for x, y in zip(rel[i], rel[j])] if j >= 0 else rel[i]
        # moving `shift` from a to b
        here, there = off[a], off[b]
        change = 0.0
        for m in measures:
            x = shift[m]
            change += weight[m] * x * (there[m] - here[m] + x)
        change *= 2
        warm = heat * (1 - k / steps) ** 2
        if change <= 0 or (warm > 0 and luck[k] < math.exp(-change / warm)):
            for m in measures:
                here[m] -= shift[m]
                there[m] += shift[m]
            moved.append((i, a))
            at[i] = b
            if j >= 0:
                moved.append((j, b))
                at[j] = a
            cost += change
            if cost < best_cost - 1e-15:
                best_cost, best_at = cost, len(moved)
    for i, was in reversed(moved[best_at:]):
        at[i] = was
    return np.array(at, dtype=start.dtype), best_cost


def assign_splits(components: DataFrame, measures: list[str], fractions: tuple[float, ...] = (0.9, 0.05, 0.05), seed: int = 7, replicas: int = 4, steps: int = 4) -> DataFrame:
    """(component, split) of every row of ``components`` (component, then the ``measures``, the size first).

    Method: component swap search. Every bucket of at most about BUCKET components starts from the hashed
    assignment and is annealed by several replicas in parallel, each with its own seed and ``steps`` proposals a
    component (2,000 at least); the best replica of a bucket is kept. Since every bucket nears the proportions, so does the whole. Heavy components, of which
    there are at most 1 / HEAVY_SHARE, are placed first by the same search, and the rest aims at what they leave.
    Fractions that do not sum to 1 are scaled. An empty table gives an empty result.
    """
    f = np.array(fractions, dtype=float) / sum(fractions)
    data = components.select("component", *[F.coalesce(F.col(m), F.lit(0)).cast("double").alias(m) for m in measures])
    n, *totals = data.agg(F.count("*"), *[F.coalesce(F.sum(m), F.lit(0.0)) for m in measures]).first()
    buckets = max(1, math.ceil(n / BUCKET))
    goal = np.outer(f, np.array(totals))
    bounds = [float(x) for x in np.cumsum(f)[:-1]]
    heavy = data.where(F.col(measures[0]) > HEAVY_SHARE * totals[0]).withColumn("_bucket", F.lit(0))
    light = data.where(F.col(measures[0]) <= HEAVY_SHARE * totals[0]).withColumn("_bucket", F.pmod(F.xxhash64("component", F.lit(seed)), F.lit(buckets)).cast("int"))

    def searched(part: DataFrame, goal_of) -> DataFrame:
        tries = part.withColumn("_replica", F.explode(F.array([F.lit(r) for r in range(replicas)])))

        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("component").reset_index(drop=True)
            sizes = pdf[measures].to_numpy(dtype=float)
            u = pd.util.hash_pandas_object(pdf["component"], index=False).to_numpy() / 2.0**64
            start = np.searchsorted(np.array(bounds), u, side="right")
            at, cost = anneal(sizes, goal_of(sizes.sum(axis=0)), start, seed * 1000 + int(key[1]), max(2000, steps * len(sizes)))
            return pd.DataFrame({"component": pdf["component"], "_bucket": key[0], "_replica": key[1], "_split": at.astype("int32"), "_cost": cost})

        found = tries.groupBy("_bucket", "_replica").applyInPandas(run, "component string, _bucket int, _replica int, _split int, _cost double")
        found = stored(found, "p1-search")
        best = found.groupBy("_bucket").agg(F.min(F.struct("_cost", "_replica")).alias("_b")).select("_bucket", F.col("_b._replica").alias("_replica"))
        return found.join(best, ["_bucket", "_replica"]).select("component", "_split")

    placed = stored(searched(heavy, lambda own: goal), "p1-heavy")
    taken = np.zeros_like(goal)
    for row in placed.join(heavy, "component").groupBy("_split").agg(*[F.sum(m).alias(m) for m in measures]).collect():
        taken[row["_split"]] = [row[m] for m in measures]
    rest = np.maximum(goal - taken, 0.0)
    share = rest / np.maximum(rest.sum(axis=0), 1e-9)
    both = placed.unionByName(searched(light, lambda own: share * own))
    return both.select("component", F.element_at(F.array([F.lit(s) for s in SPLITS[: len(f)]]), F.col("_split") + 1).alias("split"))


def split_records(df: DataFrame, fractions: tuple[float, ...] = (0.9, 0.05, 0.05), item_id: str = "item_id", address: str = "source_url", label: str = "separation_model", seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(item_id, component, split, label) of every record and (component, split) of every component.

    A record that nothing links is a component of its own. Labels are the three known models, trimmed and in
    lower case, and ``other`` for the rest, for null, and for all where there is no such column.
    """
    plain = F.lower(F.trim(F.col(label))) if label in df.columns else F.lit(None).cast("string")
    labelled = df.where(F.col(item_id).isNotNull()).groupBy(F.col(item_id).alias("item_id")).agg(F.min(F.when(plain.isin("demucs", "melband", "none"), plain).otherwise(F.lit("other"))).alias("label"))
    records = labelled.join(linked_records(df, item_id, address), "item_id", "left").select("item_id", "label", F.coalesce("component", F.concat(F.lit("i:"), F.col("item_id"))).alias("component"))
    records = stored(records, "p1-labelled")
    kinds = ["demucs", "melband", "none", "other"]
    components = records.groupBy("component").agg(F.count("*").alias("size"), *[F.count_if(F.col("label") == k).alias(f"label_{k}") for k in kinds])
    splits = stored(assign_splits(stored(components, "p1-components"), ["size", *[f"label_{k}" for k in kinds]], fractions, seed), "p1-splits")
    return records.join(splits, "component").select("item_id", "component", "split", "label"), splits


def video_groups(df: DataFrame, item_id: str = "item_id", address: str = "source_url", label: str = "separation_model") -> DataFrame:
    """(item_id, group_id, split) of the records whose video has at least two ids, as the split search placed them;
    group_id is the smallest of the ids."""
    records, _ = split_records(df, item_id=item_id, address=address, label=label)
    records = stored(records, "p1-records")
    groups = records.groupBy("component", "split").agg(F.min("item_id").alias("group_id"), F.count("*").alias("_n")).where("_n > 1")
    return records.join(groups, ["component", "split"]).select("item_id", "group_id", "split")
