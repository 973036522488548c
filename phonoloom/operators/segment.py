"""Cutting items into segments: silences, speech intervals, greedy splits and merges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

PIECE = "array<struct<start:double,end:double>>"


def silence_gaps(df: DataFrame, keys: list[str], least: float) -> DataFrame:
    """(keys, start, end, mid): pauses of at least ``least`` seconds between successive intervals (start, end).

    A window of each key's rows in order of start, then end; intervals without both times are left out.
    """
    w = Window.partitionBy(*keys).orderBy("start", "end")
    rows = df.where("start is not null and end is not null").select(*keys, F.col("end").alias("_from"), F.lead("start").over(w).alias("_to"))
    gap = F.round(F.col("_to") - F.col("_from"), 6)
    return rows.where(gap >= least).select(*keys, F.col("_from").alias("start"), F.col("_to").alias("end"), F.round((F.col("_from") + F.col("_to")) / 2, 3).alias("mid"))


def paired_silences(starts: Column, ends: Column) -> Column:
    """Starts and ends paired by place, where the end lies behind; with middles in thousandths."""
    both = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), b.alias("end"), F.round((a + b) / 2, 3).alias("mid")))
    return F.filter(both, lambda g: g["end"] > g["start"])


def _cuts(total: float, mids: np.ndarray, least: float, most: float) -> tuple[list[float], list[float]]:
    """Starts and ends of an item's pieces, each found by bisection in the ascending silences."""
    starts, ends, now = [], [], 0.0
    while total - now > most:
        k = int(np.searchsorted(mids, now + most, side="right")) - 1
        cut = float(mids[k]) if k >= 0 and mids[k] >= now + least else now + most
        starts.append(now)
        ends.append(cut)
        now = cut
    if total - now >= least:
        starts.append(now)
        ends.append(total)
    return starts, ends


def greedy_split(total: Column, mids: Column, least: float, most: float) -> Column:
    """Pieces (start, end) of an item of ``total`` seconds: while more than ``most`` is left, cut at the last silence
    between ``least`` and ``most`` from here, or at ``most``; a rest shorter than ``least`` is lost.

    Ends are in thousandths, the place itself isn't rounded. Null, NaN, endless and too short totals give no piece, null
    ``mids`` are none; they are ascending. A piece costs a bisection, whatever the length of the item.
    """

    @F.pandas_udf("starts array<double>, ends array<double>")
    def run(totals: pd.Series, silences: pd.Series) -> pd.DataFrame:
        rows = [_cuts(float(t), np.asarray(m if m is not None else [], dtype=float), least, most) if t is not None and np.isfinite(t) and t >= least else ([], []) for t, m in zip(totals, silences)]
        return pd.DataFrame(rows, columns=["starts", "ends"])

    cut = run(total.cast("double"), mids)
    return F.zip_with(cut["starts"], cut["ends"], lambda a, b: F.struct(F.round(a, 3).alias("start"), F.round(b, 3).alias("end")))


def greedy_merge(df: DataFrame, keys: list[str], least: float, most: float) -> DataFrame:
    """(keys, start, end): groups of successive intervals (start, end) of a key: the next joins while the group would
    last at most ``most`` seconds, and a group counts if it lasts at least ``least``. One interval longer than ``most``
    stays whole; intervals without both times are left out.

    Rows go by in order of key and start while only the open group is held, so an item of any length needs no more room.
    """
    rows = df.where("start is not null and end is not null").select(*keys, F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(len(keys))]
            out: list[tuple] = []
            for key, a, b in zip(zip(*columns), batch.column(len(keys)).to_pylist(), batch.column(len(keys) + 1).to_pylist()):
                if held is not None and held[0] == key and b - held[1] <= most:
                    held = (key, held[1], b)
                    continue
                if held is not None and held[2] - held[1] >= least:
                    out.append(held)
                held = (key, a, b)
            yield _piece_batch(out, batch.schema)
            schema = batch.schema
        if held is not None and held[2] - held[1] >= least:
            yield _piece_batch([held], schema)

    return rows.repartition(*keys).sortWithinPartitions(*keys, "start", "end").mapInArrow(run, rows.schema)


def _piece_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    values = [[r[0][k] for r in rows] for k in range(len(schema) - 2)] + [[r[1] for r in rows], [r[2] for r in rows]]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], names=schema.names)


def padded_pieces(df: DataFrame, total: str, pieces: str, least: float, before: float = 0.20, after: float = 0.25) -> DataFrame:
    """A row for every piece, padded and kept inside the item: segment_index counts from 1 over all pieces, so numbers
    of pieces that are dropped as too short stay free; total_segments counts all."""
    rows = df.select(*[c for c in df.columns if c != pieces], F.size(pieces).alias("total_segments"), F.posexplode(pieces).alias("_i", "_p"))
    start = F.greatest(F.lit(0.0), F.round(F.col("_p.start") - before, 3))
    end = F.least(F.col(total), F.round(F.col("_p.end") + after, 3))
    out = rows.withColumns({"segment_index": F.col("_i") + 1, "start_sec": start, "end_sec": end, "duration_seconds": F.round(end - start, 3)})
    return out.where(F.col("duration_seconds") >= least).drop("_i", "_p")


def speaker_type(df: DataFrame, keys: list[str], segments: int = 4, pause: float = 1.2) -> DataFrame:
    """(keys, n_segments, speaker_type): dialogue with at least ``segments`` intervals and a pause above ``pause``."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    rows = df.withColumn("_gap", F.col("start") - F.lag("end").over(w))
    talk = (F.count("*") >= segments) & F.coalesce(F.max("_gap") > pause, F.lit(False))
    return rows.groupBy(*keys).agg(F.count("*").alias("n_segments"), F.when(talk, F.lit("dialogue")).otherwise(F.lit("monologue")).alias("speaker_type"))


def joined_stretches(stretches: Column, gap: float, least: float = 0.0) -> Column:
    """Stretches (start, end) with pauses of at most ``gap`` seconds closed; those shorter than ``least`` go."""

    def add(out: Column, s: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        one = lambda a, b: F.array(F.struct(a.alias("start"), b.alias("end")))
        near = (F.size(out) > 0) & (s["start"] - last["end"] <= gap + 1e-9)
        return F.when(near, F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), one(last["start"], s["end"]))).otherwise(F.concat(out, one(s["start"], s["end"])))

    return F.filter(F.aggregate(stretches, F.array().cast(PIECE), add), lambda p: p["end"] - p["start"] >= least - 1e-9)


def active_stretches(energy: Column, limit: Column, hop: float) -> Column:
    """Speech intervals by energy: stretches of windows at or above the limit, in seconds."""
    first = F.struct(F.lit(-1).alias("open"), F.lit(0).alias("i"), F.array().cast(PIECE).alias("out"))

    def end(s: Column) -> Column:
        return F.when(s["open"] >= 0, F.concat(s["out"], F.array(F.struct((s["open"] * hop).alias("start"), (s["i"] * hop).alias("end"))))).otherwise(s["out"])

    def step(s: Column, e: Column) -> Column:
        on = e >= limit
        opened = F.when(on & (s["open"] < 0), s["i"]).when(on, s["open"]).otherwise(F.lit(-1))
        return F.struct(opened.alias("open"), (s["i"] + 1).alias("i"), F.when(on, s["out"]).otherwise(end(s)).alias("out"))

    return F.aggregate(energy, first, step, end)
