"""The mastering plan: separation, noise reduction, loudness and recognition as columns, with a trace of what was done.

Models plug in behind a column. The ones here need nothing but numpy; heavier ones come as functions of (samples, rate)
columns built the same way: an iterator of Arrow batches over a model that a worker loads once and keeps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from phonoloom.functions import scores, spectral
from phonoloom.functions.classify import speech_pre_gate


class Model(Protocol):
    """A model behind a column: separation, noise reduction or mastering. It gets samples and their rate and gives samples."""

    name: str

    def column(self, samples: Column, rate: Column) -> Column: ...


@dataclass(frozen=True)
class Treatment:
    """A model that is a numpy function of (samples, rate)."""

    name: str
    run: Callable

    def column(self, samples: Column, rate: Column) -> Column:
        return spectral.treated(self.run)(samples, rate)


@dataclass(frozen=True)
class Loaded:
    """A model with weights: ``load`` runs once in a Python worker, ``apply(model, samples, rate)`` for each array.

    Where executors have one accelerator each, give the stage a resource profile with one task a device.
    """

    name: str
    load: Callable[[], Any]
    apply: Callable[[Any, Any, float], Any]

    def column(self, samples: Column, rate: Column) -> Column:
        load, apply, name = self.load, self.apply, self.name

        @F.pandas_udf("array<double>")
        def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            model = _held(name, load)
            for arrays, rates in batches:
                yield pd.Series([None if x is None else apply(model, x, float(r)) for x, r in zip(arrays, rates)])

        return run(samples, rate)


_MODELS: dict[str, Any] = {}


def _held(name: str, load: Callable[[], Any]) -> Any:
    """The worker's copy of a model, loaded on first use."""
    if name not in _MODELS:
        _MODELS[name] = load()
    return _MODELS[name]


SPECTRAL = Treatment("spectral", spectral.voice_mask)
LIGHT, FULL = Treatment("light", spectral.light_chain), Treatment("full", spectral.full_chain)
LOUD = Treatment("loudness", spectral.mastered())


@dataclass
class Stages:
    """Which models run. ``cascade`` separates in two steps where it is given, the second on what the first leaves."""

    separate: bool = True
    denoise: bool = True
    loudness: bool = True
    recognise: bool = True
    cascade: list[Model] = field(default_factory=list)
    fallback: Model | None = SPECTRAL


def master(records: DataFrame, stages: Stages | None = None, samples: str = "samples", rate: str = "sample_rate") -> DataFrame:
    """``records`` (samples, sample_rate, transcript, avg_logprob, no_speech_prob) with raw_quality, mastered samples,
    passed, reason and stages_applied.

    What the raw recognition says decides: clear speech keeps its sound but for light noise reduction and passes on the
    first recognition; covered speech is separated and treated in full and is judged by the post gate. The trace names
    every stage that ran, was left out or failed. Null samples pass through with the trace of the decisions.
    """
    stages = stages or Stages()
    x, r = F.col(samples), F.col(rate)
    quality = speech_pre_gate(F.col("transcript"), F.col("avg_logprob"), F.col("no_speech_prob"))
    out = records.withColumn("raw_quality", quality)
    q, good = F.col("raw_quality"), F.col("raw_quality") == "good"
    # a decimal number of three places, as text
    logprob = F.format_string("%.3f", F.col("avg_logprob"))
    trace = [F.concat(F.lit("pre_gate(quality="), q, F.lit(",lp="), F.coalesce(logprob, F.lit("none")), F.lit(")"))]
    now = x
    if stages.separate:
        chain = stages.cascade or ([stages.fallback] if stages.fallback else [])
        for model in chain:
            now = model.column(now, r)
        label = "+".join(m.name for m in chain)
        trace.append(F.when(good, F.lit("separation_skipped")).otherwise(F.lit(f"separation({label})" if chain else "separation_failed")))
        out = out.withColumn("_separated", F.when(good, x).otherwise(now))
        now = F.col("_separated")
    if stages.denoise:
        out = out.withColumn("_clean", F.when(q == "degraded", FULL.column(now, r)).otherwise(LIGHT.column(now, r)))
        now = F.col("_clean")
        trace.append(F.when(q == "degraded", F.lit("denoise(full)")).otherwise(F.lit("denoise(light)")))
    if stages.loudness:
        out = out.withColumn("_loud", LOUD.column(now, r))
        now = F.col("_loud")
        trace.append(F.lit("loudness"))
    reason = F.lit(None).cast("string")
    if stages.recognise:
        reason = F.when(~good, scores.speech_post_gate(F.col("transcript"), F.col("avg_logprob"), F.col("no_speech_prob")))
        trace.append(F.when(good, F.lit("recognition(reused)")).when(reason.isNull(), F.lit("recognition(pass)")).otherwise(F.lit("recognition(fail)")))
    kept = [c for c in records.columns if c not in ("mastered", "passed", "reason", "stages_applied", "raw_quality")]
    return out.select(*kept, "raw_quality", now.alias("mastered"), reason.isNull().alias("passed"), reason.alias("reason"), F.array(*trace).alias("stages_applied"))
