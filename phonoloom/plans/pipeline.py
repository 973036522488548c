"""The curation plan: from landed records to accepted ones, rejects and a funnel, as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from phonoloom.functions.text import word_count
from phonoloom.operators.dedup import keep_first, unseen
from phonoloom.operators.gates import item_gates
from phonoloom.operators.rollup import stage_funnel


@dataclass
class Settings:
    least_words: int = 3
    enforce_gate: bool = False
    least_snr: float = 10.0
    most_flatness: float = 0.15


def curate(records: DataFrame, seen: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Extended records once by id, without those seen, with reject_reason (null for accepted ones).

    The dedup comes first, on ids alone; the gates are plain columns, so the planner prunes what no gate reads.
    """
    settings = settings or Settings()
    one = keep_first(records.where("item_id is not null"), ["item_id"], ["crawled_at"])
    return unseen(one, seen).withColumn("reject_reason", item_gates())


def gold_gate(df: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Records with is_gold; rows that fail are dropped only if the gate is enforced."""
    settings = settings or Settings()
    gold = (F.nanvl("spectral_flatness", F.lit(1.0)) <= settings.most_flatness) & (F.nanvl("snr_estimate_db", F.lit(0.0)) >= settings.least_snr)
    out = df.withColumn("is_gold", F.coalesce(gold, F.lit(False)))
    return out.where("is_gold") if settings.enforce_gate else out


def text_funnel(documents: DataFrame) -> DataFrame:
    """The flagship: documents per source by stage: with a source, first of their text, with enough words, with a known
    language."""
    first = documents.where("text is not null").groupBy(F.sha2("text", 256).alias("_h")).agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True)).select("doc_id", "is_first")
    rows = documents.select("doc_id", "source", "lang", word_count(F.col("text")).alias("words")).join(first, "doc_id", "left")
    stages = [("with_source", F.col("source").isNotNull()), ("first_of_text", F.col("is_first")), ("enough_words", F.col("words") >= 3), ("known_language", F.col("lang").isin("vi", "en"))]
    return stage_funnel(rows, stages, ["source"])
