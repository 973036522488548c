"""Problem 9: sources mixed to target weights that may change over the training."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from phonoloom.llm.encoding import encode
from phonoloom.operators.running import running_sum
from phonoloom.plans.cluster import stored


@dataclass
class Source:
    name: str
    target: float
    repeats: int
    documents: int = 0
    tokens: int = 0
    amount: float = 0.0

    @property
    def most(self) -> float:
        return float(self.tokens) * self.repeats


def fill(sources: list[Source], total: float) -> None:
    """Sets the amount of every source: its share of ``total``, no more than its texts allow; what capped sources
    leave goes to the others in proportion to their targets, until nothing is left or all are full."""
    open_ = [s for s in sources if s.target > 0 and s.most > 0]
    left = total
    for s in sources:
        s.amount = 0.0
    while open_ and left > 0:
        weight = sum(s.target for s in open_)
        full = [s for s in open_ if s.target / weight * left >= s.most]
        if not full:
            for s in open_:
                s.amount = s.target / weight * left
            return
        for s in full:
            s.amount = s.most
            left -= s.most
        open_ = [s for s in open_ if s.amount == 0.0]


def default_schedule(sources: list[Source], lean: float = 0.5) -> dict[str, list[tuple[float, float]]]:
    """Weights over time 0..1 as (time, weight) knots, linear between them: from a mix that leans towards what
    the sources hold to one that leans as far away from it. Every source's mean weight is its share, and at
    any time the weights sum to 1."""
    total = sum(s.amount for s in sources) or 1.0
    held = sum(s.tokens for s in sources if s.amount > 0) or 1
    share = {s.name: s.amount / total for s in sources if s.amount > 0}
    natural = {s.name: s.tokens / held for s in sources if s.amount > 0}
    lean = min([lean, *[share[k] / (natural[k] - share[k]) for k in share if natural[k] > share[k]]])
    return {k: [(0.0, share[k] + lean * (natural[k] - share[k])), (1.0, share[k] - lean * (natural[k] - share[k]))] for k in share}


def _segments(sources: list[Source], schedule: dict[str, list[tuple[float, float]]]) -> list[tuple]:
    """(source, t0, t1, w0, w1, c0, c1): stretches of each schedule with the cumulative tokens at their ends,
    scaled so that a schedule's whole area is the source's amount."""
    rows = []
    for s in sources:
        if s.amount <= 0:
            continue
        knots = sorted(schedule.get(s.name) or [(0.0, 1.0), (1.0, 1.0)])
        knots = ([(0.0, knots[0][1])] if knots[0][0] > 0 else []) + knots + ([(1.0, knots[-1][1])] if knots[-1][0] < 1 else [])
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
        scale, c = s.amount / area, 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            grown = (t1 - t0) * (w0 + w1) / 2 * scale
            if grown > 0:
                rows.append((s.name, t0, t1, w0 * scale, w1 * scale, c, c + grown))
                c += grown
    return rows


def mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, schedule: dict[str, list[tuple[float, float]]] | None = None, vocabulary: str = "byte_bpe_50k.json") -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, repeat_no, n_tokens, position) of the mixed corpus, and the shares reached.

    Method: time-varying curriculum. Every source's weight schedule is integrated to cumulative demand; a text's
    place in its source, in tokens over all repeats, is looked up in the inverse, which gives its training time;
    texts of all sources are range-sorted by that time and numbered by the tokens before them. Within a source
    texts stand in the order of a hash. Without ``total_tokens`` the corpus is as large as the texts of the
    sources that have a target.

    Texts without tokens, with a null source or with a source without target (weight 0) aren't used. A target
    that is null, NaN or not above 0, or whose max_repeats is null or below 1, counts as none; of a source
    named twice the larger target counts. ``targets`` is a table of parameters, one row a source, and is read
    on the driver. No text is used more than max_repeats times, whatever the target. A target that can't be
    reached gives what there is, and the rest goes to the others in proportion to their targets.
    """
    spark = documents.sparkSession
    sizes = encode(documents.where("source is not null"), out="n_tokens", vocabulary=vocabulary, only_count=True)
    sized = stored(documents.where("source is not null").select("doc_id", "source").join(sizes, "doc_id"), "p9-sizes")
    wanted = targets.where("source is not null").groupBy("source").agg(F.max(F.struct("target_share", "max_repeats")).alias("r")).select("source", "r.*")
    held = sized.join(wanted.select("source"), "source").groupBy("source").agg(F.count_if(F.col("n_tokens") > 0).alias("documents"), F.sum("n_tokens").alias("tokens"))
    sources = []
    for row in wanted.join(held, "source", "left").collect():  # one row a target
        share = row["target_share"]
        ok = share is not None and share == share and share > 0 and (row["max_repeats"] or 0) >= 1
        sources.append(Source(row["source"], float(share) if ok else 0.0, int(row["max_repeats"] or 0) if ok else 0, row["documents"] or 0, row["tokens"] or 0))
    sources.sort(key=lambda s: s.name)
    total = float(total_tokens if total_tokens is not None else sum(s.tokens for s in sources if s.target > 0))
    fill(sources, total)
    plan = spark.createDataFrame(_segments(sources, schedule or default_schedule(sources)) or [], "source string, t0 double, t1 double, w0 double, w1 double, c0 double, c1 double")
    use = spark.createDataFrame([(s.name, s.tokens, s.amount) for s in sources if s.amount > 0], "source string, _held bigint, _amount double")
    ran = running_sum(sized.join(F.broadcast(use), "source").where("n_tokens > 0").withColumn("_order", F.xxhash64("doc_id")), ["source"], ["_order", "doc_id"], "n_tokens", "_upto")
    times = F.sequence(F.lit(0), F.ceil(F.col("_amount") / F.col("_held")).cast("int") - 1)
    placed = ran.withColumn("repeat_no", F.explode(times)).withColumn("_c", F.col("repeat_no") * F.col("_held") + F.col("_upto") - F.col("n_tokens") / 2.0).where("_c <= _amount")
    # rows of parameters: as many as targets and knots, so they go to every task
    at = placed.join(F.broadcast(plan), "source").where("_c > c0 and _c <= c1")
    slope = (F.col("w1") - F.col("w0")) / (F.col("t1") - F.col("t0"))
    need = F.col("_c") - F.col("c0")
    root = F.sqrt(F.greatest(F.col("w0") * F.col("w0") + 2 * slope * need, F.lit(0.0)))
    time = F.col("t0") + 2 * need / (F.col("w0") + root)
    timed = at.select("doc_id", "source", "repeat_no", "n_tokens", F.least(time, F.lit(1.0)).alias("time"))
    whole = running_sum(timed, [], ["time", "source", "doc_id", "repeat_no"], "n_tokens", "_end")
    mixed = whole.select("doc_id", "source", "repeat_no", "n_tokens", (F.col("_end") - F.col("n_tokens")).alias("position"))
    return mixed, shares(spark, mixed, sources)


def shares(spark, mixed: DataFrame, sources: list[Source]) -> DataFrame:
    """(source, target_share, documents, tokens, used_tokens, actual_share, repeats) for every target."""
    plan = spark.createDataFrame([(s.name, s.target, s.documents, s.tokens) for s in sources], "source string, target_share double, documents bigint, tokens bigint")
    used = mixed.groupBy("source").agg(F.sum("n_tokens").alias("used_tokens"), (F.max("repeat_no") + 1).alias("repeats"))
    out = plan.join(used, "source", "left").withColumns({"used_tokens": F.coalesce("used_tokens", F.lit(0)), "repeats": F.coalesce("repeats", F.lit(0))})
    whole = out.agg(F.sum("used_tokens").alias("_all"))
    return out.crossJoin(F.broadcast(whole)).select("source", "target_share", "documents", "tokens", "used_tokens", F.when(F.col("_all") > 0, F.round(F.col("used_tokens") / F.col("_all"), 6)).otherwise(F.lit(0.0)).alias("actual_share"), "repeats")
