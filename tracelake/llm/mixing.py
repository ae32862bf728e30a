"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import WORD, running_total
from tracelake.session import materialise

WEIGHTS = (5, 2, 1)
BUDGET_PERCENT = 150
EPOCHS = 2


def weighted_fair_mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    epochs: int = EPOCHS,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document and epoch, with its place in the mix.

    Every source is a queue of its shuffled documents, repeated ``epochs`` times. A document's virtual finish time is
    its source's words up to its end over the source's weight. All queues share one clock: the mix is all documents in
    the order of that time, cut where the budget is used up. That time is computed from sizes and weights, and each source
    is cut at its words by then (its target), which is the same; the sort only gives ``position``. Sources by code point, null last, take ``weights`` in turn.
    A source that runs out leaves the clock to the others, so targets are capped at ``epochs`` times its size and the
    excess is shared by weight. A document that the cut falls into is taken up to it, so sources differ from their
    target by less than a word.

    Columns: ``row`` (of the document row), ``id_col``, ``source_col``, ``size``, ``source_size``, ``target``,
    ``epoch``, ``finish``, ``taken`` (words of this pass, 0 behind the cut) and ``position`` (words of the mix before it).
    Null and empty texts have size 0 and are never taken; repeated rows count each; an empty table gives no rows; other
    columns are ignored. The shuffle is a digest of the seed and the id, so reruns agree; ties follow id, then size.
    """
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("__id").cast("string")))
    sized = docs.select(
        F.col(id_col).alias("__id"),
        F.col(source_col).alias("__source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    order = [F.col("__source").isNull(), F.col("__source"), key, F.col("__id"), F.col("size")]
    queued = materialise(running_total(sized, order, F.col("size"), "__before", "mix-queues").withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    totals = queued.groupBy("__source").agg(F.sum("size").alias("source_size"))
    by_name = [F.col("__source").isNull(), F.col("__source")]
    ranked = running_total(totals, by_name, F.col("source_size"), "__offset", "mix-sources")
    ranked = running_total(ranked, by_name, F.lit(1).cast("long"), "__rank", "mix-ranks")
    shares = F.array(*[F.lit(int(w)) for w in weights])
    sources = materialise(ranked.withColumn("weight", F.element_at(shares, (F.col("__rank") % len(weights) + 1).cast("int"))), "mix-weights")
    horizon = _horizon(sources, budget_percent, epochs)
    limit = F.col("source_size") * epochs
    share = F.col("weight").cast("double") * F.lit(horizon)
    sources = sources.withColumn("target", F.when(share >= limit, limit.cast("double")).otherwise(share))
    keyed = sources.select(F.col("__source").alias("__name"), "source_size", "target", "weight", "__offset")
    placed = queued.join(keyed, F.col("__source").eqNullSafe(F.col("__name")))
    start = F.col("__before") - F.col("__offset") + F.col("epoch") * F.col("source_size")
    passes = placed.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))).withColumn("__start", start)
    passes = passes.withColumn("finish", (F.col("__start") + F.col("size")) / F.col("weight"))
    served = F.floor("target").cast("long") - F.col("__start")
    passes = passes.withColumn("taken", F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), served)))
    in_order = [F.col(c) for c in ("finish", "epoch", "row")]
    mixed = running_total(passes, in_order, F.col("taken"), "position", "mix")
    return mixed.select("row", F.col("__id").alias(id_col), F.col("__source").alias(source_col), "size", "source_size", "target", "epoch", "finish", "taken", "position")


def _horizon(sources: DataFrame, budget_percent: int, epochs: int) -> float:
    """Virtual time at which the budget is used up: words left over weights left, once the sources that run out are out.

    Each round is one small sum over the table of sources; only its two numbers reach the driver.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    horizon, full = 0.0, 0
    while True:
        out = F.col("source_size") * epochs <= F.col("weight") * F.lit(horizon)
        spent, left, count = sources.agg(
            F.sum(F.when(out, F.col("source_size") * epochs).otherwise(0)),
            F.sum(F.when(out, 0).otherwise(F.col("weight"))),
            F.count(F.when(out, 1)),
        ).first()
        if not left or (horizon and count == full):
            return horizon
        full = count
        horizon = (total * budget_percent - spent * 100) / (100.0 * left)
        if horizon <= 0:
            return 0.0


def per_document(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, ``size``, ``source_size``, ``target`` and all words ``taken`` of each document row."""
    return mixed.groupBy("row", id_col, "size", "source_size", "target").agg(F.sum("taken").alias("taken")).drop("row")
