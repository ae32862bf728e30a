"""Span trees, cross-request stitching and trace assembly."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.distribution import heavy_join, spread_join
from tracelake.functions.documents import choose_parent, grouped_attributes, map_span_attributes
from tracelake.operators.usage import sum_usage
from tracelake.session import materialise


def read_attributes(spans: DataFrame, vendor: str) -> DataFrame:
    """Spans with typed columns from their flat attributes and with ids and parent chosen as ingestion does."""
    # A projection of its own: usage and metadata both read it, and inside one expression each would make the pass again.
    grouped = spans.withColumn("__grouped", grouped_attributes(F.col("attributes"), vendor))
    typed = map_span_attributes(F.col("attributes"), vendor, F.col("__grouped"))
    ids = choose_parent(F.col("attributes"), F.col("trace_id"), F.col("span_id"), F.col("parent_span_id"), vendor)
    rest = [c for c in spans.columns if c not in ids and c not in typed]
    return grouped.select(*[c.alias(n) for n, c in ids.items()], *rest, *[c.alias(n) for n, c in typed.items()])


def span_tree(spans: DataFrame, orphans: str = "drop") -> DataFrame:
    """Adds ``root_span_id`` and ``depth``. Spans whose parent is absent are dropped with all below, or become roots.

    Each round doubles how far every span has jumped towards its root, so a tree of depth d takes about log2(d) joins
    and no trace is ever gathered in one task. A repeated span row gets its place each. Rounds are written to the shared folder. Spans on a cycle have no root
    and are left out, as a walk from the roots never meets them.
    """
    if orphans not in ("drop", "root"):
        raise ValueError("orphans must be drop or root")
    key = F.struct("trace_id", "span_id")
    parent = F.when(F.col("parent_span_id").isNotNull(), F.struct(F.col("trace_id"), F.col("parent_span_id").alias("span_id")))
    # a span delivered twice is one span; a delivery without its parent does not hide it
    edges = materialise(spans.select(key.alias("id"), parent.alias("jump")).groupBy("id").agg(F.min("jump").alias("jump")), "edges")
    known = edges.select(F.col("id").alias("jump"), F.lit(True).alias("there"))
    linked = heavy_join(edges, known, "jump", "left", "id")
    if orphans == "root":
        linked = linked.withColumn("jump", F.when(F.col("there"), F.col("jump")))
    is_root = F.col("jump").isNull()
    placed = linked.where(is_root | F.col("there")).select(
        "id",
        F.coalesce("jump", "id").alias("jump"),
        F.when(is_root, 0).otherwise(1).alias("depth"),
        is_root.alias("done"),
    )
    state = materialise(placed, "tree")
    finished, open_rows = [state.where("done")], state.where("not done")
    rounds = math.ceil(math.log2(max(edges.count(), 2))) + 1
    for _ in range(rounds):
        if open_rows.isEmpty():
            break
        steps = reduce(DataFrame.unionByName, [*finished, open_rows]).select(
            F.col("id").alias("jump"), F.col("jump").alias("to"), F.col("depth").alias("more"), F.col("done").alias("ends")
        )
        joined = heavy_join(open_rows.drop("done"), steps, "jump", "inner", "id")
        moved = joined.select("id", F.col("to").alias("jump"), (F.col("depth") + F.col("more")).alias("depth"), F.col("ends").alias("done"))
        state = materialise(moved, "tree")
        finished.append(state.where("done"))
        open_rows = state.where("not done")
    depths = reduce(DataFrame.unionByName, finished).select(
        F.col("id.trace_id").alias("trace_id"), F.col("id.span_id").alias("span_id"), F.col("jump.span_id").alias("root_span_id"), "depth"
    )
    return spans.join(depths, ["trace_id", "span_id"])


def orphan_spans(spans: DataFrame) -> DataFrame:
    """Spans that name a parent their trace does not have."""
    parents = spans.select("trace_id", F.col("span_id").alias("parent_span_id"))
    return spans.where(F.col("parent_span_id").isNotNull()).join(parents, ["trace_id", "parent_span_id"], "left_anti")


def stitch(spans: DataFrame, sessions: DataFrame) -> DataFrame:
    """Attach parentless spans of a later request to the span that dispatched them, by session.

    ``sessions`` has ``session_id, trace_id, dispatch_span_id``, one row per session.
    """
    links = sessions.select(
        "session_id", F.col("trace_id").alias("__trace"), F.col("dispatch_span_id").alias("__parent")
    )
    joined = spread_join(spans, links, ["session_id"], "left", "span_id")
    attach = F.col("parent_span_id").isNull() & F.col("__parent").isNotNull() & (F.col("trace_id").isNull() | (F.col("span_id") != F.col("__parent")))
    return joined.select(
        *[
            F.when(attach, F.col("__trace")).otherwise(F.col(c)).alias(c)
            if c == "trace_id"
            else F.when(attach, F.col("__parent")).otherwise(F.col(c)).alias(c)
            if c == "parent_span_id"
            else F.col(c)
            for c in spans.columns
        ]
    )


def trace_id_check(spans: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of distinct trace ids; one for a set of spans that belong together."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return spans.agg(count("trace_id").alias("trace_ids"))


def assemble_traces(spans: DataFrame, tokens: Sequence[str] = ("input_tokens", "output_tokens")) -> DataFrame:
    """One trace per set of spans: fields of the root, time range and token sums of the whole tree.

    Numbers of all spans are hash-aggregated and combine before the shuffle; only parentless spans, of which the first is the
    root, carry their texts to the second aggregation.
    """
    order = F.struct(-F.unix_micros(F.col("start_time").cast("timestamp")), F.col("span_id"))
    roots = spans.where(F.col("parent_span_id").isNull()).groupBy("trace_id").agg(F.max_by(F.struct("name", "input", "output", "thread_id", "tags"), order).alias("r"))
    grouped = spans.groupBy("trace_id").agg(
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.count("*").alias("spans"),
        *[F.sum(F.coalesce(F.col("usage")[t], F.lit(0))).alias(t) for t in tokens],
        F.sum(sum_usage(F.col("usage"))).alias("usage_total"),
        F.sum("cost").alias("cost"),
    )
    return grouped.join(roots, "trace_id", "left").select("trace_id", "r.*", "start_time", "end_time", "spans", *tokens, "usage_total", "cost")
