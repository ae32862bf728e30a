"""Annotation queues: assignment, enrichment and trace restructuring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.distribution import seeded_key, shuffled_index, spread_join
from tracelake.functions.documents import merge_metadata, pluck
from tracelake.operators.tables import insert_absent

# What a lookup without a hit gives.
DEFAULT_DOCS = [("No relevant documents found.", "N/A")]


def shuffle(df: DataFrame, id_col: str, seed: str | int) -> DataFrame:
    """Reproducible shuffle."""
    return df.orderBy(seeded_key(id_col, seed), id_col)


def assign_round_robin(traces: DataFrame, queues: Sequence[str], seed: str | int, id_col: str = "trace_id") -> DataFrame:
    """Deal shuffled traces to the queues in turn; queue sizes differ by at most one."""
    indexed = shuffled_index(traces, id_col, seed, "position")
    names = F.array(*[F.lit(q) for q in queues])
    turn = F.pmod(F.col("position"), F.lit(len(queues))).cast("int")
    return indexed.withColumn("queue", F.get(names, turn))


def enqueue(assignments: DataFrame, new: DataFrame) -> DataFrame:
    """Add assignments that are not there yet."""
    fresh = new.select("queue", "trace_id").distinct().join(assignments, ["queue", "trace_id"], "left_anti")
    return assignments.unionByName(fresh)


def ensure_queues(queues: DataFrame, wanted: DataFrame) -> DataFrame:
    return insert_absent(queues, wanted, "name")


def enrich(traces: DataFrame, contexts: DataFrame, key: str = "dataset_context", seed_col: str = "trace_id") -> DataFrame:
    """Add context to the metadata of traces whose input has a known question; a very common question is spread out."""
    known = contexts.where(F.coalesce(F.col("context"), F.lit("")) != "").select(
        F.col("question").alias("__question"), F.col("context").alias("__context")
    )
    asked = traces.withColumn("__question", F.get_json_object("input", "$.question"))
    joined = spread_join(asked, known, ["__question"], "left", seed_col)
    added = F.create_map(F.lit(key), F.col("__context"))
    changed = F.when(F.col("__context").isNotNull(), merge_metadata(F.col("metadata"), added)).otherwise(F.col("metadata"))
    return joined.withColumn("metadata", changed).select(*traces.columns)


def lookup_default(df: DataFrame, dim: DataFrame, key: str, value: str, default: Column, spread_by: str) -> DataFrame:
    """Value by key, or the default where the key is unknown."""
    return spread_join(df, dim.select(key, value), [key], "left", spread_by).withColumn(value, F.coalesce(F.col(value), default))


def default_docs() -> Column:
    return F.array(*[F.struct(F.lit(t).alias("text"), F.lit(s).alias("source")) for t, s in DEFAULT_DOCS])


def restructure(traces: DataFrame, docs: str = "docs") -> DataFrame:
    """Keep the answer as the output and move the supporting documents into the metadata."""
    added = F.create_map(
        F.lit("retrieved_context"), F.to_json(pluck(F.col(docs), "text")), F.lit("sources"), F.to_json(pluck(F.col(docs), "source"))
    )
    answer = F.coalesce(F.get_json_object("output", "$.answer"), F.col("output"))
    return traces.withColumns({"output": answer, "metadata": merge_metadata(F.col("metadata"), added)}).drop(docs)
