"""Composite scores of arriving traces whose scores come later, and their correction on the next day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions.scoring import composite_risk
from tracelake.sources.writers import if_written
from tracelake.streaming.arrivals import event_time

# Scores that the composite is made of; the last one has a default.
PARTS = ["regulatory_compliance", "hallucination_rate", "response_quality"]

COMPOSITE = "trace_id string, start_time timestamp, composite double, complete boolean"


def _composite(parts: dict[str, Column]) -> list[Column]:
    whole = F.lit(True)
    for value in parts.values():
        whole = whole & value.isNotNull()
    return [composite_risk(F.struct(*[value.alias(name) for name, value in parts.items()])).alias("composite"), whole.alias("complete")]


def composite_stream(traces: DataFrame, scores: DataFrame, lateness: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    """Composite of every arriving trace, once: as soon as all its parts are there, or when the watermark has passed ``lateness`` after
    its start with the parts that had come by then. Traces and scores may arrive in any order.

    One outer join of two streams for each part; their state is bounded by ``lateness`` and the watermark. If a score is sent
    again in time, one of its values counts. What comes later than ``lateness`` changes nothing here: ``correct_days`` sees it.
    """
    rows = event_time(traces.select("trace_id", "start_time"), watermark)
    timed = event_time(scores.where(F.col("name").isin(PARTS) & F.col("value").isNotNull()), watermark, "ts")
    for i, name in enumerate(PARTS):
        mine = timed.where(F.col("name") == name).select(F.col("trace_id").alias(f"__id{i}"), F.col("ts").alias(f"__ts{i}"), F.col("value").alias(f"__part{i}"))
        due = F.expr(f"__ts{i} BETWEEN start_time AND start_time + INTERVAL {lateness}")
        rows = rows.join(mine, (F.col("trace_id") == F.col(f"__id{i}")) & due, "leftOuter").drop(f"__id{i}", f"__ts{i}")
    once = rows.dropDuplicatesWithinWatermark(["trace_id"])
    return once.select("trace_id", "start_time", *_composite({name: F.col(f"__part{i}") for i, name in enumerate(PARTS)}))


def composites(traces: DataFrame, scores: DataFrame) -> DataFrame:
    """Composite of every stored trace from all its scores; of a score sent again the latest counts."""
    named = scores.where(F.col("name").isin(PARTS) & F.col("value").isNotNull())
    newest = [F.max(F.when(F.col("name") == name, F.struct("ts", "value")))["value"].alias(name) for name in PARTS]
    met = traces.select("trace_id", F.col("start_time").cast("timestamp").alias("start_time")).join(named.groupBy("trace_id").agg(*newest), "trace_id", "left")
    return met.select("trace_id", "start_time", *_composite({name: F.col(name) for name in PARTS}))


def correct_days(traces: DataFrame, scores: DataFrame, first: date, last: date, path: str) -> None:
    """Compute closed days anew as a whole and replace them in the table of final composites; running it again changes nothing."""
    day = F.to_date("start_time")
    closed = traces.where(day.between(first, last))
    final = composites(closed, scores).withColumn("day", day)
    final.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def current_composites(spark: SparkSession, arrived: str, final: str) -> DataFrame:
    """Final composites of corrected days, and of the other days what the stream has given so far."""
    early = spark.read.schema(COMPOSITE).parquet(arrived)
    late = if_written(spark, final, f"{COMPOSITE}, day date")
    if late is None:
        return early
    corrected = late.select("day").distinct()
    open_days = early.withColumn("day", F.to_date("start_time")).join(F.broadcast(corrected), "day", "left_anti")  # one row a day
    return late.drop("day").unionByName(open_days.drop("day"))
