"""Structured Streaming over arriving traces and spans. Scoring is the batch code of ``operators.rules``, unchanged."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tracelake import schemas
from tracelake.operators.filters import traces_of_yesterday
from tracelake.operators.metrics import MetricSpec
from tracelake.operators.rules import score_items
from tracelake.operators.threads import SESSION_COLUMNS, THREAD, judge_sessions, sessions_by
from tracelake.session import materialise, scratch_path
from tracelake.sources.writers import if_written


def stream_traces(spark: SparkSession, folder: str, schema: StructType = schemas.TRACE, glob: str = "*.parquet") -> DataFrame:
    """Files that arrive in a folder, as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)


def event_time(stream: DataFrame, watermark: str, column: str = "start_time") -> DataFrame:
    """Watermarks need a time with zone; times without one are taken as UTC."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, watermark)


def score_stream(
    stream: DataFrame,
    rules: DataFrame,
    metrics: Mapping[str, MetricSpec],
    answer: Callable[[pd.Series], pd.Series] | None = None,
    level: str = "trace",
    item_id: str = "trace_id",
) -> DataFrame:
    """Score rows of arriving items: a stream-static join with the rules, no state."""
    return score_items(stream, rules, metrics, answer, level, item_id)


def dedup_stream(stream: DataFrame, key: str = "trace_id", watermark: str = "1 hour", column: str = "start_time") -> DataFrame:
    """First delivery of every id; state older than the watermark is dropped."""
    return event_time(stream, watermark, column).dropDuplicatesWithinWatermark([key])


def tumbling_metrics(stream: DataFrame, width: str = "1 day", watermark: str = "1 hour", value: str = "cost") -> DataFrame:
    """Traces and mean value per project and interval."""
    return _windowed(event_time(stream, watermark), F.window("start_time", width), value)


def sliding_metrics(
    stream: DataFrame, width: str = "30 days", slide: str = "1 day", watermark: str = "1 hour", value: str = "cost"
) -> DataFrame:
    """Look-back window moved by ``slide``. Traces are first counted per slide step, so each one is not held once per
    window it falls in."""
    steps = _windowed(event_time(stream, watermark), F.window("start_time", slide), value, parts=True)
    moved = steps.groupBy("project", F.window(F.col("window"), width, slide).alias("range"))
    totals = moved.agg(F.sum("traces").alias("traces"), F.sum("__sum").alias("__sum"), F.sum("__n").alias("__n"))
    return totals.select(
        "project", F.col("range.start").alias("start"), F.col("range.end").alias("end"), "traces",
        F.try_divide(F.col("__sum"), F.col("__n")).alias("mean"),
    )


def _windowed(stream: DataFrame, window: Column, value: str, parts: bool = False) -> DataFrame:
    grouped = stream.groupBy("project", window.alias("window"))
    traces = F.count("*").alias("traces")
    if parts:
        return grouped.agg(traces, F.sum(value).alias("__sum"), F.count(value).alias("__n"))
    return grouped.agg(traces, F.avg(value).alias("mean")).select(
        "project", F.col("window.start").alias("start"), F.col("window.end").alias("end"), "traces", "mean"
    )


def session_stream(stream: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour", by: Sequence[str] = ("thread_id",)) -> DataFrame:
    """Closed sessions of arriving threads, which the columns ``by`` name.

    A session is kept as its bounds and size only, so the state of a long conversation does not grow with it; the text
    of a closed session is read from the trace table by ``thread_parts``.
    """
    return sessions_by(event_time(stream, watermark), by, gap).select(*by, *SESSION_COLUMNS[1:])


def write_batches(rows: DataFrame, path: str, checkpoint: str, make: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Write ``make`` of every micro-batch to a folder of the batch's own, ``path/batch=<number>``. A batch that runs again
    after a crash overwrites what it had written, so every batch counts once."""

    def write(batch: DataFrame, number: int) -> None:
        fixed = materialise(batch, "batch")  # state and sources run once, however often ``make`` reads the batch
        make(fixed).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def judge_threads(
    stream: DataFrame,
    read_traces: Callable[[], DataFrame],
    rules: DataFrame,
    answer: Callable[[pd.Series], pd.Series],
    path: str,
    checkpoint: str,
    gap: str = "30 minutes",
    watermark: str = "1 hour",
    size: int = 50,
) -> StreamingQuery:
    """Thread rules on arriving traces: as a session closes its conversation is read from the trace table, which
    ``read_traces`` opens anew for every batch, and judged. The scores are those of the stored sessions."""
    closed = session_stream(stream, gap, watermark, THREAD)
    return write_batches(closed, path, checkpoint, lambda batch: judge_sessions(batch, read_traces(), rules, answer, size))


def enqueue_stream(stream: DataFrame, queue: str, predicate: Column, time: str | None = None) -> DataFrame:
    """Assignment rows of arriving traces that the predicate selects; with ``time`` also the ``day`` of that column."""
    day = [F.to_date(time).alias("day")] if time else []
    return stream.where(predicate).select(F.lit(queue).alias("queue"), "trace_id", *day)


def add_assignments(fresh: DataFrame, path: str, writer: str, batch: int) -> None:
    """Add assignments that are not there yet to a table in folders by queue, day of the trace (if given), writer and batch.

    A batch replaces its own folders, so a batch that runs again adds nothing twice. A trace assigned by an earlier batch or another
    writer lies in the same queue and day: only these folders are read. The queues and days of one batch reach the driver.
    Writers that add one trace at the same moment cannot see each other; ``read_assignments`` counts it once.
    """
    spark = fresh.sparkSession
    keys = [c for c in ("queue", "day") if c in fresh.columns]
    rows = fresh.distinct()
    schema = rows.schema.add("writer", "string").add("batch", "long")
    known = if_written(spark, path, schema)
    if known is not None:
        folders = rows.select(*keys).distinct().collect()
        for key in keys:
            known = known.where(F.col(key).isin([r[key] for r in folders]))
        others = known.where(~((F.col("writer") == writer) & (F.col("batch") == batch)))
        rows = rows.join(others, ["trace_id", *keys], "left_anti")
    placed = rows.withColumns({"writer": F.lit(writer), "batch": F.lit(batch)})
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys, "writer", "batch").parquet(path)


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    """Every assigned trace once, by queue."""
    schema = schemas.ASSIGNMENT
    return spark.read.schema(schema).parquet(path).select(*schema.names).distinct()


def write_assignments(rows: DataFrame, path: str, checkpoint: str, writer: str | None = None) -> StreamingQuery:
    """Append assignments that are not there yet (``add_assignments``), so that a batch delivered again changes nothing.
    A writer is known by its checkpoint unless it is named."""
    name = writer or hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def add(batch: DataFrame, number: int) -> None:
        add_assignments(materialise(batch, "assignments"), path, name, number)

    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_rows(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append rows to a Parquet table, exactly once; stops when all that has arrived is done."""
    stream = rows.writeStream.format("parquet").outputMode("append")
    return stream.option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_available(rows: DataFrame, name: str) -> DataFrame:
    """Run a streaming plan over all that has arrived and give back the written table."""
    spark = rows.sparkSession
    base = scratch_path(spark, name)
    write_rows(rows, f"{base}/rows", f"{base}/state").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/rows")


def daily_rescore(traces: DataFrame, score: Callable[[DataFrame], DataFrame], as_of: date) -> DataFrame:
    """Late scores: the closed day before ``as_of`` is computed again as a whole."""
    return score(traces_of_yesterday(traces, as_of))
