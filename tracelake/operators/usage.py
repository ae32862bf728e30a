"""Usage metrics: daily series, monthly rollup, snapshots and the tables of the usage report."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.distribution import exact_percentiles
from tracelake.functions.dates import bucket, day_label, latency_ms, moment
from tracelake.functions.text import format_amount, format_metric

# Metric names, in report order.
DAILY_METRICS = ["TRACE_COUNT", "THREAD_COUNT", "SPAN_COUNT", "TOKEN_USAGE", "COST"]
SNAPSHOT_METRICS = ["TRACE_COUNT", "THREAD_COUNT", "TOKENS_TOTAL", "TOTAL_COST", "GUARDRAILS_FAILED_COUNT"]
DAILY_COLUMNS = ["workspace", "project_id", "project", "metric", "series", "date", "value"]

UNKNOWN_PROJECT = "unknown"
NO_SERIES = "—"


def sum_usage(usage: Column, keys: list[str] | None = None) -> Column:
    """Sum of all values of a usage map, or of the given keys only."""
    if keys is not None:
        usage = F.map_filter(usage, lambda k, _: k.isin(keys))
    total = F.aggregate(F.map_values(usage), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return F.coalesce(total, F.lit(0.0))


def with_project_name(df: DataFrame, projects: DataFrame) -> DataFrame:
    """Project name by id. Only ids that are projects have one; the others are ``unknown``."""
    names = projects.select(F.col("id").alias("project_id"), F.col("name").alias("project"))
    return df.join(names, "project_id", "left").withColumn("project", F.coalesce("project", F.lit(UNKNOWN_PROJECT)))


def _in_window(df: DataFrame, start: date | datetime | None, end: date | datetime | None) -> DataFrame:
    kind = df.schema["start_time"].dataType
    if start is not None:
        df = df.where(F.col("start_time") >= (moment(start, kind) if isinstance(start, datetime) else F.lit(start)))
    if isinstance(end, datetime):
        df = df.where(F.col("start_time") <= moment(end, kind))
    elif end is not None:  # a date is its whole day
        df = df.where(F.col("start_time") < F.lit(end + timedelta(days=1)))
    return df.where(F.col("project_id").isNotNull())


def daily_metrics(
    traces: DataFrame,
    spans: DataFrame | None = None,
    metrics: list[str] | None = None,
    start: date | datetime | None = None,
    end: date | datetime | None = None,
    workspace: str = "default",
) -> DataFrame:
    """Long daily frame. One pass over the traces serves every per-trace metric; usage types are exploded in a second.

    Threads are counted from (project, day, thread) groups, so a project with a third of the traces is spread by thread.
    """
    metrics = DAILY_METRICS if metrics is None else metrics
    keys = ["project_id", "project", "date"]
    traces = _in_window(traces, start, end).withColumn("date", F.to_date("start_time"))
    columns = {
        "TRACE_COUNT": F.count("*"),
        "THREAD_COUNT": F.count_distinct("thread_id"),
        "COST": F.sum(F.coalesce(F.col("cost"), F.lit(0.0))),
    }
    wanted = [m for m in columns if m in metrics]
    frames = []
    if wanted:
        per_day = traces.groupBy(*keys).agg(*[columns[m].cast("double").alias(m) for m in wanted])
        frames.append(per_day.unpivot(keys, wanted, "metric", "value").withColumn("series", F.lit("")))
    if "TOKEN_USAGE" in metrics:
        tokens = traces.select(*keys, F.explode("usage").alias("series", "tokens"))
        per_type = tokens.groupBy(*keys, "series").agg(F.sum(F.col("tokens").cast("double")).alias("value"))
        frames.append(per_type.withColumn("metric", F.lit("TOKEN_USAGE")))
    if "SPAN_COUNT" in metrics and spans is not None:
        spans = _in_window(spans, start, end).withColumn("date", F.to_date("start_time"))
        counted = spans.groupBy(*keys).agg(F.count("*").cast("double").alias("value"))
        frames.append(counted.select("*", F.lit("SPAN_COUNT").alias("metric"), F.lit("").alias("series")))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result.withColumn("workspace", F.lit(workspace)).select(*DAILY_COLUMNS)


def snapshot(traces: DataFrame) -> DataFrame:
    """Long summary frame: five totals per project in one pass."""
    per_project = traces.groupBy("project").agg(
        F.count("*").cast("double").alias("TRACE_COUNT"),
        F.count_distinct("thread_id").cast("double").alias("THREAD_COUNT"),
        F.sum(sum_usage(F.col("usage"))).alias("TOKENS_TOTAL"),
        F.coalesce(F.sum("cost"), F.lit(0.0)).alias("TOTAL_COST"),
        F.count_if("guardrail_failed").cast("double").alias("GUARDRAILS_FAILED_COUNT"),
    )
    return per_project.unpivot("project", SNAPSHOT_METRICS, "metric", "value")


def project_cost(total: Column, summed: Column) -> Column:
    """Total cost, else the older summed field, else zero."""
    return F.coalesce(total, summed, F.lit(0.0))


def rollup_monthly(daily: DataFrame) -> DataFrame:
    """Month totals dated at the month's end; projects of one name merge, rows without a key value drop out."""
    keys = ["workspace", "project", "metric", "series"]
    return (
        daily.dropna(subset=[*keys, "date"])
        .groupBy(*keys, F.last_day("date").alias("date"))
        .agg(F.sum("value").alias("value"))
    )


def pivot_totals(daily: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    wanted = DAILY_METRICS if metrics is None else metrics
    return daily.groupBy("project").pivot("metric", wanted).sum("value").na.fill(0.0, wanted)


def snapshot_table(summary: DataFrame) -> DataFrame:
    return summary.groupBy("project").pivot("metric", SNAPSHOT_METRICS).sum("value").na.fill(0.0, SNAPSHOT_METRICS)


def snapshot_text(summary: DataFrame) -> DataFrame:
    """Snapshot table with its numbers as display text."""
    table = snapshot_table(summary)
    return table.select("project", *[format_metric(F.lit(m), F.col(m)).alias(m) for m in SNAPSHOT_METRICS])


def magnitude(daily: DataFrame, metric: str) -> DataFrame:
    """Totals by project and series; a missing or empty series is kept and shown as a dash."""
    totals = daily.where(F.col("metric") == metric).groupBy("project", "series").agg(F.sum("value").alias("value"))
    shown = F.coalesce(F.nullif(F.col("series"), F.lit("")), F.lit(NO_SERIES))
    text = format_amount(F.col("value"), 4) if metric == "COST" else F.format_number("value", 0)
    return totals.select("project", shown.alias("series"), "value", text.alias("display"))


def daily_series(daily: DataFrame, metric: str) -> DataFrame:
    """Sum over all projects per day, in date order; days without data stay out."""
    totals = daily.where(F.col("metric") == metric).groupBy("date").agg(F.sum("value").alias("value"))
    return sort_series(totals.withColumn("label", day_label(F.col("date"))))


def sort_series(series: DataFrame) -> DataFrame:
    return series.orderBy("date")


def cumulative(daily: DataFrame, metrics: list[str]) -> DataFrame:
    """Running total per metric over days. Days are summed first, so the window sees one row per metric and day."""
    totals = daily.where(F.col("metric").isin(metrics)).groupBy("metric", "date").agg(F.sum("value").alias("value"))
    running = Window.partitionBy("metric").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return totals.withColumn("cumulative", F.sum("value").over(running))


def with_duration(traces: DataFrame) -> DataFrame:
    return traces.withColumn("duration_ms", latency_ms(F.col("start_time"), F.col("end_time")))


def duration_series(traces: DataFrame, interval: str, exact: bool = True) -> DataFrame:
    """Duration p50/p90/p99 per project and interval; needs ``duration_ms``."""
    bucketed = traces.withColumn("time", bucket(F.col("start_time"), interval))
    shares = [0.5, 0.9, 0.99]
    if exact:
        return exact_percentiles(bucketed, ["project", "time"], "duration_ms", shares)
    approx = F.percentile_approx("duration_ms", F.array(*[F.lit(s) for s in shares]))
    return bucketed.groupBy("project", "time").agg(approx.alias("p")).select(
        "project", "time", *[F.col("p")[i].alias(n) for i, n in enumerate(["p50", "p90", "p99"])]
    )


def usage_report(daily: DataFrame, summary: DataFrame) -> dict[str, DataFrame]:
    """The tables behind the usage report."""
    counts = ["TRACE_COUNT", "SPAN_COUNT", "THREAD_COUNT"]
    tables = {"snapshot": snapshot_text(summary), "monthly": rollup_monthly(daily), "totals": pivot_totals(daily)}
    tables |= {f"daily_{m.lower()}": daily_series(daily, m) for m in counts}
    tables["cumulative"] = cumulative(daily, counts)
    tables |= {f"magnitude_{m.lower()}": magnitude(daily, m) for m in ("TOKEN_USAGE", "COST")}
    return tables
