"""Usage queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.catalog.bindings import Tables
from tracelake.catalog.registry import dates_as_text, query
from tracelake.operators import usage


def _spans(t: Tables) -> DataFrame:
    return t.table("lineitem").select(
        (F.col("l_suppkey") % 6).alias("project_id"), F.concat(F.lit("proj"), F.col("l_suppkey") % 6).alias("project"),
        F.col("l_shipdate").alias("start_time"),
    )


def _daily(t: Tables, *metrics: str) -> DataFrame:
    return usage.daily_metrics(t.traces, _spans(t), list(metrics) or None)


DAILY = """
    daily AS (
      SELECT project, CAST(start_time AS DATE) AS date, 'TRACE_COUNT' AS metric, '' AS series, CAST(count(*) AS DOUBLE) AS value FROM traces GROUP BY 1, 2
      UNION ALL SELECT project, CAST(start_time AS DATE), 'THREAD_COUNT', '', CAST(count(DISTINCT thread_id) AS DOUBLE) FROM traces GROUP BY 1, 2
      UNION ALL SELECT project, CAST(start_time AS DATE), 'COST', '', sum(cost) FROM traces GROUP BY 1, 2
      UNION ALL SELECT project, CAST(start_time AS DATE), 'TOKEN_USAGE', 'prompt_tokens', CAST(sum(prompt_tokens) AS DOUBLE) FROM traces GROUP BY 1, 2
      UNION ALL SELECT project, CAST(start_time AS DATE), 'TOKEN_USAGE', 'completion_tokens', CAST(sum(completion_tokens) AS DOUBLE) FROM traces GROUP BY 1, 2
      UNION ALL SELECT 'proj' || (l_suppkey % 6), CAST(l_shipdate AS DATE), 'SPAN_COUNT', '', CAST(count(*) AS DOUBLE) FROM lineitem GROUP BY 1, 2)"""
SUMMARY = """
    summary AS (UNPIVOT (
      SELECT project, CAST(count(*) AS DOUBLE) AS TRACE_COUNT, CAST(count(DISTINCT thread_id) AS DOUBLE) AS THREAD_COUNT,
        CAST(sum(prompt_tokens + completion_tokens) AS DOUBLE) AS TOKENS_TOTAL, sum(cost) AS TOTAL_COST,
        CAST(count(*) FILTER (guardrail_failed) AS DOUBLE) AS GUARDRAILS_FAILED_COUNT
      FROM traces GROUP BY project) ON TRACE_COUNT, THREAD_COUNT, TOKENS_TOTAL, TOTAL_COST, GUARDRAILS_FAILED_COUNT INTO NAME metric VALUE value)"""


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("daily_trace_count", f"WITH {DAILY} SELECT project, CAST(date AS VARCHAR) AS date, value FROM daily WHERE metric = 'TRACE_COUNT'", ("traces",))
def daily_trace_count(t: Tables) -> DataFrame:
    return dates_as_text(_daily(t, "TRACE_COUNT").select("project", "date", "value"))


@query("daily_thread_count", f"WITH {DAILY} SELECT project, CAST(date AS VARCHAR) AS date, value FROM daily WHERE metric = 'THREAD_COUNT'", ("traces",))
def daily_thread_count(t: Tables) -> DataFrame:
    return dates_as_text(_daily(t, "THREAD_COUNT").select("project", "date", "value"))


@query("daily_span_count", f"WITH {DAILY} SELECT project, CAST(date AS VARCHAR) AS date, value FROM daily WHERE metric = 'SPAN_COUNT'", ("traces",))
def daily_span_count(t: Tables) -> DataFrame:
    return dates_as_text(_daily(t, "SPAN_COUNT").select("project", "date", "value"))


@query(
    "daily_tokens_cost",
    f"WITH {DAILY} SELECT project, CAST(date AS VARCHAR) AS date, metric, series, round(value, 6) AS value FROM daily WHERE metric IN ('TOKEN_USAGE', 'COST')",
    ("traces",),
)
def daily_tokens_cost(t: Tables) -> DataFrame:
    return dates_as_text(_rounded(_daily(t, "TOKEN_USAGE", "COST").select("project", "date", "metric", "series", "value"), "value"))


@query(
    "monthly_rollup",
    f"WITH {DAILY} SELECT project, metric, series, CAST(last_day(date) AS VARCHAR) AS date, round(sum(value), 6) AS value FROM daily GROUP BY ALL",
    ("traces",),
)
def monthly_rollup(t: Tables) -> DataFrame:
    return dates_as_text(_rounded(usage.rollup_monthly(_daily(t)).drop("workspace"), "value"))


@query(
    "usage_pivot",
    f"""WITH {DAILY} SELECT project, {', '.join(f"round(coalesce(sum(value) FILTER (metric = '{m}'), 0), 6) AS {m}" for m in usage.DAILY_METRICS)}
    FROM daily GROUP BY project""",
    ("traces",),
)
def usage_pivot(t: Tables) -> DataFrame:
    return _rounded(usage.pivot_totals(_daily(t)), *usage.DAILY_METRICS)


@query("snapshot_long", f"WITH {SUMMARY} SELECT project, metric, round(value, 6) AS value FROM summary", ("traces",))
def snapshot_long(t: Tables) -> DataFrame:
    return _rounded(usage.snapshot(t.traces), "value")


@query(
    "snapshot_table",
    f"""WITH {SUMMARY} SELECT project, {', '.join(f"round(coalesce(sum(value) FILTER (metric = '{m}'), 0), 6) AS {m}" for m in usage.SNAPSHOT_METRICS)}
    FROM summary GROUP BY project""",
    ("traces",),
)
def snapshot_table(t: Tables) -> DataFrame:
    return _rounded(usage.snapshot_table(usage.snapshot(t.traces)), *usage.SNAPSHOT_METRICS)


@query(
    "snapshot_text",
    f"""WITH {SUMMARY} SELECT project, {', '.join(
        f"max(CASE WHEN metric = '{m}' THEN " + ("'$' || format('{:,.2f}', value)" if m == "TOTAL_COST" else "format('{:,}', CAST(round(value) AS BIGINT))") + f" END) AS {m}"
        for m in usage.SNAPSHOT_METRICS)} FROM summary GROUP BY project""",
    ("traces",),
)
def snapshot_text(t: Tables) -> DataFrame:
    return usage.snapshot_text(usage.snapshot(t.traces))


@query(
    "magnitude_tokens",
    f"""WITH {DAILY} SELECT project, series, sum(value) AS value, format('{{:,}}', CAST(sum(value) AS BIGINT)) AS display
    FROM daily WHERE metric = 'TOKEN_USAGE' GROUP BY 1, 2""",
    ("traces",),
)
def magnitude_tokens(t: Tables) -> DataFrame:
    return usage.magnitude(_daily(t, "TOKEN_USAGE"), "TOKEN_USAGE")


@query(
    "magnitude_cost",
    f"""WITH {DAILY} SELECT project, '—' AS series, round(sum(value), 6) AS value, '$' || format('{{:,.4f}}', sum(value)) AS display
    FROM daily WHERE metric = 'COST' GROUP BY 1""",
    ("traces",),
)
def magnitude_cost(t: Tables) -> DataFrame:
    return _rounded(usage.magnitude(_daily(t, "COST"), "COST"), "value")


@query(
    "daily_series",
    f"WITH {DAILY} SELECT CAST(date AS VARCHAR) AS date, sum(value) AS value, strftime(any_value(date), '%b %d') AS label FROM daily WHERE metric = 'TRACE_COUNT' GROUP BY ALL",
    ("traces",),
)
def daily_series(t: Tables) -> DataFrame:
    return dates_as_text(usage.daily_series(_daily(t, "TRACE_COUNT"), "TRACE_COUNT"))


@query(
    "cumulative_traces",
    f"""WITH {DAILY} SELECT metric, CAST(date AS VARCHAR) AS date, value, sum(value) OVER (PARTITION BY metric ORDER BY date) AS cumulative
    FROM (SELECT metric, date, sum(value) AS value FROM daily WHERE metric IN ('TRACE_COUNT', 'THREAD_COUNT', 'SPAN_COUNT') GROUP BY 1, 2)""",
    ("traces",),
)
def cumulative_traces(t: Tables) -> DataFrame:
    counts = ["TRACE_COUNT", "THREAD_COUNT", "SPAN_COUNT"]
    return dates_as_text(usage.cumulative(_daily(t, *counts), counts))


@query(
    "duration_series",
    """SELECT project, date_trunc('day', start_time) AS time, round(quantile_cont(duration_ms, 0.5), 6) AS p50,
      round(quantile_cont(duration_ms, 0.9), 6) AS p90, round(quantile_cont(duration_ms, 0.99), 6) AS p99 FROM traces GROUP BY 1, 2""",
    ("traces",),
)
def duration_series(t: Tables) -> DataFrame:
    series = usage.duration_series(t.traces, "DAILY")
    return _rounded(series.withColumn("time", F.col("time").cast("timestamp_ntz")), "p50", "p90", "p99")


@query(
    "unknown_project",
    """SELECT coalesce(p.project, 'unknown') AS project, count(*) AS traces FROM traces t LEFT JOIN (
      SELECT n_nationkey AS id, 'proj' || n_nationkey AS project FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'AFRICA') p
    ON t.project_id = p.id GROUP BY 1""",
    ("traces",),
)
def unknown_project(t: Tables) -> DataFrame:
    named = t.table("region").where("r_name <> 'AFRICA'").select(F.col("r_regionkey").alias("n_regionkey"))
    known = t.table("nation").join(named, "n_regionkey", "left_semi")
    projects = known.select(F.col("n_nationkey").cast("long").alias("id"), F.concat(F.lit("proj"), "n_nationkey").alias("name"))
    per_project = t.traces.groupBy("project_id").agg(F.count("*").alias("n"))
    return usage.with_project_name(per_project, projects).groupBy("project").agg(F.sum("n").alias("traces"))
