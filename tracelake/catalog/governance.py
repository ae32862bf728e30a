"""Governance queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.catalog.bindings import AS_OF, Tables
from tracelake.catalog.registry import mean_digits, query
from tracelake.operators import filters, governance

SLICES = [{"env": "prod"}, {"risk_tier": "high"}, {"env": "prod", "risk_tier": "high"}]
DIMS = ["env", "risk_tier", "business_unit"]

SCORES = ("traces", "scores")
SLICED = """
    sliced AS (SELECT *, unnest([x FOR x IN ['all', CASE WHEN env = 'prod' THEN 'env=prod' END,
      CASE WHEN risk_tier = 'high' THEN 'risk_tier=high' END,
      CASE WHEN env = 'prod' AND risk_tier = 'high' THEN 'env=prod&risk_tier=high' END] IF x IS NOT NULL]) AS slice
      FROM scores WHERE list_contains(tags, 'governance')),
    series AS (SELECT project, slice, score AS name, date_trunc('day', start_time) AS time, avg(score_value) AS value FROM sliced GROUP BY ALL)"""
DERIVED = """
    composite AS (SELECT *, round(0.5::DOUBLE * c + 0.3::DOUBLE * (1.0 - h) + 0.2::DOUBLE * coalesce(q, 0.8), 4) AS risk,
      round(CASE WHEN q <> 0 THEN cost_usd / q END, 6) AS per_quality FROM traces)"""


@query(
    "composite_scores",
    f"""WITH {DERIVED} SELECT * FROM (
      SELECT trace_id, 'composite_risk_score' AS name, risk AS value FROM composite
      UNION ALL SELECT trace_id, 'oversight_risk_flag', CASE WHEN risk < 0.75 THEN 1.0 WHEN risk >= 0.75 THEN 0.0 END::DOUBLE FROM composite
      UNION ALL SELECT trace_id, 'cost_per_quality_unit', per_quality FROM composite) WHERE value IS NOT NULL""",
    ("traces",),
)
def composite_scores(t: Tables) -> DataFrame:
    return governance.derived_score_rows(t.traces).select("trace_id", "name", "value")


@query(
    "batch_counters",
    f"""WITH {DERIVED} SELECT count(*) AS processed, count(*) FILTER (risk IS NOT NULL OR per_quality IS NOT NULL) AS scored,
      count(*) FILTER (risk IS NULL AND per_quality IS NULL) AS skipped FROM composite""",
    ("traces",),
)
def batch_counters(t: Tables) -> DataFrame:
    return governance.batch_counters(t.traces)


def _score_series(interval: str):
    def run(t: Tables) -> DataFrame:
        series = governance.score_series(governance.explode_scores(t.traces, ["project", "start_time"]), interval)
        return series.withColumns({"time": F.col("time").cast("timestamp_ntz"), "value": mean_digits(F.col("value"))})

    return run


for _interval, _unit in (("HOURLY", "hour"), ("DAILY", "day"), ("WEEKLY", "week"), ("TOTAL", None)):
    _time = f"date_trunc('{_unit}', start_time)::TIMESTAMP" if _unit else "NULL::TIMESTAMP"
    query(
        f"score_series_{_interval.lower()}",
        f"SELECT project, score AS name, {_time} AS time, round(avg(score_value) + 1e-9, 6) AS value FROM scores GROUP BY 1, 2, 3",
        SCORES,
    )(_score_series(_interval))


@query(
    "active_projects",
    "SELECT id, name FROM projects WHERE id IN (SELECT project_id FROM traces WHERE list_contains(tags, 'governance'))",
    ("traces", "projects"),
)
def active_projects(t: Tables) -> DataFrame:
    return governance.active_projects(t.projects, t.traces)


@query("slice_metrics", f"WITH {SLICED} SELECT project, slice, name, time, round(value + 1e-9, 6) AS value FROM series", SCORES)
def slice_metrics(t: Tables) -> DataFrame:
    series = governance.slice_metrics(t.traces, SLICES, "DAILY")
    return series.withColumns({"time": F.col("time").cast("timestamp_ntz"), "value": mean_digits(F.col("value"))})


@query(
    "slice_table_counts",
    """SELECT slice, count(*) AS traces FROM (
      SELECT 'all' AS slice FROM traces
      UNION ALL SELECT 'business_unit=' || business_unit || '&env=' || env FROM traces)
    GROUP BY slice""",
    ("traces",),
)
def slice_table_counts(t: Tables) -> DataFrame:
    meta = F.col("metadata")
    pairs = t.traces.select(meta["env"].alias("env"), meta["business_unit"].alias("unit")).distinct()
    slices = pairs.select(F.create_map(F.lit("env"), "env", F.lit("business_unit"), "unit").alias("conditions"))
    members = governance.slice_traces_by_table(t.traces, slices)
    return members.groupBy("slice").agg(F.count("*").alias("traces"))


@query(
    "governance_cube",
    """SELECT env, risk_tier, business_unit, score AS name, GROUPING(env, risk_tier, business_unit, score)::BIGINT AS level, count(*) AS n,
      round(avg(score_value) + 1e-9, 6) AS value FROM scores WHERE list_contains(tags, 'governance') GROUP BY score, CUBE (env, risk_tier, business_unit)""",
    SCORES,
)
def governance_cube(t: Tables) -> DataFrame:
    return governance.governance_cube(t.traces, DIMS).withColumn("value", mean_digits(F.col("value")))


@query(
    "governance_payload",
    f"""WITH {SLICED} SELECT project, '2.0' AS schema_version, slice, name, len(list(value))::BIGINT AS points, min(time) AS first_time,
      round(min_by(value, time) + 1e-9, 6) AS first_value FROM series GROUP BY ALL""",
    SCORES,
)
def governance_payload(t: Tables) -> DataFrame:
    payload = governance.governance_payload(governance.slice_metrics(t.traces, SLICES, "DAILY"), AS_OF)
    slices = payload.select("project", "schema_version", F.explode("slices").alias("slice", "metrics"))
    metrics = slices.select("project", "schema_version", "slice", F.explode("metrics").alias("m"))
    first = F.element_at("m.data", 1)
    return metrics.select(
        "project", "schema_version", "slice", F.col("m.name").alias("name"), F.size("m.data").cast("long").alias("points"),
        first["time"].cast("timestamp_ntz").alias("first_time"), mean_digits(first["value"]).alias("first_value"),
    )


@query(
    "meta_completeness",
    """SELECT traces, field, missing FROM (UNPIVOT (SELECT count(*) AS traces, count(*) FILTER (env IS NULL) AS env,
      count(*) FILTER (risk_tier IS NULL) AS risk_tier, count(*) FILTER (business_unit IS NULL) AS business_unit, count(*) AS region
      FROM traces WHERE list_contains(tags, 'governance')) ON env, risk_tier, business_unit, region INTO NAME field VALUE missing)""",
    ("traces",),
)
def meta_completeness(t: Tables) -> DataFrame:
    return governance.metadata_completeness(t.traces, [*DIMS, "region"])


@query(
    "meta_gaps",
    "SELECT trace_id, 'risk_tier' AS missing FROM traces WHERE list_contains(tags, 'governance') AND risk_tier IS NULL",
    ("traces",),
)
def meta_gaps(t: Tables) -> DataFrame:
    gaps = governance.metadata_gaps(t.traces, DIMS)
    return gaps.withColumn("missing", F.array_join("missing", ","))


@query(
    "score_inventory",
    f"""SELECT traces, score, missing FROM (UNPIVOT (SELECT count(*) AS traces, count(*) FILTER (h IS NULL) AS hallucination_rate,
      count(*) FILTER (q IS NULL) AS response_quality, count(*) FILTER (cost_usd IS NULL) AS cost_usd, count(*) FILTER (c IS NULL) AS regulatory_compliance,
      count(*) AS composite_risk_score, count(*) AS oversight_risk_flag, count(*) AS cost_per_quality_unit FROM traces)
      ON {', '.join(governance.EXPECTED_SCORES)} INTO NAME score VALUE missing)""",
    ("traces",),
)
def score_inventory(t: Tables) -> DataFrame:
    return governance.score_inventory(t.traces)


@query(
    "score_gaps",
    """SELECT trace_id, concat_ws(',', CASE WHEN q IS NULL THEN 'response_quality' END, CASE WHEN c IS NULL THEN 'regulatory_compliance' END) AS missing
      FROM traces WHERE q IS NULL OR c IS NULL""",
    ("traces",),
)
def score_gaps(t: Tables) -> DataFrame:
    gaps = governance.score_gaps(t.traces, governance.EXPECTED_SCORES[:4])
    return gaps.withColumn("missing", F.array_join("missing", ","))


@query("low_score_search", "SELECT trace_id, q AS quality FROM traces WHERE q < 0.6", ("traces",))
def low_score_search(t: Tables) -> DataFrame:
    low = t.traces.where(filters.score_below("response_quality", 0.6))
    return low.select("trace_id", F.col("scores")["response_quality"].alias("quality"))


@query(
    "labelled_scores",
    """SELECT project, name, avg(value) AS value, count(*) AS n FROM (
      SELECT d.source AS project, unnest(['quality', 'toxic']) AS name, unnest([l.quality, l.toxic]) AS value FROM documents d JOIN labels l USING (doc_id))
    GROUP BY 1, 2""",
)
def labelled_scores(t: Tables) -> DataFrame:
    labels = t.table("labels").unpivot("doc_id", ["quality", "toxic"], "name", "value")
    scores = filters.clean_scores(labels).withColumnRenamed("doc_id", "trace_id").withColumn("ts", F.lit(0))
    per_trace = governance.trace_scores(scores)
    joined = t.table("documents").select(F.col("doc_id").alias("trace_id"), F.col("source").alias("project")).join(per_trace, "trace_id")
    rows = governance.explode_scores(joined, ["project"])
    return rows.groupBy("project", "name").agg(F.avg("value").alias("value"), F.count("*").alias("n"))
