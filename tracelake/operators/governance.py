"""Governance: derived scores per trace, score series by interval and slice, completeness checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.distribution import spread_join
from tracelake.functions import scoring
from tracelake.functions.dates import bucket
from tracelake.operators.filters import clean_scores, has_tag, metadata_filter

# The tag that marks governed traces, metadata every governed trace needs, scores a finished trace has.
GOVERNANCE_TAG = "governance"
REQUIRED_METADATA = [
    "env",
    "region",
    "use_case_id",
    "use_case_version",
    "team",
    "business_unit",
    "model_name",
    "model_version",
    "risk_tier",
    "data_classification",
    "regulatory_scope",
]
EXPECTED_SCORES = [
    "hallucination_rate",
    "response_quality",
    "cost_usd",
    "regulatory_compliance",
    "composite_risk_score",
    "oversight_risk_flag",
    "cost_per_quality_unit",
]

# The derived scores and the reason written with each.
DERIVED_REASONS = {
    "composite_risk_score": "0.5×compliance + 0.3×(1−hallucination) + 0.2×quality",
    "oversight_risk_flag": f"1.0 = composite_risk_score < {scoring.RISK_THRESHOLD}",
    "cost_per_quality_unit": "cost_usd / response_quality",
}


def with_derived(traces: DataFrame) -> DataFrame:
    """Adds the three derived scores; needs ``scores`` as a map."""
    composite = scoring.composite_risk(F.col("scores"))
    return traces.withColumns(
        {
            "composite_risk_score": composite,
            "oversight_risk_flag": scoring.oversight_flag(composite),
            "cost_per_quality_unit": scoring.cost_per_quality(F.col("scores")),
        }
    )


def derived_score_rows(traces: DataFrame) -> DataFrame:
    """Long rows of the derived scores that exist, ready to append to the score table. Narrow: no shuffle."""
    entries = [
        F.when(
            F.col(name).isNotNull(),
            F.struct(F.lit(name).alias("name"), F.col(name).alias("value"), F.lit(reason).alias("reason")),
        )
        for name, reason in DERIVED_REASONS.items()
    ]
    rows = with_derived(traces).select("trace_id", F.explode(F.array_compact(F.array(*entries))).alias("s"))
    return rows.select("trace_id", "s.name", "s.value", "s.reason", F.lit("sdk").alias("source"))


def batch_counters(traces: DataFrame) -> DataFrame:
    """Traces seen, traces that got a derived score, and the rest."""
    derived = F.coalesce(*[F.col(name) for name in DERIVED_REASONS]).isNotNull()
    scored = F.count_if(derived)
    return with_derived(traces).agg(
        F.count("*").alias("processed"), scored.alias("scored"), (F.count("*") - scored).alias("skipped")
    )


def trace_scores(scores: DataFrame) -> DataFrame:
    """Score map per trace from the long table; of several values of one name the latest wins."""
    latest = clean_scores(scores).groupBy("trace_id", "name").agg(F.max_by("value", "ts").alias("value"))
    return latest.groupBy("trace_id").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("scores"))


def explode_scores(traces: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Long score rows of traces that carry a score map."""
    return traces.select(*keep, F.explode("scores").alias("name", "value")).where(F.col("value").isNotNull())


def score_series(scores: DataFrame, interval: str, by: Sequence[str] = ()) -> DataFrame:
    """Average per project, score name and interval; averages combine before the shuffle."""
    bucketed = scores.withColumn("time", bucket(F.col("start_time"), interval))
    return bucketed.groupBy("project", *by, "name", "time").agg(F.avg("value").alias("value"))


def active_projects(projects: DataFrame, traces: DataFrame, tag: str = GOVERNANCE_TAG) -> DataFrame:
    """Projects with at least one tagged trace. The traces are reduced to project ids before the join."""
    tagged = traces.where(has_tag(F.col("tags"), tag)).select(F.col("project_id").alias("id")).distinct()
    return projects.join(tagged, "id", "left_semi")


def slice_label(conditions: Mapping[str, str]) -> str:
    return "&".join(f"{k}={v}" for k, v in sorted(conditions.items())) or "all"


def slice_label_of(conditions: Column) -> Column:
    """``slice_label`` for a map column."""
    pairs = F.transform(F.array_sort(F.map_entries(conditions)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.when(F.size(conditions) == 0, "all").otherwise(F.array_join(pairs, "&"))


def slice_traces(traces: DataFrame, slices: Sequence[Mapping[str, str]]) -> DataFrame:
    """One row per (trace, slice it belongs to); the slice without conditions is always there.

    Slices are configuration and become part of the plan, so all are served by one pass and no join.
    """
    conditions = [{}, *[s for s in slices if s]]
    labels = [F.when(metadata_filter(c), F.lit(slice_label(c))) for c in conditions]
    return traces.withColumn("slice", F.explode(F.array_compact(F.array(*labels))))


def slice_traces_by_table(traces: DataFrame, slices: DataFrame) -> DataFrame:
    """``slice_traces`` for a table of slices (``conditions`` map) of any size.

    A trace belongs to a slice if as many of its metadata pairs occur in the slice as the slice has, so the theta
    condition becomes an equi join on (key, value) followed by a count per trace and slice.
    """
    known = slices.select(F.array_sort(F.map_entries("conditions")).alias("__pairs")).distinct().select(F.map_from_entries("__pairs").alias("conditions"))
    labelled = known.select(slice_label_of(F.col("conditions")).alias("slice"), F.xxhash64(F.array_sort(F.map_entries("conditions"))).alias("__slice"), "conditions")
    wanted = labelled.where(F.size("conditions") > 0).select(
        "slice", "__slice", F.size("conditions").alias("__need"), F.explode("conditions").alias("__k", "__v")
    )
    pairs = traces.select("trace_id", F.explode("metadata").alias("__k", "__v")).distinct()
    hits = spread_join(pairs, wanted, ["__k", "__v"], "inner", "trace_id")
    members = hits.groupBy("trace_id", "slice", "__slice", "__need").count().where(F.col("count") == F.col("__need"))
    matched = traces.join(members.select("trace_id", "slice"), "trace_id")
    return traces.withColumn("slice", F.lit("all")).unionByName(matched.select(*traces.columns, "slice"))


def slice_metrics(traces: DataFrame, slices: Sequence[Mapping[str, str]], interval: str, tag: str = GOVERNANCE_TAG) -> DataFrame:
    """Score series of the governed traces for every slice."""
    governed = traces.where(has_tag(F.col("tags"), tag))
    rows = explode_scores(slice_traces(governed, slices), ["project", "slice", "start_time"])
    return score_series(rows, interval, ["slice"])


def governance_cube(traces: DataFrame, dims: Sequence[str], tag: str = GOVERNANCE_TAG) -> DataFrame:
    """Averages over every combination of metadata dimensions; ``level`` tells rolled-up dimensions from missing values.

    Each trace row is first summed at the finest level, so the combinations multiply those groups and not the rows.
    """
    governed = traces.where(has_tag(F.col("tags"), tag))
    flat = governed.select(*[F.col("metadata")[d].alias(d) for d in dims], F.explode("scores").alias("name", "value"))
    finest = flat.where(F.col("value").isNotNull()).groupBy(*dims, "name").agg(
        F.sum("value").alias("__sum"), F.count("*").alias("__n")
    )
    sets = [[d for i, d in enumerate(dims) if mask >> i & 1] + ["name"] for mask in range(2 ** len(dims))]
    by = [F.col(c) for c in [*dims, "name"]]
    cube = finest.groupingSets([[F.col(c) for c in s] for s in sets], *by)
    return cube.agg(
        F.grouping_id(*by).alias("level"),
        F.sum("__n").alias("n"),
        (F.sum("__sum") / F.sum("__n")).alias("value"),
    )


def governance_payload(series: DataFrame, as_of: datetime, tag: str = GOVERNANCE_TAG) -> DataFrame:
    """Nested payload per project: slices, in them scores, in them points by time. Input is the aggregated series."""
    points = F.array_sort(F.collect_list(F.struct("time", "value")))
    named = series.groupBy("project", "slice", "name").agg(points.alias("data"))
    sliced = named.groupBy("project", "slice").agg(F.array_sort(F.collect_list(F.struct("name", "data"))).alias("metrics"))
    return sliced.groupBy("project").agg(F.map_from_entries(F.collect_list(F.struct("slice", "metrics"))).alias("slices")).select(
        F.lit("2.0").alias("schema_version"),
        F.lit(as_of.isoformat()).alias("extracted_at"),
        "project",
        F.lit(tag).alias("governance_tag"),
        "slices",
    )


def metadata_gaps(traces: DataFrame, required: Sequence[str] = REQUIRED_METADATA, tag: str = GOVERNANCE_TAG) -> DataFrame:
    """Governed traces lacking required metadata, with the list of what is missing."""
    governed = traces.where(has_tag(F.col("tags"), tag))
    return governed.select("trace_id", _missing(required, "metadata").alias("missing")).where(F.size("missing") > 0)


def metadata_completeness(traces: DataFrame, required: Sequence[str] = REQUIRED_METADATA, tag: str = GOVERNANCE_TAG) -> DataFrame:
    """Governed traces and missing values per required field, in one aggregation."""
    governed = traces.where(has_tag(F.col("tags"), tag))
    return _completeness(governed, required, "metadata", "field")


def score_gaps(traces: DataFrame, expected: Sequence[str] = EXPECTED_SCORES) -> DataFrame:
    return traces.select("trace_id", _missing(expected, "scores").alias("missing")).where(F.size("missing") > 0)


def score_inventory(traces: DataFrame, expected: Sequence[str] = EXPECTED_SCORES) -> DataFrame:
    return _completeness(traces, expected, "scores", "score")


def _missing(names: Sequence[str], column: str) -> Column:
    absent = [F.when(F.col(column)[n].isNull(), F.lit(n)) for n in names]
    return F.array_compact(F.array(*absent))


def _completeness(df: DataFrame, names: Sequence[str], column: str, label: str) -> DataFrame:
    counts = [F.count_if(F.col(column)[n].isNull()).alias(n) for n in names]
    totals = df.agg(F.count("*").alias("traces"), *counts)
    return totals.unpivot("traces", list(names), label, "missing")
