from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tracelake.operators import governance as G
from tracelake.plans.daily_jobs import governance_extract, retrospective_scores
from tracelake.streaming.arrivals import daily_rescore

RUNS = [
    ("loan", "mobile", "high", {"regulatory_compliance": 0.95, "hallucination_rate": 0.1, "response_quality": 0.75, "cost_usd": 0.003}),
    ("card", "branch", "medium", {"regulatory_compliance": 0.85, "hallucination_rate": 0.2, "response_quality": 0.9, "cost_usd": 0.0045}),
    ("tax", "partner", "low", {"hallucination_rate": 0.02, "response_quality": 0.8, "cost_usd": 0.0012}),
    ("refund", "mobile", "low", {"regulatory_compliance": 0.5, "hallucination_rate": 0.40, "cost_usd": 0.0038}),
    ("chat", "mobile", "high", {"regulatory_compliance": 0.6, "hallucination_rate": 0.30, "response_quality": 0.0, "cost_usd": 0.01}),
]
EXPECTED = {
    "loan": (0.895, 0.0, 0.004),
    "card": (0.845, 0.0, 0.005),
    "tax": (None, None, 0.0015),
    "refund": (0.59, 1.0, None),
    "chat": (0.51, 1.0, None),
}
AS_OF = datetime(2026, 7, 2, 3)


@pytest.fixture(scope="module")
def traces(spark):
    data = [(r, "1", "p", datetime(2026, 7, 1, 23, 59, 59, 999999), ["governance"], {"business_unit": u, "risk_tier": t}, s) for r, u, t, s in RUNS]
    data.append(("plain", "2", "q", datetime(2026, 7, 1), [], {}, {}))
    return spark.createDataFrame(
        data, "trace_id string, project_id string, project string, start_time timestamp, tags array<string>, metadata map<string,string>, scores map<string,double>"
    ).cache()


def test_derived_scores(traces):
    found = {r[0]: tuple(r[1:]) for r in G.with_derived(traces).select("trace_id", "composite_risk_score", "oversight_risk_flag", "cost_per_quality_unit").collect()}
    assert {k: found[k] for k in EXPECTED} == EXPECTED
    assert found["plain"] == (None, None, None)


def test_daily_job(traces):
    scores, counters = retrospective_scores(traces, AS_OF)
    assert scores.count() == 11
    assert rows(counters) == [(5, 5, 0)]
    assert rows(G.batch_counters(traces)) == [(6, 5, 1)]
    assert daily_rescore(traces, G.derived_score_rows, AS_OF).count() == 11
    assert retrospective_scores(traces, datetime(2026, 7, 3))[0].count() == 0


def test_latest_score_wins_and_gaps(spark):
    scores = spark.createDataFrame(
        [("t", "a", 0.1, 1), ("t", "a", 0.9, 2), ("t", "b", None, 1), ("t", "", 1.0, 1)], "trace_id string, name string, value double, ts int"
    )
    assert G.trace_scores(scores).first().scores == {"a": 0.9}


def test_slices_equal_single_filters(traces):
    slices = [{"risk_tier": "high"}, {"risk_tier": "high", "business_unit": "mobile"}, {}]
    sliced = G.slice_traces(traces, slices)
    for conditions in slices:
        alone = traces
        for k, v in conditions.items():
            alone = alone.where(F.col("metadata")[k] == v)
        assert rows(sliced.where(F.col("slice") == G.slice_label(conditions)), "trace_id") == rows(alone, "trace_id")


def test_slice_table_equals_compiled_slices(spark, traces):
    slices = [{"risk_tier": "high"}, {"risk_tier": "high", "business_unit": "mobile"}, {"risk_tier": "none"}]
    table = spark.createDataFrame([(s,) for s in slices], "conditions map<string,string>")
    assert rows(G.slice_traces_by_table(traces, table), "trace_id", "slice") == rows(G.slice_traces(traces, slices), "trace_id", "slice")


def test_cube_totals_equal_slices(traces):
    cube = G.governance_cube(traces, ["risk_tier", "business_unit"])
    series = G.slice_metrics(traces, [{"risk_tier": "high"}], "TOTAL")
    high = dict(rows(series.where("slice = 'risk_tier=high'"), "name", "value"))
    rolled = dict(rows(cube.where("risk_tier = 'high' and business_unit is null"), "name", "value"))
    assert rolled == {k: pytest.approx(v) for k, v in high.items()}


def test_payload(spark, traces):
    projects = spark.createDataFrame([("1", "p"), ("2", "q"), ("3", "r")], "id string, name string")
    payload = governance_extract(traces, projects, AS_OF, [{"risk_tier": "high"}])
    row = payload.first()
    assert payload.count() == 1 and row.project == "p" and row.schema_version == "2.0"
    assert set(row.slices) == {"all", "risk_tier=high"}
    quality = next(m for m in row.slices["risk_tier=high"] if m.name == "response_quality")
    assert [p.value for p in quality.data] == [pytest.approx(0.375)]
    assert rows(G.active_projects(projects, traces), "id") == [("1",)]


def test_completeness(traces):
    assert rows(G.metadata_completeness(traces, ["risk_tier", "env"])) == [(5, "env", 5), (5, "risk_tier", 0)]
    assert G.metadata_gaps(traces, ["risk_tier"]).count() == 0
    gaps = {r.trace_id: r.missing for r in G.score_gaps(traces, ["regulatory_compliance", "response_quality"]).collect()}
    assert gaps["tax"] == ["regulatory_compliance"] and gaps["refund"] == ["response_quality"] and len(gaps) == 3
