from datetime import date, datetime

import pytest
from conftest import rows

from tracelake.operators import usage as U
from tracelake.plans.usage_report import run_usage_report

DAILY = "workspace string, project_id string, project string, metric string, series string, date date, value double"


@pytest.fixture
def daily(spark):
    return spark.createDataFrame(
        [
            ("w", "4", "orchid", "COST", "", date(2025, 11, 3), 2.5),
            ("w", "4", "orchid", "TOKEN_USAGE", "small", date(2025, 11, 8), 1500.0),
            ("w", "4", "orchid", "TRACE_COUNT", "", date(2025, 11, 3), 8.0),
            ("w", "4", "orchid", "THREAD_COUNT", "", date(2025, 11, 8), 3.0),
            ("w", "4", "orchid", "SPAN_COUNT", "", date(2025, 11, 4), 30.0),
        ],
        DAILY,
    )


@pytest.fixture
def summary(spark):
    values = {"TRACE_COUNT": 8.0, "THREAD_COUNT": 3.0, "TOKENS_TOTAL": 1500.0, "TOTAL_COST": 20500.0, "GUARDRAILS_FAILED_COUNT": 1.0}
    return spark.createDataFrame([("orchid", m, v) for m, v in values.items()], "project string, metric string, value double")


def test_monthly_rollup(daily):
    monthly = U.rollup_monthly(daily)
    assert monthly.count() == 5
    assert {r.date for r in monthly.collect()} == {date(2025, 11, 30)}


def test_projects_of_one_name_merge_and_null_keys_drop(spark, daily):
    more = spark.createDataFrame(
        [("w", "2", "orchid", "TRACE_COUNT", "", date(2025, 11, 9), 1.0), ("w", "2", "beta", "COST", None, date(2025, 11, 9), 1.0)], DAILY
    )
    monthly = U.rollup_monthly(daily.union(more))
    assert ("orchid", "TRACE_COUNT", 9.0) in rows(monthly, "project", "metric", "value")
    assert "beta" not in {r.project for r in monthly.collect()}
    assert ("beta", "—", 1.0, "$1.0000") in rows(U.magnitude(daily.union(more), "COST"))


def test_pivot_is_one_row(daily):
    assert rows(U.pivot_totals(daily)) == [("orchid", 8.0, 3.0, 30.0, 1500.0, 2.5)]


def test_report_tables(daily, summary):
    tables = U.usage_report(daily, summary)
    assert rows(tables["snapshot"]) == [("orchid", "8", "3", "1,500", "$20,500.00", "1")]
    assert rows(tables["magnitude_token_usage"]) == [("orchid", "small", 1500.0, "1,500")]
    assert rows(tables["magnitude_cost"]) == [("orchid", "—", 2.5, "$2.5000")]
    assert rows(tables["daily_trace_count"], "label", "value") == [("Nov 03", 8.0)]


def test_empty_frames_pass_through(daily, summary):
    tables = U.usage_report(daily.limit(0), summary.limit(0))
    assert all(t.isEmpty() for t in tables.values())


def test_gap_days_are_not_filled(spark):
    frame = spark.createDataFrame(
        [("w", "1", "a", "TRACE_COUNT", "", date(2026, 7, d), float(d)) for d in (1, 4, 9)], DAILY
    )
    assert rows(U.cumulative(frame, ["TRACE_COUNT"]), "date", "cumulative") == [
        (date(2026, 7, 1), 1.0), (date(2026, 7, 4), 5.0), (date(2026, 7, 9), 14.0),
    ]


def _traces(spark):
    day = datetime(2026, 7, 1, 10)
    rows_ = [
        ("t1", "1", "alpha", day, {"prompt_tokens": 10, "total_tokens": 12}, 0.5, False, "th1"),
        ("t2", "1", "alpha", day, {"prompt_tokens": 5}, None, True, "th1"),
        ("t3", "1", "alpha", datetime(2026, 7, 2), None, 0.25, None, None),
        ("t4", None, None, day, None, 9.0, False, "th9"),
    ]
    return spark.createDataFrame(
        rows_, "trace_id string, project_id string, project string, start_time timestamp, usage map<string,bigint>, cost double, guardrail_failed boolean, thread_id string"
    )


def test_daily_metrics_and_snapshot(spark):
    traces = _traces(spark)
    daily = U.daily_metrics(traces, traces.select("project_id", "project", "start_time"))
    day1, day2 = date(2026, 7, 1), date(2026, 7, 2)
    assert rows(daily, "metric", "series", "date", "value") == sorted(
        [
            ("TRACE_COUNT", "", day1, 2.0), ("TRACE_COUNT", "", day2, 1.0), ("THREAD_COUNT", "", day1, 1.0), ("THREAD_COUNT", "", day2, 0.0),
            ("SPAN_COUNT", "", day1, 2.0), ("SPAN_COUNT", "", day2, 1.0), ("COST", "", day1, 0.5), ("COST", "", day2, 0.25),
            ("TOKEN_USAGE", "prompt_tokens", day1, 15.0), ("TOKEN_USAGE", "total_tokens", day1, 12.0),
        ],
        key=repr,
    )
    snap = dict(rows(U.snapshot(traces.where("project is not null")), "metric", "value"))
    assert snap == {"TRACE_COUNT": 3.0, "THREAD_COUNT": 1.0, "TOKENS_TOTAL": 27.0, "TOTAL_COST": 0.75, "GUARDRAILS_FAILED_COUNT": 1.0}


def test_window_ends_at_a_time_of_day(spark):
    traces = _traces(spark)
    for start, end in ((datetime(2026, 7, 1, 10), datetime(2026, 7, 1, 23)), (date(2026, 7, 1), date(2026, 7, 1))):
        counted = U.daily_metrics(traces, metrics=["TRACE_COUNT"], start=start, end=end)
        assert rows(counted, "date", "value") == [(date(2026, 7, 1), 2.0)]


def test_report_files(spark, tmp_path):
    traces = _traces(spark).where("project is not null")
    run_usage_report(traces, traces.select("project_id", "project", "start_time"), "w", date(2026, 7, 3), str(tmp_path))
    written = spark.read.option("header", True).csv(str(tmp_path / "stats_daily"))
    assert written.columns == U.DAILY_COLUMNS and written.count() == 10


def test_names_and_usage_keys(spark):
    projects = spark.createDataFrame([("1", "alpha")], "id string, name string")
    df = spark.createDataFrame([("1", {"a": 1, "b": 2}), ("9", None)], "project_id string, usage map<string,bigint>")
    named = U.with_project_name(df, projects)
    assert rows(named, "project_id", "project") == [("1", "alpha"), ("9", "unknown")]
    assert rows(df.select("project_id", U.sum_usage(df.usage), U.sum_usage(df.usage, ["a"]))) == [("1", 3.0, 1.0), ("9", 0.0, 0.0)]


def test_exact_and_approximate_durations(spark):
    values = [float(v) for v in (1, 2, 2, 3, 10, 40)]
    df = spark.createDataFrame([("p", datetime(2026, 7, 1, i), v) for i, v in enumerate(values)], "project string, start_time timestamp, duration_ms double")
    assert rows(U.duration_series(df, "DAILY"), "p50", "p90", "p99") == [(2.5, 25.0, pytest.approx(38.5))]
    assert U.duration_series(df, "TOTAL", exact=False).count() == 1
