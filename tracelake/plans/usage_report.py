"""Usage report of one workspace: frames, CSV files and report tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame

from tracelake.operators.usage import daily_metrics, rollup_monthly, snapshot, usage_report
from tracelake.session import materialise
from tracelake.sources.writers import write_stats

# Fixed value: days the series go back.
WINDOW_DAYS = 30


def run_usage_report(traces: DataFrame, spans: DataFrame, workspace: str, end: date | datetime, folder: str | None = None) -> dict[str, DataFrame]:
    """All tables of the report. Traces and spans are read once: the daily frame and the summary, which are tiny beside them,
    are written and every file and table is made of these."""
    daily = materialise(daily_metrics(traces, spans, start=end - timedelta(days=WINDOW_DAYS), end=end, workspace=workspace), "usage-daily")
    summary = materialise(snapshot(traces), "usage-summary")
    if folder is not None:
        write_stats(daily, rollup_monthly(daily), summary, folder)
    return usage_report(daily, summary)
