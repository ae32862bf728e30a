"""The two chained jobs of a day, as functions of the date. When they run is left to the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.operators.filters import has_tag, traces_of_lookback, traces_of_yesterday
from tracelake.operators.governance import (
    GOVERNANCE_TAG,
    active_projects,
    batch_counters,
    derived_score_rows,
    governance_payload,
    slice_metrics,
)


def retrospective_scores(traces: DataFrame, as_of: datetime, tag: str = GOVERNANCE_TAG) -> tuple[DataFrame, DataFrame]:
    """First job: derived score rows of yesterday's governed traces, and the counters."""
    governed = traces_of_yesterday(traces, as_of).where(has_tag(F.col("tags"), tag))
    return derived_score_rows(governed), batch_counters(governed)


def governance_extract(
    traces: DataFrame,
    projects: DataFrame,
    as_of: datetime,
    slices: Sequence[Mapping[str, str]] = (),
    interval: str = "DAILY",
    days: int = 30,
    tag: str = GOVERNANCE_TAG,
) -> DataFrame:
    """Second job: payload of every project that has governed traces in the look-back window."""
    recent = traces_of_lookback(traces, as_of, days)
    active = active_projects(projects, recent, tag).select(F.col("name").alias("project"))
    series = slice_metrics(recent, slices, interval, tag)
    return governance_payload(series.join(active, "project", "left_semi"), as_of, tag)
