"""Composable trace filters and structured predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions.dates import lookback, moment, yesterday


def has_tag(tags: Column, tag: str) -> Column:
    return F.coalesce(F.array_contains(tags, tag), F.lit(False))


def has_any_tag(tags: Column, wanted: Sequence[str]) -> Column:
    return F.coalesce(F.arrays_overlap(tags, F.array(*[F.lit(t) for t in wanted])), F.lit(False))


@dataclass(frozen=True)
class TraceFilter:
    """Time bounds and tags that all must hold. The upper bound is inclusive, the lower one strict."""

    before: datetime | None = None
    after: datetime | None = None
    tags: tuple[str, ...] = ()
    exclude_tags: tuple[str, ...] = ()

    def is_empty(self) -> bool:
        return not any(getattr(self, f.name) for f in fields(self))

    def merge(self, other: TraceFilter) -> TraceFilter:
        """Every part that ``other`` sets wins over the same part here."""
        return replace(self, **{f.name: getattr(other, f.name) for f in fields(other) if getattr(other, f.name)})

    def to_column(self, df: DataFrame) -> Column:
        if self.is_empty():
            raise ValueError("a trace filter needs at least one condition")
        kind = df.schema["start_time"].dataType
        parts = []
        if self.before is not None:
            parts.append(F.col("start_time") <= moment(self.before, kind))
        if self.after is not None:
            parts.append(F.col("start_time") > moment(self.after, kind))
        parts += [has_tag(F.col("tags"), tag) for tag in self.tags]
        if self.exclude_tags:
            parts.append(~has_any_tag(F.col("tags"), self.exclude_tags))
        return reduce(Column.__and__, parts)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.where(self.to_column(df))

    def describe(self) -> str:
        days = {"before": self.before, "after": self.after}
        lists = {"tags:": self.tags, "exclude tags:": self.exclude_tags}
        shown = {k: v.date() for k, v in days.items() if v} | {k: list(v) for k, v in lists.items() if v}
        return " | ".join(f"{label} {value}" for label, value in shown.items()) or "(no filters)"


def predicate(df: DataFrame, field: str, operator: str, value: object, key: str | None = None) -> Column:
    """One structured condition; ``key`` reaches into a map column. A missing value never matches, except for a negation."""
    column = F.col(field)[key] if key is not None else F.col(field)
    kind = df.schema[field].dataType
    if isinstance(value, datetime):
        value = moment(value, kind)
    if operator in ("contains", "not_contains"):
        test = F.array_contains(column, value) if kind.typeName() == "array" else column.contains(value)
        test = F.coalesce(test, F.lit(False))
        return test if operator == "contains" else ~test
    if operator == "=":
        return column == value
    if operator == ">":
        return column > value
    if operator == "<":
        return column < value
    raise ValueError(f"unknown filter operator: {operator}")


def apply_filters(df: DataFrame, filters: Sequence[Mapping[str, object]]) -> DataFrame:
    """Keep rows for which all ``{field, operator, value[, key]}`` conditions hold."""
    for condition in filters:
        df = df.where(predicate(df, condition["field"], condition["operator"], condition["value"], condition.get("key")))
    return df


def search_traces(traces: DataFrame, project: str | None = None, filters: Sequence[Mapping[str, object]] = ()) -> DataFrame:
    found = traces if project is None else traces.where(F.col("project") == project)
    return apply_filters(found, filters)


def traces_between(traces: DataFrame, project_id: object, tag: str, start: datetime, end: datetime) -> DataFrame:
    """Tagged traces of one project, both ends of the time range included."""
    kind = traces.schema["start_time"].dataType
    return traces.where(
        (F.col("project_id") == project_id)
        & F.col("start_time").between(moment(start, kind), moment(end, kind))
        & has_tag(F.col("tags"), tag)
    )


def traces_of_yesterday(traces: DataFrame, as_of: datetime) -> DataFrame:
    return _between(traces, *yesterday(as_of))


def traces_of_lookback(traces: DataFrame, as_of: datetime, days: int) -> DataFrame:
    return _between(traces, *lookback(as_of, days))


def _between(traces: DataFrame, start: datetime, end: datetime) -> DataFrame:
    kind = traces.schema["start_time"].dataType
    return traces.where(F.col("start_time").between(moment(start, kind), moment(end, kind)))


def metadata_filter(conditions: Mapping[str, str]) -> Column:
    """All ``key = value`` pairs hold; no pairs means every row."""
    tests = [F.coalesce(F.col("metadata")[k] == v, F.lit(False)) for k, v in conditions.items()]
    return reduce(Column.__and__, tests, F.lit(True))


def score_below(name: str, limit: float) -> Column:
    """A trace without the score is not selected."""
    return F.coalesce(F.col("scores")[name] < limit, F.lit(False))


def exact_project(projects: DataFrame, name: str) -> DataFrame:
    return projects.where(F.col("name") == name)


def projects_containing(projects: DataFrame, text: str) -> DataFrame:
    return projects.where(F.col("name").contains(text))


def clean_scores(scores: DataFrame) -> DataFrame:
    return scores.where((F.col("name") != "") & F.col("value").isNotNull())


def sort_casefold(df: DataFrame, column: str) -> DataFrame:
    return df.orderBy(F.lower(column))
