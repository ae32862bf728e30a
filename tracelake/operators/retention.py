"""Trace retention: rule expansion, matching, counting and deletion.

Rules come from a configuration, so they are compiled into the plan: matching is one narrow projection over the traces,
without a join or shuffle, and the rows to keep are its complement. Rules that share their times and excluded tags are one
test against the list of their tags, so a plan has as many tests as there are different times, not rules. Rules of one tag
and an upper time bound, the usual ones, are looked up by the tags of a trace: its time does not grow with their number.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.distribution import shuffled_index
from tracelake.functions.dates import as_utc, cutoff, moment, parsed_date
from tracelake.operators.filters import TraceFilter, has_any_tag
from tracelake.session import small_frame

# Ids per delete batch, and the tag histogram's key for traces without tags.
DELETE_BATCH = 200
UNTAGGED = "(untagged)"

MATCH = T.StructType([T.StructField("rule_no", T.IntegerType()), T.StructField("label", T.StringType())])


@dataclass(frozen=True)
class RetentionRule:
    rule_no: int
    label: str
    filter: TraceFilter


# Findings of a configuration.
MUST_BE_LIST, MUST_BE_POSITIVE = "must be a list", "must be a positive integer"


def validate_retention(config: Mapping) -> list[tuple[str, str, str]]:
    """Findings ``(level, path, message)`` of a retention configuration."""
    rules, flat = list(enumerate(config.get("ttl_rules") or [])), config.get("filters") or {}
    days = [(f"ttl_rules[{n}].older_than_days", rule.get("older_than_days", KeyError)) for n, rule in rules]
    lists = [("projects", config.get("projects", [])), *((f"ttl_rules[{n}].{key}", rule.get(key, [])) for n, rule in rules for key in ("tags", "exclude_tags"))]
    errors = [(path, MUST_BE_LIST) for path, value in lists if not isinstance(value, list)]
    errors += [(path, "is missing" if value is KeyError else MUST_BE_POSITIVE) for path, value in days if not _positive_int(value)]
    if flat.get("older_than_days") is not None and not _positive_int(flat["older_than_days"]):
        errors.append(("filters.older_than_days", MUST_BE_POSITIVE))
    if flat.get("older_than_days") and flat.get("before"):
        errors.append(("filters", "older_than_days and before exclude each other"))
    errors += [(f"filters.{key}", "is no date") for key in ("before", "after") if flat.get(key) and parsed_date(flat[key]) is None]
    warnings = [("filters", "ttl_rules take precedence")] if flat and rules else []
    return [("error", *e) for e in errors] + [("warning", *w) for w in warnings]


def _positive_int(value: object) -> bool:
    return isinstance(value, int) and not isinstance(value, bool) and value > 0


def load_retention_config(spark: SparkSession, path: str) -> dict:
    """Configuration file as a dictionary; raises on the first error found in it."""
    text = spark.read.text(path, wholetext=True).first()
    config = json.loads(text["value"])
    errors = [f for f in validate_retention(config) if f[0] == "error"]
    if errors:
        raise ValueError(f"{errors[0][1]} {errors[0][2]}")
    return config


def config_filter(flat: Mapping, as_of: datetime, override: TraceFilter | None = None) -> TraceFilter:
    """Filter of a configuration's flat ``filters`` block; every part that ``override`` sets wins. Refuses an empty one."""
    before = cutoff(as_of, flat["older_than_days"]) if flat.get("older_than_days") else parsed_date(flat.get("before"))
    built = TraceFilter(before, parsed_date(flat.get("after")), tuple(flat.get("tags") or ()), tuple(flat.get("exclude_tags") or ()))
    built = built.merge(override) if override else built
    if built.is_empty():
        raise ValueError("a trace filter needs at least one condition")
    return built


def config_rules(config: Mapping, as_of: datetime, override: TraceFilter | None = None) -> list[RetentionRule]:
    """Rules of a whole configuration: its expanded ``ttl_rules``, else its flat filters as the only rule, with the
    override on top."""
    if config.get("ttl_rules"):
        expanded = expand_ttl_rules(config["ttl_rules"], as_of)
        return [replace(r, filter=r.filter.merge(override)) for r in expanded] if override else expanded
    flat = config_filter(config.get("filters") or {}, as_of, override)
    return [RetentionRule(0, flat.describe(), flat)]


def expand_ttl_rules(rules: Sequence[Mapping], as_of: datetime, protect_all_tags: bool = False) -> list[RetentionRule]:
    """One rule per tag, shortest retention first; a rule without tags spares the tags of the rules before it.

    A tag kept longer than the catch-all is therefore not spared, unless ``protect_all_tags`` is set.
    """
    by_days = sorted(rules, key=lambda rule: rule["older_than_days"])
    own = [tuple(rule.get("tags") or ()) for rule in by_days]
    earlier = list(accumulate(own, initial=()))
    spared = [earlier[-1]] * len(own) if protect_all_tags else earlier
    singles = [
        (rule, tag, tuple(rule.get("exclude_tags") or ()) if tag is not None else before + tuple(rule.get("exclude_tags") or ()))
        for rule, tags, before in zip(by_days, own, spared, strict=False)
        for tag in tags or (None,)
    ]
    return [
        RetentionRule(number, _label(rule, tag), TraceFilter(cutoff(as_of, rule["older_than_days"]), None, () if tag is None else (tag,), excluded))
        for number, (rule, tag, excluded) in enumerate(singles)
    ]


def _label(rule: Mapping, tag: str | None) -> str:
    """Fixed form of a rule's label; a rule without tags may describe itself."""
    age = f">{rule['older_than_days']}d old"
    return f"tag={tag!r}, {age}" if tag is not None else rule.get("description") or f"no configured tags, {age}"


def _shared_tests(expanded: Sequence[RetentionRule]) -> dict[TraceFilter, list[RetentionRule]]:
    """Rules by what they ask for besides a single tag."""
    shared: dict[TraceFilter, list[RetentionRule]] = {}
    for rule in expanded:
        rest = replace(rule.filter, tags=()) if len(rule.filter.tags) == 1 else rule.filter
        shared.setdefault(rest, []).append(rule)
    return shared


def _holds(traces: DataFrame, rest: TraceFilter) -> Column:
    return F.lit(True) if rest.is_empty() else F.coalesce(rest.to_column(traces), F.lit(False))


def _single_tag(rule: RetentionRule) -> str | None:
    return rule.filter.tags[0] if len(rule.filter.tags) == 1 else None


def _entries(rules: Sequence[RetentionRule]) -> Column:
    return F.array(*[F.struct(F.lit(r.rule_no).alias("rule_no"), F.lit(r.label).alias("label")) for r in rules]).cast(T.ArrayType(MATCH))


def _value_in(known: Column):
    return lambda key: F.element_at(known, key)


def _split_indexed(expanded: Sequence[RetentionRule]) -> tuple[list[RetentionRule], list[RetentionRule]]:
    """Rules that ask for one tag and at most an upper time bound, and the others."""
    plain = [len(r.filter.tags) == 1 and r.filter.after is None and not r.filter.exclude_tags for r in expanded]
    return [r for r, p in zip(expanded, plain) if p], [r for r, p in zip(expanded, plain) if not p]


def _due_by_tag(traces: DataFrame, indexed: Sequence[RetentionRule]) -> Callable[[Column], Column]:
    """For a tag, the rules that ask for it and whose time has come. They lie in as many places as there are rules, by the
    checksum of their tag. The places are one constant, given as one text: a plan is not built rule by rule."""
    kind = traces.schema["start_time"].dataType
    when = "timestamp_ntz" if isinstance(kind, T.TimestampNTZType) else "timestamp"
    count = 1 << (len(indexed) - 1).bit_length()
    places: list[list[dict]] = [[] for _ in range(count)]
    for r in indexed:
        before = None if r.filter.before is None else as_utc(r.filter.before).isoformat(sep=" ", timespec="microseconds")
        places[zlib.crc32(r.filter.tags[0].encode()) % count].append({"tag": r.filter.tags[0], "before": before, "rule_no": r.rule_no, "label": r.label})
    known = F.from_json(F.lit(json.dumps(places)), "array<array<struct<tag:string,before:string,rule_no:int,label:string>>>")

    def due(tag: Column) -> Column:
        here = F.get(known, (F.crc32(tag) % count).cast("int"))
        return F.filter(here, lambda e: (e["tag"] == tag) & (e["before"].isNull() | (F.col("start_time") <= e["before"].cast(when))))

    return due


def _own_tags() -> Column:
    return F.array_compact(F.array_distinct(F.coalesce("tags", F.array().cast("array<string>"))))


def matched_rules(traces: DataFrame, expanded: Sequence[RetentionRule]) -> Column:
    """Array of the rules a trace matches, in rule order, computed without any join."""
    none = F.array().cast(T.ArrayType(MATCH))
    indexed, others = _split_indexed(expanded)
    parts = []
    if indexed:
        met = F.flatten(F.transform(_own_tags(), _due_by_tag(traces, indexed)))
        parts.append(F.transform(met, lambda e: F.struct(e["rule_no"].alias("rule_no"), e["label"].alias("label"))))
    for rest, rules in _shared_tests(others).items():
        by_tag: dict[str, list[RetentionRule]] = {}
        for rule in rules:
            if _single_tag(rule) is not None:
                by_tag.setdefault(_single_tag(rule), []).append(rule)
        hits = _entries([r for r in rules if _single_tag(r) is None])
        if by_tag:
            known = F.map_from_arrays(F.array(*[F.lit(t) for t in by_tag]), F.array(*[_entries(r) for r in by_tag.values()]))
            met = F.array_intersect(F.coalesce("tags", F.array().cast("array<string>")), F.array(*[F.lit(t) for t in by_tag]))
            hits = F.concat(hits, F.flatten(F.transform(met, _value_in(known))))
        parts.append(F.when(_holds(traces, rest), hits).otherwise(none))
    return F.array_sort(F.flatten(F.array(*parts))) if parts else none


def matches_any(traces: DataFrame, expanded: Sequence[RetentionRule]) -> Column:
    """One test for all rules of a tag and a time, and one for each other time and exclusion, as a balanced tree: its depth
    grows with the logarithm of their number."""
    indexed, others = _split_indexed(expanded)
    tests = []
    if indexed:
        due = _due_by_tag(traces, indexed)
        tests.append(F.coalesce(F.exists(_own_tags(), lambda tag: F.size(due(tag)) > 0), F.lit(False)))
    for rest, rules in _shared_tests(others).items():
        tags = [_single_tag(r) for r in rules]
        tests.append(_holds(traces, rest) if None in tags else _holds(traces, rest) & has_any_tag(F.col("tags"), list(dict.fromkeys(tags))))
    while len(tests) > 1:
        tests = [reduce(Column.__or__, tests[i : i + 2]) for i in range(0, len(tests), 2)]
    return tests[0] if tests else F.lit(False)


def _candidates(traces: DataFrame, expanded: Sequence[RetentionRule]) -> DataFrame:
    """Traces old enough for some rule; the bound reaches the scan."""
    limits = [as_utc(r.filter.before) for r in expanded if r.filter.before is not None]
    if len(limits) < len(expanded) or not limits:
        return traces if expanded else traces.limit(0)
    return traces.where(F.col("start_time") <= moment(max(limits), traces.schema["start_time"].dataType))


def match_rules(traces: DataFrame, expanded: Sequence[RetentionRule]) -> DataFrame:
    """One row per (trace, matching rule), for any number of rules."""
    due = _candidates(traces, expanded)
    hits = due.withColumn("__hit", F.explode(matched_rules(due, expanded)))
    return hits.select(*traces.columns, "__hit.rule_no", "__hit.label")


def distinct_matches(matches: DataFrame) -> DataFrame:
    """The set of traces that any rule matched; a trace that several rules matched counts once."""
    return matches.select("project_id", "project", "trace_id").distinct()


def resolve_projects(projects: DataFrame, names: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Projects with the wanted names, and the names that no project has. No names means all projects."""
    if not names:
        return projects, projects.select("name").limit(0)
    wanted = small_frame(projects.sparkSession, [(n,) for n in names], "name string")
    return projects.join(wanted.distinct(), "name", "left_semi"), missing_names(wanted, projects)


def missing_names(wanted: DataFrame, projects: DataFrame) -> DataFrame:
    return wanted.select("name").join(projects, "name", "left_anti")


def retention_counts(traces: DataFrame, expanded: Sequence[RetentionRule], projects: DataFrame) -> DataFrame:
    """Matches per project and in total (project null): once per rule, and once per trace.

    Traces are counted before they meet the project list, so the join sees one row per project.
    """
    due = _candidates(traces, expanded)
    hits = F.size(matched_rules(due, expanded))
    per_project = due.withColumn("__hits", hits).groupBy(F.col("project").alias("name")).agg(
        F.sum("__hits").alias("matches"), F.count_if(F.col("__hits") > 0).alias("distinct_traces")
    )
    listed = projects.select("name").join(per_project, "name", "left")
    return listed.rollup("name").agg(
        F.coalesce(F.sum("matches"), F.lit(0)).alias("matches"),
        F.coalesce(F.sum("distinct_traces"), F.lit(0)).alias("distinct_traces"),
    )


def kept_traces(traces: DataFrame, expanded: Sequence[RetentionRule]) -> DataFrame:
    """What is left after deletion: a filter, since the rules are part of the plan."""
    return traces.where(~matches_any(traces, expanded))


def batch_ids(ids: DataFrame, id_col: str = "trace_id", group: Sequence[str] = ("project",), size: int = DELETE_BATCH) -> DataFrame:
    """Number ids in batches of ``size`` per group, without gathering a group in one task."""
    indexed = shuffled_index(ids, id_col, "batch", "__index", group)
    return indexed.withColumn("batch", F.floor(F.col("__index") / size) + 1).drop("__index")


def delete_audit(traces: DataFrame, expanded: Sequence[RetentionRule], dry_run: bool = False, size: int = DELETE_BATCH) -> DataFrame:
    """Batched list of what is deleted. A real run removes a trace with its first rule; a dry run lists it under each."""
    if dry_run:
        matches = match_rules(traces, expanded).select("project", "trace_id", "rule_no", "label")
    else:
        due = _candidates(traces, expanded)
        first = due.select("project", "trace_id", F.get(matched_rules(due, expanded), F.lit(0)).alias("__hit")).where(F.col("__hit").isNotNull())
        matches = first.select("project", "trace_id", "__hit.rule_no", "__hit.label")
    return batch_ids(matches, group=["project", "rule_no"], size=size)


def delete_summary(audit: DataFrame) -> DataFrame:
    """Deleted traces and batches by project and rule, with subtotals."""
    counted = audit.groupBy("project", "label").agg(F.count("*").alias("n"), F.max("batch").alias("b"))
    return counted.rollup("project", "label").agg(F.sum("n").alias("traces"), F.sum("b").alias("batches"))


def delete_traces(
    traces: DataFrame, expanded: Sequence[RetentionRule], dry_run: bool = False, size: int = DELETE_BATCH
) -> tuple[DataFrame, DataFrame]:
    """Rows to keep and the audit. The caller writes the kept rows to a new path; a dry run keeps everything."""
    kept = traces if dry_run else kept_traces(traces, expanded)
    return kept, delete_audit(traces, expanded, dry_run, size)


def tag_histogram(traces: DataFrame) -> DataFrame:
    joined = F.array_join("tags", ", ")
    key = F.when(F.coalesce(F.size("tags"), F.lit(0)) > 0, joined).otherwise(UNTAGGED)
    return traces.groupBy(key.alias("tag_key")).agg(F.count("*").alias("traces"))
