"""Retention and filter queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.catalog.bindings import AS_OF, TTL_RULES, Tables
from tracelake.catalog.registry import query
from tracelake.functions.dates import cutoff
from tracelake.operators import filters, retention
from tracelake.operators.filters import TraceFilter
from tracelake.session import materialise, scratch_path
from tracelake.sources import writers

EXPANDED = retention.expand_ttl_rules(TTL_RULES, AS_OF)

MATCHED = ("traces", "ttl", "matches")


@query(
    "filter_tags_all",
    "SELECT trace_id, project FROM traces WHERE list_contains(tags, 'beta') AND list_contains(tags, 'load-test')",
    ("traces",),
)
def filter_tags_all(t: Tables) -> DataFrame:
    return TraceFilter(tags=("beta", "load-test")).apply(t.traces).select("trace_id", "project")


@query(
    "filter_exclude_any",
    "SELECT trace_id, project FROM traces WHERE list_contains(tags, 'replay') AND NOT list_has_any(tags, ['beta', 'load-test'])",
    ("traces",),
)
def filter_exclude_any(t: Tables) -> DataFrame:
    return TraceFilter(tags=("replay",), exclude_tags=("beta", "load-test")).apply(t.traces).select("trace_id", "project")


@query(
    "filter_window",
    "SELECT trace_id, start_time FROM traces WHERE start_time > TIMESTAMP '2024-01-05' AND start_time <= TIMESTAMP '2024-01-20 12:00:00'",
    ("traces",),
)
def filter_window(t: Tables) -> DataFrame:
    window = TraceFilter(before=datetime(2024, 1, 20, 12), after=datetime(2024, 1, 5))
    return window.apply(t.traces).select("trace_id", "start_time")


@query(
    "filter_count",
    "SELECT count(*) AS total FROM traces WHERE start_time <= TIMESTAMP '2024-01-20 12:00:00'",
    ("traces",),
)
def filter_count(t: Tables) -> DataFrame:
    from tracelake.sources.readers import count_traces

    return count_traces(t.traces, TraceFilter(before=datetime(2024, 1, 20, 12)))


@query(
    "structured_filters",
    """SELECT trace_id, name FROM traces WHERE env = 'prod' AND list_contains(tags, 'governance') AND NOT list_contains(tags, 'load-test')
      AND duration_ms > 20 AND q < 0.9""",
    ("traces",),
)
def structured_filters(t: Tables) -> DataFrame:
    conditions = [
        {"field": "metadata", "key": "env", "operator": "=", "value": "prod"},
        {"field": "tags", "operator": "contains", "value": "governance"},
        {"field": "tags", "operator": "not_contains", "value": "load-test"},
        {"field": "duration_ms", "operator": ">", "value": 20},
        {"field": "scores", "key": "response_quality", "operator": "<", "value": 0.9},
    ]
    return filters.apply_filters(t.traces, conditions).select("trace_id", "name")


@query(
    "yesterday_traces",
    """SELECT trace_id, start_time FROM traces WHERE start_time >= TIMESTAMP '2024-01-30' AND start_time < TIMESTAMP '2024-01-31'
      AND project_id = 3 AND list_contains(tags, 'governance')""",
    ("traces",),
)
def yesterday_traces(t: Tables) -> DataFrame:
    from tracelake.functions.dates import yesterday

    return filters.traces_between(t.traces, 3, "governance", *yesterday(AS_OF)).select("trace_id", "start_time")


@query("ttl_matches", "SELECT trace_id, rule_no, label FROM matches", MATCHED)
def ttl_matches(t: Tables) -> DataFrame:
    return retention.match_rules(t.traces, EXPANDED).select("trace_id", "rule_no", "label")


@query(
    "ttl_counts",
    """SELECT p.name AS name, coalesce(sum(m.n), 0)::BIGINT AS matches, coalesce(sum(m.d), 0)::BIGINT AS distinct_traces FROM projects p
      LEFT JOIN (SELECT project, count(*) AS n, count(DISTINCT trace_id) AS d FROM matches GROUP BY 1) m ON p.name = m.project
      GROUP BY ROLLUP (p.name)""",
    (*MATCHED, "projects"),
)
def ttl_counts(t: Tables) -> DataFrame:
    return retention.retention_counts(t.traces, EXPANDED, t.projects)


MANY_RULES = """WITH rules AS (SELECT rule_no, 'd' || rule_no AS tag, TIMESTAMP '2024-01-31' - to_days((1 + rule_no % 40)::INTEGER) AS cutoff FROM range(1500) t(rule_no)),
    due AS (SELECT t.trace_id, min(r.rule_no) AS first_rule, count(r.rule_no) AS n FROM traces t LEFT JOIN rules r ON r.tag = 'd' || (t.trace_id % 2000) AND t.start_time <= r.cutoff GROUP BY 1)"""


@query("ttl_many_rules", f"{MANY_RULES} SELECT trace_id, n AS rules, n = 0 AS kept FROM due", ("traces",))
def ttl_many_rules(t: Tables) -> DataFrame:
    """1,500 rules of 40 different ages: how many each trace matches, and whether deletion keeps it."""
    rules = [retention.RetentionRule(n, f"d{n}", TraceFilter(before=cutoff(AS_OF, 1 + n % 40), tags=(f"d{n}",))) for n in range(1500)]
    traces = t.traces.withColumn("tags", F.array(F.concat(F.lit("d"), F.col("trace_id") % 2000)))
    hits = F.size(retention.matched_rules(traces, rules)).cast("long")
    return traces.select("trace_id", hits.alias("rules"), (~retention.matches_any(traces, rules)).alias("kept"))


@query(
    "delete_by_partition",
    """SELECT t.project, strftime(t.start_time, '%Y-%m-%d') AS date, count(*) - count(DISTINCT m.trace_id) AS kept, count(DISTINCT m.trace_id) > 0 AS rewritten
      FROM traces t LEFT JOIN (SELECT DISTINCT trace_id FROM matches) m ON t.trace_id = m.trace_id GROUP BY ALL HAVING count(*) > count(DISTINCT m.trace_id)""",
    MATCHED,
)
def delete_by_partition(t: Tables) -> DataFrame:
    """A trace table in folders after deletion: what each folder keeps, and whether its files are new."""
    base = scratch_path(t.spark, "delete")
    writers.ingest_traces(t.traces, f"{base}/traces")

    def stored() -> DataFrame:
        return t.spark.read.parquet(f"{base}/traces").withColumn("file", F.col("_metadata.file_name"))

    before = materialise(stored().select("file").distinct(), "files")
    schema = t.spark.read.parquet(f"{base}/traces").schema
    for _ in range(2):  # the second call finds everything done
        writers.delete_by_partition(t.spark, f"{base}/traces", schema, EXPANDED, f"{base}/work")
    flagged = stored().join(before.withColumn("old", F.lit(True)), "file", "left")
    counted = flagged.groupBy("project", F.date_format("date", "yyyy-MM-dd").alias("date"))
    return counted.agg(F.count("*").alias("kept"), F.bool_or(F.col("old").isNull()).alias("rewritten"))


@query("delete_dry_run", """SELECT project, trace_id, rule_no, label,
      (row_number() OVER (PARTITION BY project, rule_no ORDER BY md5('batch:' || trace_id), trace_id) - 1) // 200 + 1 AS batch FROM matches""", MATCHED)
def delete_dry_run(t: Tables) -> DataFrame:
    return retention.delete_audit(t.traces, EXPANDED, dry_run=True)


@query(
    "config_filter",
    "SELECT trace_id FROM traces WHERE start_time <= TIMESTAMP '2024-01-24' AND start_time > TIMESTAMP '2024-01-05' AND list_contains(tags, 'replay') AND NOT list_contains(tags, 'load-test')",
    ("traces",),
)
def config_filter(t: Tables) -> DataFrame:
    """The flat filters of a configuration, with the excluded tag given beside it."""
    flat = {"older_than_days": 7, "after": "2024-01-05", "tags": ["replay"], "exclude_tags": ["beta"]}
    [rule] = retention.config_rules({"filters": flat}, AS_OF, TraceFilter(exclude_tags=("load-test",)))
    return rule.filter.apply(t.traces).select("trace_id")


@query("ttl_distinct", "SELECT DISTINCT project_id, project, trace_id FROM matches", MATCHED)
def ttl_distinct(t: Tables) -> DataFrame:
    return retention.distinct_matches(retention.match_rules(t.traces, EXPANDED))


@query("ttl_kept", "SELECT trace_id, project FROM traces WHERE trace_id NOT IN (SELECT trace_id FROM matches)", MATCHED)
def ttl_kept(t: Tables) -> DataFrame:
    return retention.kept_traces(t.traces, EXPANDED).select("trace_id", "project")


AUDIT = """
    audit AS (SELECT *, (row_number() OVER (PARTITION BY project, rule_no ORDER BY md5('batch:' || trace_id), trace_id) - 1) // 200 + 1 AS batch
      FROM (SELECT m.project, m.trace_id, m.rule_no, m.label FROM matches m
        WHERE m.rule_no = (SELECT min(x.rule_no) FROM matches x WHERE x.trace_id = m.trace_id)))"""


@query("delete_audit", f"WITH {AUDIT} SELECT project, trace_id, rule_no, label, batch FROM audit", MATCHED)
def delete_audit(t: Tables) -> DataFrame:
    return retention.delete_audit(t.traces, EXPANDED)


@query(
    "delete_summary",
    f"""WITH {AUDIT} SELECT project, label, sum(n)::BIGINT AS traces, sum(b)::BIGINT AS batches FROM (
      SELECT project, label, count(*) AS n, max(batch) AS b FROM audit GROUP BY 1, 2) GROUP BY ROLLUP (project, label)""",
    MATCHED,
)
def delete_summary(t: Tables) -> DataFrame:
    return retention.delete_summary(retention.delete_audit(t.traces, EXPANDED))


@query(
    "tag_histogram",
    "SELECT coalesce(nullif(array_to_string(tags, ', '), ''), '(untagged)') AS tag_key, count(*) AS traces FROM traces GROUP BY 1",
    ("traces",),
)
def tag_histogram(t: Tables) -> DataFrame:
    return retention.tag_histogram(t.traces)


@query(
    "resolve_missing",
    "SELECT DISTINCT 'proj' || (s_nationkey + 3) AS name FROM supplier WHERE 'proj' || (s_nationkey + 3) NOT IN (SELECT name FROM projects)",
    ("projects",),
)
def resolve_missing(t: Tables) -> DataFrame:
    wanted = t.table("supplier").select(F.concat(F.lit("proj"), F.col("s_nationkey") + 3).alias("name")).distinct()
    return retention.missing_names(wanted, t.projects)


@query(
    "resolve_found",
    "SELECT DISTINCT p.id, p.name FROM projects p JOIN supplier ON p.name = 'proj' || (s_nationkey + 3)",
    ("projects",),
)
def resolve_found(t: Tables) -> DataFrame:
    wanted = t.table("supplier").select(F.concat(F.lit("proj"), F.col("s_nationkey") + 3).alias("name")).distinct()
    return t.projects.join(wanted, "name", "left_semi")
