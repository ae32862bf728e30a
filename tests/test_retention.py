from datetime import UTC, date, datetime, timedelta, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tracelake.functions.dates import yesterday
from tracelake.operators import retention as R
from tracelake.operators.filters import TraceFilter, exact_project, projects_containing, search_traces

NOON = datetime(2025, 3, 20, 12)
RULES = [
    {"tags": [], "older_than_days": 200},
    {"tags": ["audit", "legal"], "older_than_days": 120, "exclude_tags": ["hold"]},
    {"tags": ["debug"], "older_than_days": 2},
]
# trace -> (age in days, tags)
AGES = {
    1: (1, ["debug"]), 2: (3, ["debug"]), 3: (3, ["debug", "legal"]), 4: (119, ["audit"]), 5: (121, ["audit"]), 6: (121, ["audit", "legal"]),
    7: (150, ["legal", "hold"]), 8: (199, []), 9: (201, []), 10: (201, None), 11: (300, ["hold"]), 12: (300, ["audit"]), 13: (250, ["debug", "other"]), 14: (None, ["debug"]),
}
# trace -> rules, by hand: 0 debug, 1 audit, 2 legal, 3 the rest
MATCHED = {2: [0], 3: [0], 5: [1], 6: [1, 2], 9: [3], 10: [3], 11: [3], 12: [1], 13: [0]}


def ago(days):
    return NOON - timedelta(days=days)


@pytest.fixture(scope="module")
def traces(spark):
    data = [(i, "7", "shop" if i % 2 else "desk", "call", None if d is None else ago(d), None if d is None else ago(d), tags) for i, (d, tags) in AGES.items()]
    schema = "trace_id long, project_id string, project string, name string, start_time timestamp, end_time timestamp, tags array<string>"
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize(
    ("asked", "found"),
    [
        (TraceFilter(before=ago(201)), {9, 10, 11, 12, 13}), (TraceFilter(after=ago(3)), {1}), (TraceFilter(after=ago(121), before=ago(3)), {2, 3, 4}),
        (TraceFilter(tags=("audit", "legal")), {6}), (TraceFilter(tags=("legal",), exclude_tags=("hold", "debug")), {6}), (TraceFilter(exclude_tags=("debug", "audit", "hold")), {8, 9, 10}),
    ],
)
def test_filters(traces, asked, found):
    assert {r.trace_id for r in asked.apply(traces).collect()} == found


def test_empty_filter_is_refused(traces):
    with pytest.raises(ValueError):
        TraceFilter().apply(traces)


def test_merge_and_describe():
    merged = TraceFilter(before=ago(0), tags=("x",)).merge(TraceFilter(tags=("y", "z")))
    assert merged == TraceFilter(before=ago(0), tags=("y", "z"))
    assert merged.describe() == "before 2025-03-20 | tags: ['y', 'z']"
    assert TraceFilter().describe() == "(no filters)"


def test_matches_follow_the_rules(traces):
    expanded = R.expand_ttl_rules(RULES, NOON)
    assert [r.label for r in expanded] == ["tag='debug', >2d old", "tag='audit', >120d old", "tag='legal', >120d old", "no configured tags, >200d old"]
    assert rows(R.match_rules(traces, expanded), "trace_id", "rule_no") == sorted(((t, n) for t, ns in MATCHED.items() for n in ns), key=repr)
    kept, audit = R.delete_traces(traces, expanded)
    assert {r.trace_id for r in kept.collect()} == set(AGES) - set(MATCHED)
    assert rows(audit, "trace_id", "rule_no") == sorted(((t, ns[0]) for t, ns in MATCHED.items()), key=repr)
    assert R.delete_audit(traces, expanded, dry_run=True).count() == 10
    assert R.distinct_matches(R.match_rules(traces, expanded)).count() == len(MATCHED)


def test_counts_by_project(spark, traces):
    projects = spark.createDataFrame([("7", "shop"), ("8", "desk"), ("9", "idle")], "id string, name string")
    expanded = R.expand_ttl_rules(RULES, NOON)
    assert rows(R.retention_counts(traces, expanded, projects)) == sorted([("shop", 5, 5), ("desk", 5, 4), ("idle", 0, 0), (None, 10, 9)], key=repr)
    assert rows(R.retention_counts(traces, [], projects)) == sorted([("shop", 0, 0), ("desk", 0, 0), ("idle", 0, 0), (None, 0, 0)], key=repr)


def test_no_rules_delete_nothing(traces):
    kept, audit = R.delete_traces(traces, [])
    assert (kept.count(), audit.count()) == (len(AGES), 0)


@pytest.mark.parametrize("different_times", [1, 200])
def test_thousands_of_rules(traces, different_times):
    rules = [R.RetentionRule(i, f"r{i}", TraceFilter(before=ago(50 + i % different_times), tags=("audit" if i == 1700 else f"none{i}",))) for i in range(2000)]
    kept, audit = R.delete_traces(traces, rules)
    gone = {t for t, (d, tags) in AGES.items() if d is not None and "audit" in (tags or []) and d >= 50 + 1700 % different_times}
    assert {r.trace_id for r in kept.collect()} == set(AGES) - gone
    assert rows(audit, "trace_id", "rule_no", "label") == sorted(((t, 1700, "r1700") for t in gone), key=repr)


def test_rules_of_many_ages_are_one_lookup(traces):
    """However many ages: one comparison with the trace's time in the plan, not one for each."""
    rules = [R.RetentionRule(i, f"r{i}", TraceFilter(before=ago(1 + i), tags=(f"none{i}",))) for i in range(300)]
    for found in (R.matched_rules(traces, rules), R.matches_any(traces, rules)):
        plan = traces.select(found.alias("x"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("start_time") <= 2


def test_tags_of_any_text_are_looked_up(traces):
    odd = 'Größe "x"\\n\t}'
    tagged = traces.withColumn("tags", F.array(F.lit(odd), F.lit(None).cast("string"), F.lit(odd), F.lit("b")))
    rules = [R.RetentionRule(0, odd, TraceFilter(tags=(odd,))), R.RetentionRule(1, "b", TraceFilter(before=ago(10**4), tags=("b",))), R.RetentionRule(2, "c", TraceFilter(tags=("c",)))]
    found = R.match_rules(tagged, rules)
    assert {tuple(r) for r in found.select("rule_no", "label").collect()} == {(0, odd)} and found.count() == traces.count()
    assert R.kept_traces(tagged, rules).isEmpty()


def test_one_tag_in_several_rules(traces):
    rules = [R.RetentionRule(0, "a", TraceFilter(before=ago(1), tags=("debug",))), R.RetentionRule(1, "b", TraceFilter(before=ago(1), tags=("debug",))), R.RetentionRule(2, "c", TraceFilter(tags=("debug", "legal")))]
    assert rows(R.match_rules(traces, rules).where("trace_id = 3"), "rule_no") == [(0,), (1,), (2,)]


def test_aware_times_are_converted(traces):
    west = timezone(timedelta(hours=-8))
    late = (NOON - timedelta(days=3)).replace(tzinfo=UTC).astimezone(west)
    assert TraceFilter(before=late).apply(traces).count() == TraceFilter(before=ago(3)).apply(traces).count()
    assert TraceFilter(after=late).apply(traces).count() == 1
    assert yesterday(datetime(2025, 3, 20, 20, tzinfo=west))[0] == datetime(2025, 3, 20)


def test_catch_all_spares_only_earlier_tags():
    rules = [{"tags": [], "older_than_days": 5, "exclude_tags": ["x"]}, {"tags": ["y"], "older_than_days": 6}]
    assert R.expand_ttl_rules(rules, NOON)[0].filter.exclude_tags == ("x",)
    assert R.expand_ttl_rules(rules, NOON, protect_all_tags=True)[0].filter.exclude_tags == ("y", "x")


def test_filters_of_a_configuration():
    flat = {"older_than_days": 4, "after": "2025-01-02T03:04:05Z", "tags": ["a"], "exclude_tags": ["b"]}
    built = R.config_filter(flat, NOON)
    assert built == TraceFilter(ago(4), datetime(2025, 1, 2, 3, 4, 5), ("a",), ("b",))
    assert R.config_filter({"before": "2025-02-03"}, NOON, TraceFilter(tags=("c",))) == TraceFilter(datetime(2025, 2, 3), None, ("c",))
    with pytest.raises(ValueError):
        R.config_filter({}, NOON)
    both = R.config_rules({"ttl_rules": RULES, "filters": flat}, NOON, TraceFilter(exclude_tags=("k",)))
    assert len(both) == 4 and all(r.filter.exclude_tags == ("k",) for r in both)
    assert R.config_rules({"filters": flat}, NOON)[0].label == "before 2025-03-16 | after 2025-01-02 | tags: ['a'] | exclude tags: ['b']"


def test_batches_are_full_and_cover_all(traces):
    batches = R.batch_ids(traces.select("project", "trace_id"), size=3).groupBy("project", "batch").count()
    assert sorted(r["count"] for r in batches.collect()) == [1, 1, 3, 3, 3, 3]


def test_config_checks(spark, tmp_path):
    bad = {"projects": {}, "filters": {"after": "soon", "before": "2025-01-01", "older_than_days": 1.5}, "ttl_rules": [{"exclude_tags": "x", "older_than_days": True}, {"tags": []}]}
    found = R.validate_retention(bad)
    assert {f[1] for f in found if f[0] == "error"} == {"projects", "ttl_rules[0].older_than_days", "ttl_rules[0].exclude_tags", "ttl_rules[1].older_than_days", "filters.older_than_days", "filters", "filters.after"}
    assert [f[1] for f in found if f[0] == "warning"] == ["filters"]
    path = tmp_path / "rules.json"
    path.write_text('{"ttl_rules": [\n {"tags": ["q"], "older_than_days": 8}]}')
    assert R.load_retention_config(spark, str(path))["ttl_rules"][0]["tags"] == ["q"]
    path.write_text('{"ttl_rules": [{"older_than_days": "8"}]}')
    with pytest.raises(ValueError):
        R.load_retention_config(spark, str(path))


def test_projects(spark):
    projects = spark.createDataFrame([("1", "north"), ("2", "north-east")], "id string, name string")
    found, missing = R.resolve_projects(projects, ["north", "south"])
    assert rows(found, "id") == [("1",)]
    assert rows(missing) == [("south",)]
    assert R.resolve_projects(projects)[0].count() == 2
    assert exact_project(projects, "north").count() == 1
    assert projects_containing(projects, "north").count() == 2


def test_histogram_and_search(traces):
    found = dict(rows(R.tag_histogram(traces)))
    assert (found["debug"], found["audit, legal"], found["(untagged)"]) == (3, 1, 3)
    searched = search_traces(traces, "shop", [{"field": "start_time", "operator": ">", "value": ago(200)}, {"field": "tags", "operator": "not_contains", "value": "legal"}])
    assert {r.trace_id for r in searched.collect()} == {1, 5}
    with pytest.raises(ValueError):
        search_traces(traces, "shop", [{"field": "name", "operator": "~", "value": date(2025, 1, 1)}])


def test_time_bounds_reach_the_scan(spark, traces, tmp_path):
    traces.write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    assert "LessThanOrEqual(start_time" in R.match_rules(read, R.expand_ttl_rules(RULES, NOON))._jdf.queryExecution().executedPlan().toString()
    counted = TraceFilter(before=ago(30)).apply(read).agg(F.count("*"))
    assert "ReadSchema: struct<start_time:timestamp>" in counted._jdf.queryExecution().executedPlan().toString()
