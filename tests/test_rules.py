from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tracelake import schemas
from tracelake.catalog.rules import METRICS
from tracelake.functions import documents as J
from tracelake.functions.text import render_braces, render_mustache
from tracelake.operators import rules as R
from tracelake.operators.metrics import MetricSpec
from tracelake.operators.threads import SESSION_COLUMNS, combine_parts, sessions_by, thread_parts, thread_sessions
from tracelake.streaming import arrivals as A


def rule(rule_id, kind, rate=1.0, projects=("1",), **fields):
    judge = kind.endswith("judge")
    row = {
        "rule_id": rule_id, "name": rule_id, "type": kind, "project_ids": list(projects), "sampling_rate": rate, "enabled": True, "model": "m",
        "messages": [("USER", "Q {{input}} A {{output}} {{unknown}}")] if judge else None,
        "schema": [("relevance_score", "INTEGER", ""), ("is_grounded", "BOOLEAN", "")] if judge else None,
        "variables": {"input": "input.question", "output": "output.output"} if judge and "thread" not in kind else None,
        "metric": None if judge else "equals_metric",
        "arguments": None if judge else {"output": "output.output", "reference": "input.expected"},
    } | fields
    return tuple(row[f] for f in schemas.RULE.names)


@pytest.fixture(scope="module")
def rules(spark):
    kinds = list(R.RULE_LEVELS)
    return spark.createDataFrame([rule(k, k) for k in kinds] + [rule("off", kinds[1], enabled=False)], schemas.RULE)


@pytest.fixture(scope="module")
def items(spark):
    start = datetime(2026, 7, 1)
    data = [
        (f"t{i}", f"s{i}", "1" if i % 2 else "2", "p", start + timedelta(minutes=i), '{"question":"q{{output}}","expected":"a0"}', f'{{"output":"a{i % 3}"}}', f"th{i % 2}", 1.0)
        for i in range(12)
    ]
    return spark.createDataFrame(
        data, "trace_id string, span_id string, project_id string, project string, start_time timestamp, input string, output string, thread_id string, cost double"
    )


@pytest.fixture
def answers():
    return lambda prompts: prompts.map(lambda p: '{"relevance_score": 4, "is_grounded": true}' if "a0" in p else "no json")


def test_only_valid_rules_pass(spark, rules):
    assert R.rule_errors(rules).count() == 0
    judge, metric, thread = list(R.RULE_LEVELS)[:3]
    bad = [
        rule("b1", judge, rate=1.5), rule("b2", "other"), rule("b3", judge, schema=[("x", "STRING", "")]), rule("b4", thread, variables={"a": "b"}),
        rule("b5", metric, metric=None), rule("b6", judge, messages=[("ROBOT", "x")]), rule("b7", judge, messages=[]), rule("b8", judge, projects=()),
        rule("b9", judge, rate=None),
    ]
    found = R.rule_errors(spark.createDataFrame(bad, schemas.RULE))
    assert sorted(r.rule_id for r in found.collect()) == [f"b{i}" for i in range(1, 10)]


def test_routing_by_project_level_and_state(rules, items):
    routed = R.route_rules(items, rules)
    assert {(r.trace_id, r.rule.type) for r in routed.collect()} == {(f"t{i}", k) for i in range(1, 12, 2) for k, v in R.RULE_LEVELS.items() if v == "trace"}
    assert R.route_rules(items, rules, "span", "span_id").count() == 12


def test_sampling_is_stable_and_monotone(items):
    kept = [{r.trace_id for r in R.sample_by_rule(items, rate, "r").collect()} for rate in (0.0, 0.3, 0.7, 1.0)]
    assert kept[0] == set() and len(kept[3]) == 12
    assert kept[0] <= kept[1] <= kept[2] <= kept[3]
    assert kept[1] == {r.trace_id for r in R.sample_by_rule(items.repartition(3), 0.3, "r").collect()}


def test_scores_of_metrics_and_judges(rules, items, answers):
    scored = R.score_batch(items, rules, METRICS, answers)
    found = {(r.trace_id, r.name): (r.value, r.failed) for r in scored.collect()}
    assert found[("t3", "equals_metric")] == (1.0, False) and found[("t1", "equals_metric")] == (0.0, False)
    assert found[("t3", "relevance_score")] == (4.0, False) and found[("t3", "is_grounded")] == (1.0, False)
    assert found[("t1", "relevance_score")] == (None, True)
    assert len(found) == 18
    spans = R.score_spans(items, rules, METRICS, answers)
    assert spans.count() == 18 and "span_id" in spans.columns


def test_stream_equals_batch(spark, rules, items, answers, tmp_path):
    for i in range(3):
        items.where(F.expr(f"int(substr(trace_id, 2)) % 3 = {i}")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = A.stream_traces(spark, str(tmp_path / "in"), items.schema)
    assert rows(A.run_available(A.score_stream(stream, rules, METRICS, answers), "s")) == rows(R.score_batch(items, rules, METRICS, answers))


def test_prompt_is_rendered_once(rules, items):
    routed = R.route_rules(items.where("trace_id = 't3'"), rules.where("rule_id = 'llm_as_judge'"))
    prompt = R.rule_prompts(routed, {"input": F.col("input"), "output": F.col("output")}).first().prompt
    assert prompt == "USER: Q q{{output}} A a0 {{unknown}}"


def test_prompt_pieces_render_as_templates(spark, items):
    """Messages cut once per rule give what filling each row's template gives, and no template is split per row."""
    contents = ["{{ a }}-{{b}}-{{c}}", "x {{a", "}} {{{{b}} {{}} {{a}}{{a}}", "", None, "{{context}}"]
    messages = F.array(*[F.struct(F.lit("USER").alias("role"), F.lit(c).cast("string").alias("content")) for c in contents])
    made = spark.range(1).select(
        F.lit("r").alias("rule_id"), F.lit("llm_as_judge").alias("type"), F.array(F.lit("1"), F.lit("2")).alias("project_ids"), F.lit(1.0).alias("sampling_rate"),
        F.lit(True).alias("enabled"), messages.alias("messages"), F.create_map(F.lit("a"), F.lit("input.question"), F.lit("b"), F.lit("output.none")).alias("variables"),
    )
    routed = R.route_rules(*R.bind_paths(items, made))
    prompts = R.rule_prompts(routed)
    filled = F.create_map(F.lit("a"), F.get_json_object("input", "$.question"), F.lit("b"), F.lit(None).cast("string"))
    want = "\n".join(["USER: %s"] * 5)
    texts = [render_mustache(F.lit(c), filled) for c in contents if c is not None]
    assert prompts.count() > 0 and prompts.where(F.col("prompt") != F.format_string(want, *texts)).isEmpty()
    plan = prompts.select("trace_id", "prompt")._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan.split("Join")[0]


def test_templates(spark):
    df = spark.createDataFrame([("{{ a }}-{{b}}-{{c}}", "x{y", None)], "t string, a string, b string")
    values = {"a": F.col("a"), "b": F.col("b")}
    assert df.select(render_mustache(F.col("t"), values)).first()[0] == "x{y--{{c}}"
    assert df.select(render_mustache("{{ a }}-{{b}}-{{c}}", values)).first()[0] == "x{y--{{c}}"
    assert df.select(render_braces("Q {a}!", values)).first()[0] == "Q x{y!"
    assert df.select(render_braces(F.lit("Q {a}! {z}"), values)).first()[0] == "Q x{y! {z}"
    with pytest.raises(KeyError):
        render_braces("{nope}", values)


def test_rule_upkeep(spark, rules):
    changes = spark.createDataFrame([("off", 0.25), ("brand-new", 0.5)], "rule_id string, sampling_rate double")
    updated = R.rules_upsert(rules, changes)
    off = R.rule_by_id(updated, "off").first()
    assert (off.sampling_rate, off.enabled, off.type) == (0.25, False, "user_defined_metric_python")
    assert updated.count() == rules.count() + 1
    assert R.rules_delete(updated, changes.select("rule_id")).count() == rules.count() - 1
    assert R.rules_of_project(rules, "1").count() == 6 and R.rules_of_project(rules, "3").count() == 0


def test_judge_values_and_images(spark):
    df = spark.createDataFrame([('{"a": 1.5, "b": false, "c": 3}', "data:image/png;base64,aGk="), ("oops", "https://x/i.png")], "j string, u string")
    fields = [("a", "INTEGER"), ("b", "BOOLEAN"), ("c", "DOUBLE")]
    values = F.array(*[J.json_scalar(F.get_json_object("j", f"$.{n}"), F.lit(kind)) for n, kind in fields])
    first, second = df.select(values, J.image_part(F.col("u"))).collect()
    assert (first[0], second[0]) == ([None, 0.0, 3.0], [None, None, None])
    assert (first[1].kind, first[1].mime, bytes(first[1].bytes)) == ("data", "image/png", b"hi")
    assert (second[1].kind, second[1].mime) == ("url", None)
    parts = df.select(J.content_parts(F.lit("t"), F.col("u"))).first()[0]
    assert [p.type for p in parts] == ["text", "image_url"]


def test_arguments_of_the_rule_and_map_roots(spark):
    same = MetricSpec("same", lambda output, reference: (output == reference).cast("double"), {"output": "output", "reference": "input.want"})
    data = [("t", '{"want": "a", "other": "b"}', "b", {"env.zone": "b"})]
    items = spark.createDataFrame(data, "trace_id string, input string, output string, metadata map<string,string>")
    rule = "struct<rule_id: string, metric: string, arguments: map<string,string>>"
    given = [("r1", "same", {"reference": "input.other"}), ("r2", "same", {"output": "metadata.env.zone"}), ("r3", "same", None), ("r4", "same", {"reference": "metadata.env.zone"})]
    routed = items.crossJoin(spark.createDataFrame([(g,) for g in given], f"rule {rule}"))
    assert rows(R.metric_scores(routed, {"same": same}), "rule_id", "value") == [("r1", 1.0), ("r2", 0.0), ("r3", 0.0), ("r4", 1.0)]
    bound = items.select(R.bind_variables(F.create_map(F.lit("v"), F.lit("metadata.env.zone")), {"metadata": F.col("metadata")}, {"metadata"}).alias("b"))
    assert bound.first().b == {"v": "b"}


def _arrive(spark, items, folder):
    items.coalesce(1).write.mode("append").parquet(folder)
    return A.stream_traces(spark, folder, items.schema)


def test_windows_equal_batch_on_closed_intervals(spark, items, tmp_path):
    stream = _arrive(spark, items, str(tmp_path / "in"))
    closed = A.run_available(A.tumbling_metrics(stream, "2 minutes", "1 minute"), "w")
    assert rows(closed, "traces") == [(2,)] * 5
    moved = A.run_available(A.sliding_metrics(stream, "4 minutes", "2 minutes", "0 seconds"), "m")
    assert all(r.mean == 1.0 and r.traces in (2, 4) for r in moved.collect()) and moved.count() >= 4


def test_duplicates_are_dropped_over_batches(spark, items, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for _ in range(2):
        stream = _arrive(spark, items, folder)
        A.write_rows(A.dedup_stream(stream, watermark="1 day"), out, state).awaitTermination()
    assert spark.read.schema(items.schema).parquet(out).count() == 12


def test_assignment_is_idempotent(spark, items, tmp_path):
    stream = _arrive(spark, items, str(tmp_path / "in"))
    chosen = A.enqueue_stream(stream, "review", F.col("project_id") == "1")
    for state in ("s1", "s2"):
        A.write_assignments(chosen, str(tmp_path / "out"), str(tmp_path / state)).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "queue", "trace_id") == sorted((("review", f"t{i}") for i in range(1, 12, 2)), key=repr)


def test_sessions_split_at_gaps(spark):
    start = datetime(2026, 7, 1, 23)
    minutes = {"t": (0, 10, 50, 65, 80, 200, 240), "u": tuple(range(0, 4000, 29)), "v": (0, 30)}
    df = spark.createDataFrame([(k, start + timedelta(minutes=m)) for k, ms in minutes.items() for m in ms], "thread_id string, start_time timestamp")
    found = thread_sessions(df)
    assert rows(found, "thread_id", "traces") == [("t", 1), ("t", 1), ("t", 2), ("t", 3), ("u", 138), ("v", 2)]
    assert rows(found) == rows(sessions_by(df, ["thread_id"], "30 minutes").select(*SESSION_COLUMNS))


def test_thread_parts_cover_everything_in_order(spark):
    turns = spark.createDataFrame([("long", i, f"m{i}") for i in range(25)] + [("short", 0, "x")], "thread_id string, turn int, text string")
    parts = thread_parts(turns, size=10)
    joined = "\n".join(r.conversation for r in parts.where("thread_id = 'long'").orderBy("part").collect())
    assert joined == "\n".join(f"m{i}" for i in range(25))
    assert parts.agg(F.max("turns")).first()[0] == 10
    scores = parts.select("thread_id", "turns", F.lit("s").alias("name"), F.col("part").cast("double").alias("value"))
    assert dict(rows(combine_parts(scores), "thread_id", "value"))["long"] == pytest.approx((0 * 10 + 1 * 10 + 2 * 5) / 25)
