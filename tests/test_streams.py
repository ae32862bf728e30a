"""Streaming jobs against their batch counterparts, over several arrivals and repeated batches."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tracelake import schemas
from tracelake.operators import rules as R
from tracelake.operators.metrics import MetricSpec
from tracelake.operators.retention import expand_ttl_rules
from tracelake.operators import threads
from tracelake.operators.threads import judge_sessions, session_parts, thread_scores
from tracelake.sources import writers as W
from tracelake.streaming import arrivals as A
from tracelake.streaming import late_scores as L
from tracelake.streaming import stitching
from tracelake.streaming.stitching import stitch_stream

START = datetime(2026, 7, 1)
SPAN = "trace_id string, span_id string, parent_span_id string, session_id string, start_time timestamp, attributes map<string,string>"
DISPATCH = "session_id string, trace_id string, dispatch_span_id string, dispatch_time timestamp"


class Feed:
    """Folders that rows arrive in one file after the other."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, base

    def add(self, name, data, schema):
        self.spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{self.base}/{name}")

    def stream(self, name, schema):
        (self.base / name).mkdir(exist_ok=True)
        return self.spark.readStream.schema(schema).parquet(f"{self.base}/{name}")

    def run(self, df, out="out"):
        A.write_rows(df, f"{self.base}/{out}", f"{self.base}/{out}-state").awaitTermination()
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/{out}")


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def at(minutes):
    return START + timedelta(minutes=minutes)


def test_spans_meet_their_dispatch_in_any_order_and_only_once(feed):
    def run():
        stitched = stitch_stream(feed.stream("spans", SPAN), feed.stream("sent", DISPATCH), "1 hour", "10 minutes", "1 minute")
        return rows(feed.run(stitched), "span_id", "trace_id", "parent_span_id", "attributes", "start_time")

    feed.add("spans", [("own", "early", None, "s", at(5), {"k": "v"}), ("x", "child", "p", "s", at(5), None), ("y", "free", None, None, at(6), None)], SPAN)
    assert run() == [("child", "x", "p", None, at(5)), ("free", "y", None, None, at(6))]
    feed.add("sent", [("s", "t1", "d1", at(4)), ("s", "t2", "d2", at(5)), ("s", "t1", "d1", at(4))], DISPATCH)
    met = ("early", "t1", "d1", {"k": "v"}, at(5))
    assert met in run()
    feed.add("sent", [("s", "t0", "d0", at(3))], DISPATCH)  # the session has one already
    feed.add("spans", [("own", "late", None, "s", at(7), None), ("own", "far", None, "s", at(95), None), ("own", "lone", None, "z", at(8), None)], SPAN)
    found = run()
    assert ("late", "t1", "d1", None, at(7)) in found and ("lone", "own", None, None, at(8)) in found and len(found) == 5
    feed.add("spans", [("own", "clock", None, "c", at(6000), None)], SPAN)  # moves the watermark on
    found = run()
    assert [f[0] for f in found].count("early") == 1
    assert ("far", "own", None, None, at(95)) in found
    assert len(found) == 6


TRACE = "trace_id string, start_time timestamp"
SCORE = "trace_id string, name string, value double, ts timestamp"


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_composites_do_not_depend_on_the_order_of_arrival(spark, feed, order):
    traces = [("whole", at(0)), ("no-quality", at(1)), ("bare", at(2)), ("too-late", at(3))]
    values = {"whole": (0.9, 0.1, 0.5), "no-quality": (0.8, 0.2, None), "bare": (None, None, None), "too-late": (0.7, 0.3, 0.9)}
    scores = [(t, n, v, at(10 if t != "too-late" or n != L.PARTS[2] else 500)) for t, vs in values.items() for n, v in zip(L.PARTS, vs) if v is not None]
    parts = [("traces", traces, TRACE), ("scores", scores[:3], SCORE), ("scores", scores[3:] + [("whole", L.PARTS[0], 0.0, at(90))], SCORE)]

    def run():
        return feed.run(L.composite_stream(feed.stream("traces", TRACE), feed.stream("scores", SCORE), "1 hour", "10 hours"))

    for i in order:
        feed.add(*parts[i])
        found = run()
    assert rows(found, "trace_id", "composite", "complete") == [("whole", 0.82, True)]
    feed.add("traces", [("clock", at(9000))], TRACE)
    feed.add("scores", [("clock", L.PARTS[0], 1.0, at(9000))], SCORE)
    run()
    found = run()
    assert rows(found, "trace_id", "composite", "complete") == [("bare", None, False), ("no-quality", 0.8, False), ("too-late", 0.72, False), ("whole", 0.82, True)]
    stored = spark.read.schema(TRACE).parquet(f"{feed.base}/traces"), spark.read.schema(SCORE).parquet(f"{feed.base}/scores")
    for _ in range(2):
        L.correct_days(*stored, START.date(), START.date(), f"{feed.base}/final")
    final = L.current_composites(spark, f"{feed.base}/out", f"{feed.base}/final")
    batch = L.composites(*stored).where("trace_id <> 'clock'")
    assert rows(final) == rows(batch.select(final.columns))
    corrected = dict(rows(final, "trace_id", "composite"))
    assert corrected["too-late"] == pytest.approx(0.74) and corrected["whole"] == pytest.approx(0.5 * 0 + 0.3 * 0.9 + 0.2 * 0.5)


def test_a_repeated_batch_and_a_second_writer_add_nothing(spark, tmp_path):
    path = f"{tmp_path}/table"
    schema = "queue string, trace_id string, day date"
    day = date(2026, 7, 1)
    first = spark.createDataFrame([("q", "a", day), ("q", "a", day), ("q", "b", day), ("r", "a", day)], schema)
    second = spark.createDataFrame([("q", "b", day), ("q", "c", day + timedelta(days=1))], schema)
    for frame, writer, batch in ((first, "w", 0), (first, "w", 0), (second, "v", 0), (second, "v", 0), (first, "w", 1)):
        A.add_assignments(frame, path, writer, batch)
    want = [("q", "a"), ("q", "b"), ("q", "c"), ("r", "a")]
    assert rows(spark.read.parquet(path), "queue", "trace_id") == want
    spark.createDataFrame([("q", "a")], "queue string, trace_id string").write.parquet(f"{path}/queue=q/day=2026-07-01/writer=x/batch=0/extra")
    assert rows(A.read_assignments(spark, path), "queue", "trace_id") == want


def stored_traces(spark, path):
    days = [datetime(2026, 7, d, 12) for d in (1, 1, 2, 20, 20)]
    tags = [["old"], [], ["old"], ["old"], []]
    data = [(f"{p}{i}", p, p, d, t) for p in ("p", "q/r") for i, (d, t) in enumerate(zip(days, tags))]
    traces = spark.createDataFrame(data, "trace_id string, project string, project_id string, start_time timestamp, tags array<string>")
    W.ingest_traces(traces, path)
    return spark.read.parquet(path).schema


@pytest.mark.parametrize("broken", ["find", "keep", "replace"])
def test_deletion_goes_on_after_a_crash(spark, tmp_path, monkeypatch, broken):
    path, work = f"{tmp_path}/traces", f"{tmp_path}/work"
    schema = stored_traces(spark, path)
    rules = expand_ttl_rules([{"tags": ["old"], "older_than_days": 10}], datetime(2026, 7, 21))
    files = lambda: set(rows(spark.read.parquet(path).select("project", "date", F.col("_metadata.file_name").alias("f")), "project", "date", "f"))
    before = files()
    once = W._once

    def crash(session, folder, step, run):
        if step == broken:
            run()  # done, but the mark that says so was never set
            raise RuntimeError("lost")
        once(session, folder, step, run)

    monkeypatch.setattr(W, "_once", crash)
    with pytest.raises(RuntimeError):
        W.delete_by_partition(spark, path, schema, rules, work)
    monkeypatch.setattr(W, "_once", once)
    audit = W.delete_by_partition(spark, path, schema, rules, work)
    assert rows(audit, "trace_id") == [("p0",), ("p2",), ("q/r0",), ("q/r2",)]
    left = spark.read.schema(schema).parquet(path)
    assert rows(left, "trace_id") == [(f"{p}{i}",) for p in ("p", "q/r") for i in (1, 3, 4)]
    assert {f for f in before if f[1] == date(2026, 7, 20)} == {f for f in files() if f[1] == date(2026, 7, 20)}
    assert not {f for f in files() if f[1] == date(2026, 7, 2)}
    again = W.delete_by_partition(spark, path, schema, rules, f"{tmp_path}/next")
    assert again.count() == 0 and rows(spark.read.schema(schema).parquet(path), "trace_id") == rows(left, "trace_id")


ITEM = "trace_id string, project_id string, thread_id string, start_time timestamp, input string, output string"


def judge_rule(**fields):
    row = {
        "rule_id": "r", "name": "r", "type": "trace_thread_llm_as_judge", "project_ids": ["1"], "sampling_rate": 1.0, "enabled": True, "model": "m",
        "messages": [("USER", "Judge: {{ context }}")], "schema": [("long", "INTEGER", "")], "variables": None, "metric": None, "arguments": None,
    } | fields
    return tuple(row[f] for f in schemas.RULE.names)


@pytest.fixture
def count_turns():
    return lambda prompts: prompts.map(lambda p: "broken" if "bad" in p else f'{{"long": {p.count("USER: u")}}}')


def talk(spark):
    data = [(f"t{i}", "1", "long", at(i), f"u{i}", f"a{i}") for i in range(7)] + [("s0", "1", "short", at(0), "u0", "bad"), ("x", "2", "other", at(0), "u", "a")]
    data += [(f"n{i}", "1", "long", at(1430 + 20 * i), f"u{i}", "a") for i in range(2)]  # a second session, over midnight
    return spark.createDataFrame(data, ITEM)


def test_a_judge_sees_the_whole_conversation_in_parts(spark, count_turns):
    traces = talk(spark)
    rules = spark.createDataFrame([judge_rule(), judge_rule(rule_id="off", enabled=False), judge_rule(rule_id="plain", messages=[("USER", "Judge.")])], schemas.RULE)
    found = thread_scores(traces, rules, count_turns, size=3)
    means = {"long": (3 * 3 + 3 * 3 + 1 * 1) / 7}
    assert rows(found.where("rule_id = 'r'"), "thread_id", "first", "value", "failed") == [
        ("long", at(0), pytest.approx(means["long"]), False), ("long", at(1430), 2.0, False), ("short", at(0), None, True)
    ]
    assert rows(found.where("rule_id = 'plain'"), "thread_id") == [("long",), ("long",), ("short",)]
    sessions = spark.createDataFrame([("1", "long", at(0), at(6))], "project_id string, thread_id string, first timestamp, last timestamp")
    parts = session_parts(sessions, traces, size=5)
    text = "\n".join(r.conversation for r in parts.orderBy("part").collect())
    assert text == "\n".join(f"USER: u{i}\nASSISTANT: a{i}" for i in range(7))
    assert judge_sessions(sessions.limit(0), traces, rules, count_turns).count() == 0


def test_one_hot_session_is_spread_and_its_waiting_spans_are_chunks(spark, feed, monkeypatch):
    monkeypatch.setattr(stitching, "CHUNK", 7)  # several entries a share in the driver's own helpers
    spans = [(None, f"s{i}", None, "hot", at(i % 8)) for i in range(400)]
    schema = "trace_id string, span_id string, parent_span_id string, session_id string, start_time timestamp"
    sent = "session_id string, trace_id string, dispatch_span_id string, dispatch_time timestamp"

    def run() -> list:
        stitched = stitch_stream(feed.stream("spans", schema), feed.stream("sent", sent), "1 hour", "10 minutes", "1 minute")
        return rows(feed.run(stitched), "span_id", "trace_id", "parent_span_id")

    feed.add("sent", [("else", "t", "d", at(0))], sent)
    feed.add("spans", spans, schema)
    assert run() == []
    feed.add("sent", [("hot", f"t{i}", "d", at(2 + i)) for i in range(30)], sent)
    want = {(f"s{i}", "t0", "d") for i in range(400) if i % 8 >= 1}
    assert set(run()) == want
    feed.add("sent", [("else", "t", "d", at(300))], sent)
    assert set(run()) == want | {(f"s{i}", None, None) for i in range(400) if i % 8 < 1}
    entries = stitching._chunks(np.array([f"s{i}" for i in range(20)], dtype=object), np.arange(20)[::-1])
    assert [ms for _, ms in entries] == [0, 7, 14] and sum(len(stitching._opened(e)[0]) for e in entries) == 20
    plan = stitch_stream(feed.stream("spans", schema), feed.stream("sent", sent))._jdf.queryExecution().analyzed().toString()
    assert "__salt" in plan


def test_only_sessions_of_several_parts_are_numbered(spark, count_turns, monkeypatch):
    numbered = []
    total = threads.ordered_total
    monkeypatch.setattr(threads, "ordered_total", lambda turns, *a, **k: numbered.append(turns.count()) or total(turns, *a, **k))
    traces, rules = talk(spark), spark.createDataFrame([judge_rule()], schemas.RULE)
    whole = thread_scores(traces, rules, count_turns)
    assert rows(whole, "thread_id", "first", "value") == [("long", at(0), 7.0), ("long", at(1430), 2.0), ("short", at(0), None)] and numbered == []
    thread_scores(traces, rules, count_turns, size=3)
    assert numbered == [7]  # the session of seven traces; the others are one part each
    fewer = spark.createDataFrame([("1", "long", at(0), at(6), 2)], "project_id string, thread_id string, first timestamp, last timestamp, traces long")
    parts = session_parts(fewer, traces, size=3)  # the table holds more than were counted
    assert rows(parts, "part", "turns") == [(0, 3), (1, 3), (2, 1)]
    assert "\n".join(r.conversation for r in parts.orderBy("part").collect()) == "\n".join(f"USER: u{i}\nASSISTANT: a{i}" for i in range(7))


def test_closed_sessions_of_a_stream_are_judged_like_stored_ones(spark, feed, count_turns):
    rules = spark.createDataFrame([judge_rule()], schemas.RULE)
    clock = [("c", "9", "clock", at(9000), "u", "a")]
    everything = talk(spark).collect()
    for part in (everything[:4], everything[4:], clock):
        feed.add("in", part, ITEM)
        stream = feed.stream("in", ITEM)
        read = lambda: spark.read.schema(ITEM).parquet(f"{feed.base}/in")
        A.judge_threads(stream, read, rules, count_turns, f"{feed.base}/scores", f"{feed.base}/state", watermark="2 days", size=3).awaitTermination()
    got = spark.read.parquet(f"{feed.base}/scores")
    want = thread_scores(talk(spark), rules, count_turns, size=3)
    columns = ["thread_id", "first", "rule_id", "name", "value", "failed"]
    assert rows(got, *columns) == rows(want, *columns)


def test_paths_are_compiled_once_for_all_rules(spark, monkeypatch):
    same = MetricSpec("same", lambda output, reference: (output == reference).cast("double"), {"output": "output.a", "reference": "input.want"})
    data = [("t", "1", '{"want": {"deep": "a", "n": 1.50}, "Want": "b", "list": ["a"], "x": "a"}', '{"a": "a"}', {"env.zone": "a"})]
    items = spark.createDataFrame(data, "trace_id string, project_id string, input string, output string, metadata map<string,string>")
    paths = {
        "deep": ("input.want.deep", 1.0), "inner": ("input.want", 0.0), "case": ("input.Want", 0.0), "listed": ("input.list[0]", 1.0), "plain": ("input.x", 1.0),
        "map": ("metadata.env.zone", 1.0), "unknown": ("nothing.here", None), "absent": ("input.no", None), "default": (None, 0.0),
    }
    made = [judge_rule(rule_id=n, type="user_defined_metric_python", messages=None, schema=None, metric="same", arguments={"reference": p}) for n, (p, _) in paths.items()]
    rules = spark.createDataFrame(made, schemas.RULE)
    want = {n: None if v is None else v for n, (_, v) in paths.items()}
    found = R.score_batch(items, rules, {"same": same})
    assert dict(rows(found, "rule_id", "value")) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "get_json_object(input" in plan
    monkeypatch.setattr(R, "PATHS", 2)
    assert dict(rows(R.score_batch(items, rules, {"same": same}), "rule_id", "value")) == want
