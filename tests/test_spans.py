from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tracelake.functions import documents as J
from tracelake.functions.dates import is_uuid7, uuid7_time
from tracelake.operators import spans as S
from tracelake.streaming.arrivals import write_rows
from tracelake.streaming.stitching import stitch_stream

NAMES = ["web.request", "plan", "pick", "model.call", "enqueue", "worker", "plan", "pick", "model.call"]
V7 = "01890a5d-ac96-774b-bcce-b302099a8057"
SCHEMA = "trace_id string, span_id string, parent_span_id string, name string, session_id string, start_time timestamp, end_time timestamp, attributes map<string,string>"


def chain(order, start=datetime(2026, 7, 1)):
    usage = {3: (70, 8), 8: (130, 24)}
    out = []
    for i in order:
        attrs = {"gen_ai.system": "openai", "gen_ai.request.model": "m", "gen_ai.usage.input_tokens": str(usage[i][0]), "gen_ai.usage.output_tokens": str(usage[i][1])} if i in usage else {}
        if i == 0:
            attrs = {"input": "q", "output": "a", "thread_id": "s", "acme.tags": '["x","y"]'}
        out.append(("t", f"s{i}", f"s{i - 1}" if i else None, NAMES[i], "s", start + timedelta(seconds=i), start + timedelta(seconds=i + 2), attrs))
    return out


@pytest.fixture
def spans(spark):
    return spark.createDataFrame(chain([4, 8, 0, 3, 1, 7, 2, 6, 5]), SCHEMA)


def test_tree_depths(spans):
    tree = S.span_tree(spans)
    assert [(r.span_id, r.depth) for r in tree.orderBy("depth").collect()] == [(f"s{i}", i) for i in range(9)]
    assert {r.root_span_id for r in tree.collect()} == {"s0"}
    assert rows(S.trace_id_check(spans)) == [(1,)]
    assert rows(S.trace_id_check(spans, approximate=True)) == [(1,)]


def test_orphans_drop_or_become_roots(spark, spans):
    extra = spark.createDataFrame(
        [("t", "o1", "gone", "n", None, None, None, None), ("t", "o2", "o1", "n", None, None, None, None), ("t", "c1", "c2", "n", None, None, None, None), ("t", "c2", "c1", "n", None, None, None, None)],
        SCHEMA,
    )
    both = spans.unionByName(extra)
    assert {r.span_id for r in S.span_tree(both).collect()} == {f"s{i}" for i in range(9)}
    rooted = {r.span_id: (r.root_span_id, r.depth) for r in S.span_tree(both, "root").collect()}
    assert rooted["o2"] == ("o1", 1) and "c1" not in rooted and len(rooted) == 11
    assert rows(S.orphan_spans(both), "span_id") == [("o1",)]
    with pytest.raises(ValueError):
        S.span_tree(spans, "keep")


def test_spans_delivered_twice(spark, spans):
    tree = S.span_tree(spans.unionByName(spans.where("span_id in ('s0', 's2')")))
    assert sorted((r.span_id, r.depth) for r in tree.collect()) == sorted([(f"s{i}", i) for i in range(9)] + [("s0", 0), ("s2", 2)])


def test_star_tree_with_a_hot_parent(spark):
    data = [("t", "r", None)] + [("t", f"x{i}", "r") for i in range(300)]
    tree = S.span_tree(spark.createDataFrame(data, "trace_id string, span_id string, parent_span_id string"))
    assert dict(rows(tree.groupBy("depth").count())) == {0: 1, 1: 300}


def test_assembly(spans):
    typed = S.read_attributes(spans, "acme").withColumn("thread_id", F.col("session_id"))
    trace = S.assemble_traces(typed).first()
    assert (trace.name, trace.input, trace.output, trace.tags) == ("web.request", "q", "a", ["x", "y"])
    assert (trace.input_tokens, trace.output_tokens, trace.spans) == (200, 32, 9)
    assert trace.end_time - trace.start_time == timedelta(seconds=10)
    kinds = dict(rows(typed.groupBy("type").count()))
    assert kinds == {"general": 7, "llm": 2}


def test_attribute_mapping(spark):
    attrs = {
        "gen_ai.response.model": "m2", "gen_ai.usage.cost": "0.5", "gen_ai.usage.total": "7", "gen_ai.tool.name": "s",
        "acme.metadata.k": "v", "input.0": "x", "other": "y",
    }
    df = spark.createDataFrame([(attrs,)], "a map<string,string>")
    row = df.select(*[c.alias(n) for n, c in J.map_span_attributes(F.col("a"), "acme").items()]).first()
    assert (row.model, row.type, row.provider, row.usage, row.cost) == ("m2", "llm", None, {"total": 7}, 0.5)
    assert row.metadata == {"gen_ai.tool.name": "s", "k": "v"}
    assert (row.tags, row.input, row.output) == (None, '{"input.0":"x"}', None)


def test_parent_choice(spark):
    data = [
        ({"acme.trace_id": V7, "acme.parent_span_id": V7, "acme.span_id": V7}, V7, V7),
        ({"acme.trace_id": V7}, V7, None),
        ({"acme.trace_id": "not-v7", "acme.parent_span_id": V7}, "native", "np"),
        ({}, "native", "np"),
    ]
    df = spark.createDataFrame([(a,) for a, _, _ in data], "a map<string,string>")
    chosen = J.choose_parent(F.col("a"), F.lit("native"), F.lit("ns"), F.lit("np"), "acme")
    assert [tuple(r) for r in df.select(chosen["trace_id"], chosen["parent_span_id"]).collect()] == [(t, p) for _, t, p in data]


def test_ids_and_headers(spark):
    df = spark.createDataFrame([(V7, f"00-{'a' * 32}-{'b' * 16}-01"), ("0", "00-xyz")], "u string, h string")
    got = df.select(is_uuid7(F.col("u")), uuid7_time(F.col("u")), J.parse_traceparent(F.col("h"))).collect()
    assert got[0][0] and got[0][1] == datetime.fromtimestamp(0x01890A5DAC96 / 1000)
    assert tuple(got[0][2]) == ("a" * 32, "b" * 16, "01")
    assert tuple(got[1]) == (False, None, None)


def _late_spans():
    late = [r for r in chain(range(9)) if r[1] == "s5"]
    return [("other", r[1], None, *r[3:]) for r in late]


def test_stitch(spark):
    spans = spark.createDataFrame(_late_spans() + [("x", "lone", None, "n", None, None, None, None)], SCHEMA)
    sessions = spark.createDataFrame([("s", "t", "s4")], "session_id string, trace_id string, dispatch_span_id string")
    assert rows(S.stitch(spans, sessions), "span_id", "trace_id", "parent_span_id") == [("lone", "x", None), ("s5", "t", "s4")]


def test_stitch_stream(spark, tmp_path):
    spans = spark.createDataFrame(_late_spans(), SCHEMA)
    # A much later pair moves both watermarks on, so the first span's state can be given out.
    later = spans.withColumns({"session_id": F.lit("z"), "span_id": F.lit("z1"), "start_time": F.expr("start_time + INTERVAL 2 DAYS")})
    dispatch = "session_id string, trace_id string, dispatch_span_id string, dispatch_time timestamp"
    sessions = spark.createDataFrame([("s", "t", "s4", datetime(2026, 7, 1))], dispatch)
    spans.write.mode("append").parquet(str(tmp_path / "in"))
    sessions.write.mode("append").parquet(str(tmp_path / "ses"))

    def run():
        left = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        right = spark.readStream.schema(dispatch).parquet(str(tmp_path / "ses"))
        write_rows(stitch_stream(left, right), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return rows(spark.read.schema(SCHEMA).parquet(str(tmp_path / "out")), "span_id", "trace_id", "parent_span_id")

    assert run() == [("s5", "t", "s4")]
    later.write.mode("append").parquet(str(tmp_path / "in"))
    assert ("s5", "t", "s4") in run()


def test_attributes_grouped_first_are_the_same(spark):
    maps = [
        {"gen_ai.usage.a": "1", "gen_ai.usage.b": "x", "gen_ai.usage.cost": "2", "gen_ai.agent.id": "z", "acme.metadata.k": "v", "output": "o", "inputs": "i"},
        {"other\noutput": "no side", "x": "input"}, {"output.a": "1", "output.b": None, "input": None, "input.c": "2"}, {}, None,
    ]
    df = spark.createDataFrame([(m,) for m in maps], "a map<string,string>").withColumn("g", J.grouped_attributes(F.col("a"), "acme"))
    alone = df.select(*[c.alias(n) for n, c in J.map_span_attributes(F.col("a"), "acme").items()]).collect()
    grouped = df.select(*[c.alias(n) for n, c in J.map_span_attributes(F.col("a"), "acme", F.col("g")).items()]).collect()
    assert alone == grouped
    assert (alone[0].usage, alone[0].metadata, alone[0].input) == ({"a": 1}, {"gen_ai.agent.id": "z", "k": "v"}, '{"inputs":"i"}')
    assert (alone[1].input, alone[1].output) == (None, None)
    assert (alone[2].input, alone[2].output) == ('{"input":null,"input.c":"2"}', '{"output.a":"1","output.b":null}')
