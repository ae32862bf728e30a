"""Span queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.catalog.bindings import VENDOR, Tables
from tracelake.catalog.registry import query
from tracelake.functions import documents
from tracelake.operators import spans
from tracelake.streaming import arrivals, stitching


@query(
    "span_tree",
    """SELECT 'r' || r_regionkey AS span_id, 'r' || r_regionkey AS root_span_id, 0 AS depth FROM region
    UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 1 FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'c' || c_custkey, 'r' || n_regionkey, 2 FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT 'o' || o_orderkey, 'r' || n_regionkey, 3 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def span_tree(t: Tables) -> DataFrame:
    return spans.span_tree(t.tree).select("span_id", "root_span_id", "depth")


@query(
    "span_tree_rerooted",
    """SELECT 'n' || n_nationkey AS span_id, 'n' || n_nationkey AS root_span_id, 0 AS depth FROM nation
    UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 1 FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT 'o' || o_orderkey, 'n' || c_nationkey, 2 FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def span_tree_rerooted(t: Tables) -> DataFrame:
    headless = t.tree.where(~F.col("span_id").startswith("r"))
    return spans.span_tree(headless, orphans="root").select("span_id", "root_span_id", "depth")


@query(
    "span_orphans",
    """SELECT 'p' || l_partkey AS parent_span_id, count(*) AS spans FROM lineitem
      WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25) GROUP BY 1""",
)
def span_orphans(t: Tables) -> DataFrame:
    roots = t.table("part").where("p_size < 25").select(F.concat(F.lit("p"), "p_partkey").alias("span_id"), F.lit(None).cast("string").alias("parent_span_id"))
    lines = t.line_spans.select("span_id", F.concat(F.lit("p"), F.col("attributes")[f"{VENDOR}.metadata.part"]).alias("parent_span_id"))
    found = spans.orphan_spans(roots.unionByName(lines).withColumn("trace_id", F.lit("t0")))
    return found.groupBy("parent_span_id").agg(F.count("*").alias("spans"))


@query(
    "stitch",
    """SELECT l_orderkey AS session_id, 'c' || o_custkey AS trace_id, 'o' || o_orderkey AS parent_span_id, count(*) AS spans
      FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus <> 'P' GROUP BY ALL""",
)
def stitch(t: Tables) -> DataFrame:
    sessions = t.table("orders").where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("session_id"),
        F.concat(F.lit("c"), "o_custkey").alias("trace_id"),
        F.concat(F.lit("o"), "o_orderkey").alias("dispatch_span_id"),
    )
    loose = t.line_spans.withColumns({"trace_id": F.lit(None).cast("string"), "parent_span_id": F.lit(None).cast("string")})
    return spans.stitch(loose, sessions).groupBy("session_id", "trace_id", "parent_span_id").agg(F.count("*").alias("spans"))


@query(
    "stitch_stream",
    """WITH sent AS (SELECT date_trunc('month', o_orderdate) AS month, min(o_orderstatus || ':' || o_orderkey % 7) AS d FROM orders WHERE month(o_orderdate) % 2 = 0 GROUP BY 1),
      spans AS (SELECT *, date_trunc('month', l_shipdate) AS month FROM lineitem),
      clock AS (SELECT greatest((SELECT max(l_shipdate) FROM lineitem), (SELECT max(month) FROM sent)) - INTERVAL 1 DAY AS mark)
    SELECT strftime(spans.month, '%Y-%m') AS session_id, left(d, 1) AS trace_id, d AS parent_span_id, count(*) AS spans, min(l_shipdate) AS first
    FROM spans LEFT JOIN sent ON spans.month = sent.month, clock WHERE d IS NOT NULL OR l_shipdate + INTERVAL 40 DAY <= mark GROUP BY ALL""",
)
def stitch_stream(t: Tables) -> DataFrame:
    """Line items as spans of their month's session. Every order of an even month dispatches that session again; spans of odd
    months find no dispatch and go out by themselves once they have waited for 40 days."""
    lines = t.stream("lineitem").select(
        F.lit(None).cast("string").alias("trace_id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("span_id"), F.lit(None).cast("string").alias("parent_span_id"),
        F.date_format("l_shipdate", "yyyy-MM").alias("session_id"), F.col("l_shipdate").cast("timestamp").alias("start_time"),
    )
    sent = t.stream("orders").where(F.month("o_orderdate") % 2 == 0).select(
        F.date_format("o_orderdate", "yyyy-MM").alias("session_id"), F.col("o_orderstatus").alias("trace_id"),
        F.concat_ws(":", "o_orderstatus", F.col("o_orderkey") % 7).alias("dispatch_span_id"), F.date_trunc("month", "o_orderdate").alias("dispatch_time"),
    )
    stitched = arrivals.run_available(stitching.stitch_stream(lines, sent, "40 days", "1 day", "1 day"), "stitched")
    return stitched.groupBy("session_id", "trace_id", "parent_span_id").agg(F.count("*").alias("spans"), F.min("start_time").cast("timestamp_ntz").alias("first"))


@query(
    "attr_mapping",
    """SELECT span_id, coalesce(CASE WHEN l_returnflag = 'A' THEN 'model-a' END, CASE WHEN l_returnflag <> 'R' THEN 'model-b' END) AS model,
      CASE WHEN l_returnflag = 'R' THEN 'general' ELSE 'llm' END AS type, l_linestatus AS provider,
      l_quantity::BIGINT AS input_tokens, l_linenumber::BIGINT AS output_tokens, l_discount AS cost,
      CASE WHEN l_linenumber = 1 THEN 2 ELSE 1 END AS fields, CASE WHEN l_returnflag = 'N' THEN 'new,open' END AS tags,
      CASE WHEN l_linenumber = 2 THEN l_linestatus END AS input FROM line_spans""",
    ("line_spans",),
)
def attr_mapping(t: Tables) -> DataFrame:
    typed = spans.read_attributes(t.line_spans, VENDOR)
    return typed.select(
        "span_id", "model", "type", "provider", F.col("usage")["input_tokens"].alias("input_tokens"),
        F.col("usage")["output_tokens"].alias("output_tokens"), "cost", F.size("metadata").alias("fields"),
        F.array_join("tags", ",").alias("tags"), "input",
    )


@query(
    "attr_mapping_explicit",
    """WITH ids AS (SELECT *, lower(lpad(hex(l_orderkey + 1700000000000), 12, '0')) AS h, l_linenumber % 4 AS kind FROM lineitem),
      named AS (SELECT *, left(h, 8) || '-' || right(h, 4) || '-7abc-9def-0123456789ab' AS own FROM ids)
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS line, CASE WHEN kind = 0 THEN 'native' ELSE own END AS trace_id,
      CASE WHEN kind IN (0, 1) THEN 's' || l_linenumber ELSE own END AS span_id, CASE kind WHEN 0 THEN 'p' || l_linenumber WHEN 3 THEN own END AS parent_span_id,
      CASE WHEN l_linenumber = 1 THEN 'gen_ai.tool.name=search,' ELSE '' END || 'part=' || l_partkey AS metadata FROM named""",
)
def attr_mapping_explicit(t: Tables) -> DataFrame:
    """Ids and metadata of line items whose attributes hold no ids, a bad trace id, a trace id only, that and a span id, or all three."""
    h = F.lower(F.lpad(F.hex(F.col("l_orderkey") + 1_700_000_000_000), 12, "0"))
    own = F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, -4, 4), F.lit("-7abc-9def-0123456789ab"))
    kind = F.col("l_linenumber") % 4
    given = {
        f"{VENDOR}.trace_id": F.when(kind > 0, own).when(F.col("l_linenumber") > 4, "not-an-id"), f"{VENDOR}.span_id": F.when(kind > 1, own),
        f"{VENDOR}.parent_span_id": F.when(kind != 2, F.when(kind == 1, "no-id").otherwise(own)),
        "gen_ai.tool.name": F.when(F.col("l_linenumber") == 1, "search"), f"{VENDOR}.metadata.part": F.col("l_partkey").cast("string"), "other": F.lit("x"),
    }
    flat = F.map_filter(F.create_map(*[x for name, column in given.items() for x in (F.lit(name), column)]), lambda _, v: v.isNotNull())
    line = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line")
    spans_ = t.table("lineitem").select(line, flat.alias("a"), F.concat(F.lit("s"), "l_linenumber").alias("s"), F.concat(F.lit("p"), "l_linenumber").alias("p"))
    ids = documents.choose_parent(F.col("a"), F.lit("native"), F.col("s"), F.col("p"), VENDOR)
    metadata = documents.map_span_attributes(F.col("a"), VENDOR)["metadata"]
    entries = F.array_sort(F.transform(F.map_entries(metadata), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return spans_.select("line", *[c.alias(n) for n, c in ids.items()], F.array_join(entries, ",").alias("metadata"))


@query(
    "assemble_traces",
    """SELECT 'o' || o_orderkey AS trace_id, 'order' AS name, o_orderpriority AS input, o_orderstatus AS output,
      least(o_orderdate, l.s) AS start_time, greatest(o_orderdate, coalesce(l.e, o_orderdate)) + INTERVAL 1 DAY AS end_time,
      1 + coalesce(l.n, 0) AS spans, coalesce(l.q, 0)::BIGINT AS input_tokens, coalesce(l.ln, 0)::BIGINT AS output_tokens, round(l.c, 6) AS cost
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, min(l_shipdate) AS s, max(l_shipdate) AS e, sum(l_quantity::BIGINT) AS q,
      sum(l_linenumber) AS ln, sum(l_discount) AS c FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey""",
)
def assemble_traces(t: Tables) -> DataFrame:
    typed = spans.read_attributes(t.line_spans.unionByName(t.order_spans), VENDOR).withColumn("thread_id", F.col("session_id"))
    traces = spans.assemble_traces(typed)
    return traces.select(
        "trace_id", "name", "input", "output", "start_time", "end_time", "spans", "input_tokens", "output_tokens", F.round("cost", 6).alias("cost")
    )


@query("trace_id_check", "SELECT count(DISTINCT l_orderkey) AS trace_ids FROM lineitem")
def trace_id_check(t: Tables) -> DataFrame:
    return spans.trace_id_check(t.line_spans)
