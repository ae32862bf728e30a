"""Annotation queue and call queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.catalog.bindings import Tables
from tracelake.catalog.registry import query
from tracelake.functions.text import join_items
from tracelake.operators import calls, queues, threads

QUEUES = ["Team A", "Team B", "Team C"]


@query(
    "round_robin",
    """SELECT trace_id, ['Team A', 'Team B', 'Team C'][(n % 3) + 1] AS queue FROM (
      SELECT trace_id, row_number() OVER (ORDER BY md5('7:' || trace_id), trace_id) - 1 AS n FROM traces)""",
    ("traces",),
)
def round_robin(t: Tables) -> DataFrame:
    return queues.assign_round_robin(t.traces.select("trace_id"), QUEUES, 7).select("trace_id", "queue")


@query(
    "enqueue_once",
    "SELECT DISTINCT project AS queue, trace_id FROM traces WHERE len(tags) > 1 OR q < 0.6",
    ("traces",),
)
def enqueue_once(t: Tables) -> DataFrame:
    tagged = t.traces.where(F.size("tags") > 1).select(F.col("project").alias("queue"), "trace_id")
    poor = t.traces.where(F.col("scores")["response_quality"] < 0.6).select(F.col("project").alias("queue"), "trace_id")
    return queues.enqueue(tagged, poor)


@query(
    "enrich_context",
    """WITH ctx AS (SELECT name AS question, 'seen ' || count(*) AS context FROM traces WHERE name <> 'error' GROUP BY 1)
    SELECT trace_id, context, CASE WHEN context IS NULL THEN 3 ELSE 4 END AS fields FROM traces LEFT JOIN ctx ON name = question""",
    ("traces",),
)
def enrich_context(t: Tables) -> DataFrame:
    contexts = t.traces.where("name <> 'error'").groupBy(F.col("name").alias("question")).agg(
        F.concat(F.lit("seen "), F.count("*")).alias("context")
    )
    enriched = queues.enrich(t.traces.select("trace_id", "input", "metadata"), contexts)
    return enriched.select("trace_id", F.col("metadata")["dataset_context"].alias("context"), F.size("metadata").alias("fields"))


@query(
    "lookup_default",
    "SELECT doc_id, source, coalesce(s_name, 'N/A') AS s_name FROM documents LEFT JOIN supplier ON source = 'src' || s_suppkey AND s_acctbal > 0",
)
def lookup_default(t: Tables) -> DataFrame:
    names = t.table("supplier").where("s_acctbal > 0").select(F.concat(F.lit("src"), "s_suppkey").alias("source"), "s_name")
    return queues.lookup_default(t.table("documents").select("doc_id", "source"), names, "source", "s_name", F.lit("N/A"), "doc_id")


@query(
    "restructure",
    """SELECT trace_id, answer AS output, '["' || project || '","' || name || '"]' AS context, '["p","n"]' AS sources FROM (
      SELECT *, '{"output":"' || answer || '"}' AS o FROM traces)""",
    ("traces",),
)
def restructure(t: Tables) -> DataFrame:
    docs = F.array(
        F.struct(F.col("project").alias("text"), F.lit("p").alias("source")), F.struct(F.col("name").alias("text"), F.lit("n").alias("source"))
    )
    answer = F.to_json(F.struct(F.get_json_object("output", "$.output").alias("answer")))
    shaped = queues.restructure(t.traces.withColumns({"docs": docs, "output": answer}))
    meta = F.col("metadata")
    return shaped.select("trace_id", "output", meta["retrieved_context"].alias("context"), meta["sources"].alias("sources"))


@query(
    "category_default",
    """SELECT doc_id AS id, CASE lang WHEN 'en' THEN 'sales' WHEN 'de' THEN 'support' ELSE 'other' END AS category_name
      FROM documents WHERE lang IN ('en', 'de', 'fr')""",
)
def category_default(t: Tables) -> DataFrame:
    known, _ = calls.with_category(t.calls, calls.default_categories(t.spark))
    return known.select("id", "category_name")


@query("category_unknown", "SELECT doc_id AS id, 'billing' AS category FROM documents WHERE lang NOT IN ('en', 'de', 'fr')")
def category_unknown(t: Tables) -> DataFrame:
    _, unknown = calls.with_category(t.calls, calls.default_categories(t.spark))
    return unknown.select("id", "category")


@query(
    "call_prompts",
    """SELECT doc_id AS id, md5('Summarize the following ' || CASE lang WHEN 'en' THEN 'sales' WHEN 'de' THEN 'support' ELSE 'other' END
      || ' call.' || chr(10) || chr(10) || 'Transcript:' || chr(10) || text) AS prompt FROM documents WHERE lang IN ('en', 'de', 'fr')""",
)
def call_prompts(t: Tables) -> DataFrame:
    known, _ = calls.with_category(t.calls, calls.default_categories(t.spark))
    return calls.call_prompts(known).select("id", F.md5("prompt").alias("prompt"))


@query(
    "categories",
    "SELECT DISTINCT CASE lang WHEN 'en' THEN 'Sales' WHEN 'de' THEN 'support' WHEN 'fr' THEN '' ELSE 'billing' END AS category FROM documents",
)
def categories(t: Tables) -> DataFrame:
    return calls.categories_of(t.calls)


@query(
    "action_items",
    r"""SELECT doc_id, len(list_distinct(items)) AS items, length(array_to_string([x FOR x, i IN items IF list_position(items, x) = i], chr(10))) AS joined
      FROM (SELECT doc_id, [x FOR x IN [regexp_replace(y, '^\s+|\s+$', '', 'g') FOR y IN string_split(trim(text), '-')] IF x <> ''] AS items FROM documents)""",
)
def action_items(t: Tables) -> DataFrame:
    parsed = calls.with_action_items(t.table("documents"), "text")
    return parsed.select("doc_id", F.size("action_items").cast("long").alias("items"), F.length(join_items(F.col("action_items"))).cast("long").alias("joined"))


@query(
    "thread_parts",
    """SELECT conv_id, 0 AS part, count(*)::INTEGER AS turns, md5(string_agg(text, chr(10) ORDER BY turn, text)) AS conversation, 1 AS parts
      FROM conversations GROUP BY 1""",
)
def thread_parts(t: Tables) -> DataFrame:
    parts = threads.thread_parts(t.table("conversations"), 200, "conv_id")
    return parts.withColumn("conversation", F.md5("conversation"))


@query(
    "thread_parts_long",
    """SELECT conv_id, part, count(*)::INTEGER AS turns, md5(string_agg(text, chr(10) ORDER BY turn, text)) AS conversation,
        max(parts) AS parts FROM (
      SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, md5(text), text) - 1) // 2 AS part, (count(*) OVER (PARTITION BY conv_id) + 1) // 2 AS parts
      FROM conversations) GROUP BY conv_id, part""",
)
def thread_parts_long(t: Tables) -> DataFrame:
    """Conversations cut into parts of two turns."""
    parts = threads.thread_parts(t.table("conversations"), 2, "conv_id")
    return parts.withColumn("conversation", F.md5("conversation"))
