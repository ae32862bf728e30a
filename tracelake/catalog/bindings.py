"""Views that give the test tables the shape of traces, scores, spans and conversations, in Spark and in SQL."""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.operators.rules import RULE_LEVELS

AS_OF = datetime(2024, 1, 31)

TTL_RULES = [
    {"tags": ["load-test"], "older_than_days": 6},
    {"tags": ["replay"], "older_than_days": 12},
    {"tags": ["beta"], "older_than_days": 18},
    {"tags": [], "older_than_days": 24, "description": "nothing that a tag names"},
]

VENDOR = "acme"


_TRACE_COLUMNS = [
    "event_id AS trace_id",
    "user_id % 6 AS project_id",
    "concat('proj', user_id % 6) AS project",
    "event_type AS name",
    "ts AS start_time",
    "value AS duration_ms",
    "value / 10000 AS cost",
    "user_id * 100 + day(ts) AS thread_id",
    """array_compact(array(if(event_id % 3 = 0, 'governance', null), if(event_id % 5 = 0, 'beta', null),
      if(event_id % 7 = 0, 'load-test', null), if(event_id % 4 = 0, 'replay', null))) AS tags""",
    "map('prompt_tokens', bigint(k * 10), 'completion_tokens', bigint(k)) AS usage",
    "k >= 95 AS guardrail_failed",
    """map('env', get(array('prod', 'staging', 'dev'), int(user_id % 3)),
      'risk_tier', if(event_id % 11 <> 0, get(array('high', 'medium', 'low'), int(k % 3)), null),
      'business_unit', get(array('retail', 'commercial', 'wealth'), int(event_id % 3))) AS metadata""",
    """map('hallucination_rate', k / 100, 'response_quality', if(event_id % 10 <> 0, 1 - value / 500, null),
      'regulatory_compliance', if(event_id % 4 <> 1, (100 - k) / 100, null), 'cost_usd', value / 10000) AS scores""",
    "to_json(named_struct('question', event_type, 'expected', 'purchase')) AS input",
    "to_json(named_struct('output', if(k < 50, event_type, 'purchase'))) AS output",
]


def as_traces(events: DataFrame) -> DataFrame:
    """Traces from events; a projection, so it is the same for a table and a stream."""
    return events.selectExpr("*", "int(get_json_object(props, '$.k')) AS k").selectExpr(*_TRACE_COLUMNS)


class Tables:
    """Lazily read tables and views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        schema = self.table(name).schema
        return self.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(self.folder)

    @cached_property
    def traces(self) -> DataFrame:
        return as_traces(self.table("events"))

    @cached_property
    def trace_stream(self) -> DataFrame:
        return as_traces(self.stream("events"))

    @cached_property
    def projects(self) -> DataFrame:
        return self.table("nation").select(F.col("n_nationkey").cast("long").alias("id"), F.concat(F.lit("proj"), "n_nationkey").alias("name"))

    @cached_property
    def pairs(self) -> DataFrame:
        """Each user turn with the assistant turn that follows it. Joined on the turn number, so a conversation of any
        length is spread over tasks."""
        turns = self.table("conversations")
        asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
        answered = turns.where(F.col("role") == "assistant").select(
            "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
        )
        first = F.regexp_extract("output", r"(\S+)", 1)
        return asked.join(answered, ["conv_id", "turn"]).select(
            (F.col("conv_id") % 3).alias("experiment_id"),
            F.concat_ws("-", "conv_id", "turn").alias("item_id"),
            "question",
            "output",
            F.when(F.col("conv_id") % 2 == 0, first).otherwise("zzz").alias("expected_answer"),
        )

    @cached_property
    def tree(self) -> DataFrame:
        """Region, nation, customer and order as the spans of one single trace."""
        region = self.table("region").select(F.concat(F.lit("r"), "r_regionkey").alias("span_id"), F.lit(None).cast("string").alias("parent_span_id"))
        nation = self.table("nation").select(F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey"))
        customer = self.table("customer").select(F.concat(F.lit("c"), "c_custkey"), F.concat(F.lit("n"), "c_nationkey"))
        orders = self.table("orders").select(F.concat(F.lit("o"), "o_orderkey"), F.concat(F.lit("c"), "o_custkey"))
        return region.union(nation).union(customer).union(orders).select(F.lit("t0").alias("trace_id"), "*")

    @cached_property
    def line_spans(self) -> DataFrame:
        """Line items as spans with flat attributes."""
        pairs = {
            "gen_ai.request.model": F.when(F.col("l_returnflag") == "A", "model-a"),
            "gen_ai.response.model": F.when(F.col("l_returnflag") != "R", "model-b"),
            "gen_ai.system": F.col("l_linestatus"),
            "gen_ai.usage.input_tokens": F.col("l_quantity").cast("int").cast("string"),
            "gen_ai.usage.output_tokens": F.col("l_linenumber").cast("string"),
            "gen_ai.usage.cost": F.col("l_discount").cast("string"),
            "gen_ai.tool.name": F.when(F.col("l_linenumber") == 1, "search"),
            f"{VENDOR}.metadata.part": F.col("l_partkey").cast("string"),
            f"{VENDOR}.tags": F.when(F.col("l_returnflag") == "N", '["new","open"]'),
            "input": F.when(F.col("l_linenumber") == 2, F.col("l_linestatus")),
        }
        flat = F.create_map(*[x for name, column in pairs.items() for x in (F.lit(name), column)])
        return self.table("lineitem").select(
            F.concat(F.lit("o"), "l_orderkey").alias("trace_id"),
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("span_id"),
            F.concat(F.lit("o"), "l_orderkey").alias("parent_span_id"),
            F.col("l_orderkey").alias("session_id"),
            F.lit("line").alias("name"),
            F.col("l_shipdate").alias("start_time"),
            (F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("end_time"),
            F.map_filter(flat, lambda _, v: v.isNotNull()).alias("attributes"),
        )

    @cached_property
    def order_spans(self) -> DataFrame:
        return self.table("orders").select(
            F.concat(F.lit("o"), "o_orderkey").alias("trace_id"),
            F.concat(F.lit("o"), "o_orderkey").alias("span_id"),
            F.lit(None).cast("string").alias("parent_span_id"),
            F.col("o_orderkey").alias("session_id"),
            F.lit("order").alias("name"),
            F.col("o_orderdate").alias("start_time"),
            (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("end_time"),
            F.create_map(F.lit("input"), F.col("o_orderpriority"), F.lit("output"), F.col("o_orderstatus")).alias("attributes"),
        )

    @cached_property
    def calls(self) -> DataFrame:
        category = F.when(F.col("lang") == "en", "Sales").when(F.col("lang") == "de", "support").when(F.col("lang") == "fr", "")
        return self.table("documents").select(
            F.col("doc_id").alias("id"), F.col("text").alias("transcript"), category.otherwise("billing").alias("category")
        )

    @cached_property
    def rules(self) -> DataFrame:
        """One rule per nation: the even ones judge, the odd ones compute a metric."""
        content = F.concat(F.lit("Q {{question}} A {{answer}} {{other}}"), F.col("n_nationkey").cast("string"))
        variables = {"question": "input.question", "answer": "output.output"}
        return self.rules_of("trace", content, variables, {"output": F.lit("output.output"), "reference": F.lit("input.expected")})

    def rules_of(self, level: str, content: Column, variables: dict[str, str] | None, arguments: dict[str, Column]) -> DataFrame:
        """One rule per nation on a level (thread rules judge only): judges with one message, metrics with these arguments."""
        key = F.col("n_nationkey")
        judge = F.lit(level == "thread") | (key % 2 == 0)
        kinds = [t for t, of in RULE_LEVELS.items() if of == level]
        given = F.create_map(*[F.lit(x) for pair in variables.items() for x in pair]) if variables else F.lit(None).cast("map<string,string>")
        mapped = F.create_map(*[x for name, path in arguments.items() for x in (F.lit(name), path)]) if arguments else F.lit(None).cast("map<string,string>")
        return self.table("nation").select(
            F.concat(F.lit("rule"), key).alias("rule_id"),
            F.col("n_name").alias("name"),
            F.when(judge, kinds[0]).otherwise(kinds[-1]).alias("type"),
            F.array((key % 6).cast("string"), ((key + 1) % 6).cast("string")).alias("project_ids"),
            ((key % 5) / 4).alias("sampling_rate"),
            (key % 7 != 0).alias("enabled"),
            F.when(judge, F.array(F.struct(F.lit("USER").alias("role"), content.alias("content")))).alias("messages"),
            F.when(judge, F.array(F.struct(F.lit("size").alias("name"), F.lit("INTEGER").alias("type"), F.lit("").alias("description")))).alias("schema"),
            F.when(judge, given).alias("variables"),
            F.when(~judge, "equals_metric").alias("metric"),
            F.when(~judge, mapped).alias("arguments"),
        )

    @cached_property
    def label_queries(self) -> DataFrame:
        """Mean embedding of each label."""
        spread = self.table("embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
        means = spread.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
        ordered = F.array_sort(F.collect_list(F.struct("i", "m")))
        return means.groupBy(F.col("label").alias("query_id")).agg(F.transform(ordered, lambda e: e["m"]).alias("embedding"))


SQL_VIEWS = {
    "traces": """
        SELECT event_id AS trace_id, user_id % 6 AS project_id, 'proj' || (user_id % 6) AS project, event_type AS name,
          ts AS start_time, value AS duration_ms, value / 10000 AS cost, user_id * 100 + day(ts) AS thread_id,
          [x FOR x IN [CASE WHEN event_id % 3 = 0 THEN 'governance' END, CASE WHEN event_id % 5 = 0 THEN 'beta' END,
            CASE WHEN event_id % 7 = 0 THEN 'load-test' END, CASE WHEN event_id % 4 = 0 THEN 'replay' END] IF x IS NOT NULL] AS tags,
          k, k * 10 AS prompt_tokens, k AS completion_tokens, k >= 95 AS guardrail_failed,
          ['prod', 'staging', 'dev'][user_id % 3 + 1] AS env,
          CASE WHEN event_id % 11 <> 0 THEN ['high', 'medium', 'low'][k % 3 + 1] END AS risk_tier,
          ['retail', 'commercial', 'wealth'][event_id % 3 + 1] AS business_unit,
          k / 100 AS h, CASE WHEN event_id % 10 <> 0 THEN 1 - value / 500 END AS q,
          CASE WHEN event_id % 4 <> 1 THEN (100 - k) / 100 END AS c, value / 10000 AS cost_usd,
          CASE WHEN k < 50 THEN event_type ELSE 'purchase' END AS answer
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "scores": """
        SELECT t.*, s.name AS score, s.value AS score_value FROM traces t, LATERAL (
          SELECT 'hallucination_rate' AS name, h AS value UNION ALL SELECT 'response_quality', q
          UNION ALL SELECT 'regulatory_compliance', c UNION ALL SELECT 'cost_usd', cost_usd) s
        WHERE s.value IS NOT NULL""",
    "projects": "SELECT CAST(n_nationkey AS BIGINT) AS id, 'proj' || n_nationkey AS name FROM nation",
    "ttl": """
        SELECT * FROM (VALUES
          (0, 'tag=''load-test'', >6d old', TIMESTAMP '2024-01-25', 'load-test'),
          (1, 'tag=''replay'', >12d old', TIMESTAMP '2024-01-19', 'replay'),
          (2, 'tag=''beta'', >18d old', TIMESTAMP '2024-01-13', 'beta'),
          (3, 'nothing that a tag names', TIMESTAMP '2024-01-07', NULL)) v(rule_no, label, cutoff, tag)""",
    "matches": """
        SELECT t.*, r.rule_no, r.label FROM traces t JOIN ttl r ON t.start_time <= r.cutoff AND
          CASE WHEN r.tag IS NOT NULL THEN list_contains(t.tags, r.tag)
            ELSE NOT list_has_any(t.tags, ['beta', 'load-test', 'replay']) END""",
    "pairs": r"""
        SELECT a.conv_id % 3 AS experiment_id, a.conv_id || '-' || a.turn AS item_id, a.text AS question, b.text AS output,
          CASE WHEN a.conv_id % 2 = 0 THEN regexp_extract(b.text, '(\S+)', 1) ELSE 'zzz' END AS expected_answer
        FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
        WHERE a.role = 'user' AND b.role = 'assistant'""",
    "metric_rows": r"""
        SELECT *, CASE WHEN contains(lower(output), lower(expected_answer)) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS accuracy,
          round(least(1.0, len(list_intersect(kw, list_distinct(regexp_extract_all(lower(output), '\S+')))) / greatest(len(kw), 1)), 3) AS relevance,
          round(greatest(0.0, 1.0 - (len(regexp_extract_all(output, '\S+')) - 5) / 30), 3) AS conciseness
        FROM (SELECT *, list_distinct([trim(w, '?') FOR w IN regexp_extract_all(lower(question), '\S+')
          IF w NOT IN ('what', 'is', 'the', 'of', 'who', 'did', 'in', 'a', 'an')]) AS kw FROM pairs)""",
    "rules": """
        SELECT 'rule' || n_nationkey AS rule_id, n_nationkey AS key, n_nationkey % 2 = 0 AS judge, (n_nationkey % 5) / 4 AS rate,
          unnest([n_nationkey % 6, (n_nationkey + 1) % 6]) AS project_id FROM nation WHERE n_nationkey % 7 <> 0""",
    "routed": """
        SELECT t.*, r.rule_id, r.key, r.judge FROM traces t JOIN rules r ON t.project_id = r.project_id
        WHERE CAST('0x' || left(md5('sample:' || t.trace_id || ':' || r.rule_id), 8) AS BIGINT) / 4294967296 < r.rate""",
    "line_spans": """
        SELECT 'o' || l_orderkey AS trace_id, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS span_id,
          'o' || l_orderkey AS parent_span_id, l_orderkey AS session_id, * FROM lineitem""",
    "centroids": """
        SELECT label, list(m ORDER BY i) AS v FROM (
          SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM (
            SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i)
        GROUP BY label""",
    "ranked": """
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM (
          SELECT c.label AS query_id, e.vec_id AS id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.v), 6) AS similarity
          FROM centroids c, embeddings e)""",
}
