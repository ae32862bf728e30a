"""Online evaluation rule queries, over stored and arriving traces."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.catalog.bindings import Tables
from tracelake.catalog.registry import query
from tracelake.functions import scoring
from tracelake.operators import rules, threads
from tracelake.operators.metrics import MetricSpec
from tracelake.session import scratch_path
from tracelake.streaming import arrivals, late_scores

METRICS = {
    "equals_metric": MetricSpec("equals_metric", scoring.equals, {"output": "output.output", "reference": "input.expected"})
}
ROUTED = ("traces", "rules", "routed")
PROMPT = "'USER: Q ' || name || ' A ' || answer || ' {{other}}' || key"
SCORES = """SELECT trace_id, rule_id, 'equals_metric' AS name, CASE WHEN answer = 'purchase' THEN 1.0 ELSE 0.0 END::DOUBLE AS value
  FROM routed WHERE NOT judge"""


@query("rule_sampling", "SELECT trace_id, rule_id FROM routed", ROUTED)
def rule_sampling(t: Tables) -> DataFrame:
    return rules.route_rules(t.traces, t.rules).select("trace_id", "rule.rule_id")


@query("rule_prompts", f"SELECT trace_id, rule_id, {PROMPT} AS prompt FROM routed WHERE judge", ROUTED)
def rule_prompts(t: Tables) -> DataFrame:
    bound, known = rules.bind_paths(t.traces, t.rules.where(F.col("type").isin(rules.JUDGE_TYPES)))
    return rules.rule_prompts(rules.route_rules(bound, known)).select("trace_id", "rule.rule_id", "prompt")


@query(
    "rule_arguments",
    """SELECT trace_id, rule_id, 'equals_metric' AS name,
      CASE WHEN answer = CASE key % 3 WHEN 0 THEN 'purchase' WHEN 1 THEN name ELSE env END THEN 1.0 ELSE 0.0 END::DOUBLE AS value FROM routed WHERE NOT judge""",
    ROUTED,
)
def rule_arguments(t: Tables) -> DataFrame:
    """One metric under rules that compare the answer with the expected one, with the question, or with an entry of the metadata."""
    key = F.col("n_nationkey") % 3
    reference = F.when(key == 0, "input.expected").when(key == 1, "input.question").otherwise("metadata.env")
    mapped = t.rules_of("trace", F.lit(""), {}, {"reference": reference})
    return rules.score_batch(t.traces, mapped, METRICS).select("trace_id", "rule_id", "name", "value")


@query(
    "rule_metadata_prompts",
    """SELECT trace_id, rule_id, 'USER: ' || env || '/' || coalesce(risk_tier, '') || ': ' || name || ' {{none}}' AS prompt FROM routed WHERE judge""",
    ROUTED,
)
def rule_metadata_prompts(t: Tables) -> DataFrame:
    """Judge prompts whose variables lead into a map, where a key may be missing, and to a plain column."""
    made = t.rules_of("trace", F.lit("{{env}}/{{tier}}: {{what}} {{none}}"), {"env": "metadata.env", "tier": "metadata.risk_tier", "what": "name"}, {})
    bound, known = rules.bind_paths(t.traces, made.where(F.col("type").isin(rules.JUDGE_TYPES)))
    return rules.rule_prompts(rules.route_rules(bound, known)).select("trace_id", "rule.rule_id", "prompt")


@query(
    "span_rule_scores",
    """SELECT span_id, rule_id, name, value FROM (
      SELECT s.span_id, r.rule_id, CASE WHEN r.judge THEN 'size' ELSE 'equals_metric' END AS name,
        CASE WHEN r.judge THEN length('USER: ' || l_returnflag || ' of ' || l_linestatus) WHEN l_returnflag = l_linestatus THEN 1 ELSE 0 END::DOUBLE AS value
      FROM line_spans s JOIN rules r ON s.l_partkey % 6 = r.project_id
      WHERE CAST('0x' || left(md5('sample:' || s.span_id || ':' || r.rule_id), 8) AS BIGINT) / 4294967296 < r.rate)""",
    ("line_spans", "rules"),
)
def span_rule_scores(t: Tables) -> DataFrame:
    """Span rules, judges and metrics, over all line items as spans."""
    line = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    spans = line.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("span_id"), (F.col("l_partkey") % 6).alias("project_id"),
        F.to_json(F.struct(F.struct(F.col("l_linestatus").alias("status")).alias("line"))).alias("input"), F.to_json(F.struct(F.col("l_returnflag").alias("flag"))).alias("output"),
    )
    paths = {"flag": "output.flag", "status": "input.line.status"}
    made = t.rules_of("span", F.lit("{{flag}} of {{status}}"), paths, {"output": F.lit("output.flag"), "reference": F.lit("input.line.status")})
    return rules.score_spans(spans, made, METRICS, _size_judge).select("span_id", "rule_id", "name", "value")


@query("rule_scores_batch", SCORES, ROUTED)
def rule_scores_batch(t: Tables) -> DataFrame:
    return rules.score_batch(t.traces, t.rules, METRICS).select("trace_id", "rule_id", "name", "value")


def _size_judge(prompts):
    """Stand-in for a judge model: scores a prompt by its length."""
    return prompts.map(lambda p: f'{{"size": {len(p)}}}')


@query(
    "rule_scores_judged",
    f"{SCORES} UNION ALL SELECT trace_id, rule_id, 'size', CAST(length({PROMPT}) AS DOUBLE) FROM routed WHERE judge",
    ROUTED,
)
def rule_scores_judged(t: Tables) -> DataFrame:
    return rules.score_batch(t.traces, t.rules, METRICS, _size_judge).select("trace_id", "rule_id", "name", "value")


@query("rule_scores_stream", SCORES, ROUTED)
def rule_scores_stream(t: Tables) -> DataFrame:
    scored = arrivals.score_stream(t.trace_stream, t.rules, METRICS)
    return arrivals.run_available(scored.select("trace_id", "rule_id", "name", "value"), "scores")


@query(
    "rule_errors",
    """SELECT s_suppkey, unnest([x FOR x IN [CASE WHEN s_acctbal < 0 THEN 'sampling_rate must be between 0.0 and 1.0' END,
      CASE WHEN s_suppkey % 3 = 0 THEN 'unknown rule type' END,
      CASE WHEN s_suppkey % 3 = 1 THEN 'a thread judge takes no variables' END,
      CASE WHEN s_suppkey % 3 = 2 AND s_suppkey % 4 = 0 THEN 'a metric rule needs metric and arguments' END,
      CASE WHEN s_suppkey % 3 = 1 AND s_suppkey % 5 = 0 THEN 'schema types are BOOLEAN, INTEGER and DOUBLE' END] IF x IS NOT NULL]) AS error
    FROM supplier""",
)
def rule_errors(t: Tables) -> DataFrame:
    key = F.col("s_suppkey")
    kind = F.when(key % 3 == 0, "poem").when(key % 3 == 1, "trace_thread_llm_as_judge").otherwise("user_defined_metric_python")
    field = F.struct(F.lit("x").alias("name"), F.when(key % 5 == 0, "STRING").otherwise("DOUBLE").alias("type"), F.lit("").alias("description"))
    made = t.table("supplier").select(
        key.cast("string").alias("rule_id"), F.col("s_name").alias("name"), kind.alias("type"), F.array(F.lit("1")).alias("project_ids"),
        (F.col("s_acctbal") / 1e6).alias("sampling_rate"), F.lit(True).alias("enabled"),
        F.array(F.struct(F.lit("USER").alias("role"), F.lit("hi").alias("content"))).alias("messages"), F.array(field).alias("schema"),
        F.create_map(F.lit("a"), F.lit("b")).alias("variables"), F.when(key % 4 != 0, "equals_metric").alias("metric"),
        F.create_map(F.lit("a"), F.lit("b")).alias("arguments"),
    )
    return rules.rule_errors(made).select(F.col("rule_id").cast("long").alias("s_suppkey"), "error")


@query(
    "rules_upsert",
    """SELECT 'r' || s_suppkey AS rule_id, s_name AS name, CASE WHEN s_acctbal < 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS sampling_rate, 'true' AS enabled FROM supplier
    UNION ALL SELECT 'new' || s_suppkey, NULL, 0.5, 'unset' FROM supplier WHERE s_acctbal < 0""",
)
def rules_upsert(t: Tables) -> DataFrame:
    base = t.table("supplier").select(
        F.concat(F.lit("r"), "s_suppkey").alias("rule_id"), F.col("s_name").alias("name"), F.lit(1.0).alias("sampling_rate"), F.lit(True).alias("enabled")
    )
    poor = t.table("supplier").where("s_acctbal < 0")
    ids = [F.concat(F.lit(p), "s_suppkey") for p in ("r", "new")]
    changes = poor.select(F.explode(F.array(*ids)).alias("rule_id"), F.lit(0.5).alias("sampling_rate"))
    return rules.rules_upsert(base, changes).withColumn("enabled", F.coalesce(F.col("enabled").cast("string"), F.lit("unset")))


@query(
    "stream_daily",
    """SELECT project, start, count(*) AS traces, round(avg(cost) + 1e-9, 6) AS mean FROM (
        SELECT *, date_trunc('day', start_time)::TIMESTAMP AS start FROM traces)
      WHERE start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2""",
    ("traces",),
)
def stream_daily(t: Tables) -> DataFrame:
    daily = arrivals.run_available(arrivals.tumbling_metrics(t.trace_stream), "daily")
    return daily.select("project", F.col("start").cast("timestamp_ntz").alias("start"), "traces", F.round(F.col("mean") + 1e-9, 6).alias("mean"))


@query(
    "stream_lookback",
    """SELECT t.project, w.s AS start, count(*) AS traces, round(avg(t.cost) + 1e-9, 6) AS mean FROM traces t JOIN (
        SELECT unnest(generate_series(date_trunc('day', min(ts)) - INTERVAL 9 DAY, max(ts), INTERVAL 1 DAY)) AS s FROM events) w
      ON t.start_time >= w.s AND t.start_time < w.s + INTERVAL 7 DAY
      WHERE w.s + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2""",
    ("traces",),
)
def stream_lookback(t: Tables) -> DataFrame:
    moved = arrivals.run_available(arrivals.sliding_metrics(t.trace_stream, "7 days", "1 day"), "lookback")
    return moved.select("project", F.col("start").cast("timestamp_ntz").alias("start"), "traces", F.round(F.col("mean") + 1e-9, 6).alias("mean"))


@query("stream_dedup", "SELECT DISTINCT thread_id FROM traces", ("traces",))
def stream_dedup(t: Tables) -> DataFrame:
    seen = arrivals.dedup_stream(t.trace_stream.select("thread_id", "start_time"), "thread_id")
    return arrivals.run_available(seen.select("thread_id"), "dedup")


SESSIONS = """
    sessions AS (SELECT thread_id, min(start_time) AS start, max(start_time) + INTERVAL 30 MINUTE AS "end", count(*) AS traces FROM (
      SELECT thread_id, start_time, sum(fresh) OVER (PARTITION BY thread_id ORDER BY start_time, trace_id ROWS UNBOUNDED PRECEDING) AS n FROM (
        SELECT *, CASE WHEN start_time > lag(start_time) OVER (PARTITION BY thread_id ORDER BY start_time, trace_id) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh
        FROM traces)) GROUP BY thread_id, n)"""


def _session_columns(df: DataFrame) -> DataFrame:
    return df.select("thread_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("start", "end")], "traces")


@query("thread_sessions", f"WITH {SESSIONS} SELECT * FROM sessions", ("traces",))
def thread_sessions(t: Tables) -> DataFrame:
    return _session_columns(threads.thread_sessions(t.traces))


@query(
    "stream_sessions",
    f"""WITH {SESSIONS} SELECT * FROM sessions WHERE "end" <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
    ("traces",),
)
def stream_sessions(t: Tables) -> DataFrame:
    return _session_columns(arrivals.run_available(arrivals.session_stream(t.trace_stream), "sessions"))


THREADS = f"""
    turns AS (SELECT *, length('USER: {{"question":""}}') + length(name) + length(',"expected":"purchase"') + length(chr(10) || 'ASSISTANT: {{"output":""}}') + length(answer) AS long FROM traces),
    talks AS (SELECT project_id, thread_id, min(start_time) AS first, max(start_time) AS last, sum(long) + count(*) - 1 AS long FROM (
      SELECT *, sum(fresh) OVER (PARTITION BY project_id, thread_id ORDER BY start_time, trace_id ROWS UNBOUNDED PRECEDING) AS n FROM (
        SELECT *, CASE WHEN start_time > lag(start_time) OVER (PARTITION BY project_id, thread_id ORDER BY start_time, trace_id) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh
        FROM turns)) GROUP BY project_id, thread_id, n)
    SELECT thread_id, first, rule_id, 'size' AS name, (length('USER: Judge  by ' || key) + long)::DOUBLE AS value, false AS failed FROM talks JOIN (
      SELECT 'rule' || n_nationkey AS rule_id, n_nationkey AS key, (n_nationkey % 5) / 4 AS rate, unnest([n_nationkey % 6, (n_nationkey + 1) % 6]) AS project_id
      FROM nation WHERE n_nationkey % 7 <> 0) r USING (project_id)
    WHERE CAST('0x' || left(md5('sample:' || thread_id || ':' || rule_id), 8) AS BIGINT) / 4294967296 < rate"""


def _thread_rules(t: Tables) -> DataFrame:
    return t.rules_of("thread", F.concat(F.lit("Judge {{context}} by "), F.col("n_nationkey").cast("string")), None, {})


def _thread_columns(df: DataFrame) -> DataFrame:
    return df.select("thread_id", F.col("first").cast("timestamp_ntz").alias("first"), "rule_id", "name", "value", "failed")


@query("thread_rule_scores", f"WITH {THREADS}", ("traces",))
def thread_rule_scores(t: Tables) -> DataFrame:
    return _thread_columns(threads.thread_scores(t.traces, _thread_rules(t), _size_judge))


@query("thread_rule_scores_stream", f"WITH {THREADS} AND last + INTERVAL 30 MINUTE <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)", ("traces",))
def thread_rule_scores_stream(t: Tables) -> DataFrame:
    """The same judges on closed sessions of the stream."""
    base = scratch_path(t.spark, "thread-scores")
    running = arrivals.judge_threads(t.trace_stream, lambda: t.traces, _thread_rules(t), _size_judge, f"{base}/rows", f"{base}/state")
    running.awaitTermination()
    return _thread_columns(t.spark.read.parquet(f"{base}/rows"))


@query("stream_assign", "SELECT 'review' AS queue, trace_id FROM traces WHERE q < 0.6", ("traces",))
def stream_assign(t: Tables) -> DataFrame:
    rows = arrivals.enqueue_stream(t.trace_stream, "review", F.col("scores")["response_quality"] < 0.6)
    return arrivals.run_available(rows, "assign")


@query("assign_exactly_once", "SELECT 'review' AS queue, trace_id, 1::BIGINT AS times FROM traces WHERE q < 0.6", ("traces",))
def assign_exactly_once(t: Tables) -> DataFrame:
    """Two writers take the same stream to one table, and a batch of the first is delivered again: what the table then holds."""
    base = scratch_path(t.spark, "assignments")
    rows = arrivals.enqueue_stream(t.trace_stream, "review", F.col("scores")["response_quality"] < 0.6, "start_time")
    for writer in ("a", "b"):
        arrivals.write_assignments(rows, f"{base}/rows", f"{base}/{writer}", writer).awaitTermination()
    again = arrivals.enqueue_stream(t.traces, "review", F.col("scores")["response_quality"] < 0.6, "start_time")
    arrivals.add_assignments(again, f"{base}/rows", "a", 0)
    return t.spark.read.parquet(f"{base}/rows").groupBy("queue", "trace_id").agg(F.count("*").alias("times"))


@query(
    "late_composites",
    """WITH marked AS (SELECT trace_id, start_time, h, c, q, trace_id % 50 AS c_late, trace_id % 40 AS h_late, trace_id % 90 AS q_late,
        date_trunc('day', start_time) < (SELECT date_trunc('day', max(ts)) FROM events) AS closed FROM traces)
      SELECT trace_id, round(0.5 * c + 0.3 * (1.0 - h) + 0.2 * coalesce(q, 0.8), 4) AS composite, h IS NOT NULL AND c IS NOT NULL AND q IS NOT NULL AS complete
      FROM marked WHERE closed OR (h IS NOT NULL AND c IS NOT NULL AND q IS NOT NULL AND q_late <= 60)""",
    ("traces",),
)
def late_composites(t: Tables) -> DataFrame:
    """Composites of a stream whose scores come up to 90 minutes after their trace, an hour being waited for. All days but the
    last are corrected; of the last one the complete ones count."""
    minutes = {"regulatory_compliance": 50, "hallucination_rate": 40, "response_quality": 90}

    def scores(traces: DataFrame) -> DataFrame:
        late = F.create_map(*[x for name, m in minutes.items() for x in (F.lit(name), F.col("trace_id") % m)])
        rows = traces.select("trace_id", "start_time", F.explode("scores").alias("name", "value")).where(F.col("name").isin(list(minutes)))
        return rows.select("trace_id", "name", "value", (F.col("start_time").cast("timestamp") + F.make_dt_interval(mins=late[F.col("name")].cast("int"))).alias("ts"))

    base = scratch_path(t.spark, "composites")
    rows = late_scores.composite_stream(t.trace_stream, scores(t.trace_stream))
    arrivals.write_rows(rows.withColumn("trace_id", F.col("trace_id").cast("string")), f"{base}/arrived", f"{base}/state").awaitTermination()
    begin, end = t.traces.agg(F.to_date(F.min("start_time")), F.to_date(F.max("start_time"))).first()
    named = t.traces.withColumn("trace_id", F.col("trace_id").cast("string"))
    late_scores.correct_days(named, scores(t.traces).withColumn("trace_id", F.col("trace_id").cast("string")), begin, end - timedelta(days=1), f"{base}/final")
    found = late_scores.current_composites(t.spark, f"{base}/arrived", f"{base}/final")
    counted = found.where(F.col("complete") | (F.to_date("start_time") < F.lit(end)))
    return counted.select(F.col("trace_id").cast("long").alias("trace_id"), "composite", "complete")
