"""Evaluation, leaderboard and trial queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.catalog.bindings import Tables
from tracelake.catalog.registry import mean_digits, query
from tracelake.functions import scoring
from tracelake.functions.text import ellipsis, format_amount, registry_url
from tracelake.operators import evaluation, tables
from tracelake.operators.metrics import MetricSpec

GLOBAL_ASSERTIONS = ["is long enough", "names nothing twice"]
METRIC_ROWS = ("pairs", "metric_rows")
LONG = """
    long AS (SELECT experiment_id, item_id, unnest(['accuracy', 'relevance', 'conciseness']) AS score_name,
      unnest([accuracy, relevance, conciseness]) AS value FROM metric_rows)"""


def _items(t: Tables) -> DataFrame:
    return t.pairs.select("item_id", "question", "expected_answer")


def _outputs(t: Tables) -> DataFrame:
    return t.pairs.select("experiment_id", "item_id", "output")


def _results(t: Tables) -> DataFrame:
    return evaluation.evaluate(_items(t), _outputs(t), evaluation.ANSWER_METRICS)


@query("metric_accuracy", "SELECT item_id, accuracy AS value FROM metric_rows", METRIC_ROWS)
def metric_accuracy(t: Tables) -> DataFrame:
    return t.pairs.select("item_id", scoring.accuracy(F.col("output"), F.col("expected_answer")).alias("value"))


@query("metric_relevance", "SELECT item_id, relevance AS value FROM metric_rows", METRIC_ROWS)
def metric_relevance(t: Tables) -> DataFrame:
    return t.pairs.select("item_id", scoring.relevance(F.col("output"), F.col("question")).alias("value"))


@query("metric_conciseness", "SELECT item_id, conciseness AS value FROM metric_rows", METRIC_ROWS)
def metric_conciseness(t: Tables) -> DataFrame:
    return t.pairs.select("item_id", scoring.conciseness(F.col("output")).alias("value"))


@query(
    "metric_equals",
    "SELECT trace_id, CASE WHEN answer = 'purchase' THEN 1.0 ELSE 0.0 END::DOUBLE AS value FROM traces",
    ("traces",),
)
def metric_equals(t: Tables) -> DataFrame:
    output, expected = F.get_json_object("output", "$.output"), F.get_json_object("input", "$.expected")
    return t.traces.select("trace_id", scoring.equals(output, expected).alias("value"))


@query("evaluate_metrics", f"WITH {LONG} SELECT experiment_id, item_id, score_name, value FROM long", METRIC_ROWS)
def evaluate_metrics(t: Tables) -> DataFrame:
    return _results(t).select("experiment_id", "item_id", "score_name", "value")


@query(
    "experiment_scores",
    """SELECT experiment_id, round(avg(accuracy) + 1e-9, 6) AS accuracy, round(avg(relevance) + 1e-9, 6) AS relevance,
      round(avg(conciseness) + 1e-9, 6) AS conciseness FROM metric_rows GROUP BY 1""",
    METRIC_ROWS,
)
def experiment_scores(t: Tables) -> DataFrame:
    names = ["accuracy", "relevance", "conciseness"]
    return evaluation.experiment_scores(_results(t), names).withColumns({n: mean_digits(F.col(n)) for n in names})


@query("score_names", f"WITH {LONG} SELECT DISTINCT score_name FROM long", METRIC_ROWS)
def score_names(t: Tables) -> DataFrame:
    return evaluation.score_names(_results(t))


@query(
    "experiment_stats",
    """SELECT project_id AS experiment_id, count(*) AS trace_count, round(sum(cost), 6) AS total_estimated_cost,
      round(avg(cost) + 1e-9, 6) AS total_estimated_cost_avg, round(quantile_cont(duration_ms, 0.5), 6) AS duration_p50,
      round(quantile_cont(duration_ms, 0.9), 6) AS duration_p90, round(quantile_cont(duration_ms, 0.99), 6) AS duration_p99
      FROM traces GROUP BY 1""",
    ("traces",),
)
def experiment_stats(t: Tables) -> DataFrame:
    stats = evaluation.experiment_stats(t.traces.withColumnRenamed("project_id", "experiment_id"))
    shown = {c: F.round(c, 6) for c in ("total_estimated_cost", "duration_p50", "duration_p90", "duration_p99")}
    return stats.withColumns({**shown, "total_estimated_cost_avg": mean_digits(F.col("total_estimated_cost_avg"))})


@query(
    "leaderboard",
    """SELECT experiment_id, quality, traces, model, rank() OVER (ORDER BY quality DESC) AS rank FROM (
      SELECT user_id AS experiment_id, round(avg(q) + 1e-9, 6) AS quality, count(*) AS traces, 'model-' || (user_id % 4) AS model
      FROM (SELECT e.user_id, t.q FROM traces t JOIN events e ON t.trace_id = e.event_id) GROUP BY user_id
      ORDER BY quality DESC NULLS LAST, experiment_id LIMIT 50)""",
    ("traces",),
)
def leaderboard(t: Tables) -> DataFrame:
    user = F.floor(F.col("thread_id") / 100)
    experiments = t.traces.groupBy(user.alias("experiment_id")).agg(
        mean_digits(F.avg(F.col("scores")["response_quality"])).alias("quality"), F.count("*").alias("traces")
    )
    config = F.create_map(F.lit("model"), F.concat(F.lit("model-"), F.col("experiment_id") % 4))
    configured = evaluation.with_config(experiments.withColumn("config", config), ["model"])
    board = evaluation.leaderboard(configured, "quality")
    chosen = evaluation.select_columns(board, ["experiment_id", "quality", "traces", "metadata.model", "rank"])
    return chosen.withColumnRenamed("metadata.model", "model")


@query(
    "pass_rate",
    r"""WITH checked AS (
      SELECT experiment_id, item_id, run, a, CASE a
        WHEN 0 THEN length(output) >= 100 * run WHEN 1 THEN len(list_distinct(w)) = len(w) OR run = 1
        ELSE contains(lower(output), lower(regexp_extract(question, '(\S+)', 1))) OR length(question) > 40 END AS passed
      FROM (SELECT *, regexp_extract_all(lower(output), '\S+') AS w FROM pairs), (SELECT unnest([1, 2]) AS run), (SELECT unnest([0, 1, 2]) AS a)),
    items AS (SELECT experiment_id, item_id, count(*) FILTER (ok) >= 2 AS ok FROM (
      SELECT experiment_id, item_id, run, bool_and(passed) AS ok FROM checked GROUP BY ALL) GROUP BY ALL)
    SELECT experiment_id, count(*) AS items, count(*) FILTER (ok) AS passed_items, round(avg(ok::INTEGER) + 1e-9, 6) AS pass_rate FROM items GROUP BY 1""",
    ("pairs",),
)
def pass_rate(t: Tables) -> DataFrame:
    words = F.regexp_extract_all(F.lower("output"), F.lit(r"(\S+)"), 1)
    first = F.regexp_extract("question", r"(\S+)", 1)
    suite = evaluation.expand_suite(t.pairs.withColumn("assertions", F.array(first)), GLOBAL_ASSERTIONS)
    length_ok = F.length("output") >= 100 * F.col("run")
    repeats_ok = (F.size(F.array_distinct(words)) == F.size(words)) | (F.col("run") == 1)
    names_ok = F.lower("output").contains(F.lower("assertion")) | (F.length("question") > 40)
    passed = F.when(F.col("assertion_no") == 0, length_ok).when(F.col("assertion_no") == 1, repeats_ok).otherwise(names_ok)
    return evaluation.pass_rate(suite.withColumn("passed", passed)).withColumn("pass_rate", mean_digits(F.col("pass_rate")))


TRIALS = """
    drawn AS (SELECT *, row_number() OVER (PARTITION BY trial ORDER BY md5('trial:' || trial || ':' || item_id), item_id) AS n
      FROM metric_rows, (SELECT unnest(range(1, 13)) AS trial))"""


@query("sample_items", f"WITH {TRIALS} SELECT trial::INTEGER AS trial, item_id FROM drawn WHERE n <= 8", METRIC_ROWS)
def sample_items(t: Tables) -> DataFrame:
    return evaluation.sample_items(t.pairs).select("trial", "item_id")


@query(
    "best_trial",
    f"""WITH {TRIALS}, means AS (SELECT trial, avg(relevance) AS score FROM drawn WHERE n <= 8 GROUP BY 1)
    SELECT round((SELECT score FROM means WHERE trial = 1) + 1e-9, 6) AS initial_score, trial::INTEGER AS best_trial, round(score + 1e-9, 6) AS best_score
    FROM means ORDER BY score DESC, trial LIMIT 1""",
    METRIC_ROWS,
)
def best_trial(t: Tables) -> DataFrame:
    relevance = MetricSpec("relevance", scoring.relevance, {"output": "output", "question": "question"})
    best = evaluation.best_trial(evaluation.score_trials(evaluation.sample_items(t.pairs), relevance))
    return best.withColumns({c: mean_digits(F.col(c)) for c in ("initial_score", "best_score")})


@query(
    "prompt_versions",
    "SELECT doc_id, source AS name, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS version FROM documents",
)
def prompt_versions(t: Tables) -> DataFrame:
    prompts = t.table("documents").select("doc_id", F.col("source").alias("name"))
    return tables.next_version(prompts, "name", "doc_id", ties=["doc_id"])


@query("head_split", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 400")
def head_split(t: Tables) -> DataFrame:
    return tables.head_split(t.table("documents").select("doc_id", "lang"), "doc_id", 400)


@query(
    "part_cards",
    """SELECT p_partkey, 'https://models.example/acme/model-registry/' || p_brand || '/' || p_size AS url,
      CASE WHEN length(p_name) > 12 THEN left(p_name, 12) || '...' ELSE p_name END AS title, '$' || format('{:,.2f}', p_retailprice) AS price FROM part""",
)
def part_cards(t: Tables) -> DataFrame:
    url = registry_url(F.lit("https://models.example"), F.lit("acme"), F.col("p_brand"), F.col("p_size").cast("string"))
    return t.table("part").select(
        "p_partkey", url.alias("url"), ellipsis(F.col("p_name"), 12, True).alias("title"), format_amount(F.col("p_retailprice"), 2).alias("price")
    )
