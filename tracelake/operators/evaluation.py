"""Offline evaluation: items, outputs, metrics, suites, experiment comparison and trials."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.distribution import exact_percentiles, seeded_key, spread_join
from tracelake.functions import scoring
from tracelake.operators.filters import apply_filters
from tracelake.operators.metrics import MetricSpec
from tracelake.session import small_frame

# The execution policy of a suite, row limits of the leaderboard, trial and sample counts.
RUNS_PER_ITEM = 2
PASS_THRESHOLD = 2
MAX_ROWS = 50
MAX_TRIALS = 12
SAMPLES_PER_TRIAL = 8

ANSWER_METRICS = [
    MetricSpec("accuracy", scoring.accuracy, {"output": "output", "expected": "expected_answer"}, scoring.accuracy_reason),
    MetricSpec("relevance", scoring.relevance, {"output": "output", "question": "question"}, scoring.relevance_reason),
    MetricSpec("conciseness", scoring.conciseness, {"output": "output"}, scoring.conciseness_reason),
]


def map_fields(df: DataFrame, mapping: Mapping[str, str | Column], keep: Sequence[str] = ()) -> DataFrame:
    """Dataset fields or task outputs under the names a metric asks for."""
    columns = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()]
    return df.select(*keep, *columns)


def run_task(items: DataFrame, task: Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
    """Apply a caller's batch task to the items, with its output and the latency per item."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            began = time.perf_counter()
            output = task(batch)
            spent = (time.perf_counter() - began) * 1000
            yield batch.assign(output=output, latency_ms=spent / max(len(batch), 1))

    fields = [*items.schema.fields, T.StructField("output", T.StringType()), T.StructField("latency_ms", T.DoubleType())]
    return items.mapInPandas(run, T.StructType(fields))


def evaluate(items: DataFrame, outputs: DataFrame, metrics: Sequence[MetricSpec], on: Sequence[str] = ("item_id",)) -> DataFrame:
    """Score every output of every experiment: one equi join, then metrics as columns of the same row.

    An item may have very many outputs, so its key is spread over several tasks, each output by itself.
    """
    spread = outputs.withColumn("__output", F.xxhash64("experiment_id", *on, F.to_json(F.struct(*outputs.columns))))
    joined = spread_join(spread, items, list(on), "inner", "__output").drop("__output")
    return score_long(joined, metrics, ["experiment_id", *on])


def score_long(df: DataFrame, metrics: Sequence[MetricSpec], keys: Sequence[str]) -> DataFrame:
    """Long result rows ``(keys, score_name, value, reason, failed)``; a metric without a value has failed."""
    entries = F.array(*[m.entry(df.columns) for m in metrics])
    return df.select(*keys, F.explode(entries).alias("s")).select(
        *keys, F.col("s.name").alias("score_name"), "s.value", "s.reason", F.col("s.value").isNull().alias("failed")
    )


def all_assertions(global_assertions: Sequence[str], own: Column) -> Column:
    """Global assertions followed by the item's own; repeats stay."""
    shared = F.array(*[F.lit(a) for a in global_assertions]).cast("array<string>")
    return F.concat(shared, F.coalesce(own, F.array().cast("array<string>")))


def expand_suite(items: DataFrame, global_assertions: Sequence[str], runs: int = RUNS_PER_ITEM) -> DataFrame:
    """One row per item, run and assertion."""
    assertions = items.withColumn("run", F.explode(F.sequence(F.lit(1), F.lit(runs))))
    return assertions.select("*", F.posexplode(all_assertions(global_assertions, F.col("assertions"))).alias("assertion_no", "assertion"))


def pass_rate(results: DataFrame, threshold: int = PASS_THRESHOLD, by: Sequence[str] = ("experiment_id",)) -> DataFrame:
    """Share of passed items. A run passes when all its assertions hold, an item when enough of its runs pass."""
    runs = results.groupBy(*by, "item_id", "run").agg(F.bool_and(F.coalesce("passed", F.lit(False))).alias("ok"))
    items = runs.groupBy(*by, "item_id").agg((F.count_if("ok") >= threshold).alias("ok"))
    return items.groupBy(*by).agg(
        F.count("*").alias("items"), F.count_if("ok").alias("passed_items"), F.avg(F.col("ok").cast("double")).alias("pass_rate")
    )


def experiment_scores(results: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean of each score per experiment, one row per experiment."""
    return results.where(~F.col("failed")).groupBy("experiment_id").pivot("score_name", list(names)).avg("value")


def score_names(results: DataFrame) -> DataFrame:
    return results.where(~F.col("failed")).select("score_name").distinct().orderBy("score_name")


def experiment_stats(traces: DataFrame, exact: bool = True) -> DataFrame:
    """Trace count, duration percentiles and cost per experiment."""
    shares = [0.5, 0.9, 0.99]
    totals = traces.groupBy("experiment_id").agg(
        F.count("*").alias("trace_count"),
        F.sum("cost").alias("total_estimated_cost"),
        F.avg("cost").alias("total_estimated_cost_avg"),
        F.percentile_approx("duration_ms", F.array(*[F.lit(s) for s in shares])).alias("__p"),
    )
    if not exact:
        columns = [F.col("__p")[i].alias(f"duration_p{round(s * 100)}") for i, s in enumerate(shares)]
        return totals.select(*[c for c in totals.columns if c != "__p"], *columns)
    marks = exact_percentiles(traces, ["experiment_id"], "duration_ms", shares)
    renamed = marks.select("experiment_id", *[F.col(f"p{round(s * 100)}").alias(f"duration_p{round(s * 100)}") for s in shares])
    return totals.drop("__p").join(renamed, "experiment_id", "left")


def pick(experiments: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Experiments from an explicit list of ids."""
    wanted = small_frame(experiments.sparkSession, [(str(i),) for i in ids], "experiment_id string")
    kind = experiments.schema["experiment_id"].dataType
    return experiments.join(wanted.select(F.col("experiment_id").cast(kind)), "experiment_id", "left_semi")


def filter_experiments(experiments: DataFrame, filters: Sequence[Mapping[str, object]]) -> DataFrame:
    return apply_filters(experiments, filters)


def with_config(experiments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Configuration entries as ``metadata.<key>`` columns."""
    return experiments.select("*", *[F.col("config")[k].alias(f"metadata.{k}") for k in keys])


def select_columns(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Columns chosen by id: bare names are fields, prefixed ones reach into ``scores``, ``experiment_scores`` or ``config``."""
    maps = {"feedback_scores": "scores", "experiment_scores": "experiment_scores", "metadata": "config"}
    chosen = []
    for ident in ids:
        prefix, _, name = ident.partition(".")
        if prefix in maps and name:
            source = F.col(maps[prefix])[name]
        else:
            source = F.col(f"`{ident}`")
        chosen.append(source.alias(ident))
    return df.select(*chosen)


def leaderboard(
    experiments: DataFrame, metric: str, desc: bool = True, max_rows: int = MAX_ROWS, ties: Sequence[str] = ("experiment_id",)
) -> DataFrame:
    """Best experiments by one metric, with rank. Ranking sees only the rows shown, which are at most ``max_rows``."""
    if not 1 <= max_rows <= 200:
        raise ValueError("max_rows must be between 1 and 200")
    key = F.col(f"`{metric}`")
    order = key.desc_nulls_last() if desc else key.asc_nulls_last()
    top = experiments.orderBy(order, *ties).limit(max_rows)
    return top.withColumn("rank", F.rank().over(Window.orderBy(order))).orderBy("rank", *ties)


def sample_items(items: DataFrame, trials: int = MAX_TRIALS, n: int = SAMPLES_PER_TRIAL, item_id: str = "item_id") -> DataFrame:
    """``n`` items for each trial, drawn by a seeded shuffle of their ids; only drawn items are read with their texts."""
    drawn = items.select(item_id, F.explode(F.sequence(F.lit(1), F.lit(trials))).alias("trial"))
    key = seeded_key(F.concat_ws(":", F.col("trial"), F.col(item_id)), "trial")
    order = Window.partitionBy("trial").orderBy(key, item_id)
    chosen = drawn.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= n).drop("__n")
    return items.join(chosen.distinct(), item_id).select(*items.columns, "trial")


def score_trials(trials: DataFrame, metric: MetricSpec) -> DataFrame:
    return trials.withColumn("score", metric.value(trials.columns))


def best_trial(scored: DataFrame) -> DataFrame:
    """First trial's mean score and the best trial; of equal ones the earliest wins."""
    means = scored.groupBy("trial").agg(F.avg("score").alias("score"))
    return means.agg(
        F.min_by("score", "trial").alias("initial_score"),
        F.max_by("trial", F.struct("score", -F.col("trial"))).alias("best_trial"),
        F.max("score").alias("best_score"),
    )
