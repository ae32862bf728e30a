import pytest
from conftest import rows
from pyspark.sql import functions as F

from tracelake.functions import scoring
from tracelake.operators import evaluation as E
from tracelake.operators import tables
from tracelake.operators.metrics import MetricSpec, row_metric

ITEMS = [
    ("1", "What is the colour of rust?", "orange"),
    ("2", "How many legs has a crab?", "ten"),
    ("3", "Which bird cannot fly?", "ostrich"),
]
OUTPUTS = [
    ("B", "1", "orange"),
    ("A", "1", "The colour of rust is orange"),
    ("B", "2", "ten"),
    ("A", "2", "A crab has ten legs"),
    ("B", "3", "none"),
    ("A", "3", "An ostrich."),
]


@pytest.fixture(scope="module")
def results(spark):
    items = spark.createDataFrame(ITEMS, "item_id string, question string, expected_answer string")
    outputs = spark.createDataFrame(OUTPUTS, "experiment_id string, item_id string, output string")
    return E.evaluate(items, outputs, E.ANSWER_METRICS).cache()


def test_metrics(results):
    found = {(r.experiment_id, r.item_id, r.score_name): r.value for r in results.collect()}
    assert found[("A", "1", "relevance")] == 1.0
    assert found[("B", "1", "relevance")] == 0.0
    assert found[("B", "1", "conciseness")] == 1.133
    assert found[("A", "1", "conciseness")] == 0.967
    assert found[("B", "3", "accuracy")] == 0.0
    assert found[("A", "3", "relevance")] == 0.0


def test_punctuation_stays_on_output_words(spark):
    df = spark.createDataFrame([("paris, is", "is Paris?"), ("", "")], "o string, q string")
    found = df.select(scoring.relevance(F.col("o"), F.col("q")), scoring.relevance_reason(F.col("o"), F.col("q"))).collect()
    assert [tuple(r) for r in found] == [(0.0, "Keyword overlap: 0/1"), (0.0, "Keyword overlap: 0/0")]


def test_long_answer_is_not_negative(spark):
    df = spark.createDataFrame([(" ".join(["w"] * 60),)], "o string")
    assert df.select(scoring.conciseness(F.col("o"))).first()[0] == 0.0


def test_leaderboard(results):
    board = E.leaderboard(E.experiment_scores(results, ["accuracy", "relevance"]), "accuracy")
    assert rows(board, "rank", "experiment_id") == [(1, "A"), (2, "B")]
    assert rows(E.leaderboard(board.drop("rank"), "accuracy", desc=False, max_rows=1), "rank", "experiment_id") == [(1, "B")]
    assert [r[0] for r in E.score_names(results).collect()] == ["accuracy", "conciseness", "relevance"]
    with pytest.raises(ValueError):
        E.leaderboard(board, "accuracy", max_rows=201)


def test_ties_and_nulls_in_rank(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 0.5), ("d", None)], "experiment_id string, m double")
    assert [(r.experiment_id, r["rank"]) for r in E.leaderboard(df, "m").collect()] == [("a", 1), ("b", 1), ("c", 3), ("d", 4)]


def test_columns_by_id(spark):
    df = spark.createDataFrame([("e", {"acc": 1.0}, {"model": "m"})], "experiment_id string, scores map<string,double>, config map<string,string>")
    shown = E.select_columns(df, ["experiment_id", "feedback_scores.acc", "metadata.model"])
    assert shown.columns == ["experiment_id", "feedback_scores.acc", "metadata.model"]
    assert rows(shown) == [("e", 1.0, "m")]
    assert E.with_config(df, ["model"]).columns[-1] == "metadata.model"
    assert E.pick(df, ["e", "x"]).count() == 1 and E.pick(df, ["x"]).count() == 0
    assert E.filter_experiments(df, [{"field": "experiment_id", "operator": "contains", "value": "e"}]).count() == 1


def test_pass_rate(spark):
    items = spark.createDataFrame([("i1", ["own"]), ("i2", None)], "item_id string, assertions array<string>")
    suite = E.expand_suite(items, ["g", "own"]).withColumn("experiment_id", F.lit("x"))
    assert suite.count() == 10
    fails = (F.col("item_id") == "i2") & (F.col("run") == 2) & (F.col("assertion") == "g")
    assert rows(E.pass_rate(suite.withColumn("passed", ~fails))) == [("x", 2, 1, 0.5)]
    assert rows(E.pass_rate(suite.withColumn("passed", ~fails), threshold=1)) == [("x", 2, 2, 1.0)]


def test_python_metric_and_failures(spark):
    def score(output, reference):
        if output == "boom":
            raise ValueError("bad row")
        return (1.0 if output == reference else 0.0), "compared"

    spec = MetricSpec("eq", row_metric(score), {"output": "output", "reference": "reference"}, python=True)
    df = spark.createDataFrame([("1", "a", "a"), ("2", "a", "b"), ("3", "boom", "b")], "item_id string, output string, reference string")
    found = {r.item_id: (r.value, r.reason, r.failed) for r in E.score_long(df, [spec], ["item_id"]).collect()}
    assert found == {"1": (1.0, "compared", False), "2": (0.0, "compared", False), "3": (None, "bad row", True)}


def test_task_and_mapping(spark):
    items = spark.createDataFrame([("1", "hi"), ("2", "yo")], "item_id string, question string")
    done = E.run_task(items, lambda batch: batch["question"].str.upper())
    assert rows(done, "item_id", "output") == [("1", "HI"), ("2", "YO")]
    assert done.where("latency_ms < 0").count() == 0
    assert E.map_fields(items, {"input": "question"}, ["item_id"]).columns == ["item_id", "input"]


def test_trials(spark):
    items = spark.createDataFrame([(str(i),) for i in range(30)], "item_id string")
    drawn = E.sample_items(items, trials=3, n=8)
    assert [r["count"] for r in drawn.groupBy("trial").count().collect()] == [8, 8, 8]
    assert rows(drawn) == rows(E.sample_items(items, trials=3, n=8))
    scored = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.9)], "trial int, score double")
    assert rows(E.best_trial(scored)) == [(0.5, 2, 0.9)]


def test_tables(spark):
    base = spark.createDataFrame([("a", 1, None), ("b", 2, "x")], "k string, v int, w string")
    assert rows(tables.insert_absent(base, base.withColumn("v", F.lit(9)), "k")) == rows(base)
    changed = spark.createDataFrame([("a", None, "new")], base.schema)
    assert rows(tables.patch(base, changed, "k")) == [("a", 1, "new"), ("b", 2, "x")]
    assert rows(tables.upsert(base, changed, "k")) == [("a", None, "new"), ("b", 2, "x")]
    assert tables.tables_equal(base, base) and not tables.tables_equal(base, base.union(base.limit(1)))
    assert rows(tables.insert_items(base, [{"k": "c"}]), "k") == [("a",), ("b",), ("c",)]
    versions = spark.createDataFrame([("p", 3), ("p", 1), ("q", 5)], "name string, created_at int")
    assert rows(tables.next_version(versions, ties=["created_at"])) == [("p", 1, 1), ("p", 3, 2), ("q", 5, 1)]
    with pytest.raises(ValueError):
        tables.next_version(versions, ties=[])
