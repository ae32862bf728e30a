import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tracelake import distribution as D
from tracelake.session import materialise, shared_dir


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows; one group key is null."""
    draw = random.Random(1)
    start = datetime(2026, 1, 1)
    data = [(i, draw.choice(["hot"] * 8 + ["a", None]), start + timedelta(seconds=draw.randrange(5000)), draw.randrange(100)) for i in range(600)]
    return spark.createDataFrame(data, "id long, g string, ts timestamp, v int").cache()


def test_ordered_index_equals_row_number(skewed):
    indexed = D.ordered_total(skewed, F.col("ts"), ["id"], "n", ["g"], splits=16)
    digest = F.md5(F.col("id").cast("string"))
    expected = skewed.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("ts", digest, "id")) - 1)
    assert rows(indexed, "id", "n") == rows(expected, "id", "n")


def test_a_frequent_order_value_is_split(skewed):
    same = skewed.withColumn("v", F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("v")))
    indexed = D.ordered_total(same, F.col("v"), ["id"], "n", splits=16)
    digest = F.md5(F.col("id").cast("string"))
    expected = same.withColumn("n", F.row_number().over(Window.orderBy("v", digest, "id")) - 1)
    assert rows(indexed, "id", "n") == rows(expected, "id", "n")
    assert "substring(__digest" in indexed._jdf.queryExecution().optimizedPlan().toString()


def test_running_weight(skewed):
    total = D.ordered_total(skewed, F.col("id"), [], "before", weight=F.col("v"))
    found = {r.id: r.before for r in total.collect()}
    values = {r.id: r.v for r in skewed.collect()}
    assert found == {i: sum(values[j] for j in range(i)) for i in values}


def test_shuffled_index_is_dense_and_seeded(skewed):
    first = D.shuffled_index(skewed, "id", 1, "n")
    assert sorted(r.n for r in first.collect()) == list(range(600))
    assert rows(first, "id", "n") == rows(D.shuffled_index(skewed.repartition(7), "id", 1, "n"), "id", "n")
    assert rows(first, "id", "n") != rows(D.shuffled_index(skewed, "id", 2, "n"), "id", "n")


def test_empty_input(skewed):
    none = skewed.limit(0)
    assert D.ordered_total(none, F.col("ts"), ["id"], "n", ["g"]).isEmpty()
    assert D.exact_percentiles(none, ["g"], "v", [0.5]).isEmpty()


def test_joins_with_hot_keys(spark, skewed):
    dim = spark.createDataFrame([("hot", 1), ("a", 2), ("unused", 3)], "g string, w int")
    plain = skewed.join(dim, "g", "left")
    assert rows(D.spread_join(skewed, dim, ["g"], "left", "id"), "id", "w") == rows(plain, "id", "w")
    assert rows(D.heavy_join(skewed, dim, "g", "left", "id", parts=3), "id", "w") == rows(plain, "id", "w")
    assert rows(D.heavy_join(skewed, dim, "g", "inner", "id", parts=3), "id", "w") == rows(skewed.join(dim, "g"), "id", "w")
    assert rows(D.heavy_keys(skewed, "g", 2)) == [("hot",)]
    assert D.heavy_keys(skewed.withColumn("g", F.lit(None).cast("string")), "g").isEmpty()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40))
def test_percentiles(spark, values):
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, v double")
    found = D.exact_percentiles(df, ["g"], "v", [0.5, 0.9]).first()
    assert found.p50 == pytest.approx(np.percentile(values, 50), abs=1e-6)
    assert found.p90 == pytest.approx(np.percentile(values, 90), abs=1e-6)


def test_percentiles_of_a_null_group(skewed):
    found = {r.g: r.p50 for r in D.exact_percentiles(skewed, ["g"], "v", [0.5]).collect()}
    for key in ("hot", "a", None):
        assert found[key] == pytest.approx(np.percentile([r.v for r in skewed.collect() if r.g == key], 50))


def test_shared_folder_comes_from_the_session(spark, skewed):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert rows(materialise(skewed, "t"), "id") == rows(skewed, "id")


def test_no_window_gathers_all_rows(skewed):
    plan = D.shuffled_index(skewed, "id", 1, "n")._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    assert len(wide) <= 1, "only the bucket totals may meet in one task"


def test_ranges_give_the_same_order_as_buckets(spark, monkeypatch):
    data = spark.range(500).selectExpr("id", "id % 3 AS g", "CAST(id % 7 AS INT) AS v", "concat('t', id % 7) AS t", "id % 5 AS w")
    by_number = rows(D.ordered_total(data, F.col("v"), ["id"], "n", ["g"], F.col("w")), "id", "n")
    assert rows(D.ordered_total(data, F.col("t"), ["id"], "n", ["g"], F.col("w")), "id", "n") == by_number
    monkeypatch.setattr(D, "ROWS_PER_RANGE", 7)
    assert rows(D.ordered_total(data, F.col("v"), ["id"], "n", ["g"], F.col("w"), splits=4), "id", "n") == by_number
    assert rows(D.ordered_total(data, F.col("t"), ["id"], "n", ["g"], F.col("w")), "id", "n") == by_number
    assert D.ordered_total(data.limit(0), F.col("t"), ["id"], "n").isEmpty()
