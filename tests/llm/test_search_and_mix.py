import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_support import SF, documents, rows  # noqa: F401
from tracelake.llm import mixing, topk_search
from tracelake.llm.topk_search import finite_vectors, voronoi_topk


def brute_topk(data, queries, k):
    found = []
    for q, x in queries:
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in data if i != q)
        found += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(found, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_voronoi_join_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(topk_search, "DATA_BLOCK", 40)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 5)
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 200, (4, 6))
    data = [(i, [float(v) for v in np.floor(middles[i % 4] + rng.normal(0, 20 + 60 * seed, 6))]) for i in range(160)]
    data += [(1000 + i, data[3][1]) for i in range(60)]  # one vector of a quarter of the rows
    frame = spark.createDataFrame(data, "id long, v array<double>")
    got = voronoi_topk(frame, frame.where("id % 8 = 0"), k=5)
    assert rows(got, "query_id", "rank", "vec_id", "score") == brute_topk(data, [d for d in data if d[0] % 8 == 0], 5)


def test_vectors_that_take_no_part(spark):
    data = [(1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    assert rows(finite_vectors(frame, "vec_id", "embedding"), "id") == [(1,), (6,)]


def test_few_rows_ties_and_repeats(spark):
    data = [(3, [1.0]), (1, [1.0]), (2, [1.0]), (2, [1.0])]
    frame = spark.createDataFrame(data, "id long, v array<double>")
    got = rows(voronoi_topk(frame, frame.where("id = 2"), k=5), "query_id", "rank", "vec_id", "score")
    assert got == [(2, 1, 1, 1.0), (2, 2, 3, 1.0)]
    none = frame.limit(0)
    assert voronoi_topk(none, none).count() == 0
    assert voronoi_topk(frame, none).count() == 0
    assert voronoi_topk(none, frame).count() == 0


def test_repeated_ids_on_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 1)
    rng = np.random.default_rng(3)
    middles = [(200, 0), (0, 200), (-200, 0), (0, -200)]
    data = [(i, [float(v) for v in np.floor(middles[i % 4] + rng.normal(0, 10, 2))]) for i in range(80)]
    data += [(900, [260.0, 0.0])] * 9 + [(901, [0.0, 260.0])] * 4 + [(901, [0.0, -260.0])] * 4 + [(8, data[8][1])] * 7
    frame = spark.createDataFrame(data, "id long, v array<double>")
    asked = [data[i] for i in (*range(40), 80, 89, 93)]
    got = voronoi_topk(frame, spark.createDataFrame(asked, "id long, v array<double>"), k=5)
    assert rows(got, "query_id", "rank", "vec_id", "score") == brute_topk(data, asked, 5)


def plain_targets(sizes, weights=(5, 2, 1)):
    """Water-filling as the contract states it: share the rest by weight until no source is above twice its size."""
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    budget, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = budget - sum(2 * sizes[n] for n in full)
        free = sum(weight[n] for n in names if n not in full) or 1
        target = {n: 2 * sizes[n] if n in full else left * weight[n] / free for n in names}
        over = {n for n in names if n not in full and target[n] > 2 * sizes[n]}
        if not over:
            return target
        full |= over


def test_mix_meets_targets(spark, documents):
    rng = random.Random(5)
    docs = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(["a", "b", "c", "d", None, "\U0001f600", "￿"])) for i in range(300)]
    docs += [(900, None, "a"), (901, "", "b"), (7, "x y", "a"), (7, "x y", "a"), (902, "long " * 4000, "c")]
    mixed = mixing.weighted_fair_mix(documents(docs))
    per = mixing.per_document(mixed).collect()
    assert len(per) == len(docs)
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = plain_targets(sizes)
    taken = {r[0]: (r[1], r[2]) for r in mixed.groupBy("source").agg(F.sum("taken"), F.max("target")).collect()}
    for source, target in want.items():
        assert math.isclose(taken[source][1], target, rel_tol=1e-9)
        assert abs(taken[source][0] - target) <= 1
    assert all(0 <= r.taken <= 2 * r["size"] for r in per)
    again = mixing.per_document(mixing.weighted_fair_mix(documents(docs[::-1])))
    assert rows(again, "doc_id", "taken") == sorted(((r.doc_id, r.taken) for r in per), key=repr)


def test_mix_order_is_the_clock(documents):
    docs = [(i, "w " * 10, "a" if i % 3 else "b") for i in range(60)]
    mixed = mixing.weighted_fair_mix(documents(docs)).orderBy("position", "finish").collect()
    finishes = [r.finish for r in mixed]
    assert finishes == sorted(finishes)
    at = 0
    for r in mixed:
        assert r.position == at
        at += r.taken
    assert 898 <= at <= 900


def test_mix_of_nothing(documents):
    assert mixing.weighted_fair_mix(documents([])).count() == 0
    only_empty = mixing.per_document(mixing.weighted_fair_mix(documents([(1, None, None), (2, "", "a")])))
    assert rows(only_empty, "doc_id", "taken") == [(1, 0), (2, 0)]
