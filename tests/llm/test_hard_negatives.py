import numpy as np
import pandas as pd
import pytest

from tests_support import rng, rows
from tracelake.llm import hard_negatives as module
from tracelake.llm.hard_negatives import hard_negatives, tagged_vectors
from tracelake.llm.vectors import packed

OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(data, anchors, positives=5, negatives=3, low=50, high=95):
    out = []
    for a, label, v in sorted({(i, t, tuple(w)) for i, t, w in anchors}):
        scored = sorted((-int(np.dot(v, w)), i, t) for i, t, w in data)
        same = [(i, -s) for s, i, t in scored if t == label and i != a][:positives]
        for p, ps in same:
            fit = [(i, -s) for s, i, t in scored if t != label and low * ps <= -100 * s <= high * ps][:negatives]
            out += [(a, p, n, i, ps, s) for n, (i, s) in enumerate(fit, 1)]
    return sorted(out, key=repr)


@pytest.fixture
def frame(spark):
    return lambda found: spark.createDataFrame([(i, t, [float(c) for c in v]) for i, t, v in found], "id long, label long, v array<double>")


def clustered(r, n, centres=6, width=8):
    middle = [[r.randint(-200, 200) for _ in range(width)] for _ in range(centres)]
    return [(i, r.randrange(4), [c + r.randint(-25, 25) for c in middle[r.randrange(centres)]]) for i in range(n)]


@pytest.mark.parametrize("tree, piece", [(4096, 32_768), (5, 60), (1, 20)])
def test_equals_comparing_all_pairs(frame, monkeypatch, tree, piece):
    monkeypatch.setattr(module, "TREE", tree)
    monkeypatch.setattr(module, "PIECE", piece)
    data = clustered(rng(1), 400)
    data += [(1000 + i, t, v) for i, t, v in data[:30]]  # equal scores
    asked = data[::9]
    assert rows(hard_negatives(frame(data), frame(asked)), *OUT) == brute(data, asked)


def test_one_label_may_hold_most_rows(frame, monkeypatch):
    monkeypatch.setattr(module, "TREE", 8)
    monkeypatch.setattr(module, "PIECE", 64)
    r = rng(2)
    data = [(i, 0 if r.random() < 0.8 else i, v) for i, _, v in clustered(r, 300)]
    assert rows(hard_negatives(frame(data), frame(data[::11])), *OUT) == brute(data, data[::11])


def test_repeats_ties_and_windows(frame):
    up, down = [10, 0], [-10, 0]
    data = [(1, 0, up), (2, 0, up), (2, 0, up), (3, 1, [9, 0]), (3, 1, [9, 0]), (4, 1, [5, 0]), (5, 1, [4, 9]), (6, 2, down), (7, 2, up), (8, 3, [0, 0]), (9, 3, [0, 0]), (10, 4, [1])]
    asked = [(1, 0, up), (1, 0, up), (6, 2, down), (8, 3, [0, 0]), (10, 4, [1])]
    padded = [(i, t, [*v, 0][:2]) for i, t, v in data]
    assert rows(hard_negatives(frame(data), frame(asked)), *OUT) == brute(padded, [(i, t, [*v, 0][:2]) for i, t, v in asked])


def test_empty_tables_and_lonely_anchors(frame):
    some = [(1, 0, [1, 2]), (2, 1, [3, 4])]
    assert hard_negatives(frame([]), frame(some)).count() == 0
    assert hard_negatives(frame(some), frame([])).count() == 0
    assert hard_negatives(frame(some), frame(some)).count() == 0  # no positives
    assert hard_negatives(frame([]), frame([])).columns == OUT


def test_unfit_rows_take_no_part(spark):
    found = [(1, [1.0, 0.5], 1), (2, None, 1), (3, [1.0, None], 1), (4, [float("nan"), 1.0], 1), (5, [1.0, float("inf")], 1), (6, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (7, [-0.001, 0.0], 2)]
    df = spark.createDataFrame([(*r, "x", "y") for r in found], "vec_id long, embedding array<float>, label int, id string, v string")
    assert rows(tagged_vectors(df), "id", "label", "v") == [(1, 1, [256.0, 128.0]), (7, 2, [-1.0, 0.0])]


def walked(anchors, data, window):
    """Share of rows that a tree scores again below its root."""
    tree = pd.DataFrame({"tree": 0, "a": range(len(anchors)), "id": 0, "label": 0, "v": packed(anchors).to_pylist()})
    tree = module._span(anchors.shape[1])(tree)
    scored = 0
    norm = np.linalg.norm(data, axis=1)
    for i, chosen, scores in module._walk(tree, data, norm, anchors.shape[1], lambda i, lows, highs: (highs >= window[0]) & (lows <= window[1])):
        exact = data @ anchors[i]
        assert set(np.flatnonzero((exact >= window[0]) & (exact <= window[1]))) <= set(chosen)
        assert np.allclose(scores, exact[chosen])
        scored += len(chosen) if tree["parent"][i] >= 0 else 0
    return scored / (len(data) * (len(anchors) - 1))


def test_bounds_save_most_scores_where_anchors_are_near():
    r = np.random.default_rng(5)
    anchors = np.rint(1000 + 5 * r.standard_normal((60, 16)))
    data = np.rint(300 * r.standard_normal((2000, 16)))
    scores = data @ anchors.T
    assert walked(anchors, data, (np.quantile(scores, 0.95), np.quantile(scores, 0.99))) < 0.2


def test_trees_are_minimal_and_walk_with_few_bounds():
    r = np.random.default_rng(6)
    x = r.integers(-50, 50, (40, 3)).astype(float)
    tree = module._span(3)(pd.DataFrame({"tree": 0, "a": range(40), "id": 0, "label": 0, "v": packed(x).to_pylist()}))
    gaps = np.linalg.norm(x[:, None] - x[None], axis=2)
    joined, total = {0}, 0.0
    while len(joined) < 40:
        d, j = min((gaps[i, j], j) for i in joined for j in range(40) if j not in joined)
        joined.add(j)
        total += d
    assert tree["edge"].sum() == pytest.approx(total)
    assert (tree["parent"] < 0).sum() == 1
