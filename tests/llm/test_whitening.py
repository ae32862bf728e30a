import math

import numpy as np
import pytest

from tests_support import SF, rng
from tracelake.llm import queries, whitening
from tracelake.llm.whitening import bidiagonal, integer_vectors, spectrum, whitened


@pytest.fixture
def vectors(spark):
    schema = "vec_id long, embedding array<float>, label int, id string, x string, __o0 int"
    return lambda found: spark.createDataFrame([(i, v, 0, "a", "b", 1) for i, v in found], schema)


def plain(found, components=8):
    """Whitening by whole-number sums and a dense symmetric eigenvalue routine."""
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in found], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    y = ((n * x - sums) / n).astype(float)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:components]
    deviation = [sum(int(d) ** 2 for d in row) for row in n * x - sums]
    return deviation, y @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def compare(got, found, components=8):
    deviation, w, explained = plain(found, components)
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r[0], {})[r.component] = r
    assert len(by_id) == len(found)
    signs = {}
    for row, (ident, _) in enumerate(found):
        assert sorted(by_id[ident]) == list(range(1, components + 1))
        for c, r in by_id[ident].items():
            sign = signs.setdefault(c, 1 if r.whitened * w[row, c - 1] >= 0 else -1)
            assert r.whitened == pytest.approx(sign * w[row, c - 1], abs=1e-8)
            assert r.explained == pytest.approx(explained[c - 1], rel=1e-9)
            assert (r.n, r.deviation) == (len(found), deviation[row])
            assert 0 <= r.identity_error < 1e-9


def test_query_equals_the_plain_version(spark):
    found = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compare(queries.QUERIES["op12_bidiagonal_whitening"](spark, SF), found)


def test_many_triangles_and_blocks(spark, vectors, monkeypatch):
    r = rng(3)
    found = [(i, [np.float32(r.gauss(0, 1 + j)).item() for j in range(10)]) for i in range(400)]
    monkeypatch.setattr(whitening, "BLOCK", 7)
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    compare(whitened(integer_vectors(vectors(found).repartition(23))), found)


def test_unfit_vectors_take_no_part(spark, vectors):
    r = rng(4)
    good = [(i if i else None, [r.uniform(-1, 1), r.uniform(-1, 1)]) for i in range(30)]
    good = [(i, [np.float32(c).item() for c in v]) for i, v in good]
    bad = [(90, None), (91, [1.0, None]), (92, [float("nan"), 1.0]), (93, [1.0, float("inf")]), (94, [float("-inf"), 0.0])]
    compare(whitened(integer_vectors(vectors(good + bad))), good, components=2)


def test_odd_tables(vectors):
    assert whitened(integer_vectors(vectors([]))).count() == 0
    assert whitened(integer_vectors(vectors([(1, [1.0, 2.0])] * 9))).count() == 0  # no variance at all
    assert whitened(integer_vectors(vectors([(1, [1.0, 2.0])]))).count() == 0
    assert whitened(integer_vectors(vectors([(1, []), (2, [])]))).count() == 0
    line = whitened(integer_vectors(vectors([(1, [0.0, 0.0]), (1, [1.0, 2.0]), (2, [2.0, 4.0])]))).collect()
    assert sorted((r.id, r.component) for r in line) == [(1, 1), (1, 1), (2, 1)]  # one direction, repeated ids each
    assert all(r.explained == pytest.approx(1) for r in line)
    padded = [(1, [1.0, 0.0, 0.0]), (2, [0.5, 2.0, 0.0]), (3, [0.0, 1.0, 7.0]), (4, [3.0, 1.0, 0.0])]
    short = [(i, v[:2] if v[2] == 0 and i != 1 else v) for i, v in padded]
    compare(whitened(integer_vectors(vectors(short))), padded, components=3)


def test_deviations_beyond_64_bits_are_null(spark):
    frame = spark.createDataFrame([(1, [0, 10**9]), (2, [5, 10**9 + 7]), (3, [1, 5 * 10**9]), (4, [1, 2 * 10**9])], "id long, x array<long>")
    out = {r.id: r for r in whitened(frame, 1).collect()}
    assert out[3].deviation is None and out[4].deviation is not None
    assert sum(r.whitened**2 for r in out.values()) / 4 == pytest.approx(1)


@pytest.mark.parametrize("kind", ["random", "graded", "rank", "equal", "near", "zero", "duplicate", "wide"])
def test_spectrum(kind):
    r = np.random.default_rng(1)
    a = r.standard_normal((200, 40))
    turned = np.linalg.qr(r.standard_normal((40, 40)))[0]
    a = {
        "random": a, "graded": a * np.logspace(0, -6, 40), "rank": a[:, :3] @ r.standard_normal((3, 40)), "equal": np.repeat([3.0, 1], 20)[:, None] * turned,
        "near": (np.repeat([3.0, 1], 20) * (1 + 1e-9 * r.standard_normal(40)))[:, None] * turned, "zero": np.zeros((9, 40)),
        "duplicate": np.hstack([np.rint(9 * a[:, :10])] * 4), "wide": a[:7],
    }[kind]
    triangle = np.linalg.qr(a, mode="r")
    triangle = np.vstack([triangle, np.zeros((40 - len(triangle), 40))])
    d, e, v = bidiagonal(triangle)
    scale = max(1e-300, np.abs(a).max()) * 40
    b = np.diag(d) + np.diag(e, 1)
    assert np.abs(v @ b.T @ b @ v.T - triangle.T @ triangle).max() <= 1e-13 * scale**2
    values, directions = spectrum(triangle, 8)
    want = np.concatenate([np.linalg.svd(a, compute_uv=False), np.zeros(40)])[:40]
    assert np.abs(values - want).max() <= 1e-13 * scale
    assert np.abs(directions.T @ directions - np.eye(8)).max() < 1e-11
    assert np.abs(a.T @ (a @ directions) - directions * values[:8] ** 2).max() <= 1e-13 * scale**2
