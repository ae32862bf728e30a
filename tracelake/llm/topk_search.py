"""Exact top-k by inner product as a Voronoi join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracelake.session import materialise

#: Rows of the sample that pivots come from, and pivots. They steer which groups meet, not the result.
SAMPLE = 2048
PIVOTS = 64
#: Queries of a group and data rows of a piece that one task compares.
QUERY_BLOCK = 1000
DATA_BLOCK = 20_000
#: Query groups that have bounds of their own; groups of more queries are dealt into blocks that share them.
QUERY_GROUPS = 64


def finite_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id`` and ``v`` (doubles) of the rows that take part: vector not null, no null or non-finite component."""
    finite = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return df.where(F.col(vec_col).isNotNull() & finite & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))


def voronoi_topk(data: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """For each query the ``k`` rows of ``data`` with the highest inner product, all rows if fewer: ``query_id``,
    ``rank`` (from 1), ``vec_id``, ``score``. Both frames have ``id`` and ``v`` as ``finite_vectors`` gives them.

    Data and queries go to the cell of their nearest pivot. Each data cell is summed up by its k + 1 ids
    nearest to the pivot and their distances. From these follows, for each query group, a score that its k-th neighbour reaches
    for certain; a data row is sent to a group only if its own distance to its pivot lets it reach that score. Each
    group is then solved in pieces of bounded size, and the pieces' best k are merged. What the driver sees is bounded
    by ``PIVOTS`` and ``QUERY_GROUPS``.

    A row is no neighbour of a query with the same id. Equal scores go to the smaller id. A shorter vector counts as
    padded with zeros. A repeated data row counts as one neighbour each; a query repeated with the same id and vector
    is asked once. Scores are exact while they fit 53 bits. Without queries or data the result is empty.
    """
    size = data.agg(F.max(F.size("v")), F.count("*")).first()
    asked = queries.dropDuplicates(["id", "v"])
    wide = asked.agg(F.max(F.size("v")), F.count("*")).first()
    width = max(size[0] or 0, wide[0] or 0, 1)
    sample = data.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    pivots = _pivots(_padded([r.v for r in sample], width), PIVOTS)
    groups = pivots[: max(1, min(QUERY_GROUPS, len(pivots), -(-wide[1] // QUERY_BLOCK)))]
    cells = materialise(data.mapInArrow(_assign(pivots, width), "id long, cell int, distance double, v binary"), "topk-data")
    asked = materialise(asked.mapInArrow(_assign(groups, width), "id long, cell int, distance double, v binary"), "topk-queries")
    near = F.row_number().over(Window.partitionBy("cell").orderBy("distance", "id"))
    by_id = cells.groupBy("cell", "id").agg(F.min("distance").alias("distance"))
    nearest = by_id.select("cell", "id", "distance", near.alias("n")).where(F.col("n") <= k + 1).collect()  # PIVOTS x (k + 1) numbers
    bounds = asked.groupBy("cell").agg(F.max("distance").alias("radius"), F.count("*").alias("n")).collect()
    reach = _reach(pivots, groups, nearest, {r.cell: r.radius for r in bounds}, k)
    pieces = {c: max(1, -(-size[1] // DATA_BLOCK)) for c in reach}
    blocks = {r.cell: max(1, -(-r.n // QUERY_BLOCK)) for r in bounds}
    sent = cells.mapInArrow(_replicate(reach, pieces, blocks), "grp int, piece int, block int, id long, v binary")
    spread = F.create_map(*[F.lit(int(x)) for g in reach for x in (g, pieces[g])]) if reach else F.create_map(F.lit(0), F.lit(1))
    block = F.create_map(*[F.lit(int(x)) for g in reach for x in (g, blocks[g])]) if reach else F.create_map(F.lit(0), F.lit(1))
    asked = asked.select(
        F.col("cell").alias("grp"),
        F.explode(F.sequence(F.lit(0), spread[F.col("cell")] - 1)).alias("piece"),
        F.pmod(F.xxhash64("id"), block[F.col("cell")]).cast("int").alias("block"),
        F.col("id").alias("id"),
        "v",
    )
    solved = asked.groupBy("grp", "piece", "block").cogroup(sent.groupBy("grp", "piece", "block")).applyInPandas(
        _solve(k, width), "query_id long, __query long, vec_id long, score double"
    )
    rank = F.row_number().over(Window.partitionBy("query_id", "__query").orderBy(F.desc("score"), "vec_id"))
    return solved.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _padded(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Well-spread rows of the sample: each next pivot is the row farthest from those before."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    chosen = [0]
    gap = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < count and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def _assign(pivots: np.ndarray, width: int):
    """Nearest pivot and the distance to it, with vectors packed as padded doubles."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _padded(batch.column("v").to_pylist(), width)
            gaps = np.stack([np.linalg.norm(vectors - p, axis=1) for p in pivots], axis=1)
            cell = gaps.argmin(axis=1)
            packed = pa.array([v.tobytes() for v in vectors], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cell, pa.int32()), pa.array(gaps[np.arange(len(cell)), cell], pa.float64()), packed], ["id", "cell", "distance", "v"]
            )

    return assign


def _reach(pivots: np.ndarray, groups: np.ndarray, nearest: list, radius: dict[int, float], k: int) -> dict[int, np.ndarray]:
    """For each query group, the distance to its pivot from which on a row of each data cell may be needed.

    With g the group's pivot, u its radius and p a data pivot: q.x lies within g.p -+ (u |p| + (|g| + u) |x - p|).
    """
    out = {}
    for g, u in radius.items():
        middle = pivots @ groups[g]
        slack = u * np.linalg.norm(pivots, axis=1)
        length = np.linalg.norm(groups[g]) + u
        best: dict[int, float] = {}
        for r in nearest:
            best[r.id] = max(best.get(r.id, -np.inf), middle[r.cell] - slack[r.cell] - length * r.distance)
        certain = sorted(best.values(), reverse=True)
        floor = certain[k] if len(certain) > k else -np.inf  # one of these ids may be the query's own
        spare = 1e-9 * (1 + np.abs(middle) + slack + abs(floor if np.isfinite(floor) else 0))  # rounding
        out[g] = np.full(len(pivots), -np.inf) if length == 0 else (floor - middle - slack - spare) / length
    return out


def _replicate(reach: dict[int, np.ndarray], pieces: dict[int, int], blocks: dict[int, int]):
    """Sends each data row to the query groups that may need it, dealt evenly into pieces."""

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            cell = batch.column("cell").to_numpy(zero_copy_only=False)
            distance = batch.column("distance").to_numpy(zero_copy_only=False)
            mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for g, least in reach.items():
                at = np.flatnonzero(distance >= least[cell])
                piece = (mixed[at] % np.uint64(pieces[g])).astype(np.int32)
                for b in range(blocks[g]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), g, np.int32)), pa.array(piece), pa.array(np.full(len(at), b, np.int32)), batch.column("id").take(pa.array(at)), batch.column("v").take(pa.array(at))],
                        ["grp", "piece", "block", "id", "v"],
                    )

    return replicate


def _solve(k: int, width: int):
    def solve(asked: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asked) and len(data):
            data = data.sort_values("id", kind="stable")
            ids = data["id"].to_numpy()
            rows = np.frombuffer(b"".join(data["v"]), float).reshape(-1, width)
            for start in range(0, len(asked), 128):
                part = asked.iloc[start : start + 128]
                own = part["id"].to_numpy()
                scores = np.frombuffer(b"".join(part["v"]), float).reshape(-1, width) @ rows.T
                scores[own[:, None] == ids[None, :]] = -np.inf
                kth = np.partition(scores, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(own), -np.inf)
                for i, packed in enumerate(part["v"]):
                    at = np.flatnonzero((scores[i] >= kth[i]) & (scores[i] > -np.inf))
                    best = at[np.lexsort((ids[at], -scores[i][at]))[:k]]
                    query = int.from_bytes(pd.util.hash_array(np.array([packed], object)).tobytes(), "little", signed=True)
                    found.append(pd.DataFrame({"query_id": own[i], "__query": query, "vec_id": ids[best], "score": scores[i][best]}))
        if not found:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "__query": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        return pd.concat(found, ignore_index=True)

    return solve
