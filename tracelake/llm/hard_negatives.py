"""Hard negatives by bounds along spanning trees of the anchors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm.common import numbered
from tracelake.llm.vectors import matrix, packed, unpacked
from tracelake.session import materialise

#: Anchors of a tree, and rows that one task holds beside it.
TREE = 4096
PIECE = 32_768
#: Anchors of the sample that cells come from, and cells. They only bring near anchors into one tree.
SAMPLE = 2048
CELLS = 64
#: Bounds are widened by this share, far more than rounding.
SPARE = 1e-9

ROW = "id long, label long, norm double, v binary"


def tagged_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """``id``, ``label`` and ``v`` (whole numbers ``floor(scale * x)``) of the rows that take part: id, label and vector not
    null, no component null or non-finite."""
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = df.where(finite & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    whole = F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return kept.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole.alias("v"))


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of its label, the ``negatives`` best rows of other labels whose
    score is ``low`` to ``high`` percent of the positive's: ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score``, ``negative_score``. Both frames are as ``tagged_vectors`` gives them.

    Anchors near each other form trees of at most ``TREE``, whose edges are a minimum spanning tree of their distances. A
    task walks a tree over a piece of the rows: all are scored at its root; along an edge a row's score changes by at most
    edge length times the row's norm, so the parent's score bounds the child's, and only rows whose bounds meet the child's
    window are scored again. The window of the search for positives begins at the score that as many rows surely reach;
    that of the search for negatives is what the positives leave. The same bound from the root to the whole tree decides
    beforehand which rows a tree gets at all. No row is left out otherwise, so results are exact. The driver sees one row
    per tree.

    Scores are inner products of whole numbers, exact below 2^53. Equal scores go to the smaller id. A row with the anchor's id is not
    its positive. Shorter vectors count as padded with zeros. A repeated row counts as one each; an anchor repeated with the same
    vector and label is asked once. A negative positive score has no window. Empty tables give no rows.
    """
    width = max(rows.agg(F.max(F.size("v"))).first()[0] or 0, anchors.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    data = materialise(rows.select("id", "label", "v").mapInArrow(_pack(width), ROW), "negative-rows")
    trees = _trees(anchors.select("id", "label", "v").dropDuplicates(), width)
    own = _meet(data, trees, width, _same_label, _positives(width, positives), "a long, anchor_id long, other long, score long")
    best = Window.partitionBy("a").orderBy(F.desc("score"), "other")
    found = own.withColumn("n", F.row_number().over(best)).where(F.col("n") <= positives)
    windows = found.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("n", "other", "score"))).alias("p"))
    windows = windows.select("a", F.transform("p", lambda x: x["other"]).alias("positive"), F.transform("p", lambda x: x["score"]).alias("score"))
    bounds = windows.select("a", "positive", "score", (F.array_min("score") * low / 100.0).alias("least"), (F.array_max("score") * high / 100.0).alias("most"))
    sought = materialise(trees.join(bounds.where("most >= 0"), "a", "left"), "negative-windows")
    schema = "a long, n int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    other = _meet(data, sought, width, _other_label, _negatives(width, negatives, low, high), schema)
    rank = F.row_number().over(Window.partitionBy("a", "n").orderBy(F.desc("negative_score"), "negative_id"))
    ranked = other.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _pack(width: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"), width)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(np.linalg.norm(v, axis=1)), packed(v)], ["id", "label", "norm", "v"])

    return pack


def _trees(anchors: DataFrame, width: int) -> DataFrame:
    """Anchors ``a`` with their ``tree``, their parent's place in it and the length of the edge to it (the root has none), their own
    place ``at`` and distance to the root ``away``. Trees take anchors in the order of label and cell."""
    sample = anchors.orderBy(F.xxhash64("id", "label"), "id", "label", "v").limit(SAMPLE).collect()
    spread = np.zeros((max(1, len(sample)), width))
    for i, r in enumerate(sample):
        spread[i, : len(r.v)] = r.v
    centres = spread[:: -(-len(spread) // CELLS)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"), width)
            gaps = (centres**2).sum(axis=1) - 2 * v @ centres.T
            cell = gaps.argmin(axis=1)
            away = np.linalg.norm(v - centres[cell], axis=1)
            columns = [batch.column("id"), batch.column("label"), pa.array(cell.astype(np.int32)), pa.array(away), packed(v)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "cell", "gap", "v"])

    placed = anchors.mapInArrow(place, "id long, label long, cell int, gap double, v binary")
    ordered, _ = numbered(placed, [F.col(c) for c in ("label", "cell", "gap", "id", "v")], "a", "anchors")
    grown = ordered.withColumn("tree", F.floor(F.col("a") / TREE)).groupBy("tree").applyInPandas(
        _span(width), "tree long, a long, id long, label long, v binary, at int, parent int, edge double, away double"
    )
    return materialise(grown, "anchor-trees")


def _span(width: int):
    """Minimum spanning tree of a tree's anchors, grown from the one nearest to their mean."""

    def span(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("a", ignore_index=True)
        x = unpacked(group["v"], width)
        squares = (x**2).sum(axis=1)
        root = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
        parent, gap = np.full(len(x), root), squares - 2 * x @ x[root] + squares[root]
        open_ = np.ones(len(x), bool)
        parent[root], open_[root] = -1, False
        for _ in range(len(x) - 1):
            new = int(np.where(open_, gap, np.inf).argmin())
            open_[new] = False
            nearer = squares - 2 * x @ x[new] + squares[new]
            closer = open_ & (nearer < gap)
            parent[closer], gap[closer] = new, nearer[closer]
        edge = np.linalg.norm(x - x[parent], axis=1) * (parent >= 0)
        away = np.linalg.norm(x - x[root], axis=1)
        return group[["tree", "a", "id", "label", "v"]].assign(at=np.arange(len(x), dtype=np.int32), parent=parent.astype(np.int32), edge=edge, away=away)

    return span


def _same_label(trees: pd.DataFrame, label: np.ndarray, scores: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Rows x trees: may the row be a positive of one of the tree's anchors?"""
    return (label[:, None] >= trees["first"].to_numpy()) & (label[:, None] <= trees["last"].to_numpy())


def _other_label(trees: pd.DataFrame, label: np.ndarray, scores: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Rows x trees: may the row be a negative within the window of one of the tree's anchors?"""
    alone = (label[:, None] == trees["first"].to_numpy()) & (label[:, None] == trees["last"].to_numpy())
    slack = norm[:, None] * trees["radius"].to_numpy() * (1 + SPARE) + SPARE * (1 + np.abs(scores))
    return ~alone & (scores + slack >= trees["least"].to_numpy()) & (scores - slack <= trees["most"].to_numpy())


def _meet(data: DataFrame, anchors: DataFrame, width: int, needed: Callable, solve: Callable, schema: str) -> DataFrame:
    """Bring each tree together with the rows it may need, in pieces of about ``PIECE`` rows."""
    wanted = [F.min("least").alias("least"), F.max("most").alias("most")] if "least" in anchors.columns else []
    root = F.max(F.when(F.col("parent") < 0, F.col("v"))).alias("v")
    facts = anchors.groupBy("tree").agg(F.min("label").alias("first"), F.max("label").alias("last"), F.max("away").alias("radius"), root, *wanted)
    facts = pd.DataFrame([r.asDict() for r in facts.collect()], columns=facts.columns)  # one row per TREE anchors
    roots = unpacked(facts["v"], width)
    facts = facts.drop(columns="v").astype({c: float if c in ("radius", "least", "most") else "int64" for c in facts.columns if c != "v"})

    def picked(batch: pa.RecordBatch) -> np.ndarray:
        label, norm = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "norm"))
        return needed(facts, label, unpacked(batch.column("v").to_pylist(), width) @ roots.T, norm)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(facts), np.int64)
        for batch in batches:
            total += picked(batch).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(facts["tree"].to_numpy(np.int64)), pa.array(total)], ["tree", "rows"])

    counts = data.mapInArrow(count, "tree long, rows long").groupBy("tree").agg(F.sum("rows").alias("rows"))
    pieces = {r.tree: -(-r.rows // PIECE) for r in counts.collect() if r.rows}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = picked(batch)
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.uint64) + np.arange(batch.num_rows, dtype=np.uint64) * np.uint64(7919)
            mixed = (ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for i, tree in enumerate(facts["tree"]):
                at = np.flatnonzero(chosen[:, i])
                if len(at):
                    part = batch.take(pa.array(at))
                    piece = (mixed[at] % np.uint64(pieces[tree])).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), tree)), pa.array(piece), *part.columns], ["tree", "piece", *part.schema.names])

    sent = data.mapInArrow(send, f"tree long, piece int, {ROW}")
    sizes = data.sparkSession.createDataFrame(list(pieces.items()), "tree long, pieces long")
    copies = anchors.join(sizes, "tree").withColumn("piece", F.explode(F.sequence(F.lit(0), (F.col("pieces") - 1).cast("int")))).drop("pieces")
    return copies.groupBy("tree", "piece").cogroup(sent.groupBy("tree", "piece")).applyInPandas(solve, schema)


def _walk(tree: pd.DataFrame, x: np.ndarray, norm: np.ndarray, width: int, wanted: Callable) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Anchors of a tree (sorted by ``at``) with the rows to judge and their scores.

    ``wanted(i, lows, highs)`` says from the bounds which rows anchor ``i`` needs. Bounds are kept only while a child waits
    for them; the largest subtree comes last, so at most log2 of the anchors' number are kept at once.
    """
    v = unpacked(tree["v"], width)
    parent, edge = tree["parent"].to_numpy(), tree["edge"].to_numpy()
    children: list[list[int]] = [[] for _ in parent]
    for i, p in enumerate(parent):
        if p >= 0:
            children[p].append(i)
    root = int(np.flatnonzero(parent < 0)[0])
    order = [root]
    for i in order:
        order.extend(children[i])
    weight = np.ones(len(parent), np.int64)
    for i in reversed(order):
        if parent[i] >= 0:
            weight[parent[i]] += weight[i]
    waiting: list = [(root, None)]
    while waiting:
        i, bounds = waiting.pop()
        if bounds is None:
            lows = highs = x @ v[i]
            chosen = np.flatnonzero(wanted(i, lows, highs))
            scores = lows[chosen]
        else:
            slack = norm * (edge[i] * (1 + SPARE)) + SPARE * (1 + np.abs(bounds[0]))
            lows, highs = bounds[0] - slack, bounds[1] + slack
            bounds = None
            chosen = np.flatnonzero(wanted(i, lows, highs))
            if 2 * len(chosen) > len(x):  # cheaper to score all, which also narrows their bounds
                lows = highs = x @ v[i]
                scores = lows[chosen]
            else:
                scores = x[chosen] @ v[i]
                lows[chosen] = highs[chosen] = scores
        yield i, chosen, scores
        waiting += [(c, (lows, highs)) for c in sorted(children[i], key=lambda c: -weight[c])]


def _arrays(tree: pd.DataFrame, rows: pd.DataFrame, width: int):
    tree = tree.sort_values("at", ignore_index=True)
    rows = rows.sort_values("id", kind="stable")
    return tree, rows["id"].to_numpy(), rows["label"].to_numpy(), rows["norm"].to_numpy(), unpacked(rows["v"], width)


def _first(scores: np.ndarray, count: int) -> np.ndarray:
    """Places of the highest scores, falling; equal ones in the given order."""
    if len(scores) > count:
        kept = np.flatnonzero(scores >= np.partition(scores, -count)[-count])
        return kept[np.argsort(-scores[kept], kind="stable")[:count]]
    return np.argsort(-scores, kind="stable")


def _positives(width: int, count: int):
    def solve(tree: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(tree) and len(rows):
            tree, ids, labels, norm, x = _arrays(tree, rows, width)
            own, anchor = tree["label"].to_numpy(), tree["id"].to_numpy()

            def wanted(i: int, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
                fit = (labels == own[i]) & (ids != anchor[i])
                sure = lows[fit]
                return fit & (highs >= np.partition(sure, -count)[-count]) if len(sure) > count else fit

            for i, chosen, scores in _walk(tree, x, norm, width, wanted):
                at = _first(scores, count)
                found += [(tree["a"][i], anchor[i], ids[c], int(s)) for c, s in zip(chosen[at], scores[at])]
        return pd.DataFrame(found, columns=["a", "anchor_id", "other", "score"]).astype("int64")

    return solve


def _negatives(width: int, count: int, low: int, high: int):
    names = ["a", "n", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def solve(tree: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(tree) and len(rows):
            tree, ids, labels, norm, x = _arrays(tree, rows, width)
            own, least, most = tree["label"].to_numpy(), tree["least"].to_numpy(), tree["most"].to_numpy()

            def wanted(i: int, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
                return (labels != own[i]) & (highs >= least[i]) & (lows <= most[i])  # nothing without a window

            for i, chosen, scores in _walk(tree, x, norm, width, wanted):
                if np.isnan(least[i]):
                    continue
                whole = np.rint(scores).astype(np.int64)
                for n, (positive, score) in enumerate(zip(tree["positive"][i], tree["score"][i])):
                    inside = np.flatnonzero((100 * whole >= low * score) & (100 * whole <= high * score))
                    at = inside[_first(whole[inside], count)]
                    found += [(tree["a"][i], n, tree["id"][i], positive, score, ids[chosen[c]], whole[c]) for c in at]
        return pd.DataFrame(found, columns=names).astype({c: "int32" if c == "n" else "int64" for c in names})

    return solve
