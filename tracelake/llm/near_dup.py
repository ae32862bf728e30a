"""Near-duplicate groups of documents by a chosen-path set similarity join.

A document is its set of distinct five-word shingles. Sets are embedded by ``COORDINATES`` minwise values. Each of
``TREES`` independent trees deals the sets into nodes by the minwise token at a few selected coordinates; a node too large to
compare is branched again by coordinates that its own path selects, and small nodes are compared exhaustively. Links are
confirmed on full sets. Before that, the first member of each node, and of each node at the end of some longer paths, is
compared with the others: members of a large family mostly come together there, at a cost in proportion to its size, and
only nodes that still hold several groups go on.

Recall: two sets of similarity s share the token of a coordinate with probability s. At 0.75 they miss all 12 nodes of the
first level with probability 6e-8, and in nodes that go on branching in two, one tree loses them with probability 0.11, all
six with 2e-6. The estimate from 64 coordinates that sorts out pairs before the full comparison loses them with 5e-6.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import columns_of, lower_words, small_batches
from tracelake.session import materialise

SHINGLE = 5
PERCENT = 75
COORDINATES = 64
TREES = 6
BRANCHES = 2
#: Longer paths whose ends only bring very similar sets together, and the coordinates of each.
LONG_PATHS = 8
LONG = 3
#: A node is compared by one task if it has at most so many sets and shingles in all.
NODE_SETS = 3_000
NODE_SHINGLES = 4_000_000
#: Levels of branching; what is still large then is compared in blocks, so depth costs time and loses nothing.
LEVELS = 8
#: Coordinates that must agree before full sets are fetched: half of them, where 0.75 is asked for.
AGREEING = COORDINATES // 2
REMEMBERED_WORDS = 500_000

_RANDOM = np.random.default_rng(20_240_601)
_FACTORS = _RANDOM.integers(1 << 62, 1 << 63, COORDINATES + 3, dtype=np.uint64) | np.uint64(1)
_MASKS = _RANDOM.integers(0, 1 << 63, COORDINATES + 3, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _FACTORS[-1]
    return x ^ (x >> np.uint64(29))


def _sets(texts: list[str | None], known: _WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after the other, and how many each has."""
    if len(known) > REMEMBERED_WORDS:
        known.clear()
    words = [lower_words(t) for t in texts]
    counts = np.array([len(w) for w in words], dtype=np.int64)
    hashes = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.uint64, int(counts.sum()))
    rolled = hashes[: max(0, len(hashes) - SHINGLE + 1)].copy()
    for j in range(1, SHINGLE):
        rolled = rolled * _STEP + hashes[j : j + len(rolled)]
    rolled = _mixed(rolled)
    parts, start = [], 0
    for n in counts.tolist():
        if n >= SHINGLE:
            parts.append(np.unique(rolled[start : start + n - SHINGLE + 1]))
        else:  # the whole sequence is one shingle; its length keeps it apart from longer ones
            whole = reduce(lambda h, w: h * _STEP + w, hashes[start : start + n], np.uint64(n)) if n else None
            parts.append(_mixed(np.array([whole])) if n else np.empty(0, np.uint64))
        start += n
    return np.concatenate(parts) if parts else np.empty(0, np.uint64), np.array([len(p) for p in parts], dtype=np.int64)


def _per_set(values: np.ndarray, sizes: np.ndarray, function: np.ufunc) -> np.ndarray:
    """``function`` over the values of each non-empty set; 0 for empty ones."""
    out = np.zeros(len(sizes), values.dtype)
    full = sizes > 0
    if full.any():
        starts = (np.cumsum(sizes) - sizes)[full]
        out[full] = function.reduceat(values, starts)
    return out


def _digests(values: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
    """Two order-free digests of each set; sets that agree in both and in size are the same."""
    found = []
    for i in (COORDINATES, COORDINATES + 1):
        found.append(pa.array(_per_set(_mixed((values ^ _MASKS[i]) * _FACTORS[i]), sizes, np.add).view(np.int64)))
    return found


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _WordHashes()
    with np.errstate(over="ignore"):
        for batch in batches:
            values, sizes = _sets(batch.column("__text").to_pylist(), known)
            minima = np.empty((len(sizes), COORDINATES), np.int32)
            for c in range(COORDINATES):
                least = _per_set((values ^ _MASKS[c]) * _FACTORS[c], sizes, np.minimum)
                minima[:, c] = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * COORDINATES), pa.array(minima.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(sizes), *_digests(values, sizes), tokens], ["id", "n", "d1", "d2", "minima"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of each text under the ``sid`` it belongs to, once for each that a task meets."""
    known, met = _WordHashes(), set()
    with np.errstate(over="ignore"):
        for batch in batches:
            values, sizes = _sets(batch.column("__text").to_pylist(), known)
            digests = [d.to_numpy() for d in _digests(values, sizes)]
            own = (digests[0] == batch.column("d1").to_numpy()) & (digests[1] == batch.column("d2").to_numpy())  # not another text of that id
            sids = batch.column("sid").to_pylist()
            new = []
            for i in np.flatnonzero(own).tolist():
                if sids[i] not in met:
                    met.add(sids[i])
                    new.append(i)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            for lot in [new[i : i + 64] for i in range(0, len(new), 64)]:
                part = [values[ends[i] : ends[i + 1]].view(np.int64) for i in lot]
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in part])]).astype(np.int32)
                items = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(part)))
                yield pa.RecordBatch.from_arrays([pa.array([sids[i] for i in lot], pa.int64()), items], ["sid", "items"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the digests of their sets, once for each set that a task meets; empty sets are left out."""
    known, met = _WordHashes(), set()
    with np.errstate(over="ignore"):
        for batch in batches:
            texts = batch.column("__text")
            values, sizes = _sets(texts.to_pylist(), known)
            d1, d2 = (d.to_numpy() for d in _digests(values, sizes))
            new = []
            for i, kind in enumerate(zip(d1.tolist(), d2.tolist(), sizes.tolist(), strict=True)):
                if kind[2] and kind not in met:
                    met.add(kind)
                    new.append(i)
            at = pa.array(new, pa.int64())
            yield pa.RecordBatch.from_arrays([texts.take(at), *[pa.array(x).take(at) for x in (d1, d2, sizes)]], ["__text", "d1", "d2", "n"])


def connected(edges: DataFrame, name: str) -> DataFrame:
    """``id`` and ``root``, the smallest id it is connected with, of every id in ``edges`` (``a``, ``b``).

    Alternating large and small stars: a neighbour is hung on the smallest id its middle knows. Every round is written, so
    no lineage grows, and a hub of any degree only meets joins that adaptive execution may split.
    """
    pairs = edges.where(F.col("a") != F.col("b"))
    current = materialise(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    state = _state(current)
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        current = materialise(hung.select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct(), name)
        before, state = state, _state(current)
        if state == before:
            roots = current.select(F.col("v").alias("id")).distinct()
            return current.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots.select("id", F.col("id").alias("root")))


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _agreeing(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` whose minwise values agree often enough."""
    minima = sketches.select("sid", "minima")
    left = minima.select(F.col("sid").alias("a"), F.col("minima").alias("__a"))
    right = minima.select(F.col("sid").alias("b"), F.col("minima").alias("__b"))
    same = F.size(F.filter(F.zip_with("__a", "__b", lambda x, y: x == y), lambda x: x))
    return pairs.join(left, "a").join(right, "b").where(same >= AGREEING).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that are linked by their full sets."""
    left = sets.select(F.col("sid").alias("a"), F.col("items").alias("__a"))
    right = sets.select(F.col("sid").alias("b"), F.col("items").alias("__b"))
    common = F.size(F.array_intersect("__a", "__b")).cast("long")
    linked = 100 * common >= PERCENT * (F.size("__a") + F.size("__b") - common)
    return pairs.join(left, "a").join(right, "b").where(linked).select("a", "b")


def _child(path: Column, coordinate: Column) -> Column:
    return F.xxhash64(path, coordinate, F.element_at("minima", coordinate + 1))


def _open_nodes(rows: DataFrame) -> DataFrame:
    """Rows of the nodes that hold several groups, with the node's ``sets`` and ``shingles``; nodes of the same sets count
    once. ``rows``: ``node``, ``sid``, ``grp``, ``n``."""
    facts = rows.groupBy("node").agg(
        F.count("*").alias("sets"), F.sum("n").alias("shingles"), F.min("grp").alias("__low"), F.max("grp").alias("__high"),
        F.sum(F.xxhash64("sid") % 1_000_000_007).alias("__sum"), F.bit_xor(F.xxhash64("sid", F.lit(1))).alias("__xor"),
    )
    alike = facts.where(F.col("__low") < F.col("__high")).groupBy("sets", "shingles", "__sum", "__xor").agg(F.min("node").alias("node"))
    return rows.join(alike.select("node", "sets", "shingles"), "node")


def _nodes_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Whole nodes of rows that come sorted by node: a table and the bounds of its nodes."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([rest, rows]) if rest is not None else rows
        keys = rows.column("node").to_numpy()
        cuts = (np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()
        if cuts:
            yield rows.slice(0, cuts[-1]).combine_chunks(), list(zip([0, *cuts[:-1]], cuts, strict=True))
        rest = rows.slice(cuts[-1] if cuts else 0)
    if rest is not None and len(rest):
        yield rest.combine_chunks(), [(0, len(rest))]


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of a node that agree with a member of another group in enough coordinates."""
    for rows, bounds in _nodes_in(batches):
        groups = rows.column("grp").to_numpy()
        minima = rows.column("minima").chunk(0).flatten().to_numpy().reshape(-1, COORDINATES)
        keep = np.zeros(len(rows), bool)
        for start, end in bounds:
            of, own = minima[start:end], groups[start:end]
            for i in range(end - start - 1):
                near = ((of[i + 1 :] == of[i]).sum(axis=1) >= AGREEING) & (own[i + 1 :] != own[i])
                if near.any():
                    keep[start + i] = True
                    keep[start + i + 1 : end] |= near
        yield from rows.filter(pa.array(keep)).select(["node", "sid", "grp"]).to_batches()


def _node_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the groups of each node, as few as connect them: a set is compared on full sets with all later ones it
    agrees with, unless they are of its group already."""
    for rows, bounds in _nodes_in(batches):
        groups = rows.column("grp").to_numpy()
        minima = rows.column("minima").chunk(0).flatten().to_numpy().reshape(-1, COORDINATES)
        lists = rows.column("items").chunk(0)
        values, offsets = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
        found: list[tuple[int, int]] = []
        for start, end in bounds:
            sets = [values[offsets[i] : offsets[i + 1]] for i in range(start, end)]
            found.extend(_joined(groups[start:end].copy(), minima[start:end], sets))
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])


def _joined(groups: np.ndarray, minima: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of groups of one node that links bring together."""
    out: list[tuple[int, int]] = []
    sizes = np.array([len(s) for s in sets])
    shared = None
    for i in range(len(groups) - 1):
        near = ((minima[i + 1 :] == minima[i]).sum(axis=1) >= AGREEING) & (groups[i + 1 :] != groups[i])
        at = np.flatnonzero(near) + i + 1
        at = at[100 * np.minimum(sizes[at], sizes[i]) >= PERCENT * np.maximum(sizes[at], sizes[i])]
        if not len(at):
            continue
        shared = shared or _Postings(sets, sizes)
        common = shared.common(i)[at]
        for j in at[100 * common >= PERCENT * (sizes[at] + sizes[i] - common)].tolist():
            if groups[i] != groups[j]:
                first, second = sorted((int(groups[i]), int(groups[j])))
                groups[groups == second] = first
                out.append((first, second))
    return out


class _Postings:
    """Which sets of a node hold each shingle, to count a set's common shingles with all others in one sweep."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray) -> None:
        _, self.shingle, self.counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        self.holders = np.repeat(np.arange(len(sets)), sizes)[np.argsort(self.shingle, kind="stable")]
        self.starts = np.cumsum(self.counts) - self.counts
        self.ends = np.cumsum(sizes)
        self.sizes = sizes

    def common(self, i: int) -> np.ndarray:
        own = self.shingle[self.ends[i] - self.sizes[i] : self.ends[i]]
        counts = self.counts[own]
        places = np.repeat(self.starts[own] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return np.bincount(self.holders[places], minlength=len(self.sizes))


def _blocks(rows: DataFrame) -> DataFrame:
    """Large nodes as a grid of block pairs, each small enough to compare; every pair of members meets in one."""
    count = F.ceil(F.greatest(F.col("sets") * 2 / NODE_SETS, F.col("shingles") * 2 / NODE_SHINGLES)).cast("int")
    block = F.pmod(F.xxhash64("sid"), count).cast("int")
    dealt = rows.withColumn("__count", count).withColumn("__block", block)
    dealt = dealt.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__count") - 1)))
    pair = F.xxhash64("node", F.least("__block", "__other"), F.greatest("__block", "__other"))
    return dealt.withColumn("node", pair).drop("__count", "__block", "__other")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_shingles`` (size of the set), ``component_id`` (smallest id reachable over links, itself included) and
    ``kept`` (it is that document) of every row.

    Documents are linked if 100 x intersection >= 75 x union of their sets of lower-cased five-word shingles. With fewer
    words the whole sequence is the one shingle. Without words or text (null) a set is empty and linked with nothing.
    Documents with equal sets, however many, are one set from the start and never compared. A repeated row gets a row
    each; a row with a null id links and bridges like any other, and has a null component only if it meets no id. Other columns are ignored. Texts are read
    whole. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"))
    sketches = materialise(small_batches(texts).mapInArrow(_sketch, "id long, n long, d1 long, d2 long, minima array<int>"), "dup-sketch")
    kinds = ["d1", "d2", "n"]
    distinct = sketches.where("n > 0").groupBy(*kinds).agg(F.min("id").alias("least"), F.first("minima").alias("minima"))
    distinct = materialise(distinct.withColumn("sid", F.monotonically_increasing_id()), "dup-sets")

    first = [[c] for c in range(TREES * BRANCHES)]
    long = [[(TREES * BRANCHES + p + i * LONG_PATHS) % COORDINATES for i in range(LONG)] for p in range(LONG_PATHS)]
    ends = F.array(*[F.xxhash64(F.lit(path[0]), *[F.element_at("minima", c + 1) for c in path]) for path in first + long])
    entries = distinct.select("sid", "n", F.posexplode(ends).alias("path", "node"))
    shared = entries.groupBy("node").agg(F.count("*").alias("sets"), F.min("sid").alias("leader")).where("sets > 1")
    placed = materialise(entries.join(shared.select("node", "leader"), "node"), "dup-nodes")

    stars = placed.where("sid <> leader").select(F.col("leader").alias("a"), F.col("sid").alias("b")).distinct()
    stars = materialise(_agreeing(stars, distinct), "dup-stars")
    sets = _sets_of(texts, distinct, placed)
    roots = connected(_confirmed(stars, sets), "dup-first")
    roots = materialise(roots.select(F.col("id").alias("sid"), F.col("root").alias("grp")), "dup-groups")

    rows = placed.where(F.col("path") < len(first)).select("node", "sid", "n").join(roots, "sid", "left").withColumn("grp", F.coalesce("grp", "sid"))
    rows = materialise(_open_nodes(rows), "dup-level")
    small, level = [], 0
    is_small = (F.col("sets") <= NODE_SETS) & (F.col("shingles") <= NODE_SHINGLES)
    small.append(rows.where(is_small))
    large = rows.where(~is_small)
    while level < LEVELS and not large.isEmpty():
        known = large.join(distinct.select("sid", "minima"), "sid")
        picks = [F.pmod(F.xxhash64("node", F.lit(b)), F.lit(COORDINATES)).cast("int") for b in range(BRANCHES)]
        children = known.select(F.explode(F.array(*[_child(F.col("node"), p) for p in picks])).alias("child"), "sid", "n", "grp")
        rows = materialise(_open_nodes(children.withColumnRenamed("child", "node")), "dup-level")
        small.append(rows.where(is_small))
        large = rows.where(~is_small)
        level += 1
    nodes = reduce(DataFrame.unionByName, [*small, _blocks(large)]).select("node", "sid", "grp")
    hinted = nodes.join(distinct.select("sid", "minima"), "sid").repartition("node").sortWithinPartitions("node")
    active = materialise(hinted.select("node", "sid", "grp", "minima").mapInArrow(_promising, "node long, sid long, grp long"), "dup-active")
    gathered = active.join(distinct.select("sid", "minima"), "sid").join(sets, "sid").repartition("node").sortWithinPartitions("node")
    gathered = gathered.select("node", "grp", "minima", "items")
    links = connected(gathered.mapInArrow(_node_links, "a long, b long"), "dup-second")
    links = links.select(F.col("id").alias("grp"), F.col("root").alias("__root"))

    final = roots.join(links, "grp", "left").select("sid", F.coalesce("__root", "grp").alias("grp"))
    lone = distinct.select("sid").join(roots.select("sid"), "sid", "left_anti").withColumn("grp", F.col("sid"))
    lone = lone.join(links, "grp", "left").select("sid", F.coalesce("__root", "grp").alias("grp"))
    owned = distinct.select("sid", "least", *kinds).join(final.unionByName(lone), "sid")
    named = owned.groupBy("grp").agg(F.min("least").alias("component_id"))
    by_kind = materialise(owned.join(named, "grp").select(*kinds, "component_id"), "dup-components")
    found = sketches.select("id", *kinds).join(by_kind, kinds, "left")
    component = F.coalesce("component_id", "id")
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of every near-duplicate group, with all its columns: the row of the smallest id, one of them if rows share
    it. Rows without an id can't be told apart and are all kept.

    Only ids are joined; Catalyst broadcasts the written list of ids to drop where that is small, else it shuffles.
    """
    groups = materialise(near_duplicates(docs, id_col, text_col), "dup-result")
    dropped = groups.where(~F.col("kept")).select(id_col)
    repeated = materialise(groups.where(F.col("kept") & F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").select(id_col), "dup-repeated")
    away = materialise(dropped.where(F.col(id_col).isNotNull()).unionByName(repeated).distinct(), "dup-dropped")
    kept = docs.where(F.col(id_col).isNotNull()).join(away, id_col, "left_anti").select(*columns_of(docs))
    again = docs.join(repeated.join(dropped, id_col, "left_anti"), id_col, "left_semi").select(*columns_of(docs)).dropDuplicates([id_col])
    return kept.unionByName(again).unionByName(docs.where(F.col(id_col).isNull()))


def _sets_of(texts: DataFrame, distinct: DataFrame, placed: DataFrame) -> DataFrame:
    """Full set (``items``) of every ``sid`` that shares a node with another.

    A text is found again by the smallest id that holds its set. A set held under null ids only is found by its digests:
    each task gives one text of every such set, copies or not.
    """
    wanted = distinct.join(placed.select("sid").distinct(), "sid", "left_semi").select("sid", "least", "d1", "d2", "n")
    wanted = materialise(wanted, "dup-wanted")
    read = texts.join(wanted.where("least IS NOT NULL").withColumnRenamed("least", "__id"), "__id").select("__text", "sid", "d1", "d2")
    loose = small_batches(texts.where("__id IS NULL").select("__text")).mapInArrow(_digested, "__text string, d1 long, d2 long, n long")
    nameless = loose.join(wanted.where("least IS NULL").drop("least"), ["d1", "d2", "n"]).select("__text", "sid", "d1", "d2")
    return materialise(small_batches(read.unionByName(nameless)).mapInArrow(_full_sets, "sid long, items array<long>"), "dup-full")
