"""Chunking, embedding, vector upkeep and exact nearest-neighbour search."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.distribution import ordered_total
from tracelake.functions.dates import created_on
from tracelake.functions.text import ellipsis, word_chunks, word_count
from tracelake.operators import tables
from tracelake.session import materialise

# Words per chunk, texts per embedding batch, hits per search, hits looked through for "today".
CHUNK_WORDS = 500
EMBED_BATCH = 16
TOP_K = 5
TODAY_CANDIDATES = 20

# Query vectors that a task compares at once, and query and corpus vectors of the blocks that meet in a task. Each block is
# sent once for each block of the other side, so the larger they are the less is shuffled.
QUERY_BLOCK = 4096
QUERY_GROUP = 32_768
CORPUS_BLOCK = 50_000

# Most scores a task holds at once. Also bounds the candidates when very many corpus rows are copies of each other.
SCORE_CELLS = 1_000_000
# Corpus rows that give the first bar of each query.
FIRST_ROWS = 512


def chunk(docs: DataFrame, size: int = CHUNK_WORDS, text: str = "text") -> DataFrame:
    """One row per chunk of ``size`` words, numbered from 0 within the document."""
    rest = [c for c in docs.columns if c != text]
    return docs.select(*rest, F.posexplode(word_chunks(F.col(text), size)).alias("chunk_no", "chunk"))


def chunk_with(docs: DataFrame, split: Callable[[str], Sequence[str]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks of a caller's own splitter, numbered from 0 within the document: ``key``, ``chunk_no``, ``chunk``.

    The splitter runs as a Python table function next to the rows, one document after the other in Arrow batches; chunks
    are given out as they come, and no document is shuffled. A null text has no chunks.
    """
    kind = docs.schema[key].dataType.simpleString()

    class Split:
        def eval(self, ident, body):
            if body is not None:
                for number, piece in enumerate(split(body)):
                    yield ident, number, piece

    function = F.udtf(Split, returnType=f"{key}: {kind}, chunk_no: int, chunk: string", useArrow=True)
    named = f"split_{uuid.uuid4().hex}"
    spark = docs.sparkSession
    spark.udtf.register(named, function)
    return spark.sql(f"SELECT made.* FROM {{docs}} AS docs, LATERAL {named}(docs.`{key}`, docs.`{text}`) AS made", docs=docs)


def number_chunks(docs: DataFrame, size: int = CHUNK_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks with a dense global id ``doc_<n>`` in document order.

    Documents learn the number of their first chunk from a running total, so chunks are never sorted globally. The sizes
    are written first: they are narrow, and the texts are then counted only once.
    """
    sizes = materialise(docs.select(key, F.ceil(word_count(F.col(text)) / F.lit(size)).alias("chunks")), "sizes")
    first = ordered_total(sizes, F.col(key), [], "first", weight=F.col("chunks")).select(key, "first")
    numbered = chunk(docs.select(key, text), size, text).join(first, key)
    position = F.col("first") + F.col("chunk_no")
    return numbered.select(key, "chunk_no", F.concat(F.lit("doc_"), position.cast("string")).alias("chunk_id"), "chunk")


def embed(df: DataFrame, model: Callable[[], Callable[[list[str]], Sequence]], text: str = "text", batch: int = EMBED_BATCH) -> DataFrame:
    """Adds ``embedding``. ``model()`` is called once per worker and gives a function from texts to vectors."""

    @F.pandas_udf("array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = model()
        for texts in batches:
            values = texts.tolist()
            found = [v for i in range(0, len(values), batch) for v in encode(values[i : i + batch])]
            yield pd.Series([np.asarray(v, dtype="float32") for v in found], index=texts.index)

    return df.withColumn("embedding", vectors(F.col(text)))


def upsert_vectors(base: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """New vectors replace old ones of the same id; within ``new`` the largest row wins."""
    one_each = tables.latest_by(new, [key], [c for c in new.columns if c != key and new.schema[c].dataType.typeName() != "map"])
    return tables.upsert(base, one_each, key)


def topk_similar(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = TOP_K,
    query_id: str = "query_id",
    doc_id: str = "id",
    payload: Sequence[str] = (),
    digits: int = 6,
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """Exact ``k`` most similar corpus vectors per query, with similarity, distance and rank.

    Queries and corpus are dealt into blocks of bounded size that meet in a grid, by an equi join on the block numbers. A
    cell multiplies its two blocks, ``block`` queries at once, and gives out its own ``k`` best per query; no vector passes
    through the driver, only the two counts that set the number of blocks. Scores are compared rounded to ``digits`` and ties go to the smaller id,
    so results do not depend on how rows are dealt. Vectors that are null have no neighbours and are none, zero vectors
    have no direction, and vectors of different lengths are not compared. A query id given twice is asked once, with the
    smaller vector.
    """
    kept = [doc_id, *payload]
    asked = queries.where(F.col("embedding").isNotNull()).groupBy(query_id).agg(F.min("embedding").alias("embedding"))
    searched = corpus.where(F.col("embedding").isNotNull()).select(*kept, "embedding")
    query_blocks = max(1, -(-asked.count() // max(block, QUERY_GROUP)))
    corpus_blocks = max(queries.sparkSession.sparkContext.defaultParallelism, -(-searched.count() // CORPUS_BLOCK))
    asked = _gridded(asked, query_id, "__q", query_blocks, "__c", corpus_blocks)
    searched = _gridded(searched, doc_id, "__c", corpus_blocks, "__q", query_blocks)
    cell = ["__q", "__c", "__size"]
    fields = [queries.schema[query_id], *[corpus.schema[c] for c in kept], T.StructField("similarity", T.DoubleType())]
    nearest = _cell_hits(k, query_id, doc_id, list(payload), digits, block)
    hits = asked.groupBy(*cell).cogroup(searched.groupBy(*cell)).applyInPandas(nearest, T.StructType(fields))
    best = Window.partitionBy(query_id).orderBy(F.col("similarity").desc(), F.col(doc_id))
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.withColumn("distance", F.round(1.0 - F.col("similarity"), digits))


def topk_hashed(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = TOP_K,
    query_id: str = "query_id",
    doc_id: str = "id",
    payload: Sequence[str] = (),
    digits: int = 6,
    bits: int = 4,
    tables: int = 16,
) -> DataFrame:
    """Approximate ``topk_similar`` for collections too large to compare every query with everything.

    A vector's bucket in each of ``tables`` hash tables is on which side of ``bits`` hyperplanes it lies. A query is compared,
    exactly, with the vectors of its buckets only; near vectors share one of them with high probability, far ones less
    often. More bits make buckets smaller, more tables find more; the defaults suit neighbours at wide angles. Buckets of very many rows are split into blocks that meet
    in a grid; no row of a bucket is left out. Fewer than ``k`` rows come back for a query whose buckets hold fewer.
    """
    kept = [doc_id, *payload]
    asked = queries.where(F.col("embedding").isNotNull()).groupBy(query_id).agg(F.min("embedding").alias("embedding"))
    asked = materialise(_bucketed(asked, bits, tables), "hashed-queries")
    searched = materialise(_bucketed(corpus.where(F.col("embedding").isNotNull()).select(*kept, "embedding"), bits, tables), "hashed-corpus")
    sizes = [
        df.groupBy("__bucket").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias(name))
        for df, name, block in ((asked, "__qs", QUERY_BLOCK), (searched, "__cs", CORPUS_BLOCK))
    ]
    grid = F.broadcast(sizes[0].join(sizes[1], "__bucket"))  # at most tables x 2^bits rows
    asked = _dealt(asked.join(grid, "__bucket"), query_id, "__q", "__qs", "__c", "__cs")
    searched = _dealt(searched.join(grid, "__bucket"), doc_id, "__c", "__cs", "__q", "__qs")
    cell = ["__bucket", "__q", "__c", "__size"]
    fields = [queries.schema[query_id], *[corpus.schema[c] for c in kept], T.StructField("similarity", T.DoubleType())]
    hits = asked.groupBy(*cell).cogroup(searched.groupBy(*cell)).applyInPandas(_cell_hits(k, query_id, doc_id, list(payload), digits), T.StructType(fields))
    best = Window.partitionBy(query_id).orderBy(F.col("similarity").desc(), F.col(doc_id))
    ranked = hits.dropDuplicates([query_id, doc_id]).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.withColumn("distance", F.round(1.0 - F.col("similarity"), digits))


def hyperplanes(width: int, count: int) -> np.ndarray:
    """Normals of reproducible hyperplanes, as columns: whole numbers spread evenly by a polynomial of their place."""
    i, j = np.arange(width)[:, None], np.arange(count)[None, :]
    return ((i * i * 7919 + j * j * 104_729 + i * i * j * 31 + i * j * j * 17 + i * j * 31_337 + i * 65_537 + j * 257) % 10_007 - 5003).astype(float)


def _bucketed(df: DataFrame, bits: int, tables: int) -> DataFrame:
    """One row per hash table, with the vector's bucket in it (tables do not share buckets)."""

    @F.pandas_udf("array<int>")
    def buckets(vectors: pd.Series) -> pd.Series:
        found = []
        for v in vectors:
            sides = (np.asarray(v, float) @ hyperplanes(len(v), bits * tables)).reshape(tables, bits) >= 0
            found.append(sides @ (1 << np.arange(bits)) + (np.arange(tables) << bits))
        return pd.Series(found)

    return df.withColumn("__bucket", F.explode(buckets("embedding")))


def _dealt(df: DataFrame, ident: str, own: str, blocks: str, other: str, copies: str) -> DataFrame:
    placed = df.withColumn(own, F.pmod(F.xxhash64(ident), F.col(blocks)).cast("int")).withColumn("__size", F.size("embedding"))
    return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(copies) - 1))).drop(blocks, copies)


def _gridded(df: DataFrame, ident: str, own: str, blocks: int, other: str, copies: int) -> DataFrame:
    """Rows in a block of their own, once for each block of the other side."""
    dealt = df.withColumn(own, F.pmod(F.xxhash64(ident), F.lit(blocks)).cast("int")).withColumn("__size", F.size("embedding"))
    return dealt.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def _cell_hits(k: int, query_id: str, doc_id: str, payload: list[str], digits: int, block: int = QUERY_BLOCK):
    kept = [doc_id, *payload]

    def nearest(asked: pd.DataFrame, searched: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(searched):
            return pd.DataFrame({c: pd.Series(dtype=(searched if c in kept else asked).get(c, pd.Series(dtype="float64")).dtype) for c in [query_id, *kept, "similarity"]})
        searched = searched.sort_values(doc_id, na_position="first")  # of equal scores the earlier row wins
        asked, queries = _directions(asked)
        searched, corpus = _directions(searched)
        parts = [_best_rows(queries[at : at + block], corpus, k, digits) for at in range(0, len(queries), block)] or [(np.empty(0, int), np.empty(0, int), np.empty(0))]
        names = np.concatenate([n * block + query for n, (query, _, _) in enumerate(parts)])
        found = searched[kept].iloc[np.concatenate([row for _, row, _ in parts])].reset_index(drop=True)
        found.insert(0, query_id, asked[query_id].iloc[names].reset_index(drop=True))
        return found.assign(similarity=np.concatenate([score for _, _, score in parts]))

    return nearest


def _directions(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """Rows that have a direction, and their vectors of length one."""
    vectors = np.stack(rows["embedding"].to_numpy()).astype("float64")
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    known = ~np.isnan(vectors).any(axis=1)
    return rows[known], vectors[known]


def _best_rows(queries: np.ndarray, corpus: np.ndarray, k: int, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, corpus row and rounded score of each query's ``k`` best rows, earlier rows first among equal scores.

    Products in single precision find the few rows that can pass a query's bar, its k-th best score so far; these are scored
    again in double precision. The margin is more than single precision and rounding can differ by. Where so many pass that
    they are no selection, as among copies of one vector, the whole slice is scored in double precision.
    """
    width = queries.shape[1]
    margin = 4e-7 * max(width, 8) + 10.0**-digits
    short_queries, short_corpus = queries.T.astype("float32"), corpus.astype("float32")
    bar = np.full(len(queries), -np.inf)
    best = (np.empty(0, int), np.empty(0, int), np.empty(0))
    slices, start = max(k, SCORE_CELLS // len(queries)), 0
    while start < len(corpus):
        rows = slices if start else min(slices, max(k, FIRST_ROWS))
        scores = short_corpus[start : start + rows] @ short_queries
        low = bar
        if not start and len(scores) >= k:
            low = -np.partition(-scores, k - 1, axis=0)[k - 1] - margin
        row, query = np.nonzero(scores >= low - margin)
        if len(row) * width > scores.size:
            exact = np.round(corpus[start : start + rows] @ queries.T, digits) + 0.0
            if start:
                passed = exact > bar
            else:
                last = min(k, len(exact)) - 1
                passed = exact >= -np.partition(-exact, last, axis=0)[last]
            row, query = np.nonzero(passed)
            score = exact[row, query]
        else:
            score = np.round(np.einsum("ij,ij->i", corpus[start + row], queries[query]), digits) + 0.0
            passed = score > bar[query]
            row, query, score = row[passed], query[passed], score[passed]
        if len(row):
            query, row, score = (np.concatenate(pair) for pair in zip(best, (query, start + row, score)))
            order = np.lexsort((row, -score, query))
            query, row, score = query[order], row[order], score[order]
            place = np.arange(len(query)) - np.searchsorted(query, query)
            first = place < k
            best = query[first], row[first], score[first]
            bar[query[place == k - 1]] = score[place == k - 1]
        start += rows
    return best


def only_today(hits: DataFrame, day: date | str) -> DataFrame:
    """Filter by creation date, applied to the hits of a search and not before it, so fewer than asked may remain."""
    return hits.where(created_on(F.col("created_at"), day))


def topk_per_query(hits: DataFrame, k: int, order: Sequence[Column], query_id: str = "query_id") -> DataFrame:
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy(query_id).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def all_summaries(vectors: DataFrame, length: int = 500) -> DataFrame:
    """Whole collection with texts cut for display and defaults for what is missing."""
    meta = F.col("payload")
    return vectors.select(
        "id",
        ellipsis(F.col("text"), length, only_if_longer=True).alias("text"),
        F.coalesce(meta["summary"], F.lit("")).alias("summary"),
        F.coalesce(meta["category"], F.lit("other")).alias("category"),
        F.coalesce(meta["created_at"], F.lit("")).alias("created_at"),
    )
