"""Retrieval queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.catalog.bindings import Tables
from tracelake.catalog.registry import query
from tracelake.functions.vectors import cosine_distance
from tracelake.operators import retrieval, tables
from tracelake.sources import writers

RANKED = ("centroids", "ranked")
CHUNKS = r"""
    chunks AS (SELECT doc_id, unnest(range(0, n)) AS chunk_no, w, n FROM (
      SELECT doc_id, w, CAST(ceil(len(w) / 500) AS BIGINT) AS n FROM (SELECT doc_id, regexp_extract_all(text, '\S+') AS w FROM documents)))"""


def _corpus(t: Tables) -> DataFrame:
    day = F.format_string("2024-01-%02dT00:00:00", F.col("vec_id") % 5 + 1)
    return t.table("embeddings").select(F.col("vec_id").alias("id"), "embedding", day.alias("created_at"))


@query(
    "topk_cosine",
    "SELECT query_id, id, rank::INTEGER AS rank, similarity, round(1.0 - similarity, 6) AS distance FROM ranked WHERE rank <= 5",
    RANKED,
)
def topk_cosine(t: Tables) -> DataFrame:
    return retrieval.topk_similar(t.label_queries, _corpus(t), 5)


@query(
    "topk_many",
    """SELECT query_id, id, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM (
      SELECT q.vec_id AS query_id, e.vec_id AS id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS similarity
      FROM embeddings q, embeddings e)) WHERE rank <= 3""",
)
def topk_many(t: Tables) -> DataFrame:
    """Every vector as a query, in several blocks."""
    every = t.table("embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.topk_similar(every, _corpus(t), 3, block=200).select("query_id", "id", "rank")


PLANE = "((i * i * 7919 + j * j * 104729 + i * i * j * 31 + i * j * j * 17 + i * j * 31337 + i * 65537 + j * 257) % 10007 - 5003)"
BUCKETS = f"""[list_sum([CASE WHEN list_sum([v[i + 1] * {PLANE} FOR i IN range(len(v))]) >= 0 THEN 1 << (j % 4) ELSE 0 END FOR j IN range(b * 4, b * 4 + 4)]) FOR b IN range(16)]"""


@query(
    "topk_hashed",
    f"""WITH asked AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 20 = 0),
      queries AS MATERIALIZED (SELECT query_id, v, {BUCKETS} AS s FROM asked),
      corpus AS MATERIALIZED (SELECT id, v, {BUCKETS} AS s FROM (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings))
    SELECT query_id, id, rank::INTEGER AS rank, similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM (
      SELECT q.query_id, c.id, round(list_cosine_similarity(c.v, q.v), 6) AS similarity FROM queries q, corpus c
      WHERE len([b FOR b IN range(1, 17) IF q.s[b] = c.s[b]]) > 0)) WHERE rank <= 5""",
)
def topk_hashed(t: Tables) -> DataFrame:
    """Every twentieth vector looked up among all of them through hash tables."""
    asked = t.table("embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.topk_hashed(asked, _corpus(t), 5).select("query_id", "id", "rank", "similarity")


@query(
    "topk_today",
    "SELECT query_id, id, rank::INTEGER AS rank FROM ranked WHERE rank <= 20 AND id % 5 = 2",
    RANKED,
)
def topk_today(t: Tables) -> DataFrame:
    hits = retrieval.topk_similar(t.label_queries, _corpus(t), retrieval.TODAY_CANDIDATES, payload=["created_at"])
    return retrieval.only_today(hits, "2024-01-03").select("query_id", "id", "rank")


@query(
    "label_distance",
    """SELECT e.vec_id AS id, round(1.0 - list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.v), 6) AS distance
      FROM embeddings e JOIN centroids c ON e.label = c.label""",
    ("centroids",),
)
def label_distance(t: Tables) -> DataFrame:
    centroids = t.label_queries.select(F.col("query_id").alias("label"), F.col("embedding").alias("centroid"))
    joined = t.table("embeddings").join(centroids, "label")
    return joined.select(F.col("vec_id").alias("id"), F.round(cosine_distance(F.col("embedding"), F.col("centroid")), 6).alias("distance"))


@query(
    "chunk_words",
    f"""WITH {CHUNKS} SELECT doc_id, chunk_no::INTEGER AS chunk_no,
      md5(array_to_string(w[chunk_no * 500 + 1 : chunk_no * 500 + 500], ' ')) AS digest FROM chunks""",
)
def chunk_words(t: Tables) -> DataFrame:
    chunks = retrieval.chunk(t.table("documents").select("doc_id", "text"))
    return chunks.select("doc_id", "chunk_no", F.md5("chunk").alias("digest"))


@query(
    "number_chunks",
    f"""WITH {CHUNKS} SELECT doc_id, chunk_no::INTEGER AS chunk_no,
      'doc_' || (row_number() OVER (ORDER BY doc_id, chunk_no) - 1) AS chunk_id FROM chunks""",
)
def number_chunks(t: Tables) -> DataFrame:
    return retrieval.number_chunks(t.table("documents")).select("doc_id", "chunk_no", "chunk_id")


@query(
    "number_chunks_text_key",
    f"""WITH {CHUNKS} SELECT lower(hex(doc_id)) || '-x' AS doc_id, chunk_no::INTEGER AS chunk_no,
      'doc_' || (row_number() OVER (ORDER BY lower(hex(doc_id)) || '-x', chunk_no) - 1) AS chunk_id FROM chunks""",
)
def number_chunks_text_key(t: Tables) -> DataFrame:
    """Chunks numbered in the order of documents whose keys are texts."""
    docs = t.table("documents").select(F.concat(F.lower(F.hex("doc_id")), F.lit("-x")).alias("doc_id"), "text")
    return retrieval.number_chunks(docs).select("doc_id", "chunk_no", "chunk_id")


@query(
    "version_ties",
    """SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderstatus, md5(o_orderkey::VARCHAR), o_orderkey)::BIGINT AS version FROM orders""",
)
def version_ties(t: Tables) -> DataFrame:
    """Versions of five names in the order of a text with three values: nearly all rows tie."""
    numbered = tables.next_version(t.table("orders"), "o_orderpriority", "o_orderstatus", ties=["o_orderkey"])
    return numbered.select("o_orderkey", F.col("version").cast("long").alias("version"))


@query(
    "append_scores",
    """SELECT trace_id, name, value, late FROM (SELECT *, row_number() OVER (PARTITION BY trace_id, name ORDER BY late DESC) AS n FROM (
      SELECT event_id AS trace_id, 'quality' AS name, value, false AS late FROM events
      UNION ALL SELECT event_id, 'quality', value + 1, true FROM events WHERE event_id % 100 = 7
      UNION ALL SELECT event_id, 'other', value, true FROM events WHERE event_id % 100 = 8)) WHERE n = 1""",
)
def append_scores(t: Tables) -> DataFrame:
    """A score table after a batch of corrections and new scores."""
    events = t.table("events").select(F.col("event_id").alias("trace_id"), F.lit("quality").alias("name"), "value", "ts", F.lit(False).alias("late"))
    changed = events.where("trace_id % 100 = 7").withColumns({"value": F.col("value") + 1, "late": F.lit(True), "ts": F.expr("ts + INTERVAL 1 DAY")})
    added = events.where("trace_id % 100 = 8").withColumns({"name": F.lit("other"), "late": F.lit(True)})
    return writers.append_scores(events, changed.unionByName(added)).select("trace_id", "name", "value", "late")


@query(
    "chunk_sentences",
    r"""SELECT doc_id, (i - 1)::INTEGER AS chunk_no, md5(s) AS digest FROM (
      SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM (
        SELECT doc_id, [trim(x, ' ') FOR x IN string_split(text, '. ') IF trim(x, ' ') <> ''] AS l FROM documents))""",
)
def chunk_sentences(t: Tables) -> DataFrame:
    """Chunks of a caller's own splitter, here sentences, over all documents."""
    chunks = retrieval.chunk_with(t.table("documents").select("doc_id", "text"), lambda text: [s for s in (x.strip(" ") for x in text.split(". ")) if s])
    return chunks.select("doc_id", "chunk_no", F.md5("chunk").alias("digest"))


@query(
    "truncate_history",
    """SELECT doc_id AS id, md5(CASE WHEN length(text) > 500 THEN left(text, 500) || '...' ELSE text END) AS text, lang AS summary,
      'other' AS category, '' AS created_at FROM documents""",
)
def truncate_history(t: Tables) -> DataFrame:
    stored = t.table("documents").select(F.col("doc_id").alias("id"), "text", F.create_map(F.lit("summary"), F.col("lang")).alias("payload"))
    return retrieval.all_summaries(stored).withColumn("text", F.md5("text"))


@query(
    "upsert_latest",
    """SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""",
)
def upsert_latest(t: Tables) -> DataFrame:
    latest = tables.latest_by(t.table("events"), ["user_id"], ["ts", "event_id"])
    return latest.select("user_id", "event_id", "event_type")


@query(
    "upsert_vectors",
    """SELECT e.vec_id AS id, coalesce(l.quality, e.label)::INTEGER AS label FROM embeddings e LEFT JOIN labels l ON e.vec_id = l.doc_id
    UNION ALL SELECT doc_id, quality FROM labels WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)""",
)
def upsert_vectors(t: Tables) -> DataFrame:
    base = t.table("embeddings").select(F.col("vec_id").alias("id"), "label")
    new = t.table("labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))
    return retrieval.upsert_vectors(base, new)


@query("delete_by_id", "SELECT vec_id FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def delete_by_id(t: Tables) -> DataFrame:
    toxic = t.table("labels").where("toxic = 1").select(F.col("doc_id").alias("vec_id"))
    return tables.delete_by_id(t.table("embeddings").select("vec_id"), toxic, "vec_id")
