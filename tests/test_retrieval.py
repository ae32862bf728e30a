import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tracelake import schemas
from tracelake.functions.text import ellipsis
from tracelake.functions.vectors import cosine_distance, cosine_similarity
from tracelake.operators import calls as C
from tracelake.operators import queues as Q
from tracelake.operators import retrieval as V


def brute_force(queries, corpus, k):
    hits = []
    for q, a in queries:
        scored = [(-round(float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)), 6), i) for i, b in corpus if np.linalg.norm(b)]
        hits += [(q, i, -s, n + 1) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(hits, key=repr)


@pytest.fixture(scope="module")
def vectors(spark):
    draw = random.Random(3)
    corpus = [(i, [draw.choice([-1.0, 0.0, 1.0, 2.0]) for _ in range(3)]) for i in range(120)]
    queries = [(f"q{i}", [draw.uniform(-1, 1) for _ in range(3)]) for i in range(11)]
    frames = (
        spark.createDataFrame(queries, "query_id string, embedding array<double>"),
        spark.createDataFrame(corpus, "id long, embedding array<double>").repartition(5),
    )
    return queries, corpus, *frames


def test_topk_equals_brute_force(vectors):
    queries, corpus, q, c = vectors
    expected = brute_force(queries, corpus, 7)
    for hits in (V.topk_similar(q, c, 7), V.topk_similar(q, c, 7, block=4)):
        found = sorted(((r.query_id, r.id, r.similarity, r["rank"]) for r in hits.collect()), key=repr)
        assert [f[:2] + f[3:] for f in found] == [e[:2] + e[3:] for e in expected]
        assert [f[2] for f in found] == [pytest.approx(e[2]) for e in expected]


def test_topk_in_small_slices_and_with_copies(spark, vectors, monkeypatch):
    queries, corpus, q, c = vectors
    monkeypatch.setattr(V, "SCORE_CELLS", 20)
    copies = corpus + [(1000 + i, [1.0, 1.0, 1.0]) for i in range(60)]
    frame = spark.createDataFrame(copies, "id long, embedding array<double>").repartition(3)
    found = sorted(((r.query_id, r.id, r["rank"]) for r in V.topk_similar(q, frame, 7).collect()), key=repr)
    assert found == [e[:2] + e[3:] for e in brute_force(queries, copies, 7)]


def test_small_query_blocks_do_not_multiply_the_corpus(spark, vectors, monkeypatch):
    """The corpus is sent once for each group of queries, not once for every few that are compared at once."""
    dealt = []
    gridded = V._gridded
    monkeypatch.setattr(V, "_gridded", lambda *a: dealt.append(a[3:]) or gridded(*a))
    _, _, q, c = vectors
    V.topk_similar(q, c, 7, block=1)
    copies_of_corpus = dealt[1][2]
    assert copies_of_corpus == 1


def test_best_rows_among_near_scores_and_copies():
    """Scores that differ beyond single precision, and a slice of copies only, against scoring all in double precision."""
    draw = np.random.default_rng(5)
    base = draw.normal(size=(6, 16))
    near = base[draw.integers(0, 6, 3000)] + draw.normal(size=(3000, 16)) * 1e-4
    for corpus in (near, np.vstack([near[:700], np.repeat(base[:1], 4000, axis=0), near[700:]])):
        queries = np.vstack([base, near[:40]])
        corpus = corpus / np.linalg.norm(corpus, axis=1, keepdims=True)
        queries = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        exact = np.round(queries @ corpus.T, 6)
        want = [(q, r) for q in range(len(queries)) for r in np.lexsort((np.arange(len(corpus)), -exact[q]))[:5]]
        query, row, score = V._best_rows(queries, corpus, 5, 6)
        assert list(zip(query, row)) == want
        assert np.array_equal(score, exact[query, row])


def test_topk_edges(spark, vectors):
    _, _, q, c = vectors
    assert V.topk_similar(q, c.limit(0), 3).isEmpty()
    assert V.topk_similar(q.limit(0), c, 3).isEmpty()
    assert V.topk_similar(q.limit(1), c.where("id < 2"), 5).count() <= 2
    dated = c.withColumn("created_at", F.when(F.col("id") % 2 == 0, "2026-07-01T10").otherwise("2026-07-02T10"))
    hits = V.topk_similar(q.limit(1), dated, 20, payload=["created_at"])
    today = V.only_today(hits, "2026-07-01")
    assert 0 < today.count() < 20


def test_similarity_expressions(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    got = df.select(cosine_similarity(F.col("a"), F.col("b")), cosine_distance(F.col("a"), F.col("b"))).collect()
    assert got[0][0] == pytest.approx(2**-0.5) and got[0][1] == pytest.approx(1 - 2**-0.5)
    assert tuple(got[1]) == (None, None)


def test_chunks_are_whole_and_numbered(spark):
    docs = [(5, " ".join(f"w{i}" for i in range(1201))), (2, "  one\n two  "), (9, ""), (7, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    chunks = {(r.doc_id, r.chunk_no): r.chunk for r in V.chunk(df).collect()}
    assert len(chunks) == 5 and chunks[(2, 0)] == "one two"
    assert " ".join(chunks[(5, i)] for i in range(3)) == docs[0][1]
    numbered = {(r.doc_id, r.chunk_no): r.chunk_id for r in V.number_chunks(df).collect()}
    assert numbered == {(2, 0): "doc_0", (5, 0): "doc_1", (5, 1): "doc_2", (5, 2): "doc_3", (7, 0): "doc_4"}


def test_embedding_batches(spark):
    def model():
        return lambda texts: [[float(len(t)), float(len(texts) <= 16)] for t in texts]

    df = spark.createDataFrame([(str(i), "x" * i) for i in range(40)], "id string, text string")
    found = {r.id: r.embedding for r in V.embed(df, model).collect()}
    assert found["7"] == [7.0, 1.0] and len(found) == 40


def test_upsert_and_history(spark):
    base = spark.createDataFrame([("a", "old", {"summary": "s"}), ("b", "x" * 600, {"category": "sales", "created_at": "2026"})], "id string, text string, payload map<string,string>")
    new = spark.createDataFrame([("a", "new", None), ("c", "c", None)], base.schema)
    merged = V.upsert_vectors(base, new)
    assert rows(merged, "id", "text")[0] == ("a", "new") and merged.count() == 3
    shown = {r.id: r for r in V.all_summaries(merged).collect()}
    assert len(shown["b"].text) == 503 and shown["b"].category == "sales"
    assert (shown["c"].summary, shown["c"].category, shown["c"].created_at) == ("", "other", "")
    assert spark.range(1).select(ellipsis(F.lit("ab"), 5, False), ellipsis(F.lit("ab"), 5, True)).first()[:] == ("ab...", "ab")


def test_topk_per_query(spark):
    hits = spark.createDataFrame([("q", 1, 0.5), ("q", 2, 0.9), ("q", 3, 0.9)], "query_id string, id int, s double")
    top = V.topk_per_query(hits, 2, [F.col("s").desc(), F.col("id")])
    assert rows(top, "id", "rank") == [(2, 1), (3, 2)]


QUEUES = ["Annotation Queue - Team A", "Annotation Queue - Team B", "Annotation Queue - Team C"]


def test_round_robin_sizes(spark):
    traces = spark.createDataFrame([(i,) for i in range(65)], "trace_id long")
    dealt = Q.assign_round_robin(traces, QUEUES, 11)
    assert sorted((r["count"] for r in dealt.groupBy("queue").count().collect()), reverse=True) == [22, 22, 21]
    added = Q.enqueue(dealt.select("queue", "trace_id"), dealt.limit(5))
    assert added.count() == 65
    order = [r.trace_id for r in Q.shuffle(traces, "trace_id", 1).collect()]
    assert order == [r.trace_id for r in Q.shuffle(traces.repartition(3), "trace_id", 1).collect()] and order != sorted(order)


def test_queues_are_made_once(spark):
    old = spark.createDataFrame([("A", "keep")], "name string, instructions string")
    wanted = spark.createDataFrame([("A", "other"), ("B", "b"), ("B", "b")], old.schema)
    assert rows(Q.ensure_queues(old, wanted)) == [("A", "keep"), ("B", "b")]


def test_enrichment(spark):
    traces = spark.createDataFrame(
        [("1", '{"question":"leave?"}', {"a": "b", "dataset_context": "old"}), ("2", "plain", None), ("3", '{"question":"other"}', {"a": "b"})],
        "trace_id string, input string, metadata map<string,string>",
    )
    contexts = spark.createDataFrame([("leave?", "25 days"), ("other", "")], "question string, context string")
    found = {r.trace_id: r.metadata for r in Q.enrich(traces, contexts).collect()}
    assert found == {"1": {"a": "b", "dataset_context": "25 days"}, "2": None, "3": {"a": "b"}}


def test_restructure_and_lookup(spark):
    docs = "array<struct<text:string,source:string>>"
    df = spark.createDataFrame([("1", '{"answer":"A"}', None, [("t", "s")])], f"trace_id string, output string, metadata map<string,string>, docs {docs}")
    row = Q.restructure(df).first()
    assert (row.output, row.metadata) == ("A", {"retrieved_context": '["t"]', "sources": '["s"]'})
    asked = spark.createDataFrame([("1", "known"), ("2", "unknown")], "trace_id string, question string")
    dim = spark.createDataFrame([("known", [("d", "x")])], f"question string, docs {docs}")
    found = {r.question: r.docs[0].text for r in Q.lookup_default(asked, dim, "question", "docs", Q.default_docs(), "trace_id").collect()}
    assert found == {"known": "d", "unknown": "No relevant documents found."}


def test_action_items(spark):
    texts = [("1", "- Call Bob\n- Send notes\n- Call Bob"), ("2", "No action items identified"), ("3", "- Do follow-up")]
    df = spark.createDataFrame(texts, "id string, action_items_text string")
    assert [r.action_items for r in C.with_action_items(df).orderBy("id").collect()] == [["Call Bob", "Send notes"], [], ["Do follow", "up"]]
    assert [r.action_items for r in C.with_action_items(df, legacy=False).orderBy("id").collect()][2] == ["Do follow-up"]


def test_categories(spark):
    cats = C.default_categories(spark)
    calls = spark.createDataFrame([("1", "SALES", "t"), ("2", None, "t"), ("3", "x", "t"), ("4", "", "t")], "id string, category string, transcript string")
    known, unknown = C.with_category(calls, cats)
    assert rows(known, "id", "category_name") == [("1", "sales"), ("2", "other"), ("4", "other")]
    assert rows(unknown, "id") == [("3",)]
    assert "Transcript:\nt" in C.call_prompts(known).first().prompt
    assert C.by_category(calls, "All").count() == 4 and C.by_category(calls, "x").count() == 1
    renamed = C.update_category(cats, spark.createDataFrame([("Sales", "deals", "ignored")], "key string, name string, extra string"))
    assert ("sales", "deals") in rows(renamed, "key", "name") and renamed.columns == cats.columns
    assert C.ensure_categories(cats, cats).count() == 5
    assert schemas.CATEGORY.names[0] == "key"


def test_hashed_search_finds_most_neighbours_and_splits_hot_buckets(spark, monkeypatch):
    r = np.random.default_rng(3)
    centres = r.standard_normal((40, 16))
    vectors = centres[r.integers(0, 40, 1500)] + 0.3 * r.standard_normal((1500, 16))
    vectors[:300] = vectors[0]  # one bucket holds a fifth of all rows
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)] + [(9000, None)], "id long, embedding array<double>")
    queries = corpus.where("id % 15 = 0").withColumnRenamed("id", "query_id")
    exact = set(rows(V.topk_similar(queries, corpus, 5), "query_id", "id"))
    monkeypatch.setattr(V, "CORPUS_BLOCK", 100)
    monkeypatch.setattr(V, "QUERY_BLOCK", 10)
    found = rows(V.topk_hashed(queries, corpus, 5), "query_id", "id", "rank")
    assert len(exact & {f[:2] for f in found}) >= 0.9 * len(exact)
    assert len({f[:2] for f in found}) == len(found)
    assert V.topk_hashed(queries.limit(0), corpus, 5).count() == 0


def test_custom_splitter(spark):
    docs = spark.createDataFrame([(1, "a|b|"), (2, None), (3, "")], "doc_id long, text string")
    assert rows(V.chunk_with(docs, lambda text: text.split("|"))) == [(1, 0, "a"), (1, 1, "b"), (1, 2, ""), (3, 0, "")]
