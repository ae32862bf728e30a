import pytest

from tests_support import brute_components, documents, edited, prose, rng, rows  # noqa: F401
from tracelake.llm import near_dup
from tracelake.llm.near_dup import connected, near_duplicates, one_of_each_group


def families(seed):
    r, docs = rng(seed), []
    for _ in range(25):
        base = prose(r, r.randint(3, 150))
        for share in (0, 0, 0.01, 0.03, 0.05, 0.2)[: r.randint(1, 6)]:
            docs.append((len(docs), " ".join(edited(r, base, share)).upper() if r.random() < 0.3 else " ".join(edited(r, base, share))))
    shared = prose(r, 60)
    docs += [(len(docs) + i, " ".join([*prose(r, 80), *shared, *prose(r, 80)])) for i in range(20)]
    step = prose(r, 120)
    for _ in range(60):  # a chain whose ends have little in common
        step = edited(r, step, 0.01)
        docs.append((len(docs), "\n".join(step)))
    return docs


@pytest.mark.parametrize(("seed", "small"), [(1, 400), (2, 4), (3, 12)])
def test_groups_equal_brute_force(documents, monkeypatch, seed, small):
    monkeypatch.setattr(near_dup, "NODE_SETS", small)  # small nodes: branching and the block grid run too
    monkeypatch.setattr(near_dup, "LEVELS", 2)
    docs = families(seed)
    got = near_duplicates(documents(docs)).collect()
    want = brute_components(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_one_group_of_thousands_of_copies(documents):
    r = rng(9)
    base = prose(r, 60)
    docs = [(i, " ".join(base)) for i in range(2000)] + [(5000 + i, " ".join(prose(r, 50))) for i in range(100)]
    got = near_duplicates(documents(docs)).groupBy("component_id").count()
    assert (0, 2000) in rows(got, "component_id", "count")
    assert got.count() == 101


def test_edges(documents):
    docs = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (4, "one two"), (None, "alone is it here now"), (8, "É é ß"), (9, "é é ß"), (10, "x " * 30_000)]
    got = rows(near_duplicates(documents(docs)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(
        [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (8, 1, 8, True), (9, 1, 9, True), (10, 1, 10, True), (None, 1, None, True)],
        key=repr,
    )
    assert near_duplicates(documents([])).count() == 0


def test_rows_without_an_id_link_and_bridge(documents):
    r = rng(12)
    base, other = prose(r, 100), prose(r, 100)
    front, back = ["x", *prose(r, 7), *base[8:]], [*base[:92], *prose(r, 7), "y"]
    docs = [(7, " ".join(front)), (None, " ".join(base)), (5, " ".join(back)), (None, " ".join(base)), (8, " ".join(other)), (None, " ".join([*other[:95], "z"])), (9, " ".join(prose(r, 40)))]
    docs += [(None, " ".join(prose(r, 60))), (None, None), (None, "")]
    got = [(d, c, k) for d, _, c, k in rows(near_duplicates(documents(docs)), "doc_id", "n_shingles", "component_id", "kept")]
    want = [(7, 5, False), (5, 5, True), (8, 8, True), (9, 9, True), (None, 5, False), (None, 5, False), (None, 8, False), (None, None, True), (None, None, True), (None, None, True)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    apart = rows(near_duplicates(documents([d for d in docs if d[0] in (5, 7)])), "doc_id", "component_id")
    assert apart == [(5, 5), (7, 7)]  # linked through the row without an id only
    many = rows(near_duplicates(documents([(3, " ".join(front)), *[(None, " ".join(base))] * 300])).groupBy("component_id").count(), "component_id", "count")
    assert many == [(3, 301)]


def test_one_document_of_each_group(documents):
    docs = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "q r s t u v"), (3, "q r s t u v"), (4, None), (None, "k l m n o"), (None, "k l m n o")]
    kept = one_of_each_group(documents(docs))
    assert kept.columns == documents([]).columns
    assert rows(kept, "doc_id") == [(1,), (3,), (4,), (None,), (None,)]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    got = {r.id: r.root for r in connected(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
