import __spark_entry__ as entry_module
import corpus_pipeline
import duckdb
import pytest

from tests_support import SF, brute_components, documents, edited, prose, rng, rows  # noqa: F401
from tracelake.llm import decontamination, mixing, queries
from tracelake.llm.decontamination import leaks, without_leaks


@pytest.fixture
def items(spark):
    return lambda found: spark.createDataFrame([(i, t, "x", "y") for i, t in found], "item_id long, text string, __doc string, seed string")


def brute_leaks(docs, found):
    """Pairs whose best run of equal (1) and other (-1) tokens at some offset reaches what is asked for."""
    import regex

    split = lambda t: regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
    out = set()
    for i, text in found:
        item = split(text)
        if len(item) < 5:
            continue
        need = len(item) if len(item) < 7 else min(12, max(7, -(-len(item) // 2)))
        for d, body in docs:
            words = split(body)
            for shift in range(-len(item) + 1, len(words)):
                run = best = 0
                for p, w in enumerate(item):
                    if 0 <= shift + p < len(words):
                        run = max(0, run + (1 if words[shift + p] == w else -1))
                        best = max(best, run)
                if best >= need:
                    out.add((d, i))
    return out


def test_planted_passages(documents, items):
    r = rng(1)
    found = [(i, " ".join(prose(r, n, 4000))) for i, n in enumerate([5, 6, 7, 8, 16, 30, 60, 4])]
    docs = []
    for i, text in found:
        words = text.split()
        third = [w if p % 3 else "sub" for p, w in enumerate(words)]
        fourth = [w if p % 4 else "sub" for p, w in enumerate(words)]
        for body in (words, [w.upper() + "," for w in words], fourth, edited(r, words, 0.1), words[len(words) // 3 :], third if len(words) > 40 else words, prose(r, 30, 4000)):
            docs.append((len(docs), " ".join([*prose(r, r.randint(0, 40), 4000), *body, *prose(r, r.randint(0, 40), 4000)])))
    got = {(a, b) for a, b in rows(leaks(documents(docs), items(found)), "doc_id", "item_id")}
    want = brute_leaks(docs, found)
    assert got <= want
    assert len(want) > 25 and len(got) >= 0.98 * len(want)
    plain = {(d, i) for d, i in want if found[i][1].lower() in docs[d][1].lower()}
    assert plain <= got


@pytest.mark.parametrize("length", [8, 10, 12, 15, 16, 20, 24, 30])
def test_recall_with_every_fourth_token_replaced(documents, items, length):
    """Against comparing everything: of the passages that score as a leak, at least 98 in 100 are met, at any length."""
    r = rng(length)
    found = [(i, " ".join(prose(r, length, 10**6))) for i in range(300)]
    docs = []
    for i, text in found:
        words = text.split()
        for at in r.sample(range(length), length // 4 if length >= 12 else 1):  # shorter ones need seven equal tokens
            words[at] = f"r{r.randrange(10**9)}"
        docs.append((i, " ".join([*prose(r, 5, 10**6), *words, *prose(r, 5, 10**6)])))
    want = {(d, i) for (d, body), item in zip(docs, found) for _, i in brute_leaks([(d, body)], [item])}
    got = set(rows(leaks(documents(docs), items(found)), "doc_id", "item_id"))
    assert got <= want and len(want) >= 20
    assert len(got) >= 0.98 * len(want)


def test_a_template_shared_by_many_items_is_no_leak_of_them(documents, items):
    r = rng(9)
    template = prose(r, 13, 10**6)
    found = [(i, " ".join([*template, *prose(r, 6, 10**6)])) for i in range(400)]
    docs = [(i, " ".join([*prose(r, 20, 10**6), *template, *prose(r, 20, 10**6)])) for i in range(60)]
    docs += [(100 + i, "so " + found[i][1] + " it was") for i in range(5)]
    again = [(1000 + i, found[0][1].upper()) for i in range(50)]  # one text under many ids counts once
    got = leaks(documents(docs), items(found + again))
    assert rows(got, "doc_id", "item_id", "n_items") == [(100, 0, 51), *[(100 + i, i, 1) for i in range(1, 5)]]


def test_items_made_of_shared_wording_alone_are_found_without_the_cap(documents, items):
    """Every seed of these items is held by more than 32 of them: the score alone decides, as in comparing everything."""
    r = rng(10)
    words = prose(r, 20, 10**6)
    found = [(i, " ".join(words[2 * p + (i >> p) % 2] for p in range(10))) for i in range(1024)]
    docs = [(i, " ".join([*prose(r, 9, 10**6), found[i * 131][1], *prose(r, 9, 10**6)])) for i in range(6)] + [(9, " ".join(prose(r, 30, 10**6)))]
    want = set(brute_leaks(docs, found))
    got = set(rows(leaks(documents(docs), items(found), common=None), "doc_id", "item_id"))
    assert {(i, i * 131) for i in range(6)} <= got <= want and len(got) >= 0.98 * len(want)
    assert leaks(documents(docs), items(found)).isEmpty()  # by its SQL, op9 takes none of these seeds
    assert rows(without_leaks(documents(docs), items(found)), "doc_id") == [(9,)]


def test_leak_edges(documents, items):
    text = "one two three four five six seven eight"
    docs = [(1, None), (2, ""), (3, text), (3, text), (None, text), (4, "the " * 5000), (5, "Eight, seven")]
    found = [(1, text), (1, text), (2, None), (3, ""), (None, text), (4, "the the the the the the the the"), (5, "too short")]
    assert rows(leaks(documents(docs), items(found)), "doc_id", "item_id") == sorted([(3, 1), (None, 1), (4, 4)], key=repr)
    kept = without_leaks(documents(docs), items(found))
    assert rows(kept, "doc_id") == sorted([(1,), (2,), (5,), (None,)], key=repr)
    assert leaks(documents([]), items(found)).count() == 0
    assert leaks(documents(docs), items([])).count() == 0
    assert kept.columns == documents([]).columns


def test_many_seeds_take_the_shuffle_join(documents, items, monkeypatch):
    text = "one two three four five six seven eight nine"
    docs, found = documents([(1, f"so {text} it is"), (2, "nothing like that here at all")]), items([(1, text)])
    want = rows(leaks(docs, found), "doc_id", "item_id", "score")
    monkeypatch.setattr(decontamination, "BROADCAST_SEEDS", 1)
    assert rows(leaks(docs, found), "doc_id", "item_id", "score") == want == [(1, 1, 9)]


def test_stages_keep_clean_documents_and_drop_the_rest(spark, tmp_path):
    """Each stage against a plain version of it on what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns
        path = f"{tmp_path}/{name.replace(' ', '-')}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        left = {r.doc_id: r.text for r in docs.collect()}
        assert left.items() <= kept.items()
        if name == "near duplicates":
            assert set(left) == {i for i, (_, c) in brute_components(sorted(kept.items())).items() if i == c}
        if name == "decontamination":
            bench = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
            assert set(kept) - set(left) == {d for d, _ in brute_leaks_fast(kept, bench)}
        kept = left
    mix = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    sizes = {i: len(t.encode().split()) for i, t in kept.items()}
    assert abs(mix.agg({"taken": "sum"}).first()[0] - 1.5 * sum(sizes.values())) <= 20
    assert {r.doc_id for r in mix.collect()} <= set(kept)


def test_stages_take_odd_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 AS __score", "'x' AS `a.b`", "2 AS __id", "3 AS component_id")
    for frame in (docs.where("doc_id < 40"), docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF)
            assert out.columns == docs.columns
            assert out.count() <= frame.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0


def brute_leaks_fast(kept, bench):
    """``brute_leaks`` for the few pairs that share three tokens in a row."""
    import regex

    grams = lambda t: {tuple(w[i : i + 3]) for w in [regex.findall(r"[\p{L}\p{N}]+", t.lower())] for i in range(len(w) - 2)}
    sets = {d: grams(t) for d, t in kept.items()}
    out = set()
    for i, text in bench:
        own = grams(text)
        near = [(d, kept[d]) for d, g in sets.items() if len(own & g) >= 3]
        out |= brute_leaks(near, [(i, text)])
    return out


def normal(found, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(round(float(r[i]), 6)) if isinstance(r[i], (int, float)) else str(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = duck.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert normal([tuple(r) for r in got.collect()], got.columns) == normal(want.fetchall(), columns)


def test_every_operator_and_the_pipeline_are_registered(spark):
    names = set(entry_module.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert entry_module.queries()["pipeline"](spark, SF).count() > 0
