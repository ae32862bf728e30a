import random

import pytest

SF = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def word_set(text, size=5):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def brute_components(docs):
    """doc_id -> (set size, smallest reachable id) by comparing all pairs."""
    sets = [(i, word_set(t)) for i, t in docs]
    root = {i: i for i, _ in docs}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {i: (len(s), top(i)) for i, s in sets}


def prose(rng, n, words=400):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def edited(rng, words, share):
    return [f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def rng(seed):
    return random.Random(seed)


DOC = "doc_id long, text string, lang string, source string, n_chars long, __id string, __text string, id string, sid long, node long, score string"


@pytest.fixture
def documents(spark):
    """Frame of (doc_id, text) or (doc_id, text, source) rows with extra columns whose names clash with inner ones."""

    def make(rows):
        full = [(i, t, "en", (s or [None])[0], None, "x", "y", "z", 1, 2, "w") for i, t, *s in rows]
        return spark.createDataFrame(full, DOC)

    return make


@pytest.fixture
def label_rows(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")

    return make
