import itertools
import zlib

import numpy as np
import pytest

from tests_support import documents, label_rows, prose, rng, rows  # noqa: F401
from tracelake.llm import quality, toxicity
from tracelake.llm.labelled import SCORE
from tracelake.llm.toxicity import Field, batch_evidence, keys_of


def auc(y, s):
    pairs = [(a, b) for a in s[y == 1] for b in s[y == 0]]
    return sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs)


def brute_marginals(field, weights):
    """Marginals by summing over all state sequences."""
    total, toxic = 0.0, np.zeros(len(weights))
    for states in itertools.product((0, 1), repeat=len(weights)):
        score = field.start * states[0] + sum(w * z for w, z in zip(weights, states)) + sum(field.move[a, b] for a, b in itertools.pairwise(states))
        total += np.exp(score)
        toxic += np.exp(score) * np.array(states)
    return toxic / total


def test_forward_backward_equals_enumeration():
    field = Field(np.zeros(3), -1.3, np.array([[0.2, -1.0], [-0.4, 0.7]]))
    g = np.random.default_rng(0)
    lengths = np.array([1, 4, 8, 7])
    weights = g.normal(0, 2, (4, 8))
    got = field.marginals(weights, lengths)
    for w, n, m in zip(weights, lengths, got, strict=True):
        assert np.allclose(m[:n], brute_marginals(field, w[:n])) and not m[n:].any()
    steps = field.expected_steps(weights, lengths)
    assert np.isclose(steps.sum(), (lengths - 1).sum())


def test_pieces_of_a_long_chain_equal_one_sweep():
    field = Field(np.zeros(1), -2.0, np.array([[0.0, -2.5], [-0.2, 0.4]]))
    g = np.random.default_rng(1)
    docs = [[bytes([g.integers(97, 123)]) for _ in range(n)] for n in (0, 1, 95, 96, 97, 700)]
    known = {bytes([c]): float(g.normal(-1, 2)) for c in range(97, 123)}
    evidence, got = batch_evidence(field, docs, known)
    for words, marginals in zip(docs, got, strict=True):
        if words:
            whole = field.marginals(np.array([[known[w] for w in words]]), np.array([len(words)]))[0]
            assert np.abs(marginals - whole).max() < 1e-3
    assert evidence[0] == np.log(1e-3)


def toxic_docs(seed, n=500):
    r, docs, labels = rng(seed), [], []
    for i in range(n):
        words, toxic = prose(r, r.randint(5, 200)), r.random() < 0.25
        for _ in range(r.randint(1, 4) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(["Nasty!", "vileword,", "crud", "schuft" + "abcdef"[r.randrange(6)]]))
        docs.append((i, " ".join(words)))
        if i % 5 < 4:
            labels.append((i, None, int(toxic), "x"))
    return docs, labels


def test_toxicity_on_held_out_documents(documents, label_rows):
    docs, labels = toxic_docs(3)
    extra = [(9000, None), (9001, ""), (9002, "Quite calm."), (9003, "a vileword here " + "w1 " * 30_000), (None, "you crud"), (9002, "Quite calm.")]
    got = toxicity.toxicity_scores(documents(docs + extra), label_rows(labels)).collect()
    assert len(got) == len(docs) + len(extra)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    truth = {i: t for i, _, t, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert auc(np.array([truth[r.doc_id] for r in held]), np.array([r.score for r in held])) > 0.95
    by = {r.doc_id: r for r in got}
    assert by[9003].predicted == 1 and by[9002].predicted == 0 and by[9000].score == by[9001].score
    text = dict(docs + extra)[9003]
    assert [text[s.start : s.end] for s in by[9003].spans] == ["vileword"]
    assert by[None].held_out is None


def test_labels_of_held_out_rows_do_not_matter(documents, label_rows):
    docs, labels = toxic_docs(4, 200)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t, x) for i, q, t, x in labels]
    a, b = (rows(toxicity.toxicity_scores(documents(docs), label_rows(x)), "doc_id", "score") for x in (labels, flipped))
    assert a == b


@pytest.mark.parametrize("scores", [toxicity.toxicity_scores, quality.quality_scores])
def test_without_labels_or_documents(documents, label_rows, scores):
    docs = documents([(1, "a b"), (2, None)])
    for labels in ([], [(1, 1, 1, None)], [(1, None, None, None), (None, 1, 1, None)]):
        got = scores(docs, label_rows(labels)).collect()
        assert len(got) == 2 and len({round(r.score, 6) for r in got}) == 1
    assert scores(documents([]), label_rows([])).count() == 0


def test_keys_of_odd_tokens():
    assert keys_of(b"***") == ["none", "token"]
    assert "w=idiot" in keys_of(b"(Idiot!!)")
    assert keys_of(b"\xff\xfe")


def quality_docs(seed, n=400):
    r, docs, labels = rng(seed), [], []
    for i in range(n):
        words, good = prose(r, r.randint(8, 150)), r.random() < 0.7
        text = " ".join(words) + "." if good else r.choice([" | ".join(words), " ".join(w + "%%%" for w in words), " ".join(words).upper(), " ".join(words[:1] * 50)])
        docs.append((i, text))
        labels.append((i, int(good), None, None))
    return docs, labels


def test_quality_on_held_out_documents(documents, label_rows):
    docs, labels = quality_docs(6)
    extra = [(9000, None), (9001, ""), (9002, "w " * 50_000), (3, docs[3][1]), (None, "x")]
    got = quality.quality_scores(documents(docs + extra), label_rows(labels)).collect()
    assert len(got) == len(docs) + len(extra)
    truth = {i: q for i, q, _, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert auc(np.array([truth[r.doc_id] for r in held]), np.array([r.score for r in held])) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) for r in got)


def test_columns_pass_beside_the_score(documents, label_rows):
    docs, labels = quality_docs(7, 60)
    frame = documents(docs)
    scored = quality.with_quality(frame, label_rows(labels))
    assert scored.columns == [*frame.columns, SCORE]
    assert rows(scored, *frame.columns) == rows(frame, *frame.columns)


def test_additive_model_learns_single_and_pair_effects():
    g = np.random.default_rng(8)
    x = g.normal(size=(4000, 4))
    y = ((x[:, 0] > 0.5) | ((x[:, 1] > 0) & (x[:, 2] > 0))).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert auc(y[3000:], model.score(x[3000:])) > 0.97
    assert (1, 2) in model.pairs
    constant = quality.fit(np.zeros((10, 2)), np.array([0.0, 1.0] * 5))
    assert np.allclose(constant.score(np.array([[0.0, 0.0], [5.0, -5.0]])), 0.5)
