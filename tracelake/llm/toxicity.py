"""Toxic spans and document toxicity by a linear-chain conditional random field."""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.llm.common import small_batches
from tracelake.llm.labelled import SCORE, learning_sample, remainder, with_scores

#: Labelled documents of each class that tokens are labelled in, the tokens of a training chain, and the chains of each kind.
SAMPLE = 2_000
CHAIN = 100
CHAINS = 4_000
#: A token's key marks toxicity if toxic documents of the sample hold it at least so many times as often, by share, as
#: others, and if its documents would fall so by chance with a log probability below the negative of this. A sample holds
#: hundreds of thousands of keys, most of them rare.
RATIO = 20.0
SURPRISE = 13.0
SLOTS = 1 << 18
KEYS = 8
EPOCHS = 4
RATE = 0.3
#: Tokens that a sweep of the field handles as one piece, and how far pieces overlap.
PIECE = 96
MARGIN = 12
REMEMBERED_WORDS = 500_000
SPANS = "__spans"
TOKEN = regex.compile(rb"[^\x20\x09-\x0D]+")
_EDGES = regex.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$")


def core(word: bytes) -> str:
    """Lower-cased token without the signs around it."""
    inner = word.decode("utf-8", "replace").lower().strip(string.punctuation)
    return inner if inner[:1].isalnum() and inner[-1:].isalnum() else _EDGES.sub("", inner)


def keys_of(word: bytes) -> list[str]:
    """What the field sees of a token: its core, beginnings and end, and that it is a token, so that unknown ones are taken
    for what most tokens are."""
    inner = core(word)
    if not inner:
        return ["none", "token"]
    return [f"w={inner}", f"e={inner[-4:]}", *[f"{n}={inner[:n]}" for n in (4, 5, 6, 7, 8)], "token"]


class _Slots(dict):
    """Hashed feature slots of tokens, remembered."""

    def __missing__(self, word: bytes) -> list[int]:
        slots = [xxhash.xxh32_intdigest(k) % SLOTS for k in keys_of(word)]
        self[word] = value = (slots + [SLOTS] * KEYS)[:KEYS]  # the last slot weighs nothing
        return value


@dataclass
class Field:
    """Weights of the field. A token is toxic or not; ``emit`` is the toxic state's weight of each feature slot, ``start``
    that of a toxic first token, and ``move`` those of steps (from, to). ``scale`` and ``shift`` turn a document's log
    evidence into its score."""

    emit: np.ndarray
    start: float
    move: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def odds(self, weights: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward-backward over chains padded to one width (chain x place) of toxic-state weights. Returns the toxic
        state's odds from the places up to each one, from those after it, and the factor of the weights."""
        up = np.exp(np.clip(weights, -30, 30))
        step = np.exp(self.move)
        width = up.shape[1]
        ahead, back = np.empty_like(up), np.ones_like(up)
        inside = np.arange(width)[None, :] < lengths[:, None]
        ahead[:, 0] = up[:, 0] * np.exp(self.start)
        for i in range(1, width):
            before = ahead[:, i - 1]
            ahead[:, i] = up[:, i] * (step[0, 1] + before * step[1, 1]) / (step[0, 0] + before * step[1, 0])
        for i in range(width - 2, -1, -1):
            after = up[:, i + 1] * back[:, i + 1]
            back[:, i] = np.where(inside[:, i + 1], (step[1, 0] + step[1, 1] * after) / (step[0, 0] + step[0, 1] * after), 1.0)
        return ahead, back, up

    def marginals(self, weights: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probability of the toxic state at each place; 0 beyond a chain's end."""
        ahead, back, _ = self.odds(weights, lengths)
        both = ahead * back
        return np.where(np.arange(weights.shape[1])[None, :] < lengths[:, None], both / (1 + both), 0.0)

    def expected_steps(self, weights: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Expected number of steps (from, to) over all chains."""
        ahead, back, up = self.odds(weights, lengths)
        step = np.exp(self.move)
        after = (up * back)[:, 1:]
        before = ahead[:, :-1]
        parts = np.stack([step[0, 0] + 0 * after, step[0, 1] * after, before * step[1, 0], before * step[1, 1] * after])
        parts = parts / parts.sum(axis=0) * (np.arange(1, weights.shape[1])[None, :] < lengths[:, None])
        return parts.sum(axis=(1, 2)).reshape(2, 2)


def without_copies(docs: list[list[bytes]]) -> list[list[bytes]]:
    """Documents that share none of three minwise windows of three words with one before: copies would make every word of
    a copied document look like a sign of its label."""
    kept, met = [], set()
    for words in docs:
        windows = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
        marks = {(seed, min(xxhash.xxh32_intdigest(w, seed) for w in windows)) for seed in range(3)}
        if met.isdisjoint(marks):
            kept.append(words)
        met |= marks
    return kept


def toxic_keys(toxic: list[list[bytes]], clean: list[list[bytes]]) -> set[str]:
    """Keys that toxic documents hold far more often than others: they label the tokens that carry them."""
    known: dict[bytes, list[str]] = {}
    for words in chain(toxic, clean):
        known.update((w, keys_of(w)) for w in words if w not in known)
    hits, misses = (Counter(k for words in docs for k in {k for w in set(words) for k in known[w]}) for docs in (toxic, clean))
    share = (len(toxic) + 1) / (len(toxic) + len(clean) + 2)

    def surprise(n: int, m: int) -> float:
        return n * np.log(n / (n + m) / share) + (m * np.log(m / (n + m) / (1 - share)) if m else 0.0)

    often = {k: n for k, n in hits.items() if n * (1 - share) >= RATIO * misses[k] * share and k not in ("token", "none")}
    return {k for k, n in often.items() if surprise(n, misses[k]) >= SURPRISE}


def fit(toxic: list[list[bytes]], clean: list[list[bytes]]) -> Field:
    """Field learned from tokenised documents of both labels by gradient ascent on the likelihood of labelled tokens.

    Tokens of toxic documents that carry a toxic key are labelled toxic, all others are not. Whole documents are cut into
    chains of ``CHAIN`` tokens; all that hold a toxic token are used and as many others. The evidence of a document is
    then turned into a probability of its label by a logistic fit.
    """
    field = Field(np.zeros(SLOTS + 1), -3.0, np.array([[0.0, -3.0], [0.0, -1.0]]))
    if not toxic or not clean:
        field.shift, field.scale = float(np.log((len(toxic) + 1) / (len(clean) + 1))), 0.0
        return field
    toxic, clean = without_copies(toxic), without_copies(clean)
    marked, slots = toxic_keys(toxic, clean), _Slots()
    carries = {w: not marked.isdisjoint(keys_of(w)) for w in {w for words in toxic for w in words}}
    chains = []
    for words, is_toxic in [*((w, True) for w in toxic), *((w, False) for w in clean)]:
        for low in range(0, len(words), CHAIN):
            part = words[low : low + CHAIN]
            chains.append((part, [int(is_toxic and carries[w]) for w in part]))
    order = np.random.default_rng(11).permutation(len(chains))
    holding = [i for i in order if any(chains[i][1])][:CHAINS]
    plain = [i for i in order if not any(chains[i][1])][: max(200, len(holding))]
    chosen = np.random.default_rng(12).permutation([*holding, *plain])
    energy = np.full(SLOTS + 1, 1e-2)
    for _ in range(EPOCHS):
        for low in range(0, len(chosen), 64):
            lot = [chains[i] for i in chosen[low : low + 64]]
            lengths = np.array([len(c[0]) for c in lot])
            places = np.full((len(lot), int(lengths.max()), KEYS), SLOTS)
            truth = np.zeros(places.shape[:2], int)
            for i, (words, labels) in enumerate(lot):
                places[i, : len(words)] = [slots[w] for w in words]
                truth[i, : len(words)] = labels
            inside = np.arange(places.shape[1])[None, :] < lengths[:, None]
            weights = field.emit[places].sum(axis=2)
            gap = (truth - field.marginals(weights, lengths)) * inside
            slope = np.bincount(places.ravel(), np.repeat(gap.ravel(), KEYS), SLOTS + 1)
            slope[SLOTS] = 0
            energy += slope**2
            field.emit += RATE * slope / np.sqrt(energy) - 1e-5 * field.emit
            seen = np.zeros((2, 2))
            np.add.at(seen, (truth[:, :-1][inside[:, 1:]], truth[:, 1:][inside[:, 1:]]), 1)
            field.move += 2.0 * (seen - field.expected_steps(weights, lengths)) / inside.sum()
            field.start += 0.5 * gap[:, 0].mean()
    evidence, _ = batch_evidence(field, [*toxic, *clean], _Weights(field))
    field.scale, field.shift = _logistic(evidence, np.array([1.0] * len(toxic) + [0.0] * len(clean)))
    return field


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and shift of a penalised logistic fit, by Newton steps."""
    w = np.zeros(2)
    design = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (y - p) - np.array([1e-2, 1e-4]) * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-2, 1e-4])
        w = w + np.linalg.solve(curve, slope)
    return max(0.0, float(w[0])), float(w[1])


class _Weights(dict):
    """The toxic state's weight of tokens, remembered."""

    def __init__(self, field: Field) -> None:
        super().__init__()
        self.emit = field.emit.tolist()

    def __missing__(self, word: bytes) -> float:
        emit = self.emit
        self[word] = value = sum([emit[xxhash.xxh32_intdigest(k) % SLOTS] for k in keys_of(word)])
        return value


def batch_evidence(field: Field, docs: list[list[bytes]], weights: _Weights) -> tuple[np.ndarray, list[np.ndarray]]:
    """Log evidence of each document, and the marginals of all its tokens.

    Documents are swept in overlapping pieces side by side: ``MARGIN`` tokens on, a field of two states has forgotten where
    a piece began, so every token of a whole document gets the marginal of its whole chain. Marginals under 0.05 are no
    evidence, so it does not grow with length alone; beyond 3 it says no more.
    """
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    line = np.fromiter(map(weights.__getitem__, chain.from_iterable(docs)), float, int(lengths.sum()))
    ends = np.cumsum(lengths)
    marginals = np.empty(len(line))
    pieces = -(-lengths // PIECE)
    owner = np.repeat(np.arange(len(docs)), pieces)
    first, last = (ends - lengths)[owner], ends[owner]
    start = first + (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * PIECE
    for lot in np.array_split(np.arange(len(owner)), max(1, len(owner) // 8192)):
        low = np.maximum(start[lot] - MARGIN, first[lot])
        size = np.minimum(start[lot] + PIECE + MARGIN, last[lot]) - low
        if not len(lot):
            continue
        at = low[:, None] + np.arange(int(size.max()))[None, :]
        inside = np.arange(at.shape[1])[None, :] < size[:, None]
        found = field.marginals(np.where(inside, line[np.minimum(at, len(line) - 1)], 0.0), size)
        own = inside & (at >= start[lot][:, None]) & (at < np.minimum(start[lot] + PIECE, last[lot])[:, None])
        marginals[at[own]] = found[own]
    strong = np.concatenate([[0.0], np.cumsum(np.where(marginals >= 0.05, marginals, 0.0))])
    total = strong[ends] - strong[ends - lengths]
    return np.log(1e-3 + np.clip(total, 0, 3.0)), [marginals[e - n : e] for e, n in zip(ends, lengths, strict=True)]


def _scorer(field: Field, text_col: str, score_col: str, with_spans: bool):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _Weights(field)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            if len(weights) > REMEMBERED_WORDS:
                weights.clear()
            raw = [(t or "").encode("utf-8", "replace") for t in batch.column(text_col).to_pylist()]
            evidence, marginals = batch_evidence(field, [r.split() for r in raw], weights)
            scores = 1 / (1 + np.exp(-(field.scale * evidence + field.shift)))
            spans = [pa.array([_spans(text, found) for text, found in zip(raw, marginals, strict=True)], kind)] if with_spans else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores), *spans], [*batch.schema.names, score_col, *[SPANS] * with_spans])

    return score


def _spans(text: bytes, marginals: np.ndarray) -> list[dict]:
    """Character offsets of runs of tokens that are toxic with probability 0.5 or more."""
    if not len(marginals) or not (marginals >= 0.5).any():
        return []
    out, open_at, end = [], None, 0
    for match, toxic in zip(TOKEN.finditer(text), marginals >= 0.5, strict=True):
        if toxic:
            open_at, end = (match.start() if open_at is None else open_at), match.end()
        elif open_at is not None:
            out.append((open_at, end))
            open_at = None
    if open_at is not None:
        out.append((open_at, end))
    return [{"start": len(text[:a].decode("utf-8")), "end": len(text[:b].decode("utf-8"))} for a, b in out]


def fitted(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", parts: int = 4, held: int = 2) -> Field:
    """Field of at most ``SAMPLE`` documents of each label, in digest order, none with crc32(id) mod ``parts`` = ``held``."""
    chosen, _ = learning_sample(docs, labels, label, id_col, parts, held, SAMPLE)
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    rows = texts.join(F.broadcast(chosen), "__id").groupBy("__id", "__label").agg(F.max("__text").alias("__text")).toPandas()
    rows = rows.sort_values("__id", kind="stable")
    toxic, clean = ([t.encode("utf-8", "replace").split() for t in rows.loc[rows["__label"] == y, "__text"]] for y in (1, 0))
    return fit(toxic, clean)


def with_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", parts: int = 4, held: int = 2,
    score_col: str = SCORE, spans: bool = True,
) -> DataFrame:
    """``docs`` with the probability of label 1 in ``score_col`` and, unless turned off, the character offsets of offending
    passages in ``SPANS``, neither of which they may have; no document crosses a shuffle.

    Only the text is an input, and every token of the whole text gets its marginal. Null and empty texts get the score of a
    text without evidence; without both labels all scores are the same; repeated rows are kept; other columns pass unread,
    whatever their names.
    """
    field = fitted(docs, labels, label, id_col, text_col, parts, held)
    added = [T.StructField(score_col, T.DoubleType()), T.StructField(SPANS, T.ArrayType(T.StructType.fromDDL("start long, end long")))]
    return with_scores(docs, text_col, lambda text: _scorer(field, text, score_col, spans), added[: 1 + spans])


def toxicity_scores(docs: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2, threshold: float = 0.3, **columns: str) -> DataFrame:
    """Id, ``held_out`` (the document was kept from learning; null for a null id), ``score``, ``predicted`` (1 from
    ``threshold`` on) and ``spans`` of every row, as ``with_toxicity`` finds them."""
    id_col, text_col = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    scored = with_toxicity(docs.select(id_col, text_col), labels, parts=parts, held=held, **columns)
    held_out = (remainder(id_col, parts) == held).alias("held_out")
    return scored.select(id_col, held_out, F.col(SCORE).alias("score"), (F.col(SCORE) >= threshold).cast("int").alias("predicted"), F.col(SPANS).alias("spans"))
