"""Document quality by a generalised additive model with pairwise interactions.

Every feature and every chosen pair of features has a lookup table over bins. The tables are learned by boosting shallow
trees in turn, a small step each; a document's score is the sum of its table entries through the logistic function.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.llm.common import small_batches
from tracelake.llm.labelled import SCORE, learning_sample, remainder, with_scores

FEATURES = (
    "log_words", "word_length", "upper_share", "symbol_share", "digit_share", "symbol_word_share", "symbol_tail_share", "repeat_share",
    "distinct_share", "top_word_share", "line_length", "repeated_line_share", "sentence_share", "exclaim_share", "short_word_share", "shout_share",
)
#: Labelled rows of each class that the model is fitted on.
SAMPLE = 10_000
BINS = 48
PAIR_BINS = 8
PAIRS = 10
ROUNDS = 120
RATE = 0.1
LEAST_ROWS = 5

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_ORDINARY = _LETTER | _DIGIT | _BLANK
_ORDINARY[[ord(c) for c in ".,;:'\"-()?!"]] = True


def _wordy(word: bytes) -> bool:
    """The word holds a letter or digit; bytes beyond ASCII count as letters."""
    return not word.isascii() or any(bytes([b]).isalnum() for b in word)


def text_features(text: str | None) -> list[float]:
    """Shape of a text as numbers, in the order of ``FEATURES``; null and empty texts are all zeros."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = max(1, int(kinds[_LETTER].sum()))
    inked = len(raw) - int(kinds[_BLANK].sum())
    counts = Counter(words)
    lines = [line for line in raw.split(b"\n") if line]
    tails = sum(c for w, c in counts.items() if w[-1] < 128 and w[-2:-1] == w[-1:] and not w[-1:].isalnum())
    return [
        float(np.log1p(n)),
        inked / n,
        kinds[_UPPER].sum() / letters,
        kinds[~_ORDINARY].sum() / inked,
        kinds[_DIGIT].sum() / inked,
        sum(c for w, c in counts.items() if len(w) <= 3 and not _wordy(w)) / n,
        tails / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        len(counts) / n,
        max(counts.values()) / n,
        min(inked / max(1, len(lines)), 1e4),
        1 - len(set(lines)) / max(1, len(lines)),
        (kinds[46] + kinds[33] + kinds[63]) / n,
        kinds[33] / n,
        sum(map((4).__gt__, map(len, words))) / n,
        sum(map(bytes.isupper, words)) / n,
    ]


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_features(t) for t in batch.column("__text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("__label"), pa.array(rows, pa.list_(pa.float64()))], ["label", "features"])


@dataclass
class AdditiveModel:
    """``cuts[f]`` are the bin edges of feature f, ``single[f]`` its table, ``pairs[(f, g)]`` the table of two features over
    coarse bins with edges ``coarse``."""

    intercept: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    single: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        total = np.full(len(x), self.intercept)
        for f, table in enumerate(self.single):
            total += table[np.searchsorted(self.cuts[f], x[:, f], side="right")]
        for (f, g), table in self.pairs.items():
            total += table[np.searchsorted(self.coarse[f], x[:, f], side="right"), np.searchsorted(self.coarse[g], x[:, g], side="right")]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def _cut_gain(slope: np.ndarray, curve: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain and the two leaf values of every cut of a row of bins (last axis)."""
    left, right = np.cumsum(slope, -1)[..., :-1], np.cumsum(slope[..., ::-1], -1)[..., ::-1][..., 1:]
    low, high = np.cumsum(curve, -1)[..., :-1] + 1, np.cumsum(curve[..., ::-1], -1)[..., ::-1][..., 1:] + 1
    few = np.minimum(np.cumsum(rows, -1)[..., :-1], np.cumsum(rows[..., ::-1], -1)[..., ::-1][..., 1:]) < LEAST_ROWS
    return np.where(few, -1.0, left**2 / low + right**2 / high), left / low, right / high


def _tree(slope: np.ndarray, curve: np.ndarray, rows: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value of each bin, from a tree of at most ``depth`` cuts on the way to a leaf."""
    whole = slope.sum() / (curve.sum() + 1)
    if depth == 0 or len(slope) < 2:
        return np.full(len(slope), whole)
    gain, _, _ = _cut_gain(slope, curve, rows)
    at = int(gain.argmax())
    if gain[at] <= slope.sum() ** 2 / (curve.sum() + 1):
        return np.full(len(slope), whole)
    halves = (slice(None, at + 1), slice(at + 1, None))
    return np.concatenate([_tree(slope[h], curve[h], rows[h], depth - 1) for h in halves])


def _pair_tree(slope: np.ndarray, curve: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, float]:
    """Best tree that cuts one feature and then the other on either side: its leaf values over the grid, and its gain."""
    best, table = -1.0, np.zeros_like(slope)
    for flip in (False, True):
        s, c, r = (a.T if flip else a for a in (slope, curve, rows))
        for at in range(1, len(s)):
            parts, gain = [], 0.0
            for h in (slice(None, at), slice(at, None)):
                line = [a[h].sum(axis=0) for a in (s, c, r)]
                gains, low, high = _cut_gain(*line)
                cut = int(gains.argmax()) if len(gains) else -1
                whole = line[0].sum() ** 2 / (line[1].sum() + 1)
                if cut < 0 or gains[cut] <= whole:
                    values = np.full(len(line[0]), line[0].sum() / (line[1].sum() + 1))
                    gain += whole
                else:
                    values = np.where(np.arange(len(line[0])) <= cut, low[cut], high[cut])
                    gain += gains[cut]
                parts.append(np.tile(values, (len(s[h]), 1)))
            if gain > best:
                found = np.vstack(parts)
                best, table = gain, found.T if flip else found
    return table, best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Model of label ``y`` (0 or 1). Without both labels only the intercept is learned: the share of 1, 0.5 without rows."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(intercept=float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    model.cuts = [_edges(x[:, f], BINS) for f in range(x.shape[1])]
    model.coarse = [_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    bins = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.cuts)]
    coarse = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.coarse)]
    model.single = [np.zeros(len(c) + 1) for c in model.cuts]
    total = np.full(len(y), model.intercept)

    def sums(place: np.ndarray, size: int) -> list[np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return [np.bincount(place, w, size) for w in (y - p, p * (1 - p), np.ones(len(y)))]

    for _ in range(ROUNDS):
        for f, table in enumerate(model.single):
            step = RATE * _tree(*sums(bins[f], len(table)))
            table += step
            total += step[bins[f]]
    grids = {}
    for f, g in combinations(range(x.shape[1]), 2):
        shape = (len(model.coarse[f]) + 1, len(model.coarse[g]) + 1)
        if min(shape) > 1:
            grids[f, g] = (coarse[f] * shape[1] + coarse[g], shape)
    gains = {k: _pair_tree(*[a.reshape(shape) for a in sums(place, shape[0] * shape[1])])[1] for k, (place, shape) in grids.items()}
    for k in sorted(gains, key=lambda k: (-gains[k], k))[:PAIRS]:
        model.pairs[k] = np.zeros(grids[k][1])
    for _ in range(ROUNDS // 4 if model.pairs else 0):
        for k, table in model.pairs.items():
            place, shape = grids[k]
            step = RATE * _pair_tree(*[a.reshape(shape) for a in sums(place, shape[0] * shape[1])])[0]
            table += step
            total += step.ravel()[place]
    return model


def _scorer(model: AdditiveModel, text_col: str, score_col: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([text_features(t) for t in batch.column(text_col).to_pylist()], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], [*batch.schema.names, score_col])

    return score


def fitted(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", parts: int = 5, held: int = 0) -> AdditiveModel:
    """Model of at most ``SAMPLE`` documents of each label, in digest order, none with crc32(id) mod ``parts`` = ``held``.

    Ids are chosen first, so only the sample's texts become features, and only features reach the driver.
    """
    chosen, counts = learning_sample(docs, labels, label, id_col, parts, held, SAMPLE)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    rows = small_batches(texts.join(F.broadcast(chosen), "__id")).select("__label", "__text").mapInArrow(_featured, "label int, features array<double>").toPandas()
    rows = rows.iloc[np.lexsort(np.array(rows["features"].tolist()).T)] if len(rows) else rows  # no order of tasks in the sums
    y = rows["label"].to_numpy(float)
    model = fit(np.array(rows["features"].tolist(), float).reshape(len(rows), len(FEATURES)), y)
    if 0 < y.sum() < len(y):  # from the sample's share of labels to that of all labelled rows
        model.intercept += float(np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum())))
    return model


def with_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", parts: int = 5, held: int = 0, score_col: str = SCORE
) -> DataFrame:
    """``docs`` with the probability of label 1 in ``score_col``, which they must not have; no document crosses a shuffle.

    Only what the whole text shows is an input. Null and empty texts get a score too; without labels all scores are 0.5;
    repeated rows are kept; other columns pass unread, whatever their names.
    """
    model = fitted(docs, labels, label, id_col, text_col, parts, held)
    return with_scores(docs, text_col, lambda text: _scorer(model, text, score_col), [T.StructField(score_col, T.DoubleType())])


def quality_scores(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0, threshold: float = 0.3, **columns: str) -> DataFrame:
    """Id, ``held_out`` (the document was kept from learning; null for a null id), ``score`` and ``predicted`` (1 from
    ``threshold`` on) of every row, as ``with_quality`` finds them."""
    id_col, text_col = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    scored = with_quality(docs.select(id_col, text_col), labels, parts=parts, held=held, **columns)
    return scored.select(id_col, (remainder(id_col, parts) == held).alias("held_out"), F.col(SCORE).alias("score"), (F.col(SCORE) >= threshold).cast("int").alias("predicted"))
