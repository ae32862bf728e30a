"""Shards of a reproducible shuffle: a Feistel permutation of global row numbers with cycle walking."""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import columns_of, numbered

SHARDS = 16
SEED = 20240131
ROUNDS = 8

# The odd step and the two multipliers of the published 64-bit mixing function of split generators.
STEP = 0x9E3779B97F4A7C15
FIRST_FACTOR = 0xBF58476D1CE4E5B9
SECOND_FACTOR = 0x94D049BB133111EB

PLACED = ["row", "shard", "slot"]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(FIRST_FACTOR)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(SECOND_FACTOR)
    return values ^ (values >> np.uint64(31))


class Permutation:
    """A bijection of the numbers below ``n`` that only ``n`` and ``seed`` decide.

    A number is a pair of digits to the base ``ceil(sqrt(n))``; each round adds a keyed mix of one digit to the other and
    swaps them. The square may hold a few numbers that are not below ``n``: whoever lands there goes on walking the
    cycle until it is back below ``n``, which keeps the map a bijection.
    """

    def __init__(self, n: int, seed: int = SEED):
        self.n = n
        self.base = np.uint64(max(1, isqrt(max(n - 1, 0)) + 1))
        with np.errstate(over="ignore"):
            self.keys = _mixed((np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(seed % 2**64)) * np.uint64(STEP))

    def _walk(self, numbers: np.ndarray, once) -> np.ndarray:
        found = np.asarray(numbers).astype(np.uint64)
        if found.size and int(found.max()) >= self.n:
            raise ValueError(f"numbers must be below {self.n}")
        found = once(found)
        while (out := found >= np.uint64(self.n)).any():
            found[out] = once(found[out])
        return found.astype(np.int64)

    def _there(self, numbers: np.ndarray) -> np.ndarray:
        left, right = numbers // self.base, numbers % self.base
        for key in self.keys:
            left, right = right, (left + _mixed(right ^ key) % self.base) % self.base
        return left * self.base + right

    def _back(self, numbers: np.ndarray) -> np.ndarray:
        left, right = numbers // self.base, numbers % self.base
        for key in self.keys[::-1]:
            left, right = (right + self.base - _mixed(left ^ key) % self.base) % self.base, left
        return left * self.base + right

    def forward(self, rows: np.ndarray) -> np.ndarray:
        """Places of the given rows in the shuffle."""
        return self._walk(rows, self._there)

    def inverse(self, places: np.ndarray) -> np.ndarray:
        """Rows at the given places of the shuffle."""
        return self._walk(places, self._back)


def shard_size(n: int, shard: int, shards: int = SHARDS) -> int:
    """Rows of a shard: its slots are 0 to this number less one."""
    return (n - shard + shards - 1) // shards


def row_at(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """Global row number at a slot of a shard, without reading anything."""
    if not (0 <= shard < shards and 0 <= slot < shard_size(n, shard, shards)):
        raise ValueError(f"no slot {slot} in shard {shard}")
    return int(Permutation(n, seed).inverse(np.array([slot * shards + shard]))[0])


def _placed(df: DataFrame, n: int, shards: int, seed: int) -> DataFrame:
    permutation = Permutation(n, seed)

    @F.pandas_udf("long")
    def place(rows: pd.Series) -> pd.Series:
        return pd.Series(permutation.forward(rows.to_numpy()))

    at = df.withColumn("__place", place("row"))
    return at.withColumn("shard", (F.col("__place") % shards).cast("int")).withColumn("slot", F.floor(F.col("__place") / shards)).drop("__place")


def _order(ident: Column, text: Column) -> list[Column]:
    return [ident.isNotNull(), ident, F.xxhash64(text), F.crc32(text), text.isNotNull()]


def placements(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Where every document goes: ``id_col``, ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``row``, ``shard``, ``slot``.

    Documents are numbered by id (null first), then by two digests of the text; the permutation of that number gives the
    place in the shuffle, the rest by ``shards`` the shard and the quotient the slot. So shards differ by one document at
    most, slots have no gaps, and any of them can be computed both ways (``Permutation``, ``row_at``). Seed, ids and texts
    decide, not files or partitions. Only ids, sizes and digests are shuffled, no text.

    Every row counts, repeated ones each; which of two equal rows takes which of their places makes no difference. A null
    text has no bytes and the checksum of an empty one, but is numbered before it; an empty table gives no rows; other
    columns are ignored.
    """
    ident, text = F.col(id_col), F.col(text_col)
    body = F.coalesce(text, F.lit(""))
    rows = docs.select(
        ident.alias(id_col), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        *[c.alias(f"__k{i}") for i, c in enumerate(_order(ident, text))],
    )
    keys = [f"__k{i}" for i in range(5)]
    found, n = numbered(rows, [F.col(k) for k in keys], "row", "shard")
    return _placed(found.drop(*keys), n, shards, seed)


def shuffled(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole documents with ``row``, ``shard`` and ``slot`` as ``placements`` gives them. Columns of these names are replaced."""
    kept = docs.select(*[c for c, name in zip(columns_of(docs), docs.columns) if name.lower() not in PLACED])
    found, n = numbered(kept, _order(F.col(id_col), F.col(text_col)), "row", "shuffle")
    return _placed(found, n, shards, seed)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write whole documents to one folder a shard, ``shard=0`` to ``shard=15``, in files that follow the slots."""
    placed = shuffled(docs, shards, seed, id_col, text_col)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
