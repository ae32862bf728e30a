import zlib

import numpy as np
import pytest

from tests_support import SF, documents, rows  # noqa: F401
from tracelake.llm import queries, sharding
from tracelake.llm.sharding import Permutation, placements, row_at, shard_size, shuffled, write_shards

WORD = 2**64


def plain_place(row, n, seed=sharding.SEED):
    """The permutation once more, on whole numbers, one row at a time."""

    def mixed(z):
        z = (z ^ (z >> 30)) * 0xBF58476D1CE4E5B9 % WORD
        z = (z ^ (z >> 27)) * 0x94D049BB133111EB % WORD
        return z ^ (z >> 31)

    base = next(b for b in range(1, n + 2) if b * b >= n)
    keys = [mixed((r + seed) * 0x9E3779B97F4A7C15 % WORD) for r in range(1, 9)]
    while True:
        a, b = divmod(row, base)
        for key in keys:
            a, b = b, (a + mixed(b ^ key) % base) % base
        row = a * base + b
        if row < n:
            return row


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 99, 1000, 10_007])
def test_permutation_is_a_bijection_with_an_inverse(n):
    there = Permutation(n).forward(np.arange(n))
    assert sorted(there) == list(range(n))
    assert list(Permutation(n).inverse(there)) == list(range(n))
    assert list(there[:50]) == [plain_place(i, n) for i in range(min(n, 50))]


def test_permutation_depends_on_its_seed_and_mixes():
    n = 4096
    a, b = Permutation(n, 1).forward(np.arange(n)), Permutation(n, 2).forward(np.arange(n))
    assert (a == b).sum() < 20
    assert abs(np.corrcoef(np.arange(n), a)[0, 1]) < 0.08
    assert abs(np.corrcoef(a[:-1], a[1:])[0, 1]) < 0.08
    big = Permutation(10**13)
    far = np.array([0, 1, 10**12, 10**13 - 1])
    assert list(big.inverse(big.forward(far))) == list(far)
    with pytest.raises(ValueError):
        big.forward(np.array([10**13]))


def test_query_equals_the_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    n = len(docs)
    got = {r.doc_id: r for r in queries.QUERIES["op11_feistel_shards"](spark, SF).collect()}
    assert len(got) == n
    for row, doc in enumerate(docs):
        place = plain_place(row, n)
        body = doc.text.encode()
        want = (len(body) + 1, zlib.crc32(body), "rows", place % 16, place // 16, None)
        found = got[doc.doc_id]
        assert (found["size"], found.text_crc32, found.law, found.shard, found.slot, found.grown_shard) == want


def test_rows_do_not_depend_on_partitions_and_can_be_found(spark, documents):
    many = [(i % 40, f"text {i % 7}") for i in range(300)] + [(None, None)] * 150 + [(None, "")] * 50
    docs = documents(many)
    first = rows(placements(docs.repartition(7)), "doc_id", "size", "text_crc32", "row", "shard", "slot")
    assert first == rows(placements(docs.coalesce(1)), "doc_id", "size", "text_crc32", "row", "shard", "slot")
    per_shard = {}
    for _, _, _, row, shard, slot in first:
        per_shard.setdefault(shard, []).append(slot)
        assert row_at(shard, slot, len(many)) == row
    assert sorted(r[3] for r in first) == list(range(len(many)))
    for shard, slots in per_shard.items():
        assert sorted(slots) == list(range(shard_size(len(many), shard)))
    with pytest.raises(ValueError):
        row_at(0, len(many), len(many))


def test_ranges_grow_with_the_rows(spark, documents, monkeypatch):
    from tracelake.llm import common

    docs = documents([(i, "x") for i in range(200)])
    want = rows(placements(docs), "doc_id", "shard", "slot")
    monkeypatch.setattr(common, "ROWS_PER_RANGE", 10)
    assert rows(placements(docs), "doc_id", "shard", "slot") == want


def test_odd_tables(spark, documents):
    assert placements(documents([])).count() == 0
    one = placements(documents([(5, "é" * 100_000)])).first()
    assert (one.doc_id, one["size"], one.shard, one.slot) == (5, 200_001, 0, 0)
    clash = documents([(1, "a"), (2, None)]).selectExpr("*", "7 AS row", "8 AS shard", "9 AS __o0")
    whole = shuffled(clash)
    assert sorted(r.row for r in whole.collect()) == [0, 1]
    assert placements(clash).columns == ["doc_id", "size", "text_crc32", "row", "shard", "slot"]


def test_written_shards_hold_every_document_in_slot_order(spark, documents, tmp_path):
    docs = documents([(i, f"text {i}") for i in range(100)])
    path = f"{tmp_path}/shards"
    write_shards(docs, path, shards=4)
    back = spark.read.parquet(path)
    assert rows(back, "doc_id", "text") == rows(docs, "doc_id", "text")
    assert rows(back, "doc_id", "shard", "slot") == rows(placements(docs, shards=4), "doc_id", "shard", "slot")
    for f in back.select("shard", "slot", "_metadata.file_path").groupBy("file_path").agg({"slot": "collect_list"}).collect():
        assert list(f[1]) == sorted(f[1])
