import datetime as dt
import random
import textwrap
import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests_support import documents, rows  # noqa: F401
from tracelake.llm import token_counts, url_filters
from tracelake.llm.licenses import license_digest, license_matches
from tracelake.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = [*"aAbBzé́İΣςß'’\n\t\x0b\x1c\x85\xa0 　½日🙂#$%.,-\x00", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "'s", "don't ", "  ", "\r\n"]


def some_texts(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_words_add_up_to_the_library_count():
    tokenizer, count = Tokenizer.from_file(PATH), token_counts.word_counter(PATH)
    texts = some_texts(1, 4000)
    assert count(texts) == [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_counts_and_cache(spark, documents):
    tokenizer = Tokenizer.from_file(PATH)
    texts = [*some_texts(2, 80), "same text"] * 2 + ["same \n text", "", "the word " * 20_000]
    docs = [(i, t) for i, t in enumerate(texts)] + [(900, None), (None, "nameless text"), (3, texts[3])]
    cache = scratch_path(spark, "cache")
    got = token_counts.count_tokens(documents(docs), PATH, cache)
    want = sorted(((i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False))) for i, t in docs), key=repr)
    assert rows(got, "doc_id", "n_bytes", "n_tokens") == want
    stored = spark.read.parquet(cache)
    before = stored.count()
    assert before == stored.select("digest").distinct().count()
    more = token_counts.count_tokens(documents([*docs, (901, "new text")]), PATH, cache)
    assert more.count() == len(docs) + 1
    assert spark.read.parquet(cache).count() == before + 1  # only the new content was encoded
    assert token_counts.count_tokens(documents([]), PATH, scratch_path(spark, "cache")).count() == 0


def test_cached_counts_are_used(spark, documents):
    cache = scratch_path(spark, "cache")
    digest = documents([(1, "a b")]).select(token_counts.content_digest(F.col("text"))).first()[0]
    spark.createDataFrame([(token_counts.tokenizer_version(PATH), digest, 77), ("other", digest, 5)], token_counts.CACHE).write.parquet(cache)
    assert rows(token_counts.count_tokens(documents([(1, " a  b ")]), PATH, cache), "n_tokens") == [(77,)]


def test_licences(spark, documents):
    body = "Permission is granted, free of charge: to any licence holder's favourite programme."
    known = spark.createDataFrame([(7, f"Copyright (c) 2020 A. Author\n{body}"), (3, body), (9, None), (11, "Copyright 1999 nobody"), (None, "x")], "license_id long, text string")
    docs = [
        (1, body), (2, body.upper().replace(",", "")), (3, f"  © 2024 Somebody\n{body}\n"), (4, "permission is granted free of charge to any license holder s favorite program"),
        (5, f"More before. {body}"), (6, None), (7, ""), (8, "Copyright 2001 me"), (1, body),
    ]
    got = license_matches(documents(docs), known)
    assert rows(got, "doc_id", "license_id") == [(1, 3), (1, 3), (2, 3), (3, 3), (4, 3)]
    assert license_matches(documents([]), known).count() == 0
    assert license_matches(documents(docs), known.limit(0)).count() == 0


BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that: redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer. (c) You must retain all copyright and related notices; copyright law, the Copyright Act and "
    "Copyright License apply. In no event shall the copyright owner or contributors be liable."
)


@pytest.mark.parametrize("width", [20, 31, 47, 70, 100_000])
@pytest.mark.parametrize("case", [str, str.upper, str.lower])
def test_a_licence_has_one_digest_however_it_is_wrapped(spark, width, case):
    wrapped = "\n * ".join(textwrap.wrap(BSD, width))
    starts = [
        "", "Copyright (c) 2020 X. ", "Copyright 2014 Acme, Inc. and J. Q. Public. All rights reserved.\n", "Copyright (c) 2020 Jane Doe ", "/* © 2021 Acme\n * All rights reserved.\n */",
        "Copyright (c) 1999, 2001 A. Author,\n  B. Author and\n  others\nCopyright 2002 C <c@d.example>\n", "(c) 2010-2012 Acme Ltd. ", "Copyright [yyyy] [name of copyright owner]\n", "Copyright The Example Authors. ",
    ]
    texts = [BSD, *[case(s if case is not str.lower or "The" not in s else "") + case(wrapped) for s in starts]]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(license_digest(F.col("t"))).collect()
    assert [r[0] == found[0][0] for r in found] == [True] * len(texts)


def test_only_statements_are_deleted(spark):
    pairs = [
        ("Do not remove the\ncopyright notice, please.", "Do not remove the\nplease."), ("(c) You must keep it.\nEnd", "End"), ("copyright law applies\nEnd", "End"),
        ("Copyright (c) 2020 X. Permission is hereby granted.", "Copyright (c) 2020 X. Permission is refused."), ("Copyright Law applies.\nEnd", "End"),
        ("under\ncopyright doctrines of fair use", "under"), ("Copyright 2020 " + "A B " * 100_000 + ". Yes", "No"),
    ]
    for a, b in spark.createDataFrame(pairs, "a string, b string").select(license_digest(F.col("a")), license_digest(F.col("b"))).collect():
        assert a and b and a != b


ENTRIES = [
    ("ads", "d:bad.example", "2023-01-10", "add"), ("ads", "d:bad.example", "2023-02-01", "remove"), ("ads", "d:bad.example", "2024-06-01", "add"),
    ("spam", "d:bad.example", "2023-01-20", "add"), ("spam", "u:ok.example/a/b", "2023-01-01", "add"),
    ("same", "d:day.example", "2023-03-01", "remove"), ("same", "d:day.example", "2023-03-01", "add"), (None, "d:x.example", "2023-01-01", "add"), ("odd", "d:x.example", "2023-01-01", "pause"),
]
CAPTURES = [
    (1, "http://www.bad.example/", "2023-01-09", []), (2, "http://www.BAD.example:80/x", "2023-01-10", ["ads"]), (3, "https://u@bad.example", "2023-01-31", ["ads", "spam"]),
    (4, "http://bad.example./", "2023-02-01", ["spam"]), (5, "http://notbad.example/", "2023-01-15", []), (6, "http://ok.example/a/b/c?q", "2023-05-05", ["spam"]), (7, "http://ok.example/a/bc", "2023-05-05", []),
    (8, "http://bad.example/", "2025-01-01", ["ads", "spam"]), (9, "http://day.example/", "2023-03-01", ["same"]), (10, None, "2023-03-01", []), (11, "no url", "2023-03-01", []), (12, "http://bad.example/", None, []), (13, "http://x.example/", "2024-01-01", []), (2, "http://www.BAD.example:80/x", "2023-01-10", ["ads"]),
]


def day(value):
    return dt.date.fromisoformat(value) if value else None


def test_entries_hold_for_their_time(spark):
    entries = spark.createDataFrame([(n, k, day(d), a) for n, k, d, a in ENTRIES], "list string, key string, day date, action string")
    captures = spark.createDataFrame([(i, u, day(d), "x", "y") for i, u, d, _ in CAPTURES], "id long, url string, fetched date, key string, year string")
    got = url_filters.filtered(captures, entries)
    assert rows(got, "id", "lists", "blocked") == sorted(((i, lists, bool(lists)) for i, _, _, lists in CAPTURES), key=repr)
    assert url_filters.filtered(captures.limit(0), entries).count() == 0
    assert rows(url_filters.filtered(captures, entries.limit(0)), "blocked") == [(False,)] * len(CAPTURES)


@pytest.mark.parametrize(
    ("url", "keys"),
    [
        ("http://a.b.example/x/y.html?q#f", {"d:a.b.example", "d:b.example", "u:a.b.example/x", "u:a.b.example/x/y.html"}),
        ("https://example/", {"d:example", "u:example/"}), ("ftp:/nothing", set()), ("", set()),
    ],
)
def test_url_keys(spark, url, keys):
    assert set(spark.createDataFrame([(url,)], "u string").select(url_filters.url_keys(F.col("u"))).first()[0]) == keys


def test_long_urls_cost_their_length(spark):
    deep = "http://ok.example/" + "/".join(f"f{i}" for i in range(30_000))
    wide = "http://" + "a." * 20_000 + "bad.example/x"
    keys = ["u:ok.example/f0/f1", "u:ok.example/f0/f2", "u:" + deep[7:], "d:bad.example", "odd", "u:", "d:"]
    entries = spark.createDataFrame([(str(i), k, day("2023-01-01"), "add") for i, k in enumerate(keys)], "list string, key string, day date, action string")
    captures = spark.createDataFrame([(i, u, day("2023-05-05")) for i, u in enumerate([deep, wide, deep + "/more", "http://ok.example//f0"])], "id long, url string, fetched date")
    assert url_filters.key_lengths(entries) == ([1, 2], [2, 30_000])
    began = time.perf_counter()
    got = rows(url_filters.filtered(captures, entries), "id", "lists")
    assert got == [(0, ["0", "2"]), (1, ["3"]), (2, ["0", "2"]), (3, [])]
    assert time.perf_counter() - began < 60  # every prefix of these took minutes


@pytest.mark.parametrize("url", ["http://a.b.c.example/x/y/z/", "http://example", "http://a..b/x//y", "http://h.example/?q"])
def test_keys_of_some_lengths_are_those_of_all(spark, url):
    some = spark.createDataFrame([(url,)], "u string").select(url_filters.url_keys(F.col("u")).alias("all"), url_filters.url_keys(F.col("u"), [2, 4], [1, 3]).alias("some")).first()
    lengths = {"d": (".", 1, {2, 4}), "u": ("/", 0, {1, 3})}
    assert sorted(some["some"]) == sorted(k for k in some["all"] if k[2:].count(lengths[k[0]][0]) + lengths[k[0]][1] in lengths[k[0]][2])
