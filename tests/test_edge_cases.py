"""Rows that once gave a wrong result or a crash."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tracelake.functions.text import markdown_sections
from tracelake.operators import governance as G
from tracelake.operators.retrieval import topk_similar
from tracelake.sources.readers import read_tree


def test_bad_bytes_and_repeated_folder_names(spark, tmp_path):
    root = tmp_path / "community" / "x" / "community"
    (root / "mine").mkdir(parents=True)
    (root / "mine" / "app.py").write_bytes(b"key = 'k-1' # caf\xe9")
    (root / "mine" / "deep").mkdir()
    (root / "mine" / "deep" / "b.md").write_text("ok")
    assert rows(read_tree(spark, str(root))) == [("mine", "app.py", "key = 'k-1' # caf�"), ("mine", "deep/b.md", "ok")]


def test_bare_heading_marks_take_no_next_line(spark):
    text = "## One\nbody\n##\nnot a heading\n##  Two\nmore"
    found = spark.createDataFrame([(text,)], "t string").select(markdown_sections(F.col("t"))).first()[0]
    assert found == {"One": "body\n##\nnot a heading", "Two": "more"}


@pytest.mark.parametrize("conditions", [{"env2": "y", "env": "x"}, {"a": "1&b=2"}, {"b": "2", "a": "1"}, {}])
def test_both_slice_labels_agree(spark, conditions):
    frame = spark.createDataFrame([(conditions,)], "c map<string,string>")
    assert frame.select(G.slice_label_of(F.col("c"))).first()[0] == G.slice_label(conditions)


def test_slices_of_one_label_and_repeated_traces(spark):
    traces = spark.createDataFrame([("t", {"a": "1", "b": "2"}), ("t", {"a": "1", "b": "2"}), ("u", {"a": "1&b=2"})], "trace_id string, metadata map<string,string>")
    slices = spark.createDataFrame([({"a": "1", "b": "2"},), ({"a": "1&b=2"},), ({"a": "1", "b": "2"},)], "conditions map<string,string>")
    found = rows(G.slice_traces_by_table(traces, slices).where("slice <> 'all'"), "trace_id", "slice")
    assert found == [("t", "a=1&b=2"), ("t", "a=1&b=2"), ("u", "a=1&b=2")]


def test_null_vectors_and_repeated_queries(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0])], "id long, embedding array<double>")
    queries = spark.createDataFrame([("q", [1.0, 0.1]), ("q", [1.0, 0.1]), ("n", None)], "query_id string, embedding array<double>")
    assert rows(topk_similar(queries, corpus, 5), "query_id", "id", "rank") == [("q", 1, 1), ("q", 3, 2)]
