"""Bounded, reproducible samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.llm.common import small_batches
from tracelake.session import materialise

SCORE = "__score"


def remainder(id_col: str, parts: int):
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def one_label(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """``__id`` and ``__label`` (0 or 1) of every labelled id; an id labelled twice takes the larger label."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label).cast("int")).alias("__label"))


def bounded_sample(rows: DataFrame, label: int, bound: int) -> DataFrame:
    """At most ``bound`` rows of one label, in the order of a digest of their ids."""
    return rows.where(F.col("__label") == label).orderBy(F.xxhash64("__id", F.lit(17)), "__id").limit(bound)


def learning_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, parts: int, held: int, bound: int) -> tuple[DataFrame, dict[int, int]]:
    """``__id`` and ``__label`` of the documents to learn from, at most ``bound`` of each label, and how many each label has."""
    ids = docs.select(F.col(id_col).alias("__id")).where(remainder("__id", parts) != held).distinct()
    known = materialise(ids.join(one_label(labels, label, id_col), "__id"), "labelled")
    counts = {r["__label"]: r["count"] for r in known.groupBy("__label").count().collect()}
    return materialise(bounded_sample(known, 0, bound).unionByName(bounded_sample(known, 1, bound)), "learning"), counts


def with_scores(docs: DataFrame, text_col: str, scorer: Callable, added: Sequence[T.StructField]) -> DataFrame:
    """``docs`` with the columns that ``scorer(name of the text column)`` adds to Arrow batches. Inside, columns have plain
    names, for theirs may hold anything."""
    plain = [f"c{i}" for i in range(len(docs.columns))]
    fields = [T.StructField(n, f.dataType) for n, f in zip(plain, docs.schema.fields, strict=True)]
    rows = small_batches(docs.toDF(*plain)).mapInArrow(scorer(plain[docs.columns.index(text_col)]), T.StructType([*fields, *added]))
    return rows.toDF(*docs.columns, *[f.name for f in added])
