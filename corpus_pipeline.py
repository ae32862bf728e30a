"""A training corpus from ``documents``: each stage applies one operator to what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm import decontamination, mixing, near_dup, quality, toxicity
from tracelake.llm.common import free_name, table
from tracelake.session import configure, materialise

#: A document is of quality, or toxic, from this probability on.
THRESHOLD = 0.3


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject."""
    score = free_name(docs, "__score")
    scored = quality.with_quality(docs, table(spark, sf_dir, "labels"), score_col=score)
    return scored.where(F.col(score) >= THRESHOLD).drop(score)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity field does not reject."""
    score = free_name(docs, "__score")
    scored = toxicity.with_toxicity(docs, table(spark, sf_dir, "labels"), score_col=score, spans=False)
    return scored.where(F.col(score) < THRESHOLD).drop(score)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dup.one_of_each_group(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents and how many of their words each pass takes, with their place in it."""
    return mixing.weighted_fair_mix(docs).where("taken > 0").drop("row")


STAGES = [("quality", good), ("toxicity", civil), ("near duplicates", distinct), ("decontamination", clean), ("mixing", mixed)]
#: Learned models and the join on minwise values are no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole of ``documents``; each result is written and read again."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
