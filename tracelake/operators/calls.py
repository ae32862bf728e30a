"""Call summaries and their categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.distribution import spread_join
from tracelake.functions.text import parse_action_items, render_braces
from tracelake.operators.tables import insert_absent, patch
from tracelake.session import small_frame

# The category of a call that names none, and the categories every installation has.
DEFAULT_CATEGORY = "other"
CATEGORIES = {
    "sales": "Talks about buying, with people who may or do buy",
    "support": "Help with a product or service in use",
    "interview": "Talks with applicants for a job",
    "meeting": "Meetings of people who work together",
    "other": "Everything else",
}


def default_categories(spark: SparkSession) -> DataFrame:
    rows = [(n, n, d, f"Summarize the following {n} call.\n\nTranscript:\n{{transcript}}") for n, d in CATEGORIES.items()]
    return small_frame(spark, rows, "key string, name string, description string, prompt_template string")


def ensure_categories(categories: DataFrame, wanted: DataFrame) -> DataFrame:
    return insert_absent(categories, wanted, "key")


def update_category(categories: DataFrame, changes: DataFrame) -> DataFrame:
    """Changed fields win; a category that is renamed stays under its old key."""
    known = [c for c in changes.columns if c in categories.columns]
    keyed = changes.select(*known).withColumn("key", F.lower("key"))
    return patch(categories, keyed, "key")


def by_category(df: DataFrame, category: str) -> DataFrame:
    return df if category == "All" else df.where(F.col("category") == category)


def categories_of(df: DataFrame) -> DataFrame:
    return df.select("category").distinct().orderBy("category")


def with_category(calls: DataFrame, categories: DataFrame, spread_by: str = "id") -> tuple[DataFrame, DataFrame]:
    """Calls with their category's fields, and the calls that name an unknown category."""
    keyed = calls.withColumn("key", F.lower(F.coalesce(F.nullif(F.col("category"), F.lit("")), F.lit(DEFAULT_CATEGORY))))
    dim = categories.select("key", F.col("name").alias("category_name"), "prompt_template")
    joined = spread_join(keyed, dim, ["key"], "left", spread_by)
    known = F.col("category_name").isNotNull()
    return joined.where(known), joined.where(~known).select(*calls.columns)


def call_prompts(calls: DataFrame) -> DataFrame:
    """Prompt of each call from its category's template."""
    return calls.withColumn("prompt", render_braces(F.col("prompt_template"), {"transcript": F.col("transcript")}))


def with_action_items(calls: DataFrame, text: str = "action_items_text", legacy: bool = True) -> DataFrame:
    return calls.withColumn("action_items", parse_action_items(F.col(text), legacy))
