"""Checks of community entries and text corpora, as tables of findings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions import text
from tracelake.operators.tables import tables_equal

# Entry requirements. Those that carry the product's name are built from it below.
REQUIRED_STRINGS = ["title", "description", "author"]
REQUIRED_SECTIONS = ["What I built", "Problem it solves", "What I learned"]
PLATFORMS = ["cloud", "self-hosted"]
TEXT_SUFFIXES = ["py", "ipynb", "md", "txt", "yaml", "yml", "toml", "sh", "json"]
CODE_SUFFIXES = ["py", "ipynb"]
SECRET_PATTERNS = [
    r"sk-ant-[A-Za-z0-9_-]{20,}",
    r"sk-(?:proj|svcacct)-[A-Za-z0-9_-]{20,}",
    r"sk-[A-Za-z0-9]{20,}",
]


def required_sections(product: str) -> list[str]:
    return [*REQUIRED_SECTIONS, f"How I used {product.capitalize()}"]


def proof_file(product: str) -> str:
    return f"{product}-proof.png"


def code_markers(product: str) -> list[str]:
    name = product.capitalize()
    return [f"import {product}", f"from {product}", f"@{product}.track", f"{product}.{name}(", f"{product.upper()}_"]


def secret_patterns(product: str) -> list[str]:
    return [*SECRET_PATTERNS, rf"{product.upper()}_API_KEY\s*[=:]\s*[\"'][^\"']+[\"']"]


def any_pattern(column: Column, patterns: Sequence[str]) -> Column:
    """Any of the patterns occurs. Kept apart: each can be searched by its literal start, which one alternation cannot."""
    found = F.lit(False)
    for pattern in patterns:
        found = found | column.rlike(pattern)
    return F.coalesce(found, F.lit(False))


def _suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def _filled(value: Column) -> Column:
    return F.coalesce(F.trim(value) != "", F.lit(False))


def _list(*messages: Column) -> Column:
    return F.array_compact(F.array(*messages))


def meta_errors() -> Column:
    """Broken requirements of the metadata fields. A field of the wrong type arrives here as null."""
    links = F.exists(F.map_values("links"), lambda v: _filled(v) & v.startswith("http"))
    return _list(
        *[F.when(~_filled(F.col(f)), F.lit(f"field '{f}' must be a non-empty string")) for f in REQUIRED_STRINGS],
        F.when(~F.coalesce(links, F.lit(False)), "'links' must contain at least one http link"),
        F.when(~F.coalesce(F.col("platform").isin(PLATFORMS), F.lit(False)), "'platform' must be cloud or self-hosted"),
        F.when(F.col("tags").isNull(), "'tags' must be a list"),
        F.when(F.col("hosted").isNull(), "'hosted' must be a boolean"),
    )


def readme_errors(product: str) -> Column:
    """Required sections that are missing or unfinished. The sections are bound as a lambda variable, so that the text
    is split once and not once per section."""

    def check(sections: Column) -> Column:
        found = []
        for name in required_sections(product):
            body = F.try_element_at(sections, F.lit(name))
            found.append(
                F.when(body.isNull(), F.lit(f"missing section '{name}'")).when(
                    text.is_placeholder(body), F.lit(f"section '{name}' is empty or a placeholder")
                )
            )
        return _list(*found)

    errors = F.flatten(F.transform(F.array(text.markdown_sections(F.col("readme"))), check))
    return F.when(F.col("readme").isNull(), F.array(F.lit("missing README"))).otherwise(errors)


def proof_errors(product: str) -> Column:
    proof = proof_file(product)
    there = F.coalesce(F.exists("files", lambda f: f["path"] == proof), F.lit(False))
    named = F.coalesce(F.col("readme").contains(proof), F.lit(False))
    return _list(
        F.when(~there, F.lit(f"missing {proof}")).when(~named, F.lit(f"{proof} must be referenced from the README"))
    )


def slug_errors() -> Column:
    return _list(F.when(~text.valid_slug(F.col("slug")), "folder name must be lowercase '<author>_<project>'"))


def secret_errors(product: str) -> Column:
    """At most one finding per file with a secret, and one for every environment file."""
    env = F.filter("files", lambda f: f["path"].rlike(r"(^|/)\.env$"))
    leaks = F.filter("files", lambda f: _suffix(f["path"]).isin(TEXT_SUFFIXES) & any_pattern(f["text"], secret_patterns(product)))
    found = F.concat(
        F.transform(env, lambda f: F.concat(F.lit("committed .env file at "), f["path"])),
        F.transform(leaks, lambda f: F.concat(F.lit("possible secret in "), f["path"])),
    )
    return F.coalesce(found, F.array().cast("array<string>"))


def marker_errors(product: str) -> Column:
    """A hosted entry needs code that uses the product."""
    markers = code_markers(product)

    def uses(f: Column) -> Column:
        hit = F.lit(False)
        for marker in markers:
            hit = hit | f["text"].contains(marker)
        return _suffix(f["path"]).isin(CODE_SUFFIXES) & F.coalesce(hit, F.lit(False))

    used = F.coalesce(F.exists("files", uses), F.lit(False))
    return _list(F.when(F.coalesce(F.col("hosted"), F.lit(False)) & ~used, "hosted entry has no code that uses the product"))


def entry_errors(entries: DataFrame, product: str) -> DataFrame:
    """One row per finding. Unreadable metadata is one finding and hides those that need it."""
    readable = F.col("meta_error").isNull()
    meta = F.when(readable, meta_errors()).otherwise(F.array("meta_error"))
    markers = F.when(readable, marker_errors(product)).otherwise(F.array().cast("array<string>"))
    everything = F.concat(
        slug_errors(), meta, readme_errors(product), proof_errors(product), secret_errors(product), markers
    )
    return entries.select("slug", F.explode(everything).alias("error"))


def check_entries(entries: DataFrame, product: str) -> DataFrame:
    """Findings per entry and whether it passes."""
    found = entry_errors(entries, product).groupBy("slug").agg(F.count("*").alias("errors"))
    joined = entries.select("slug").join(found, "slug", "left").withColumn("errors", F.coalesce("errors", F.lit(0)))
    return joined.withColumn("ok", F.col("errors") == 0)


def secret_findings(files: DataFrame, patterns: Sequence[str], text_col: str = "text") -> DataFrame:
    """Rows of a corpus that contain a secret, each once, whatever the number of matches."""
    return files.where(any_pattern(F.col(text_col), patterns))


def no_credentials(df: DataFrame, patterns: Sequence[str]) -> bool:
    """No text column of a result contains a credential."""
    texts = [f.name for f in df.schema if f.dataType.typeName() == "string"]
    leaked = F.lit(False)
    for name in texts:
        leaked = leaked | any_pattern(F.col(name), patterns)
    return df.where(leaked).isEmpty()


def readable_entries(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("meta_error").isNull())


def entry_catalogue(entries: DataFrame, author_url: str = "https://github.com/") -> DataFrame:
    """Display rows of the readable entries, ordered by title without regard to case."""
    title = F.coalesce("title", "slug")
    author = F.coalesce("author", F.lit(""))
    shown = text.escape_pipes(author)
    rows = readable_entries(entries).select(
        "slug",
        F.concat(F.lit("["), text.escape_pipes(title), F.lit("]("), F.col("slug"), F.lit("/)")).alias("project"),
        F.when(author == "", "").otherwise(F.concat(F.lit("[@"), shown, F.lit("]("), F.lit(author_url), shown, F.lit(")"))).alias("author"),
        text.escape_pipes(F.coalesce("description", F.lit(""))).alias("description"),
        text.escape_pipes(F.coalesce("platform", F.lit(""))).alias("platform"),
        text.links_cell(F.col("links")).alias("links"),
        F.when(F.col("hosted"), "hosted").otherwise("").alias("hosted"),
        text.escape_pipes(F.coalesce(F.array_join("tags", ", "), F.lit(""))).alias("tags"),
        F.lower(title).alias("__title"),
    )
    return rows.orderBy("__title", "slug").drop("__title")


def catalogue_is_current(stored: DataFrame, entries: DataFrame) -> bool:
    return tables_equal(stored, entry_catalogue(entries).select(*stored.columns))
