"""Corpus and entry quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.catalog.bindings import VENDOR, Tables
from tracelake.catalog.registry import query
from tracelake.functions.text import http_links
from tracelake.operators import quality

# A pattern that the test corpus does contain, beside the fixed ones.
ASSIGNED_SECRET = r"(key|secret|token|password)[A-Za-z_]*\s*[=:]"


def _entries(t: Tables) -> DataFrame:
    key = F.col("doc_id")
    section = "## {}\n".format
    readme = F.concat(
        F.lit(section("What I built")), F.col("lang"), F.lit("\n" + section("Problem it solves")), F.when(key % 5 == 0, "TODO later").otherwise("a problem"),
        F.when(key % 7 != 0, F.lit("\n" + section("What I learned") + "much\n")).otherwise("\n"),
        F.lit(section(f"How I used {VENDOR.capitalize()}")), F.when(key % 3 != 0, f"see {VENDOR}-proof.png").otherwise("daily"),
    )
    return t.table("documents").select(
        F.concat(F.col("source"), F.when(key % 4 == 0, "-").otherwise("_"), key).alias("slug"),
        F.when(key % 6 != 0, F.col("lang")).alias("title"),
        F.concat(F.lit("a|b "), F.col("source")).alias("description"),
        F.when(key % 8 != 0, F.col("source")).otherwise(" ").alias("author"),
        F.create_map(F.lit("home|page"), F.concat(F.when(key % 9 != 0, "http").otherwise("ftp"), F.lit("://x/"), key)).alias("links"),
        F.when(F.col("lang") == "en", "cloud").otherwise("desk").alias("platform"),
        F.when(key % 10 != 0, F.array(F.col("lang"), F.col("source"))).alias("tags"),
        (key % 2 == 0).alias("hosted"),
        F.when(key % 13 != 0, readme).alias("readme"),
        F.array(
            F.struct(F.lit("app.py").alias("path"), F.concat(F.col("text"), F.when(key % 4 == 2, f"\nimport {VENDOR}").otherwise("")).alias("text")),
            F.struct(F.when(key % 11 != 0, f"{VENDOR}-proof.png").otherwise("x.png").alias("path"), F.lit("").alias("text")),
            F.struct(F.when(key % 12 == 0, "conf/.env").otherwise("conf/env").alias("path"), F.lit("A=1").alias("text")),
        ).alias("files"),
        F.when(key % 17 == 0, "metadata cannot be read").alias("meta_error"),
    )


_CHECKS = [
    ("doc_id % 4 = 0", "folder name must be lowercase ''<author>_<project>''"),
    ("doc_id % 17 = 0", "metadata cannot be read"),
    ("ok AND doc_id % 6 = 0", "field ''title'' must be a non-empty string"),
    ("ok AND doc_id % 8 = 0", "field ''author'' must be a non-empty string"),
    ("ok AND doc_id % 9 = 0", "''links'' must contain at least one http link"),
    ("ok AND lang <> ''en''".replace("''", "'"), "''platform'' must be cloud or self-hosted"),
    ("ok AND doc_id % 10 = 0", "''tags'' must be a list"),
    ("doc_id % 13 = 0", "missing README"),
    ("doc_id % 13 <> 0 AND doc_id % 5 = 0", "section ''Problem it solves'' is empty or a placeholder"),
    ("doc_id % 13 <> 0 AND doc_id % 7 = 0", "missing section ''What I learned''"),
    ("doc_id % 11 = 0", "missing acme-proof.png"),
    ("doc_id % 11 <> 0 AND (doc_id % 3 = 0 OR doc_id % 13 = 0)", "acme-proof.png must be referenced from the README"),
    ("doc_id % 12 = 0", "committed .env file at conf/.env"),
    ("ok AND doc_id % 2 = 0 AND doc_id % 4 <> 2", "hosted entry has no code that uses the product"),
    (r"regexp_matches(text, 'sk-ant-[A-Za-z0-9_-]{20,}|sk-(?:proj|svcacct)-[A-Za-z0-9_-]{20,}|sk-[A-Za-z0-9]{20,}|ACME_API_KEY\s*[=:]\s*[\"''][^\"'']+[\"'']')", "possible secret in app.py"),
]
FINDINGS = f"""
    findings AS (SELECT slug, unnest([x FOR x IN [{", ".join(f"CASE WHEN {c} THEN '{m}' END" for c, m in _CHECKS)}] IF x IS NOT NULL]) AS error
      FROM (SELECT *, source || CASE WHEN doc_id % 4 = 0 THEN '-' ELSE '_' END || doc_id AS slug, doc_id % 17 <> 0 AS ok FROM documents))"""


@query("entry_errors", f"WITH {FINDINGS} SELECT slug, error FROM findings")
def entry_errors(t: Tables) -> DataFrame:
    return quality.entry_errors(_entries(t), VENDOR)


@query(
    "check_entries",
    f"""WITH {FINDINGS} SELECT d.slug, coalesce(f.n, 0) AS errors, f.n IS NULL AS ok FROM (
      SELECT source || CASE WHEN doc_id % 4 = 0 THEN '-' ELSE '_' END || doc_id AS slug FROM documents) d
      LEFT JOIN (SELECT slug, count(*) AS n FROM findings GROUP BY 1) f ON d.slug = f.slug""",
)
def check_entries(t: Tables) -> DataFrame:
    return quality.check_entries(_entries(t), VENDOR)


@query(
    "index_rows",
    r"""SELECT slug, '[' || coalesce(title, slug) || '](' || slug || '/)' AS project,
      CASE WHEN doc_id % 8 <> 0 THEN '[@' || source || '](https://github.com/' || source || ')' ELSE '[@ ](https://github.com/ )' END AS author,
      'a\|b ' || source AS description, CASE WHEN lang = 'en' THEN 'cloud' ELSE 'desk' END AS platform,
      CASE WHEN doc_id % 9 <> 0 THEN '[home\|page](http://x/' || doc_id || ')' ELSE '' END AS links,
      CASE WHEN doc_id % 2 = 0 THEN 'hosted' ELSE '' END AS hosted, CASE WHEN doc_id % 10 <> 0 THEN lang || ', ' || source ELSE '' END AS tags
    FROM (SELECT *, source || CASE WHEN doc_id % 4 = 0 THEN '-' ELSE '_' END || doc_id AS slug, CASE WHEN doc_id % 6 <> 0 THEN lang END AS title FROM documents)
    WHERE doc_id % 17 <> 0""",
)
def index_rows(t: Tables) -> DataFrame:
    return quality.entry_catalogue(_entries(t))


@query(
    "secret_scan",
    r"SELECT doc_id FROM documents WHERE regexp_matches(text, '(key|secret|token|password)[A-Za-z_]*\s*[=:]')",
)
def secret_scan(t: Tables) -> DataFrame:
    patterns = [*quality.secret_patterns(VENDOR), ASSIGNED_SECRET]
    return quality.secret_findings(t.table("documents"), patterns).select("doc_id")


@query("page_links", "SELECT page_id, url LIKE 'http%' AS linked, CASE WHEN url LIKE 'http%' THEN 1 ELSE 0 END AS links FROM pages")
def page_links(t: Tables) -> DataFrame:
    links = http_links(F.create_map(F.lit("page"), "url", F.lit("host"), F.regexp_extract("url", "//([^/]+)", 1)))
    return t.table("pages").select("page_id", F.map_contains_key(links, "page").alias("linked"), F.size(links).alias("links"))
