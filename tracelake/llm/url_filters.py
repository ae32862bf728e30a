"""URL filters that hold for a time: every capture is judged by the list entries active when it was fetched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.session import materialise


def host_of(url: Column) -> Column:
    """Lower-cased host without user, port and a final dot; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*?)\.?(?::[0-9]*)?(?:[/?#]|$)", 1))


def path_of(url: Column) -> Column:
    """Path without query and fragment."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_keys(url: Column, labels: Sequence[int] | None = None, folders: Sequence[int] | None = None) -> Column:
    """All keys an entry may name a URL by: ``d:`` with its host or a parent domain of two labels or more, and ``u:`` with
    its host and its path or a parent folder of that.

    Where ``labels`` and ``folders`` are given, only keys of so many labels or folders are made. A key takes time in
    proportion to its length, so a URL of thousands of folders costs as much as the lengths asked for, not their square.
    """
    host, path = host_of(url), path_of(url)
    names, parts = F.split(host, r"\."), F.split(F.regexp_replace(path, "^/|/$", ""), "/")
    shortest = F.least(F.size(names), F.lit(2))
    some_labels = F.sequence(shortest, F.size(names)) if labels is None else F.filter(_numbers(labels), lambda n: (n >= shortest) & (n <= F.size(names)))
    some_folders = F.sequence(F.lit(1), F.size(parts)) if folders is None else F.filter(_numbers(folders), lambda n: n <= F.size(parts))
    domains = F.transform(some_labels, lambda n: F.concat(F.lit("d:"), F.array_join(F.slice(names, -n, n), ".")))
    prefixes = F.transform(some_folders, lambda n: F.concat(F.lit("u:"), host, F.lit("/"), F.array_join(F.slice(parts, 1, n), "/")))
    return F.when(host != "", F.array_distinct(F.concat(domains, prefixes))).otherwise(F.array().cast("array<string>"))


def _numbers(values: Sequence[int]) -> Column:
    """A constant array, folded into the plan as one value however long it is."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>") if values else F.array().cast("array<int>")


def key_lengths(entries: DataFrame) -> tuple[list[int], list[int]]:
    """Numbers of labels of the listed domains and of folders of the listed paths, each number once.

    Different numbers need keys of different lengths, so ``n`` of them need a list of at least ``n * n / 2`` characters.
    """
    length = F.when(F.col("key").startswith("d:"), F.regexp_count("key", F.lit(r"\.")) + 1).when(F.col("key").startswith("u:"), F.regexp_count("key", F.lit("/")))
    kinds = entries.select(F.substring("key", 1, 1).alias("kind"), length.alias("n")).where("n > 0").distinct().collect()
    return sorted(r.n for r in kinds if r.kind == "d"), sorted(r.n for r in kinds if r.kind == "u")


def entry_intervals(entries: DataFrame) -> DataFrame:
    """``list``, ``key``, ``first`` and ``until`` (first day it no longer holds, null if it still does).

    ``entries`` has ``list``, ``key``, ``day`` and ``action`` (``add`` or ``remove``). Of several entries of a day an ``add``
    wins, so a key has at most one a day. Entries with a null in any of these take no part.
    """
    known = entries.where(F.col("list").isNotNull() & F.col("key").isNotNull() & F.col("day").isNotNull() & F.col("action").isin("add", "remove"))
    daily = known.groupBy("list", "key", "day").agg(F.min("action").alias("action"))
    following = F.lead("day").over(Window.partitionBy("list", "key").orderBy("day"))
    return daily.withColumn("until", following).where("action = 'add'").select("list", "key", F.col("day").alias("first"), "until")


def filtered(captures: DataFrame, entries: DataFrame, id_col: str = "id", url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """``id_col``, ``url_col``, ``time_col``, ``blocked`` and ``lists`` (sorted names whose entries held) of every capture.

    An as-of join: intervals are laid out by key and calendar year, at most a year's days of each list together, and a
    capture meets the intervals of its keys in its year only, not all versions of them. A host that holds a third of the
    captures is split by adaptive skew handling, for captures are only joined by key; they are gathered by row.

    Of a URL only keys as long as some entry's are made, so very long URLs cost no more than their length for each such
    length. A null or unreadable URL or a null time is not blocked; a repeated capture gets a row each; other columns are ignored;
    no entries block nothing; an empty table gives no rows.
    """
    rows = captures.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.col(time_col).alias("__time"))
    rows = materialise(rows.withColumn("__row", F.monotonically_increasing_id()).withColumn("__day", F.to_date("__time")), "captures")
    first_year, last_year = rows.agg(F.min(F.year("__day")), F.max(F.year("__day"))).first()
    spans = entry_intervals(entries).where(F.year("first") <= F.lit(last_year)).withColumn("__until", F.coalesce("until", F.make_date(F.lit((last_year or 0) + 1), F.lit(1), F.lit(1))))
    spans = spans.where(F.year("__until") >= F.lit(first_year))
    years = F.sequence(F.greatest(F.year("first"), F.lit(first_year)), F.least(F.year(F.date_sub("__until", 1)), F.lit(last_year)))
    yearly = spans.withColumn("year", F.explode(years)).groupBy("key", "year", "list").agg(F.collect_list(F.struct("first", "__until")).alias("spans"))
    labels, folders = key_lengths(entries)
    met = rows.where(F.col("__day").isNotNull()).select("__row", "__day", F.year("__day").alias("year"), F.explode(url_keys(F.col("__url"), labels, folders)).alias("key"))
    holds = F.exists("spans", lambda s: (s["first"] <= F.col("__day")) & (F.col("__day") < s["__until"]))
    hits = met.join(yearly, ["key", "year"]).where(holds).select("__row", "list")
    judged = hits.groupBy("__row").agg(F.array_sort(F.collect_set("list")).alias("lists"))
    found = rows.join(judged, "__row", "left")
    return found.select(
        F.col("__id").alias(id_col), F.col("__url").alias(url_col), F.col("__time").alias(time_col),
        F.col("lists").isNotNull().alias("blocked"), F.coalesce("lists", F.array().cast("array<string>")).alias("lists"),
    )
