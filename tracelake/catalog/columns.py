"""Column functions over the given tables: dates, ids, headers, message parts and small searches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.catalog.bindings import Tables
from tracelake.catalog.registry import query
from tracelake.functions import dates, documents
from tracelake.operators import filters


@query(
    "parse_dates",
    """SELECT o_orderkey, strftime(CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS TIMESTAMP) WHEN 3 THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) + INTERVAL 3723 SECOND END, '%Y-%m-%dT%H:%M:%S.%gZ') AS parsed,
      date_diff('day', CAST(o_orderdate AS DATE), DATE '1999-01-01') AS days FROM orders""",
)
def parse_dates(t: Tables) -> DataFrame:
    """Dates written in three accepted formats, and one that is not."""
    orders = t.table("orders").withColumn("d", F.date_format("o_orderdate", "yyyy-MM-dd"))
    written = F.element_at(F.array(F.col("d"), F.concat("d", F.lit("T01:02:03")), F.concat("d", F.lit("T01:02:03Z")), F.concat(F.lit("on "), "d")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    days = dates.span_days(F.col("o_orderdate").cast("date"), F.lit("1999-01-01").cast("date"))
    return orders.select("o_orderkey", dates.format_ms_z(dates.parse_date(written)).alias("parsed"), days.cast("long").alias("days"))


@query(
    "uuid_time",
    """SELECT doc_id, doc_id % 3 <> 2 AS valid, CASE WHEN doc_id % 3 <> 2 THEN doc_id * 1000 + 1700000000000 END AS millis FROM documents""",
)
def uuid_time(t: Tables) -> DataFrame:
    """Creation times read back from version-7 ids that hold them; every third id is of version 4."""
    h = F.lpad(F.lower(F.hex(F.col("doc_id") * 1000 + 1_700_000_000_000)), 12, "0")
    version = F.when(F.col("doc_id") % 3 == 2, "4").otherwise("7")
    ident = F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"), version, F.lit("abc-9def-0123456789ab"))
    made = t.table("documents").select("doc_id", ident.alias("u"))
    return made.select("doc_id", dates.is_uuid7(F.col("u")).alias("valid"), F.unix_millis(dates.uuid7_time(F.col("u"))).alias("millis"))


@query(
    "traceparent",
    """SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN md5(text) END AS trace_id, CASE WHEN doc_id % 4 <> 0 THEN left(md5(source), 16) END AS span_id,
      CASE WHEN doc_id % 4 <> 0 THEN '01' END AS flags FROM documents""",
)
def traceparent(t: Tables) -> DataFrame:
    """Trace context headers made of digests; every fourth has a flaw."""
    good = F.concat(F.lit("00-"), F.md5("text"), F.lit("-"), F.substring(F.md5("source"), 1, 16), F.lit("-01"))
    header = F.when(F.col("doc_id") % 4 == 0, F.upper(F.concat(good, F.lit("x")))).otherwise(good)
    return t.table("documents").select("doc_id", documents.parse_traceparent(header).alias("h")).select("doc_id", "h.*")


@query(
    "image_parts",
    """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'data' ELSE 'url' END AS kind, CASE WHEN page_id % 2 = 0 THEN 'image/png' END AS mime,
      CASE WHEN page_id % 2 = 0 THEN md5(html) END AS digest, 'text,image_url' AS parts FROM pages""",
)
def image_parts(t: Tables) -> DataFrame:
    """Message parts with a picture: by address, or the page's own bytes as inline data."""
    inline = F.concat(F.lit("data:image/png;base64,"), F.base64(F.col("html").cast("binary")))
    pages = t.table("pages").withColumn("picture", F.when(F.col("page_id") % 2 == 0, inline).otherwise(F.col("url")))
    part = documents.image_part(F.regexp_replace("picture", r"[\r\n]", ""))
    types = F.array_join(documents.pluck(documents.content_parts(F.lit("see"), F.col("url")), "type"), ",")
    return pages.select("page_id", part["kind"].alias("kind"), part["mime"].alias("mime"), F.md5(part["bytes"]).alias("digest"), types.alias("parts"))


@query(
    "merged_metadata",
    """SELECT event_id AS trace_id, 'env=' || ['prod', 'staging', 'dev'][(user_id % 3 + 1)::INTEGER] || ',note=new' AS merged FROM events""",
)
def merged_metadata(t: Tables) -> DataFrame:
    """Stored metadata under newer entries that win."""
    old = F.create_map(F.lit("env"), F.get(F.array(F.lit("prod"), F.lit("staging"), F.lit("dev")), (F.col("user_id") % 3).cast("int")), F.lit("note"), F.lit("old"))
    merged = documents.merge_metadata(old, F.create_map(F.lit("note"), F.lit("new")))
    entries = F.transform(F.array_sort(F.map_entries(merged)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return t.table("events").select(F.col("event_id").alias("trace_id"), F.array_join(entries, ",").alias("merged"))


@query("projects_containing", "SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE contains(s_name, '7')")
def projects_containing(t: Tables) -> DataFrame:
    return filters.projects_containing(t.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), "7")


@query("exact_project", "SELECT p_partkey AS id, p_name AS name FROM part WHERE p_name = (SELECT min(p_name) FROM part)")
def exact_project(t: Tables) -> DataFrame:
    parts = t.table("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    first = parts.agg(F.min("name")).first()[0]
    return filters.exact_project(parts, first)


@query(
    "lookback_traces",
    "SELECT trace_id, start_time FROM traces WHERE start_time BETWEEN TIMESTAMP '2024-01-28' AND TIMESTAMP '2024-01-31'",
    ("traces",),
)
def lookback_traces(t: Tables) -> DataFrame:
    from tracelake.catalog.bindings import AS_OF

    return filters.traces_of_lookback(t.traces, AS_OF, 3).select("trace_id", "start_time")


@query(
    "search_project",
    "SELECT trace_id, name FROM traces WHERE project = 'proj2' AND env = 'dev' AND list_contains(tags, 'governance') AND duration_ms > 20",
    ("traces",),
)
def search_project(t: Tables) -> DataFrame:
    conditions = [
        {"field": "metadata", "key": "env", "operator": "=", "value": "dev"}, {"field": "tags", "operator": "contains", "value": "governance"},
        {"field": "duration_ms", "operator": ">", "value": 20},
    ]
    return filters.search_traces(t.traces, "proj2", conditions).select("trace_id", "name")
