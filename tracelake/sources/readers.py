"""Batch sources. Every read has a fixed schema, so no file is scanned to infer one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracelake import schemas
from tracelake.operators.filters import TraceFilter

TRANSCRIPT_SUFFIXES = ["txt", "md"]


def scan_traces(spark: SparkSession, path: str, project: str | None = None) -> DataFrame:
    """Traces, of one project if named. With the layout of ``ingest_traces`` the project prunes folders."""
    traces = spark.read.schema(schemas.TRACE).parquet(path)
    return traces if project is None else traces.where(F.col("project") == project)


def count_traces(traces: DataFrame, flt: TraceFilter) -> DataFrame:
    """Number of matching traces; the scan reads only the columns of the filter."""
    return flt.apply(traces).agg(F.count("*").alias("total"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def scan_projects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("id", "name")


def scan_spans(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(schemas.SPAN).format(fmt).load(path)


def read_records(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON file holding an array of objects."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_config_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """``read_records``, but a missing file is an empty table."""
    try:
        return read_records(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """One row per text or Markdown file, with its name and whole text."""
    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{%s}" % ",".join(TRANSCRIPT_SUFFIXES))
    return texts.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("transcript"))


def read_tree(spark: SparkSession, root: str) -> DataFrame:
    """Files below a root as ``(folder, path, text)``, where ``folder`` is the first level and ``path`` is within it. Bytes that
    are no UTF-8 become the replacement character."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    whole = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    inner = F.substring("path", len(whole) + 2, 1 << 30)
    return files.select(
        F.substring_index(inner, "/", 1).alias("folder"),
        F.regexp_extract(inner, r"^[^/]+/(.*)$", 1).alias("path"),
        F.make_valid_utf8(F.col("content").cast("string")).alias("text"),
    ).where(F.col("path") != "")


def discover_entries(spark: SparkSession, root: str, reserved: Sequence[str] = ()) -> DataFrame:
    """Entry folders, without reserved names and those that start with a dot or underscore."""
    folders = read_tree(spark, root).select(F.col("folder").alias("slug")).distinct()
    return folders.where(~F.col("slug").isin(list(reserved)) & ~F.col("slug").rlike(r"^[._]"))
