"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracelake.operators.retention import RetentionRule, delete_audit, matches_any
from tracelake.operators.tables import upsert_latest

#: Folders of a trace table.
FOLDERS = ["project", "date"]
#: Touched folders whose names are given to the scan; the values of more of them are given as ranges.
NAMED_FOLDERS = 500


def ingest_traces(traces: DataFrame, path: str) -> None:
    """Append traces by project and day. Rebalancing brings the rows of a folder together, splits a large one over
    several tasks by its measured size and merges small ones, so that files come out well sized."""
    dated = traces.withColumn("date", F.to_date("start_time"))
    dated.hint("rebalance", *FOLDERS).write.mode("append").partitionBy(*FOLDERS).parquet(path)


def if_written(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame | None:
    """Table at a path, or nothing if there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _once(spark: SparkSession, work: str, step: str, run) -> None:
    """Run a step of a job unless the mark that ends it has been set; a step that broke off is run again as a whole."""
    mark = if_written(spark, f"{work}/{step}-done", "id long")
    if mark is None or mark.isEmpty():
        run()
        spark.range(1).write.mode("overwrite").parquet(f"{work}/{step}-done")


def delete_by_partition(spark: SparkSession, path: str, schema: StructType, rules: Sequence[RetentionRule], work: str) -> DataFrame:
    """Delete what the rules match from the trace table that ``ingest_traces`` wrote, and return the audit of it.

    Only folders (project and day) with a match are written anew; files of all others stay as they are. ``work`` is a shared folder of
    this deletion's own: what is to be deleted and the rows that stay in the touched folders are written there first, then these
    rows replace the folders, and folders that keep nothing lose their files. After a crash the same call goes on: written
    steps are not run again, and replacing folders twice changes nothing. Nobody may write to the touched folders meanwhile.
    """
    stored = spark.read.schema(schema).option("basePath", path).parquet(path)
    with_file = stored.select("*", F.col("_metadata.file_path").alias("__file"))
    met = f"{work}/touched"
    audit = f"{work}/audit"

    def find() -> None:
        hit = with_file.groupBy(*FOLDERS, "__file").agg(F.max(matches_any(stored, rules)).alias("__hit"))
        hit.withColumn("__hit", F.max("__hit").over(Window.partitionBy(*FOLDERS))).where("__hit").drop("__hit").write.mode("overwrite").parquet(met)
        delete_audit(stored, rules).write.mode("overwrite").parquet(audit)

    def keep() -> None:
        touched = spark.read.parquet(met)
        folders = touched.select(*FOLDERS).distinct()
        near = _of_folders(stored, folders)
        left = near.where(~matches_any(near, rules)).join(folders, FOLDERS, "left_semi")
        left.hint("rebalance", *FOLDERS).write.mode("overwrite").partitionBy(*FOLDERS).parquet(f"{work}/kept")

    def replace() -> None:
        kept = spark.read.schema(schema).parquet(f"{work}/kept")
        if not kept.isEmpty():
            rows = kept.hint("rebalance", *FOLDERS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            rows.partitionBy(*FOLDERS).parquet(path)
        emptied = spark.read.parquet(met).join(kept.select(*FOLDERS).distinct(), FOLDERS, "left_anti")
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for row in emptied.select("__file").toLocalIterator():
            file = hadoop(spark.sparkContext._jvm.java.net.URI(row[0]))
            file.getFileSystem(conf).delete(file, False)

    for step, run in (("find", find), ("keep", keep), ("replace", replace)):
        _once(spark, work, step, run)
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(audit)


def _of_folders(stored: DataFrame, folders: DataFrame) -> DataFrame:
    """Rows of about these folders, by a filter that the scan uses to leave out the others: their projects and days if these are
    few, else the range of their days."""
    for column in FOLDERS:
        values = [r[0] for r in folders.select(column).distinct().limit(NAMED_FOLDERS + 1).collect()]
        if len(values) <= NAMED_FOLDERS:
            stored = stored.where(F.col(column).isin(values))
        else:
            low, high = folders.agg(F.min(column), F.max(column)).first()
            stored = stored.where(F.col(column).between(low, high))
    return stored


def write_stats(daily: DataFrame, monthly: DataFrame, summary: DataFrame, folder: str) -> None:
    for name, df in (("stats_daily", daily), ("stats_monthly", monthly), ("stats_summary", summary)):
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def write_payload(payload: DataFrame, path: str) -> None:
    payload.write.mode("overwrite").json(path)


def append_scores(scores: DataFrame, new: DataFrame) -> DataFrame:
    """Score table with new rows; per trace and name the latest wins. The table holds one row each, so only the new rows are
    aggregated, and with a batch that can be broadcast the table is not shuffled."""
    return upsert_latest(scores, new, ["trace_id", "name"], ["ts", "value"])


def rebuild_vectors(vectors: DataFrame, path: str) -> None:
    vectors.write.mode("overwrite").parquet(path)


def save_result(df: DataFrame, path: str, replace: bool = False) -> None:
    """Refuse to write over an existing result unless asked to."""
    df.write.mode("overwrite" if replace else "errorifexists").parquet(path)


def write_catalogue(catalogue: DataFrame, path: str) -> None:
    catalogue.write.mode("overwrite").option("header", True).csv(path)
