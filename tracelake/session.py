"""Session settings and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Settings that can only be given when the session is made: without them every Column call also records its call site.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

_LOCAL_DIRS: dict[str, str] = {}


def start(builder: SparkSession.Builder) -> SparkSession:
    """Session of a builder with all settings of this package."""
    for key, value in {**START_SETTINGS, **SETTINGS}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator here relies on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it.

    A machine-local folder would be lost with its executor, so one is made only for a local master.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="tracelake-")
    return _LOCAL_DIRS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def small_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Frame of a few rows given in code. It is a local relation of known size, which Catalyst can broadcast."""
    kind = T.StructType.fromDDL(schema)
    return spark.createDataFrame(pd.DataFrame(list(rows), columns=kind.names, dtype=object), kind)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage of iterative plans, survives executor loss, and gives later joins real sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
