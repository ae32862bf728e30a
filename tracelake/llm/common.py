"""What several training-data operators share: word splitting, written intermediates and running totals in a global order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.session import materialise

#: A word is a run of characters other than ASCII white space. ``bytes.split()`` splits at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of one range when rows are numbered, so the number of ranges grows with the table.
ROWS_PER_RANGE = 4_000_000
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Documents a task holds at once while it works on whole texts.
TEXTS_PER_BATCH = 512


def small_batches(df: DataFrame) -> DataFrame:
    """Same frame, in a session that hands whole texts to Python in short batches, so long documents don't add up."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_PER_BATCH))
    return df


def lower_words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 bytes with A-Z lower-cased; null has none."""
    return text.encode("utf-8", "replace").translate(LOWER).split() if text else []


def columns_of(df: DataFrame) -> list[Column]:
    """All columns of a frame, whatever their names hold."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name like the wanted one that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def running_total(df: DataFrame, order: Sequence[Column], weight: Column, out: str, name: str) -> DataFrame:
    """Exclusive running total of ``weight`` over all rows in the given order, without one task that sees them all.

    Rows are range-sorted and written; the totals of the ranges (one row each) give every range its offset. A value so
    frequent that it fills ranges is split only as far as ``order`` tells its rows apart, so give a key that does.
    """
    key = [f"__o{i}" for i in range(len(order))]
    ordered = df.select("*", *[c.alias(k) for c, k in zip(order, key, strict=True)]).withColumn("__w", weight)
    ranged = materialise(ordered.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("__range", F.spark_partition_id()), name)
    totals = ranged.groupBy("__range").agg(F.sum("__w").alias("__total"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__range", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__ahead"))
    inside = Window.partitionBy("__range").orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("__local", F.coalesce(F.sum("__w").over(inside), F.lit(0)))
    return local.join(offsets, "__range").withColumn(out, F.col("__local") + F.col("__ahead")).drop(*key, "__w", "__range", "__local", "__ahead")


def numbered(df: DataFrame, order: Sequence[Column], out: str, name: str) -> tuple[DataFrame, int]:
    """``df`` with the dense 0-based place ``out`` of every row in the given order, and the number of rows.

    The rows are written once with a tie-break, so that equal ones split over ranges as well and a repeated task sees the
    same table. Each range is sorted on its own; ranges are counted (one row each) and every row adds its range's offset
    to its place in it. No window holds a group, and no row is shuffled twice.
    """
    key = [f"__o{i}" for i in range(len(order))]
    whole = F.struct(*columns_of(df)).alias("__row")  # apart from the columns made here, whatever its own are called
    fixed = df.select(whole, *[c.alias(k) for c, k in zip(order, key, strict=True)], F.monotonically_increasing_id().alias("__tie"))
    fixed = materialise(fixed, f"{name}-rows")
    rows = fixed.count()
    ranges = -(-rows // ROWS_PER_RANGE)
    by = [*key, "__tie"]
    wide = ranges > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = fixed.repartitionByRange(ranges, *by) if wide else fixed.repartitionByRange(*by)
    ranged = ranged.sortWithinPartitions(*by).select("__row", F.monotonically_increasing_id().alias("__at"))
    ranged = materialise(ranged, f"{name}-ranges").withColumn("__range", F.shiftright("__at", 33))
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__ahead"))
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = ranged.join(F.broadcast(offsets), "__range")
    return placed.select(*[F.col("__row")[c].alias(c) for c in df.columns], (F.col("__ahead") + inside).alias(out)), rows
