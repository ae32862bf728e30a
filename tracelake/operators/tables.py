"""Table maintenance by key: upsert, insert-if-absent, delete, versions and comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.distribution import ordered_total


def insert_items(dataset: DataFrame, rows: Sequence[Mapping]) -> DataFrame:
    """Dataset with the rows appended; missing fields are null."""
    new = dataset.sparkSession.createDataFrame([tuple(r.get(c) for c in dataset.columns) for r in rows], dataset.schema)
    return dataset.unionByName(new)


def insert_absent(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` are added only for keys that are not there yet; one row per new key."""
    return base.unionByName(new.dropDuplicates([key]).join(base.select(key), key, "left_anti").select(*base.columns))


def delete_by_id(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per key. A maximum combines before the shuffle, so a key with many versions stays cheap."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("__row")).select(*keys, "__row.*").select(*df.columns)


def upsert_latest(base: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per key of a table that holds one row per key and a batch of new rows.

    Only the batch is reduced to its latest rows. Stored rows meet them by key and stay unless the new one is later; new keys
    are added. Stored rows are neither aggregated nor written before the result is.
    """
    newest = latest_by(new.select(*base.columns), keys, order)
    marked = newest.select(*[F.col(k).alias(f"__{k}") for k in keys], F.struct(*order).alias("__order"), F.struct(*base.columns).alias("__new"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    met = base.select(F.struct(*base.columns).alias("__old"), *keys, F.struct(*order).alias("__had")).join(marked, same, "left")
    later = F.col("__order").isNotNull() & (F.col("__order") >= F.col("__had"))
    stayed = met.select(F.when(later, F.col("__new")).otherwise(F.col("__old")).alias("__row")).select("__row.*")
    known = base.select(*[F.col(k).alias(f"__{k}") for k in keys])
    added = newest.join(known, same, "left_anti")
    return stayed.unionByName(added)


def upsert(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` replace rows of ``base`` with the same key. ``new`` should hold one row per key."""
    return base.join(new.select(key), key, "left_anti").select(*base.columns).unionByName(new.select(*base.columns))


def patch(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Fields that ``changes`` sets win; those it leaves null, or lacks, are carried forward."""
    fields = [c for c in changes.columns if c != key]
    renamed = changes.select(key, *[F.col(c).alias(f"__new_{c}") for c in fields])
    merged = [F.coalesce(f"__new_{c}", c).alias(c) if c in fields else F.col(c) for c in base.columns]
    return base.join(renamed, key, "left").select(*merged)


def next_version(prompts: DataFrame, name: str = "name", created: str = "created_at", *, ties: Sequence[str]) -> DataFrame:
    """Number the rows of each name from 1 in order of creation; a name used very often is spread over many tasks.

    ``ties`` tell rows created at one moment apart, so that versions don't depend on how rows are partitioned.
    """
    if not ties:
        raise ValueError("versions need a total order: name the columns that tell rows of one moment apart")
    numbered = ordered_total(prompts, F.col(created), ties, "__before", [name])
    return numbered.withColumn("version", F.col("__before") + 1).drop("__before")


def tables_equal(left: DataFrame, right: DataFrame) -> bool:
    """Same rows the same number of times."""
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def limit_rows(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def head_split(df: DataFrame, key: str, n: int) -> DataFrame:
    """First ``n`` rows by key."""
    return limit_rows(df, [key], n)
