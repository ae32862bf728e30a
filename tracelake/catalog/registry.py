"""Registry of the queries over the given tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.catalog.bindings import SQL_VIEWS, Tables
from tracelake.session import configure

Query = Callable[[Tables], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``name``; ``views`` are the common table expressions its SQL uses, in order."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ctes = ",\n".join(f"{v} AS ({SQL_VIEWS[v].strip()})" for v in views)
            body = sql.strip()
            if ctes and body.upper().startswith("WITH "):
                body = f",\n{body[5:]}"
            ORACLES[name] = f"WITH {ctes}{'' if body.startswith(',') else chr(10)}{body}" if ctes else body
        return fn

    return add


def mean_digits(value: Column) -> Column:
    """Mean rounded for comparison. The shift keeps exact halves, such as the mean of two cents, from falling either way."""
    return F.round(value + 1e-9, 6)


def dates_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def runner(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(Tables(configure(spark), sf_dir))
