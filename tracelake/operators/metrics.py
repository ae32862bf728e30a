"""User metrics: built-in expressions or vectorised functions, with arguments bound by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tracelake.functions.documents import json_path


@dataclass(frozen=True)
class MetricSpec:
    """A metric ``fn(**arguments)`` whose arguments name columns, or paths into JSON columns such as ``output.answer``.

    ``fn`` builds a Column, or with ``python=True`` takes pandas series and returns a frame with ``value`` and ``reason``.
    """

    name: str
    fn: Callable
    arguments: Mapping[str, str]
    reason: Callable | None = None
    python: bool = False

    def bound(self, columns: Sequence[str]) -> dict[str, Column]:
        roots = {c: F.col(c) for c in columns}
        return {arg: F.col(path) if path in roots else json_path(roots, path) for arg, path in self.arguments.items()}

    def _python(self, bound: Mapping[str, Column]) -> Column:
        names, fn = list(bound), self.fn

        @F.pandas_udf("value double, reason string")
        def score(args: pd.DataFrame) -> pd.DataFrame:
            return fn(**{n: args[n] for n in names})

        return score(F.struct(*[c.alias(n) for n, c in bound.items()]))

    def value(self, columns: Sequence[str]) -> Column:
        return self._python(self.bound(columns))["value"] if self.python else self.fn(**self.bound(columns))

    def entry(self, columns: Sequence[str], given: Mapping[str, Column] | None = None) -> Column:
        """Struct ``(name, value, reason)``; ``given`` arguments stand in for those the spec maps."""
        bound = {**self.bound(columns), **(given or {})}
        if self.python:
            result = self._python(bound)
            value, reason = result["value"], result["reason"]
        else:
            value = self.fn(**bound)
            reason = self.reason(**bound) if self.reason else F.lit(None)
        return F.struct(
            F.lit(self.name).alias("name"), value.cast("double").alias("value"), reason.cast("string").alias("reason")
        )


def row_metric(score: Callable) -> Callable:
    """Turn a caller's ``score(**values) -> value | (value, reason)`` function into one over batches; a failing row has no
    value. It runs row by row, so it is for code that can't be written over columns; no query here needs it."""

    def batch(**series: pd.Series) -> pd.DataFrame:
        rows = []
        for values in zip(*series.values()):
            try:
                result = score(**dict(zip(series, values)))
                rows.append(result if isinstance(result, tuple) else (result, None))
            except Exception as error:  # noqa: BLE001 - a user metric may fail in any way; the row is marked instead
                rows.append((None, str(error)))
        return pd.DataFrame(rows, columns=["value", "reason"]).astype({"value": "float64"})

    return batch
