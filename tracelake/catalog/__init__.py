"""Queries over the given tables, one module per area."""

from tracelake.catalog import annotation, columns, evaluation, governance, quality, retention, retrieval, rules, spans, usage  # noqa: F401
from tracelake.catalog.registry import ORACLES, QUERIES, runner  # noqa: F401
