"""All queries of the engine by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import evidence, labels, layout, ownership, review, sources, structure, tables

_PLANS = (evidence, ownership, layout, labels, tables, structure, review, sources)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: f for plan in _PLANS for name, f in plan.QUERIES.items()}
#: Folds and sequence matching are beyond SQL; those queries are held against small worked cases in the tests.
ORACLE_SQL: dict[str, str] = {name: sql for plan in _PLANS for name, sql in plan.ORACLE_SQL.items()}
