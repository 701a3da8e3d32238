"""All queries of the core and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexgrain.plans import data_queries, reference_queries

_MODULES = (data_queries, reference_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.ORACLES.items()}


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return queries()["r06_targets"](spark, d)
