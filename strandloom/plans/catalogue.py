"""All queries of the core, by name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandloom.plans import edges, graphs, measures, quality, texts, training

MODULES = [training, texts, graphs, measures, edges, quality]


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return training.p1_hierarchy(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
