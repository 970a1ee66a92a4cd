"""All queries of the core, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinspark.plans import archive, records, training


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**archive.QUERIES, **records.QUERIES, **training.QUERIES}


def oracles() -> dict[str, str]:
    return {**archive.ORACLES, **records.ORACLES, **training.ORACLES}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.births_by_place_and_year(spark, sf_dir)
