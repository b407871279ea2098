"""All core queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spanloom.plans import general, quotes


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.quote_matches(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return general.QUERIES | quotes.QUERIES


def oracle_sql() -> dict[str, str]:
    return general.ORACLES | quotes.ORACLES
