"""Medallion layers over the driver tables.

``bronze`` is the dirty landing-shaped view of an event table, ``silver`` its
cleaned one-row-per-key form, ``seed`` a typed catalogue. In a deployed job
these are stored tables (see ``tidewater.plans.daily``); here they are derived
on the fly from the driver's parquet files, so every query's work grows with
the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import silver as sv
from ..spec import EVENT_TABLES, SEEDS
from . import fixtures


def bronze(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return fixtures.bronze_view(spark, sf_dir, table)


def silver(spark: SparkSession, sf_dir: str, table: str, columns: list[str] | None = None) -> DataFrame:
    return sv.silver(bronze(spark, sf_dir, table), EVENT_TABLES[table], columns=columns)


def seed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return sv.promote_seed(fixtures.seed_bronze(spark, sf_dir, name), SEEDS[name])
