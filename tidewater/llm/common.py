"""Small helpers shared by the operators: inputs, batches, written steps."""

from __future__ import annotations

import pickle

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from ..session import prepare
from ..sources.tables import materialize

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Cap rows per Arrow batch: documents are long, Python workers are small.

    A value that the user has set below Spark's default is kept.
    """
    if int(spark.conf.get(ARROW_ROWS, "10000")) >= 10000:
        spark.conf.set(ARROW_ROWS, str(rows))


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared work folder and read back."""
    return materialize(spark, df, f"llm-{name}")


def share(spark: SparkSession, value):
    """A broadcast of an object of this package; bytes, so that workers need no copy of the package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(broadcast):
    return pickle.loads(broadcast.value)
