"""Row numbers inside groups of any size: no group, however large, meets in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written


def ranked(df: DataFrame, group: list[str], order: list[str], rank: str = "_rank") -> DataFrame:
    """``df``, written once, plus ``rank``: its 0-based place in its group by ``order`` (nulls first).

    Rows are dealt into ranges of (group, order), so a hot group spans many
    ranges; a row's place is its place in the range plus the group's rows in
    the ranges before. Equal rows take consecutive places in any order: they
    are told apart by their position in the input, so that even a row repeated
    very often is spread.
    """
    spark = df.sparkSession
    by = [F.col(c).asc_nulls_first() for c in [*group, *order]] + [F.col("_tie")]
    dealt = (df.withColumn("_tie", F.monotonically_increasing_id())
             .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *by)
             .withColumn("_range", F.spark_partition_id()))
    dealt = written(spark, dealt, "ranges")
    keys = ["_range", *group]
    counts = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*group).orderBy("_range")) - F.col("_n")    # a row per range at most
    starts = counts.select(*[F.col(c).alias(f"_at_{c}") for c in keys], before.alias("_start"))
    same = [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in keys]
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*by)) - 1
    placed = dealt.withColumn("_inside", inside).join(starts, same)
    return placed.select(*df.columns, (F.col("_start") + F.col("_inside")).alias(rank))
