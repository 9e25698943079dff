"""Landing-zone retention: a plan as a DataFrame, deletion as a thin edge step.

The plan lists day partitions from file metadata only (the ``binaryFile``
source with its ``content`` column never selected, so no file is read).
A partition is removable when its day is strictly older than the cutoff AND
every file in it has reached bronze: deleting a file the stream has not
ingested would lose it for good.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune_file_listing
from ..sources.landing import system_dir
from ..sources.tables import path_exists, remove
from ..spec import PARTITION_COLUMN


def path_only(c: Column) -> Column:
    """Comparable file path: URI scheme and authority dropped."""
    return F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def landing_files(spark: SparkSession, landing: str, systems: tuple[str, ...]) -> DataFrame:
    """Every landed file of the systems that have a folder: system, path and its ``data`` partition (text)."""
    tune_file_listing(spark)
    out = None
    for s in systems:
        if not path_exists(spark, system_dir(landing, s)):
            continue
        files = (spark.read.format("binaryFile").load(system_dir(landing, s))
                 .select(F.lit(s).alias("sistema"), F.col("path").alias("arquivo"), F.col(PARTITION_COLUMN)))
        out = files if out is None else out.unionByName(files)
    return out if out is not None else spark.createDataFrame([], f"sistema string, arquivo string, {PARTITION_COLUMN} string")


def retention_plan(files: DataFrame, ledger: DataFrame, retention_days: int = 30,
                   reference_day: str | None = None) -> DataFrame:
    """One row per system and day partition: files, landed day, and the action.

    ``manter`` (inside retention), ``remover`` (older than the cutoff, all
    files in bronze), ``bloqueado_nao_ingerido`` (older, but a file is not in
    bronze yet), ``ignorado_data_invalida`` (partition name is not a date).
    ``ledger`` has the paths (``arquivo``) of the files in bronze, as the ingest
    notes them: no bronze row is read.
    """
    ref = F.lit(reference_day or dt.date.today().isoformat()).cast("date")
    cutoff = F.date_sub(ref, retention_days)
    seen = ledger.select(path_only(F.col("arquivo")).alias("_caminho")).distinct().withColumn("_no_bronze", F.lit(True))
    f = files.withColumn("_caminho", path_only(F.col("arquivo"))).join(seen, "_caminho", "left")
    per = f.groupBy("sistema", PARTITION_COLUMN).agg(
        F.count(F.lit(1)).alias("arquivos"),
        F.count_if(F.col("_no_bronze").isNull()).alias("arquivos_nao_ingeridos"))
    day = F.try_to_date(F.col(PARTITION_COLUMN), "yyyy-MM-dd")
    action = (F.when(day.isNull(), "ignorado_data_invalida")
              .when(day >= cutoff, "manter")
              .when(F.col("arquivos_nao_ingeridos") > 0, "bloqueado_nao_ingerido")
              .otherwise("remover"))
    return per.select("sistema", F.concat(F.lit(f"{PARTITION_COLUMN}="), F.col(PARTITION_COLUMN)).alias("particao"),
                      day.alias("dia"), cutoff.alias("data_corte"), "arquivos", "arquivos_nao_ingeridos",
                      action.alias("acao"))


def apply_retention(spark: SparkSession, landing: str, plan: DataFrame, dry_run: bool = True) -> list[str]:
    """Delete the partitions the plan marks ``remover`` (nothing when dry_run); their paths below ``landing``.

    The list of partitions is bounded by the number of landed days and systems.
    """
    doomed = [f"{r['sistema']}/{r['particao']}" for r in plan.where(F.col("acao") == "remover").select("sistema", "particao").collect()]
    if not dry_run:
        for part in doomed:
            remove(spark, f"{landing.rstrip('/')}/{part}")
    return sorted(doomed)
