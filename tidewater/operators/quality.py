"""Data-quality reports: table profile and volume anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import days_between, operates_on
from ..spec import PARTITION_COLUMN, TableSpec
from .silver import REASONS, cleanse


def table_profile(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per silver column: position, type, and the number of silver rows.

    Silver has one row per key with a trusted row, so counting distinct trusted
    keys gives its row count: two narrow columns through a hash aggregate, with
    no row picked and no wide shuffle.
    """
    c = cleanse(bronze, spec)
    df, name = c.drop(REASONS), spec.name
    keys = (c.select(F.col(spec.key).alias("_k"), (F.col(REASONS) == "").alias("_ok"))
            .groupBy("_k").agg(F.max("_ok").alias("_ok")).where("_ok AND _k IS NOT NULL"))
    return _described(keys, df, name)


def seed_profile(seed: DataFrame, name: str) -> DataFrame:
    """The same of a typed seed, all of whose rows are silver rows."""
    return _described(seed, seed, name)


def _described(rows: DataFrame, columns_of: DataFrame, name: str) -> DataFrame:
    cols = F.array(*[F.struct(F.lit(f.name).alias("coluna"), F.lit(i + 1).alias("posicao"),
                              F.lit(f.dataType.simpleString()).alias("tipo"))
                     for i, f in enumerate(columns_of.schema.fields)])
    return (rows.agg(F.count(F.lit(1)).alias("total_linhas"))
            .select(F.lit(name).alias("tabela"), F.explode(cols).alias("_c"), "total_linhas")
            .select("tabela", "_c.coluna", "_c.posicao", "_c.tipo", "total_linhas"))


def daily_volume(bronze: DataFrame, name: str) -> DataFrame:
    return bronze.groupBy(PARTITION_COLUMN).agg(F.count(F.lit(1)).alias("linhas")) \
        .select(F.lit(name).alias("tabela"), PARTITION_COLUMN, "linhas")


# Rows per operating day that the business expects, by table.
VOLUME_BANDS = {
    "erp_lotes_producao": (40, 80),
    "erp_notas_expedicao": (150, 300),
    "erp_posicoes_estoque": (30, 60),
    "tms_remessas": (150, 300),
    "crm_pedidos": (150, 300),
    "crm_atendimento": (20, 40),
    "financeiro_faturas": (150, 300),
}


def volume_bands(bronze: DataFrame, spec: TableSpec, band: tuple[int, int]) -> DataFrame:
    """Every calendar day between a table's first and last landed day against the expected rows.

    A day without rows is seen: ``sem_dado`` on an operating day of the
    table's system, ``fora_de_operacao`` otherwise.
    """
    daily = bronze.groupBy(F.to_date(PARTITION_COLUMN).alias("dia")).agg(F.count(F.lit(1)).alias("linhas"))
    span = daily.agg(F.min("dia").alias("ini"), F.max("dia").alias("fim")).where("ini IS NOT NULL")
    n = F.coalesce(F.col("linhas"), F.lit(0))
    verdict = (F.when((n == 0) & operates_on(F.lit(spec.system), F.col("dia")), "sem_dado").when(n == 0, "fora_de_operacao")
               .when(n < band[0], "abaixo").when(n > band[1], "acima").otherwise("na_faixa"))
    return (days_between(span, "ini", "fim").select("dia").join(daily, "dia", "left")
            .select(F.lit(spec.name).alias("tabela"), "dia", n.alias("linhas"), verdict.alias("situacao")))


def volume_anomaly(daily: DataFrame, window_days: int = 7, z: float = 3.0) -> DataFrame:
    """Daily row counts vs the trailing window mean and standard deviation.

    Both sides of the test are rounded to 6 decimals, so a deviation of
    exactly ``z`` standard deviations is not decided by the last float bit.
    The input has one row per table and landed day, so each window partition
    is bounded by the number of days, whatever the data volume.
    """
    w = Window.partitionBy("tabela").orderBy(PARTITION_COLUMN).rowsBetween(-window_days, -1)
    mean, sd = F.avg("linhas").over(w), F.stddev_samp("linhas").over(w)
    out = daily.select("tabela", PARTITION_COLUMN, "linhas", mean.alias("_m"), sd.alias("_s"))
    flag = F.when(F.col("_s").isNull() | (F.col("_s") == 0), F.lit(False)) \
        .otherwise(F.round(F.abs(F.col("linhas") - F.col("_m")), 6) > F.round(F.col("_s") * z, 6))
    return out.select("tabela", PARTITION_COLUMN, "linhas", F.round("_m", 4).alias("media_movel"),
                      F.round("_s", 4).alias("desvio_movel"), flag.alias("anomalia"))
