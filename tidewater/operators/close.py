"""Monthly financial close that refuses incomplete months.

All months are closed in one plan: invoices are aggregated by month,
receivables are pre-aggregated per invoice (an invoice with two receivable
rows is not counted twice), and completeness comes from an anti-join of the
finance calendar against successful runs. Nothing is collected to the
driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import days_between, operates_on

MONEY = "decimal(18,2)"


def closable_months(runs: DataFrame, system: str = "financeiro", pipeline: str = "gerar_dados") -> DataFrame:
    """Months from the first logged run up to the month before the last run day.

    A month can be closed only once it has ended (the default close is the
    previous month of the run date).
    """
    r = runs.where((F.col("pipeline") == pipeline) & (F.col("item") == system)) \
        .select(F.to_date("data_referencia").alias("dia"))
    span = r.agg(F.trunc(F.min("dia"), "MM").alias("ini"),
                 F.add_months(F.trunc(F.max("dia"), "MM"), -1).alias("fim"))
    return span.where(F.col("ini") <= F.col("fim")).select(
        F.explode(F.sequence("ini", "fim", F.expr("INTERVAL 1 MONTH"))).alias("mes"))


def business_days(months: DataFrame, system: str = "financeiro") -> DataFrame:
    """Expected operating days per month (``mes`` = first day of month)."""
    cal = days_between(months.select("mes", F.last_day("mes").alias("_fim")), "mes", "_fim")
    return cal.where(operates_on(F.lit(system), F.col("dia"))).select("mes", "dia")


def missing_run_days(runs: DataFrame, months: DataFrame, system: str = "financeiro",
                     pipeline: str = "gerar_dados") -> DataFrame:
    """Expected days with no successful run (a failed day that was re-run counts as run)."""
    seen = (runs.where((F.col("pipeline") == pipeline) & (F.col("item") == system)
                       & (F.col("status") == "sucesso"))
                .select(F.to_date("data_referencia").alias("dia")).distinct())
    return business_days(months, system).join(seen, "dia", "left_anti").select("mes", "dia")


def missing_by_system(runs: DataFrame, months: DataFrame, systems: tuple[str, ...],
                      pipeline: str = "gerar_dados") -> DataFrame:
    """(mes, sistema, dia): operating days of each system without a successful run."""
    out = None
    for s in systems:
        m = missing_run_days(runs, months, s, pipeline).select("mes", F.lit(s).alias("sistema"), "dia")
        out = m if out is None else out.unionByName(m)
    return out


def months_complete(runs: DataFrame, systems: tuple[str, ...]) -> DataFrame:
    """Per closable month of the first system: is it complete in every system, and how many days each lacks (JSON)."""
    months = closable_months(runs, systems[0])
    lacks = (missing_by_system(runs, months, systems).groupBy("mes")
             .agg(*[F.count_if(F.col("sistema") == s).alias(s) for s in systems], F.count(F.lit(1)).alias("dias_faltando")))
    j = months.join(lacks, "mes", "left")
    return j.select(F.date_format("mes", "yyyy-MM").alias("mes_referencia"),
                    F.coalesce("dias_faltando", F.lit(0)).alias("dias_faltando"),
                    F.to_json(F.struct(*[F.coalesce(F.col(s), F.lit(0)).alias(s) for s in systems])).alias("por_sistema"),
                    F.col("dias_faltando").isNull().alias("mes_completo"))


def monthly_close(reconciliation: DataFrame, receivables: DataFrame, runs: DataFrame,
                  systems: tuple[str, ...] = ("financeiro",)) -> DataFrame:
    """One close record per closable month of the first system.

    total_faturado, total_recebido (receivable status ``recebido``),
    total_em_aberto, total_faturas, total_divergentes, dias_faltando (JSON
    list of the first system's missing business days), por_sistema (JSON: how
    many days each system lacks) and fechamento_valido: no system lacks a run
    on one of its operating days.
    """
    months = closable_months(runs, systems[0])
    paid = (receivables.groupBy("fatura_id")
            .agg(F.max(F.col("status_conta") == "recebido").alias("_recebido")))
    inv = (reconciliation.select("fatura_id", "valor_faturado", "divergente",
                                 F.trunc("data_faturamento", "MM").alias("mes"))
           .join(paid, "fatura_id", "left"))
    totals = inv.groupBy("mes").agg(
        F.sum("valor_faturado").alias("_fat"),
        F.sum(F.when(F.col("_recebido"), F.col("valor_faturado"))).alias("_rec"),
        F.count(F.lit(1)).alias("total_faturas"),
        F.count_if(F.col("divergente")).alias("total_divergentes"))
    # At most one row per system and day of the month: a bounded list per group.
    first = F.col("sistema") == systems[0]
    missing = (missing_by_system(runs, months, systems).groupBy("mes").agg(
        F.array_sort(F.collect_list(F.when(first, F.date_format("dia", "yyyy-MM-dd")))).alias("_faltando"),
        *[F.count_if(F.col("sistema") == s).alias(f"_n_{s}") for s in systems], F.count(F.lit(1)).alias("_lacks")))
    j = months.join(totals, "mes", "left").join(missing, "mes", "left")
    fat = F.coalesce(F.col("_fat"), F.lit(0)).cast(MONEY)
    rec = F.coalesce(F.col("_rec"), F.lit(0)).cast(MONEY)
    return j.select(
        F.date_format("mes", "yyyy-MM").alias("mes_referencia"),
        fat.alias("total_faturado"), rec.alias("total_recebido"), (fat - rec).cast(MONEY).alias("total_em_aberto"),
        F.coalesce(F.col("total_faturas"), F.lit(0)).alias("total_faturas"),
        F.coalesce(F.col("total_divergentes"), F.lit(0)).alias("total_divergentes"),
        F.to_json(F.coalesce(F.col("_faltando"), F.array().cast("array<string>"))).alias("dias_faltando"),
        F.to_json(F.struct(*[F.coalesce(F.col(f"_n_{s}"), F.lit(0)).alias(s) for s in systems])).alias("por_sistema"),
        F.col("_lacks").isNull().alias("fechamento_valido"))


# ---- a month's states -----------------------------------------------------------
#
#   (none) -> aberto -> fechado | invalido -> reaberto -> fechado | invalido ...
#
# Opening and closing are two writes, so a job that dies between them leaves months
# open; the next run closes them. A closed month reopens when what it was closed on
# has changed: a missing run has landed, or an amount was corrected.

OPEN = ("aberto", "reaberto")
MEASURES = ("total_faturado", "total_recebido", "total_em_aberto", "total_faturas", "total_divergentes", "dias_faltando", "por_sistema",
            "fechamento_valido")
STATE = ("estado", "reaberturas", "atualizado_em")


def months_to_open(now: DataFrame, stored: DataFrame, at: Column) -> DataFrame:
    """Rows of the close table that have to be written to open months: new ones, and closed ones that no longer hold.

    ``now`` are close records as they would be today, ``stored`` the close table.
    """
    was = stored.select("mes_referencia", F.struct(*MEASURES).alias("_was"), "estado", "reaberturas")
    j = now.select("mes_referencia", F.struct(*MEASURES).alias("_now")).join(was, "mes_referencia", "left")
    new = F.col("estado").isNull()
    changed = ~F.col("estado").isin(*OPEN) & ~F.col("_now").eqNullSafe(F.col("_was"))
    return j.where(new | changed).select(
        "mes_referencia", *[F.col(f"_was.{c}").alias(c) for c in MEASURES],
        F.when(new, OPEN[0]).otherwise(OPEN[1]).alias("estado"),
        F.when(new, F.lit(0)).otherwise(F.col("reaberturas") + 1).cast("int").alias("reaberturas"), at.cast("timestamp").alias("atualizado_em"))


def months_to_close(now: DataFrame, stored: DataFrame, at: Column) -> DataFrame:
    """Rows that close every open month of the close table with its numbers of today."""
    waiting = stored.where(F.col("estado").isin(*OPEN)).select("mes_referencia", "reaberturas")
    return now.join(waiting, "mes_referencia").select(
        "mes_referencia", *MEASURES, F.when(F.col("fechamento_valido"), "fechado").otherwise("invalido").alias("estado"), "reaberturas",
        at.cast("timestamp").alias("atualizado_em"))


def close_alerts(close: DataFrame, quando: Column | None = None) -> DataFrame:
    """One high-severity alert per invalid month, with a deterministic id, dated (unless told) at the month's end."""
    from .alerts import alert_rows, month_end

    bad = close.where(~F.col("fechamento_valido"))
    dias = F.from_json("dias_faltando", "array<string>")
    lacks = F.aggregate(F.map_values(F.from_json("por_sistema", "map<string,bigint>")), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return alert_rows(
        bad, tipo="fechamento_invalido", origem="fechar_mes", severidade="alta",
        periodo=F.col("mes_referencia"),
        mensagem=F.concat(F.lit("Mês "), F.col("mes_referencia"), F.lit(" não pode ser fechado: faltam execuções de "),
                          lacks.cast("string"), F.lit(" dia(s)")),
        detalhes=F.to_json(F.struct(F.col("mes_referencia"), dias.alias("dias_faltando"),
                                    F.from_json("por_sistema", "map<string,bigint>").alias("por_sistema"))),
        quando=month_end(F.col("mes_referencia")) if quando is None else quando)
