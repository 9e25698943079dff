"""Alerts as a table, built from rule outputs.

Each alert has a deterministic ``alerta_id`` (hash of type, source and
period), so re-running a job upserts the same alert instead of appending a
duplicate. Channels (e-mail, webhook) are out of scope; the table is the
contract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALERT_COLUMNS = ("alerta_id", "tipo_evento", "origem", "severidade", "periodo", "mensagem", "detalhes",
                 "timestamp_alerta")


def alert_rows(df: DataFrame, tipo: str, origem: str, severidade: str, periodo: Column,
               mensagem: Column, detalhes: Column, quando: Column | None = None) -> DataFrame:
    """Rows of the alert table; ``quando`` is the time of the alert (now, if not given)."""
    quando = F.current_timestamp() if quando is None else quando
    return df.select(
        F.sha2(F.concat_ws("|", F.lit(tipo), F.lit(origem), periodo), 256).alias("alerta_id"),
        F.lit(tipo).alias("tipo_evento"), F.lit(origem).alias("origem"),
        F.lit(severidade).alias("severidade"), periodo.alias("periodo"),
        mensagem.alias("mensagem"), detalhes.alias("detalhes"), quando.cast("timestamp").alias("timestamp_alerta"))


def cold_chain_alerts(cold: DataFrame, quando: Column | None = None) -> DataFrame:
    """Alert when any shipment of a cold-chain product rode a non-refrigerated vehicle."""
    n = cold.agg(F.count_if(F.col("tipo_violacao") == "veiculo_incorreto").alias("n")).where(F.col("n") > 0)
    return alert_rows(
        n, tipo="cadeia_fria", origem="observability_cadeia_fria", severidade="alta",
        periodo=F.lit("total"),
        mensagem=F.concat(F.lit("Cadeia fria: remessas em veículo sem refrigeração: "), F.col("n").cast("string")),
        detalhes=F.to_json(F.struct(F.col("n").alias("total_violacoes"))), quando=quando)


def month_end(month: Column) -> Column:
    """First instant after a month given as yyyy-MM."""
    return F.add_months(F.to_date(F.concat(month, F.lit("-01"))), 1).cast("timestamp")


def reconciliation_alerts(reconciliation: DataFrame, quando: Column | None = None) -> DataFrame:
    """One alert per invoicing month with divergent invoices, dated (unless told) at the month's end."""
    m = (reconciliation.groupBy(F.date_format("data_faturamento", "yyyy-MM").alias("mes"))
         .agg(F.count_if(F.col("divergente")).alias("n"), F.count(F.lit(1)).alias("total"))
         .where(F.col("n") > 0))
    return alert_rows(
        m, tipo="reconciliacao", origem="gold_reconciliacao_financeira", severidade="media",
        periodo=F.col("mes"),
        mensagem=F.concat(F.col("n").cast("string"), F.lit(" de "), F.col("total").cast("string"),
                          F.lit(" faturas divergentes em "), F.col("mes")),
        detalhes=F.to_json(F.struct(F.col("mes").alias("mes_referencia"), F.col("n").alias("divergentes"),
                                    F.col("total").alias("total_faturas"))),
        quando=month_end(F.col("mes")) if quando is None else quando)


def run_sla_alerts(breaches: DataFrame) -> DataFrame:
    """One alert per run that exceeded the duration threshold, dated at the run's end."""
    return alert_rows(
        breaches, tipo="sla_execucao", origem="pipeline_runs", severidade="media",
        periodo=F.concat_ws("|", F.col("pipeline"), F.col("item"), F.col("data_referencia")),
        mensagem=F.concat(F.col("pipeline"), F.lit("/"), F.col("item"), F.lit(" levou "),
                          F.col("duracao_segundos").cast("string"), F.lit(" s em "), F.col("data_referencia")),
        detalhes=F.to_json(F.struct("execucao_id", "duracao_segundos")),
        quando=F.col("ended_at") if "ended_at" in breaches.columns else None)


def all_alerts(*parts: DataFrame) -> DataFrame:
    out = None
    for p in parts:
        p = p.select(*ALERT_COLUMNS)
        out = p if out is None else out.unionByName(p)
    return out


def tracked(found: DataFrame, stored: DataFrame | None, at: Column) -> DataFrame:
    """Rows to merge into the alert table: what holds now is open, what was open and holds no longer is resolved.

    A resolved alert keeps its text and time; one that comes back is open again.
    """
    now = found.select(*ALERT_COLUMNS, F.lit("aberto").alias("situacao"), F.lit(None).cast("timestamp").alias("resolvido_em"))
    if stored is None:
        return now
    gone = stored.where(F.col("situacao") == "aberto").join(found.select("alerta_id"), "alerta_id", "left_anti")
    return now.unionByName(gone.select(*ALERT_COLUMNS, F.lit("resolvido").alias("situacao"), at.cast("timestamp").alias("resolvido_em")))


def recent_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    """The latest alerts by time; ids break ties."""
    return alerts.orderBy(F.desc("timestamp_alerta"), F.asc("alerta_id")).limit(n)
