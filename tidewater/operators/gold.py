"""Business KPIs: reconciliation, on-time delivery, production quality.

KPI tables may inner join (a KPI is defined over matched pairs); what the
inner join drops is reported by a separate orphan query, so nothing vanishes
silently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import MONEY_TYPE
from .joins import lookup_join

ONE_CENT = "0.01"


def reconcile_invoices(faturas: DataFrame, pedidos: DataFrame,
                       hot_orders: DataFrame | None = None) -> DataFrame:
    """One row per invoice whose order exists; divergent when |diff| > one cent.

    ``divergente`` is NULL when either amount is NULL (three-valued).
    ``hot_orders`` is a bounded set of heavy ``pedido_id`` values (e.g. an
    orphan marker shared by many invoices); those rows are salted.
    """
    inv = faturas.select("fatura_id", "pedido_id", "valor_faturado", "data_faturamento")
    j = lookup_join(inv, pedidos.select("pedido_id", "valor_total"), "pedido_id", "inner", hot_orders)
    diff = (F.col("valor_faturado") - F.col("valor_total")).cast(MONEY_TYPE)
    return j.select("fatura_id", "pedido_id", "valor_total", "valor_faturado",
                    diff.alias("divergencia_valor"),
                    (F.abs(diff) > F.lit(ONE_CENT).cast(MONEY_TYPE)).alias("divergente"),
                    "data_faturamento")


def reconcile_orphans(faturas: DataFrame, pedidos: DataFrame,
                      hot_orders: DataFrame | None = None) -> DataFrame:
    """Invoices whose order is unknown: what the inner join above drops."""
    inv = faturas.select("fatura_id", "pedido_id", "valor_faturado", "data_faturamento")
    return lookup_join(inv, pedidos.select("pedido_id"), "pedido_id", "left_anti", hot_orders) \
        .select("fatura_id", "pedido_id", "valor_faturado", "data_faturamento")


def otif(comprovantes: DataFrame, remessas: DataFrame) -> DataFrame:
    """On-time half of OTIF per delivery; ``no_prazo`` NULL unless POD confirmed."""
    j = comprovantes.join(remessas.select("remessa_id", "data_entrega_prevista"), "remessa_id")
    on_time = F.when(F.col("pod_confirmado"), F.col("data_entrega_real") <= F.col("data_entrega_prevista"))
    return j.select("remessa_id", "comprovante_id", "data_entrega_prevista", "data_entrega_real",
                    "pod_confirmado", on_time.alias("no_prazo"), "status_entrega")


def otif_rate(otif_df: DataFrame) -> DataFrame:
    """One row: deliveries, confirmed, on time, on-time share of confirmed."""
    return otif_df.agg(
        F.count(F.lit(1)).alias("total_entregas"),
        F.count_if(F.col("pod_confirmado")).alias("confirmadas"),
        F.count_if(F.col("no_prazo")).alias("no_prazo"),
    ).withColumn("taxa_no_prazo", F.try_divide(F.col("no_prazo").cast("double"), F.col("confirmadas")))


def production_quality(lotes: DataFrame) -> DataFrame:
    """Reject rate per production centre x product (NULL status counts in total only)."""
    return (lotes.groupBy("centro_producao_id", "produto_id")
                 .agg(F.count(F.lit(1)).alias("total_lotes"),
                      F.count_if(F.col("status_qc") == "reprovado").alias("lotes_reprovados"))
                 .withColumn("taxa_rejeicao", F.col("lotes_reprovados") / F.col("total_lotes")))


def worst_quality_groups(quality: DataFrame, n: int = 20) -> DataFrame:
    """Top-n groups by reject rate; keys break ties so the cut is deterministic."""
    return quality.orderBy(F.desc("taxa_rejeicao"), "centro_producao_id", "produto_id").limit(n)


def gold_summary(reconciliation: DataFrame, otif_df: DataFrame, quality: DataFrame, cold: DataFrame,
                 sku: DataFrame, stock: DataFrame) -> DataFrame:
    """Row counts and flagged shares of the gold and audit tables, one pass each.

    A share is taken over the rows that can be judged: confirmed deliveries
    for on-time delivery, lots for production quality (``sinalizadas`` counts
    lots there), verifiable cold-chain shipments for the cold chain. Rates use
    a zero-safe division: nothing to judge gives NULL, not an error.
    """
    def one(df, name, flagged, judged=None):
        return df.agg(F.lit(name).alias("tabela"), F.count(F.lit(1)).alias("total_linhas"), flagged.alias("sinalizadas"),
                      (F.count(F.lit(1)) if judged is None else judged).alias("_de")) \
                 .withColumn("taxa", F.try_divide(F.col("sinalizadas").cast("double"), F.col("_de"))).drop("_de")

    verdict = F.col("tipo_violacao")
    violated = verdict.isin("veiculo_incorreto", "falha_equipamento")
    rows = [
        one(reconciliation, "gold_reconciliacao_financeira", F.count_if(F.col("divergente"))),
        one(otif_df, "gold_otif", F.count_if(F.col("no_prazo")), F.count_if(F.col("pod_confirmado"))),
        one(quality, "gold_qualidade_producao", F.coalesce(F.sum("lotes_reprovados"), F.lit(0)), F.sum("total_lotes")),
        one(cold, "observability_cadeia_fria", F.count_if(violated), F.count_if(violated | (verdict == "conforme"))),
        one(sku, "observability_qualidade_sku", F.count_if(~F.col("sku_valido"))),
        one(stock, "observability_estoque_negativo", F.count_if(F.col("estoque_invalido"))),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
