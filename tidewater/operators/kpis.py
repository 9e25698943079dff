"""KPIs and rules the business documents but the source project never coded.

Fact-to-fact lookups go through :func:`~tidewater.operators.joins.lookup_join`
(hot keys salted), catalogue lookups are joins that Spark broadcasts by size, and
every per-group statistic is a map-side combined aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import hours_to_days
from .joins import lookup_join


def _month(c: str):
    return F.date_format(c, "yyyy-MM")


def dso(faturas: DataFrame, contas: DataFrame) -> DataFrame:
    """Days sales outstanding per invoicing month: mean days invoice -> receipt.

    Unpaid receivables are excluded from the mean and counted apart.
    """
    j = contas.select("fatura_id", "data_recebimento", "status_conta") \
        .join(faturas.select("fatura_id", "data_faturamento"), "fatura_id")
    paid = (F.col("status_conta") == "recebido") & F.col("data_recebimento").isNotNull()
    days = F.datediff("data_recebimento", "data_faturamento")
    return j.groupBy(_month("data_faturamento").alias("mes")).agg(
        F.round(F.avg(F.when(paid, days)), 4).alias("dso_dias"),
        F.count_if(paid).alias("faturas_recebidas"),
        F.count_if(~F.coalesce(paid, F.lit(False))).alias("faturas_em_aberto"))


def reconciled_pct(reconciliation: DataFrame) -> DataFrame:
    """Share of invoices reconciled without divergence, per invoicing month."""
    return reconciliation.groupBy(_month("data_faturamento").alias("mes")).agg(
        F.count(F.lit(1)).alias("faturas"),
        F.count_if(~F.col("divergente")).alias("sem_divergencia"),
        F.count_if(F.col("divergente").isNull()).alias("sem_veredito"),
        F.round(F.avg((~F.col("divergente")).cast("double")), 6).alias("pct_conciliado"))


def missing_cost_center(faturas: DataFrame, centros: DataFrame) -> DataFrame:
    """Every invoice with its cost-centre verdict: ok / sem_centro / centro_desconhecido."""
    known = centros.select(F.col("centro_custo_id").alias("_cc")).distinct().withColumn("_ok", F.lit(True))
    j = faturas.join(known, faturas.centro_custo_id == known._cc, "left")
    verdict = (F.when(F.col("centro_custo_id").isNull(), "sem_centro")
               .when(F.col("_ok").isNull(), "centro_desconhecido").otherwise("ok"))
    return j.select("fatura_id", "centro_custo_id", verdict.alias("situacao"))


def delivery_without_pod(comprovantes: DataFrame) -> DataFrame:
    return comprovantes.where(F.col("pod_confirmado").isNull()) \
        .select("comprovante_id", "remessa_id", "status_entrega", "data_entrega_real")


def invoice_before_delivery(faturas: DataFrame, comprovantes: DataFrame) -> DataFrame:
    """Invoices whose shipment has no confirmed proof of delivery."""
    confirmed = comprovantes.where(F.col("pod_confirmado")).select("remessa_id").distinct()
    return faturas.join(confirmed, "remessa_id", "left_anti") \
        .select("fatura_id", "remessa_id", "data_faturamento")


def blocked_customer_orders(pedidos: DataFrame, clientes: DataFrame) -> DataFrame:
    blocked = clientes.where(F.col("status_cliente") == "bloqueado").select("cliente_id")
    return pedidos.join(blocked, "cliente_id", "left_semi") \
        .select("pedido_id", "cliente_id", "data_pedido", "valor_total", "status_pedido")


def unreleased_lot_dispatch(notas: DataFrame, lotes: DataFrame, hot_lots: DataFrame | None = None) -> DataFrame:
    """Every dispatch note classified: liberado / nao_liberado / lote_inexistente."""
    lots = lotes.select("lote_id", "status_qc", F.lit(True).alias("_achado"))
    j = lookup_join(notas.select("nota_expedicao_id", "lote_id"), lots, "lote_id", "left", hot_lots)
    cat = (F.when(F.col("_achado").isNull(), "lote_inexistente")
           .when(F.col("status_qc") == "aprovado", "liberado").otherwise("nao_liberado"))
    return j.select("nota_expedicao_id", "lote_id", "status_qc", cat.alias("categoria"))


def fefo_compliance(notas: DataFrame, lotes: DataFrame, posicoes: DataFrame,
                    hot_lots: DataFrame | None = None, hot_centre_days: DataFrame | None = None) -> DataFrame:
    """First-expire-first-out per dispatch.

    Available stock = positions with quantity > 0 of approved lots, per
    distribution centre, product and day. The dispatched lot complies when
    it expires no later than the earliest-expiring available lot of the same
    product at the same centre on the dispatch day. The minimum per
    (centre, product, day) is an aggregate, joined back on that composite
    key (equi-join, no range join, no pairs). The key is ordered
    ``centre|day|product``: a hot composite key implies a hot (centre, day)
    among the dispatch notes, so ``hot_centre_days`` ('centre|yyyy-MM-dd',
    from :func:`centre_days_hot`) salts by the key's first two parts without
    materialising the dispatch-lot join twice.
    """
    lots = lotes.select("lote_id", "produto_id", "status_qc", "data_validade")
    avail = (posicoes.where(F.col("quantidade") > 0)
             .select("lote_id", "centro_distribuicao_id", "data_posicao")
             .join(lots.where(F.col("status_qc") == "aprovado"), "lote_id")
             .groupBy("centro_distribuicao_id", "produto_id", F.col("data_posicao").alias("dia"))
             .agg(F.min("data_validade").alias("validade_minima_disponivel")))
    # concat, not concat_ws: a key with a NULL part is NULL and matches nothing.
    key = F.concat(F.col("centro_distribuicao_id"), F.lit("|"), F.date_format("dia", "yyyy-MM-dd"), F.lit("|"), F.col("produto_id"))
    avail = avail.select(key.alias("_k"), "validade_minima_disponivel")
    disp = lookup_join(notas.select("nota_expedicao_id", "lote_id", "centro_distribuicao_id", "data_expedicao"),
                       lots.select("lote_id", "produto_id", "data_validade", F.lit(True).alias("_achado")),
                       "lote_id", "left", hot_lots)
    disp = disp.withColumn("_k", F.concat(F.col("centro_distribuicao_id"), F.lit("|"), F.date_format("data_expedicao", "yyyy-MM-dd"),
                                          F.lit("|"), F.col("produto_id")))
    if hot_centre_days is None:
        hot_centre_days = centre_days_hot(notas)
    j = lookup_join(disp, avail, "_k", "left", hot_centre_days,
                    hot_part=lambda k: F.substring_index(k, "|", 2))
    verdict = (F.when(F.col("_achado").isNull(), "lote_inexistente")
               .when(F.col("validade_minima_disponivel").isNull(), "sem_posicao_estoque")
               .when(F.col("data_validade") <= F.col("validade_minima_disponivel"), "conforme")
               .otherwise("fora_fefo"))
    return j.select("nota_expedicao_id", "lote_id", "produto_id", "centro_distribuicao_id", "data_expedicao",
                    "data_validade", "validade_minima_disponivel", verdict.alias("situacao"))


def centre_days_hot(notas: DataFrame) -> DataFrame:
    """Hot (centre, dispatch day) pairs of the dispatch notes, as 'centre|yyyy-MM-dd'."""
    from .joins import heavy_hitters

    pairs = notas.select(F.concat_ws("|", "centro_distribuicao_id",
                                     F.date_format("data_expedicao", "yyyy-MM-dd")).alias("_cd"))
    return heavy_hitters(pairs, "_cd")


def pick_cycle_time(notas: DataFrame, pedidos: DataFrame) -> DataFrame:
    """Order -> dispatch days per distribution centre: mean, median, max.

    The exact median keeps one count per distinct value per group (not one
    entry per row), and whole-day differences have few distinct values, so
    even a centre holding a third of all dispatches has a small buffer.
    """
    j = notas.select("pedido_id", "centro_distribuicao_id", "data_expedicao") \
        .join(pedidos.select("pedido_id", "data_pedido"), "pedido_id")
    days = F.datediff("data_expedicao", "data_pedido")
    return j.groupBy("centro_distribuicao_id").agg(
        F.count(F.lit(1)).alias("expedicoes"),
        F.round(F.avg(days), 4).alias("ciclo_medio_dias"),
        F.percentile(days, 0.5).alias("ciclo_mediano_dias"),
        F.max(days).alias("ciclo_maximo_dias"))


def transit_time_by_route(remessas: DataFrame, comprovantes: DataFrame, rotas: DataFrame) -> DataFrame:
    j = (comprovantes.select("remessa_id", "data_entrega_real")
         .join(remessas.select("remessa_id", "rota_id", "data_expedicao"), "remessa_id")
         .join(rotas, "rota_id", "left"))
    days = F.datediff("data_entrega_real", "data_expedicao")
    std = hours_to_days("tempo_transito_padrao_horas")
    return j.groupBy("rota_id", "regiao_destino", std.alias("transito_padrao_dias")).agg(
        F.count(F.lit(1)).alias("entregas"),
        F.round(F.avg(days), 4).alias("transito_medio_dias"),
        F.count_if(days > std).alias("acima_do_padrao"))


def sla_breach(comprovantes: DataFrame, remessas: DataFrame) -> DataFrame:
    j = comprovantes.join(remessas.select("remessa_id", "data_entrega_prevista"), "remessa_id")
    return j.select("remessa_id", "data_entrega_prevista", "data_entrega_real",
                    F.datediff("data_entrega_real", "data_entrega_prevista").alias("atraso_dias"),
                    (F.col("data_entrega_real") > F.col("data_entrega_prevista")).alias("violou_sla"))


def orders_by_region(pedidos: DataFrame, clientes: DataFrame) -> DataFrame:
    c = clientes.select("cliente_id", "regiao")
    j = pedidos.select("pedido_id", "cliente_id", "valor_total").join(c, "cliente_id", "left")
    return j.groupBy(F.coalesce(F.col("regiao"), F.lit("desconhecida")).alias("regiao")).agg(
        F.count(F.lit(1)).alias("pedidos"), F.sum("valor_total").alias("valor_total"))


def orders_by_representative(pedidos: DataFrame, representantes: DataFrame) -> DataFrame:
    """Orders and value per sales representative; an unknown one keeps a NULL name."""
    per = pedidos.groupBy("representante_id").agg(F.count(F.lit(1)).alias("pedidos"), F.sum("valor_total").alias("valor_total"))
    return per.join(representantes.select("representante_id", "nome_representante"), "representante_id", "left") \
        .select("representante_id", "nome_representante", "pedidos", "valor_total")


# Payment term of an invoice, days.
PAYMENT_DAYS = 30


def due_date_check(contas: DataFrame, faturas: DataFrame) -> DataFrame:
    """Every receivable with the due date its invoice implies (NULL if the invoice is unknown)."""
    j = contas.select("conta_receber_id", "fatura_id", "data_vencimento").join(
        faturas.select("fatura_id", "data_faturamento"), "fatura_id", "left")
    due = F.date_add("data_faturamento", PAYMENT_DAYS)
    return j.select("conta_receber_id", "fatura_id", "data_vencimento", due.alias("vencimento_esperado"),
                    (F.col("data_vencimento") == due).alias("vencimento_confere"))


def complaints_per_lot(atendimento: DataFrame, lotes: DataFrame) -> DataFrame:
    """Complaints per lot and per thousand units produced (recall trigger)."""
    c = (atendimento.where((F.col("tipo_interacao") == "reclamacao") & F.col("lote_id").isNotNull())
         .groupBy("lote_id").agg(F.count(F.lit(1)).alias("reclamacoes")))
    j = c.join(lotes.select("lote_id", "quantidade_produzida"), "lote_id", "left")
    rate = F.try_divide(F.col("reclamacoes") * 1000.0, F.col("quantidade_produzida"))
    return j.select("lote_id", "reclamacoes", "quantidade_produzida",
                    F.round(rate, 6).alias("reclamacoes_por_mil_unidades"),
                    F.col("quantidade_produzida").isNotNull().alias("lote_conhecido"))


def lot_trace(lot_set: DataFrame, notas: DataFrame, remessas: DataFrame, pedidos: DataFrame,
              hot_lots: DataFrame | None = None) -> DataFrame:
    """Lot -> dispatch note -> shipment -> order -> customer, for a set of lots."""
    lots = lot_set.select("lote_id").distinct()
    n = lookup_join(notas.select("nota_expedicao_id", "lote_id", "pedido_id"), lots, "lote_id", "inner", hot_lots)
    j = (n.join(remessas.select("remessa_id", "nota_expedicao_id"), "nota_expedicao_id", "left")
          .join(pedidos.select("pedido_id", "cliente_id"), "pedido_id", "left"))
    return j.select("lote_id", "nota_expedicao_id", "remessa_id", "pedido_id", "cliente_id")


def lot_release_time(lotes: DataFrame) -> DataFrame:
    return lotes.select("lote_id", "centro_producao_id", "produto_id", "status_qc",
                        F.datediff("data_liberacao", "data_fabricacao").alias("dias_ate_liberacao"))


def billable_deliveries(comprovantes: DataFrame, remessas: DataFrame) -> DataFrame:
    """Deliveries with a confirmed proof: the only ones that may be invoiced."""
    c = comprovantes.where(F.col("pod_confirmado")).select("remessa_id", "comprovante_id", "data_entrega_real")
    return c.join(remessas.select("remessa_id", "pedido_id"), "remessa_id") \
        .select("remessa_id", "pedido_id", "comprovante_id", "data_entrega_real")


def lot_cold_flag(lotes: DataFrame, produtos: DataFrame) -> DataFrame:
    p = produtos.select("produto_id", "exige_cadeia_fria")
    return lotes.select("lote_id", "produto_id").join(p, "produto_id", "left") \
        .select("lote_id", "produto_id", "exige_cadeia_fria")
