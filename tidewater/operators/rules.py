"""Cross-system audit rules. They never drop a row.

Audit tables LEFT JOIN from their anchor entity and give every row a verdict;
unresolved references get an explicit category instead of vanishing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import lookup_join

# Acceptable cold-chain band, degrees Celsius.
COLD_CHAIN_MIN_C = 2.0
COLD_CHAIN_MAX_C = 8.0


def out_of_range_readings(leituras: DataFrame) -> DataFrame:
    """Readings outside the band; a NULL temperature is not a violation."""
    t = F.col("temperatura_celsius")
    return leituras.where((t < COLD_CHAIN_MIN_C) | (t > COLD_CHAIN_MAX_C))


def cold_chain(remessas: DataFrame, notas: DataFrame, lotes: DataFrame, produtos: DataFrame,
               veiculos: DataFrame, leituras: DataFrame,
               hot_lots: DataFrame | None = None) -> DataFrame:
    """Cold-chain verdict per shipment, first matching rule wins.

    nao_verificavel (product, its cold-chain flag or the vehicle unknown) ->
    nao_aplicavel (product needs no cold chain) -> veiculo_incorreto (vehicle
    not refrigerated) -> falha_equipamento (a reading out of band) -> conforme.
    A product id missing from the catalogue is *not* verifiable (the
    reference let it fall through to a verdict).
    """
    base = remessas.select("remessa_id", "nota_expedicao_id", "veiculo_id") \
        .join(notas.select("nota_expedicao_id", "lote_id"), "nota_expedicao_id", "left")
    base = lookup_join(base, lotes.select("lote_id", "produto_id"), "lote_id", "left", hot_lots)
    base = (base
            .join(produtos.select("produto_id", "nome_produto", "exige_cadeia_fria"), "produto_id", "left")
            .join(veiculos.select("veiculo_id", "refrigerado"),
                  "veiculo_id", "left"))
    # Pre-aggregated to one row per shipment before the join.
    flagged = out_of_range_readings(leituras).select("remessa_id").distinct() \
        .withColumn("_fora", F.lit(True))
    j = base.join(flagged, "remessa_id", "left")
    fora = F.coalesce(F.col("_fora"), F.lit(False))
    verifiable = (F.col("produto_id").isNotNull() & F.col("exige_cadeia_fria").isNotNull()
                  & F.col("refrigerado").isNotNull())
    verdict = (F.when(~verifiable, "nao_verificavel")
               .when(~F.col("exige_cadeia_fria"), "nao_aplicavel")
               .when(~F.col("refrigerado"), "veiculo_incorreto")
               .when(fora, "falha_equipamento")
               .otherwise("conforme"))
    return j.select("remessa_id", "veiculo_id", "produto_id", "nome_produto", "exige_cadeia_fria",
                    "refrigerado", fora.alias("teve_leitura_fora_faixa"), verdict.alias("tipo_violacao"))


def violations_by_type(cold: DataFrame) -> DataFrame:
    return (cold.groupBy("tipo_violacao").agg(F.count(F.lit(1)).alias("total"))
                .orderBy(F.desc("total"), "tipo_violacao"))


def cold_chain_rate(cold: DataFrame) -> DataFrame:
    """Share of verifiable, cold-chain shipments that violated it."""
    applicable = F.col("tipo_violacao").isin("veiculo_incorreto", "falha_equipamento", "conforme")
    violated = F.col("tipo_violacao").isin("veiculo_incorreto", "falha_equipamento")
    return cold.agg(F.count_if(applicable).alias("remessas_aplicaveis"),
                    F.count_if(violated).alias("remessas_violadas")) \
        .withColumn("taxa_violacao", F.try_divide(F.col("remessas_violadas").cast("double"),
                                                  F.col("remessas_aplicaveis")))


def sku_validity(itens: DataFrame, produtos: DataFrame) -> DataFrame:
    """Every order line with a flag: product id present in the catalogue."""
    known = produtos.select(F.col("produto_id").alias("_pid")).distinct().withColumn("_ok", F.lit(True))
    j = itens.join(known, itens.produto_id == known._pid, "left")
    return j.select("item_pedido_id", "pedido_id", "produto_id",
                    F.coalesce(F.col("_ok"), F.lit(False)).alias("sku_valido"))


def negative_stock(posicoes: DataFrame) -> DataFrame:
    return posicoes.select("posicao_id", "lote_id", "centro_distribuicao_id", "quantidade",
                           "data_posicao", (F.col("quantidade") < 0).alias("estoque_invalido"))


def delivery_date_drift(comprovantes: DataFrame, remessas: DataFrame) -> DataFrame:
    """Per delivery status: how many delivery dates differ from the promise.

    A child (proof of delivery) that always equals its parent's promise means
    the two were generated together, and the on-time KPI is meaningless.
    """
    j = comprovantes.join(remessas.select("remessa_id", "data_entrega_prevista"), "remessa_id")
    return (j.groupBy("status_entrega")
             .agg(F.count(F.lit(1)).alias("total"),
                  F.count_if(F.col("data_entrega_real") != F.col("data_entrega_prevista")).alias("diferentes"))
             .withColumn("taxa_diferente", F.col("diferentes") / F.col("total")))


# ---- generic rule checker ---------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """A named row predicate that marks a violation (NULL = not a violation)."""
    name: str
    predicate: str            # Spark SQL boolean expression over the table's columns
    severity: str = "media"

    def column(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def rule_violations(df: DataFrame, table: str, key: str, rules: list[Rule]) -> DataFrame:
    """One row per (row, violated rule): table, key, rule, severity.

    All rules are evaluated in one projection; violated ones are exploded out
    of an array, so the table is scanned once whatever the number of rules.
    """
    hits = F.array(*[
        F.when(r.column(), F.struct(F.lit(r.name).alias("regra"), F.lit(r.severity).alias("severidade")))
        for r in rules])
    return (df.select(F.lit(table).alias("tabela"), F.col(key).alias("chave"), F.explode(hits).alias("_h"))
              .where(F.col("_h").isNotNull())
              .select("tabela", "chave", "_h.regra", "_h.severidade"))


def kpi_plausibility(summary: DataFrame, rate_col: str = "taxa", name_col: str = "tabela") -> DataFrame:
    """Flag KPIs at exactly 0 % or 100 %: usually a generation or join bug."""
    r = F.col(rate_col)
    return summary.select(name_col, rate_col,
                          F.when(r.isNull(), "sem_dado").when(r == 0, "zero_suspeito")
                          .when(r == 1, "cem_suspeito").otherwise("plausivel").alias("veredito"))
