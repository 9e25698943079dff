"""Dirty landing-shaped views over the driver's tables.

Each view carries the shape and the dirt of one source table (mixed date
layouts, Brazilian numbers, case/space noise, null spellings, orphan keys,
hot keys) onto the TPC-H-like driver tables, by key arithmetic only, so the
same rows can be produced by DuckDB (``tidewater.oracle.sql``) for
an independent check. Every view is plain text, like bronze, plus the ingest
partition column ``data``. Their size grows with the driver tables.

Seed catalogues are fixed and tiny; they are built as local relations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import SEEDS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- text helpers (mirrored one-to-one in the DuckDB fixture SQL) ---------

def num(x: Column, places: int = 2) -> Column:
    return F.translate(F.format_number(x, places), ",.", ".,")


def dmy(d: Column) -> Column:
    return F.date_format(d, "dd/MM/yyyy")


def iso(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def mixed(d: Column, k: Column) -> Column:
    return F.when(k % 2 == 0, dmy(d)).otherwise(iso(d))


def caps(s: Column, k: Column) -> Column:
    m = k % 4
    return (F.when(m == 0, F.upper(s)).when(m == 1, F.lower(s))
            .when(m == 2, F.concat(F.lit(" "), s, F.lit(" "))).otherwise(F.concat(s, F.lit(" "))))


def padded(prefix: str, k: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(k.cast("string"), 9, "0"))


def tagged(prefix: str, k: Column) -> Column:
    return F.concat(F.lit(prefix), k.cast("string"))


def plus_days(d: Column, n) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    return F.date_add(d, n.cast("int"))


def _orders(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o, F.col("o_orderkey"), F.to_date("o_orderdate")


# ---- event tables ----------------------------------------------------------

def pedidos(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k, day = _orders(spark, sf_dir)
    status = (F.when(F.col("o_orderstatus") == "P", "aberto")
              .when(F.col("o_orderstatus") == "F", "concluido").otherwise("cancelado"))
    return o.select(
        padded("PED-", k).alias("pedido_id"),
        tagged("CLI-", F.col("o_custkey")).alias("cliente_id"),
        F.concat(F.lit("REP-00"), (F.col("o_custkey") % 8 + 1).cast("string")).alias("representante_id"),
        F.when(k % 50 == 7, F.lit("N/A")).otherwise(mixed(day, k)).alias("data_pedido"),
        F.when(k % 97 == 0, F.lit("NULL")).otherwise(num(F.col("o_totalprice"))).alias("valor_total"),
        caps(status, k).alias("status_pedido"),
        iso(day).alias("data"),
    )


def itens_pedido(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    s = order + line
    return li.select(
        F.concat(F.lit("ITEM-"), order.cast("string"), F.lit("-"), line.cast("string")).alias("item_pedido_id"),
        padded("PED-", order).alias("pedido_id"),
        F.when(s % 33 == 0, F.lit("PROD-999"))
         .otherwise(F.concat(F.lit("PROD-00"), (F.col("l_partkey") % 3 + 1).cast("string"))).alias("produto_id"),
        # Fractions are cut off, not rounded.
        F.when(s % 40 == 3, F.concat(num(F.col("l_quantity"), 0), F.lit(",996")))
         .otherwise(num(F.col("l_quantity"), 0)).alias("quantidade"),
        # US layout on a few lines: not a Brazilian number, so quarantined.
        F.when(s % 250 == 11, F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
         .otherwise(num(F.col("l_extendedprice"))).alias("preco_unitario"),
        iso(F.to_date("l_shipdate")).alias("data"),
    )


def lotes_producao(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    made = plus_days(F.lit("1995-01-01").cast("date"), k % 365)
    rejected = k % 9 == 4
    return p.select(
        tagged("LOTE-", k).alias("lote_id"),
        F.when(k % 40 == 0, F.lit("PROD-777"))
         .otherwise(F.concat(F.lit("PROD-00"), (k % 3 + 1).cast("string"))).alias("produto_id"),
        caps(F.when(F.col("p_size") % 2 == 0, F.lit("CP01")).otherwise(F.lit("CP02")), k).alias("centro_producao_id"),
        mixed(made, k).alias("data_fabricacao"),
        mixed(plus_days(F.lit("1996-01-01").cast("date"), k % 730), k).alias("data_validade"),
        num(F.col("p_retailprice")).alias("quantidade_produzida"),
        caps(F.when(rejected, F.lit("reprovado")).otherwise(F.lit("aprovado")), k).alias("status_qc"),
        F.when(rejected, F.lit(""))
         .otherwise(mixed(plus_days(F.lit("1995-01-03").cast("date"), k % 365), k)).alias("data_liberacao"),
        iso(made).alias("data"),
    )


def notas_expedicao(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k, day = _orders(spark, sf_dir)
    return o.select(
        tagged("NOTA-", k).alias("nota_expedicao_id"),
        padded("PED-", k).alias("pedido_id"),
        # LOTE-X: one unknown lot on a seventh of all notes -> a hot join key.
        F.when(k % 7 == 0, F.lit("LOTE-X")).otherwise(tagged("LOTE-", F.col("o_custkey"))).alias("lote_id"),
        # No centre: a NULL part of a composite key must match nothing.
        F.when(k % 53 == 9, F.lit("N/A"))
         .otherwise(caps(F.when(k % 3 == 0, F.lit("CD01")).otherwise(F.lit("CD02")), k)).alias("centro_distribuicao_id"),
        num(k % 50 + 1, 0).alias("quantidade_expedida"),
        mixed(plus_days(day, 1), k).alias("data_expedicao"),
        iso(plus_days(day, 1)).alias("data"),
    )


def remessas(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k, day = _orders(spark, sf_dir)
    return o.select(
        padded("REM-", k).alias("remessa_id"),
        tagged("NOTA-", k).alias("nota_expedicao_id"),
        padded("PED-", k).alias("pedido_id"),
        F.concat(F.lit("ROTA-00"), (k % 4 + 1).cast("string")).alias("rota_id"),
        F.when(k % 101 == 0, F.lit("VEI-099"))
         .otherwise(F.concat(F.lit("VEI-00"), (k % 6 + 1).cast("string"))).alias("veiculo_id"),
        num(k % 4 * 8 + 8, 0).alias("sla_horas_contratado"),
        mixed(plus_days(day, 1), k).alias("data_expedicao"),
        mixed(plus_days(day, 3), k).alias("data_entrega_prevista"),
        iso(plus_days(day, 1)).alias("data"),
    )


def leituras_temperatura(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    k = F.col("event_id")
    base = (k % 60) / 10
    return e.select(
        tagged("LEIT-", k).alias("leitura_id"),
        padded("REM-", k).alias("remessa_id"),
        # A time of day without a date is not a timestamp.
        F.when(k % 90 == 11, F.lit("10:30")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("timestamp_leitura"),
        # Three decimals just outside the band, which rounding would move inside it.
        F.when(k % 80 == 7, F.lit("8,004")).when(k % 80 == 27, F.lit("1,996")).when(k % 80 == 47, F.lit("-0,004"))
         .otherwise(num(F.when(k % 20 == 4, base + 9).otherwise(base + 2))).alias("temperatura_celsius"),
        iso(F.to_date("ts")).alias("data"),
    )


def _delivery_offset(k: Column) -> Column:
    return F.when(k % 19 == 0, 6).when(k % 19 < 4, 4).otherwise(3)


def comprovantes_entrega(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k, day = _orders(spark, sf_dir)
    real = plus_days(day, _delivery_offset(k))
    status = F.when(k % 19 == 0, F.lit("devolvida")).when(k % 19 < 4, F.lit("atrasada")).otherwise(F.lit("entregue"))
    return o.select(
        tagged("POD-", k).alias("comprovante_id"),
        padded("REM-", k).alias("remessa_id"),
        mixed(real, k).alias("data_entrega_real"),
        caps(status, k).alias("status_entrega"),
        F.when(k % 14 != 0, F.lit("true")).when(k % 3 == 0, F.lit("N/A"))
         .when(k % 3 == 1, F.lit("")).otherwise(F.lit(None).cast("string")).alias("pod_confirmado"),
        iso(real).alias("data"),
    )


def faturas(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k, day = _orders(spark, sf_dir)
    billed = plus_days(day, k % 3 + 3)
    price = F.col("o_totalprice")
    # One in a hundred is billed before its delivery is confirmed.
    return o.filter((k % 14 != 0) | (k % 98 == 0)).select(
        tagged("FAT-", k).alias("fatura_id"),
        F.when(k % 61 == 5, F.lit("PED-ORFAO")).otherwise(padded("PED-", k)).alias("pedido_id"),
        padded("REM-", k).alias("remessa_id"),
        num(F.when(k % 25 < 2, price + 12.34).otherwise(price)).alias("valor_faturado"),
        mixed(billed, k).alias("data_faturamento"),
        F.when(k % 33 == 0, F.lit("NULL"))
         .otherwise(F.concat(F.lit("CC-00"), (k % 5 + 1).cast("string"))).alias("centro_custo_id"),
        iso(billed).alias("data"),
    )


def contas_receber(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k, day = _orders(spark, sf_dir)
    paid = k % 5 < 3
    return o.filter(k % 14 != 0).select(
        tagged("CR-", k).alias("conta_receber_id"),
        tagged("FAT-", k).alias("fatura_id"),
        mixed(plus_days(day, 33), k).alias("data_vencimento"),
        F.when(paid, mixed(plus_days(day, k % 11 + 28), k)).otherwise(F.lit("N/A")).alias("data_recebimento"),
        caps(F.when(paid, F.lit("recebido")).otherwise(F.lit("em aberto")), k).alias("status_conta"),
        iso(plus_days(day, k % 3 + 3)).alias("data"),
    )


def posicoes_estoque(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    d = plus_days(F.lit("1996-01-01").cast("date"), k * 5 % 700)
    return c.select(
        tagged("POS-", k).alias("posicao_id"),
        tagged("LOTE-", k).alias("lote_id"),
        F.when(k % 29 == 3, F.lit("")).otherwise(caps(F.when(k % 2 == 0, F.lit("CD01")).otherwise(F.lit("CD02")), k))
         .alias("centro_distribuicao_id"),
        num(F.floor("c_acctbal"), 0).alias("quantidade"),
        mixed(d, k).alias("data_posicao"),
        iso(d).alias("data"),
    )


def atendimento(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    k = F.col("event_id")
    kind = (F.when(F.col("event_type") == "error", F.lit("reclamacao"))
            .when(F.col("event_type") == "view", F.lit("duvida"))
            .when(F.col("event_type") == "purchase", F.lit("elogio")).otherwise(F.lit("solicitacao")))
    d = F.to_date("ts")
    return e.select(
        tagged("INT-", k).alias("interacao_id"),
        tagged("CLI-", F.col("user_id")).alias("cliente_id"),
        F.when(k % 10 == 0, tagged("LOTE-", F.col("user_id")))
         .when(k % 3 == 0, F.lit("N/A")).otherwise(F.lit("")).alias("lote_id"),
        caps(kind, k).alias("tipo_interacao"),
        F.col("props").alias("descricao"),
        # Junk, not dates: quarantined.
        F.when(k % 250 == 13, F.lit("ontem")).when(k % 250 == 63, F.lit("01/02/99/2026"))
         .when(k % 250 == 113, F.lit("1/2/3/2026")).when(k % 250 == 163, F.lit("31/02/2026"))
         .otherwise(mixed(d, k)).alias("data_interacao"),
        iso(d).alias("data"),
    )


EVENT_FIXTURES = {
    "crm_pedidos": pedidos,
    "crm_itens_pedido": itens_pedido,
    "crm_atendimento": atendimento,
    "erp_lotes_producao": lotes_producao,
    "erp_posicoes_estoque": posicoes_estoque,
    "erp_notas_expedicao": notas_expedicao,
    "tms_remessas": remessas,
    "tms_leituras_temperatura": leituras_temperatura,
    "tms_comprovantes_entrega": comprovantes_entrega,
    "financeiro_faturas": faturas,
    "financeiro_contas_receber": contas_receber,
}


def bronze_view(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return EVENT_FIXTURES[table](spark, sf_dir)


# ---- seeds -----------------------------------------------------------------

# Seed catalogues (bronze text). Placeholder names.
SEED_ROWS: dict[str, list[tuple]] = {
    "erp_produtos": [
        ("PROD-001", "Produto 001", "comprimido", "false", "730"),
        ("PROD-002", "Produto 002", "injetavel", "true", "365"),
        ("PROD-003", "Produto 003", "xarope", "false", "180"),
    ],
    "tms_veiculos": [
        ("VEI-001", "PLACA-001", "furgao", "false"),
        ("VEI-002", "PLACA-002", "carreta", "false"),
        ("VEI-003", "PLACA-003", "carreta", "true"),
        ("VEI-004", "PLACA-004", "furgao", "false"),
        ("VEI-005", "PLACA-005", "carreta", "true"),
        ("VEI-006", "PLACA-006", "furgao", "false"),
    ],
    "tms_rotas": [
        ("ROTA-001", "Litoral", "7"),
        ("ROTA-002", "Serra", "20"),
        ("ROTA-003", "Planalto", "31"),
        ("ROTA-004", "Interior", "13"),
    ],
    "financeiro_centros_custo": [
        ("CC-001", "Fábrica"),
        ("CC-002", "Armazéns"),
        ("CC-003", "Frota"),
        ("CC-004", "Vendas"),
    ],
    "crm_representantes": [
        ("REP-001", "Representante 001", "Sudeste"),
        ("REP-002", "Representante 002", "Sul"),
        ("REP-003", "Representante 003", "Nordeste"),
        ("REP-004", "Representante 004", "Centro-Oeste"),
        ("REP-005", "Representante 005", "Norte"),
        ("REP-006", "Representante 006", "Sudeste"),
        ("REP-007", "Representante 007", "Sul"),
        ("REP-008", "Representante 008", "Nordeste"),
    ],
}


def seed_bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Seed as landed text. Customers derive from the driver's customer table.

    The fixed catalogues become a SQL inline table (a local relation planned
    on the JVM, with exact size statistics), not a Python-side RDD.
    """
    spec = SEEDS[name]
    if name == "crm_clientes":
        return clientes(spark, sf_dir)

    def lit(v):
        return "'" + str(v).replace("'", "''") + "'"

    rows = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in SEED_ROWS[name])
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(spec.columns)})")


def clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("c_custkey")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
             .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
             .select(tagged("CLI-", k).alias("cliente_id"),
                     F.col("c_name").alias("nome_cliente"),
                     F.concat(F.lit("contato"), k.cast("string"), F.lit("@cliente.example")).alias("email_contato"),
                     F.col("r_name").alias("regiao"),
                     F.when(k % 20 == 0, F.lit("bloqueado")).otherwise(F.lit("ativo")).alias("status_cliente")))


# ---- run log ---------------------------------------------------------------

# Systems whose daily generation runs are logged in the fixture.
RUN_ITEMS = ("financeiro", "tms", "crm")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log of the daily generation job: one run per order day and system.

    Finance is off on weekends and TMS on Sundays; TMS fails on day 10 and is
    reprocessed on day 11; days 9 and 17 of every third month were never
    logged. Durations vary by day so some runs break the 900 s SLA.
    """
    o = read_table(spark, sf_dir, "orders")
    d = F.col("d")
    days = o.select(F.to_date("o_orderdate").alias("d")).distinct()
    x = days.select("d", F.explode(F.array(*[F.lit(i) for i in RUN_ITEMS])).alias("item"))
    item, dow, dom = F.col("item"), F.weekday(d) + 1, F.dayofmonth(d)
    x = x.where(~((F.month(d) % 3 == 0) & dom.isin(9, 17)))
    status = (F.when((item == "financeiro") & dow.isin(6, 7), F.lit("dia_nao_operacional"))
              .when((item == "tms") & (dow == 7), F.lit("dia_nao_operacional"))
              .when((item == "tms") & (dom == 10), F.lit("falha")).otherwise(F.lit("sucesso")))
    mode = F.when((item == "tms") & (dom == 11), F.lit("reprocessamento")).otherwise(F.lit("diario"))
    idx = F.when(item == "financeiro", 0).when(item == "tms", 1).otherwise(2)
    start = F.unix_date(d).cast("bigint") * 86400 + 21600 + idx * 600
    duration = (F.dayofyear(d) * 37 + idx * 101) % 1000 + 120
    return x.select(
        F.concat(item, F.lit("-"), iso(d)).alias("execucao_id"),
        F.lit("gerar_dados").alias("pipeline"),
        item.alias("item"),
        status.alias("status"),
        F.concat(F.lit('{"modo_execucao":"'), mode, F.lit('"}')).alias("detalhes"),
        iso(d).alias("data_referencia"),
        F.timestamp_seconds(start).alias("started_at"),
        F.timestamp_seconds(start + duration).alias("ended_at"),
    )
