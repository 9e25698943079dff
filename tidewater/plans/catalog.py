"""Named queries: each a function ``(spark, sf_dir) -> DataFrame``, with its oracle.

Every query derives its inputs from the driver's tables (fixture bronze ->
silver -> gold), so its work grows with them. The oracle for each key is a
separately written DuckDB query over the same tables (``tidewater.oracle``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import gold, rules
from ..operators import silver as sv
from ..operators.joins import heavy_hitters
from ..oracle import sql as O
from ..session import prepare
from ..sources import fixtures, layers
from ..spec import EVENT_TABLES, SYSTEM_CALENDARS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = O.with_fixtures(oracle)
        return run
    return deco


def B(spark, d, t):
    return layers.bronze(spark, d, t)


def S(spark, d, t, *columns):
    """Silver rows; with ``columns`` only the key and those, which is all that is compared and shuffled."""
    return layers.silver(spark, d, t, list(columns) or None)


def SEED(spark, d, n):
    return layers.seed(spark, d, n)


def hot_keys(spark, d, table, column):
    """Heavy hitters of a bronze key column: one narrow scan, bounded result."""
    return heavy_hitters(B(spark, d, table).select(column), column)


# ---- cleaners (C1-C13) -------------------------------------------------------

@query("clean_dates", f"""SELECT interacao_id, data_interacao AS data_bruta,
 {O.c_date('data_interacao')} AS data_interacao,
 (NOT {O.nv('data_interacao')} AND {O.c_date('data_interacao')} IS NULL) AS invalida
 FROM bz_crm_atendimento""")
def q_clean_dates(spark, d):
    b = B(spark, d, "crm_atendimento")
    return b.select("interacao_id", F.col("data_interacao").alias("data_bruta"),
                    clean.parse_date("data_interacao").alias("data_interacao"),
                    clean.parse_date_bad("data_interacao").alias("invalida"))


@query("clean_numbers", f"""SELECT item_pedido_id, preco_unitario AS preco_bruto,
 {O.c_money('preco_unitario')} AS preco_unitario, {O.c_int('quantidade')} AS quantidade,
 (NOT {O.nv('preco_unitario')} AND {O.c_money('preco_unitario')} IS NULL) AS invalido
 FROM bz_crm_itens_pedido""")
def q_clean_numbers(spark, d):
    b = B(spark, d, "crm_itens_pedido")
    return b.select("item_pedido_id", F.col("preco_unitario").alias("preco_bruto"),
                    clean.parse_number("preco_unitario").alias("preco_unitario"),
                    clean.parse_integer("quantidade").alias("quantidade"),
                    clean.parse_number_bad("preco_unitario").alias("invalido"))


@query("clean_text", f"""SELECT pedido_id, status_pedido AS status_bruto,
 {O.c_text('status_pedido')} AS status_pedido FROM bz_crm_pedidos""")
def q_clean_text(spark, d):
    b = B(spark, d, "crm_pedidos")
    return b.select("pedido_id", F.col("status_pedido").alias("status_bruto"),
                    clean.clean_text("status_pedido").alias("status_pedido"))


@query("clean_nullable_fk", f"""SELECT interacao_id, lote_id AS lote_bruto,
 {O.c_fk('lote_id')} AS lote_id FROM bz_crm_atendimento""")
def q_clean_nullable_fk(spark, d):
    b = B(spark, d, "crm_atendimento")
    return b.select("interacao_id", F.col("lote_id").alias("lote_bruto"),
                    clean.null_if_variant("lote_id").alias("lote_id"))


@query("clean_boolean", f"""SELECT comprovante_id, pod_confirmado AS pod_bruto,
 {O.c_bool('pod_confirmado')} AS pod_confirmado FROM bz_tms_comprovantes_entrega""")
def q_clean_boolean(spark, d):
    b = B(spark, d, "tms_comprovantes_entrega")
    return b.select("comprovante_id", F.col("pod_confirmado").alias("pod_bruto"),
                    clean.parse_boolean("pod_confirmado").alias("pod_confirmado"))


@query("clean_timestamp", f"""SELECT leitura_id, {O.c_ts('timestamp_leitura')} AS timestamp_leitura,
 {O.c_measure('temperatura_celsius')} AS temperatura_celsius FROM bz_tms_leituras_temperatura""")
def q_clean_timestamp(spark, d):
    b = B(spark, d, "tms_leituras_temperatura")
    return b.select("leitura_id", clean.parse_timestamp("timestamp_leitura").alias("timestamp_leitura"),
                    clean.parse_measure("temperatura_celsius").alias("temperatura_celsius"))


@query("strip_accents", f"""SELECT doc_id, lang,
 translate(text, '{clean.ACCENTED}', '{clean.UNACCENTED}') AS texto_sem_acento FROM documents""")
def q_strip_accents(spark, d):
    docs = fixtures.read_table(spark, d, "documents")
    return docs.select("doc_id", "lang", clean.strip_accents("text").alias("texto_sem_acento"))


@query("format_number_locale", f"""SELECT o_orderkey, {O.num('o_totalprice')} AS valor_formatado,
 {O.c_money(O.num('o_totalprice'))} AS valor_de_volta FROM orders""")
def q_format_number_locale(spark, d):
    o = fixtures.read_table(spark, d, "orders")
    f = clean.format_number_locale("o_totalprice")
    return o.select("o_orderkey", f.alias("valor_formatado"), clean.parse_number(f).alias("valor_de_volta"))


@query("promised_date", """SELECT r.remessa_id, r.rota_id, r.data_expedicao, t.tempo_transito_padrao_horas AS horas,
 CAST(ceil(t.tempo_transito_padrao_horas / 24) AS INTEGER) AS dias_transito,
 CAST(r.data_expedicao + CAST(ceil(t.tempo_transito_padrao_horas / 24) AS INTEGER) AS DATE) AS data_entrega_prometida
 FROM sv_tms_remessas r LEFT JOIN sd_tms_rotas t USING (rota_id)""")
def q_promised_date(spark, d):
    r = S(spark, d, "tms_remessas")
    routes = SEED(spark, d, "tms_rotas")
    j = r.join(routes, "rota_id", "left")
    days = clean.hours_to_days("tempo_transito_padrao_horas")
    return j.select("remessa_id", "rota_id", "data_expedicao",
                    F.col("tempo_transito_padrao_horas").alias("horas"), days.alias("dias_transito"),
                    F.date_add("data_expedicao", days).alias("data_entrega_prometida"))


@query("expiry_check", """SELECT l.lote_id, l.produto_id, l.data_fabricacao, l.data_validade,
 CAST(l.data_fabricacao + CAST(p.validade_padrao_dias AS INTEGER) AS DATE) AS validade_esperada,
 l.data_validade = CAST(l.data_fabricacao + CAST(p.validade_padrao_dias AS INTEGER) AS DATE) AS validade_confere
 FROM sv_erp_lotes_producao l LEFT JOIN sd_erp_produtos p USING (produto_id)""")
def q_expiry_check(spark, d):
    lots = S(spark, d, "erp_lotes_producao")
    prods = SEED(spark, d, "erp_produtos")
    j = lots.join(prods.select("produto_id", "validade_padrao_dias"), "produto_id", "left")
    expected = F.date_add("data_fabricacao", F.col("validade_padrao_dias").cast("int"))
    return j.select("lote_id", "produto_id", "data_fabricacao", "data_validade",
                    expected.alias("validade_esperada"),
                    (F.col("data_validade") == expected).alias("validade_confere"))


# ---- silver (T1-T5, Q2, Q4) --------------------------------------------------

@query("silver_orders", "SELECT * FROM sv_crm_pedidos")
def q_silver_orders(spark, d):
    return S(spark, d, "crm_pedidos")


@query("latest_by_key", "SELECT * FROM sv_crm_itens_pedido")
def q_latest_by_key(spark, d):
    return S(spark, d, "crm_itens_pedido")


@query("duplicate_keys", """SELECT item_pedido_id, count(*) AS linhas FROM bz_crm_itens_pedido
 GROUP BY item_pedido_id HAVING count(*) > 1""")
def q_duplicate_keys(spark, d):
    return sv.duplicate_keys(B(spark, d, "crm_itens_pedido"), "item_pedido_id")


def _quarantine_sql() -> str:
    parts = []
    for t, spec in EVENT_TABLES.items():
        cols = ", ".join(spec.columns + ("data",))
        parts.append(f"SELECT '{t}' AS tabela, {spec.key} AS chave, array_to_string(_m, ',') AS motivos, "
                     f"registro_bruto FROM (SELECT {spec.key}, {O.reasons(spec)} AS _m, "
                     f"CAST(to_json(struct_pack({cols})) AS VARCHAR) AS registro_bruto FROM bz_{t}) WHERE len(_m) > 0")
    return "\nUNION ALL\n".join(parts)


@query("quarantine", _quarantine_sql())
def q_quarantine(spark, d):
    out = None
    for t, spec in EVENT_TABLES.items():
        q = sv.quarantine(B(spark, d, t), spec)
        out = q if out is None else out.unionByName(q)
    return out


# ---- gold (G1-G3, A4, A7, L1) ------------------------------------------------

RECONCILE_SQL = """SELECT f.fatura_id, f.pedido_id, p.valor_total, f.valor_faturado,
 CAST(f.valor_faturado - p.valor_total AS DECIMAL(18,2)) AS divergencia_valor,
 abs(CAST(f.valor_faturado - p.valor_total AS DECIMAL(18,2))) > 0.01 AS divergente, f.data_faturamento
 FROM sv_financeiro_faturas f JOIN sv_crm_pedidos p USING (pedido_id)"""


def reconciliation(spark, d):
    return gold.reconcile_invoices(S(spark, d, "financeiro_faturas", "pedido_id", "valor_faturado", "data_faturamento"), S(spark, d, "crm_pedidos", "valor_total"),
                                   hot_keys(spark, d, "financeiro_faturas", "pedido_id"))


@query("reconcile_invoices", RECONCILE_SQL)
def q_reconcile_invoices(spark, d):
    return reconciliation(spark, d)


@query("reconcile_orphans", """SELECT fatura_id, pedido_id, valor_faturado, data_faturamento
 FROM sv_financeiro_faturas f WHERE NOT EXISTS (SELECT 1 FROM sv_crm_pedidos p WHERE p.pedido_id = f.pedido_id)""")
def q_reconcile_orphans(spark, d):
    return gold.reconcile_orphans(S(spark, d, "financeiro_faturas", "pedido_id", "valor_faturado", "data_faturamento"), S(spark, d, "crm_pedidos", "pedido_id"),
                                  hot_keys(spark, d, "financeiro_faturas", "pedido_id"))


OTIF_SQL = """SELECT c.remessa_id, c.comprovante_id, r.data_entrega_prevista, c.data_entrega_real, c.pod_confirmado,
 CASE WHEN c.pod_confirmado THEN c.data_entrega_real <= r.data_entrega_prevista END AS no_prazo, c.status_entrega
 FROM sv_tms_comprovantes_entrega c JOIN sv_tms_remessas r USING (remessa_id)"""


def otif_df(spark, d):
    return gold.otif(S(spark, d, "tms_comprovantes_entrega"), S(spark, d, "tms_remessas"))


@query("otif", OTIF_SQL)
def q_otif(spark, d):
    return otif_df(spark, d)


@query("otif_rate", f"""SELECT count(*) AS total_entregas, count(*) FILTER (WHERE pod_confirmado) AS confirmadas,
 count(*) FILTER (WHERE no_prazo) AS no_prazo,
 CASE WHEN count(*) FILTER (WHERE pod_confirmado) = 0 THEN NULL ELSE
 CAST(count(*) FILTER (WHERE no_prazo) AS DOUBLE) / count(*) FILTER (WHERE pod_confirmado) END AS taxa_no_prazo
 FROM ({OTIF_SQL})""")
def q_otif_rate(spark, d):
    return gold.otif_rate(otif_df(spark, d))


QUALITY_SQL = """SELECT centro_producao_id, produto_id, count(*) AS total_lotes,
 count(*) FILTER (WHERE status_qc = 'reprovado') AS lotes_reprovados,
 count(*) FILTER (WHERE status_qc = 'reprovado') / count(*) AS taxa_rejeicao
 FROM sv_erp_lotes_producao GROUP BY centro_producao_id, produto_id"""


@query("production_quality", QUALITY_SQL)
def q_production_quality(spark, d):
    return gold.production_quality(S(spark, d, "erp_lotes_producao", "centro_producao_id", "produto_id", "status_qc"))


@query("worst_quality_groups", f"""SELECT * FROM ({QUALITY_SQL})
 ORDER BY taxa_rejeicao DESC, centro_producao_id, produto_id LIMIT 20""")
def q_worst_quality_groups(spark, d):
    return gold.worst_quality_groups(gold.production_quality(S(spark, d, "erp_lotes_producao", "centro_producao_id", "produto_id", "status_qc")))


# ---- audit rules (O1-O3, T8, Q8, K11) -----------------------------------------

COLD_SQL = """SELECT remessa_id, veiculo_id, produto_id, nome_produto, exige_cadeia_fria, refrigerado,
 teve_leitura_fora_faixa,
 CASE WHEN NOT (produto_id IS NOT NULL AND exige_cadeia_fria IS NOT NULL AND refrigerado IS NOT NULL) THEN 'nao_verificavel'
      WHEN NOT exige_cadeia_fria THEN 'nao_aplicavel'
      WHEN NOT refrigerado THEN 'veiculo_incorreto'
      WHEN teve_leitura_fora_faixa THEN 'falha_equipamento'
      ELSE 'conforme' END AS tipo_violacao
 FROM (SELECT r.remessa_id, r.veiculo_id, l.produto_id, p.nome_produto, p.exige_cadeia_fria, v.refrigerado,
   coalesce(f.fora, false) AS teve_leitura_fora_faixa
  FROM sv_tms_remessas r
  LEFT JOIN sv_erp_notas_expedicao n ON n.nota_expedicao_id = r.nota_expedicao_id
  LEFT JOIN sv_erp_lotes_producao l ON l.lote_id = n.lote_id
  LEFT JOIN sd_erp_produtos p ON p.produto_id = l.produto_id
  LEFT JOIN sd_tms_veiculos v ON v.veiculo_id = r.veiculo_id
  LEFT JOIN (SELECT DISTINCT remessa_id, true AS fora FROM sv_tms_leituras_temperatura
             WHERE temperatura_celsius < 2.0 OR temperatura_celsius > 8.0) f ON f.remessa_id = r.remessa_id)"""


def cold_chain_df(spark, d, remessas=None, lotes=None):
    if remessas is None:
        remessas = S(spark, d, "tms_remessas", "nota_expedicao_id", "veiculo_id")
    if lotes is None:
        lotes = S(spark, d, "erp_lotes_producao", "produto_id")
    return rules.cold_chain(remessas, S(spark, d, "erp_notas_expedicao", "lote_id"), lotes, SEED(spark, d, "erp_produtos"),
                            SEED(spark, d, "tms_veiculos"), S(spark, d, "tms_leituras_temperatura", "remessa_id", "temperatura_celsius"),
                            hot_keys(spark, d, "erp_notas_expedicao", "lote_id"))


@query("cold_chain", COLD_SQL)
def q_cold_chain(spark, d):
    return cold_chain_df(spark, d)


@query("violations_by_type", f"""SELECT tipo_violacao, count(*) AS total FROM ({COLD_SQL})
 GROUP BY tipo_violacao ORDER BY total DESC, tipo_violacao""")
def q_violations_by_type(spark, d):
    return rules.violations_by_type(cold_chain_df(spark, d))


@query("cold_chain_rate", f"""SELECT
 count(*) FILTER (WHERE tipo_violacao IN ('veiculo_incorreto', 'falha_equipamento', 'conforme')) AS remessas_aplicaveis,
 count(*) FILTER (WHERE tipo_violacao IN ('veiculo_incorreto', 'falha_equipamento')) AS remessas_violadas,
 CAST(count(*) FILTER (WHERE tipo_violacao IN ('veiculo_incorreto', 'falha_equipamento')) AS DOUBLE)
  / nullif(count(*) FILTER (WHERE tipo_violacao IN ('veiculo_incorreto', 'falha_equipamento', 'conforme')), 0) AS taxa_violacao
 FROM ({COLD_SQL})""")
def q_cold_chain_rate(spark, d):
    return rules.cold_chain_rate(cold_chain_df(spark, d))


SKU_SQL = """SELECT i.item_pedido_id, i.pedido_id, i.produto_id,
 coalesce(i.produto_id IN (SELECT produto_id FROM sd_erp_produtos), false) AS sku_valido
 FROM sv_crm_itens_pedido i"""


@query("sku_validity", SKU_SQL)
def q_sku_validity(spark, d):
    return rules.sku_validity(S(spark, d, "crm_itens_pedido", "pedido_id", "produto_id"), SEED(spark, d, "erp_produtos"))


STOCK_SQL = """SELECT posicao_id, lote_id, centro_distribuicao_id, quantidade, data_posicao,
 quantidade < 0 AS estoque_invalido FROM sv_erp_posicoes_estoque"""


@query("negative_stock", STOCK_SQL)
def q_negative_stock(spark, d):
    return rules.negative_stock(S(spark, d, "erp_posicoes_estoque"))


@query("out_of_range_readings", """SELECT leitura_id, remessa_id, timestamp_leitura, temperatura_celsius
 FROM sv_tms_leituras_temperatura WHERE temperatura_celsius < 2.0 OR temperatura_celsius > 8.0""")
def q_out_of_range_readings(spark, d):
    return rules.out_of_range_readings(S(spark, d, "tms_leituras_temperatura")) \
        .select("leitura_id", "remessa_id", "timestamp_leitura", "temperatura_celsius")


@query("delivery_date_drift", """SELECT c.status_entrega, count(*) AS total,
 count(*) FILTER (WHERE c.data_entrega_real <> r.data_entrega_prevista) AS diferentes,
 count(*) FILTER (WHERE c.data_entrega_real <> r.data_entrega_prevista) / count(*) AS taxa_diferente
 FROM sv_tms_comprovantes_entrega c JOIN sv_tms_remessas r USING (remessa_id) GROUP BY c.status_entrega""")
def q_delivery_date_drift(spark, d):
    return rules.delivery_date_drift(S(spark, d, "tms_comprovantes_entrega", "remessa_id", "status_entrega", "data_entrega_real"), S(spark, d, "tms_remessas", "data_entrega_prevista"))


GOLD_SUMMARY_SQL = f"""
SELECT 'gold_reconciliacao_financeira' AS tabela, count(*) AS total_linhas, count(*) FILTER (WHERE divergente) AS sinalizadas,
 CAST(count(*) FILTER (WHERE divergente) AS DOUBLE) / nullif(count(*), 0) AS taxa FROM ({RECONCILE_SQL})
UNION ALL
SELECT 'gold_otif', count(*), count(*) FILTER (WHERE no_prazo),
 CAST(count(*) FILTER (WHERE no_prazo) AS DOUBLE) / nullif(count(*) FILTER (WHERE pod_confirmado), 0) FROM ({OTIF_SQL})
UNION ALL
SELECT 'gold_qualidade_producao', count(*), CAST(coalesce(sum(lotes_reprovados), 0) AS BIGINT),
 CAST(sum(lotes_reprovados) AS DOUBLE) / nullif(sum(total_lotes), 0) FROM ({QUALITY_SQL})
UNION ALL
SELECT 'observability_cadeia_fria', count(*), count(*) FILTER (WHERE tipo_violacao IN ('veiculo_incorreto', 'falha_equipamento')),
 CAST(count(*) FILTER (WHERE tipo_violacao IN ('veiculo_incorreto', 'falha_equipamento')) AS DOUBLE)
 / nullif(count(*) FILTER (WHERE tipo_violacao IN ('veiculo_incorreto', 'falha_equipamento', 'conforme')), 0) FROM ({COLD_SQL})
UNION ALL
SELECT 'observability_qualidade_sku', count(*), count(*) FILTER (WHERE NOT sku_valido),
 CAST(count(*) FILTER (WHERE NOT sku_valido) AS DOUBLE) / nullif(count(*), 0) FROM ({SKU_SQL})
UNION ALL
SELECT 'observability_estoque_negativo', count(*), count(*) FILTER (WHERE estoque_invalido),
 CAST(count(*) FILTER (WHERE estoque_invalido) AS DOUBLE) / nullif(count(*), 0) FROM ({STOCK_SQL})"""


@query("gold_summary", GOLD_SUMMARY_SQL)
def q_gold_summary(spark, d):
    return gold_summary_df(spark, d)


def gold_summary_df(spark, d):
    # Tables that two KPIs read are cleaned and shuffled once, with the columns of both.
    remessas = S(spark, d, "tms_remessas", "nota_expedicao_id", "veiculo_id", "data_entrega_prevista")
    lotes = S(spark, d, "erp_lotes_producao", "centro_producao_id", "produto_id", "status_qc")
    return gold.gold_summary(reconciliation(spark, d), gold.otif(S(spark, d, "tms_comprovantes_entrega"), remessas),
                             gold.production_quality(lotes), cold_chain_df(spark, d, remessas, lotes),
                             rules.sku_validity(S(spark, d, "crm_itens_pedido", "pedido_id", "produto_id"), SEED(spark, d, "erp_produtos")),
                             rules.negative_stock(S(spark, d, "erp_posicoes_estoque")))


@query("kpi_plausibility", """SELECT tabela, taxa, CASE WHEN taxa IS NULL THEN 'sem_dado' WHEN taxa = 0 THEN 'zero_suspeito'
 WHEN taxa = 1 THEN 'cem_suspeito' ELSE 'plausivel' END AS veredito FROM (""" + GOLD_SUMMARY_SQL + ")")
def q_kpi_plausibility(spark, d):
    return rules.kpi_plausibility(gold_summary_df(spark, d))


# ---- run log, calendar, completeness, close (R, M, K17, V3, V5, L3) ---------

from ..functions import calendar as cal  # noqa: E402
from ..operators import alerts as al  # noqa: E402
from ..operators import close as cl  # noqa: E402
from ..operators import runs as rn  # noqa: E402


def RUNS(spark, d):
    return fixtures.runs(spark, d)


@query("business_days", f"SELECT strftime(mes, '%Y-%m') AS mes_referencia, count(*) AS dias_uteis FROM ({O.BUSINESS_DAYS}) GROUP BY mes")
def q_business_days(spark, d):
    months = cl.closable_months(RUNS(spark, d))
    return (cl.business_days(months).groupBy(cal.month_label("mes").alias("mes_referencia"))
              .agg(F.count(F.lit(1)).alias("dias_uteis")))


@query("missing_run_days", f"SELECT strftime(mes, '%Y-%m') AS mes_referencia, dia FROM ({O.MISSING_DAYS})")
def q_missing_run_days(spark, d):
    runs = RUNS(spark, d)
    return cl.missing_run_days(runs, cl.closable_months(runs)) \
        .select(cal.month_label("mes").alias("mes_referencia"), "dia")


CLOSE_SYSTEMS = ("financeiro", "tms", "crm")


def _lacking(s):
    return (f"(SELECT count(*) FROM (SELECT {O.days_sql('m.mes', 'last_day(m.mes)')} AS dia) WHERE {O.operates_sql(repr(s), 'dia')} "
            f"AND dia NOT IN (SELECT CAST(data_referencia AS DATE) FROM bz_runs WHERE pipeline = 'gerar_dados' AND item = '{s}' AND status = 'sucesso'))")


MONTHLY_CLOSE_SQL = f"""SELECT strftime(m.mes, '%Y-%m') AS mes_referencia,
 CAST(coalesce(t.fat, 0) AS DECIMAL(18,2)) AS total_faturado, CAST(coalesce(t.rec, 0) AS DECIMAL(18,2)) AS total_recebido,
 CAST(coalesce(t.fat, 0) - coalesce(t.rec, 0) AS DECIMAL(18,2)) AS total_em_aberto,
 coalesce(t.n, 0) AS total_faturas, coalesce(t.ndiv, 0) AS total_divergentes,
 CAST(to_json(coalesce(x.faltando, CAST([] AS VARCHAR[]))) AS VARCHAR) AS dias_faltando,
 CAST(json_object({', '.join(f"'{s}', m.{s}" for s in CLOSE_SYSTEMS)}) AS VARCHAR) AS por_sistema,
 {' + '.join(f'm.{s}' for s in CLOSE_SYSTEMS)} = 0 AS fechamento_valido
 FROM (SELECT m.mes, {', '.join(f'{_lacking(s)} AS {s}' for s in CLOSE_SYSTEMS)} FROM ({O.FIN_MONTHS}) m) m
 LEFT JOIN (SELECT CAST(date_trunc('month', r.data_faturamento) AS DATE) AS mes, sum(r.valor_faturado) AS fat,
     sum(CASE WHEN p.recebido THEN r.valor_faturado END) AS rec, count(*) AS n, count(*) FILTER (WHERE r.divergente) AS ndiv
   FROM ({RECONCILE_SQL}) r
   LEFT JOIN (SELECT fatura_id, max(status_conta = 'recebido') AS recebido FROM sv_financeiro_contas_receber GROUP BY fatura_id) p
   USING (fatura_id) GROUP BY 1) t ON t.mes = m.mes
 LEFT JOIN (SELECT mes, list_sort(list(strftime(dia, '%Y-%m-%d'))) AS faltando FROM ({O.MISSING_DAYS}) GROUP BY mes) x
   ON x.mes = m.mes"""


def monthly_close_df(spark, d):
    return cl.monthly_close(reconciliation(spark, d), S(spark, d, "financeiro_contas_receber"), RUNS(spark, d), CLOSE_SYSTEMS)


@query("monthly_close", MONTHLY_CLOSE_SQL)
def q_monthly_close(spark, d):
    return monthly_close_df(spark, d)


# Month-based alerts are dated at the first instant after their month.
MONTH_END_SQL = "CAST(CAST({m} || '-01' AS DATE) + INTERVAL 1 MONTH AS TIMESTAMP)"


def _alert_sql(tipo, origem, sev, periodo, msg, det, src, quando):
    return (f"SELECT sha256('{tipo}' || '|' || '{origem}' || '|' || {periodo}) AS alerta_id, '{tipo}' AS tipo_evento, "
            f"'{origem}' AS origem, '{sev}' AS severidade, {periodo} AS periodo, {msg} AS mensagem, "
            f"CAST({det} AS VARCHAR) AS detalhes, {quando} AS timestamp_alerta FROM ({src})")


CLOSE_ALERTS_SQL = _alert_sql(
    "fechamento_invalido", "fechar_mes", "alta", "mes_referencia",
    "'Mês ' || mes_referencia || ' não pode ser fechado: faltam execuções de ' || CAST((" + ' + '.join(f"CAST(json_extract(por_sistema, '$.{x}') AS BIGINT)" for x in CLOSE_SYSTEMS) + ") AS VARCHAR) || ' dia(s)'",
    "json_object('mes_referencia', mes_referencia, 'dias_faltando', CAST(dias_faltando AS JSON), 'por_sistema', CAST(por_sistema AS JSON))",
    f"SELECT * FROM ({MONTHLY_CLOSE_SQL}) WHERE NOT fechamento_valido", MONTH_END_SQL.format(m="mes_referencia"))


@query("close_alerts", CLOSE_ALERTS_SQL)
def q_close_alerts(spark, d):
    return cl.close_alerts(monthly_close_df(spark, d))


RUN_STATUS_ITEMS = tuple(SYSTEM_CALENDARS)


@query("run_day_status", f"""SELECT g.sistema, g.dia, {O.operates_sql('g.sistema', 'g.dia')} AS dia_operacional,
 CASE WHEN b.rk IS NOT NULL THEN (CASE b.rk WHEN 3 THEN 'sucesso' WHEN 2 THEN 'dia_nao_operacional' WHEN 1 THEN 'falha' ELSE 'outro' END)
      WHEN {O.operates_sql('g.sistema', 'g.dia')} THEN 'ausente' ELSE 'dia_nao_operacional' END AS situacao
 FROM (SELECT dia, sistema FROM (SELECT {O.days_sql('min(CAST(data_referencia AS DATE))', 'max(CAST(data_referencia AS DATE))')} AS dia
        FROM bz_runs WHERE pipeline = 'gerar_dados'), (VALUES {', '.join(f"('{s}')" for s in RUN_STATUS_ITEMS)}) s(sistema)) g
 LEFT JOIN (SELECT item AS sistema, CAST(data_referencia AS DATE) AS dia,
   max(CASE status WHEN 'sucesso' THEN 3 WHEN 'dia_nao_operacional' THEN 2 WHEN 'falha' THEN 1 ELSE 0 END) AS rk
   FROM bz_runs WHERE pipeline = 'gerar_dados' GROUP BY 1, 2) b ON b.sistema = g.sistema AND b.dia = g.dia""")
def q_run_day_status(spark, d):
    return rn.run_day_status(RUNS(spark, d), RUN_STATUS_ITEMS)


def evidence_df(spark, d):
    """Days with landed files per system, from every event table's partition."""
    out = None
    for t, spec in EVENT_TABLES.items():
        e = B(spark, d, t).select(F.lit(spec.system).alias("sistema"), F.to_date("data").alias("dia")).distinct()
        out = e if out is None else out.unionByName(e)
    return out


EVIDENCE_SQL = " UNION ".join(
    f"SELECT DISTINCT '{spec.system}' AS sistema, CAST(data AS DATE) AS dia FROM bz_{t}" for t, spec in EVENT_TABLES.items())


@query("rebuild_run_log", f"""SELECT g.sistema || '-' || strftime(g.dia, '%Y-%m-%d') AS execucao_id, 'gerar_dados' AS pipeline,
 g.sistema AS item, st AS status,
 CAST(json_object('sistema', g.sistema, 'data_referencia', strftime(g.dia, '%Y-%m-%d'), 'status', st,
   'reconstrucao_retroativa', true) AS VARCHAR) AS detalhes, strftime(g.dia, '%Y-%m-%d') AS data_referencia
 FROM (SELECT g.*, CASE WHEN e.sistema IS NOT NULL THEN 'sucesso' WHEN NOT {O.operates_sql('g.sistema', 'g.dia')}
   THEN 'dia_nao_operacional' ELSE 'sem_evidencia' END AS st
  FROM (SELECT dia, sistema FROM (SELECT {O.days_sql('min(dia)', 'max(dia)')} AS dia FROM ({EVIDENCE_SQL})),
        (VALUES {', '.join(f"('{s}')" for s in SYSTEM_CALENDARS)}) s(sistema)) g
  LEFT JOIN (SELECT DISTINCT sistema, dia FROM ({EVIDENCE_SQL})) e ON e.sistema = g.sistema AND e.dia = g.dia) g""")
def q_rebuild_run_log(spark, d):
    return rn.rebuild_run_log(evidence_df(spark, d))


@query("calendar_reconciliation", f"""SELECT g.sistema, count(*) FILTER (WHERE e.dia IS NOT NULL) AS dias_com_arquivo,
 count(*) FILTER (WHERE {O.operates_sql('g.sistema', 'g.dia')}) AS dias_esperados,
 count(*) FILTER (WHERE e.dia IS NOT NULL AND NOT {O.operates_sql('g.sistema', 'g.dia')}) AS dias_fora_calendario,
 count(*) FILTER (WHERE e.dia IS NULL AND {O.operates_sql('g.sistema', 'g.dia')}) AS dias_faltando
 FROM (SELECT sistema, {O.days_sql('min(dia)', 'max(dia)')} AS dia FROM ({EVIDENCE_SQL}) GROUP BY sistema) g
 LEFT JOIN (SELECT DISTINCT sistema, dia FROM ({EVIDENCE_SQL})) e ON e.sistema = g.sistema AND e.dia = g.dia
 GROUP BY g.sistema""")
def q_calendar_reconciliation(spark, d):
    return rn.calendar_reconciliation(evidence_df(spark, d))


@query("partition_day_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS tabela, count(DISTINCT data) AS dias_particao, count(*) AS linhas FROM bz_{t}" for t in EVENT_TABLES))
def q_partition_day_counts(spark, d):
    out = None
    for t in EVENT_TABLES:
        p = B(spark, d, t).agg(F.lit(t).alias("tabela"), F.count_distinct("data").alias("dias_particao"),
                               F.count(F.lit(1)).alias("linhas"))
        out = p if out is None else out.unionByName(p)
    return out


RUN_SECONDS = "(epoch(ended_at) - epoch(started_at))"


@query("run_sla_breach", f"""SELECT execucao_id, pipeline, item, data_referencia, ended_at, CAST({RUN_SECONDS} AS BIGINT) AS duracao_segundos
 FROM bz_runs WHERE {RUN_SECONDS} > 900""")
def q_run_sla_breach(spark, d):
    return rn.run_sla_breach(RUNS(spark, d))


@query("runs_by_status", "SELECT pipeline, status, count(*) AS execucoes FROM bz_runs GROUP BY ALL")
def q_runs_by_status(spark, d):
    return rn.runs_by_status(RUNS(spark, d))


@query("runs_by_mode", """SELECT coalesce(json_extract_string(detalhes, '$.modo_execucao'), 'desconhecido') AS modo_execucao,
 count(*) AS execucoes FROM bz_runs GROUP BY 1""")
def q_runs_by_mode(spark, d):
    return rn.runs_by_mode(RUNS(spark, d))


@query("latest_runs", """SELECT * FROM bz_runs WHERE pipeline = 'gerar_dados' AND item = 'tms'
 ORDER BY started_at DESC, execucao_id DESC LIMIT 10""")
def q_latest_runs(spark, d):
    return rn.latest_runs(RUNS(spark, d), "gerar_dados", "tms")


RUN_LOG_DAY = "(SELECT max(data_referencia) FROM bz_runs)"
RUN_LOG_START, RUN_LOG_END = "(SELECT max(started_at) FROM bz_runs)", "(SELECT max(ended_at) FROM bz_runs)"


@query("run_log", f"""SELECT sha256('construir_gold|' || tabela || '|' || {RUN_LOG_DAY} || '|' || strftime({RUN_LOG_START}, '%Y-%m-%d %H:%M:%S')) AS execucao_id,
 'construir_gold' AS pipeline, tabela AS item, 'sucesso' AS status,
 CAST(json_object('total_linhas', total_linhas, 'sinalizadas', sinalizadas) AS VARCHAR) AS detalhes,
 {RUN_LOG_DAY} AS data_referencia, {RUN_LOG_START} AS started_at, {RUN_LOG_END} AS ended_at FROM ({GOLD_SUMMARY_SQL})""")
def q_run_log(spark, d):
    """Records of a gold build as part of the last logged day's run: its day and start make the ids."""
    last = RUNS(spark, d).agg(F.max("data_referencia").alias("dia"), F.max("started_at").alias("ini"), F.max("ended_at").alias("fim")).first()
    s = gold_summary_df(spark, d).select(F.col("tabela").alias("item"), F.lit("sucesso").alias("status"),
                                         "total_linhas", "sinalizadas", F.lit(last["dia"]).alias("data_referencia"))
    return rn.run_records(s, "construir_gold", F.lit(last["dia"]), F.lit(last["ini"]), F.lit(last["fim"]))


# ---- alerts (R2-R4, M6, V1, T10) ----------------------------------------------

COLD_ALERT_SQL = _alert_sql(
    "cadeia_fria", "observability_cadeia_fria", "alta", "'total'",
    "'Cadeia fria: remessas em veículo sem refrigeração: ' || CAST(n AS VARCHAR)",
    "json_object('total_violacoes', n)",
    f"SELECT count(*) FILTER (WHERE tipo_violacao = 'veiculo_incorreto') AS n FROM ({COLD_SQL}) HAVING n > 0",
    "(SELECT max(ended_at) FROM bz_runs)")

RECON_ALERT_SQL = _alert_sql(
    "reconciliacao", "gold_reconciliacao_financeira", "media", "mes",
    "CAST(n AS VARCHAR) || ' de ' || CAST(total AS VARCHAR) || ' faturas divergentes em ' || mes",
    "json_object('mes_referencia', mes, 'divergentes', n, 'total_faturas', total)",
    f"""SELECT strftime(data_faturamento, '%Y-%m') AS mes, count(*) FILTER (WHERE divergente) AS n, count(*) AS total
        FROM ({RECONCILE_SQL}) GROUP BY 1 HAVING count(*) FILTER (WHERE divergente) > 0""",
    MONTH_END_SQL.format(m="mes"))

SLA_ALERT_SQL = _alert_sql(
    "sla_execucao", "pipeline_runs", "media", "(pipeline || '|' || item || '|' || data_referencia)",
    "pipeline || '/' || item || ' levou ' || CAST(duracao_segundos AS VARCHAR) || ' s em ' || data_referencia",
    "json_object('execucao_id', execucao_id, 'duracao_segundos', duracao_segundos)",
    f"""SELECT execucao_id, pipeline, item, data_referencia, ended_at, CAST({RUN_SECONDS} AS BIGINT) AS duracao_segundos
        FROM bz_runs WHERE {RUN_SECONDS} > 900""", "ended_at")

ALERTS_SQL = " UNION ALL ".join(f"SELECT * FROM ({s})" for s in
                                (COLD_ALERT_SQL, RECON_ALERT_SQL, SLA_ALERT_SQL, CLOSE_ALERTS_SQL))


def cold_alerts_df(spark, d):
    """Cold-chain alerts dated at the end of the last logged run."""
    last = RUNS(spark, d).agg(F.max("ended_at").alias("m")).first()["m"]
    return al.cold_chain_alerts(cold_chain_df(spark, d), F.lit(last))


def alerts_df(spark, d):
    """All four families; the reconciliation is built once and read twice, as the daily job does."""
    rec = tb.materialize(spark, reconciliation(spark, d), "alerts-reconciliation")
    close = cl.monthly_close(rec, S(spark, d, "financeiro_contas_receber"), RUNS(spark, d), CLOSE_SYSTEMS)
    return al.all_alerts(cold_alerts_df(spark, d), al.reconciliation_alerts(rec),
                         al.run_sla_alerts(rn.run_sla_breach(RUNS(spark, d))), cl.close_alerts(close))


@query("cold_chain_alerts", COLD_ALERT_SQL)
def q_cold_chain_alerts(spark, d):
    return cold_alerts_df(spark, d)


@query("alerts", ALERTS_SQL)
def q_alerts(spark, d):
    return alerts_df(spark, d)


@query("recent_alerts", f"SELECT * FROM ({ALERTS_SQL}) ORDER BY timestamp_alerta DESC, alerta_id ASC LIMIT 10")
def q_recent_alerts(spark, d):
    return al.recent_alerts(alerts_df(spark, d))


@query("alerts_by_type", f"SELECT * FROM ({ALERTS_SQL}) WHERE tipo_evento = 'fechamento_invalido'")
def q_alerts_by_type(spark, d):
    return alerts_df(spark, d).filter("tipo_evento = 'fechamento_invalido'")


@query("billed_by_day", f"""SELECT data_faturamento, faturado_dia,
 sum(faturado_dia) OVER (ORDER BY data_faturamento ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS faturado_acumulado
 FROM (SELECT data_faturamento, sum(valor_faturado) AS faturado_dia FROM ({RECONCILE_SQL}) GROUP BY 1)""")
def q_billed_by_day(spark, d):
    from pyspark.sql import Window

    daily = reconciliation(spark, d).groupBy("data_faturamento").agg(F.sum("valor_faturado").alias("faturado_dia"))
    # One row per day: the running total's single-partition window is bounded by the number of days.
    w = Window.orderBy("data_faturamento").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("faturado_acumulado", F.sum("faturado_dia").over(w))


# ---- sources, streaming, sinks (S1-S15, T2, T4, Q3, M5, P1-P3) ---------------

from ..operators import retention as rt  # noqa: E402
from ..session import fresh_path  # noqa: E402
from ..sources import landing as ld  # noqa: E402
from ..sources import tables as tb  # noqa: E402
from ..spec import SEEDS  # noqa: E402
from ..streaming import ingest as ig  # noqa: E402
from . import daily  # noqa: E402

NOTAS, POSICOES = "erp_notas_expedicao", "erp_posicoes_estoque"


def _landed(spark, d, tables_):
    """A fresh landing zone holding the given fixture tables (by their system)."""
    root = fresh_path(spark, "landing")
    paths = ig.IngestPaths(f"{root}/landing", f"{root}/bronze", f"{root}/checkpoints")
    _land(spark, d, tables_, paths.landing)
    return paths


def _land(spark, d, tables_, landing):
    """Systems land side by side; the tables of one share its day folders and land one after the other."""
    from concurrent.futures import ThreadPoolExecutor

    def land(system):
        for t in tables_:
            if EVENT_TABLES[t].system == system:
                ld.write_landing(spark, B(spark, d, t), landing, system, t)

    with ThreadPoolExecutor(len(SYSTEM_CALENDARS)) as pool:
        list(pool.map(land, sorted({EVENT_TABLES[t].system for t in tables_})))


@query("bronze_ingest", f"SELECT {', '.join(EVENT_TABLES[NOTAS].columns)}, data FROM bz_{NOTAS}")
def q_bronze_ingest(spark, d):
    """Stream one table out of a shared system folder into bronze (all text)."""
    paths = _landed(spark, d, [NOTAS, POSICOES])
    ig.ingest_table(spark, paths, NOTAS)
    return ig.read_bronze(spark, paths, NOTAS).select(*EVENT_TABLES[NOTAS].columns, "data")


@query("ingest_metrics", f"""SELECT 1 AS execucao, '{NOTAS}' AS tabela, 'sucesso' AS status,
 count(DISTINCT data) AS arquivos_processados, count(*) AS linhas_processadas FROM bz_{NOTAS}
 UNION ALL SELECT 2, '{NOTAS}', 'sem_dado_novo', 0, 0""")
def q_ingest_metrics(spark, d):
    """Run the stream twice: the second run finds nothing new."""
    paths = _landed(spark, d, [NOTAS, POSICOES])
    first, second = ig.ingest_table(spark, paths, NOTAS), ig.ingest_table(spark, paths, NOTAS)
    one, two = ig.ingest_metrics(spark, [first]), ig.ingest_metrics(spark, [second])
    return one.select(F.lit(1).alias("execucao"), "*").unionByName(two.select(F.lit(2).alias("execucao"), "*"))


@query("seed_promote", "SELECT * FROM sd_crm_clientes")
def q_seed_promote(spark, d):
    """Seed to landing _seed folder, batch read as text, bronze copy, typed silver."""
    root = fresh_path(spark, "seeds")
    spec = SEEDS["crm_clientes"]
    ld.write_seed(spark, fixtures.seed_bronze(spark, d, "crm_clientes"), f"{root}/landing", spec.system, spec.name)
    raw = spark.read.schema(ld.bronze_schema(spec.columns)).json(
        f"{root}/landing/{spec.system}/{ld.SEED_DIR}/{spec.name}.json").drop("data")
    tb.overwrite(sv.bronze_copy(raw), f"{root}/bronze/{spec.name}")
    tb.overwrite(sv.promote_seed(spark.read.parquet(f"{root}/bronze/{spec.name}"), spec), f"{root}/silver/{spec.name}")
    return spark.read.parquet(f"{root}/silver/{spec.name}")


@query("read_or_empty", """SELECT 'orders' AS fonte, count(*) AS linhas FROM orders
 UNION ALL SELECT 'financeiro_faturas_ausente', 0""")
def q_read_or_empty(spark, d):
    """A same-day cross-system read of a file that does not exist is empty, not an error."""
    from pyspark.sql import types as T

    present = tb.read_or_empty(spark, f"{d}/orders.parquet", fixtures.read_table(spark, d, "orders").schema, "parquet")
    missing = tb.read_or_empty(spark, f"{d}/financeiro_faturas_ausente.json",
                               T.StructType([T.StructField("fatura_id", T.StringType())]))
    return (present.agg(F.lit("orders").alias("fonte"), F.count(F.lit(1)).alias("linhas"))
            .unionByName(missing.agg(F.lit("financeiro_faturas_ausente").alias("fonte"),
                                     F.count(F.lit(1)).alias("linhas"))))


RETENTION_DAYS, RETENTION_REF = 30, "2000-01-01"
#: A table of every system, ingested; the stock positions land too, but have not been ingested.
RETENTION_TABLES = ("erp_lotes_producao", NOTAS, "crm_pedidos", "tms_remessas", "financeiro_faturas")


@query("retention_plan", f"""SELECT sistema, 'data=' || data AS particao, CAST(data AS DATE) AS dia,
 CAST(DATE '{RETENTION_REF}' - INTERVAL {RETENTION_DAYS} DAY AS DATE) AS data_corte, count(*) AS arquivos,
 count(*) FILTER (WHERE t = 'p') AS arquivos_nao_ingeridos,
 CASE WHEN CAST(data AS DATE) >= CAST(DATE '{RETENTION_REF}' - INTERVAL {RETENTION_DAYS} DAY AS DATE) THEN 'manter'
      WHEN count(*) FILTER (WHERE t = 'p') > 0 THEN 'bloqueado_nao_ingerido' ELSE 'remover' END AS acao
 FROM ({' UNION ALL '.join(f"SELECT DISTINCT '{EVENT_TABLES[t].system}' AS sistema, data, '{'p' if t == POSICOES else 'n'}' AS t FROM bz_{t}"
                           for t in (*RETENTION_TABLES, POSICOES))})
 GROUP BY sistema, data""")
def q_retention_plan(spark, d):
    """All five systems. Stock positions landed but never ingested: their days must not be deleted."""
    paths = _landed(spark, d, [*RETENTION_TABLES, POSICOES])
    ig.ingest_tables(spark, paths, list(RETENTION_TABLES))
    files = rt.landing_files(spark, paths.landing, tuple(SYSTEM_CALENDARS))
    return rt.retention_plan(files, ig.file_ledger(spark, paths), RETENTION_DAYS, RETENTION_REF)


UPSERT_RESULT_SQL = """SELECT pedido_id, cliente_id, representante_id, data_pedido,
 CASE WHEN status_pedido = 'cancelado' THEN CAST(0 AS DECIMAL(18,2)) ELSE valor_total END AS valor_total,
 status_pedido, data_particao_ingestao FROM sv_crm_pedidos"""


def _order_increment(silver_orders):
    """Day-2 feed: open orders arrive (inserts), cancelled ones are re-sent at zero (updates)."""
    st = F.col("status_pedido")
    return (silver_orders.where(st.isin("aberto", "cancelado"))
            .withColumn("valor_total", F.when(st == "cancelado", F.lit(0).cast("decimal(18,2)"))
                        .otherwise(F.col("valor_total"))))


@query("silver_upsert", UPSERT_RESULT_SQL)
def q_silver_upsert(spark, d):
    path = fresh_path(spark, "silver-crm_pedidos")
    orders = tb.materialize(spark, S(spark, d, "crm_pedidos"), "orders-silver")
    tb.upsert(spark, orders.where(F.col("status_pedido") != "aberto"), path, "pedido_id")
    tb.upsert(spark, _order_increment(orders), path, "pedido_id")
    return tb.read_table(spark, path)


@query("upsert_twice", f"""SELECT e AS execucao, count(*) AS total_linhas, sum(valor_total) AS soma_valor
 FROM ({UPSERT_RESULT_SQL}), (VALUES (1), (2)) x(e) GROUP BY e""")
def q_upsert_twice(spark, d):
    """Applying the same increment twice leaves the table unchanged."""
    path = fresh_path(spark, "silver-crm_pedidos")
    orders = tb.materialize(spark, S(spark, d, "crm_pedidos"), "orders-silver")
    tb.upsert(spark, orders.where(F.col("status_pedido") != "aberto"), path, "pedido_id")
    out = []
    for run in (1, 2):
        tb.upsert(spark, _order_increment(orders), path, "pedido_id")
        totals = tb.read_table(spark, path).agg(F.lit(run).alias("execucao"), F.count(F.lit(1)).alias("total_linhas"),
                                                F.sum("valor_total").alias("soma_valor"))
        out.append(tb.materialize(spark, totals, f"upsert-run{run}"))
    return out[0].unionByName(out[1])


@query("monthly_close_upsert", MONTHLY_CLOSE_SQL)
def q_monthly_close_upsert(spark, d):
    """Close the early months, then re-close everything: merge by month, no duplicates."""
    path = fresh_path(spark, "gold_fechamento_mensal")
    close = tb.materialize(spark, monthly_close_df(spark, d), "close")
    tb.upsert(spark, close.where(F.col("mes_referencia") <= "1998-12"), path, "mes_referencia", buckets=8)
    tb.upsert(spark, close, path, "mes_referencia", buckets=8)
    return tb.read_table(spark, path)


BACKFILL_START, BACKFILL_END = "1996-01-01", "1996-12-31"
BACKFILL_TABLES = {"crm": ["crm_pedidos"], "financeiro": ["financeiro_faturas"]}


@query("backfill_range", " UNION ALL ".join(
    f"SELECT '{t}' AS tabela, count(*) AS linhas, count(DISTINCT data_particao_ingestao) AS dias FROM sv_{t}"
    for ts in BACKFILL_TABLES.values() for t in ts))
def q_backfill_range(spark, d):
    """Streamed bronze, then a window of landed days loaded again: silver holds every row once."""
    root = fresh_path(spark, "backfill")
    paths = daily.JobPaths(f"{root}/landing", root)
    names = [t for ts in BACKFILL_TABLES.values() for t in ts]
    _land(spark, d, names, paths.landing)
    ig.ingest_tables(spark, paths.ingest, names)
    daily.backfill_range(spark, paths.ingest, BACKFILL_START, BACKFILL_END, BACKFILL_TABLES)
    out = None
    for t in names:
        daily.silver_refresh(spark, paths, t)
        b = daily.read_silver(spark, paths, t).agg(
            F.lit(t).alias("tabela"), F.count(F.lit(1)).alias("linhas"), F.count_distinct("data_particao_ingestao").alias("dias"))
        out = b if out is None else out.unionByName(b)
    return out


REPROCESS_DAY = "1996-06-14"
_PED = EVENT_TABLES["crm_pedidos"]
_CORRECTED = ", ".join(c if c != "valor_total" else f"CASE WHEN data = '{REPROCESS_DAY}' THEN '1,00' ELSE valor_total END AS valor_total"
                       for c in _PED.columns)


@query("reprocess_day", O.silver_sql(_PED, f"(SELECT {_CORRECTED}, data FROM bz_crm_pedidos)"))
def q_reprocess_day(spark, d):
    """A corrected file replaces one landed day of streamed bronze; silver follows."""
    root = fresh_path(spark, "reprocess")
    paths = daily.JobPaths(f"{root}/landing", root)
    _land(spark, d, ["crm_pedidos"], paths.landing)
    ig.ingest_table(spark, paths.ingest, "crm_pedidos")
    daily.silver_refresh(spark, paths, "crm_pedidos")
    fixed = B(spark, d, "crm_pedidos").where(F.col("data") == REPROCESS_DAY).withColumn("valor_total", F.lit("1,00"))
    tb.remove(spark, f"{ld.system_dir(paths.landing, 'crm')}/data={REPROCESS_DAY}")
    ld.write_landing(spark, fixed, paths.landing, "crm", "crm_pedidos")
    daily.reprocess_day(spark, paths.ingest, "crm_pedidos", REPROCESS_DAY)
    daily.silver_refresh(spark, paths, "crm_pedidos")
    return daily.read_silver(spark, paths, "crm_pedidos")


# ---- documented KPIs and rules (K1-K16, J7, J9) --------------------------------

from ..operators import kpis as kp  # noqa: E402
from ..operators import quality as qa  # noqa: E402


def hot_lots(spark, d):
    return hot_keys(spark, d, "erp_notas_expedicao", "lote_id")


@query("dso", """SELECT strftime(f.data_faturamento, '%Y-%m') AS mes,
 round(avg(CASE WHEN c.status_conta = 'recebido' AND c.data_recebimento IS NOT NULL
   THEN datediff('day', f.data_faturamento, c.data_recebimento) END), 4) AS dso_dias,
 count(*) FILTER (WHERE c.status_conta = 'recebido' AND c.data_recebimento IS NOT NULL) AS faturas_recebidas,
 count(*) FILTER (WHERE NOT coalesce(c.status_conta = 'recebido' AND c.data_recebimento IS NOT NULL, false)) AS faturas_em_aberto
 FROM sv_financeiro_contas_receber c JOIN sv_financeiro_faturas f USING (fatura_id) GROUP BY 1""")
def q_dso(spark, d):
    return kp.dso(S(spark, d, "financeiro_faturas", "data_faturamento"), S(spark, d, "financeiro_contas_receber", "fatura_id", "data_recebimento", "status_conta"))


@query("reconciled_pct", f"""SELECT strftime(data_faturamento, '%Y-%m') AS mes, count(*) AS faturas,
 count(*) FILTER (WHERE NOT divergente) AS sem_divergencia, count(*) FILTER (WHERE divergente IS NULL) AS sem_veredito,
 round(avg(CAST(NOT divergente AS DOUBLE)), 6) AS pct_conciliado FROM ({RECONCILE_SQL}) GROUP BY 1""")
def q_reconciled_pct(spark, d):
    return kp.reconciled_pct(reconciliation(spark, d))


@query("missing_cost_center", """SELECT fatura_id, centro_custo_id,
 CASE WHEN centro_custo_id IS NULL THEN 'sem_centro'
      WHEN centro_custo_id NOT IN (SELECT centro_custo_id FROM sd_financeiro_centros_custo) THEN 'centro_desconhecido'
      ELSE 'ok' END AS situacao FROM sv_financeiro_faturas""")
def q_missing_cost_center(spark, d):
    return kp.missing_cost_center(S(spark, d, "financeiro_faturas"), SEED(spark, d, "financeiro_centros_custo"))


@query("delivery_without_pod", """SELECT comprovante_id, remessa_id, status_entrega, data_entrega_real
 FROM sv_tms_comprovantes_entrega WHERE pod_confirmado IS NULL""")
def q_delivery_without_pod(spark, d):
    return kp.delivery_without_pod(S(spark, d, "tms_comprovantes_entrega"))


@query("invoice_before_delivery", """SELECT fatura_id, remessa_id, data_faturamento FROM sv_financeiro_faturas f
 WHERE NOT EXISTS (SELECT 1 FROM sv_tms_comprovantes_entrega c WHERE c.pod_confirmado AND c.remessa_id = f.remessa_id)""")
def q_invoice_before_delivery(spark, d):
    return kp.invoice_before_delivery(S(spark, d, "financeiro_faturas", "remessa_id", "data_faturamento"), S(spark, d, "tms_comprovantes_entrega", "remessa_id", "pod_confirmado"))


@query("blocked_customer_orders", """SELECT pedido_id, cliente_id, data_pedido, valor_total, status_pedido
 FROM sv_crm_pedidos WHERE cliente_id IN (SELECT cliente_id FROM sd_crm_clientes WHERE status_cliente = 'bloqueado')""")
def q_blocked_customer_orders(spark, d):
    return kp.blocked_customer_orders(S(spark, d, "crm_pedidos"), SEED(spark, d, "crm_clientes"))


@query("unreleased_lot_dispatch", """SELECT n.nota_expedicao_id, n.lote_id, l.status_qc,
 CASE WHEN l.lote_id IS NULL THEN 'lote_inexistente' WHEN l.status_qc = 'aprovado' THEN 'liberado' ELSE 'nao_liberado' END AS categoria
 FROM sv_erp_notas_expedicao n LEFT JOIN sv_erp_lotes_producao l ON l.lote_id = n.lote_id""")
def q_unreleased_lot_dispatch(spark, d):
    return kp.unreleased_lot_dispatch(S(spark, d, "erp_notas_expedicao", "lote_id"), S(spark, d, "erp_lotes_producao", "status_qc"),
                                      hot_lots(spark, d))


@query("fefo_compliance", """SELECT n.nota_expedicao_id, n.lote_id, l.produto_id, n.centro_distribuicao_id, n.data_expedicao,
 l.data_validade, a.validade_minima_disponivel,
 CASE WHEN l.lote_id IS NULL THEN 'lote_inexistente' WHEN a.validade_minima_disponivel IS NULL THEN 'sem_posicao_estoque'
      WHEN l.data_validade <= a.validade_minima_disponivel THEN 'conforme' ELSE 'fora_fefo' END AS situacao
 FROM sv_erp_notas_expedicao n LEFT JOIN sv_erp_lotes_producao l ON l.lote_id = n.lote_id
 LEFT JOIN (SELECT p.centro_distribuicao_id, l2.produto_id, p.data_posicao AS dia, min(l2.data_validade) AS validade_minima_disponivel
   FROM sv_erp_posicoes_estoque p JOIN sv_erp_lotes_producao l2 ON l2.lote_id = p.lote_id
   WHERE p.quantidade > 0 AND l2.status_qc = 'aprovado' GROUP BY 1, 2, 3) a
   ON a.centro_distribuicao_id = n.centro_distribuicao_id AND a.produto_id = l.produto_id AND a.dia = n.data_expedicao""")
def q_fefo_compliance(spark, d):
    # Hot (centre, day) pairs from the cleaned bronze notes: a narrow scan, no dedup, no join.
    b = B(spark, d, "erp_notas_expedicao").select(
        clean.clean_text("centro_distribuicao_id").alias("centro_distribuicao_id"),
        clean.parse_date("data_expedicao").alias("data_expedicao"))
    return kp.fefo_compliance(S(spark, d, "erp_notas_expedicao"), S(spark, d, "erp_lotes_producao", "produto_id", "status_qc", "data_validade"),
                              S(spark, d, "erp_posicoes_estoque"), hot_lots(spark, d), kp.centre_days_hot(b))


@query("pick_cycle_time", """SELECT n.centro_distribuicao_id, count(*) AS expedicoes,
 round(avg(datediff('day', p.data_pedido, n.data_expedicao)), 4) AS ciclo_medio_dias,
 quantile_cont(datediff('day', p.data_pedido, n.data_expedicao), 0.5) AS ciclo_mediano_dias,
 max(datediff('day', p.data_pedido, n.data_expedicao)) AS ciclo_maximo_dias
 FROM sv_erp_notas_expedicao n JOIN sv_crm_pedidos p USING (pedido_id) GROUP BY 1""")
def q_pick_cycle_time(spark, d):
    return kp.pick_cycle_time(S(spark, d, "erp_notas_expedicao", "pedido_id", "centro_distribuicao_id", "data_expedicao"), S(spark, d, "crm_pedidos", "data_pedido"))


@query("transit_time_by_route", """SELECT r.rota_id, t.regiao_destino,
 CAST(ceil(t.tempo_transito_padrao_horas / 24) AS INTEGER) AS transito_padrao_dias, count(*) AS entregas,
 round(avg(datediff('day', r.data_expedicao, c.data_entrega_real)), 4) AS transito_medio_dias,
 count(*) FILTER (WHERE datediff('day', r.data_expedicao, c.data_entrega_real) > ceil(t.tempo_transito_padrao_horas / 24)) AS acima_do_padrao
 FROM sv_tms_comprovantes_entrega c JOIN sv_tms_remessas r USING (remessa_id) LEFT JOIN sd_tms_rotas t USING (rota_id)
 GROUP BY 1, 2, 3""")
def q_transit_time_by_route(spark, d):
    return kp.transit_time_by_route(S(spark, d, "tms_remessas", "rota_id", "data_expedicao"), S(spark, d, "tms_comprovantes_entrega", "remessa_id", "data_entrega_real"),
                                    SEED(spark, d, "tms_rotas"))


@query("sla_breach", """SELECT c.remessa_id, r.data_entrega_prevista, c.data_entrega_real,
 datediff('day', r.data_entrega_prevista, c.data_entrega_real) AS atraso_dias,
 c.data_entrega_real > r.data_entrega_prevista AS violou_sla
 FROM sv_tms_comprovantes_entrega c JOIN sv_tms_remessas r USING (remessa_id)""")
def q_sla_breach(spark, d):
    return kp.sla_breach(S(spark, d, "tms_comprovantes_entrega", "remessa_id", "data_entrega_real"), S(spark, d, "tms_remessas", "data_entrega_prevista"))


@query("orders_by_region", """SELECT coalesce(c.regiao, 'desconhecida') AS regiao, count(*) AS pedidos,
 sum(p.valor_total) AS valor_total FROM sv_crm_pedidos p LEFT JOIN sd_crm_clientes c USING (cliente_id) GROUP BY 1""")
def q_orders_by_region(spark, d):
    return kp.orders_by_region(S(spark, d, "crm_pedidos", "cliente_id", "valor_total"), SEED(spark, d, "crm_clientes"))


@query("orders_by_representative", """SELECT p.representante_id, r.nome_representante, count(*) AS pedidos,
 sum(p.valor_total) AS valor_total FROM sv_crm_pedidos p LEFT JOIN sd_crm_representantes r USING (representante_id) GROUP BY 1, 2""")
def q_orders_by_representative(spark, d):
    return kp.orders_by_representative(S(spark, d, "crm_pedidos", "representante_id", "valor_total"), SEED(spark, d, "crm_representantes"))


@query("due_date_check", """SELECT c.conta_receber_id, c.fatura_id, c.data_vencimento,
 CAST(f.data_faturamento + 30 AS DATE) AS vencimento_esperado,
 c.data_vencimento = CAST(f.data_faturamento + 30 AS DATE) AS vencimento_confere
 FROM sv_financeiro_contas_receber c LEFT JOIN sv_financeiro_faturas f USING (fatura_id)""")
def q_due_date_check(spark, d):
    return kp.due_date_check(S(spark, d, "financeiro_contas_receber", "fatura_id", "data_vencimento"), S(spark, d, "financeiro_faturas", "data_faturamento"))


@query("complaints_per_lot", """SELECT c.lote_id, c.reclamacoes, l.quantidade_produzida,
 round(CASE WHEN l.quantidade_produzida IS NULL OR l.quantidade_produzida = 0 THEN NULL
   ELSE c.reclamacoes * 1000.0 / l.quantidade_produzida END, 6) AS reclamacoes_por_mil_unidades,
 l.quantidade_produzida IS NOT NULL AS lote_conhecido
 FROM (SELECT lote_id, count(*) AS reclamacoes FROM sv_crm_atendimento
       WHERE tipo_interacao = 'reclamacao' AND lote_id IS NOT NULL GROUP BY 1) c
 LEFT JOIN sv_erp_lotes_producao l USING (lote_id)""")
def q_complaints_per_lot(spark, d):
    return kp.complaints_per_lot(S(spark, d, "crm_atendimento", "lote_id", "tipo_interacao"), S(spark, d, "erp_lotes_producao", "quantidade_produzida"))


@query("lot_trace", """SELECT n.lote_id, n.nota_expedicao_id, r.remessa_id, n.pedido_id, p.cliente_id
 FROM sv_erp_notas_expedicao n JOIN (SELECT DISTINCT lote_id FROM sv_erp_lotes_producao WHERE status_qc = 'reprovado') l USING (lote_id)
 LEFT JOIN sv_tms_remessas r ON r.nota_expedicao_id = n.nota_expedicao_id
 LEFT JOIN sv_crm_pedidos p ON p.pedido_id = n.pedido_id""")
def q_lot_trace(spark, d):
    rejected = S(spark, d, "erp_lotes_producao", "status_qc").where(F.col("status_qc") == "reprovado")
    return kp.lot_trace(rejected, S(spark, d, "erp_notas_expedicao", "pedido_id", "lote_id"), S(spark, d, "tms_remessas", "nota_expedicao_id"),
                        S(spark, d, "crm_pedidos", "cliente_id"), hot_lots(spark, d))


@query("lot_release_time", """SELECT lote_id, centro_producao_id, produto_id, status_qc,
 datediff('day', data_fabricacao, data_liberacao) AS dias_ate_liberacao FROM sv_erp_lotes_producao""")
def q_lot_release_time(spark, d):
    return kp.lot_release_time(S(spark, d, "erp_lotes_producao"))


@query("billable_deliveries", """SELECT c.remessa_id, r.pedido_id, c.comprovante_id, c.data_entrega_real
 FROM sv_tms_comprovantes_entrega c JOIN sv_tms_remessas r USING (remessa_id) WHERE c.pod_confirmado""")
def q_billable_deliveries(spark, d):
    return kp.billable_deliveries(S(spark, d, "tms_comprovantes_entrega", "remessa_id", "data_entrega_real", "pod_confirmado"), S(spark, d, "tms_remessas", "pedido_id"))


@query("lot_cold_flag", """SELECT l.lote_id, l.produto_id, p.exige_cadeia_fria
 FROM sv_erp_lotes_producao l LEFT JOIN sd_erp_produtos p USING (produto_id)""")
def q_lot_cold_flag(spark, d):
    return kp.lot_cold_flag(S(spark, d, "erp_lotes_producao", "produto_id"), SEED(spark, d, "erp_produtos"))


# ---- quality reports (Q1, Q5, Q6) -------------------------------------------------

_SQL_TYPES = {"dates": "date", "integers": "bigint", "money": "decimal(18,2)", "measures": "double",
              "texts": "string", "nullable_fks": "string", "booleans": "boolean", "timestamps": "timestamp",
              "plain": "string"}


def _profile_sql(t):
    spec = EVENT_TABLES[t]
    cols = list(spec.columns) + ["data_particao_ingestao"]
    vals = ", ".join(f"('{c}', {i + 1}, '{_SQL_TYPES[spec.category(c)] if c in spec.columns else 'string'}')"
                     for i, c in enumerate(cols))
    return (f"SELECT '{t}' AS tabela, coluna, posicao, tipo, (SELECT count(*) FROM sv_{t}) AS total_linhas "
            f"FROM (VALUES {vals}) v(coluna, posicao, tipo)")


def _seed_profile_sql(n):
    spec = SEEDS[n]
    vals = ", ".join(f"('{c}', {i + 1}, '{'boolean' if c in spec.booleans else 'bigint' if c in spec.integers else 'string'}')"
                     for i, c in enumerate(spec.columns))
    return (f"SELECT '{n}' AS tabela, coluna, posicao, tipo, (SELECT count(*) FROM sd_{n}) AS total_linhas "
            f"FROM (VALUES {vals}) v(coluna, posicao, tipo)")


@query("table_profile", " UNION ALL ".join([_profile_sql(t) for t in EVENT_TABLES] + [_seed_profile_sql(n) for n in SEEDS]))
def q_table_profile(spark, d):
    """All silver tables, the seeds among them."""
    out = None
    for t in EVENT_TABLES:
        p = qa.table_profile(B(spark, d, t), EVENT_TABLES[t])
        out = p if out is None else out.unionByName(p)
    for n in SEEDS:
        out = out.unionByName(qa.seed_profile(SEED(spark, d, n), n))
    return out


# Data rules checked on silver (Spark SQL predicates, valid in DuckDB too).
DATA_RULES = {
    "crm_pedidos": [
        rules.Rule("valor_nao_positivo", "valor_total <= 0", "alta"),
        rules.Rule("valor_ausente", "valor_total IS NULL", "media"),
        rules.Rule("data_pedido_ausente", "data_pedido IS NULL", "media"),
    ],
    "tms_remessas": [
        rules.Rule("entrega_prevista_antes_da_expedicao", "data_entrega_prevista < data_expedicao", "alta"),
        rules.Rule("veiculo_fora_da_frota", "veiculo_id NOT IN ('VEI-001', 'VEI-002', 'VEI-003', 'VEI-004', 'VEI-005', 'VEI-006')", "media"),
        rules.Rule("sla_acima_de_um_dia", "sla_horas_contratado > 24", "baixa"),
    ],
    "crm_itens_pedido": [rules.Rule("quantidade_nao_positiva", "quantidade <= 0", "alta"),
                         rules.Rule("preco_acima_do_usual", "preco_unitario > 90000", "baixa")],
    "crm_atendimento": [rules.Rule("reclamacao_sem_lote", "tipo_interacao = 'reclamacao' AND lote_id IS NULL", "media")],
    "erp_lotes_producao": [rules.Rule("aprovado_sem_liberacao", "status_qc = 'aprovado' AND data_liberacao IS NULL", "alta"),
                           rules.Rule("reprovado", "status_qc = 'reprovado'", "baixa")],
    "erp_notas_expedicao": [rules.Rule("sem_centro", "centro_distribuicao_id IS NULL", "media")],
    "erp_posicoes_estoque": [rules.Rule("quantidade_negativa", "quantidade < 0", "alta"),
                             rules.Rule("sem_centro", "centro_distribuicao_id IS NULL", "media")],
    "tms_leituras_temperatura": [rules.Rule("abaixo_de_zero", "temperatura_celsius < 0", "media")],
    "tms_comprovantes_entrega": [rules.Rule("entregue_sem_confirmacao", "status_entrega = 'entregue' AND pod_confirmado IS NULL", "media")],
    "financeiro_faturas": [rules.Rule("sem_centro_de_custo", "centro_custo_id IS NULL", "media")],
    "financeiro_contas_receber": [rules.Rule("recebido_apos_vencimento", "data_recebimento > data_vencimento", "baixa")],
}


@query("rule_violations", " UNION ALL ".join(
    f"SELECT '{t}' AS tabela, {EVENT_TABLES[t].key} AS chave, '{r.name}' AS regra, '{r.severity}' AS severidade "
    f"FROM sv_{t} WHERE coalesce({r.predicate}, false)" for t, rs in DATA_RULES.items() for r in rs))
def q_rule_violations(spark, d):
    out = None
    for t, rs in DATA_RULES.items():
        v = rules.rule_violations(S(spark, d, t), t, EVENT_TABLES[t].key, rs)
        out = v if out is None else out.unionByName(v)
    return out


VOLUME_TABLES = tuple(EVENT_TABLES)


@query("volume_anomaly", " UNION ALL ".join(f"""SELECT tabela, data, linhas, round(m, 4) AS media_movel, round(s, 4) AS desvio_movel,
 CASE WHEN s IS NULL OR s = 0 THEN false ELSE round(abs(linhas - m), 6) > round(s * 3.0, 6) END AS anomalia
 FROM (SELECT '{t}' AS tabela, data, linhas,
   avg(linhas) OVER (ORDER BY data ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS m,
   stddev_samp(linhas) OVER (ORDER BY data ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS s
   FROM (SELECT data, count(*) AS linhas FROM bz_{t} GROUP BY data))""" for t in VOLUME_TABLES))
def q_volume_anomaly(spark, d):
    out = None
    for t in VOLUME_TABLES:
        v = qa.daily_volume(B(spark, d, t), t)
        out = v if out is None else out.unionByName(v)
    return qa.volume_anomaly(out)


@query("volume_bands", " UNION ALL ".join(f"""SELECT '{t}' AS tabela, dia, coalesce(linhas, 0) AS linhas,
 CASE WHEN coalesce(linhas, 0) = 0 THEN (CASE WHEN {O.operates_sql(f"'{EVENT_TABLES[t].system}'", 'dia')} THEN 'sem_dado' ELSE 'fora_de_operacao' END)
      WHEN linhas < {lo} THEN 'abaixo' WHEN linhas > {hi} THEN 'acima' ELSE 'na_faixa' END AS situacao
 FROM (SELECT {O.days_sql('min(CAST(data AS DATE))', 'max(CAST(data AS DATE))')} AS dia FROM bz_{t})
 LEFT JOIN (SELECT CAST(data AS DATE) AS dia, count(*) AS linhas FROM bz_{t} GROUP BY 1) USING (dia)"""
    for t, (lo, hi) in qa.VOLUME_BANDS.items()))
def q_volume_bands(spark, d):
    out = None
    for t, band in qa.VOLUME_BANDS.items():
        v = qa.volume_bands(B(spark, d, t), EVENT_TABLES[t], band)
        out = v if out is None else out.unionByName(v)
    return out


@query("months_complete", f"""SELECT strftime(mes, '%Y-%m') AS mes_referencia, {' + '.join(CLOSE_SYSTEMS)} AS dias_faltando,
 CAST(json_object({', '.join(f"'{s}', {s}" for s in CLOSE_SYSTEMS)}) AS VARCHAR) AS por_sistema,
 {' + '.join(CLOSE_SYSTEMS)} = 0 AS mes_completo
 FROM (SELECT m.mes, {', '.join(f'{_lacking(s)} AS {s}' for s in CLOSE_SYSTEMS)} FROM ({O.FIN_MONTHS}) m)""")
def q_months_complete(spark, d):
    """A month can be closed only if no system lacks a run on one of its operating days."""
    return cl.months_complete(RUNS(spark, d), CLOSE_SYSTEMS)
