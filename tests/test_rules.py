"""Golden tiny frames for every rule: verdict by verdict, nulls first."""

import datetime as dt

from pyspark.sql import functions as F

from tidewater.operators import gold, kpis, rules
from tidewater.operators.alerts import cold_chain_alerts

D = dt.date


def test_cold_chain_every_verdict(spark):
    remessas = spark.createDataFrame([
        ("R1", "N1", "V-REF"), ("R2", "N2", "V-REF"), ("R3", "N3", "V-DRY"), ("R4", "N4", "V-REF"),
        ("R5", "N5", "V-REF"), ("R6", "N6", "V-REF"), ("R7", "N7", "V-???"), ("R8", "N8", "V-REF"),
    ], "remessa_id string, nota_expedicao_id string, veiculo_id string")
    notas = spark.createDataFrame([
        ("N1", "L-COLD"), ("N2", "L-COLD"), ("N3", "L-COLD"), ("N4", "L-DRY"), ("N5", "L-GHOST"),
        ("N6", "L-UNKNOWN-PRODUCT"), ("N7", "L-COLD"), ("N8", None),
    ], "nota_expedicao_id string, lote_id string")
    lotes = spark.createDataFrame([("L-COLD", "P-COLD"), ("L-DRY", "P-DRY"), ("L-UNKNOWN-PRODUCT", "P-777")],
                                  "lote_id string, produto_id string")
    produtos = spark.createDataFrame([("P-COLD", "frio", True), ("P-DRY", "seco", False)],
                                     "produto_id string, nome_produto string, exige_cadeia_fria boolean")
    veiculos = spark.createDataFrame([("V-REF", True), ("V-DRY", False)], "veiculo_id string, refrigerado boolean")
    leituras = spark.createDataFrame([("R2", 9.5), ("R1", 5.0), ("R1", None), ("R8", 1.0)],
                                     "remessa_id string, temperatura_celsius double")
    out = {r.remessa_id: r.tipo_violacao for r in
           rules.cold_chain(remessas, notas, lotes, produtos, veiculos, leituras).collect()}
    assert out == {
        "R1": "conforme",            # in band, null reading is not a violation
        "R2": "falha_equipamento",   # refrigerated truck, reading out of band
        "R3": "veiculo_incorreto",   # cold product on a dry truck
        "R4": "nao_aplicavel",       # product needs no cold chain
        "R5": "nao_verificavel",     # lot unknown
        "R6": "nao_verificavel",     # product missing from catalogue (the D1 defect)
        "R7": "nao_verificavel",     # vehicle unknown
        "R8": "nao_verificavel",     # dispatch without lot
    }
    # the anchor row count is preserved
    assert rules.cold_chain(remessas, notas, lotes, produtos, veiculos, leituras).count() == remessas.count()


def test_cold_chain_alert_only_when_wrong_vehicle(spark):
    cold = spark.createDataFrame([("R1", "conforme"), ("R2", "veiculo_incorreto")], "remessa_id string, tipo_violacao string")
    a = cold_chain_alerts(cold).collect()
    assert len(a) == 1 and a[0].detalhes == '{"total_violacoes":1}'
    assert cold_chain_alerts(cold.where("tipo_violacao = 'conforme'")).count() == 0


def test_on_time_is_three_valued(spark):
    comp = spark.createDataFrame([
        ("R1", "C1", D(2026, 7, 3), "entregue", True), ("R2", "C2", D(2026, 7, 5), "atrasada", True),
        ("R3", "C3", D(2026, 7, 3), "entregue", None), ("R4", "C4", D(2026, 7, 3), "entregue", False),
    ], "remessa_id string, comprovante_id string, data_entrega_real date, status_entrega string, pod_confirmado boolean")
    rem = spark.createDataFrame([(r, D(2026, 7, 3)) for r in ("R1", "R2", "R3", "R4")],
                                "remessa_id string, data_entrega_prevista date")
    o = gold.otif(comp, rem)
    assert dict((r.remessa_id, r.no_prazo) for r in o.collect()) == {"R1": True, "R2": False, "R3": None, "R4": None}
    rate = gold.otif_rate(o).first()
    assert (rate.confirmadas, rate.no_prazo, rate.taxa_no_prazo) == (2, 1, 0.5)


def test_rates_on_empty_input_are_null(spark):
    empty = spark.createDataFrame([], "remessa_id string, comprovante_id string, data_entrega_prevista date, "
                                      "data_entrega_real date, pod_confirmado boolean, no_prazo boolean, status_entrega string")
    assert gold.otif_rate(empty).first().taxa_no_prazo is None


def test_reconciliation_cent_and_nulls(spark):
    from decimal import Decimal as Dec
    fat = spark.createDataFrame([("F1", "P1", Dec("100.01"), D(2026, 7, 1)), ("F2", "P2", Dec("100.02"), D(2026, 7, 1)),
                                 ("F3", "P3", Dec("5.00"), D(2026, 7, 1)), ("F4", "P-ORFAO", Dec("1.00"), D(2026, 7, 1))],
                                "fatura_id string, pedido_id string, valor_faturado decimal(18,2), data_faturamento date")
    ped = spark.createDataFrame([("P1", Dec("100.00")), ("P2", Dec("100.00")), ("P3", None)],
                                "pedido_id string, valor_total decimal(18,2)")
    r = {x.fatura_id: x.divergente for x in gold.reconcile_invoices(fat, ped).collect()}
    assert r == {"F1": False, "F2": True, "F3": None}   # exactly one cent is not divergent
    assert [x.fatura_id for x in gold.reconcile_orphans(fat, ped).collect()] == ["F4"]


def test_sku_and_cost_centre_keep_every_row(spark):
    itens = spark.createDataFrame([("I1", "P", "PROD-001"), ("I2", "P", "PROD-999"), ("I3", "P", None)],
                                  "item_pedido_id string, pedido_id string, produto_id string")
    prods = spark.createDataFrame([("PROD-001",), ("PROD-001",)], "produto_id string")  # duplicate catalogue row
    out = dict((r.item_pedido_id, r.sku_valido) for r in rules.sku_validity(itens, prods).collect())
    assert out == {"I1": True, "I2": False, "I3": False}
    fat = spark.createDataFrame([("F1", "CC-001"), ("F2", None), ("F3", "CC-009")], "fatura_id string, centro_custo_id string")
    cc = spark.createDataFrame([("CC-001",)], "centro_custo_id string")
    assert dict((r.fatura_id, r.situacao) for r in kpis.missing_cost_center(fat, cc).collect()) == \
        {"F1": "ok", "F2": "sem_centro", "F3": "centro_desconhecido"}


def test_rule_checker_one_row_per_violation(spark):
    df = spark.createDataFrame([("A", -1.0, None), ("B", 5.0, "x"), ("C", None, None)], "k string, v double, t string")
    out = rules.rule_violations(df, "t", "k", [rules.Rule("neg", "v < 0", "alta"), rules.Rule("no_t", "t IS NULL")])
    assert sorted((r.chave, r.regra) for r in out.collect()) == [("A", "neg"), ("A", "no_t"), ("C", "no_t")]


def test_kpi_plausibility(spark):
    s = spark.createDataFrame([("a", 0.0), ("b", 1.0), ("c", 0.3), ("d", None)], "tabela string, taxa double")
    assert dict((r.tabela, r.veredito) for r in rules.kpi_plausibility(s).collect()) == \
        {"a": "zero_suspeito", "b": "cem_suspeito", "c": "plausivel", "d": "sem_dado"}


def test_fefo(spark):
    notas = spark.createDataFrame([("N1", "L1", "cd01", D(2026, 1, 5)), ("N2", "L2", "cd01", D(2026, 1, 5)),
                                   ("N3", "LX", "cd01", D(2026, 1, 5)), ("N4", "L1", "cd02", D(2026, 1, 5))],
                                  "nota_expedicao_id string, lote_id string, centro_distribuicao_id string, data_expedicao date")
    lotes = spark.createDataFrame([("L1", "P", "aprovado", D(2026, 6, 1)), ("L2", "P", "aprovado", D(2026, 9, 1)),
                                   ("L3", "P", "reprovado", D(2026, 2, 1))],
                                  "lote_id string, produto_id string, status_qc string, data_validade date")
    pos = spark.createDataFrame([("L1", "cd01", 10, D(2026, 1, 5)), ("L2", "cd01", 5, D(2026, 1, 5)),
                                 ("L3", "cd01", 9, D(2026, 1, 5))],
                                "lote_id string, centro_distribuicao_id string, quantidade bigint, data_posicao date")
    out = dict((r.nota_expedicao_id, r.situacao) for r in kpis.fefo_compliance(notas, lotes, pos).collect())
    assert out == {"N1": "conforme", "N2": "fora_fefo", "N3": "lote_inexistente", "N4": "sem_posicao_estoque"}


def test_fefo_null_parts_match_nothing(spark):
    from tidewater.operators.kpis import fefo_compliance
    import datetime as dt
    day = dt.date(2026, 7, 1)
    notas = spark.createDataFrame([("N1", "L1", None, day), ("N2", "L1", "cd01", day)],
                                  "nota_expedicao_id string, lote_id string, centro_distribuicao_id string, data_expedicao date")
    lotes = spark.createDataFrame([("L1", "P1", "aprovado", day)], "lote_id string, produto_id string, status_qc string, data_validade date")
    pos = spark.createDataFrame([("L1", None, 5, day), ("L1", "cd01", 5, day)],
                                "lote_id string, centro_distribuicao_id string, quantidade long, data_posicao date")
    got = {r.nota_expedicao_id: r.situacao for r in fefo_compliance(notas, lotes, pos, [], []).collect()}
    assert got == {"N1": "sem_posicao_estoque", "N2": "conforme"}


def test_gold_summary_shuffles_a_shared_table_once(spark, sf):
    """Shipments and lots are each read by two KPIs: one aggregate over each serves both."""
    from __spark_entry__ import queries

    df = queries()["kpi_plausibility"](spark, sf)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 2
