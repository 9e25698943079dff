"""The daily job: every step logged, no row lost by a failure, corrections reach silver, gold published whole."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidewater.plans import daily
from tidewater.session import fresh_path
from tidewater.sources import fixtures, layers, tables
from tidewater.sources import landing as ld
from tidewater.spec import EVENT_TABLES, SEEDS

T = "crm_pedidos"


def land(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)


def order(i, value="10,00", **kw):
    return {"pedido_id": f"PED-{i}", "cliente_id": "CLI-1", "representante_id": "REP-001", "data_pedido": "01/07/2026",
            "valor_total": value, "status_pedido": "aberto", **kw}


@pytest.fixture
def job(spark):
    root = fresh_path(spark, "job")
    return daily.JobPaths(f"{root}/landing", root)


def orders(spark, paths):
    return {r.pedido_id: float(r.valor_total) for r in daily.read_silver(spark, paths, T).collect()}


def runs(spark, paths):
    return [(r.item, r.status) for r in spark.read.parquet(paths.runs).orderBy("started_at").collect()]


def test_daily_job_end_to_end(spark, sf):
    root = fresh_path(spark, "daily")
    paths = daily.JobPaths(f"{root}/landing", root)
    few = {"erp_lotes_producao", "erp_notas_expedicao", "crm_pedidos", "tms_remessas", "tms_comprovantes_entrega", "financeiro_faturas"}
    for t in few:
        df = layers.bronze(spark, sf, t)
        ld.write_landing(spark, df.withColumn("data", F.concat(F.substring("data", 1, 5), F.lit("01-01"))), paths.landing, EVENT_TABLES[t].system, t)
    for n in ("erp_produtos", "tms_veiculos"):
        ld.write_seed(spark, fixtures.seed_bronze(spark, sf, n), paths.landing, SEEDS[n].system, n)
    ctx = daily.daily_job(spark, paths.landing, root, day="2026-07-01")
    log = dict(runs(spark, paths))
    assert log["ingest:crm_pedidos"] == "sucesso" and log["ingest:crm_itens_pedido"] == "sem_dado_novo"
    assert log["silver:tms_remessas"] == "sucesso" and log["alertas"] == "sucesso" and "falha" not in log.values()
    assert log["fechamento"] == log["retencao"] == "sucesso"
    assert {i for i in log if i.startswith("gold:")} == {"gold:resumo", *(f"gold:{t}" for t in (
        "gold_reconciliacao_financeira", "gold_otif", "gold_qualidade_producao", "observability_cadeia_fria",
        "observability_qualidade_sku", "observability_estoque_negativo"))}
    assert not ctx.records                                                                  # flushed
    want = layers.silver(spark, sf, T)
    assert daily.read_silver(spark, paths, T).select(*EVENT_TABLES[T].columns).exceptAll(want.select(*EVENT_TABLES[T].columns)).count() == 0
    summary = {r.tabela: r for r in tables.read_table(spark, paths.gold("resumo")).collect()}
    assert len(summary) == 6 and summary["observability_estoque_negativo"].total_linhas == 0 and summary["gold_otif"].total_linhas > 0
    first = tables.read_table(spark, paths.alerts).collect()
    assert first and len({a.alerta_id for a in first}) == len(first)
    # A second run finds nothing new, changes no row, raises the same alerts again under their ids, and adds its own log.
    before = daily.read_silver(spark, paths, T).count()
    daily.daily_job(spark, paths.landing, root, day="2026-07-02")
    again = tables.read_table(spark, paths.alerts).collect()
    assert daily.read_silver(spark, paths, T).count() == before
    assert {a.situacao for a in again} == {"aberto"}
    assert {a.alerta_id for a in again} == {a.alerta_id for a in first} and min(a.timestamp_alerta for a in again) > max(a.timestamp_alerta for a in first)
    all_runs = spark.read.parquet(paths.runs)
    assert all_runs.select("execucao_id").distinct().count() == all_runs.count() == 2 * len(log)
    assert all_runs.where(F.col("ended_at") < F.col("started_at")).count() == 0


def test_rows_of_a_failed_silver_step_come_with_the_next_run(spark, job, monkeypatch):
    land(f"{job.landing}/crm/data=2026-07-01/{T}.json", [order(1), order(2), {**order(3), "valor_total": "bad"}])
    daily.ingest_tables(spark, job.ingest, [T])
    real = tables.upsert
    monkeypatch.setattr(tables, "upsert", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        daily.silver_refresh(spark, job, T)
    monkeypatch.setattr(tables, "upsert", real)
    daily.ingest_tables(spark, job.ingest, [T])                                             # nothing new landed
    daily.silver_refresh(spark, job, T)
    land(f"{job.landing}/crm/data=2026-07-02/{T}.json", [order(4)])
    daily.ingest_tables(spark, job.ingest, [T])
    daily.silver_refresh(spark, job, T)
    assert orders(spark, job) == {"PED-1": 10.0, "PED-2": 10.0, "PED-4": 10.0}
    # The bad row was written by both tries and counts once.
    assert spark.read.parquet(f"{job.root}/quarentena").count() == 1
    assert [r.chave for r in daily.read_quarantine(spark, job, T).collect()] == ["PED-3"]
    # A correction of its day takes it out of the quarantine.
    land(f"{job.landing}/crm/data=2026-07-01/{T}.json", [order(1), order(2), order(3, "30,00")])
    daily.reprocess_day(spark, job.ingest, T, "2026-07-01")
    daily.silver_refresh(spark, job, T)
    assert daily.read_quarantine(spark, job, T).collect() == [] and orders(spark, job)["PED-3"] == 30.0
    assert daily.read_quarantine(spark, job, "crm_atendimento").collect() == []
    assert daily.silver_refresh(spark, job, T)["status"] == "sem_dado_novo"


def test_one_failing_table_stops_no_other(spark, job, monkeypatch):
    land(f"{job.landing}/crm/data=2026-07-01/{T}.json", [order(1)])
    land(f"{job.landing}/crm/data=2026-07-01/crm_atendimento.json", [{"interacao_id": "I1"}])
    real = daily.silver_refresh
    monkeypatch.setattr(daily, "silver_refresh", lambda s, p, t: 1 / 0 if t == T else real(s, p, t))
    with pytest.raises(ZeroDivisionError):
        daily.daily_job(spark, job.landing, job.root)
    log = dict(runs(spark, job))
    assert log[f"silver:{T}"] == "falha" and log["silver:crm_atendimento"] == "sucesso"
    assert not any(i.startswith("gold:") for i in log)
    monkeypatch.setattr(daily, "silver_refresh", real)
    daily.daily_job(spark, job.landing, job.root)
    assert orders(spark, job) == {"PED-1": 10.0}


def test_reprocessed_day_replaces_streamed_rows(spark, job):
    day = f"{job.landing}/crm/data=2026-07-01/{T}.json"
    land(day, [order(1), order(2)])
    land(f"{job.landing}/crm/data=2026-07-02/{T}.json", [order(2, "20,00"), order(3)])
    daily.ingest_tables(spark, job.ingest, [T])
    daily.silver_refresh(spark, job, T)
    assert orders(spark, job) == {"PED-1": 10.0, "PED-2": 20.0, "PED-3": 10.0}
    land(day, [order(1, "11,00"), order(2, "12,00")])       # a correction that arrives last wins, also over later days
    daily.reprocess_day(spark, job.ingest, T, "2026-07-01")
    daily.silver_refresh(spark, job, T)
    want = {"PED-1": 11.0, "PED-2": 12.0, "PED-3": 10.0}
    assert orders(spark, job) == want
    assert daily.read_bronze(spark, job.ingest, T).count() == 4
    land(day, [order(1, "11,00")])                                                          # PED-2 gone from that day
    daily.backfill_range(spark, job.ingest, "2026-07-01", "2026-07-01", {"crm": [T]})
    daily.silver_refresh(spark, job, T)
    assert orders(spark, job) == want                                                       # a merge deletes nothing
    daily.silver_rebuild(spark, job, T)
    assert orders(spark, job) == {"PED-1": 11.0, "PED-2": 20.0, "PED-3": 10.0}
    assert daily.silver_refresh(spark, job, T)["status"] == "sem_dado_novo"


def test_failed_step_is_logged_whole(spark):
    root = fresh_path(spark, "daily-fail")
    ctx = daily.RunContext("teste", "2026-07-01")
    with pytest.raises(ValueError):
        with ctx.step("quebra"):
            raise ValueError("x" * 9000)
    ctx.flush(spark, f"{root}/runs")
    r = spark.read.parquet(f"{root}/runs").first()
    assert r.status == "falha" and "x" * 9000 in json.loads(r.detalhes)["erro"] and "traceback" in json.loads(r.detalhes)


def log_days(spark, job, days, systems, status="sucesso"):
    """One ingest record per table of the systems and day."""
    at = daily.dt.datetime(2026, 9, 1)
    rows = [(f"{t}{d}{status}", "diario", f"ingest:{t}", status, "{}", d, at, at) for d in days for t, s in EVENT_TABLES.items() if s.system in systems]
    tables.append(spark.createDataFrame(rows, daily.RUN_LOG_SCHEMA), job.runs)


def test_an_invalid_month_reopens_once_its_run_lands(spark, job):
    every = [f"2026-07-{d:02d}" for d in range(1, 32)] + ["2026-08-03"]
    log_days(spark, job, every, set(daily.SYSTEM_ORDER) - {"tms"})
    log_days(spark, job, [d for d in every if d != "2026-07-15"], {"tms"})
    rec = spark.createDataFrame([("F1", "P1", "100.00", "100.00", "0.00", False, "2026-07-03")],
                                "fatura_id string, pedido_id string, valor_total string, valor_faturado string, divergencia_valor string, divergente boolean, data_faturamento string")
    rec = rec.withColumn("valor_faturado", F.col("valor_faturado").cast("decimal(18,2)")).withColumn("data_faturamento", F.to_date("data_faturamento"))
    none = spark.createDataFrame([], "tipo_violacao string")
    built = {"gold_reconciliacao_financeira": rec, "observability_cadeia_fria": none}
    month = lambda: tables.read_table(spark, job.gold(daily.CLOSE_TABLE)).collect()[0]                      # noqa: E731
    alert = lambda: {(a.tipo_evento, a.situacao) for a in tables.read_table(spark, job.alerts).collect()}
    when = [daily.dt.datetime(2026, 9, d) for d in range(1, 6)]

    assert daily.close_months(spark, job, built, when[0]) == {"invalido": 1}
    daily.raise_alerts(spark, job, built, when[0])
    m = month()
    assert (m.mes_referencia, m.estado, m.reaberturas, json.loads(m.por_sistema)["tms"], m.dias_faltando) == ("2026-07", "invalido", 0, 1, "[]")
    assert alert() == {("fechamento_invalido", "aberto")}
    assert daily.close_months(spark, job, built, when[1]) == {}                     # nothing has changed
    # The missing run lands; the job dies between opening and closing, the next one takes the month up.
    log_days(spark, job, ["2026-07-15"], {"tms"})
    real, calls = tables.upsert, []

    def once(*a, **k):
        calls.append(a)
        return real(*a, **k) if len(calls) == 1 else 1 / 0
    tables.upsert = once
    try:
        with pytest.raises(ZeroDivisionError):
            daily.close_months(spark, job, built, when[2])
    finally:
        tables.upsert = real
    assert (month().estado, month().reaberturas, month().fechamento_valido) == ("reaberto", 1, False)
    assert daily.close_months(spark, job, built, when[3]) == {"fechado": 1}
    m = month()
    assert (m.estado, m.reaberturas, m.fechamento_valido, m.total_faturado) == ("fechado", 1, True, 100)
    daily.raise_alerts(spark, job, built, when[3])
    assert alert() == {("fechamento_invalido", "resolvido")}
    # A corrected amount reopens a closed month.
    built["gold_reconciliacao_financeira"] = rec.withColumn("valor_faturado", F.lit("90.00").cast("decimal(18,2)"))
    assert daily.close_months(spark, job, built, when[4]) == {"fechado": 1}
    assert (month().reaberturas, float(month().total_faturado), month().atualizado_em) == (2, 90.0, when[4])


def test_a_failed_last_try_of_a_table_is_no_run_of_its_system(spark):
    from tidewater.operators.runs import system_runs

    at = lambda h: daily.dt.datetime(2026, 7, 1, h)                                 # noqa: E731
    rows = [("1", "diario", "ingest:a", "falha", "", "2026-07-01", at(1), at(1)), ("2", "diario", "ingest:a", "sem_dado_novo", "", "2026-07-01", at(2), at(2)),
            ("3", "diario", "ingest:b", "sucesso", "", "2026-07-01", at(1), at(1)), ("4", "diario", "ingest:b", "sucesso", "", "2026-07-02", at(1), at(1)),
            ("5", "diario", "ingest:a", "falha", "", "2026-07-02", at(1), at(1)), ("6", "diario", "silver:a", "falha", "", "2026-07-01", at(5), at(5)),
            ("7", "gerar_dados", "x", "sucesso", "", "2026-07-03", at(1), at(1)), ("8", "diario", "ingest:a", "sucesso", "", None, at(1), at(1))]
    got = system_runs(spark.createDataFrame(rows, daily.RUN_LOG_SCHEMA), {"a": "s", "b": "s"}).collect()
    assert sorted((r.item, r.data_referencia, r.status) for r in got) == [("s", "2026-07-01", "sucesso"), ("s", "2026-07-02", "falha"), ("x", "2026-07-03", "sucesso")]


def test_retention_removes_only_ingested_old_days(spark, job):
    for d in ("2026-05-01", "2026-05-02", "2026-06-30"):
        land(f"{job.landing}/crm/data={d}/{T}.json", [order(1)])
    daily.ingest_tables(spark, job.ingest, [T])
    land(f"{job.landing}/crm/data=2026-05-02/crm_atendimento.json", [{"interacao_id": "I1"}])       # not ingested
    land(f"{job.landing}/tms/data=2026-05-01/tms_remessas.json", [{"remessa_id": "R"}])             # not ingested
    land(f"{job.landing}/crm/data=junk/{T}.json", [order(9)])
    plan = daily.retention.retention_plan(daily.retention.landing_files(spark, job.landing, tuple(daily.SYSTEM_ORDER)),
                                          daily.file_ledger(spark, job.ingest), 30, "2026-07-01")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in text                                                    # the ledger, not bronze
    assert {(r.sistema, r.particao): r.acao for r in plan.collect()} == {
        ("crm", "data=2026-05-01"): "remover", ("crm", "data=2026-05-02"): "bloqueado_nao_ingerido", ("crm", "data=2026-06-30"): "manter",
        ("crm", "data=junk"): "ignorado_data_invalida", ("tms", "data=2026-05-01"): "bloqueado_nao_ingerido"}
    dry = daily.apply_retention(spark, job, 30, "2026-07-01")
    assert dry["particoes"] == ["crm/data=2026-05-01"] and os.path.exists(f"{job.landing}/crm/data=2026-05-01")
    daily.apply_retention(spark, job, 30, "2026-07-01", dry_run=False)
    assert not os.path.exists(f"{job.landing}/crm/data=2026-05-01") and os.path.exists(f"{job.landing}/crm/data=2026-05-02/{T}.json")
    assert daily.read_bronze(spark, job.ingest, T).where("data = '2026-05-01'").count() == 1
