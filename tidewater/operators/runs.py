"""Pipeline run log: records, day verdicts, retroactive rebuild, calendar checks.

The run log answers "did the pipelines run?". A missing run on a
non-operating day is expected, not a failure, so every verdict is taken
against the system's own calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import days_between, operates_on
from ..spec import SYSTEM_CALENDARS

RUN_COLUMNS = ("execucao_id", "pipeline", "item", "status", "detalhes", "data_referencia",
               "started_at", "ended_at")

# The daily job's duration warning threshold, seconds.
RUN_SLA_SECONDS = 900


def run_records(results: DataFrame, pipeline: str, run_key: Column, started_at: Column, ended_at: Column) -> DataFrame:
    """Turn per-item job results into run-log rows, as one batch.

    ``results`` has ``item``, ``status`` and any metric columns; the metrics
    become the ``detalhes`` JSON. One append per job, not one file per item.
    ``execucao_id`` is deterministic (hash of pipeline, item, run key and start)
    so writing the same run again doubles nothing, and another run, of the same
    day too, has ids of its own.
    """
    metrics = [c for c in results.columns if c not in ("item", "status", "data_referencia")]
    ref = F.col("data_referencia") if "data_referencia" in results.columns else F.lit(None).cast("string")
    start = started_at.cast("timestamp")
    return results.select(
        F.sha2(F.concat_ws("|", F.lit(pipeline), F.col("item"), run_key, F.date_format(start, "yyyy-MM-dd HH:mm:ss")), 256).alias("execucao_id"),
        F.lit(pipeline).alias("pipeline"), "item", "status",
        F.to_json(F.struct(*[F.col(c) for c in metrics])).alias("detalhes"),
        ref.alias("data_referencia"), start.alias("started_at"), ended_at.cast("timestamp").alias("ended_at"))


def system_runs(log: DataFrame, system_of: dict[str, str], job: str = "diario", pipeline: str = "gerar_dados") -> DataFrame:
    """Runs per system and day, from a log of per-table ingest steps and of the systems' own runs.

    A system has run on a day if the last try of each of its tables on that day
    succeeded, with new data or without; rows of ``pipeline`` are taken as they are.
    """
    step = F.regexp_extract("item", "^ingest:(.+)$", 1)
    tables = F.create_map(*[F.lit(x) for t, s in system_of.items() for x in (t, s)])
    steps = (log.where((F.col("pipeline") == job) & (step != "") & F.col("data_referencia").isNotNull())
             .select(tables[step].alias("item"), step.alias("_tabela"), "data_referencia", F.struct("started_at", "status").alias("_try")))
    last = steps.groupBy("item", "data_referencia", "_tabela").agg(F.max("_try").alias("_try"))
    ran = last.groupBy("item", "data_referencia").agg(
        F.min(F.col("_try.status").isin("sucesso", "sem_dado_novo")).alias("_ok"))
    return (ran.select(F.lit(pipeline).alias("pipeline"), "item", F.when(F.col("_ok"), "sucesso").otherwise("falha").alias("status"), "data_referencia")
            .unionByName(log.where(F.col("pipeline") == pipeline).select("pipeline", "item", "status", "data_referencia")))


def run_day_status(runs: DataFrame, systems: tuple[str, ...], pipeline: str = "gerar_dados") -> DataFrame:
    """Verdict per system and calendar day over the logged date range.

    A logged run gives its status (a success on any run of the day wins over
    an earlier failure); no run on an operating day is ``ausente``; no run on
    a non-operating day is ``dia_nao_operacional``.
    """
    r = runs.where(F.col("pipeline") == pipeline).select(
        F.col("item").alias("sistema"), F.to_date("data_referencia").alias("dia"), "status")
    best = r.groupBy("sistema", "dia").agg(
        F.max(F.when(F.col("status") == "sucesso", 3).when(F.col("status") == "dia_nao_operacional", 2)
              .when(F.col("status") == "falha", 1).otherwise(0)).alias("_rank"))
    span = r.agg(F.min("dia").alias("ini"), F.max("dia").alias("fim"))
    cal = days_between(span, "ini", "fim").select(
        "dia", F.explode(F.array(*[F.lit(s) for s in systems])).alias("sistema"))
    j = cal.join(best, ["sistema", "dia"], "left")
    logged = (F.when(F.col("_rank") == 3, "sucesso").when(F.col("_rank") == 2, "dia_nao_operacional")
              .when(F.col("_rank") == 1, "falha").otherwise("outro"))
    verdict = (F.when(F.col("_rank").isNotNull(), logged)
               .when(operates_on("sistema", "dia"), "ausente").otherwise("dia_nao_operacional"))
    return j.select("sistema", "dia", operates_on("sistema", "dia").alias("dia_operacional"),
                    verdict.alias("situacao"))


def rebuild_run_log(evidence: DataFrame) -> DataFrame:
    """Rebuild generation runs from landed data, marked as retroactive.

    ``evidence`` has ``sistema`` and ``dia`` (days on which the system's
    files exist). Over the evidence date range, each system/day gets
    ``sucesso`` only with evidence; a non-operating day without data gets
    ``dia_nao_operacional``; an operating day without data ``sem_evidencia``
    (never marked as run without data).
    """
    ev = evidence.select("sistema", "dia").distinct().withColumn("_tem", F.lit(True))
    span = ev.agg(F.min("dia").alias("ini"), F.max("dia").alias("fim"))
    systems = list(SYSTEM_CALENDARS)
    cal = days_between(span, "ini", "fim").select(
        "dia", F.explode(F.array(*[F.lit(s) for s in systems])).alias("sistema"))
    j = cal.join(ev, ["sistema", "dia"], "left")
    has = F.coalesce(F.col("_tem"), F.lit(False))
    status = (F.when(has, "sucesso").when(~operates_on("sistema", "dia"), "dia_nao_operacional")
              .otherwise("sem_evidencia"))
    ref = F.date_format("dia", "yyyy-MM-dd")
    details = F.to_json(F.struct(F.col("sistema"), ref.alias("data_referencia"), status.alias("status"),
                                 F.lit(True).alias("reconstrucao_retroativa")))
    return j.select(F.concat(F.col("sistema"), F.lit("-"), ref).alias("execucao_id"),
                    F.lit("gerar_dados").alias("pipeline"), F.col("sistema").alias("item"),
                    status.alias("status"), details.alias("detalhes"), ref.alias("data_referencia"))


def calendar_reconciliation(evidence: DataFrame) -> DataFrame:
    """Per system: file-days seen vs operating days expected over the window."""
    ev = evidence.select("sistema", "dia").distinct()
    span = ev.groupBy("sistema").agg(F.min("dia").alias("ini"), F.max("dia").alias("fim"))
    cal = days_between(span, "ini", "fim").select("sistema", "dia")
    j = cal.join(ev.withColumn("_tem", F.lit(True)), ["sistema", "dia"], "left")
    op = operates_on("sistema", "dia")
    has = F.col("_tem").isNotNull()
    return j.groupBy("sistema").agg(
        F.count_if(has).alias("dias_com_arquivo"),
        F.count_if(op).alias("dias_esperados"),
        F.count_if(has & ~op).alias("dias_fora_calendario"),
        F.count_if(op & ~has).alias("dias_faltando"))


def run_durations(runs: DataFrame) -> DataFrame:
    secs = F.unix_timestamp("ended_at") - F.unix_timestamp("started_at")
    return runs.withColumn("duracao_segundos", secs)


def run_sla_breach(runs: DataFrame, limit_seconds: int = RUN_SLA_SECONDS) -> DataFrame:
    d = run_durations(runs)
    return d.where(F.col("duracao_segundos") > limit_seconds).select(
        "execucao_id", "pipeline", "item", "data_referencia", "ended_at", "duracao_segundos")


def runs_by_status(runs: DataFrame) -> DataFrame:
    return runs.groupBy("pipeline", "status").agg(F.count(F.lit(1)).alias("execucoes"))


def runs_by_mode(runs: DataFrame) -> DataFrame:
    mode = F.get_json_object("detalhes", "$.modo_execucao")
    return runs.groupBy(F.coalesce(mode, F.lit("desconhecido")).alias("modo_execucao")) \
        .agg(F.count(F.lit(1)).alias("execucoes"))


def latest_runs(runs: DataFrame, pipeline: str, item: str, n: int = 10) -> DataFrame:
    return (runs.where((F.col("pipeline") == pipeline) & (F.col("item") == item))
                .orderBy(F.desc("started_at"), F.desc("execucao_id")).limit(n))
