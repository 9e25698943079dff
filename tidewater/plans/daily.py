"""Jobs composed from the operators: daily run, backfill, reprocess.

Order: ingest -> silver -> seeds -> gold -> rules -> close -> alerts -> retention
-> run log. The run log is written in a ``finally`` block, so a failed step is recorded as
``falha`` with its error instead of silently missing; every record carries
start and end times (how long did it take is a question the log answers).
"""

from __future__ import annotations

import datetime as dt
import traceback
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import alerts, close, gold, retention, rules, runs
from ..operators import silver as sv
from ..sources import tables
from ..sources.landing import SEED_DIR, bronze_schema, system_dir
from ..spec import EVENT_TABLES, INGESTED_AT, PARTITION_COLUMN, SEEDS, SILVER_PARTITION_COLUMN, SYSTEM_ORDER
from ..streaming.ingest import IngestPaths, _ledger, complete_lotes, current_rows, file_ledger, ingest_tables, read_bronze, reread_days

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("execucao_id", T.StringType(), False),
    T.StructField("pipeline", T.StringType(), False),
    T.StructField("item", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("detalhes", T.StringType(), True),
    T.StructField("data_referencia", T.StringType(), True),
    T.StructField("started_at", T.TimestampType(), True),
    T.StructField("ended_at", T.TimestampType(), True),
])


@dataclass
class RunContext:
    """Collects one record per job item; written once, as a batch.

    Every record has its own id: a later run never overwrites an earlier one.
    """
    pipeline: str
    data_referencia: str | None = None
    modo: str = "diario"
    records: list = field(default_factory=list)
    started: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))

    @contextmanager
    def step(self, item: str):
        start = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        facts: dict = {}
        status = "sucesso"
        try:
            yield facts
        except Exception as e:  # recorded, then re-raised
            status = "falha"
            facts["erro"] = f"{type(e).__name__}: {e}"
            facts["traceback"] = traceback.format_exc()
            raise
        finally:
            import json
            import uuid

            facts.setdefault("modo_execucao", self.modo)
            self.records.append((str(uuid.uuid4()), self.pipeline, item, facts.pop("status", status)
                                 if status == "sucesso" else status,
                                 json.dumps(facts, default=str, ensure_ascii=False), self.data_referencia,
                                 start, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)))

    def flush(self, spark: SparkSession, run_log_path: str) -> None:
        if self.records:
            tables.append(spark.createDataFrame(self.records, RUN_LOG_SCHEMA), run_log_path)
            self.records = []


def backfill_range(spark: SparkSession, paths: IngestPaths, start: str, end: str,
                   tables_by_system: dict[str, list[str]] | None = None) -> list[dict]:
    """Read every table's landed days in [start, end] into bronze again, in dependency order.

    One range-filtered batch per table (partition pruning on ``data``), not a
    loop over days. The new lote replaces the earlier rows of the window,
    streamed or not, so re-running a backfill changes nothing.
    """
    facts = []
    for system in SYSTEM_ORDER:
        default = [n for n, s in EVENT_TABLES.items() if s.system == system]
        for t in (tables_by_system.get(system, []) if tables_by_system else default):
            facts.append({"sistema": system, "tabela": t, "inicio": start, "fim": end, **reread_days(spark, paths, t, start, end)})
    return facts


def reprocess_day(spark: SparkSession, paths: IngestPaths, table: str, day: str) -> dict:
    """Read one landed day of one table again; its rows replace the day's earlier ones."""
    return {"tabela": table, "data_referencia": day, "modo_execucao": "reprocessamento", **reread_days(spark, paths, table, day, day)}


# ---- silver -------------------------------------------------------------------

MARK_SCHEMA = T.StructType([T.StructField("lote", T.StringType()), T.StructField("fundido_em", T.TimestampType())])


@dataclass(frozen=True)
class JobPaths:
    """Folders of a deployment below one root."""
    landing: str
    root: str

    @property
    def ingest(self) -> IngestPaths:
        return IngestPaths(self.landing, f"{self.root}/bronze", f"{self.root}/checkpoints")

    def silver(self, t: str) -> str:
        return f"{self.root}/silver/{t}"

    def marks(self, t: str) -> str:
        return f"{self.root}/marcas/{t}"

    def quarantine(self, t: str, lote: str) -> str:
        return f"{self.root}/quarentena/tabela={t}/lote={lote}"

    def gold(self, t: str) -> str:
        return f"{self.root}/gold/{t}"

    def seed(self, t: str) -> str:
        return f"{self.root}/seeds/{t}"

    @property
    def alerts(self) -> str:
        return f"{self.root}/alertas"

    @property
    def runs(self) -> str:
        return f"{self.root}/pipeline_runs"


def pending_lotes(spark: SparkSession, paths: JobPaths, table: str) -> list[str]:
    """Complete lotes that silver hasn't merged yet, in bronze order; the marks hold one row per lote."""
    done = {r["lote"] for r in tables.read_or_empty(spark, paths.marks(table), MARK_SCHEMA, "parquet").select("lote").collect()}
    return [x for x in complete_lotes(spark, paths.ingest, table) if x not in done]


def silver_refresh(spark: SparkSession, paths: JobPaths, table: str) -> dict:
    """Merge the pending lotes of a table into silver, then mark them.

    Reads only those lotes' folders. Any step may fail and be run again:
    quarantine is written per lote over itself, the merge is idempotent, and
    the marks come last, so no row is skipped.
    """
    spec = EVENT_TABLES[table]
    lotes = pending_lotes(spark, paths, table)
    if not lotes:
        return {"status": "sem_dado_novo", "lotes": 0}
    for x in lotes:
        tables.overwrite(sv.quarantine(read_bronze(spark, paths.ingest, table, [x]), spec, (PARTITION_COLUMN, INGESTED_AT)), paths.quarantine(table, x))
    facts = tables.upsert(spark, sv.silver(read_bronze(spark, paths.ingest, table, lotes), spec), paths.silver(table), spec.key,
                          order=[INGESTED_AT, SILVER_PARTITION_COLUMN])
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    tables.append(spark.createDataFrame([(x, now) for x in lotes], MARK_SCHEMA), paths.marks(table))
    return {"lotes": len(lotes), **facts}


def silver_rebuild(spark: SparkSession, paths: JobPaths, table: str) -> dict:
    """Build a silver table again from all current bronze rows (rows deleted by a correction go)."""
    spec = EVENT_TABLES[table]
    lotes = complete_lotes(spark, paths.ingest, table)
    n = tables.replace(spark, sv.silver(read_bronze(spark, paths.ingest, table), spec), paths.silver(table), spec.key).count()
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    tables.overwrite(spark.createDataFrame([(x, now) for x in lotes], MARK_SCHEMA), paths.marks(table))
    return {"lotes": len(lotes), "linhas": n}


QUARANTINE = f"tabela string, chave string, motivos string, registro_bruto string, {PARTITION_COLUMN} string, {INGESTED_AT} timestamp"


def read_quarantine(spark: SparkSession, paths: JobPaths, table: str) -> DataFrame:
    """The table's rows that still wait for a correction: those of days read again since are gone."""
    root = f"{paths.root}/quarentena/tabela={table}"
    if not tables.path_exists(spark, root):
        return spark.createDataFrame([], QUARANTINE)
    stored = spark.read.schema(QUARANTINE).option("basePath", root).parquet(*[f"{root}/{n}" for n in tables.list_names(spark, root)])
    names = [c.split()[0] for c in QUARANTINE.split(", ")]
    return current_rows(stored.select(F.lit(table).alias("tabela"), *names[1:]), _ledger(spark, paths.ingest, table))


def read_silver(spark: SparkSession, paths: JobPaths, table: str) -> DataFrame:
    """A stored silver table without its stamp; empty, with the right types, if it was never loaded."""
    if tables.table_exists(spark, paths.silver(table)):
        return tables.read_table(spark, paths.silver(table)).drop(INGESTED_AT)
    return sv.silver(read_bronze(spark, paths.ingest, table, []), EVENT_TABLES[table]).drop(INGESTED_AT)


# ---- seeds, gold, rules, alerts -------------------------------------------------

def promote_seed(spark: SparkSession, paths: JobPaths, name: str) -> DataFrame:
    """Landed seed file -> typed table; without a file the stored one stays, or an empty one is published."""
    spec = SEEDS[name]
    path = f"{system_dir(paths.landing, spec.system)}/{SEED_DIR}/{name}.json"
    if not tables.path_exists(spark, path) and tables.table_exists(spark, paths.seed(name)):
        return tables.read_table(spark, paths.seed(name))
    raw = tables.read_or_empty(spark, path, bronze_schema(spec.columns)).drop(PARTITION_COLUMN)
    return tables.replace(spark, sv.promote_seed(sv.bronze_copy(raw), spec), paths.seed(name))


def build_gold(spark: SparkSession, paths: JobPaths, ctx: "RunContext") -> dict[str, DataFrame]:
    """Publish the three gold and the three rule tables, one logged step each; each is built once and read back."""
    s = lambda t: read_silver(spark, paths, t)                                      # noqa: E731
    seed = lambda n: tables.read_table(spark, paths.seed(n))                        # noqa: E731
    steps = {
        "gold_reconciliacao_financeira": lambda: gold.reconcile_invoices(s("financeiro_faturas"), s("crm_pedidos")),
        "gold_otif": lambda: gold.otif(s("tms_comprovantes_entrega"), s("tms_remessas")),
        "gold_qualidade_producao": lambda: gold.production_quality(s("erp_lotes_producao")),
        "observability_cadeia_fria": lambda: rules.cold_chain(
            s("tms_remessas"), s("erp_notas_expedicao"), s("erp_lotes_producao"), seed("erp_produtos"), seed("tms_veiculos"),
            s("tms_leituras_temperatura")),
        "observability_qualidade_sku": lambda: rules.sku_validity(s("crm_itens_pedido"), seed("erp_produtos")),
        "observability_estoque_negativo": lambda: rules.negative_stock(s("erp_posicoes_estoque")),
    }
    built = {}
    for name, make in steps.items():
        with ctx.step(f"gold:{name}") as facts:
            built[name] = tables.replace(spark, make(), paths.gold(name))
            facts["total_linhas"] = built[name].count()
    return built


CLOSE_TABLE = "gold_fechamento_mensal"


def read_runs(spark: SparkSession, paths: JobPaths) -> DataFrame:
    return tables.read_or_empty(spark, paths.runs, RUN_LOG_SCHEMA, "parquet")


def close_months(spark: SparkSession, paths: JobPaths, built: dict[str, DataFrame], when: dt.datetime,
                 systems: tuple[str, ...] = tuple(SYSTEM_ORDER)) -> dict:
    """Open what has to be closed, then close it: two merges by month, so a run that dies between them is taken up by the next.

    A month is judged by the runs of every system, on its own calendar; the
    finance system's months lead. A closed month whose missing run has landed,
    or whose amounts have changed, reopens and is closed again.
    """
    ordered = ("financeiro", *[s for s in systems if s != "financeiro"])
    log = runs.system_runs(read_runs(spark, paths), {t: spec.system for t, spec in EVENT_TABLES.items()})
    now = tables.materialize(spark, close.monthly_close(built["gold_reconciliacao_financeira"], read_silver(spark, paths, "financeiro_contas_receber"),
                                                        log, ordered), "close")
    path, at = paths.gold(CLOSE_TABLE), F.lit(when)
    stored = tables.read_table(spark, path) if tables.table_exists(spark, path) else _no_months(now)
    tables.upsert(spark, close.months_to_open(now, stored, at), path, "mes_referencia")
    due = tables.materialize(spark, close.months_to_close(now, tables.read_table(spark, path), at), "close-due")
    tables.upsert(spark, due, path, "mes_referencia")
    return {r["estado"]: r["n"] for r in due.groupBy("estado").agg(F.count(F.lit(1)).alias("n")).collect()}


def _no_months(now: DataFrame) -> DataFrame:
    return now.withColumn("estado", F.lit("")).withColumn("reaberturas", F.lit(0)).withColumn("atualizado_em", F.lit(None).cast("timestamp")).limit(0)


def raise_alerts(spark: SparkSession, paths: JobPaths, built: dict[str, DataFrame], when: dt.datetime) -> dict:
    """All four families from the published tables and the run log, merged by id.

    An alert raised again keeps one row, with the new time; one whose cause is
    gone is resolved.
    """
    at = F.lit(when)
    found = alerts.all_alerts(alerts.cold_chain_alerts(built["observability_cadeia_fria"], at),
                              alerts.reconciliation_alerts(built["gold_reconciliacao_financeira"], at),
                              alerts.run_sla_alerts(runs.run_sla_breach(read_runs(spark, paths))),
                              close.close_alerts(tables.read_table(spark, paths.gold(CLOSE_TABLE)), at))
    found = tables.materialize(spark, found, "alerts")
    stored = tables.read_table(spark, paths.alerts) if tables.table_exists(spark, paths.alerts) else None
    return tables.upsert(spark, alerts.tracked(found, stored, at), paths.alerts, "alerta_id")


def apply_retention(spark: SparkSession, paths: JobPaths, days: int, day: str | None = None, dry_run: bool = True) -> dict:
    """Plan retention over every system from the listing and the file ledger; remove what may go unless dry_run."""
    plan = tables.materialize(spark, retention.retention_plan(
        retention.landing_files(spark, paths.landing, tuple(SYSTEM_ORDER)), file_ledger(spark, paths.ingest), days, day), "retention")
    counts = {r["acao"]: r["n"] for r in plan.groupBy("acao").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {**counts, "dry_run": dry_run, "particoes": retention.apply_retention(spark, paths.landing, plan, dry_run)}


def daily_job(spark: SparkSession, landing: str, root: str, day: str | None = None, retention_days: int = 30,
              remove_old: bool = False) -> RunContext:
    """Ingest, silver, seeds, gold, rules, close, alerts, retention; every step logged, the log written whatever happens.

    A table that fails stops neither the other tables nor its own next run:
    silver catches up with every lote that isn't marked. Gold is built only if
    all of silver is current; the first error is raised at the end.
    """
    paths, ctx = JobPaths(landing, root), RunContext("diario", day)
    ordered = [t for system in SYSTEM_ORDER for t, spec in EVENT_TABLES.items() if spec.system == system]
    errors: list[Exception] = []

    def guarded(item, work):
        try:
            with ctx.step(item) as facts:
                facts.update(work())
        except Exception as e:
            errors.append(e)

    def ingested(r):
        if r["erro"]:
            raise RuntimeError(r["erro"])
        return {**{k: r[k] for k in ("linhas_processadas", "arquivos_processados", "lotes")},
                "status": "sucesso" if r["linhas_processadas"] else "sem_dado_novo"}

    try:
        # All streams run together; one log record per table once they finish.
        with ctx.step("ingest"):
            results = ingest_tables(spark, paths.ingest, ordered)
        for r in results:
            guarded(f"ingest:{r['tabela']}", lambda r=r: ingested(r))
        for t in ordered:
            guarded(f"silver:{t}", lambda t=t: silver_refresh(spark, paths, t))
        for n in SEEDS:
            guarded(f"seed:{n}", lambda n=n: {"linhas": promote_seed(spark, paths, n).count()})
        if not errors:
            built = build_gold(spark, paths, ctx)
            with ctx.step("gold:resumo") as facts:
                summary = tables.replace(spark, gold.gold_summary(
                    built["gold_reconciliacao_financeira"], built["gold_otif"], built["gold_qualidade_producao"],
                    built["observability_cadeia_fria"], built["observability_qualidade_sku"],
                    built["observability_estoque_negativo"]), paths.gold("resumo"))
                facts["tabelas"] = summary.count()
            ctx.flush(spark, paths.runs)        # the close and the alerts read today's records too
            guarded("fechamento", lambda: close_months(spark, paths, built, ctx.started))
            guarded("alertas", lambda: raise_alerts(spark, paths, built, ctx.started))
            guarded("retencao", lambda: apply_retention(spark, paths, retention_days, day, dry_run=not remove_old))
    finally:
        ctx.flush(spark, paths.runs)
    if errors:
        raise errors[0]
    return ctx
