"""Independent DuckDB SQL for the oracle check.

Mirrors the fixture views (``tidewater.sources.fixtures``) and the cleaning
rules (``tidewater.functions.clean``) as SQL text over the driver's
pre-registered tables, so each ``queries()`` key can be compared with a
query written separately in another engine. Nothing here runs on Spark.
"""

from __future__ import annotations

from ..functions.clean import BR_NUMBER_PATTERN, MONEY_PATTERN, NULL_SPELLINGS
from ..spec import EVENT_TABLES, SILVER_PARTITION_COLUMN, TableSpec

# ---- fixture text helpers --------------------------------------------------


def num(x: str, places: int = 2) -> str:
    return f"translate(format('{{:,.{places}f}}', CAST({x} AS DOUBLE)), ',.', '.,')"


def dmy(d: str) -> str:
    return f"strftime({d}, '%d/%m/%Y')"


def iso(d: str) -> str:
    return f"strftime({d}, '%Y-%m-%d')"


def mixed(d: str, k: str) -> str:
    return f"(CASE WHEN {k} % 2 = 0 THEN {dmy(d)} ELSE {iso(d)} END)"


def caps(s: str, k: str) -> str:
    return (f"(CASE {k} % 4 WHEN 0 THEN upper({s}) WHEN 1 THEN lower({s}) "
            f"WHEN 2 THEN ' ' || {s} || ' ' ELSE {s} || ' ' END)")


def padded(p: str, k: str) -> str:
    return f"('{p}' || lpad(CAST({k} AS VARCHAR), 9, '0'))"


def tagged(p: str, k: str) -> str:
    return f"('{p}' || CAST({k} AS VARCHAR))"


def plus_days(d: str, n: str) -> str:
    return f"CAST(CAST({d} AS DATE) + CAST({n} AS INTEGER) AS DATE)"


DAY = "CAST(o_orderdate AS DATE)"
K = "o_orderkey"

FIXTURES: dict[str, str] = {
    "crm_pedidos": f"""SELECT {padded('PED-', K)} AS pedido_id, {tagged('CLI-', 'o_custkey')} AS cliente_id,
 'REP-00' || CAST(o_custkey % 8 + 1 AS VARCHAR) AS representante_id,
 CASE WHEN {K} % 50 = 7 THEN 'N/A' ELSE {mixed(DAY, K)} END AS data_pedido,
 CASE WHEN {K} % 97 = 0 THEN 'NULL' ELSE {num('o_totalprice')} END AS valor_total,
 {caps("CASE o_orderstatus WHEN 'P' THEN 'aberto' WHEN 'F' THEN 'concluido' ELSE 'cancelado' END", K)} AS status_pedido,
 {iso(DAY)} AS data FROM orders""",
    "crm_itens_pedido": f"""SELECT 'ITEM-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS item_pedido_id,
 {padded('PED-', 'l_orderkey')} AS pedido_id,
 CASE WHEN (l_orderkey + l_linenumber) % 33 = 0 THEN 'PROD-999' ELSE 'PROD-00' || CAST(l_partkey % 3 + 1 AS VARCHAR) END AS produto_id,
 CASE WHEN (l_orderkey + l_linenumber) % 40 = 3 THEN {num('l_quantity', 0)} || ',996' ELSE {num('l_quantity', 0)} END AS quantidade,
 CASE WHEN (l_orderkey + l_linenumber) % 250 = 11 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
      ELSE {num('l_extendedprice')} END AS preco_unitario,
 {iso('CAST(l_shipdate AS DATE)')} AS data FROM lineitem""",
    "erp_lotes_producao": f"""SELECT {tagged('LOTE-', 'p_partkey')} AS lote_id,
 CASE WHEN p_partkey % 40 = 0 THEN 'PROD-777' ELSE 'PROD-00' || CAST(p_partkey % 3 + 1 AS VARCHAR) END AS produto_id,
 {caps("CASE WHEN p_size % 2 = 0 THEN 'CP01' ELSE 'CP02' END", 'p_partkey')} AS centro_producao_id,
 {mixed(plus_days("DATE '1995-01-01'", 'p_partkey % 365'), 'p_partkey')} AS data_fabricacao,
 {mixed(plus_days("DATE '1996-01-01'", 'p_partkey % 730'), 'p_partkey')} AS data_validade,
 {num('p_retailprice')} AS quantidade_produzida,
 {caps("CASE WHEN p_partkey % 9 = 4 THEN 'reprovado' ELSE 'aprovado' END", 'p_partkey')} AS status_qc,
 CASE WHEN p_partkey % 9 = 4 THEN '' ELSE {mixed(plus_days("DATE '1995-01-03'", 'p_partkey % 365'), 'p_partkey')} END AS data_liberacao,
 {iso(plus_days("DATE '1995-01-01'", 'p_partkey % 365'))} AS data FROM part""",
    "erp_notas_expedicao": f"""SELECT {tagged('NOTA-', K)} AS nota_expedicao_id, {padded('PED-', K)} AS pedido_id,
 CASE WHEN {K} % 7 = 0 THEN 'LOTE-X' ELSE {tagged('LOTE-', 'o_custkey')} END AS lote_id,
 CASE WHEN {K} % 53 = 9 THEN 'N/A' ELSE {caps(f"CASE WHEN {K} % 3 = 0 THEN 'CD01' ELSE 'CD02' END", K)} END AS centro_distribuicao_id,
 {num(f'{K} % 50 + 1', 0)} AS quantidade_expedida,
 {mixed(plus_days(DAY, '1'), K)} AS data_expedicao,
 {iso(plus_days(DAY, '1'))} AS data FROM orders""",
    "tms_remessas": f"""SELECT {padded('REM-', K)} AS remessa_id, {tagged('NOTA-', K)} AS nota_expedicao_id,
 {padded('PED-', K)} AS pedido_id, 'ROTA-00' || CAST({K} % 4 + 1 AS VARCHAR) AS rota_id,
 CASE WHEN {K} % 101 = 0 THEN 'VEI-099' ELSE 'VEI-00' || CAST({K} % 6 + 1 AS VARCHAR) END AS veiculo_id,
 {num(f'{K} % 4 * 8 + 8', 0)} AS sla_horas_contratado,
 {mixed(plus_days(DAY, '1'), K)} AS data_expedicao,
 {mixed(plus_days(DAY, '3'), K)} AS data_entrega_prevista,
 {iso(plus_days(DAY, '1'))} AS data FROM orders""",
    "tms_leituras_temperatura": f"""SELECT {tagged('LEIT-', 'event_id')} AS leitura_id, {padded('REM-', 'event_id')} AS remessa_id,
 CASE WHEN event_id % 90 = 11 THEN '10:30' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS timestamp_leitura,
 CASE event_id % 80 WHEN 7 THEN '8,004' WHEN 27 THEN '1,996' WHEN 47 THEN '-0,004' ELSE {num('CASE WHEN event_id % 20 = 4 THEN (event_id % 60) / 10 + 9 ELSE (event_id % 60) / 10 + 2 END')} END AS temperatura_celsius,
 {iso('CAST(ts AS DATE)')} AS data FROM events""",
    "tms_comprovantes_entrega": f"""SELECT {tagged('POD-', K)} AS comprovante_id, {padded('REM-', K)} AS remessa_id,
 {mixed(plus_days(DAY, f'CASE WHEN {K} % 19 = 0 THEN 6 WHEN {K} % 19 < 4 THEN 4 ELSE 3 END'), K)} AS data_entrega_real,
 {caps(f"CASE WHEN {K} % 19 = 0 THEN 'devolvida' WHEN {K} % 19 < 4 THEN 'atrasada' ELSE 'entregue' END", K)} AS status_entrega,
 CASE WHEN {K} % 14 <> 0 THEN 'true' WHEN {K} % 3 = 0 THEN 'N/A' WHEN {K} % 3 = 1 THEN '' ELSE NULL END AS pod_confirmado,
 {iso(plus_days(DAY, f'CASE WHEN {K} % 19 = 0 THEN 6 WHEN {K} % 19 < 4 THEN 4 ELSE 3 END'))} AS data FROM orders""",
    "financeiro_faturas": f"""SELECT {tagged('FAT-', K)} AS fatura_id,
 CASE WHEN {K} % 61 = 5 THEN 'PED-ORFAO' ELSE {padded('PED-', K)} END AS pedido_id,
 {padded('REM-', K)} AS remessa_id,
 {num(f'CASE WHEN {K} % 25 < 2 THEN o_totalprice + 12.34 ELSE o_totalprice END')} AS valor_faturado,
 {mixed(plus_days(DAY, f'{K} % 3 + 3'), K)} AS data_faturamento,
 CASE WHEN {K} % 33 = 0 THEN 'NULL' ELSE 'CC-00' || CAST({K} % 5 + 1 AS VARCHAR) END AS centro_custo_id,
 {iso(plus_days(DAY, f'{K} % 3 + 3'))} AS data FROM orders WHERE {K} % 14 <> 0 OR {K} % 98 = 0""",
    "financeiro_contas_receber": f"""SELECT {tagged('CR-', K)} AS conta_receber_id, {tagged('FAT-', K)} AS fatura_id,
 {mixed(plus_days(DAY, '33'), K)} AS data_vencimento,
 CASE WHEN {K} % 5 < 3 THEN {mixed(plus_days(DAY, f'{K} % 11 + 28'), K)} ELSE 'N/A' END AS data_recebimento,
 {caps(f"CASE WHEN {K} % 5 < 3 THEN 'recebido' ELSE 'em aberto' END", K)} AS status_conta,
 {iso(plus_days(DAY, f'{K} % 3 + 3'))} AS data FROM orders WHERE {K} % 14 <> 0""",
    "erp_posicoes_estoque": f"""SELECT {tagged('POS-', 'c_custkey')} AS posicao_id, {tagged('LOTE-', 'c_custkey')} AS lote_id,
 CASE WHEN c_custkey % 29 = 3 THEN '' ELSE {caps("CASE WHEN c_custkey % 2 = 0 THEN 'CD01' ELSE 'CD02' END", 'c_custkey')} END AS centro_distribuicao_id,
 {num('floor(c_acctbal)', 0)} AS quantidade,
 {mixed(plus_days("DATE '1996-01-01'", 'c_custkey * 5 % 700'), 'c_custkey')} AS data_posicao,
 {iso(plus_days("DATE '1996-01-01'", 'c_custkey * 5 % 700'))} AS data FROM customer""",
    "crm_atendimento": f"""SELECT {tagged('INT-', 'event_id')} AS interacao_id, {tagged('CLI-', 'user_id')} AS cliente_id,
 CASE WHEN event_id % 10 = 0 THEN {tagged('LOTE-', 'user_id')} WHEN event_id % 3 = 0 THEN 'N/A' ELSE '' END AS lote_id,
 {caps("CASE event_type WHEN 'error' THEN 'reclamacao' WHEN 'view' THEN 'duvida' WHEN 'purchase' THEN 'elogio' ELSE 'solicitacao' END", 'event_id')} AS tipo_interacao,
 props AS descricao,
 CASE event_id % 250 WHEN 13 THEN 'ontem' WHEN 63 THEN '01/02/99/2026' WHEN 113 THEN '1/2/3/2026' WHEN 163 THEN '31/02/2026' ELSE {mixed('CAST(ts AS DATE)', 'event_id')} END AS data_interacao,
 {iso('CAST(ts AS DATE)')} AS data FROM events""",
}

SEEDS: dict[str, str] = {
    "erp_produtos": """SELECT * FROM (VALUES
 ('PROD-001', 'Produto 001', 'comprimido', 'false', '730'),
 ('PROD-002', 'Produto 002', 'injetavel', 'true', '365'),
 ('PROD-003', 'Produto 003', 'xarope', 'false', '180'))
 t(produto_id, nome_produto, forma_farmaceutica, exige_cadeia_fria, validade_padrao_dias)""",
    "tms_veiculos": """SELECT * FROM (VALUES
 ('VEI-001', 'PLACA-001', 'furgao', 'false'), ('VEI-002', 'PLACA-002', 'carreta', 'false'),
 ('VEI-003', 'PLACA-003', 'carreta', 'true'), ('VEI-004', 'PLACA-004', 'furgao', 'false'),
 ('VEI-005', 'PLACA-005', 'carreta', 'true'), ('VEI-006', 'PLACA-006', 'furgao', 'false'))
 t(veiculo_id, placa, tipo_veiculo, refrigerado)""",
    "tms_rotas": """SELECT * FROM (VALUES
 ('ROTA-001', 'Litoral', '7'), ('ROTA-002', 'Serra', '20'), ('ROTA-003', 'Planalto', '31'),
 ('ROTA-004', 'Interior', '13')) t(rota_id, regiao_destino, tempo_transito_padrao_horas)""",
    "financeiro_centros_custo": """SELECT * FROM (VALUES
 ('CC-001', 'Fábrica'), ('CC-002', 'Armazéns'), ('CC-003', 'Frota'),
 ('CC-004', 'Vendas')) t(centro_custo_id, nome_centro_custo)""",
    "crm_representantes": """SELECT * FROM (VALUES
 ('REP-001', 'Representante 001', 'Sudeste'), ('REP-002', 'Representante 002', 'Sul'),
 ('REP-003', 'Representante 003', 'Nordeste'), ('REP-004', 'Representante 004', 'Centro-Oeste'),
 ('REP-005', 'Representante 005', 'Norte'), ('REP-006', 'Representante 006', 'Sudeste'),
 ('REP-007', 'Representante 007', 'Sul'), ('REP-008', 'Representante 008', 'Nordeste'))
 t(representante_id, nome_representante, regiao)""",
    "crm_clientes": """SELECT 'CLI-' || CAST(c_custkey AS VARCHAR) AS cliente_id, c_name AS nome_cliente,
 'contato' || CAST(c_custkey AS VARCHAR) || '@cliente.example' AS email_contato, r_name AS regiao,
 CASE WHEN c_custkey % 20 = 0 THEN 'bloqueado' ELSE 'ativo' END AS status_cliente
 FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
}

# Typed silver seeds (bronze text -> typed).
SEED_TYPED: dict[str, str] = {
    "erp_produtos": "SELECT produto_id, nome_produto, forma_farmaceutica, {b} AS exige_cadeia_fria, "
                    "TRY_CAST(validade_padrao_dias AS BIGINT) AS validade_padrao_dias FROM bz_erp_produtos",
    "tms_veiculos": "SELECT veiculo_id, placa, tipo_veiculo, {b2} AS refrigerado FROM bz_tms_veiculos",
    "tms_rotas": "SELECT rota_id, regiao_destino, TRY_CAST(tempo_transito_padrao_horas AS BIGINT) "
                 "AS tempo_transito_padrao_horas FROM bz_tms_rotas",
    "financeiro_centros_custo": "SELECT * FROM bz_financeiro_centros_custo",
    "crm_representantes": "SELECT * FROM bz_crm_representantes",
    "crm_clientes": "SELECT * FROM bz_crm_clientes",
}

# ---- cleaning rules as SQL -------------------------------------------------

_NULLS = ", ".join(f"'{v}'" for v in NULL_SPELLINGS)


def strip(x: str) -> str:
    from ..functions.clean import EDGE_SPACE_CODES

    chars = " || ".join(f"chr({c})" for c in EDGE_SPACE_CODES)
    return f"trim({x}, {chars})"


def nv(x: str) -> str:
    return f"({x} IS NULL OR lower({strip(x)}) IN ({_NULLS}))"


def c_date(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN NOT {nv(x)} THEN CAST(coalesce(try_strptime({s}, '%d/%m/%Y'), "
            f"try_strptime({s}, '%Y-%m-%d')) AS DATE) END)")


def c_money(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN NOT {nv(x)} AND regexp_full_match({s}, '{MONEY_PATTERN}') THEN "
            f"TRY_CAST(replace(replace({s}, '.', ''), ',', '.') AS DECIMAL(18,2)) END)")


def c_int(x: str) -> str:
    # Truncation toward zero: what stands before the decimal comma.
    s = strip(x)
    return (f"(CASE WHEN NOT {nv(x)} AND regexp_full_match({s}, '{BR_NUMBER_PATTERN}') THEN "
            f"TRY_CAST(replace(split_part({s}, ',', 1), '.', '') AS BIGINT) END)")


def c_measure(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN NOT {nv(x)} AND regexp_full_match({s}, '{BR_NUMBER_PATTERN}') THEN "
            f"TRY_CAST(replace(replace({s}, '.', ''), ',', '.') AS DOUBLE) END)")


def c_text(x: str) -> str:
    return f"(CASE WHEN NOT {nv(x)} THEN lower({strip(x)}) END)"


def c_fk(x: str) -> str:
    return f"(CASE WHEN NOT {nv(x)} THEN {x} END)"


def c_bool(x: str) -> str:
    return f"(CASE WHEN NOT {nv(x)} THEN lower({strip(x)}) = 'true' END)"


def c_ts(x: str) -> str:
    # Year first: a bare time of day is no timestamp.
    return f"(CASE WHEN NOT {nv(x)} AND {strip(x)} LIKE '____-%' THEN TRY_CAST({strip(x)} AS TIMESTAMP) END)"


_PARSERS = {"dates": c_date, "integers": c_int, "money": c_money, "measures": c_measure,
            "texts": c_text, "nullable_fks": c_fk, "booleans": c_bool, "timestamps": c_ts,
            "plain": lambda x: x}
_CAN_FAIL = {"dates", "integers", "money", "measures", "timestamps"}


def reasons(spec: TableSpec) -> str:
    """List of reasons a bronze row cannot be trusted (NULL entries removed)."""
    out = []
    for c in spec.columns:
        cat = spec.category(c)
        if cat in _CAN_FAIL:
            out.append(f"CASE WHEN NOT {nv(c)} AND {_PARSERS[cat](c)} IS NULL THEN '{c}:{cat}' END")
    out.append(f"CASE WHEN {nv(spec.key)} THEN '{spec.key}:chave_nula' END")
    return f"list_filter([{', '.join(out)}], lambda x: x IS NOT NULL)"


def cleansed(spec: TableSpec, src: str) -> str:
    """Typed columns + data_particao_ingestao + _motivos from a bronze view."""
    cols = [f"{_PARSERS[spec.category(c)](c)} AS {c}" for c in spec.columns]
    return (f"SELECT {', '.join(cols)}, data AS {SILVER_PARTITION_COLUMN}, {reasons(spec)} AS _motivos "
            f"FROM {src}")


def silver_sql(spec: TableSpec, src: str) -> str:
    """Latest trusted row per key: same total order as the Spark max(struct)."""
    rest = [c for c in spec.columns if c != spec.key]
    order = [SILVER_PARTITION_COLUMN] + rest
    order_by = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    cols = ", ".join(list(spec.columns) + [SILVER_PARTITION_COLUMN])
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {spec.key} ORDER BY {order_by}) AS _rn "
            f"FROM ({cleansed(spec, src)}) WHERE len(_motivos) = 0 AND {spec.key} IS NOT NULL) WHERE _rn = 1")


# ---- CTE assembly ----------------------------------------------------------

def _deps() -> dict[str, tuple[str, str]]:
    """CTE name -> (SQL, kind). bz_* bronze fixtures, sv_* silver, sd_* typed seeds."""
    out = {}
    for t, sql in FIXTURES.items():
        out[f"bz_{t}"] = sql
        out[f"cl_{t}"] = cleansed(EVENT_TABLES[t], f"bz_{t}")
        out[f"sv_{t}"] = silver_sql(EVENT_TABLES[t], f"bz_{t}")
    for s, sql in SEEDS.items():
        out[f"bz_{s}"] = sql
        out[f"sd_{s}"] = SEED_TYPED[s].format(b=c_bool("exige_cadeia_fria"), b2=c_bool("refrigerado"))
    return out


CTES = _deps()


def _needed(body: str) -> list[str]:
    """CTE names referenced by ``body``, dependencies first."""
    import re

    order: list[str] = []

    def visit(name: str):
        if name in order:
            return
        for dep in re.findall(r"\b((?:bz|cl|sv|sd)_[a-z_]+)\b", CTES[name]):
            if dep in CTES and dep != name:
                visit(dep)
        order.append(name)

    for name in re.findall(r"\b((?:bz|cl|sv|sd)_[a-z_]+)\b", body):
        if name in CTES:
            visit(name)
    return order


def with_fixtures(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the fixture/silver CTEs it references.

    ``extra`` are additional (name, sql) CTEs, placed after the fixtures.
    """
    text = body + " " + " ".join(sql for _, sql in (extra or []))
    names = _needed(text)
    parts = [f"{n} AS ({CTES[n]})" for n in names] + [f"{n} AS ({sql})" for n, sql in (extra or [])]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


RUNS_SQL = """SELECT item || '-' || strftime(d, '%Y-%m-%d') AS execucao_id, 'gerar_dados' AS pipeline, item,
 CASE WHEN item = 'financeiro' AND isodow(d) IN (6, 7) THEN 'dia_nao_operacional'
      WHEN item = 'tms' AND isodow(d) = 7 THEN 'dia_nao_operacional'
      WHEN item = 'tms' AND day(d) = 10 THEN 'falha' ELSE 'sucesso' END AS status,
 '{"modo_execucao":"' || CASE WHEN item = 'tms' AND day(d) = 11 THEN 'reprocessamento' ELSE 'diario' END || '"}' AS detalhes,
 strftime(d, '%Y-%m-%d') AS data_referencia,
 CAST(d AS TIMESTAMP) + to_seconds(21600 + (CASE item WHEN 'financeiro' THEN 0 WHEN 'tms' THEN 1 ELSE 2 END) * 600) AS started_at,
 CAST(d AS TIMESTAMP) + to_seconds(21600 + (CASE item WHEN 'financeiro' THEN 0 WHEN 'tms' THEN 1 ELSE 2 END) * 600
   + (dayofyear(d) * 37 + (CASE item WHEN 'financeiro' THEN 0 WHEN 'tms' THEN 1 ELSE 2 END) * 101) % 1000 + 120) AS ended_at
 FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) days,
      (VALUES ('financeiro'), ('tms'), ('crm')) items(item)
 WHERE NOT (month(d) % 3 = 0 AND day(d) IN (9, 17))"""

CTES["bz_runs"] = RUNS_SQL


def operates_sql(system: str, day: str) -> str:
    """Oracle twin of ``functions.calendar.operates_on``."""
    from ..spec import SYSTEM_CALENDARS

    whens = " ".join(f"WHEN '{s}' THEN isodow({day}) IN ({', '.join(map(str, d))})"
                     for s, d in SYSTEM_CALENDARS.items())
    return f"(CASE {system} {whens} END)"


def days_sql(start: str, end: str) -> str:
    return f"CAST(unnest(generate_series(CAST({start} AS DATE), CAST({end} AS DATE), INTERVAL 1 DAY)) AS DATE)"


# Months from the first finance run up to the month before the last run day.
FIN_MONTHS = """SELECT CAST(unnest(generate_series(CAST(date_trunc('month', min(dia)) AS DATE),
   CAST(date_trunc('month', max(dia)) - INTERVAL 1 MONTH AS DATE), INTERVAL 1 MONTH)) AS DATE) AS mes
 FROM (SELECT CAST(data_referencia AS DATE) AS dia FROM bz_runs WHERE pipeline = 'gerar_dados' AND item = 'financeiro')"""

BUSINESS_DAYS = f"""SELECT mes, dia FROM (SELECT mes, {days_sql('mes', 'last_day(mes)')} AS dia FROM ({FIN_MONTHS}))
 WHERE {operates_sql("'financeiro'", 'dia')}"""

MISSING_DAYS = f"""SELECT mes, dia FROM ({BUSINESS_DAYS}) WHERE dia NOT IN
 (SELECT CAST(data_referencia AS DATE) FROM bz_runs WHERE pipeline = 'gerar_dados' AND item = 'financeiro' AND status = 'sucesso')"""
