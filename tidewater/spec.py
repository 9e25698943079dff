"""Table specifications: data, no logic.

One :class:`TableSpec` per silver event table says which raw (all-string)
bronze column is cleaned by which column function. Unlisted columns stay
text. Seeds carry only casts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Ingest partition column in bronze and its silver name.
PARTITION_COLUMN = "data"
SILVER_PARTITION_COLUMN = "data_particao_ingestao"
# Ingest stamp of stored bronze and silver rows: the later arrival wins.
INGESTED_AT = "_ingerido_em"


@dataclass(frozen=True)
class TableSpec:
    name: str
    system: str
    key: str
    columns: tuple[str, ...]          # raw bronze columns, in order (partition excluded)
    dates: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    money: tuple[str, ...] = ()       # decimal(18,2)
    measures: tuple[str, ...] = ()    # double (sensor readings)
    texts: tuple[str, ...] = ()
    nullable_fks: tuple[str, ...] = ()
    booleans: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()

    def category(self, column: str) -> str:
        for cat in ("dates", "integers", "money", "measures", "texts",
                    "nullable_fks", "booleans", "timestamps"):
            if column in getattr(self, cat):
                return cat
        return "plain"


@dataclass(frozen=True)
class SeedSpec:
    name: str
    system: str
    key: str
    columns: tuple[str, ...]
    booleans: tuple[str, ...] = ()
    integers: tuple[str, ...] = field(default=())


# The eleven event tables, their business keys and column roles.
EVENT_TABLES: dict[str, TableSpec] = {s.name: s for s in [
    TableSpec("erp_lotes_producao", "erp", "lote_id",
              ("lote_id", "produto_id", "centro_producao_id", "data_fabricacao", "data_validade",
               "quantidade_produzida", "status_qc", "data_liberacao"),
              dates=("data_fabricacao", "data_validade", "data_liberacao"),
              integers=("quantidade_produzida",),
              texts=("centro_producao_id", "status_qc")),
    TableSpec("erp_posicoes_estoque", "distribution", "posicao_id",
              ("posicao_id", "lote_id", "centro_distribuicao_id", "quantidade", "data_posicao"),
              dates=("data_posicao",), integers=("quantidade",),
              texts=("centro_distribuicao_id",)),
    TableSpec("erp_notas_expedicao", "distribution", "nota_expedicao_id",
              ("nota_expedicao_id", "pedido_id", "lote_id", "centro_distribuicao_id",
               "quantidade_expedida", "data_expedicao"),
              dates=("data_expedicao",), integers=("quantidade_expedida",),
              texts=("centro_distribuicao_id",)),
    TableSpec("crm_pedidos", "crm", "pedido_id",
              ("pedido_id", "cliente_id", "representante_id", "data_pedido", "valor_total",
               "status_pedido"),
              dates=("data_pedido",), money=("valor_total",), texts=("status_pedido",)),
    TableSpec("crm_itens_pedido", "crm", "item_pedido_id",
              ("item_pedido_id", "pedido_id", "produto_id", "quantidade", "preco_unitario"),
              integers=("quantidade",), money=("preco_unitario",)),
    TableSpec("crm_atendimento", "crm", "interacao_id",
              ("interacao_id", "cliente_id", "lote_id", "tipo_interacao", "descricao",
               "data_interacao"),
              dates=("data_interacao",), texts=("tipo_interacao",), nullable_fks=("lote_id",)),
    TableSpec("tms_remessas", "tms", "remessa_id",
              ("remessa_id", "nota_expedicao_id", "pedido_id", "rota_id", "veiculo_id",
               "sla_horas_contratado", "data_expedicao", "data_entrega_prevista"),
              dates=("data_expedicao", "data_entrega_prevista"),
              integers=("sla_horas_contratado",)),
    TableSpec("tms_leituras_temperatura", "tms", "leitura_id",
              ("leitura_id", "remessa_id", "timestamp_leitura", "temperatura_celsius"),
              measures=("temperatura_celsius",), timestamps=("timestamp_leitura",)),
    TableSpec("tms_comprovantes_entrega", "tms", "comprovante_id",
              ("comprovante_id", "remessa_id", "data_entrega_real", "status_entrega",
               "pod_confirmado"),
              dates=("data_entrega_real",), texts=("status_entrega",),
              booleans=("pod_confirmado",)),
    TableSpec("financeiro_faturas", "financeiro", "fatura_id",
              ("fatura_id", "pedido_id", "remessa_id", "valor_faturado", "data_faturamento",
               "centro_custo_id"),
              dates=("data_faturamento",), money=("valor_faturado",),
              nullable_fks=("centro_custo_id",)),
    TableSpec("financeiro_contas_receber", "financeiro", "conta_receber_id",
              ("conta_receber_id", "fatura_id", "data_vencimento", "data_recebimento",
               "status_conta"),
              dates=("data_vencimento", "data_recebimento"), texts=("status_conta",)),
]}

# The six seed catalogues.
SEEDS: dict[str, SeedSpec] = {s.name: s for s in [
    SeedSpec("erp_produtos", "erp", "produto_id",
             ("produto_id", "nome_produto", "forma_farmaceutica", "exige_cadeia_fria",
              "validade_padrao_dias"),
             booleans=("exige_cadeia_fria",), integers=("validade_padrao_dias",)),
    SeedSpec("crm_representantes", "crm", "representante_id",
             ("representante_id", "nome_representante", "regiao")),
    SeedSpec("crm_clientes", "crm", "cliente_id",
             ("cliente_id", "nome_cliente", "email_contato", "regiao", "status_cliente")),
    SeedSpec("tms_veiculos", "tms", "veiculo_id",
             ("veiculo_id", "placa", "tipo_veiculo", "refrigerado"), booleans=("refrigerado",)),
    SeedSpec("tms_rotas", "tms", "rota_id",
             ("rota_id", "regiao_destino", "tempo_transito_padrao_horas"),
             integers=("tempo_transito_padrao_horas",)),
    SeedSpec("financeiro_centros_custo", "financeiro", "centro_custo_id",
             ("centro_custo_id", "nome_centro_custo")),
]}

# Operating calendar per system, as ISO weekdays (Monday = 1).
SYSTEM_CALENDARS: dict[str, tuple[int, ...]] = {
    "erp": (1, 2, 3, 4, 5),
    "distribution": (1, 2, 3, 4, 5, 6),
    "crm": (1, 2, 3, 4, 5, 6, 7),
    "tms": (1, 2, 3, 4, 5, 6),
    "financeiro": (1, 2, 3, 4, 5),
}

# Dependency order of the systems in a backfill.
SYSTEM_ORDER = ("crm", "erp", "distribution", "tms", "financeiro")
