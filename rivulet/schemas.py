"""Table schemas, defaults, generated columns and change-feed routing.

One place for the data model: the six transactional tables (source side), the
replica's insert defaults, and the topic routing of the change feed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

D15_2 = T.DecimalType(15, 2)
D5_2 = T.DecimalType(5, 2)
D8_2 = T.DecimalType(8, 2)
D8_3 = T.DecimalType(8, 3)


def _s(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


CLIENTES = _s(
    ("id", T.LongType()), ("nome", T.StringType()), ("email", T.StringType()),
    ("telefone", T.StringType()), ("cpf", T.StringType()), ("data_nascimento", T.DateType()),
    ("endereco", T.StringType()), ("status", T.StringType()), ("tipo_cliente", T.StringType()),
    ("limite_credito", D15_2), ("data_cadastro", T.TimestampType()),
    ("updated_at", T.TimestampType()), ("created_by", T.StringType()), ("version", T.IntegerType()),
)

PEDIDOS = _s(
    ("id", T.LongType()), ("cliente_id", T.LongType()), ("numero_pedido", T.StringType()),
    ("data_pedido", T.TimestampType()), ("status", T.StringType()), ("valor_bruto", D15_2),
    ("desconto", D15_2), ("valor_liquido", D15_2), ("metodo_pagamento", T.StringType()),
    ("canal_venda", T.StringType()), ("observacoes", T.StringType()),
    ("data_entrega_prevista", T.DateType()), ("data_entrega_real", T.DateType()),
    ("updated_at", T.TimestampType()), ("created_by", T.StringType()), ("version", T.IntegerType()),
)

PRODUTOS = _s(
    ("id", T.LongType()), ("codigo_produto", T.StringType()), ("nome", T.StringType()),
    ("categoria", T.StringType()), ("subcategoria", T.StringType()), ("marca", T.StringType()),
    ("preco_custo", D15_2), ("preco_venda", D15_2), ("margem_lucro", D5_2),
    ("estoque_atual", T.IntegerType()), ("estoque_minimo", T.IntegerType()),
    ("ativo", T.BooleanType()), ("peso", D8_3), ("dimensoes", T.StringType()),
    ("descricao", T.StringType()), ("tags", T.ArrayType(T.StringType())),
    ("data_lancamento", T.DateType()), ("fornecedor_id", T.IntegerType()),
    ("updated_at", T.TimestampType()), ("created_by", T.StringType()), ("version", T.IntegerType()),
)

ITENS_PEDIDO = _s(
    ("id", T.LongType()), ("pedido_id", T.LongType()), ("produto_id", T.LongType()),
    ("quantidade", T.IntegerType()), ("preco_unitario", D15_2), ("desconto_item", D15_2),
    ("valor_total", D15_2), ("observacoes", T.StringType()), ("updated_at", T.TimestampType()),
    ("created_by", T.StringType()), ("version", T.IntegerType()),
)

CAMPANHAS = _s(
    ("id", T.LongType()), ("nome", T.StringType()), ("tipo", T.StringType()),
    ("canal", T.StringType()), ("orcamento", D15_2), ("data_inicio", T.DateType()),
    ("data_fim", T.DateType()), ("status", T.StringType()), ("meta_leads", T.IntegerType()),
    ("leads_gerados", T.IntegerType()), ("taxa_conversao", D5_2), ("roi", D8_2),
    ("descricao", T.StringType()), ("parametros", T.StringType()),
    ("updated_at", T.TimestampType()), ("created_by", T.StringType()), ("version", T.IntegerType()),
)

LEADS = _s(
    ("id", T.LongType()), ("nome", T.StringType()), ("email", T.StringType()),
    ("telefone", T.StringType()), ("empresa", T.StringType()), ("cargo", T.StringType()),
    ("fonte", T.StringType()), ("campanha_id", T.IntegerType()), ("score", T.IntegerType()),
    ("status", T.StringType()), ("interesse", T.StringType()), ("orcamento_estimado", D15_2),
    ("data_contato", T.DateType()), ("data_conversao", T.DateType()),
    ("observacoes", T.StringType()), ("tags", T.ArrayType(T.StringType())),
    ("ultima_atividade", T.TimestampNTZType()), ("updated_at", T.TimestampNTZType()),
    ("created_by", T.StringType()), ("version", T.IntegerType()),
)

SCHEMAS: dict[str, T.StructType] = {
    "clientes": CLIENTES,
    "pedidos": PEDIDOS,
    "produtos": PRODUTOS,
    "itens_pedido": ITENS_PEDIDO,
    "campanhas_marketing": CAMPANHAS,
    "leads": LEADS,
}

# Column defaults of the source DDL (applied when a column is
# absent from an insert; an explicit NULL stays NULL).  "__now__" / "__today__"
# stand for CURRENT_TIMESTAMP / CURRENT_DATE and are bound to ``as_of``.
SOURCE_DEFAULTS: dict[str, dict[str, object]] = {
    "clientes": {"status": "ativo", "tipo_cliente": "pessoa_fisica", "limite_credito": 0,
                 "data_cadastro": "__now__", "updated_at": "__now__", "created_by": "sistema",
                 "version": 1},
    "pedidos": {"data_pedido": "__now__", "status": "pendente", "desconto": 0,
                "canal_venda": "loja_online", "updated_at": "__now__", "created_by": "sistema",
                "version": 1},
    "produtos": {"estoque_atual": 0, "estoque_minimo": 10, "ativo": True,
                 "updated_at": "__now__", "created_by": "sistema", "version": 1},
    "itens_pedido": {"desconto_item": 0, "updated_at": "__now__", "created_by": "sistema",
                     "version": 1},
    "campanhas_marketing": {"status": "planejada", "leads_gerados": 0, "taxa_conversao": 0,
                            "roi": 0, "updated_at": "__now__", "created_by": "sistema",
                            "version": 1},
    "leads": {"score": 0, "status": "novo", "interesse": "medio", "data_contato": "__today__",
              "updated_at": "__now__", "created_by": "sistema", "version": 1},
}

# Generated (STORED) columns; computed by rules.generated_columns.
GENERATED: dict[str, tuple[str, ...]] = {
    "pedidos": ("valor_liquido",),
    "produtos": ("margem_lucro",),
    "itens_pedido": ("valor_total",),
}

# Key columns that the DDL declares UNIQUE (besides the PK).
UNIQUE_KEYS: dict[str, tuple[str, ...]] = {
    "clientes": ("email", "cpf"),
    "pedidos": ("numero_pedido",),
    "produtos": ("codigo_produto",),
}


@dataclass(frozen=True)
class Route:
    """How one change topic maps onto a replica table."""

    topic: str
    table: str
    pk: str
    columns: tuple[str, ...]
    # Replica insert defaults (DDL DEFAULT of the replica table).
    defaults: dict[str, object] = field(default_factory=dict)


TOPIC_PREFIX = "dbserver1.public."

# The consumer's topic -> (table, pk, column whitelist) routing,
# and the replica DDL defaults.
ROUTES: dict[str, Route] = {
    r.topic: r
    for r in (
        Route(TOPIC_PREFIX + "clientes", "clientes", "id",
              ("id", "nome", "email", "telefone", "cpf", "data_nascimento",
               "status", "tipo_cliente", "limite_credito", "data_cadastro",
               "updated_at", "created_by", "version", "endereco")),
        Route(TOPIC_PREFIX + "pedidos", "pedidos", "id",
              ("id", "cliente_id", "numero_pedido", "data_pedido", "status",
               "valor_bruto", "desconto", "metodo_pagamento",
               "canal_venda", "observacoes", "data_entrega_prevista",
               "data_entrega_real", "updated_at", "created_by", "version"),
              defaults={"desconto": 0}),
        Route(TOPIC_PREFIX + "produtos", "produtos", "id",
              ("id", "codigo_produto", "nome", "categoria", "preco_custo",
               "preco_venda", "estoque_atual", "ativo", "updated_at"),
              defaults={"ativo": True}),
        Route(TOPIC_PREFIX + "leads", "leads", "id",
              ("id", "nome", "email", "telefone", "fonte", "score",
               "status", "interesse", "orcamento_estimado", "data_contato",
               "data_conversao", "updated_at")),
    )
}

TOPICS = tuple(ROUTES)

# Wire encodings of the change events.
EPOCH_DAY_COLS = frozenset({"data_nascimento", "data_cadastro_date", "data_contato",
                            "data_conversao", "data_entrega_prevista", "data_entrega_real"})
EPOCH_TS_COLS = frozenset({"data_cadastro", "data_pedido", "updated_at", "data_nascimento_ts"})
JSON_OBJECT_COLS = frozenset({"endereco"})

# Change-event schema (what a Kafka source yields, value already decoded).
CHANGE_EVENT = _s(
    ("topic", T.StringType()), ("partition", T.IntegerType()), ("offset", T.LongType()),
    ("timestamp", T.TimestampType()), ("value", T.StringType()),
)

# Pipeline control table.
CONTROL = _s(
    ("topic", T.StringType()), ("last_offset", T.LongType()),
    ("last_event", T.TimestampType()), ("event_count", T.LongType()),
)


def replica_schema(table: str) -> T.StructType:
    """Replica rows use the full source schema."""
    return SCHEMAS[table]
