"""Bronze models (B1-B4): projection + basic validity filter, materialised as views.

Each is a narrow select over the raw table; Catalyst pushes the filter into the
parquet scan and prunes columns the downstream model does not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bronze column lists.
CLIENTES_COLS = ("id", "nome", "email", "telefone", "cpf", "data_nascimento", "endereco",
                 "status", "tipo_cliente", "limite_credito", "data_cadastro", "updated_at",
                 "created_by", "version")
PEDIDOS_COLS = ("id", "cliente_id", "numero_pedido", "data_pedido", "status", "valor_bruto",
                "desconto", "valor_liquido", "metodo_pagamento", "canal_venda", "observacoes",
                "data_entrega_prevista", "data_entrega_real", "updated_at", "created_by", "version")
PRODUTOS_COLS = ("id", "codigo_produto", "nome", "categoria", "subcategoria", "marca",
                 "preco_custo", "preco_venda", "margem_lucro", "estoque_atual", "estoque_minimo",
                 "ativo", "peso", "dimensoes", "descricao", "tags", "data_lancamento",
                 "fornecedor_id", "updated_at", "created_by", "version")
LEADS_COLS = ("id", "nome", "email", "telefone", "empresa", "cargo", "fonte", "campanha_id",
              "score", "status", "interesse", "orcamento_estimado", "data_contato",
              "data_conversao", "observacoes", "tags", "ultima_atividade", "updated_at",
              "created_by", "version")


def _bronze(df: DataFrame, cols, keep) -> DataFrame:
    return (df.select(*cols, F.col("updated_at").alias("ultima_modificacao_fonte"))
            .filter(keep))


def bronze_clientes(clientes: DataFrame) -> DataFrame:  # B1
    return _bronze(clientes, CLIENTES_COLS, F.col("nome").isNotNull())


def bronze_pedidos(pedidos: DataFrame) -> DataFrame:  # B2
    return _bronze(pedidos, PEDIDOS_COLS, F.col("valor_bruto") > 0)


def bronze_produtos(produtos: DataFrame) -> DataFrame:  # B3
    return _bronze(produtos, PRODUTOS_COLS, F.col("nome").isNotNull())


def bronze_leads(leads: DataFrame) -> DataFrame:  # B4
    return _bronze(leads, LEADS_COLS, F.col("nome").isNotNull())
