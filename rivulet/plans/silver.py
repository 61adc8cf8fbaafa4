"""Silver models (V1-V6): cleaned, typed and enriched tables.

All row-level: projections with ``when`` chains (JVM-side), plus one LEFT equi-join
(V2).  ``as_of`` replaces CURRENT_DATE / CURRENT_TIMESTAMP.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions import exprs as E


def _trim(c):
    return F.trim(F.col(c))


def dim_clientes(bronze_clientes: DataFrame, as_of) -> DataFrame:  # V1
    b = bronze_clientes
    return b.filter(F.col("nome").isNotNull()).select(
        F.col("id").alias("cliente_id"), "nome",
        F.lower(_trim("email")).alias("email_limpo"),
        F.col("email").alias("email_original"),
        "telefone", "cpf", "data_nascimento", "endereco", "status", "tipo_cliente",
        "limite_credito", "data_cadastro", "updated_at",
        E.categoria_cliente("data_cadastro", as_of).alias("categoria_cliente"),
        E.provedor_email("email").alias("provedor_email"),
        E.tipo_cliente_abrev("tipo_cliente").alias("tipo_cliente_abrev"),
        E.categoria_credito("limite_credito").alias("categoria_credito"),
    )


def fct_pedidos(bronze_pedidos: DataFrame, bronze_clientes: DataFrame) -> DataFrame:  # V2
    """Orders LEFT JOIN customers.

    A row-level join on ``cliente_id``: both sides hash-partition by the key (or
    the customer side is broadcast when AQE measures it small).  A customer that
    holds a large share of all orders makes one join partition large; AQE's skew
    join splits that partition of the order side.
    """
    p = bronze_pedidos.filter(F.col("valor_bruto") > 0).select(
        F.col("id").alias("pedido_id"), "cliente_id", "numero_pedido", "data_pedido", "status",
        "valor_bruto", "desconto", "valor_liquido", "metodo_pagamento", "canal_venda",
        "observacoes", "data_entrega_prevista", "data_entrega_real", "updated_at")
    c = bronze_clientes.select(
        F.col("id").alias("cliente_id"), F.col("nome").alias("nome_cliente"),
        F.col("email").alias("email_cliente"), "tipo_cliente",
        F.col("status").alias("status_cliente"))
    j = p.join(c, on="cliente_id", how="left")
    return j.select(
        "pedido_id", "cliente_id", "nome_cliente", "tipo_cliente", "numero_pedido",
        F.col("status").alias("status_pedido"), "valor_bruto", "desconto", "valor_liquido",
        "metodo_pagamento", "canal_venda", "observacoes", "data_pedido",
        "data_entrega_prevista", "data_entrega_real",
        F.year("data_pedido").alias("ano_pedido"),
        F.month("data_pedido").alias("mes_pedido"),
        F.dayofmonth("data_pedido").alias("dia_pedido"),
        "updated_at",
        E.percentual_desconto("desconto", "valor_bruto").alias("percentual_desconto"),
        E.atraso_entrega_dias("data_entrega_real", "data_entrega_prevista").alias("atraso_entrega_dias"),
    )


def silver_clientes(bronze_clientes: DataFrame, as_of) -> DataFrame:  # V3
    b = bronze_clientes.filter(F.col("email").isNotNull() & F.col("nome").isNotNull())
    cad = F.col("data_cadastro").cast("timestamp")
    return b.select(
        F.col("id").alias("cliente_id_origem"),
        E.pg_initcap(_trim("nome")).alias("nome_completo"),
        F.lower(_trim("email")).alias("email_padronizado"),
        "telefone", "cpf", "data_nascimento", "endereco", "status", "tipo_cliente",
        "limite_credito",
        cad.alias("data_cadastro_ts"),
        F.col("updated_at").cast("timestamp").alias("updated_at_ts"),
        E.ts_lit(as_of).alias("data_processamento"),
        E.email_domain("email").alias("dominio_email"),
        F.year(cad).alias("ano_cadastro"),
        E.pg_age_years("data_nascimento", as_of).alias("idade_estimada"),
    )


def silver_pedidos(bronze_pedidos: DataFrame, as_of) -> DataFrame:  # V4
    p = bronze_pedidos.filter(F.col("valor_bruto") > 0)
    dp = F.col("data_pedido").cast("timestamp")
    return p.select(
        F.col("id").alias("pedido_id_origem"),
        F.col("cliente_id").alias("cliente_id_origem"),
        _trim("numero_pedido").alias("numero_pedido_clean"),
        "status",
        F.col("valor_bruto").cast("decimal(18,2)").alias("valor_bruto_decimal"),
        F.col("desconto").cast("decimal(18,2)").alias("desconto_decimal"),
        F.col("valor_liquido").cast("decimal(18,2)").alias("valor_liquido_decimal"),
        "metodo_pagamento", "canal_venda", "observacoes",
        dp.alias("data_pedido_ts"),
        "data_entrega_prevista", "data_entrega_real",
        F.col("updated_at").cast("timestamp").alias("updated_at_ts"),
        E.ts_lit(as_of).alias("data_processamento"),
        F.year(dp).alias("ano_pedido"), F.month(dp).alias("mes_pedido"),
        F.dayofmonth(dp).alias("dia_pedido"),
        E.percentual_desconto("desconto", "valor_bruto").alias("percentual_desconto"),
        E.atraso_entrega_dias("data_entrega_real", "data_entrega_prevista").alias("atraso_entrega_dias"),
    )


def silver_produtos(bronze_produtos: DataFrame, as_of) -> DataFrame:  # V5
    p = bronze_produtos.filter(F.col("nome").isNotNull() & (F.col("preco_venda") > 0)
                               & (F.col("ativo") == F.lit(True)))
    return p.select(
        F.col("id").alias("produto_id_origem"),
        _trim("codigo_produto").alias("codigo_produto_clean"),
        E.pg_initcap(_trim("nome")).alias("nome_produto_clean"),
        F.upper(_trim("categoria")).alias("categoria_padronizada"),
        F.upper(_trim("subcategoria")).alias("subcategoria_padronizada"),
        E.pg_initcap(_trim("marca")).alias("marca_clean"),
        F.col("preco_custo").cast("decimal(18,2)").alias("preco_custo_decimal"),
        F.col("preco_venda").cast("decimal(18,2)").alias("preco_venda_decimal"),
        F.col("margem_lucro").cast("decimal(8,2)").alias("margem_lucro_decimal"),
        "estoque_atual", "estoque_minimo", "ativo", "peso", "dimensoes", "descricao", "tags",
        "data_lancamento", "fornecedor_id",
        F.col("updated_at").cast("timestamp").alias("updated_at_ts"),
        E.ts_lit(as_of).alias("data_processamento"),
        E.status_estoque("estoque_atual", "estoque_minimo").alias("status_estoque"),
        E.categoria_margem("margem_lucro").alias("categoria_margem"),
        E.fase_produto("data_lancamento", as_of).alias("fase_produto"),
    )


def silver_leads(bronze_leads: DataFrame, as_of) -> DataFrame:  # V6
    b = bronze_leads.filter(F.col("nome").isNotNull() & F.col("email").isNotNull())
    return b.select(
        F.col("id").alias("lead_id_origem"),
        E.pg_initcap(_trim("nome")).alias("nome_lead_clean"),
        F.lower(_trim("email")).alias("email_lead_clean"),
        "telefone",
        E.pg_initcap(_trim("empresa")).alias("empresa_clean"),
        E.pg_initcap(_trim("cargo")).alias("cargo_clean"),
        F.upper(_trim("fonte")).alias("fonte_padronizada"),
        "campanha_id", "score",
        F.upper(_trim("status")).alias("status_padronizado"),
        F.upper(_trim("interesse")).alias("interesse_padronizado"),
        F.col("orcamento_estimado").cast("decimal(18,2)").alias("orcamento_estimado_decimal"),
        F.col("data_contato").cast("date").alias("data_contato_clean"),
        F.col("data_conversao").cast("date").alias("data_conversao_clean"),
        "observacoes", "tags",
        F.col("ultima_atividade").alias("ultima_atividade_ts"),
        F.col("updated_at").alias("updated_at_ts"),
        E.ts_lit(as_of, ntz=True).alias("data_processamento"),
        E.categoria_score("score").alias("categoria_score"),
        E.categoria_orcamento("orcamento_estimado").alias("categoria_orcamento"),
        E.fase_funil("data_conversao", "status").alias("fase_funil"),
        E.status_atividade("ultima_atividade", as_of).alias("status_atividade"),
        E.email_domain("email").alias("dominio_email_lead"),
    )
