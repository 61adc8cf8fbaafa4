"""Gold models.

Both aggregate on a key before anything else: Spark's partial (map-side)
aggregation folds every task's rows per key before the shuffle, so a key that
holds a third of all orders still ships one partial row per task.  Both join the
aggregated orders to the customers, never the raw orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions import exprs as E


def agg_valor_pedidos_por_cliente_mensal(bronze_pedidos: DataFrame, bronze_clientes: DataFrame,
                                         ordered: bool = True) -> DataFrame:  # G1
    """Monthly order value and distinct order count per customer.

    The fact rows of the model (orders with a positive value) are aggregated by
    customer id and month before anything is joined: a partial aggregate, so a
    hot customer, or the orders without one, are a row a month and task.
    ``countDistinct`` aggregates on (group, pedido_id) first, which spreads a hot
    customer's ids over all shuffle partitions.  The name belongs to the id (the
    key of clientes), so it joins the aggregated rows; NULL ids match no name.
    """
    months = (bronze_pedidos.filter(F.col("valor_bruto") > 0)
              .groupBy("cliente_id", F.year("data_pedido").alias("ano_pedido"), F.month("data_pedido").alias("mes_pedido"))
              .agg(F.sum("valor_liquido").alias("valor_total_pedidos_mensal"),
                   F.countDistinct("id").alias("numero_de_pedidos_mensal")))
    names = bronze_clientes.select(F.col("id").alias("cliente_id"), F.col("nome").alias("nome_cliente"))
    out = months.join(names, "cliente_id", "left").select(
        "cliente_id", "nome_cliente", "ano_pedido", "mes_pedido", "valor_total_pedidos_mensal", "numero_de_pedidos_mensal")
    if ordered:
        # PostgreSQL sorts NULLs first in DESC order.
        out = out.orderBy(F.col("ano_pedido").desc_nulls_first(),
                          F.col("mes_pedido").desc_nulls_first(),
                          F.col("valor_total_pedidos_mensal").desc_nulls_first())
    return out


def pedidos_agregados_por_cliente(silver_pedidos: DataFrame) -> DataFrame:
    """Per-customer order statistics (the CTE of G2; G5 is the conditional count)."""
    return (silver_pedidos.groupBy("cliente_id_origem").agg(
        F.count("pedido_id_origem").alias("total_pedidos"),
        F.sum("valor_liquido_decimal").alias("valor_total_gasto"),
        # AVG over numeric: exact sum / count, kept unrounded as a double
        # (Spark's decimal avg would round to 6 places).
        (F.sum("valor_liquido_decimal").cast("double") / F.count("valor_liquido_decimal"))
        .alias("ticket_medio"),
        F.min("data_pedido_ts").alias("data_primeiro_pedido"),
        F.max("data_pedido_ts").alias("data_ultimo_pedido"),
        F.count(F.when(F.col("status") == "concluido", 1)).alias("pedidos_concluidos"),
    ))


def gold_visao_geral_clientes(silver_clientes: DataFrame, silver_pedidos: DataFrame) -> DataFrame:  # G2
    sc = silver_clientes.select(
        "cliente_id_origem", "nome_completo", "email_padronizado", "telefone", "cpf", "status",
        "tipo_cliente", "limite_credito", "data_cadastro_ts", "updated_at_ts", "dominio_email",
        "ano_cadastro", "idade_estimada")
    pa = pedidos_agregados_por_cliente(silver_pedidos)
    j = sc.join(pa, on="cliente_id_origem", how="left")
    n = F.col("total_pedidos")
    return j.select(
        "cliente_id_origem", "nome_completo", "email_padronizado", "telefone", "cpf", "status",
        "tipo_cliente", "limite_credito", "data_cadastro_ts",
        F.col("updated_at_ts").alias("updated_at_cliente_ts"),
        "dominio_email", "ano_cadastro", "idade_estimada",
        F.coalesce(n, F.lit(0)).alias("total_pedidos_realizados"),
        F.coalesce(F.col("valor_total_gasto"), F.lit(0).cast("decimal(2,2)"))
        .alias("valor_total_gasto_cliente"),
        F.coalesce(F.col("ticket_medio"), F.lit(0.0)).alias("ticket_medio_cliente"),
        "data_primeiro_pedido", "data_ultimo_pedido",
        F.coalesce(F.col("pedidos_concluidos"), F.lit(0)).alias("pedidos_concluidos"),
        E.segmento_cliente(n).alias("segmento_cliente"),
        E.categoria_valor("limite_credito", n).alias("categoria_valor"),
    )
