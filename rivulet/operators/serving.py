"""Serving queries over the source tables, the replica and the gold layer (Q1-Q12).

Global metrics are single aggregates (partial per task, one final row).  Top-k
reports use ``orderBy(...).limit(k)``, which Spark plans as a per-task top-k
(TakeOrderedAndProject): no global sort, k rows per task move.  Ties in every
top-k are broken by the key so the result is deterministic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Replication state labels and thresholds.
IN_SYNC, REPLICATING, QUEUED = "em dia", "replicando", "na fila"
REPLICATING_BELOW = 10


def row_counts(source: dict[str, DataFrame], replica: dict[str, DataFrame]) -> DataFrame:
    """Q1: rows per table in source and replica, lag, and the overall state
    (0 in sync / < 10 replicating / otherwise queued)."""
    parts = []
    for name in source:
        s = source[name].agg(F.count(F.lit(1)).alias("source_rows"))
        t = replica[name].agg(F.count(F.lit(1)).alias("target_rows"))
        parts.append(s.crossJoin(t).select(F.lit(name).alias("tabela"), "source_rows", "target_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.withColumn("lag", F.col("source_rows") - F.col("target_rows"))
    # One row per table: the total over this tiny frame is bounded by the table list.
    total = F.sum("lag").over(Window.partitionBy(F.lit(1)))
    return out.withColumn(
        "estado", F.when(total == 0, IN_SYNC).when(total < REPLICATING_BELOW, REPLICATING)
        .otherwise(QUEUED))


def total_revenue(pedidos: DataFrame) -> DataFrame:  # Q2
    return pedidos.agg(F.coalesce(F.sum("valor_bruto"), F.lit(0)).cast("double").alias("receita_total"))


def average_ticket(pedidos: DataFrame) -> DataFrame:  # Q3
    avg = F.sum("valor_liquido").cast("double") / F.count("valor_liquido")
    return pedidos.agg(F.coalesce(avg, F.lit(0.0)).alias("ticket_medio"))


def counts_long(counts: DataFrame) -> DataFrame:  # Q4
    """Wide (tabela, source_rows, target_rows) -> long (tabela, camada, registros)."""
    return counts.select(
        "tabela", F.col("source_rows").alias("Source"), F.col("target_rows").alias("Target")
    ).unpivot("tabela", ["Source", "Target"], "camada", "registros")


def latest_customers(clientes: DataFrame, n: int = 10) -> DataFrame:  # Q5
    return (clientes.orderBy(F.col("updated_at").desc_nulls_last(), F.col("id").desc())
            .limit(n)
            .select("id", "nome", "email", "tipo_cliente", "status",
                    F.date_format("data_cadastro", "dd/MM HH:mm").alias("cadastro"),
                    F.date_format("updated_at", "HH:mm:ss").alias("updated")))


def latest_orders(pedidos: DataFrame, n: int = 10) -> DataFrame:  # Q6
    def money(c):
        return F.col(c).cast("double").cast("decimal(10,2)")
    return (pedidos.orderBy(F.col("updated_at").desc_nulls_last(), F.col("id").desc())
            .limit(n)
            .select("id", "numero_pedido", "status", "metodo_pagamento",
                    money("valor_bruto").alias("valor_bruto"),
                    money("valor_liquido").alias("valor_liq"), "canal_venda",
                    F.date_format("updated_at", "HH:mm:ss").alias("updated")))


def top_customers(gold: DataFrame, n: int = 10) -> DataFrame:  # Q7
    return (gold.select("cliente_id_origem", F.col("nome_completo").alias("nome"),
                        F.col("total_pedidos_realizados").alias("total_pedidos"),
                        F.col("valor_total_gasto_cliente").cast("double").alias("receita"))
            .orderBy(F.col("receita").desc_nulls_first(), F.col("cliente_id_origem"))
            .limit(n))


def revenue_by_status(pedidos: DataFrame) -> DataFrame:  # Q8
    """Exact decimal sum per status, then double (the float sum of the dashboard
    depends on summation order)."""
    return (pedidos.groupBy("status")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("valor_bruto").cast("double").alias("receita"))
            .orderBy(F.col("receita").desc_nulls_first()))


def control_by_count(control: DataFrame) -> DataFrame:  # Q9
    return control.select("topic", "event_count", "last_event").orderBy(F.col("event_count").desc())


def items_revenue(itens: DataFrame) -> DataFrame:  # Q10
    return itens.agg(F.sum(F.col("quantidade") * F.col("preco_unitario")).cast("double")
                     .alias("receita_total"))


def latest_item_with_customer(items_above: Callable[[int], DataFrame], orders: DataFrame, pedidos: DataFrame,
                              clientes: DataFrame, ids_per_order: int, n: int = 1) -> DataFrame:  # Q11
    """Newest ``n`` order items with their customer (INNER joins), ``ORDER BY id DESC LIMIT n``.

    An item's id is its order's key times ``ids_per_order`` plus its place among the
    order's items, so only items of the greatest keys are numbered and joined:
    ``items_above(key)`` gives those of orders above a key.  No order has more items than
    there are items, so those of orders further down than items / ids_per_order keys
    can't come before one of the greatest order.  If fewer than n rows survive the joins
    above the threshold, or the last of them could come after one below it, the
    threshold goes down by twice as much.  ``orders``: the items' order keys.
    """
    # An order without a customer matches none: it never enters the join's shuffle.
    p = pedidos.filter(F.col("cliente_id").isNotNull()).select(F.col("id").alias("pedido_id"), "cliente_id")
    c = clientes.select(F.col("id").alias("cliente_id"), F.col("nome"))
    key = F.col("pedido_id")
    least, greatest, items = orders.agg(F.min(key), F.max(key), F.count(key)).first()
    width = items // ids_per_order + 1
    while True:
        above = (greatest or 0) - width
        i = items_above(above).select(F.col("id").alias("item_id"), "pedido_id", "produto_id", "quantidade", "preco_unitario")
        top = (i.join(p.filter(key > above), "pedido_id").join(c, "cliente_id").orderBy(F.col("item_id").desc()).limit(n)
               .select("item_id", "pedido_id", "nome", "produto_id",
                       (F.col("quantidade") * F.col("preco_unitario")).cast("double").alias("valor_total")))
        rows = top.collect()        # n rows
        if least is None or above < least or len(rows) == n and rows[-1]["item_id"] > above * ids_per_order + items:
            return top.sparkSession.createDataFrame(rows, top.schema)
        width *= 2


def stack_metrics(metrics: dict[str, DataFrame]) -> DataFrame:  # Q12
    """Stack one-row, one-column frames into (metrica, valor) rows by UNION ALL."""
    out = None
    for name, df in metrics.items():
        col = df.columns[0]
        row = df.select(F.lit(name).alias("metrica"), F.col(col).cast("double").alias("valor"))
        out = row if out is None else out.unionByName(row)
    return out
