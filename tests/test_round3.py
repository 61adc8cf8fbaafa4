"""Threshold top-k of items, the streaming lifetime totals."""
import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators import serving
from rivulet.streaming import lifetime


@pytest.mark.parametrize("n, orders_with_customer", [(1, range(0, 400)), (3, range(0, 5)), (2, range(0, 0))])
def test_newest_items_by_threshold(spark, n, orders_with_customer):
    """Orders without a customer at the top, one order of many items further down, whose ids pass those of later orders."""
    rnd = random.Random(n)
    items = [(k * 100 + i, k, i) for k in range(400) for i in range(1, 900 if k == 390 else rnd.randint(2, 4))]
    ddl = "id long, pedido_id long, produto_id long"
    table = spark.createDataFrame(items, ddl).withColumn("quantidade", F.lit(2)).withColumn("preco_unitario", F.lit(3).cast("decimal(15,2)"))
    pedidos = spark.createDataFrame([(k, 1 if k in orders_with_customer else None) for k in range(400)], "id long, cliente_id long")
    clientes = spark.createDataFrame([(1, "Ana")], "id long, nome string")
    asked = []

    def above(key):
        asked.append(key)
        return table.filter(F.col("pedido_id") > key)
    got = [r["item_id"] for r in serving.latest_item_with_customer(above, table, pedidos, clientes, 100, n).collect()]
    assert sorted(got, reverse=True) == sorted((i for i, k, _ in items if k in orders_with_customer), reverse=True)[:n]
    assert len(asked) == 1 or orders_with_customer != range(0, 400)


def test_totals_go_on_after_a_stop(spark, tmp_path):
    ddl = "cliente_id long, quantidade int, preco_unitario decimal(15,2), desconto decimal(4,2)"
    rnd = random.Random(1)
    rows = [(rnd.choice([1, 1, 1, 2, None]), rnd.randint(1, 9), rnd.randint(1, 99), 0) for _ in range(60)]
    sales, out = str(tmp_path / "sales"), str(tmp_path / "out")
    for part in (rows[:30], rows[30:]):
        df = spark.createDataFrame([(c, q, __import__("decimal").Decimal(p), __import__("decimal").Decimal(d)) for c, q, p, d in part], ddl)
        df.repartition(3).write.mode("append").parquet(sales)
        query = lifetime.start(lifetime.read_sales(spark, sales, df.schema, 2), out, str(tmp_path / "checkpoint"))
        query.awaitTermination()
        query.stop()
    (tmp_path / "out" / "v=99").mkdir()         # a write that broke off
    got = {r["cliente_id"]: (r["total_compras"], int(r["valor_total_gasto"])) for r in lifetime.totals(spark, out).collect()}
    want = {k: (sum(c == k for c, *_ in rows), sum(q * p for c, q, p, _ in rows if c == k)) for k in (1, 2, None)}
    assert got == want
