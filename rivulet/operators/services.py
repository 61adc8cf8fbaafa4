"""List and summary computations of the e-commerce and CRM services (M1-M18),
re-aimed at tables.

"first n" / "last n" are top-k by id (per-task top-k, no global sort).  Counts
per status/type are grouped aggregates with map-side combine.  The funnel check
(M18) needs each lead's previous status; ``windows.lag_skew_safe`` computes it
without putting a hot lead into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.operators.windows import lag_skew_safe


def _with_total(page: DataFrame) -> DataFrame:
    """A page with ``total``, the number of rows returned.

    The page is a top-k result of at most ``limit`` rows, so the window over all
    of it stays as small.
    """
    return page.withColumn("total", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))))


def products_page(produtos: DataFrame, limit: int = 100, categoria: str = "") -> DataFrame:  # M1
    """First ``limit`` products by id, *then* the case-insensitive category filter;
    ``total`` is the number of products returned."""
    page = produtos.orderBy("id").limit(limit)
    if categoria:
        page = page.filter(F.lower(F.col("categoria")) == categoria.lower())
    # The page holds at most ``limit`` rows, so this count stays bounded.
    total = page.agg(F.count(F.lit(1)).alias("total"))
    return page.select("id", "nome", "categoria", "preco_venda", "estoque_atual", "ativo") \
        .crossJoin(total)


def sale_amount() -> "F.Column":  # M7
    """quantity * price, times (1 - discount) rounded to cents when discounted."""
    gross = F.col("quantidade") * F.col("preco_unitario")
    return F.when(F.col("desconto") > 0, F.round(gross * (1 - F.col("desconto")), 2)) \
        .otherwise(gross).cast("decimal(18,2)")


def with_amount(vendas: DataFrame) -> DataFrame:
    return vendas.withColumn("valor_total", sale_amount())


def sales_page(vendas: DataFrame, limit: int = 100, data_inicio: str = "") -> DataFrame:  # M2
    v = vendas
    if data_inicio:
        v = v.filter(F.col("data_venda") >= F.lit(data_inicio).cast("timestamp_ntz"))
    return _with_total(with_amount(v).orderBy(F.col("id").desc()).limit(limit))


def customers_page(clientes: DataFrame, limit: int = 100, vip_only: bool = False) -> DataFrame:  # M3
    c = clientes.withColumn("vip", F.col("status") == "premium")
    if vip_only:
        c = c.filter("vip")
    return _with_total(c.orderBy("id").limit(limit).select("id", "nome", "email", "status", "vip"))


def sales_summary(vendas: DataFrame, produtos: DataFrame, clientes: DataFrame) -> DataFrame:  # M4
    s = with_amount(vendas).agg(F.count(F.lit(1)).alias("total_vendas"),
                                F.sum("valor_total").alias("receita"))
    p = produtos.agg(F.count(F.lit(1)).alias("total_produtos"))
    c = clientes.agg(F.count(F.lit(1)).alias("total_clientes"),
                     F.count(F.when(F.col("status") == "premium", 1)).alias("clientes_vip"))
    # Three one-row aggregates side by side.
    return s.crossJoin(p).crossJoin(c).select(
        "total_vendas",
        F.round(F.col("receita"), 2).cast("double").alias("receita_total"),
        F.round(F.col("receita") / F.greatest(F.lit(1), F.col("total_vendas")), 2)
        .cast("double").alias("ticket_medio"),
        "total_produtos", "total_clientes", "clientes_vip")


def count_by(df: DataFrame, col: str, name: str = "quantidade") -> DataFrame:  # M5, M14, M15
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def units_per_product(vendas: DataFrame) -> DataFrame:  # M6
    return vendas.groupBy("produto_id").agg(F.sum("quantidade").alias("unidades"))


def stock_after_sales(produtos: DataFrame, vendas: DataFrame) -> DataFrame:  # M8
    """``max(0, stock - q)`` per sale without restock = ``max(0, stock - sum q)``."""
    sold = units_per_product(vendas).withColumnRenamed("produto_id", "id")
    return (produtos.select("id", "estoque_atual").join(sold, "id", "left")
            .select("id", "estoque_atual", F.coalesce("unidades", F.lit(0)).alias("unidades"),
                    F.greatest(F.lit(0), F.col("estoque_atual") - F.coalesce("unidades", F.lit(0)))
                    .alias("estoque_final")))


def customer_lifetime(vendas: DataFrame) -> DataFrame:  # M9
    return (with_amount(vendas).groupBy("cliente_id")
            .agg(F.count(F.lit(1)).alias("total_compras"),
                 F.sum("valor_total").alias("valor_total_gasto")))


def leads_page(leads: DataFrame, limit: int = 100, status: str = "") -> DataFrame:  # M10
    l = leads
    if status:
        l = l.filter(F.lower(F.col("status")) == status.lower())
    return _with_total(l.orderBy(F.col("id").desc()).limit(limit).select("id", "nome", "email", "status", "score"))


def campaigns_page(campanhas: DataFrame, limit: int = 50) -> DataFrame:  # M11
    """Last ``limit`` campaigns; ``total`` counts *all* campaigns."""
    total = campanhas.agg(F.count(F.lit(1)).alias("total"))
    return (campanhas.orderBy(F.col("id").desc()).limit(limit)
            .select("id", "nome", "tipo", "orcamento", "status").crossJoin(total))


def activities_page(atividades: DataFrame, limit: int = 100, lead_id: int = 0) -> DataFrame:  # M12
    a = atividades
    if lead_id and lead_id > 0:
        a = a.filter(F.col("lead_id") == lead_id)
    return _with_total(a.orderBy(F.col("id").desc()).limit(limit))


def crm_summary(leads: DataFrame, campanhas: DataFrame, atividades: DataFrame) -> DataFrame:  # M13
    l = leads.agg(F.count(F.lit(1)).alias("total_leads"),
                  F.count(F.when(F.col("status") == "Convertido", 1)).alias("leads_convertidos"),
                  F.sum("score").alias("__score"))
    c = campanhas.agg(F.count(F.lit(1)).alias("total_campanhas"))
    a = atividades.agg(F.count(F.lit(1)).alias("total_atividades"))
    denom = F.greatest(F.lit(1), F.col("total_leads")).cast("double")
    return l.crossJoin(c).crossJoin(a).select(
        "total_leads", "leads_convertidos",
        F.round(F.col("leads_convertidos").cast("double") / denom * 100, 2).alias("taxa_conversao"),
        F.round(F.coalesce(F.col("__score"), F.lit(0)).cast("double") / denom, 1).alias("score_medio"),
        "total_campanhas", "total_atividades")


def leads_per_campaign(campanhas: DataFrame, leads: DataFrame) -> DataFrame:  # M16
    per = leads.filter(F.col("campanha_id").isNotNull()).groupBy("campanha_id") \
        .agg(F.count(F.lit(1)).alias("n"))
    return (campanhas.select("id", "nome", "meta_leads")
            .join(per.withColumnRenamed("campanha_id", "id"), "id", "left")
            .select("id", "nome", "meta_leads", F.coalesce("n", F.lit(0)).alias("leads_gerados")))


def last_contact(leads: DataFrame, atividades: DataFrame) -> DataFrame:  # M17
    last = atividades.groupBy("lead_id").agg(F.max("data_atividade").alias("ultima"))
    return (leads.select("id", "ultima_atividade")
            .join(last.withColumnRenamed("lead_id", "id"), "id", "left")
            .select("id", F.coalesce("ultima", "ultima_atividade").alias("ultimo_contato")))


# Legal funnel moves.
FUNNEL_MOVES = (
    ("Novo", "Contactado"),
    ("Contactado", "Qualificado"),
    ("Contactado", "Perdido"),
    ("Qualificado", "Convertido"),
    ("Qualificado", "Perdido"),
)


def funnel_check(historico: DataFrame) -> DataFrame:  # M18
    """Each status change with its previous status and whether the move is legal
    (a repeated status is no move and counts as legal)."""
    h = lag_skew_safe(historico, "lead_id", ["ts", "id"], "status", "status_anterior")
    legal = F.lit(False)
    for a, b in FUNNEL_MOVES:
        legal = legal | ((F.col("status_anterior") == a) & (F.col("status") == b))
    legal = legal | (F.col("status_anterior") == F.col("status"))
    return (h.filter(F.col("status_anterior").isNotNull())
            .select("id", "lead_id", "ts", "status_anterior", "status", legal.alias("legal")))
