"""Domain tables derived from the driver's star schema.

Each mapping is one SQL text in the subset that both Spark SQL and DuckDB accept,
so the very same text is a temp view in Spark and a CTE in an oracle query.  The
mappings only project and filter the given tables (and number lineitem rows per
order), so their cost grows with the inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

CLIENTES_SQL = """
select c_custkey as id,
  case when c_custkey % 89 = 0 then null else '  ' || lower(c_name) || ' da-silva ' end as nome,
  case when c_custkey % 97 = 0 then null when c_custkey % 53 = 0 then 'sem-arroba' || cast(c_custkey as string)
       else ' Cliente' || cast(c_custkey as string) || '@' || case c_custkey % 5 when 0 then 'gmail.com' when 1 then 'outlook.com'
            when 2 then 'yahoo.com' when 3 then 'example.com' else 'empresa.com' end end as email,
  '11' || cast(900000000 + c_custkey as string) as telefone,
  case when c_custkey % 41 = 0 then null else cast(10000000000 + c_custkey as string) end as cpf,
  case when c_custkey % 11 = 0 then null else date '1950-01-01' + cast((c_custkey * 37) % 18000 as int) end as data_nascimento,
  '{"cidade":"C' || cast(c_nationkey as string) || '","estado":"E' || cast(c_nationkey % 5 as string) || '"}' as endereco,
  case c_custkey % 3 when 0 then 'ativo' when 1 then 'inativo' else 'premium' end as status,
  case c_nationkey % 3 when 0 then 'pessoa_fisica' when 1 then 'pessoa_juridica' else 'outro' end as tipo_cliente,
  case when c_custkey % 71 = 0 then null else cast(cast(c_acctbal as decimal(15,2)) * 2 as decimal(15,2)) end as limite_credito,
  case when c_custkey % 83 = 0 then null else cast(date '2001-08-01' - cast(c_custkey % 800 as int) as timestamp) end as data_cadastro,
  cast(date '2001-08-01' - cast(c_custkey % 30 as int) as timestamp) as updated_at,
  'sistema' as created_by, 1 as version
from customer
"""

PEDIDOS_SQL = """
select o_orderkey as id, case when o_custkey % 10 = 0 then null else o_custkey end as cliente_id, ' PED-' || cast(o_orderkey as string) || ' ' as numero_pedido,
  cast(o_orderdate as timestamp) as data_pedido,
  case o_orderstatus when 'F' then 'concluido' when 'O' then 'enviado' else 'pendente' end as status,
  case when o_orderkey % 101 = 0 then cast(0 as decimal(15,2)) else cast(o_totalprice as decimal(15,2)) end as valor_bruto,
  case when o_orderkey % 67 = 0 then null else cast(o_orderkey % 500 as decimal(15,2)) end as desconto,
  case o_orderkey % 4 when 0 then 'cartao_credito' when 1 then 'pix' when 2 then 'boleto' else 'cartao_debito' end as metodo_pagamento,
  case o_custkey % 4 when 0 then 'web' when 1 then 'app' when 2 then 'loja_fisica' else 'marketplace' end as canal_venda,
  cast(null as string) as observacoes,
  cast(o_orderdate as date) + 7 as data_entrega_prevista,
  case when o_orderstatus = 'P' then null else cast(o_orderdate as date) + cast(o_orderkey % 15 as int) end as data_entrega_real,
  cast(cast(o_orderdate as date) + cast(o_orderkey % 20 as int) as timestamp) as updated_at,
  'sistema' as created_by, 1 as version
from orders
"""

PRODUTOS_SQL = """
select p_partkey as id, 'PROD-' || cast(p_partkey as string) as codigo_produto,
  case when p_partkey % 79 = 0 then null else ' ' || p_name end as nome, lower(p_type) as categoria, p_type as subcategoria, lower(p_brand) as marca,
  cast(case p_partkey % 5 when 0 then p_retailprice / 2 when 1 then p_retailprice - 100 when 2 then p_retailprice - 200 when 3 then p_retailprice else 0 end as decimal(15,2)) as preco_custo,
  cast(p_retailprice as decimal(15,2)) as preco_venda,
  p_size * 2 as estoque_atual, 20 as estoque_minimo, p_partkey % 9 <> 0 as ativo,
  date '2001-08-01' - cast(p_partkey % 900 as int) as data_lancamento, cast(p_partkey % 100 as int) as fornecedor_id,
  cast(date '2001-08-01' as timestamp) as updated_at
from part
"""

ITENS_PEDIDO_SQL = """
select l_orderkey * 100 + row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_tax, l_discount) as id,
  l_orderkey as pedido_id, l_partkey as produto_id, cast(l_quantity as int) as quantidade,
  cast(900 + l_partkey % 100 as decimal(15,2)) as preco_unitario, cast(l_linenumber as decimal(15,2)) as desconto_item
from lineitem
"""

CAMPANHAS_SQL = """
select n_nationkey as id, 'Campanha ' || n_name as nome, case n_regionkey when 0 then 'Google Ads' when 1 then 'Webinar' else 'Email' end as tipo,
  cast(1000 * (n_nationkey + 1) as decimal(15,2)) as orcamento, date '2024-01-01' + n_nationkey as data_inicio, 'ativa' as status, 100 as meta_leads
from nation
"""

LEADS_SQL = """
select event_id as id, case when event_id % 73 = 0 then null else ' lead ' || cast(user_id as string) || ' ' end as nome,
  case when event_id % 59 = 0 then null else 'Lead' || cast(event_id as string) || '@prospect.com' end as email,
  case event_id % 3 when 0 then ' google_ads' when 1 then 'indicacao' else 'email ' end as fonte,
  cast(case when user_id % 23 = 0 then null else user_id % 25 end as int) as campanha_id,
  cast(event_id % 101 as int) as score,
  case event_id % 6 when 0 then 'novo' when 1 then 'NOVO' when 2 then 'QUALIFICADO' when 3 then 'Convertido' when 4 then 'perdido' else 'proposta' end as status,
  case event_id % 3 when 0 then 'alto' when 1 then 'medio' else 'baixo' end as interesse,
  case when event_id % 31 = 0 then null else cast((event_id % 60) * 1000 as decimal(15,2)) end as orcamento_estimado,
  cast(ts as date) as data_contato, case when event_id % 7 = 0 then cast(ts as date) + 3 else null end as data_conversao,
  case when event_id % 19 = 0 then null else ts end as ultima_atividade, ts as updated_at
from events where event_type = 'signup'
"""

ATIVIDADES_SQL = """
select e.event_id as id, l.lead_id, case e.event_type when 'click' then 'Email' when 'view' then 'Reunião' when 'purchase' then 'Proposta' else 'Follow-up' end as tipo, e.ts as data_atividade
from events e join (select user_id, min(event_id) as lead_id from events where event_type = 'signup' group by user_id) l on e.user_id = l.user_id
where e.event_type <> 'signup'
"""

LEAD_HISTORICO_SQL = """
select event_id as id, user_id as lead_id, ts, case event_type when 'signup' then 'Novo' when 'view' then 'Contactado' when 'click' then 'Qualificado' when 'purchase' then 'Convertido' else 'Perdido' end as status
from events
"""

VENDAS_SQL = """
select l.l_orderkey * 100 + row_number() over (partition by l.l_orderkey order by l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_quantity, l.l_shipdate, l.l_tax, l.l_discount) as id,
  o.o_custkey as cliente_id, l.l_partkey as produto_id, cast(l.l_quantity as int) as quantidade,
  cast(900 + l.l_partkey % 100 as decimal(15,2)) as preco_unitario,
  case when l.l_linenumber % 3 = 0 then cast(cast(l.l_linenumber as decimal(4,2)) / 100 as decimal(4,2)) else cast(0 as decimal(4,2)) end as desconto,
  case l.l_linenumber % 4 when 0 then 'Pendente' when 1 then 'Processando' when 2 then 'Enviado' else 'Entregue' end as status,
  o.o_orderdate as data_venda
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
"""

# Raw (un-conformed) mapping per domain table.
MAPPINGS: dict[str, str] = {
    "clientes": CLIENTES_SQL,
    "pedidos": PEDIDOS_SQL,
    "produtos": PRODUTOS_SQL,
    "itens_pedido": ITENS_PEDIDO_SQL,
    "campanhas_marketing": CAMPANHAS_SQL,
    "leads": LEADS_SQL,
    "atividades": ATIVIDADES_SQL,
    "lead_historico": LEAD_HISTORICO_SQL,
    "vendas": VENDAS_SQL,
}

# Which base tables each mapping reads.
MAPPING_INPUTS: dict[str, tuple[str, ...]] = {
    "clientes": ("customer",),
    "pedidos": ("orders",),
    "produtos": ("part",),
    "itens_pedido": ("lineitem",),
    "campanhas_marketing": ("nation",),
    "leads": ("events",),
    "atividades": ("events",),
    "lead_historico": ("events",),
    "vendas": ("lineitem", "orders"),
}

# Generated (STORED) columns in SQL, for oracle CTEs that need them.
GENERATED_SQL: dict[str, str] = {
    "pedidos": "cast(valor_bruto - desconto as decimal(15,2)) as valor_liquido",
    "itens_pedido": "cast(quantidade * preco_unitario - desconto_item as decimal(15,2)) as valor_total",
}


def register_base(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    """Register the given parquet tables as temp views under their own names."""
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


# Order of lineitem rows within an order, for the item ids.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
              "l_shipdate", "l_tax", "l_discount")


# Item ids: the order's key times this, plus the item's place in the order.
IDS_PER_ORDER = 100


def _numbered_lines(spark: SparkSession, sf_dir: str, above: int | None = None) -> DataFrame:
    """Lineitem rows with their rank inside the order (``row_number`` of the SQL
    mapping), computed so that one huge order does not land in a single task.
    ``above``: only those of orders with a greater key."""
    from pyspark.sql import functions as F

    from rivulet.operators.windows import row_number_skew_safe
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if above is not None:
        li = li.filter(F.col("l_orderkey") > above)
    n = row_number_skew_safe(li, "l_orderkey", LINE_ORDER, "line_rank")
    return n.withColumn("__item_id", F.col("l_orderkey") * IDS_PER_ORDER + F.col("line_rank"))


def _lines(spark: SparkSession, sf_dir: str, with_id: bool, above: int | None = None) -> DataFrame:
    """Lineitem rows; numbering them costs a range shuffle, so only for callers that read the id."""
    from pyspark.sql import functions as F
    if with_id:
        return _numbered_lines(spark, sf_dir, above)
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("__item_id", F.lit(None).cast("long"))


def _itens_pedido(spark: SparkSession, sf_dir: str, with_id: bool = True, above: int | None = None) -> DataFrame:
    from pyspark.sql import functions as F
    return _lines(spark, sf_dir, with_id, above).select(
        F.col("__item_id").alias("id"), F.col("l_orderkey").alias("pedido_id"),
        F.col("l_partkey").alias("produto_id"), F.col("l_quantity").cast("int").alias("quantidade"),
        (F.lit(900) + F.col("l_partkey") % 100).cast("decimal(15,2)").alias("preco_unitario"),
        F.col("l_linenumber").cast("decimal(15,2)").alias("desconto_item"))


def _vendas(spark: SparkSession, sf_dir: str, with_id: bool = True) -> DataFrame:
    from pyspark.sql import functions as F
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    ln = F.col("l_linenumber")
    return _lines(spark, sf_dir, with_id).join(o, "l_orderkey").select(
        F.col("__item_id").alias("id"), F.col("o_custkey").alias("cliente_id"),
        F.col("l_partkey").alias("produto_id"), F.col("l_quantity").cast("int").alias("quantidade"),
        (F.lit(900) + F.col("l_partkey") % 100).cast("decimal(15,2)").alias("preco_unitario"),
        F.when(ln % 3 == 0, (ln.cast("decimal(4,2)") / 100).cast("decimal(4,2)"))
        .otherwise(F.lit(0).cast("decimal(4,2)")).alias("desconto"),
        F.when(ln % 4 == 0, "Pendente").when(ln % 4 == 1, "Processando")
        .when(ln % 4 == 2, "Enviado").otherwise("Entregue").alias("status"),
        F.col("o_orderdate").alias("data_venda"))


# Spark-side builders that replace a SQL text where the text's window would put
# a hot key into one task (same rows as the SQL, which the oracle keeps using).
SKEW_SAFE_BUILDERS = {"itens_pedido": _itens_pedido, "vendas": _vendas}


def mapped(spark: SparkSession, sf_dir: str, name: str, with_id: bool = True) -> DataFrame:
    """The raw mapping of one domain table, as a DataFrame over the parquet scan.

    ``with_id=False``: the table without its numbered ``id`` column, where it has one.
    """
    if name in SKEW_SAFE_BUILDERS:
        df = SKEW_SAFE_BUILDERS[name](spark, sf_dir, with_id)
        return df if with_id else df.drop("id")
    register_base(spark, sf_dir, MAPPING_INPUTS[name])
    return spark.sql(MAPPINGS[name])


def items_above(spark: SparkSession, sf_dir: str, key: int) -> DataFrame:
    """``itens_pedido`` of the orders with a greater key; the filter reaches the scan."""
    return _itens_pedido(spark, sf_dir, True, key)


def oracle_cte(names: list[str] | tuple[str, ...], generated: bool = True) -> str:
    """``WITH`` clause defining the named domain tables for a DuckDB oracle query."""
    parts = []
    for n in names:
        body = MAPPINGS[n].strip()
        if generated and n in GENERATED_SQL:
            body = f"select m.*, {GENERATED_SQL[n]} from ({body}) m"
        parts.append(f"{n} as ({body})")
    return "with " + ",\n".join(parts) + "\n"
