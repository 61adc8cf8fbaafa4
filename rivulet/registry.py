"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every entry reads the given parquet tables (through the fixture mappings) so its
work grows with them.  ``comparable`` fixes the output types shared with the
DuckDB oracle: decimals leave as double, zoned timestamps as wall-clock
``timestamp_ntz`` in UTC.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.plans.medallion import Models
from rivulet.session import ensure_conf
from rivulet.sources.tables import fixture_root

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def models(spark: SparkSession, sf_dir: str) -> Models:
    ensure_conf(spark)
    return Models(fixture_root(spark, sf_dir))


MODEL_NAMES = (
    "bronze_clientes", "bronze_pedidos", "bronze_produtos", "bronze_leads",
    "dim_clientes", "fct_pedidos", "silver_clientes", "silver_pedidos", "silver_produtos",
    "silver_leads", "agg_valor_pedidos_por_cliente_mensal", "gold_visao_geral_clientes",
)


def _model_query(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(models(spark, sf_dir).ref(name))
    run.__name__ = name
    return run


for _n in MODEL_NAMES:
    register(_n)(_model_query(_n))


# ---------------------------------------------------------------- CDC

def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.streaming.changelog import change_log
    ensure_conf(spark)
    return change_log(fixture_root(spark, sf_dir))


def _replica(table: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from rivulet.streaming.cdc import apply_changes
        return comparable(apply_changes(_log(spark, sf_dir))[table])
    run.__name__ = f"cdc_replica_{table}"
    return run


for _t in ("clientes", "pedidos", "produtos", "leads"):
    register(f"cdc_replica_{_t}")(_replica(_t))


@register("cdc_control_table")
def cdc_control_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.streaming.cdc import control_counts
    return comparable(control_counts(_log(spark, sf_dir)))


@register("cdc_quarantine")
def cdc_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.streaming.cdc import quarantine
    return quarantine(_log(spark, sf_dir))


@register("cdc_stream_replica_clientes")
def cdc_stream_replica_clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log through Structured Streaming in several micro-batches,
    applied by the merge-on-read sink; must equal the one-batch fold."""
    return comparable(_streamed_sink(spark, sf_dir).state("clientes"))


def _streamed_sink(spark: SparkSession, sf_dir: str, log=None, **options):
    """The sink after the whole log (of ``log(root)``) has gone through a streaming query."""
    import uuid

    from rivulet.schemas import CHANGE_EVENT
    from rivulet.session import checkpoint_dir, release
    from rivulet.streaming.changelog import change_log_steps
    from rivulet.streaming.cdc import SnapshotSink, delete_path
    from rivulet.streaming.replication import read_changes, stage_log, start

    ensure_conf(spark)
    base = f"{checkpoint_dir(spark).rstrip('/')}/cdc-{uuid.uuid4().hex}"
    stage_log((log or change_log_steps)(fixture_root(spark, sf_dir)), f"{base}/log", fmt="parquet")
    release(spark)
    # About four micro-batches in all, with a compaction on the way.
    files = len(spark.read.schema(CHANGE_EVENT).parquet(f"{base}/log").inputFiles())
    # Nobody reads an older commit of this replica, so what a batch replaces goes at once.
    sink = SnapshotSink(spark, f"{base}/replica", compact_every=3, keep=1, **options)
    q = start(read_changes(spark, "files", f"{base}/log", max_per_trigger=-(-files // 4), fmt="parquet"), sink,
              f"{base}/checkpoint", available_now=True)
    q.awaitTermination()
    # The whole log has been applied.
    delete_path(spark, f"{base}/log")
    return sink


def _sink_query(table: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sink = _streamed_sink(spark, sf_dir)
        if table == "control":
            return comparable(sink.control())
        return sink.quarantine() if table == "quarantine" else comparable(sink.state(table))
    run.__name__ = f"cdc_sink_{table}"
    return run


for _t in ("pedidos", "produtos", "leads", "control", "quarantine"):
    register(f"cdc_sink_{_t}")(_sink_query(_t))


@register("cdc_unique_pedidos")
def cdc_unique_pedidos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after a log with claims on each other's numbers, in several micro-batches with the UNIQUE column enforced."""
    from rivulet.streaming.changelog import unique_log_steps
    sink = _streamed_sink(spark, sf_dir, unique_log_steps, unique=True)
    return sink.state("pedidos").select("id", "numero_pedido", "status")


@register("cdc_unique_violations")
def cdc_unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log in one batch: the claims that are rejected."""
    from functools import reduce

    from rivulet.streaming.cdc import quarantine
    from rivulet.streaming.changelog import unique_log_steps
    ensure_conf(spark)
    log = reduce(DataFrame.unionByName, unique_log_steps(fixture_root(spark, sf_dir)))
    return quarantine(log, unique=True).select("topic", "partition", "offset", "reason")


@register("cdc_replica_key_range")
def cdc_replica_key_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a range of keys, from the runs that may hold one only."""
    return comparable(_streamed_sink(spark, sf_dir).state("pedidos", keys=(1000, 5000)))


def _replayed_steps(root):
    """The change log, its second step delivered once more at the end."""
    from rivulet.streaming.changelog import change_log_steps
    steps = change_log_steps(root)
    return steps + [steps[1]]


@register("cdc_sink_partitions")
def cdc_sink_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounting per topic and partition after a log that delivers a step twice: repeats are counted, not applied."""
    return comparable(_streamed_sink(spark, sf_dir, _replayed_steps, track_offsets=True).partitions())


@register("cdc_offset_coverage")
def cdc_offset_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of the log a partition: consumed, missing between the first and the last, and in how many gaps."""
    from rivulet.streaming import offsets
    return offsets.coverage(offsets.ledger(_log(spark, sf_dir)))


# ---------------------------------------------------------------- serving (Q1-Q12)

def _source(spark: SparkSession, sf_dir: str):
    ensure_conf(spark)
    return fixture_root(spark, sf_dir)


def _replica_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    from rivulet.streaming.cdc import apply_changes
    return apply_changes(_log(spark, sf_dir))


@register("q1_replication_lag")
def q1_replication_lag(spark, sf_dir):
    from rivulet.operators import serving
    src, rep = _source(spark, sf_dir), _replica_tables(spark, sf_dir)
    names = ("clientes", "pedidos")
    return serving.row_counts({n: src.table(n) for n in names}, {n: rep[n] for n in names})


@register("q2_total_revenue")
def q2_total_revenue(spark, sf_dir):
    from rivulet.operators import serving
    return serving.total_revenue(_replica_tables(spark, sf_dir)["pedidos"])


@register("q3_average_ticket")
def q3_average_ticket(spark, sf_dir):
    from rivulet.operators import serving
    return serving.average_ticket(_replica_tables(spark, sf_dir)["pedidos"])


@register("q4_counts_long")
def q4_counts_long(spark, sf_dir):
    from rivulet.operators import serving
    return serving.counts_long(q1_replication_lag(spark, sf_dir))


@register("q5_latest_customers")
def q5_latest_customers(spark, sf_dir):
    from rivulet.operators import serving
    return serving.latest_customers(_replica_tables(spark, sf_dir)["clientes"])


@register("q6_latest_orders")
def q6_latest_orders(spark, sf_dir):
    from rivulet.operators import serving
    return comparable(serving.latest_orders(_replica_tables(spark, sf_dir)["pedidos"]))


@register("q7_top_customers")
def q7_top_customers(spark, sf_dir):
    from rivulet.operators import serving
    return serving.top_customers(models(spark, sf_dir)["gold_visao_geral_clientes"])


@register("q8_revenue_by_status")
def q8_revenue_by_status(spark, sf_dir):
    from rivulet.operators import serving
    return serving.revenue_by_status(_replica_tables(spark, sf_dir)["pedidos"])


@register("q9_control_by_count")
def q9_control_by_count(spark, sf_dir):
    from rivulet.operators import serving
    from rivulet.streaming.cdc import control_counts
    return comparable(serving.control_by_count(control_counts(_log(spark, sf_dir))))


@register("q10_items_revenue")
def q10_items_revenue(spark, sf_dir):
    from rivulet.operators import serving
    return serving.items_revenue(_source(spark, sf_dir).without_id("itens_pedido"))


@register("q11_latest_item_with_customer")
def q11_latest_item_with_customer(spark, sf_dir):
    from rivulet.operators import serving
    from rivulet.sources import fixtures
    src = _source(spark, sf_dir)
    return serving.latest_item_with_customer(lambda key: fixtures.items_above(spark, sf_dir, key), src.without_id("itens_pedido"),
                                             src.table("pedidos"), src.table("clientes"), fixtures.IDS_PER_ORDER)


@register("q12_stacked_metrics")
def q12_stacked_metrics(spark, sf_dir):
    from rivulet.operators import serving
    src = _source(spark, sf_dir)
    c, p = src.table("clientes"), src.table("pedidos")
    return serving.stack_metrics({
        "clientes": c.agg(F.count(F.lit(1))),
        "pedidos": p.agg(F.count(F.lit(1))),
        "receita_total": serving.total_revenue(p),
        "ticket_medio": serving.average_ticket(p),
    })


# ---------------------------------------------------------------- services

def _svc(name: str, build):
    def run(spark, sf_dir):
        from rivulet.operators import services as S
        return comparable(build(S, _source(spark, sf_dir)))
    run.__name__ = name
    register(name)(run)


_svc("m1_products_page", lambda S, r: S.products_page(r.table("produtos"), 100, "Economy"))
_svc("m2_sales_page", lambda S, r: S.sales_page(r.table("vendas"), 100, "1998-01-01"))
_svc("m3_vip_customers_page", lambda S, r: S.customers_page(r.table("clientes"), 100, True))
_svc("m4_sales_summary", lambda S, r: S.sales_summary(r.without_id("vendas"), r.table("produtos"),
                                                      r.table("clientes")))
_svc("m5_sales_per_status", lambda S, r: S.count_by(r.without_id("vendas"), "status"))
_svc("m6_units_per_product", lambda S, r: S.units_per_product(r.without_id("vendas")))
_svc("m7_sale_amounts", lambda S, r: S.with_amount(r.table("vendas")).select("id", "valor_total"))
_svc("m8_stock_after_sales", lambda S, r: S.stock_after_sales(r.table("produtos"), r.without_id("vendas")))
_svc("m9_customer_lifetime", lambda S, r: S.customer_lifetime(r.without_id("vendas")))
_svc("m10_leads_page", lambda S, r: S.leads_page(r.table("leads"), 100, "novo"))
_svc("m11_campaigns_page", lambda S, r: S.campaigns_page(r.table("campanhas_marketing"), 5))
_svc("m12_activities_page", lambda S, r: S.activities_page(r.table("atividades"), 100))
_svc("m13_crm_summary", lambda S, r: S.crm_summary(r.table("leads"), r.table("campanhas_marketing"),
                                                   r.table("atividades")))
_svc("m14_leads_per_status", lambda S, r: S.count_by(r.table("leads"), "status"))
_svc("m15_activities_per_type", lambda S, r: S.count_by(r.table("atividades"), "tipo"))
_svc("m16_leads_per_campaign", lambda S, r: S.leads_per_campaign(r.table("campanhas_marketing"),
                                                                 r.table("leads")))
_svc("m17_last_contact", lambda S, r: S.last_contact(r.table("leads"), r.table("atividades")))
_svc("m18_funnel_check", lambda S, r: S.funnel_check(r.table("lead_historico")))


@register("m9_customer_lifetime_stream")
def m9_customer_lifetime_stream(spark, sf_dir):
    """M9 as a streaming aggregate over the sales in files: about three micro-batches, a stop, and the rest."""
    from rivulet.streaming import lifetime
    sales = _source(spark, sf_dir).without_id("vendas")
    base = _lake(spark)
    # Every sale once: which half a row falls in follows from its own values.
    half = F.pmod(F.xxhash64(*sales.columns), F.lit(2))
    for part in (0, 1):
        sales.filter(half == part).write.mode("append").parquet(f"{base}/vendas")
        files = len(spark.read.schema(sales.schema).parquet(f"{base}/vendas").inputFiles())
        stream = lifetime.read_sales(spark, f"{base}/vendas", sales.schema, max_per_trigger=-(-files // 2))
        query = lifetime.start(stream, f"{base}/totals", f"{base}/checkpoint")
        query.awaitTermination()
        query.stop()
    return comparable(lifetime.totals(spark, f"{base}/totals"))


# ---------------------------------------------------------------- data quality (D1-D9), O1, O2

@register("dq_declared_tests")
def dq_declared_tests(spark, sf_dir):
    from rivulet.operators import quality
    return quality.run_checks(spark, quality.DECLARED, models(spark, sf_dir).ref)


@register("dq_ddl_constraints")
def dq_ddl_constraints(spark, sf_dir):
    from rivulet.operators import quality
    return quality.run_checks(spark, quality.DDL + quality.REPLICA_LENGTH_CHECKS,
                              models(spark, sf_dir).ref)


@register("dq_schema_contract")
def dq_schema_contract(spark, sf_dir):
    from rivulet.operators import quality
    from rivulet.sources.tables import DOMAIN_TABLES
    return quality.schema_contract(spark, DOMAIN_TABLES, _source(spark, sf_dir).table)


@register("dq_non_empty")
def dq_non_empty(spark, sf_dir):
    from rivulet.operators import quality
    return quality.non_empty(_source(spark, sf_dir).table)


def _lake(spark) -> str:
    import uuid

    from rivulet.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex}"


@register("o1_refresh_silver_gold")
def o1_refresh_silver_gold(spark, sf_dir):
    """Refresh the silver and gold layers into the lake, read gold back."""
    from rivulet.plans.medallion import refresh
    m = models(spark, sf_dir)
    refresh(m, ("silver", "gold"), lake_root=_lake(spark))
    return comparable(m.ref("gold_visao_geral_clientes"))


@register("s6_published_tables")
def s6_published_tables(spark, sf_dir):
    """Two refreshes into the catalog: the second one's swap is what is read."""
    from rivulet.plans.medallion import layer_schema, refresh
    where = _lake(spark)
    for _ in range(2):
        refresh(models(spark, sf_dir), ("dimension",), use_catalog=True, database_root=where)
    return comparable(spark.table(f"{layer_schema('silver')}.dim_clientes"))


@register("o2_refresh_then_test")
def o2_refresh_then_test(spark, sf_dir):
    from rivulet.plans.medallion import refresh_and_test
    return refresh_and_test(models(spark, sf_dir), lake_root=_lake(spark))


# ---------------------------------------------------------------- table rules

def _seed_rows(clientes: DataFrame, new_email_mod: int, keep_cpf_mod: int | None = None) -> DataFrame:
    """New customer rows derived from every tenth customer: a fresh id, the
    customer's own e-mail for every ``new_email_mod``-th (a conflict) else a new one."""
    k = F.col("id")
    cpf = F.col("cpf") if keep_cpf_mod is None else F.when(k % keep_cpf_mod == 0, F.col("cpf")) \
        .otherwise(F.concat(F.lit("9"), F.col("cpf")))
    return clientes.filter(k % 10 == 0).select(
        *[(k + 1_000_000_000).alias("id") if c == "id" else
          F.when(k % new_email_mod == 0, F.col("email"))
          .otherwise(F.concat(F.lit("novo"), k.cast("string"), F.lit("@seed.com"))).alias("email")
          if c == "email" else cpf.alias("cpf") if c == "cpf" else F.col(c)
          for c in clientes.columns])


@register("r6_update_by_key")
def r6_update_by_key(spark, sf_dir):
    from rivulet.operators import rules
    from rivulet.sources.tables import AS_OF_ORDERS
    c = _source(spark, sf_dir).table("clientes")
    changes = c.filter(F.col("id") % 7 == 0).select(
        "id", F.concat(F.lit("novo"), F.col("id").cast("string"), F.lit("@email.com")).alias("email"))
    return comparable(rules.update_by_key(c, changes, "id", AS_OF_ORDERS))


@register("r7_insert_if_absent")
def r7_insert_if_absent(spark, sf_dir):
    from rivulet.operators import rules
    c = _source(spark, sf_dir).table("clientes")
    return comparable(rules.insert_if_absent(c, _seed_rows(c, 20), "email"))


@register("r8_insert_on_conflict_do_nothing")
def r8_insert_on_conflict_do_nothing(spark, sf_dir):
    from rivulet import schemas
    from rivulet.operators import rules
    c = _source(spark, sf_dir).table("clientes")
    first = _seed_rows(c, 20, keep_cpf_mod=30)
    # Chains: the second row shares its cpf with the first, the third its e-mail
    # with the second, so it goes in exactly where the second is skipped.
    cpf = c.select((F.col("id") + 1_000_000_000).alias("id"), F.col("cpf").alias("__cpf"))
    email = F.concat(F.lit("cadeia"), F.col("id").cast("string"), F.lit("@seed.com"))

    def link(n: int, digit: str) -> DataFrame:
        return (first.join(cpf, "id").withColumn("email", email).withColumn("cpf", F.concat(F.lit(digit), "__cpf"))
                .withColumn("id", F.col("id") + n * 1_000_000_000).select(*c.columns))
    rows = first.unionByName(link(1, "9")).unionByName(link(2, "8"))
    return comparable(rules.insert_on_conflict_do_nothing(c, rows, ("id",) + schemas.UNIQUE_KEYS["clientes"]))


@register("r9_delete_cascade")
def r9_delete_cascade(spark, sf_dir):
    from rivulet.operators import rules
    src = _source(spark, sf_dir)
    p, i = src.table("pedidos"), src.table("itens_pedido")
    _, children = rules.delete_cascade(p, i, p.filter(F.col("id") % 50 == 0).select("id"))
    return children.select("id", "pedido_id", "produto_id", "quantidade")


@register("r10_random_sample")
def r10_random_sample(spark, sf_dir):
    from rivulet.operators import rules
    return comparable(rules.random_sample(_source(spark, sf_dir).table("clientes"), 10, seed=7))


@register("r1_r3_generated_columns")
def r1_r3_generated_columns(spark, sf_dir):
    """Generated columns recomputed on the item table (R3) with R1 on orders."""
    src = _source(spark, sf_dir)
    i = src.without_id("itens_pedido").select("pedido_id", "valor_total")
    p = src.table("pedidos").select(F.col("id").alias("pedido_id"), "valor_liquido")
    return comparable(i.groupBy("pedido_id").agg(F.sum("valor_total").alias("itens_total"))
                      .join(p, "pedido_id", "inner"))


# ---------------------------------------------------------------- sources and sinks

@register("s3_choose_root")
def s3_choose_root(spark, sf_dir):
    from rivulet.sources.tables import Root, choose_root
    reps = _replica_tables(spark, sf_dir)
    replica = Root(spark, lambda n: reps[n], "replica")
    chosen = choose_root(replica, _source(spark, sf_dir))
    return chosen.table("clientes").agg(F.count(F.lit(1)).alias("linhas")) \
        .select(F.lit(chosen.name).alias("root"), "linhas")


@register("s4_full_refresh_copy")
def s4_full_refresh_copy(spark, sf_dir):
    from rivulet.sources.tables import full_refresh_copy
    paths = full_refresh_copy(_source(spark, sf_dir), ["clientes", "pedidos"], _lake(spark))
    out = None
    for name, path in paths.items():
        n = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("linhas")) \
            .select(F.lit(name).alias("tabela"), "linhas")
        out = n if out is None else out.unionByName(n)
    return out


def _product_pages(spark, sf_dir) -> DataFrame:
    """Products as service responses (page, value) of 100 items."""
    p = _source(spark, sf_dir).table("produtos")
    item = F.struct("id", "nome", "categoria", F.col("preco_venda").cast("double").alias("preco"),
                    F.col("estoque_atual").alias("estoque"), "ativo")
    return (p.withColumn("page", F.floor((F.col("id") - 1) / 100))
            .groupBy("page")            # pages hold at most 100 items
            .agg(F.count(F.lit(1)).alias("total"), F.collect_list(item).alias("dados"))
            .select("page", F.to_json(F.struct("total", "dados",
                                               F.lit("2001-08-01T00:00:00").alias("timestamp")))
                    .alias("value")))


_ITEM_DDL = "id bigint, nome string, categoria string, preco double, estoque int, ativo boolean"


@register("s9_document_ingest")
def s9_document_ingest(spark, sf_dir):
    """Products published as service responses of 100 items, many to a file, read back."""
    from rivulet.sources.tables import read_documents
    path = _lake(spark) + "/produtos-api"
    _product_pages(spark, sf_dir).select("value").write.text(path)
    return read_documents(spark, path, T.StructType.fromDDL(_ITEM_DDL), multi_line=False) \
        .select("id", "nome", "categoria", "preco", "estoque", "ativo")


@register("s9_document_rejects")
def s9_document_rejects(spark, sf_dir):
    """The same responses, some broken: documents by reason, and the items of those that load."""
    from rivulet.sources.tables import documents_with_rejects
    page, value = F.col("page"), F.col("value")
    broken = (F.when(page % 5 == 1, F.expr("left(value, length(value) - 7)"))
              .when(page % 5 == 2, F.regexp_replace(value, '"dados":', '"data":'))
              .when(page % 5 == 3, F.concat(F.expr("left(value, length(value) - 1)"), F.lit(',"total":"many"}')))
              .when(page % 5 == 4, F.regexp_replace(value, '"total":[0-9]+', '"total":0')).otherwise(value))
    path = _lake(spark) + "/produtos-api"
    _product_pages(spark, sf_dir).select(broken.alias("value")).write.text(path)
    items, rejects = documents_with_rejects(spark, path, T.StructType.fromDDL(_ITEM_DDL), multi_line=False)
    return (rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("linhas"))
            .unionByName(items.agg(F.lit("loaded_items").alias("reason"), F.count(F.lit(1)).alias("linhas"))))


@register("s10_csv_seed")
def s10_csv_seed(spark, sf_dir):
    from rivulet import schemas
    from rivulet.sources.tables import read_seed
    c = _source(spark, sf_dir).table("clientes")
    path = _lake(spark) + "/raw_seeds/clientes"
    opts = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    c.write.options(**opts).option("header", True).csv(path)
    return comparable(read_seed(spark, path, schema=schemas.CLIENTES, options=opts))


@register("s10_csv_rejects")
def s10_csv_rejects(spark, sf_dir):
    """Customers as CSV lines, some broken: the rejected rows with reason, and how many load."""
    from rivulet import schemas
    from rivulet.sources.tables import seed_with_rejects
    c = _source(spark, sf_dir).table("clientes")
    k, line = F.col("id"), F.col("line")
    rows = c.select(k, F.to_csv(F.struct(*c.columns)).alias("line"))
    broken = (F.when(k % 13 == 0, F.concat(line, F.lit(",extra")))
              .when(k % 17 == 0, F.regexp_extract(line, "^[^,]*,[^,]*", 0))
              .when(k % 19 == 0, F.concat(F.regexp_extract(line, "^(.*),[^,]*$", 1), F.lit(",many")))
              .otherwise(line))
    path = _lake(spark) + "/raw_seeds/clientes"
    rows.select(broken.alias("value")).write.text(path)
    good, rejects = seed_with_rejects(spark, path, schema=schemas.CLIENTES, options={"header": "false"})
    first = F.regexp_extract("record", "^[0-9]+", 0).cast("long")
    return (rejects.select(first.alias("id"), "reason", "columns")
            .unionByName(good.agg(F.count(F.lit(1)).alias("id"), F.lit("loaded").alias("reason"), F.lit(None).cast("string").alias("columns"))))
