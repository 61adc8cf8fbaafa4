"""The model graph: bronze -> silver -> gold over a table root.

``Models(root)`` builds every model lazily as a DataFrame; nothing runs until an
action or a write.  Bronze models are views, so Catalyst inlines them into the
silver plans (filters and projections fold into the parquet scan).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from rivulet.plans import bronze as B
from rivulet.plans import gold as G
from rivulet.plans import silver as S
from rivulet.sources.tables import AS_OF_LEADS, AS_OF_ORDERS, Root

#: Models written at a time (fixed value: threads of the default target).
THREADS = 4


@dataclass(frozen=True)
class Model:
    name: str
    layer: str                 # bronze | silver | gold
    materialized: str          # view | table
    tags: tuple[str, ...]
    deps: tuple[str, ...]      # models or raw tables it reads
    build: Callable[..., DataFrame]


def _model_list(as_of_orders, as_of_leads) -> list[Model]:
    return [
        Model("bronze_clientes", "bronze", "view", ("bronze", "clientes", "cdc"),
              ("clientes",), B.bronze_clientes),
        Model("bronze_pedidos", "bronze", "view", ("bronze", "pedidos", "cdc"),
              ("pedidos",), B.bronze_pedidos),
        Model("bronze_produtos", "bronze", "view", ("bronze", "produtos", "ecommerce", "cdc"),
              ("produtos",), B.bronze_produtos),
        Model("bronze_leads", "bronze", "view", ("bronze", "leads", "crm", "cdc"),
              ("leads",), B.bronze_leads),
        Model("dim_clientes", "silver", "table", ("silver", "dimension"),
              ("bronze_clientes",), lambda b: S.dim_clientes(b, as_of_orders)),
        Model("fct_pedidos", "silver", "table", ("silver", "fact"),
              ("bronze_pedidos", "bronze_clientes"), S.fct_pedidos),
        Model("silver_clientes", "silver", "table", ("silver",),
              ("bronze_clientes",), lambda b: S.silver_clientes(b, as_of_orders)),
        Model("silver_pedidos", "silver", "table", ("silver",),
              ("bronze_pedidos",), lambda b: S.silver_pedidos(b, as_of_orders)),
        Model("silver_produtos", "silver", "table", ("silver", "produtos", "ecommerce"),
              ("bronze_produtos",), lambda b: S.silver_produtos(b, as_of_orders)),
        Model("silver_leads", "silver", "table", ("silver", "leads", "crm"),
              ("bronze_leads",), lambda b: S.silver_leads(b, as_of_leads)),
        Model("agg_valor_pedidos_por_cliente_mensal", "gold", "table", ("gold",),
              ("bronze_pedidos", "bronze_clientes"), G.agg_valor_pedidos_por_cliente_mensal),
        Model("gold_visao_geral_clientes", "gold", "table", ("gold",),
              ("silver_clientes", "silver_pedidos"), G.gold_visao_geral_clientes),
    ]


class Models:
    """Lazily built model DataFrames over one root; ``refs`` can override inputs
    (e.g. a materialised silver table replaces its plan once written)."""

    def __init__(self, root: Root, as_of_orders=AS_OF_ORDERS, as_of_leads=AS_OF_LEADS):
        self.root = root
        self.models = {m.name: m for m in _model_list(as_of_orders, as_of_leads)}
        self.refs: dict[str, DataFrame] = {}

    def ref(self, name: str) -> DataFrame:
        if name in self.refs:
            return self.refs[name]
        if name not in self.models:           # a raw table of the root
            return self.root.table(name)
        m = self.models[name]
        df = m.build(*[self.ref(d) for d in m.deps])
        self.refs[name] = df
        return df

    __getitem__ = ref

    def ancestors(self, name: str) -> set[str]:
        """All models that ``name`` reads, directly or not."""
        direct = {d for d in self.models[name].deps if d in self.models}
        return direct.union(*(self.ancestors(d) for d in direct))

    def order(self, select_tags: Iterable[str] | None = None) -> list[Model]:
        """Models in dependency order; optionally only those with a given tag."""
        done: list[str] = []

        def visit(n: str):
            if n in done or n not in self.models:
                return
            for d in self.models[n].deps:
                visit(d)
            done.append(n)

        for n in self.models:
            visit(n)
        tags = set(select_tags or ())
        return [self.models[n] for n in done if not tags or tags & set(self.models[n].tags)]


def layer_schema(layer: str) -> str:
    """Models of a layer live in database ``public_<layer>``."""
    return f"public_{layer}"


class RefreshError(RuntimeError):
    """Models that failed, with their errors, and those not built because of them."""

    def __init__(self, failed: dict[str, Exception], skipped: list[str]):
        self.failed, self.skipped = failed, skipped
        text = "; ".join(f"{name}: {type(e).__name__}: {e}" for name, e in failed.items())
        super().__init__(text + (f"; not built: {', '.join(skipped)}" if skipped else ""))


def refresh(models: Models, select_tags: Iterable[str] | None = None, lake_root: str | None = None,
            use_catalog: bool = False, threads: int = THREADS, database_root: str | None = None) -> dict[str, str]:  # O1
    """Materialise models, each as soon as those it reads are written (full rebuild each run).

    Views (bronze) become temp views (S5).  Tables are written as parquet under
    ``<lake_root>/<layer>-data/<model>`` (S8) or, with ``use_catalog``, published
    as ``public_<layer>.<model>`` (S6, ``publish``; new databases go under
    ``database_root`` if given).  After a table is written its
    downstream models read the written copy, which also cuts the lineage.

    Up to ``threads`` models are written at a time, each in a scheduler pool of its
    own name; they share the executors fairly where the session was launched with
    ``spark.scheduler.mode=FAIR``.  A model that fails stops those that read it, not
    the others; ``RefreshError`` then names it.  Returns model -> location.
    """
    spark = models.root.spark
    selected = models.order(select_tags)
    waits = {m.name: models.ancestors(m.name) & {s.name for s in selected} for m in selected}
    out: dict[str, str] = {}
    failed: dict[str, Exception] = {}
    skipped: list[str] = []
    if use_catalog:
        for layer in sorted({m.layer for m in selected if m.materialized == "table"}):
            at = f" location '{database_root}/{layer_schema(layer)}'" if database_root else ""
            spark.sql(f"create database if not exists {layer_schema(layer)}{at}")

    def write(m: Model, df: DataFrame) -> tuple[str, DataFrame]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", m.name)
        spark.sparkContext.setJobDescription(f"refresh {m.name}")
        if use_catalog:
            name = publish(df, layer_schema(m.layer), m.name)
            return name, spark.table(name)
        path = f"{lake_root}/{m.layer}-data/{m.name}"
        df.write.mode("overwrite").parquet(path)
        return path, spark.read.parquet(path)

    todo, running = list(selected), {}
    with ThreadPoolExecutor(threads) as pool:
        while todo or running:
            for m in list(todo):
                if waits[m.name] & (failed.keys() | set(skipped)):
                    skipped.append(m.name)
                elif waits[m.name] <= out.keys():
                    try:  # plans are built here: ``models`` belongs to one thread
                        df = models.ref(m.name)
                        if m.materialized == "view" or not (use_catalog or lake_root is not None):
                            df.createOrReplaceTempView(m.name)
                            out[m.name] = f"view:{m.name}"
                        else:
                            running[pool.submit(inheritable_thread_target(spark)(write), m, df)] = m
                    except Exception as error:
                        failed[m.name] = error
                else:
                    continue
                todo.remove(m)
            for done in wait(running, return_when=FIRST_COMPLETED).done if running else ():
                m = running.pop(done)
                if done.exception() is None:
                    out[m.name], models.refs[m.name] = done.result()
                else:
                    failed[m.name] = done.exception()
    if failed:
        raise RefreshError(failed, skipped) from next(iter(failed.values()))
    return {m.name: out[m.name] for m in selected}


def publish(df: DataFrame, database: str, name: str, keep: int = 2) -> str:  # S6
    """Write ``df`` as a new version and point ``database.name`` at it in one step.

    The name is a view over the version's folder, replaced by one change of the
    catalog entry, new columns included.  A reader sees the old rows or the new
    ones, never none; a write that fails leaves the old ones.  The ``keep`` newest
    versions stay, for readers that began before.  A plain table of that name, from
    before, is dropped first (once).
    """
    spark = df.sparkSession
    base = f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/_versions/{name}"
    path = f"{base}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    full = f"{database}.{name}"
    if spark.catalog.tableExists(full) and spark.catalog.getTable(full).tableType != "VIEW":
        spark.sql(f"drop table {full}")
    spark.sql(f"create or replace view {full} as select * from parquet.`{path}`")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    versions = sorted((status.getPath() for status in files.listStatus(folder)), key=lambda v: v.getName())
    for old in versions[:-keep]:
        if old.getName() != path.rsplit("/", 1)[1]:
            files.delete(old, True)
    return full


def refresh_and_test(models: Models, lake_root: str | None = None,
                     select_tags: Iterable[str] | None = None, checks=None):  # O2
    """Refresh the layers (O1), then run the data tests (D1-D7) on what was
    written.  Raw tables resolve through the models' root."""
    from rivulet.operators import quality

    at = refresh(models, select_tags, lake_root=lake_root)
    checks = quality.DECLARED if checks is None else checks
    stored = {name for name, place in at.items() if not place.startswith("view:")}
    return quality.run_checks(models.root.spark, checks, models.ref, stored=stored)
