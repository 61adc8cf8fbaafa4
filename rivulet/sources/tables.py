"""Table sources.

A *root* resolves a table name to a DataFrame.  Models never read paths
themselves: they receive DataFrames from a root, so the same model runs over
the source tables, a parquet copy, or the CDC replica.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet import schemas
from rivulet.operators import rules
from rivulet.sources import fixtures

# Reference dates of the fixtures (CURRENT_DATE stand-ins).
AS_OF_ORDERS = _dt.date(2001, 8, 1)
AS_OF_LEADS = _dt.date(2024, 1, 31)

DOMAIN_TABLES = ("clientes", "pedidos", "produtos", "itens_pedido", "campanhas_marketing", "leads")
EXTRA_TABLES = ("atividades", "lead_historico", "vendas")


class Root:
    """Resolves table names to DataFrames (``{{ source('raw_data', name) }}``)."""

    def __init__(self, spark: SparkSession, loader: Callable[[str], DataFrame], name: str = "root",
                 loader_without_id: Callable[[str], DataFrame] | None = None):
        self.spark = spark
        self._without_id = loader_without_id
        self._loader = loader
        self.name = name
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._loader(name)
        return self._cache[name]

    def without_id(self, name: str) -> DataFrame:
        """The table without its ``id`` column, spared the work of making one where it is made."""
        return self._without_id(name) if self._without_id else self.table(name).drop("id")

    __call__ = table


def as_of_for(table: str) -> _dt.date:
    return AS_OF_LEADS if table in ("leads", "atividades", "lead_historico",
                                    "campanhas_marketing") else AS_OF_ORDERS


def fixture_root(spark: SparkSession, sf_dir: str) -> Root:
    """Domain tables mapped from the star schema at ``sf_dir`` (FIXTURES.md)."""

    def load(name: str) -> DataFrame:
        raw = fixtures.mapped(spark, sf_dir, name)
        if name in schemas.SCHEMAS:
            return rules.conform(raw, name, as_of_for(name))
        return raw

    def load_without_id(name: str) -> DataFrame:
        raw = fixtures.mapped(spark, sf_dir, name, with_id=False)
        return (rules.conform(raw, name, as_of_for(name)) if name in schemas.SCHEMAS else raw).drop("id")

    return Root(spark, load, f"fixtures:{sf_dir}", load_without_id)


def parquet_root(spark: SparkSession, path: str) -> Root:
    """Tables stored as ``<path>/<name>`` parquet (a layer of the lake, or a copy)."""
    return Root(spark, lambda n: spark.read.parquet(f"{path}/{n}"), f"parquet:{path}")


#: Spark's error conditions for a table or path that is not there.
MISSING_TABLE = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def has_rows(df: DataFrame) -> bool:
    """At least one row, reading as little as possible (``LIMIT 1``)."""
    return not df.limit(1).isEmpty()


def choose_root(replica: Root, source: Root, probe_table: str = "clientes") -> Root:  # S3
    """Use the replica when it holds at least one ``clientes`` row, else the source."""
    try:
        table = replica.table(probe_table)
    except (AnalysisException, KeyError) as missing:
        # Only a replica table that does not exist yet means "use the source".
        if isinstance(missing, AnalysisException) and missing.getCondition() not in MISSING_TABLE:
            raise
        return source
    return replica if has_rows(table) else source


def full_refresh_copy(root: Root, names: Iterable[str], dest: str) -> dict[str, str]:  # S4
    """Overwrite-copy the named tables to ``<dest>/<name>``; returns name -> path."""
    out = {}
    for name in names:
        path = f"{dest}/{name}"
        root.table(name).write.mode("overwrite").parquet(path)
        out[name] = path
    return out


CORRUPT = "_corrupt_record"


def read_documents(spark: SparkSession, path: str, item_schema: T.StructType | None = None,
                   multi_line: bool = True) -> DataFrame:  # S9
    """Ingest service responses ``{total, dados: [...], timestamp}``: one row per item.

    ``multi_line``: a document may span lines, and a file is read as one; otherwise
    a file holds one document a line and splits.  Without ``item_schema`` Spark
    reads everything once more to infer it.  ``explode`` runs on the executors.
    Documents that can't be loaded give no row: ``documents_with_rejects`` tells which.
    """
    if item_schema is not None:
        return documents_with_rejects(spark, path, item_schema, multi_line)[0]
    docs = spark.read.option("multiLine", multi_line).json(path)
    return (docs.select(F.col("timestamp").alias("response_ts"), F.explode("dados").alias("d"))
            .select("response_ts", "d.*"))


def documents_with_rejects(spark: SparkSession, path: str, item_schema: T.StructType,
                           multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Items of the documents that load, and (file, record, reason) of those that don't.

    A document loads whole or not at all.  Reasons: ``invalid_json``; ``bad_value``, a
    value that doesn't fit the schema; ``no_items``, no list of items (an empty list is
    one); ``total_below_items``, a total smaller than the list.  A null item is a row
    of nulls.  Both frames read the files on their own.
    """
    schema = T.StructType([
        T.StructField("total", T.LongType()),
        T.StructField("dados", T.ArrayType(item_schema)),
        T.StructField("timestamp", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ])
    docs = (spark.read.option("multiLine", multi_line).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).schema(schema).json(path))
    record = F.col(CORRUPT)
    # Every top-level column takes part in the reason, so that both frames parse all of them.
    reason = (F.when(record.isNotNull() & F.get_json_object(record, "$").isNull(), "invalid_json")
              .when(record.isNotNull(), "bad_value")
              .when(F.col("dados").isNull(), "no_items")
              .when(F.col("total") < F.size("dados"), "total_below_items"))
    checked = docs.withColumn("reason", reason)
    items = (checked.filter(F.col("reason").isNull())
             .select(F.col("timestamp").alias("response_ts"), F.explode("dados").alias("d"))
             .select("response_ts", "d.*"))
    rejects = checked.filter(F.col("reason").isNotNull()).select(
        F.input_file_name().alias("file"),
        F.coalesce(record, F.to_json(F.struct("total", "dados", "timestamp"))).alias("record"), "reason")
    return items, rejects


def read_seed(spark: SparkSession, path: str, table: str | None = None,
              schema: T.StructType | None = None, options: dict | None = None) -> DataFrame:  # S10
    """CSV seed with a header, read with a declared schema (no inference).
    Array columns (CSV has none) are read as text.  Rows that don't fit the schema keep what
    does, the rest null, as Spark reads them; ``seed_with_rejects`` keeps them out."""
    schema = _seed_schema(table, schema)
    reader = spark.read.option("header", True).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def _seed_schema(table: str | None, schema: T.StructType | None) -> T.StructType | None:
    if schema is None and table is not None:
        schema = schemas.SCHEMAS[table]
    if schema is None:
        return None
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(
        f.dataType, T.ArrayType) else f.dataType, True) for f in schema.fields])


def seed_with_rejects(spark: SparkSession, path: str, table: str | None = None,
                      schema: T.StructType | None = None, options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV seed that fit the declared schema, and (file, record, reason, columns) of those that don't.

    Reasons: ``column_count``, more or fewer fields than columns; ``bad_value``, a field
    that its column's type can't hold (``columns``: which).  ``options`` are those of Spark's
    CSV reader.  Both frames read the files on their own.
    """
    schema = _seed_schema(table, schema)
    if schema is None:
        raise ValueError("name a table or give a schema: without one every row fits")
    options = options or {}
    names = [f.name for f in schema.fields]
    reader = (spark.read.option("header", True).options(**options).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT)
              .schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])))
    rows = reader.csv(path)
    # Generators, not filters: Spark refuses to read the corrupt column alone, as a count would.
    good = rows.select(F.inline(F.filter(F.array(F.struct(*names)), lambda _: F.col(CORRUPT).isNull())))
    bad = rows.select(F.input_file_name().alias("file"), F.inline(F.filter(F.array(F.struct(*names, CORRUPT)), lambda r: r[CORRUPT].isNotNull())))
    # The same record as texts: only a wrong number of fields is corrupt then.
    texts = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(CORRUPT, T.StringType())])
    parse = {**{k: str(v) for k, v in options.items() if k != "header"}, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    bad = bad.withColumn("__t", F.from_csv(F.col(CORRUPT), ", ".join(f"`{f.name}` string" for f in texts), parse))
    count = F.col(f"__t.{CORRUPT}").isNotNull()
    wrong = F.array_compact(F.array(*[F.when(F.col(f"__t.{n}").isNotNull() & F.col(n).isNull(), F.lit(n)) for n in names]))
    rejects = bad.select(
        "file", F.col(CORRUPT).alias("record"),
        F.when(count, "column_count").otherwise("bad_value").alias("reason"),
        F.when(~count, F.array_join(wrong, ",")).alias("columns"))
    return good, rejects
