"""Declarative data-quality checks (D1-D9) and the refresh-then-test run (O2).

A check names a model, a column and a kind; the runner turns each into a small
aggregate over the model and returns one report row per check::

    test, model, column, failures, status      (status: pass | warn | error)

Failures never stop the run (severity ``warn``, D4).  A check on a column the
model does not have reports ``error`` with NULL failures instead of raising.
All not-null, range and length checks of one model are conditional counts of one
aggregate, turned into report rows by exploding the one row it gives (a union of
selections would be pruned to one column each and scan the model once a check).
Unique checks go in two passes: one job counts 64-bit hashes of (column, value) for
all models (map-side combined, so a hot value is pre-counted per task) and writes
those that occur twice; only values with such a hash are compared themselves, so
hashes that collide do not count as repeats.  Relationships count child rows per key, then left-anti
join the distinct keys against the parent.  A model that several passes read is built
once: its checked columns are written to the shared folder first, unless it is stored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.rules import written
from rivulet.sources.tables import MISSING_TABLE


@dataclass(frozen=True)
class Check:
    kind: str                 # unique | not_null | relationships | range | max_length
    model: str
    column: str
    to: str | None = None     # relationships: parent model
    field: str | None = None  # relationships: parent column
    low: float | None = None  # range
    high: float | None = None
    max_len: int | None = None
    severity: str = "warn"

    @property
    def name(self) -> str:
        extra = f"_{self.to}_{self.field}" if self.kind == "relationships" else ""
        if self.kind == "max_length":
            extra = f"_{self.max_len}"
        return f"{self.kind}_{self.model}_{self.column}{extra}"


def _decl(model: str, spec: dict[str, Iterable]) -> list[Check]:
    out = []
    for column, kinds in spec.items():
        for k in kinds:
            if isinstance(k, tuple):       # ("relationships", parent, field)
                out.append(Check("relationships", model, column, to=k[1], field=k[2]))
            else:
                out.append(Check(k, model, column))
    return out


U, N = "unique", "not_null"

# The 58 declared tests (sources 10/22/4, silver 5/13/1, gold 1/2/0).
DECLARED: list[Check] = (
    _decl("clientes", {"id": [U, N], "nome": [N], "email": [U, N], "cpf": [U]})
    + _decl("pedidos", {"id": [U, N], "cliente_id": [N, ("relationships", "clientes", "id")],
                        "numero_pedido": [U, N], "valor_bruto": [N]})
    + _decl("produtos", {"id": [U, N], "codigo_produto": [U, N], "nome": [N], "preco_venda": [N]})
    + _decl("itens_pedido", {"id": [U, N],
                             "pedido_id": [N, ("relationships", "pedidos", "id")],
                             "produto_id": [N, ("relationships", "produtos", "id")],
                             "quantidade": [N], "preco_unitario": [N]})
    + _decl("campanhas_marketing", {"id": [U, N], "nome": [N], "tipo": [N], "data_inicio": [N]})
    + _decl("leads", {"id": [U, N], "nome": [N],
                      "campanha_id": [("relationships", "campanhas_marketing", "id")]})
    + _decl("dim_clientes", {"cliente_id": [U, N], "nome": [N], "email": [N, U]})
    + _decl("fct_pedidos", {"pedido_id": [U, N],
                            "cliente_id": [N, ("relationships", "dim_clientes", "cliente_id")],
                            "produto": [N], "quantidade": [N], "preco_unitario": [N],
                            "valor_total_pedido": [N]})
    + _decl("silver_clientes", {"cliente_id_origem": [U, N]})
    + _decl("silver_pedidos", {"pedido_id_origem": [U, N], "cliente_id_origem": [N],
                               "quantidade": [N]})
    + _decl("agg_valor_pedidos_por_cliente_mensal", {"valor_total_pedidos_mensal": [N]})
    + _decl("gold_visao_geral_clientes", {"cliente_id_origem": [U, N]})
)

# Constraints of the source DDL (D5-D7) beyond the declared tests.
DDL: list[Check] = [
    Check("range", "itens_pedido", "quantidade", low=1),
    Check("range", "leads", "score", low=0, high=100),
    Check("max_length", "clientes", "nome", max_len=255),
    Check("max_length", "clientes", "email", max_len=255),
    Check("max_length", "produtos", "nome", max_len=255),
    Check("max_length", "leads", "nome", max_len=255),
    Check("not_null", "produtos", "codigo_produto"),
    Check("unique", "pedidos", "numero_pedido"),
    Check("unique", "produtos", "codigo_produto"),
    Check("relationships", "itens_pedido", "pedido_id", to="pedidos", field="id"),
    Check("relationships", "leads", "campanha_id", to="campanhas_marketing", field="id"),
]

# Replica VARCHAR(200) limit for the same columns (D6): source
# rows longer than this fail to replicate.
REPLICA_LENGTH_CHECKS: list[Check] = [
    Check("max_length", "clientes", "nome", max_len=200),
    Check("max_length", "clientes", "email", max_len=200),
    Check("max_length", "leads", "nome", max_len=200),
]

REPORT_DDL = "test string, model string, column string, failures long, status string"


def _report_row(spark: SparkSession, check: Check, failures: DataFrame | None) -> DataFrame:
    if failures is None:
        return spark.createDataFrame([(check.name, check.model, check.column, None, "error")],
                                     REPORT_DDL)
    return failures.select(
        F.lit(check.name).alias("test"), F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column"), F.col("failures").cast("long").alias("failures"),
        F.when(F.col("failures") == 0, "pass").otherwise(F.lit(check.severity)).alias("status"))


def failures_of(check: Check, resolve: Callable[[str], DataFrame]) -> DataFrame | None:
    """One-row frame ``failures`` for a check, or None if the column is missing."""
    df = resolve(check.model)
    if check.column not in df.columns:
        return None
    c = F.col(check.column)
    if check.kind in ("not_null", "range", "max_length"):
        return df.agg(F.count(F.when(_violates(check), 1)).alias("failures"))
    if check.kind == "unique":
        dup = df.filter(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        return dup.agg(F.count(F.lit(1)).alias("failures"))
    if check.kind == "relationships":
        parent = resolve(check.to)
        if check.field not in parent.columns:
            return None
        # Count child rows per key first (map-side combined: a hot key becomes
        # one row per task), then anti-join one row per distinct key.
        per_key = df.filter(c.isNotNull()).groupBy(c.alias("__c")).agg(F.count(F.lit(1)).alias("n"))
        p = parent.select(F.col(check.field).alias("__k")).filter(F.col("__k").isNotNull())
        orphans = per_key.join(p, F.col("__c") == F.col("__k"), "left_anti")
        return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
    raise ValueError(f"unknown check kind {check.kind}")


def _built_once(checks: list[Check], resolve: Callable[[str], DataFrame], stored: Iterable[str]) -> Callable[[str], DataFrame]:
    """``resolve``, with the checked columns of models that several passes read written down."""
    passes: dict[str, set] = {}
    columns: dict[str, set[str]] = {}
    for ch in checks:
        kind = ch if ch.kind == "relationships" else ch.kind == "unique"
        passes.setdefault(ch.model, set()).add(kind)
        columns.setdefault(ch.model, set()).add(ch.column)
        if ch.kind == "relationships":
            passes.setdefault(ch.to, set()).add(ch)
            columns.setdefault(ch.to, set()).add(ch.field)
    kept: dict[str, DataFrame] = {}

    def once(name: str) -> DataFrame:
        if name in stored or len(passes.get(name, ())) < 2:
            return resolve(name)
        if name not in kept:
            df = resolve(name)
            read = [c for c in df.columns if c in columns[name]]
            kept[name] = written(df.select(*read)) if read else df
        return kept[name]
    return once


def run_checks(spark: SparkSession, checks: Iterable[Check], resolve: Callable[[str], DataFrame],
               hash64: Callable[..., Column] = F.xxhash64, stored: Iterable[str] = ()) -> DataFrame:
    """Report frame for ``checks``: one union of small aggregates, lazy but for models
    that are written and the first pass of the unique checks.  ``hash64`` hashes a column
    to a long; ``stored``: models that are tables already, so cheap to read again."""
    checks = list(checks)
    resolve = _built_once(checks, resolve, stored)
    frames: list[DataFrame] = []
    single: dict[str, list[Check]] = {}
    unique: dict[str, list[Check]] = {}
    for ch in checks:
        if ch.kind not in ("not_null", "unique", "range", "max_length"):
            frames.append(_report_row(spark, ch, failures_of(ch, resolve)))
        elif ch.column not in resolve(ch.model).columns:
            frames.append(_report_row(spark, ch, None))
        else:
            (unique if ch.kind == "unique" else single).setdefault(ch.model, []).append(ch)
    for model, group in single.items():
        frames.append(_report_rows(group, resolve(model).agg(
            F.array(*[F.count(F.when(_violates(ch), 1)) for ch in group]).alias("counts"))))
    twice = _hashes_twice(unique, resolve, hash64) if unique else None
    # One row a model at most.
    suspect = {r["model"] for r in twice.select("model").distinct().collect()} if unique else set()
    for model, group in unique.items():
        if model not in suspect:
            frames.append(_report_rows(group, spark.range(1).select(F.array(*[F.lit(0).cast("long")] * len(group)).alias("counts"))))
            continue
        hashes = twice.filter(F.col("model") == model).select("col", "h")
        # A written table: its size is known, so a small one is broadcast and only values that may repeat are shuffled.
        dup = (_values(resolve(model), group, hash64).join(hashes, ["col", "h"], "left_semi")
               .groupBy("col", "val").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
               .groupBy("col").agg(F.count(F.lit(1)).alias("dups")))
        frames.append(_report_rows(group, dup.agg(F.array(*[
            F.coalesce(F.max(F.when(F.col("col") == ch.column, F.col("dups"))), F.lit(0)) for ch in group]).alias("counts"))))
    out = frames[0]
    for r in frames[1:]:
        out = out.unionByName(r)
    return out


def _values(df: DataFrame, group: list[Check], hash64: Callable[..., Column]) -> DataFrame:
    """(col, val, h) of the columns of unique checks, NULLs left out.  Values are compared
    as text within one column, which is exact for the key types checked here."""
    cols = sorted({ch.column for ch in group})
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val")) for c in cols]))
    return df.select(pairs.alias("p")).select("p.col", "p.val").filter(F.col("val").isNotNull()).withColumn("h", hash64("val"))


def _hashes_twice(unique: dict[str, list[Check]], resolve: Callable[[str], DataFrame], hash64: Callable[..., Column]) -> DataFrame:
    """(model, col, h) of hashes that occur more than once, written to the shared folder."""
    out = None
    for model, group in unique.items():
        hashes = (_values(resolve(model), group, hash64).groupBy("col", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                  .select(F.lit(model).alias("model"), "col", "h"))
        out = hashes if out is None else out.unionByName(hashes)
    return written(out)


def _violates(check: Check) -> Column:
    """A row that fails a not-null, range or length check."""
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "max_length":
        return F.length(c) > check.max_len
    bad = F.lit(False)
    if check.low is not None:
        bad = bad | (c < check.low)
    if check.high is not None:
        bad = bad | (c > check.high)
    return bad


def _report_rows(group: list[Check], counts: DataFrame) -> DataFrame:
    """Report rows of checks whose failures are the one row's array ``counts``, in order."""
    names = F.array(*[F.struct(F.lit(ch.name).alias("test"), F.lit(ch.model).alias("model"),
                               F.lit(ch.column).alias("column"), F.lit(ch.severity).alias("severity"))
                      for ch in group])
    row = counts.select(F.explode(F.arrays_zip(names.alias("check"), F.col("counts").alias("failures"))).alias("r"))
    return row.select("r.check.test", "r.check.model", "r.check.column", F.col("r.failures").cast("long").alias("failures"),
                      F.when(F.col("r.failures") == 0, "pass").otherwise(F.col("r.check.severity")).alias("status"))


def schema_contract(spark: SparkSession, expected: Iterable[str],
                    resolve: Callable[[str], DataFrame], minimum: int = 2) -> DataFrame:  # D8
    """Which expected tables exist, their columns and rows, and whether at least ``minimum`` exist."""
    rows, counts = [], None
    for name in expected:
        try:
            df = resolve(name)
            rows.append((name, True, len(df.columns), ",".join(df.columns)))
            n = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
            counts = n if counts is None else counts.unionByName(n)
        except (AnalysisException, KeyError) as missing:
            if isinstance(missing, AnalysisException) and missing.getCondition() not in MISSING_TABLE:
                raise
            rows.append((name, False, 0, None))
    ok = sum(1 for r in rows if r[1]) >= minimum
    # One row a table name: bounded by ``expected``, so the contract side is broadcast.
    contract = spark.createDataFrame([r + (ok,) for r in rows],
                                     "table string, present boolean, n_columns int, columns string, "
                                     "contract_ok boolean")
    if counts is None:
        return contract.withColumn("n_rows", F.lit(None).cast("long"))
    return contract.join(counts, "table", "left")


def non_empty(resolve: Callable[[str], DataFrame], tables=("clientes", "pedidos")) -> DataFrame:  # D9
    """One row: per table whether it has a row (LIMIT 1 probes), and their OR."""
    probes = [resolve(t).limit(1).agg(F.count(F.lit(1)).alias(f"has_{t}")) for t in tables]
    out = probes[0]
    for p in probes[1:]:
        out = out.crossJoin(p)
    any_rows = None
    for t in tables:
        c = F.col(f"has_{t}") > 0
        any_rows = c if any_rows is None else any_rows | c
    return out.select(*[(F.col(f"has_{t}") > 0).alias(f"has_{t}") for t in tables],
                      any_rows.alias("ok"))
