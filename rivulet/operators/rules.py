"""Table rules of the source DDL as DataFrame transforms.

Generated columns, defaults, the ``updated_at`` touch, keyed updates, insert-if-absent
on a key, ``ON DELETE CASCADE`` and random sampling.  All are joins, filters and
projections; each join is an equi-join on the key, so Spark shuffles both sides by
that key (or broadcasts a side AQE measured as small).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet import schemas
from rivulet.functions.exprs import date_lit, ts_lit
from rivulet.session import checkpoint_dir


# ---------------------------------------------------------------- generated columns

def valor_liquido() -> Column:  # R1
    return (F.col("valor_bruto") - F.col("desconto")).cast("decimal(15,2)")


def margem_lucro() -> Column:  # R2: overflow of decimal(5,2) gives NULL (see reject_overflow)
    custo, venda = F.col("preco_custo"), F.col("preco_venda")
    pct = (venda - custo) / custo * 100
    return F.when(custo > 0, pct.try_cast("decimal(5,2)")).otherwise(F.lit(0).cast("decimal(5,2)"))


def valor_total() -> Column:  # R3
    return (F.col("quantidade") * F.col("preco_unitario") - F.col("desconto_item")).cast("decimal(15,2)")


GENERATED_EXPRS = {
    "valor_liquido": valor_liquido,
    "margem_lucro": margem_lucro,
    "valor_total": valor_total,
}


def generated_columns(df: DataFrame, table: str) -> DataFrame:
    """Recompute the table's STORED generated columns from their inputs."""
    for name in schemas.GENERATED.get(table, ()):
        df = df.withColumn(name, GENERATED_EXPRS[name]())
    return df


def overflow_rejects(df: DataFrame, table: str) -> Column:
    """Rows whose generated value does not fit its type (the insert would fail)."""
    if table == "produtos":
        return (F.col("preco_custo") > 0) & F.col("margem_lucro").isNull() & \
            F.col("preco_venda").isNotNull()
    return F.lit(False)


# ---------------------------------------------------------------- defaults

def _default_value(value, as_of, dtype) -> Column:
    if value == "__now__":
        lit = ts_lit(as_of)
    elif value == "__today__":
        lit = date_lit(as_of)
    else:
        lit = F.lit(value)
    return lit.cast(dtype)


def apply_defaults(df: DataFrame, table: str, as_of, defaults: Mapping | None = None) -> DataFrame:
    """Conform ``df`` to the table schema: absent columns get their DDL default
    (or NULL); present columns keep their values, explicit NULLs included."""
    schema = schemas.SCHEMAS[table]
    defaults = schemas.SOURCE_DEFAULTS.get(table, {}) if defaults is None else defaults
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in present:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in defaults:
            cols.append(_default_value(defaults[f.name], as_of, f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def conform(df: DataFrame, table: str, as_of, drop_rejects: bool = True) -> DataFrame:
    """Defaults + generated columns: what the source table holds after INSERT.

    Rows whose INSERT would fail are not in it; ``rejects`` returns those, with
    the reason.
    """
    out = generated_columns(apply_defaults(df, table, as_of), table)
    if drop_rejects:
        out = out.filter(~overflow_rejects(out, table))
    return out


def rejects(df: DataFrame, table: str, as_of) -> DataFrame:
    """The rows that ``conform`` leaves out, with ``reason``: conform and rejects
    together hold every row of ``df`` once."""
    out = generated_columns(apply_defaults(df, table, as_of), table)
    return out.filter(overflow_rejects(out, table)).withColumn("reason", F.lit("generated_value_overflow"))


# ---------------------------------------------------------------- updates

def touch_updated_at(df: DataFrame, as_of, column: str = "updated_at") -> DataFrame:  # R5
    """The BEFORE UPDATE trigger: every updated row gets ``updated_at = now``."""
    dtype = dict(df.dtypes).get(column, "timestamp")
    return df.withColumn(column, ts_lit(as_of).cast(dtype))


def update_by_key(target: DataFrame, changes: DataFrame, key: str, as_of=None,
                  touch: str | None = "updated_at") -> DataFrame:  # R6
    """``UPDATE target SET <changes' columns> WHERE key = changes.key``.

    ``changes`` holds the key and the new values; rows of ``target`` whose key
    matches take them (and are touched), all other rows pass unchanged.  One
    row per key in ``changes`` is required, as in a keyed UPDATE ... FROM.
    """
    set_cols = [c for c in changes.columns if c != key]
    ch = changes.select(F.col(key), *[F.col(c).alias(f"__new_{c}") for c in set_cols],
                        F.lit(True).alias("__hit"))
    joined = target.join(ch, on=key, how="left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    cols = []
    for c in target.columns:
        if c in set_cols:
            cols.append(F.when(hit, F.col(f"__new_{c}")).otherwise(F.col(c)).cast(
                dict(target.dtypes)[c]).alias(c))
        elif touch and c == touch and as_of is not None:
            cols.append(F.when(hit, ts_lit(as_of).cast(dict(target.dtypes)[c]))
                        .otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return joined.select(*cols)


# ---------------------------------------------------------------- insert-if-absent

def first_per_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Among rows sharing a non-NULL key, the one with the smallest ``order``
    (rows with a NULL key part never conflict and all stay).  ``min_by`` is a
    partial aggregate, so a hot key is reduced per task before the shuffle."""
    nn = F.lit(True)
    for k in keys:
        nn = nn & F.col(k).isNotNull()
    others = [c for c in rows.columns if c not in keys]
    firsts = (rows.filter(nn).groupBy(*keys)
              .agg(F.min_by(F.struct(*[F.col(c) for c in others]), F.col(order)).alias("__r"))
              .select(*keys, *[F.col(f"__r.{c}").alias(c) for c in others]))
    return firsts.select(*rows.columns).unionByName(rows.filter(~nn))


def insert_if_absent(target: DataFrame, rows: DataFrame, key: str | Iterable[str],
                     order: str = "id") -> DataFrame:  # R7
    """``INSERT ... WHERE NOT EXISTS (SELECT 1 FROM target WHERE key = row.key)``,
    one statement per row in ``order``: the first new row of a key wins, rows
    whose key already exists are skipped, NULL keys always insert."""
    keys = [key] if isinstance(key, str) else list(key)
    fresh = first_per_key(rows, keys, order)
    existing = target.select(*keys).dropna()
    return target.unionByName(fresh.join(existing, on=keys, how="left_anti").select(*target.columns))


#: Rounds of single links before chains are followed as a whole.
PLAIN_ROUNDS = 3


def insert_on_conflict_do_nothing(target: DataFrame, rows: DataFrame,
                                  unique_keys: Iterable[str], order: str = "id") -> DataFrame:  # R8
    """``INSERT ... ON CONFLICT DO NOTHING`` without a conflict target, one row at
    a time in ``order``: a row is skipped if any of its non-NULL unique keys (PK
    or UNIQUE column) is in the table or in a row inserted before it.

    Rows are settled in rounds.  A row that comes first on all its keys among
    the unsettled ones is inserted whatever else happens; rows that share a key
    with it are skipped.  A skipped row frees its other keys, so the rest goes
    another round.  After ``PLAIN_ROUNDS`` rounds whole chains are settled at once
    (``_along_chains``): a chain of n conflicts takes log n joins.  Only rows that
    conflict with two or more earlier unsettled ones wait, so further rounds follow
    the longest chain of such rows.  Each round is written to the shared folder:
    lineage does not grow with the rounds.  ``order`` names a row.
    """
    unique_keys = list(unique_keys)
    fresh = rows.select(*target.columns)
    for k in unique_keys:
        fresh = _without_keys_of(fresh, target, k)
    fresh = written(fresh)
    accepted, rounds = None, 0
    while True:
        if rounds < PLAIN_ROUNDS:
            chosen = written(_firsts(fresh, unique_keys, order))
        else:
            chosen = written(fresh.join(_along_chains(fresh, unique_keys, order), on=order, how="left_semi").select(*target.columns))
        accepted = chosen if accepted is None else accepted.unionByName(chosen)
        rest = fresh.join(chosen.select(order), on=order, how="left_anti")
        for k in unique_keys:
            rest = _without_keys_of(rest, chosen, k)
        fresh, rounds = written(rest.select(*target.columns)), rounds + 1
        if fresh.isEmpty():
            return target.unionByName(accepted)


def _firsts(fresh: DataFrame, unique_keys: list[str], order: str) -> DataFrame:
    """Rows that come first on all their keys."""
    firsts = fresh
    for i, k in enumerate(unique_keys):
        # min is a partial aggregate: a hot key is one row per task.
        first = (fresh.filter(F.col(k).isNotNull()).groupBy(F.col(k).alias(f"__k{i}"))
                 .agg(F.min(order).alias(f"__first{i}")))
        firsts = firsts.join(first, F.col(k) == F.col(f"__k{i}"), "left").filter(
            F.col(k).isNull() | (F.col(order) == F.col(f"__first{i}")))
    return firsts.select(*fresh.columns)


def _along_chains(fresh: DataFrame, unique_keys: list[str], order: str) -> DataFrame:
    """(order) of the rows that go in, as far as chains of conflicts decide it.

    A row with one earlier conflict goes in exactly where that one does not, so it
    points there with a change of sign.  Pointers are doubled until each ends at a
    row without such a pointer: one that goes in (no earlier conflict), or one with
    several earlier conflicts, which leaves its chain open.
    """
    links = fresh
    for i, k in enumerate(unique_keys):
        keyed = fresh.filter(F.col(k).isNotNull()).select(F.col(k).alias(f"__k{i}"), F.col(order).alias("__o"))
        first = keyed.groupBy(f"__k{i}").agg(F.min("__o").alias(f"__first{i}"))
        second = keyed.join(first, f"__k{i}").filter(F.col("__o") > F.col(f"__first{i}")).groupBy(f"__k{i}").agg(F.min("__o").alias(f"__second{i}"))
        links = links.join(first.join(second, f"__k{i}", "left"), F.col(k) == F.col(f"__k{i}"), "left")
    o = F.col(order)
    # Earlier conflicts on a key: none, the first row, or (beyond the second row) several.
    earlier = F.array_distinct(F.array_compact(F.array(*[F.when(F.col(f"__first{i}") < o, F.col(f"__first{i}")) for i in range(len(unique_keys))])))
    several = F.lit(False)
    for i in range(len(unique_keys)):
        several = several | F.coalesce(F.col(f"__second{i}") < o, F.lit(False))
    links = written(links.select(o.alias("row"), earlier.alias("earlier"), several.alias("several")).select(
        "row", F.when((F.size("earlier") == 1) & ~F.col("several"), F.col("earlier")[0]).alias("to"),
        F.lit(True).alias("flip"), ((F.size("earlier") == 0)).alias("in_")))
    ends = links.filter(F.col("to").isNull()).select(F.col("row").alias("to"), "in_")
    moving = links.filter(F.col("to").isNotNull()).select("row", "to", "flip")
    while not moving.join(ends, "to", "left_anti").isEmpty():
        # A pointer at an end stays; the others jump to where their target points.
        jump = moving.select(F.col("row").alias("to"), F.col("to").alias("__to"), F.col("flip").alias("__flip"))
        moving = written(moving.join(jump, "to", "left").select(
            "row", F.coalesce("__to", "to").alias("to"), (F.col("flip") != F.coalesce("__flip", F.lit(False))).alias("flip")))
    settled = moving.join(ends, "to").filter(F.col("in_") & ~F.col("flip")).select("row").unionByName(links.filter("in_").select("row"))
    return settled.select(F.col("row").alias(order))


def _without_keys_of(rows: DataFrame, settled: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` no settled row has; NULL never conflicts."""
    return rows.join(settled.select(key).filter(F.col(key).isNotNull()), on=key, how="left_anti")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/rules-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- cascade

def delete_cascade(parent: DataFrame, child: DataFrame, deleted_keys: DataFrame,
                   parent_key: str = "id", child_fk: str = "pedido_id") -> tuple[DataFrame, DataFrame]:
    """Delete parents by key and, ``ON DELETE CASCADE``, their children."""
    dk = deleted_keys.select(F.col(deleted_keys.columns[0]).alias(parent_key)).distinct()
    new_parent = parent.join(dk, on=parent_key, how="left_anti")
    new_child = child.join(dk.withColumnRenamed(parent_key, child_fk), on=child_fk, how="left_anti")
    return new_parent, new_child


# ---------------------------------------------------------------- sampling

def random_sample(df: DataFrame, n: int, seed: int = 42, key: str = "id") -> DataFrame:
    """``ORDER BY RANDOM() LIMIT n`` with a seed: the n rows with the smallest hash
    of (key, seed), ties by key, so the sample does not depend on partitioning.
    ``limit`` after ``orderBy`` is a top-k: only n rows per task move."""
    draw = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(draw, key).limit(n)
