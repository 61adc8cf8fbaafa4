"""Ordered-window operators that stay correct and balanced under key skew.

``Window.partitionBy(key)`` sends every row of a key to one task; a key with a
third of all rows then runs in a single task.  Here rows are range-partitioned
on (key, order...) so a hot key is spread over many partitions, and the window
runs per (key, partition) slice.

The sliced rows are written once to the shared folder, slice id included, and
both the slice windows and the slice summary read those files.  Range bounds are
sampled, so two plans over the same rows may cut them differently; the written
id is the same for every reader.

Range partitioning keeps keys sorted across partitions, so only the *first*
key of a partition can continue from earlier partitions, and it does so if the
partition before it ends with that key.  The fix-up therefore needs one summary
row per partition (first key, last key, rows and last value of the last key)
and a running window over those rows: tables bounded by the partition count
whatever the data size, which is what makes broadcasting the fix-up safe.  Keys
are compared null-safely and ordered nulls first, as the range partitioning
orders them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.session import checkpoint_dir


def _sliced(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows with ``__pid``, the slice they are in, as written to the shared folder."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/slices-{uuid.uuid4().hex}"
    rows = df.repartitionByRange(key, *order).withColumn("__pid", F.spark_partition_id())
    rows.write.parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def _slice_summary(r: DataFrame, key: str, last_value: Column | None = None) -> DataFrame:
    """One row per non-empty slice: ``__pid, __first, __last, __n_last[, __v_last]``.

    ``r`` carries ``__rn`` (row number inside the (key, slice) group, or its rows), so the
    greatest (key, __rn) is the slice's last row and its ``__rn`` is the number
    of rows the last key has in the slice.
    """
    k = F.col(key)
    fields = [k.alias("k"), F.col("__rn").alias("n")]
    if last_value is not None:
        fields.append(last_value.alias("v"))
    s = r.groupBy("__pid").agg(F.min(F.struct(k.alias("k"))).alias("__f"),
                               F.max(F.struct(*fields)).alias("__l"))
    cols = [F.col("__pid"), F.col("__f.k").alias("__first"), F.col("__l.k").alias("__last"),
            F.col("__l.n").alias("__n_last")]
    if last_value is not None:
        cols.append(F.col("__l.v").alias("__v_last"))
    return s.select(*cols)


def _continued(summary: DataFrame, carried: Column) -> DataFrame:
    """(__fpid, __fkey, __carry) of each slice whose first key the slice before it ends with.

    ``carried`` is what the slice before hands on.  Slices of one key follow each
    other, so the nearest slice before is the only one to look at; the window
    over all slices has one row per partition.
    """
    before = Window.orderBy("__pid")
    return (summary.withColumn("__carry", carried)
            .select("__pid", "__first", F.lag("__last").over(before).alias("__prev_last"),
                    F.lag(F.struct("__carry")).over(before).alias("__prev"))
            .filter(F.col("__prev").isNotNull() & F.col("__prev_last").eqNullSafe(F.col("__first")))
            .select(F.col("__pid").alias("__fpid"), F.col("__first").alias("__fkey"),
                    F.col("__prev.__carry").alias("__carry"), F.lit(True).alias("__hit")))


def _attach(r: DataFrame, key: str, fix: DataFrame) -> DataFrame:
    """Left-join the per-slice fix-up onto the rows; at most one row a partition, so broadcast."""
    cond = (F.col("__pid") == F.col("__fpid")) & F.col(key).eqNullSafe(F.col("__fkey"))
    return r.join(F.broadcast(fix), cond, "left")


HELPERS = ("__pid", "__rn", "__fpid", "__fkey", "__carry", "__hit")


def lag_skew_safe(df: DataFrame, key: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    """``lag(value) over (partition by key order by order...)`` as column ``out``."""
    w = Window.partitionBy(key, "__pid").orderBy(*[F.col(c) for c in order])
    r = _sliced(df, key, order)
    r = r.withColumn(out, F.lag(value).over(w)).withColumn("__rn", F.row_number().over(w))
    fix = _continued(_slice_summary(r, key, F.col(value)), F.col("__v_last"))
    return (_attach(r, key, fix)
            .withColumn(out, F.when((F.col("__rn") == 1) & F.col("__hit"), F.col("__carry"))
                        .otherwise(F.col(out)))
            .drop(*HELPERS))


def row_number_skew_safe(df: DataFrame, key: str, order: Sequence[str], out: str) -> DataFrame:
    """``row_number() over (partition by key order by order...)`` as column ``out``."""
    w = Window.partitionBy(key, "__pid").orderBy(*[F.col(c) for c in order])
    s = _sliced(df, key, order)
    r = s.withColumn("__rn", F.row_number().over(w))
    # Rows of a key up to and including each slice that ends with it; a key's rows in a slice are counted, not sorted.
    running = F.sum("__n_last").over(Window.partitionBy("__last").orderBy("__pid"))
    counts = s.groupBy(key, "__pid").agg(F.count(F.lit(1)).alias("__rn"))
    fix = _continued(_slice_summary(counts, key), running)
    return (_attach(r, key, fix)
            .withColumn(out, F.col("__rn") + F.coalesce(F.col("__carry"), F.lit(0)))
            .drop(*HELPERS))
