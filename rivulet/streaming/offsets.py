"""Applied offsets per topic and partition, as interval sets.

A ledger row is (topic, partition, block, runs, seen): the offsets of one block of
``BLOCK`` that were consumed, as ascending runs of consecutive offsets.  A block in
which nothing is missing is one run, and no group holds more than a block, however
long the partition.  Two ledgers merge block by block.  Events without a topic,
partition or offset have no address: they're in no ledger and never repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.windows import lag_skew_safe

BLOCK = 8192
ADDRESS = ("topic", "partition", "offset")
GROUP = ("topic", "partition", "block")
LEDGER_DDL = "topic string, partition int, block long, runs array<struct<first:bigint,last:bigint>>, seen long"


def _addressed() -> Column:
    return F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()


def _block() -> Column:
    return F.floor(F.col("offset") / F.lit(BLOCK)).cast("long")


def _runs(offsets: Column) -> Column:
    """Ascending distinct offsets -> their runs."""
    last = F.size(offsets) - 1
    firsts = F.filter(offsets, lambda x, i: (i == 0) | (F.get(offsets, i - 1) < x - 1))
    lasts = F.filter(offsets, lambda x, i: (i == last) | (F.get(offsets, i + 1) > x + 1))
    return F.arrays_zip(firsts.alias("first"), lasts.alias("last"))


def _rows(blocks: DataFrame, offsets: Column, *more: str) -> DataFrame:
    # The array leaves through a generator: its lambdas then read it, and don't build it again.
    return (blocks.select(*GROUP, *more, F.inline(F.array(F.struct(offsets.alias("__o")))))
            .select(*GROUP, _runs(F.col("__o")).cast("array<struct<first:bigint,last:bigint>>").alias("runs"),
                    F.size("__o").cast("long").alias("seen"), *more))


def ledger(events: DataFrame) -> DataFrame:
    """Ledger of some events, with ``delivered``: how many came, repeats included."""
    # Counted per offset first: a repeated offset is one row a task.
    once = (events.filter(_addressed()).groupBy("topic", "partition", "offset").agg(F.count(F.lit(1)).alias("n")))
    blocks = (once.groupBy("topic", "partition", _block().alias("block"))
              .agg(F.collect_list("offset").alias("offsets"), F.sum("n").alias("delivered")))
    return _rows(blocks, F.array_sort("offsets"), "delivered")


def merge(ledgers: DataFrame) -> DataFrame:
    """Rows of several ledgers -> one row a block."""
    blocks = ledgers.groupBy(*GROUP).agg(F.flatten(F.collect_list("runs")).alias("all"))
    offsets = F.flatten(F.transform("all", lambda r: F.sequence(r["first"], r["last"])))
    return _rows(blocks, F.array_sort(F.array_distinct(offsets)))


def already_seen(own: DataFrame, held: DataFrame) -> DataFrame:
    """(topic, partition, repeats): offsets of a ledger that others hold too; these may overlap."""
    cols = [*GROUP, "runs", "seen"]
    met = merge(held.join(own.select(*GROUP), list(GROUP), "left_semi"))
    both = own.select(*cols).unionByName(met)
    sums = both.groupBy(*GROUP).agg(F.sum("seen").alias("s"))
    return (merge(both).join(sums, list(GROUP)).groupBy("topic", "partition")
            .agg(F.sum(F.col("s") - F.col("seen")).alias("repeats")))


def fresh(events: DataFrame, held: DataFrame | None) -> DataFrame:
    """The events whose offset no ledger row holds, each offset once (an address has one event, so any of its copies)."""
    named = events.filter(_addressed())
    if held is not None:
        runs = merge(held).select(*GROUP, F.col("runs").alias("__runs"))
        inside = F.exists("__runs", lambda r: F.col("offset").between(r["first"], r["last"]))
        named = (named.withColumn("block", _block()).join(runs, list(GROUP), "left")
                 .filter(~F.coalesce(inside, F.lit(False))).select(*events.columns))
    return named.dropDuplicates(list(ADDRESS)).unionByName(events.filter(~_addressed()))


def gaps(merged: DataFrame) -> DataFrame:
    """(topic, partition, first, last): offsets missing between the first and the last of a partition.

    Runs are compared with the run before them across blocks, in slices: a partition
    may hold any share of all offsets.
    """
    rows = (merged.select(F.struct("topic", "partition").alias("__at"), F.inline("runs"))
            .select("__at", "first", "last"))
    before = lag_skew_safe(rows, "__at", ["first"], "last", "__before")
    return (before.filter(F.col("first") > F.col("__before") + 1)
            .select("__at.topic", "__at.partition", (F.col("__before") + 1).alias("first"), (F.col("first") - 1).alias("last")))


def coverage(merged: DataFrame) -> DataFrame:
    """A row a partition: first and last offset, how many were consumed, how many between them are missing, in how many gaps."""
    span = (merged.groupBy("topic", "partition")
            .agg(F.min(F.get("runs", F.lit(0))["first"]).alias("first_offset"), F.max(F.element_at("runs", -1)["last"]).alias("last_offset"),
                 F.sum("seen").alias("seen")))
    holes = gaps(merged).groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("gaps"))
    return (span.join(holes, ["topic", "partition"], "left")
            .withColumn("missing", F.col("last_offset") - F.col("first_offset") + 1 - F.col("seen"))
            .withColumn("gaps", F.coalesce("gaps", F.lit(0))))
