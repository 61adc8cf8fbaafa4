"""UNIQUE columns of the replica, enforced over the change log.

In the replica an event that would give a row the value another row holds fails, and
the whole event is skipped.  Which row holds a value follows from the events before,
of which some were skipped in turn.  ``enforce`` finds them for all keys at once:

1. Only contested values matter, those that several keys claim, and only the events
   that set or release the column of keys that claim one (``_timeline``).
2. Each round takes the events that are thought to apply, reads off how long each
   claim holds its value (until its key's next such event), and lets a claim apply if
   no other key's claim, begun before it, still holds the value.
3. An event's answer depends on earlier events only, so the answers become right from
   the earliest on, and rounds end when none changes: after at most as many rounds as
   the longest chain of claims that each decide the next, usually two or three.

Order is (offset, partition), as in the fold.  Of rounds the driver sees one number.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet import schemas
from rivulet.session import checkpoint_dir
from rivulet.streaming.cdc import ENFORCED, NO_DELETE

#: Place in the log: of a value held when the batch began, and after all events.
AT = "struct<offset: bigint, partition: int>"


def _at(offset, partition):
    return F.struct(offset.cast("long").alias("offset"), partition.cast("int").alias("partition"))


def _timeline(typed: DataFrame, column: str, held: DataFrame | None, path: str) -> DataFrame:
    """(key, at, value) of the events that set or release the column of keys with contested values.

    Those of all keys are written to ``path`` first: the events are parsed once.

    ``held``: folded keys (``fold_keys``) of the state that the events come upon; a value
    held counts as a claim at the offset that set it.
    """
    ok = F.col("reason").isNull()
    deletes = F.col("op") == "d"
    events = typed.filter(ok & F.col("key").isNotNull() & (deletes | F.col(f"p_{column}"))).select(
        "key", _at(F.col("offset"), F.col("partition")).alias("at"), F.when(~deletes, F.col(f"v_{column}")).alias("value"))
    if held is not None:
        last = F.col(f"s_{column}")
        floor = F.coalesce(F.col("ld"), F.lit(NO_DELETE))
        events = events.unionByName(held.filter((F.col("lu") > floor) & (last["o"] > floor) & last["v"].isNotNull())
                                    .select("key", _at(last["o"], F.lit(-1)).alias("at"), last["v"].alias("value")))
    events.write.parquet(path)
    events = events.sparkSession.read.schema(events.schema).parquet(path)
    contested = (events.filter(F.col("value").isNotNull()).groupBy("value")
                 .agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low <> high").select("value"))
    keys = events.join(contested, "value", "left_semi").select("key").distinct()
    return events.join(keys, "key", "left_semi")


def violations(typed: DataFrame, column: str, held: DataFrame | None = None) -> DataFrame:
    """(offset, partition) of the events that the UNIQUE column rejects."""
    spark = typed.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/unique-{uuid.uuid4().hex}"
    rows = _timeline(typed, column, held, f"{folder}/events").withColumn("ok", F.lit(True)).withColumn("was", F.lit(True))
    by_key = Window.partitionBy("key", "ok").orderBy("at")
    before = Window.partitionBy("value").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    round_ = 0
    while True:
        path = f"{folder}/round={round_}"
        rows.write.parquet(path)        # a round's plan starts from files, whatever the rounds before
        rows = spark.read.schema(rows.schema).parquet(path)
        if round_ and not rows.filter("ok <> was").limit(1).count():
            return rows.filter(~F.col("ok")).select("at.offset", "at.partition")
        # Applied events only bound each other; a claim without an end holds on.
        ends = rows.withColumn("next", F.lead("at").over(by_key))
        span = F.when(F.col("ok"), F.struct(F.col("next").isNull().alias("open"), F.col("next").alias("end"), F.col("key").alias("by")))
        claims = ends.filter(F.col("value").isNotNull()).withColumn("holder", F.max(span).over(before))
        holds = F.col("holder.open") | (F.col("holder.end") > F.col("at"))
        free = F.col("holder").isNull() | ~holds | (F.col("holder.by") == F.col("key"))
        # What the state held before the events stays.
        decided = F.when(F.col("at.partition") == -1, F.lit(True)).otherwise(free)
        rows = (claims.select("key", "at", "value", decided.alias("ok"), F.col("ok").alias("was"))
                .unionByName(rows.filter(F.col("value").isNull()).withColumn("was", F.col("ok"))))
        round_ += 1


def enforce(typed: DataFrame, route: schemas.Route, held: DataFrame | None = None) -> DataFrame:
    """Typed events of a table; those that break its UNIQUE column get the reason ``unique_violation``."""
    column = ENFORCED.get(route.table)
    if column is None:
        return typed
    bad = violations(typed, column, held).select(F.col("offset").alias("__offset"), F.col("partition").alias("__partition"), F.lit(True).alias("__bad"))
    on = (F.col("offset") == F.col("__offset")) & (F.col("partition") == F.col("__partition"))
    broken = F.col("reason").isNull() & F.col("__bad")
    return (typed.join(bad, on, "left")
            .withColumn("reason", F.when(broken, "unique_violation").otherwise(F.col("reason"))).drop("__offset", "__partition", "__bad"))
