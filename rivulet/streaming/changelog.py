"""Change logs derived from the domain tables (FIXTURES.md section 3).

A Spark job turns table rows into change events in the connector's wire format
(dates as epoch days, timestamps as epoch micros, decimals as JSON numbers,
JSON columns as nested objects, explicit nulls kept).  Offsets are
``step * STEP + id`` so they grow with the step and then the key, without a
global sort; a key always lands in the same partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet import schemas
from rivulet.sources.tables import Root

STEP = 10 ** 12
PARTITIONS = 4
BASE_TS = "2001-08-01 00:00:00"


def wire_value(c: Column, name: str, dtype: T.DataType, ts_unit: str = "micros") -> Column:
    if isinstance(dtype, T.DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        ts = c.cast("timestamp")
        return F.unix_micros(ts) if ts_unit == "micros" else F.unix_millis(ts)
    if isinstance(dtype, T.DecimalType):
        return c.cast("double")
    if name in schemas.JSON_OBJECT_COLS:
        return F.from_json(c, "map<string,string>")
    return c


def to_json_obj(fields: list[Column]) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _event(topic: str, key: Column, payload: Column, step: int) -> list[Column]:
    return [
        F.lit(topic).alias("topic"),
        F.pmod(key, F.lit(PARTITIONS)).cast("int").alias("partition"),
        (F.lit(step * STEP) + key).cast("long").alias("offset"),
        (F.lit(BASE_TS).cast("timestamp") + F.make_interval(mins=F.lit(step))).alias("timestamp"),
        payload.alias("value"),
    ]


def snapshot_events(df: DataFrame, table: str, step: int = 1, op: str = "r",
                    ts_unit: str = "micros") -> DataFrame:
    """Every row as a full-row read event."""
    schema = schemas.SCHEMAS[table]
    fields = [wire_value(F.col(f.name), f.name, f.dataType, ts_unit).alias(f.name)
              for f in schema.fields]
    payload = to_json_obj(fields + [F.lit(op).alias("__op"), F.lit(table).alias("__table")])
    return df.select(*_event(schemas.TOPIC_PREFIX + table, F.col("id"), payload, step))


def _partial(df: DataFrame, table: str, step: int, cond: Column, fields: list[Column],
             op: str, envelope: bool = False) -> DataFrame:
    body = to_json_obj([F.col("id").alias("id"), *fields, F.lit(op).alias("__op")])
    if envelope:
        body = F.concat(F.lit('{"payload":'), body, F.lit("}"))
    return df.filter(cond).select(*_event(schemas.TOPIC_PREFIX + table, F.col("id"), body, step))


def junk_events(spark: SparkSession, step: int = 6) -> DataFrame:
    """Events the consumer must skip or only count (step 6 of the log)."""
    t = schemas.TOPIC_PREFIX + "clientes"
    # Malformed and edge-case events.
    rows = [
        (t, '{bad json'),
        (t, 'null'),
        (t, '{"payload":null}'),
        (t, '{"payload":{}}'),
        (t, '[1]'),
        (t, '{"nome":"sem id","__op":"c"}'),
        (t, '{"id":null,"nome":"id nulo","__op":"c"}'),
        (schemas.TOPIC_PREFIX + "outra", '{"id":1,"nome":"outra"}'),
        (t, '{"id":1,"limite_credito":"abc","__op":"u"}'),
        (t, None),
        (t, '{"id":null,"__op":"d"}'),
    ]
    df = spark.createDataFrame([(i, tp, v) for i, (tp, v) in enumerate(rows)],
                               "i long, topic string, value string")
    return df.select(
        "topic", F.lit(0).alias("partition"), (F.lit(step * STEP) + F.col("i")).alias("offset"),
        (F.lit(BASE_TS).cast("timestamp") + F.make_interval(mins=F.lit(step))).alias("timestamp"),
        "value")


def clientes_log(clientes: DataFrame, spark: SparkSession, ts_unit: str = "micros") -> list[DataFrame]:
    """The seven steps for ``clientes``, one DataFrame per step, in order."""
    k = F.col("id")
    ua = F.col("updated_at")
    enc = lambda c, n, t: wire_value(c, n, t, ts_unit)
    ts_t = T.TimestampType()
    return [
        snapshot_events(clientes, "clientes", 1, "r", ts_unit),
        _partial(clientes, "clientes", 2, k % 3 == 0,
                 [F.lit("bloqueado").alias("status"),
                  enc(ua + F.expr("interval 1 day"), "updated_at", ts_t).alias("updated_at")], "u"),
        _partial(clientes, "clientes", 3, k % 7 == 0,
                 [F.lit(None).cast("string").alias("telefone")], "u"),
        _partial(clientes, "clientes", 4, k % 17 == 0, [], "d"),
        _partial(clientes, "clientes", 5, k % 34 == 0,
                 [F.concat(F.lit("reinserido "), k.cast("string")).alias("nome")], "c"),
        junk_events(spark, 6),
        _partial(clientes, "clientes", 7, k % 5 == 0,
                 [F.lit("reativado").alias("status"),
                  enc(ua + F.expr("interval 2 days"), "updated_at", ts_t).alias("updated_at")],
                 "u", envelope=True),
    ]


def pedidos_log(pedidos: DataFrame, ts_unit: str = "micros") -> list[DataFrame]:
    return [
        snapshot_events(pedidos, "pedidos", 1, "r", ts_unit),
        _partial(pedidos, "pedidos", 2, F.col("id") % 13 == 0, [], "d"),
    ]


def spread(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows hash-spread by ``key``, as a keyed producer spreads them over topic partitions."""
    return df.repartition(key)


def change_log_steps(root: Root, ts_unit: str = "micros") -> list[DataFrame]:
    """All topics' events grouped by step (a step may mix topics)."""
    spark = root.spark
    cl = clientes_log(spread(root.table("clientes")), spark, ts_unit)
    pl = pedidos_log(spread(root.table("pedidos")), ts_unit)
    steps = [cl[0].unionByName(pl[0])
             .unionByName(snapshot_events(spread(root.table("produtos")), "produtos", 1, "r",
                                          ts_unit))
             .unionByName(snapshot_events(spread(root.table("leads")), "leads", 1, "r", ts_unit)),
             cl[1].unionByName(pl[1])] + cl[2:]
    return steps


def change_log(root: Root, ts_unit: str = "micros") -> DataFrame:
    steps = change_log_steps(root, ts_unit)
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    return out


CLAIM = 10 ** 9


def unique_log_steps(root: Root) -> list[DataFrame]:
    """A log of ``pedidos`` whose rows claim order numbers of others, one DataFrame per step.

    Orders are loaded (1) and some deleted (2); new rows claim the numbers of every 11th
    order (3); some orders give theirs up (4); more rows claim the same numbers (5); the
    first claimers go (6), and a third set claims them (7).
    """
    k = F.col("id")
    orders = spread(root.table("pedidos"))

    def rows(n: int) -> DataFrame:
        return orders.filter(k % 11 == 0).select((k + n * CLAIM).alias("id"), "numero_pedido")

    def claim(n: int, step: int) -> DataFrame:
        return _partial(rows(n), "pedidos", step, F.lit(True), [F.col("numero_pedido"), F.lit(f"claim {n}").alias("status")], "c")
    return pedidos_log(orders) + [
        claim(1, 3),
        _partial(orders, "pedidos", 4, k % 22 == 0, [F.concat("numero_pedido", F.lit("-b")).alias("numero_pedido")], "u"),
        claim(2, 5),
        _partial(rows(1), "pedidos", 6, F.lit(True), [], "d"),
        claim(3, 7),
    ]
