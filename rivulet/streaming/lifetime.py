"""Lifetime purchases and spend per customer as a streaming aggregate (M9).

Sales arrive as files; a stateful ``groupBy`` keeps each customer's count and sum in
the state store, by partial sums a task, and in update mode a micro-batch sends only
the customers it changed.  A batch's rows go to ``v=<batch>``; a read takes each
customer's row of the newest batch.  A replayed batch gives the same rows and replaces
its folder, and a folder without ``_SUCCESS`` (a write that broke off) is not read: its
batch is replayed.  A restarted query goes on from the checkpoint's offsets and state.

Customers are not forgotten, so the state grows with the customers, not with the sales.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rivulet.operators.services import customer_lifetime
from rivulet.streaming.cdc import path_exists, versions_under

TOTALS = "cliente_id long, total_compras long, valor_total_gasto decimal(28,2)"


def read_sales(spark: SparkSession, path: str, schema: StructType, max_per_trigger: int | None = None) -> DataFrame:
    """Sales files as a stream."""
    reader = spark.readStream.schema(schema)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.parquet(path)


def start(sales: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Run the aggregate; changed totals of each micro-batch go below ``out``."""
    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/v={batch}")
    stream = customer_lifetime(sales).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if available_now else stream.trigger(processingTime="1 second")).start()


def totals(spark: SparkSession, out: str) -> DataFrame:
    """The newest totals of each customer."""
    paths = [f"{out}/v={v}" for v in versions_under(spark, out) if path_exists(spark, f"{out}/v={v}/_SUCCESS")]
    if not paths:
        return spark.createDataFrame([], TOTALS)
    rows = spark.read.schema(TOTALS).option("basePath", out).parquet(*paths).withColumn("v", F.col("_metadata.file_path"))
    batch = F.regexp_extract("v", r"/v=(\d+)/", 1).cast("long")
    newest = rows.groupBy("cliente_id").agg(F.max(F.struct(batch.alias("batch"), "total_compras", "valor_total_gasto")).alias("last"))
    return newest.select("cliente_id", "last.total_compras", "last.valor_total_gasto")
