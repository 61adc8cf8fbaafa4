"""Connected components of a large edge table by alternating star contraction.

Every round first ties each vertex's larger neighbours to its smallest one, then
does the same with the smaller neighbours (Kiveris et al., 2014); edges end as a
star around each component's least vertex.  Only edges move; no vertex list or
component ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import shared_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex but the roots; edges: (a, b) longs."""
    edges = shared_table(spark, edges.filter("a <> b").distinct(), "edges")
    before = None
    while True:
        edges = shared_table(spark, _star(_star(edges, large=True), large=False), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
        before = state
