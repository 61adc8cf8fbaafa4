"""Approximate nearest neighbours by learned partitions.

After Dong, Indyk, Razenshteyn and Wagner: the neighbour graph of a bounded
sample is cut into parts of equal size with few edges between them; a small
network learns which parts a vector's neighbours lie in.  Every row is indexed in
its most probable part; a query is compared with all rows of its ``PROBES`` most
probable parts, by inner product in double precision on the original vectors.

The sample, and with it the model that tasks receive, is bounded by parameters
(``SAMPLE`` vectors, ``PARTS`` parts); the index holds every row.  A part is
split into blocks of rows and its queries into blocks too, so one task compares
a bounded block with a bounded block, however many rows a part or a group of
equal vectors has; each block keeps a query's nearest, and those are merged.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do vectors of another length than most of the
sample; equal scores go to the smaller vec_id, a null id before all; a query's
own vec_id is no candidate, other rows of equal vectors are; rows that repeat a
vec_id are candidates each and one query; fewer candidates than asked for are all
returned from the parts searched, and all parts are searched where ``PROBES``
parts hold fewer; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import NULL_ID, restore_id, shared_table, table

SAMPLE, PARTS, PROBES, HIDDEN = 8192, 32, 24, 128
GRAPH_NEIGHBOURS, EPOCHS, SLACK = 10, 25, 1.05
#: Rows and queries that one task compares at a time.
BLOCK, QUERY_BLOCK = 8192, 2048


def neighbour_graph(vectors: np.ndarray, k: int = GRAPH_NEIGHBOURS) -> np.ndarray:
    """Indices of the k largest inner products of each vector with the others."""
    k = min(k, len(vectors) - 1)
    out = np.zeros((len(vectors), k), np.int64)
    for a in range(0, len(vectors), 1024):
        scores = vectors[a:a + 1024] @ vectors.T
        scores[np.arange(len(scores)), np.arange(a, a + len(scores))] = -np.inf
        out[a:a + 1024] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(vectors: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 20, slack: float = SLACK) -> np.ndarray:
    """Part of each vector: parts of nearly equal size that cut few edges of the graph.

    Starts from size-bounded clusters, then moves vertices to the part that holds
    most of their neighbours while sizes stay within ``slack``.
    """
    rng = np.random.Generator(np.random.PCG64(5))
    n, room = len(vectors), int(np.ceil(slack * len(vectors) / parts))
    centres = vectors[rng.choice(n, parts, replace=False)]
    for _ in range(10):
        scores = vectors @ centres.T
        own = _assign_bounded(scores, room)
        for p in range(parts):
            if (own == p).any():
                mean = vectors[own == p].mean(axis=0)
                centres[p] = mean / max(np.linalg.norm(mean), 1e-12)
    edges = np.concatenate([np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()]),
                            np.stack([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])], axis=1)
    size = np.bincount(own, minlength=parts)
    for _ in range(rounds):
        held = np.zeros((n, parts), np.int32)
        np.add.at(held, (edges[0], own[edges[1]]), 1)
        gain = held - held[np.arange(n), own][:, None]
        target = gain.argmax(axis=1)
        best = gain[np.arange(n), target]
        moved = 0
        for v in np.argsort(-best, kind="stable"):
            if best[v] <= 0:
                break
            if size[target[v]] < room:
                size[own[v]] -= 1
                size[target[v]] += 1
                own[v] = target[v]
                moved += 1
        if moved < n // 1000 + 1:
            break
    return own


def _assign_bounded(scores: np.ndarray, room: int) -> np.ndarray:
    """Each row to its best column with room left; rows that lose most by waiting go first."""
    order = np.argsort(-scores, axis=1)
    top = np.take_along_axis(scores, order[:, :2], axis=1) if scores.shape[1] > 1 else np.c_[scores, scores]
    left = np.full(scores.shape[1], room)
    own = np.zeros(len(scores), np.int64)
    for v in np.argsort(top[:, 1] - top[:, 0], kind="stable"):
        for p in order[v]:
            if left[p]:
                own[v], left[p] = p, left[p] - 1
                break
    return own


class Router:
    """A network with one hidden layer that gives the probability of each part."""

    def __init__(self, vectors: np.ndarray, target: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS):
        rng = np.random.Generator(np.random.PCG64(55))
        d, parts = vectors.shape[1], target.shape[1]
        self.scale = 1 / max(1e-12, float(np.sqrt((vectors ** 2).sum(axis=1).mean())))
        self.weights = [rng.normal(0, np.sqrt(2 / d), (d, hidden)), np.zeros(hidden),
                        rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        x, step = vectors * self.scale * np.sqrt(d), 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(x), 256):
                pick = order[a:a + 256]
                inner = x[pick] @ self.weights[0] + self.weights[1]
                active = np.maximum(inner, 0)
                chance = self._softmax(active @ self.weights[2] + self.weights[3])
                error = (chance - target[pick]) / len(pick)
                back = (error @ self.weights[2].T) * (inner > 0)
                step += 1
                for k, g in enumerate((x[pick].T @ back, back.sum(axis=0), active.T @ error, error.sum(axis=0))):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.weights[k] = self.weights[k] - 3e-3 * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)

    @staticmethod
    def _softmax(x: np.ndarray) -> np.ndarray:
        x = np.exp(x - x.max(axis=1, keepdims=True))
        return x / x.sum(axis=1, keepdims=True)

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        x = vectors * self.scale * np.sqrt(vectors.shape[1])
        return np.maximum(x @ self.weights[0] + self.weights[1], 0) @ self.weights[2] + self.weights[3]


def learn(sample: np.ndarray, parts: int = PARTS) -> Router:
    """Router of a sample of distinct vectors."""
    parts = max(1, min(parts, len(sample) // 16))
    if parts == 1:
        return Router(sample, np.ones((len(sample), 1)), epochs=0)
    graph = neighbour_graph(sample)
    own = balanced_parts(sample, graph, parts)
    target = np.zeros((len(sample), parts))
    np.add.at(target, (np.arange(len(sample)), own), 1.0)
    for k in range(graph.shape[1]):
        np.add.at(target, (np.arange(len(sample)), own[graph[:, k]]), 1.0)
    return Router(sample, target / target.sum(axis=1, keepdims=True))


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, but for their length."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (embeddings.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID)).alias("vec_id"), v.alias("v"))
            .filter(F.col("v").isNotNull()).filter(fine & F.exists("v", lambda x: x != 0)))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _route(router: Router, probes: int):
    """Batches of (vec_id, v) to (vec_id, v, parts): the most probable parts, likeliest first."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            logits = router.logits(_matrix(batch.column("v")))
            parts = np.argsort(-logits, axis=1, kind="stable")[:, :probes].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(list(parts), pa.list_(pa.int32()))],
                                             names=["vec_id", "v", "parts"])
    return run


def nearest(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """(query, row, score) of each query's k nearest rows; exact scores, ties to the smaller id.

    The matrix product only preselects: its rounding depends on a row's place.
    """
    out = []
    for a in range(0, len(queries), 256):
        part = queries[a:a + 256]
        rough = part @ rows.T
        rough[query_ids[a:a + 256, None] == ids[None, :]] = -np.inf
        if rough.shape[1] > k:
            # Copies of a common vector tie with the k-th; all of them go on to the exact scores.
            bar = np.partition(rough, rough.shape[1] - k, axis=1)[:, rough.shape[1] - k]
            bar = bar - 1e-9 * np.maximum(1.0, np.abs(bar))
        else:
            bar = np.full(len(part), -np.finfo(float).max)
        for i in range(len(part)):
            near = np.flatnonzero(rough[i] >= bar[i])
            near = near[rough[i, near] > -np.inf]
            score = (rows[near] * part[i]).sum(axis=1)
            best = np.lexsort((ids[near], -score))[:k]
            out.append((np.full(len(best), query_ids[a + i]), ids[near[best]], score[best]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _compare(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        found = nearest(_matrix(right.column("v")), right.column("vec_id").to_numpy(), _matrix(left.column("row_v")), left.column("row_id").to_numpy(), k)
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.float64())})
    return run


def search(spark: SparkSession, embeddings: DataFrame, every: int = 20, k: int = 20, parts: int = PARTS, probes: int = PROBES,
           sample_rows: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each row whose vec_id is divisible by ``every``."""
    from pyspark.sql.window import Window

    fine = valid_vectors(embeddings)
    sample = [r[0] for r in fine.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(sample_rows).select("v").collect()]
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = np.array([len(v) for v in sample])
    length = int(np.bincount(lengths).argmax())
    router = learn(np.unique(np.array([v for v in sample if len(v) == length]), axis=0), parts)
    parts = len(router.weights[3])
    routed = shared_table(spark, fine.filter(F.size("v") == length).mapInArrow(
        _route(router, min(probes, parts)), "vec_id long, v array<double>, parts array<int>"), "routed")
    part = F.element_at("parts", 1)
    is_query = (F.col("vec_id") != NULL_ID) & (F.col("vec_id") % every == 0)
    # Rows of each part, and queries that go there: ``parts`` rows at most, on the driver.
    rows_in = {r[0]: r[1] for r in routed.groupBy(part.alias("p")).count().collect()}
    few = sum(sorted(rows_in.values())[:min(probes, parts)]) <= k
    asked = routed.filter(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "parts")).alias("q")).select("vec_id", "q.v", "q.parts")
    reach = F.sequence(F.lit(0), F.lit(parts - 1)) if few else F.col("parts")
    to_part = asked.select("vec_id", "v", F.explode(reach).alias("p"))
    asked_in = {r[0]: r[1] for r in to_part.groupBy("p").count().collect()}
    blocks = spark.createDataFrame([(p, -(-rows_in.get(p, 0) // BLOCK), -(-asked_in.get(p, 0) // QUERY_BLOCK)) for p in range(parts)],
                                   "p int, row_blocks int, query_blocks int").filter("row_blocks > 0 AND query_blocks > 0")
    blocks = F.broadcast(blocks)
    # Columns of the two sides have names of their own: both come from the same table.
    rows = (routed.select(F.col("vec_id").alias("row_id"), F.col("v").alias("row_v"), part.alias("p")).join(blocks, "p")
            .select("row_id", "row_v", F.col("p").alias("row_p"), F.pmod(F.xxhash64("row_id", "row_v", F.lit(1)), F.col("row_blocks")).cast("int").alias("row_rb"),
                    F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("row_qb")))
    wanted = (to_part.join(blocks, "p")
              .select("vec_id", "v", "p", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.col("query_blocks")).cast("int").alias("qb"),
                      F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)).alias("rb")))
    found = rows.groupBy("row_p", "row_rb", "row_qb").cogroup(wanted.groupBy("p", "rb", "qb")).applyInArrow(
        _compare(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", restore_id("vec_id"), "score"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    return search(spark, table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
