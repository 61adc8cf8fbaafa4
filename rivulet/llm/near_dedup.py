"""Near-duplicate documents by a chosen-path set similarity join.

Documents are sets of word shingles; two are linked if their Jaccard similarity
is at least ``percent`` / 100, confirmed on the full sets.  Components are the
documents that links connect.

Method (Christiani and Pagh; Christiani, Pagh and Sivertsen): a tree's node picks
a few of ``POSITIONS`` minwise hash functions, by a hash of its path, and every
document in the node moves on to the child of each picked function's minwise
token.  In expectation a node has 1 / threshold children for a document, so a
pair at the threshold keeps on meeting in one child a level.  Nodes of at most
``LEAF`` documents are compared exhaustively; larger ones branch on.  ``TREES``
independent trees miss a pair at similarity 0.8 with a chance of about 0.16 **
TREES where one level suffices (3e-10) and 0.36 ** TREES at three levels (5e-6).

What keeps work and rows linear:

- Equal sets are one class, represented by its smallest doc_id; only classes
  enter trees.
- A small node is compared by minwise sketches, one matrix a node.  It sends on
  a spanning forest of the pairs that agree in ``NEED`` positions (a pair at the
  threshold fails that with a chance of about 1e-6), never the pairs themselves.
- Forests of all nodes connect into groups.  A group's full sets meet in one
  task, each document once, which counts the shared shingles of every pair by an
  inverted index and sends on a spanning forest of the links.  Documents of a
  group over ``LEAF`` meet node by node instead, so no task holds more.

Sketches never confirm a link.  Sets are compared as 64-bit shingle hashes.

Defined results: null text is empty; a text without words has n_shingles 0, its
own component and no link; fewer words than a shingle make one shingle; ties and
repeated rows: rows of one doc_id and text are returned each, with one component
and kept alike; different texts of one doc_id are documents of their own, ordered
by a hash; a null doc_id orders before all others; a component's id is its
smallest doc_id, and of its documents only the first one is kept; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import blocks_of_groups, id_text, restore_id, segments, shared_table, table, told_apart
from rivulet.llm.components import components
from rivulet.llm.shingles import shingle_set

POSITIONS, TREES, LEAF, DEEPEST = 64, 12, 3000, 100
#: Of 64 sketch positions, how many must agree; a pair at similarity 0.8 has 51 +- 3.2.
NEED = 34

_RNG = np.random.Generator(np.random.PCG64(66))
_ODD = _RNG.integers(0, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 64, POSITIONS, dtype=np.uint64)

FEATURES = "doc_id long, key long, print long, n_shingles long, set_a long, set_b long, sketch array<int>"


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Minwise values of a non-empty set, one for each position."""
    out = np.full(POSITIONS, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(shingles), 1 << 14):
        part = shingles[at:at + (1 << 14)]
        least = (part * _ODD[:, None] + _ADD[:, None]).min(axis=1) >> np.uint64(32)
        np.minimum(out, least, out=out)
    return out.astype(np.uint32).view(np.int32)


def _features(words: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                size, set_a, set_b, sketches = [], [], [], []
                for text in part.column("text"):
                    shingles = shingle_set(text.as_buffer(), words)
                    size.append(len(shingles))
                    # Two independent sums over the set identify it.
                    odd = shingles * np.uint64(0x9E3779B97F4A7C15)
                    set_a.append(int((odd ^ (odd >> np.uint64(31))).sum(dtype=np.uint64).view(np.int64)))
                    odd = (shingles ^ np.uint64(0xA0761D6478BD642F)) * np.uint64(0xE7037ED1A0B428DB)
                    set_b.append(int((odd ^ (odd >> np.uint64(29))).sum(dtype=np.uint64).view(np.int64)))
                    sketches.append(sketch(shingles) if len(shingles) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), part.column("print"), pa.array(size, pa.int64()), pa.array(set_a, pa.int64()), pa.array(set_b, pa.int64()),
                     pa.array(sketches, pa.list_(pa.int32()))],
                    names=["doc_id", "key", "print", "n_shingles", "set_a", "set_b", "sketch"])
    return run


def forest(label: np.ndarray, x: int, partners: np.ndarray) -> list[int]:
    """Partners that connect x to something new; labels of what they connect become one."""
    if not len(partners):
        return []
    names, first = np.unique(label[partners], return_index=True)
    new = names != label[x]
    if new.any():
        label[np.isin(label, np.append(names, label[x]))] = min(names[0], label[x])
    return partners[first[new]].tolist()


def _likely(percent: int):
    """Small nodes, sorted by node: a spanning forest of each node's likely pairs."""
    def run(batches):
        for block in blocks_of_groups(batches, ("node",), rows=20_000):
            node, rep, size = (block.column(n).to_numpy() for n in ("node", "rep", "n_shingles"))
            values = block.column("sketch").combine_chunks().flatten().to_numpy().reshape(-1, POSITIONS)
            columns = np.ascontiguousarray(values.T)
            head = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            found = []
            for a, z in zip(head.tolist(), [*head[1:].tolist(), len(node)], strict=True):
                label = np.arange(z - a)
                for at in range(a, z, 256):
                    end = min(at + 256, z)
                    agree = np.zeros((end - at, end - a), np.int8)
                    for column in columns:
                        agree += column[at:end, None] == column[a:end]
                    agree = agree >= NEED
                    agree &= 100 * np.minimum(size[at:end, None], size[a:end]) >= percent * np.maximum(size[at:end, None], size[a:end])
                    for x in np.flatnonzero(agree.sum(axis=1) > 1).tolist():
                        own = at - a + x
                        found += [(node[a], rep[a + y], rep[at + x]) for y in forest(label, own, np.flatnonzero(agree[x, :own]))]
            names, left, right = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(left, pa.int64()), pa.array(right, pa.int64())],
                                             names=["node", "a", "b"])
    return run


def similar_forest(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets that are similar enough: exact, by an inverted index."""
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    _, name = np.unique(flat, return_inverse=True)
    order = np.argsort(name, kind="stable")
    posting, begin = owner[order], np.searchsorted(name[order], np.arange(name.max() + 2))
    ends = np.cumsum(size)
    label, out = np.arange(len(sets)), []
    for x in range(1, len(sets)):
        own = name[ends[x] - size[x]:ends[x]]
        shared = np.bincount(posting[segments(begin[own], begin[own + 1] - begin[own])], minlength=len(sets))[:x]
        partners = np.flatnonzero(100 * shared >= percent * (size[:x] + size[x] - shared))
        out += [(y, x) for y in forest(label, x, partners)]
    return out


def _confirm(words: int, percent: int):
    """Sorted by key: (key, rep, text) to links (a, b) that connect what all links of a key connect."""
    def run(batches):
        for block in blocks_of_groups(batches, ("key",), rows=500):
            key, rep = block.column("key").to_numpy(), block.column("rep").to_numpy()
            texts = block.column("text").combine_chunks()
            head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            found = []
            for a, z in zip(head.tolist(), [*head[1:].tolist(), len(key)], strict=True):
                sets = [shingle_set(texts[i].as_buffer(), words) for i in range(a, z)]
                found += [(rep[a + x], rep[a + y]) for x, y in similar_forest(sets, percent)]
            left, right = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])
    return run


def _children(node, sketch_col, percent: int):
    """Child nodes of a node for a document: one picked position always, a second one in a share of nodes."""
    pick = F.pmod(F.xxhash64(node, F.lit(1)), F.lit(POSITIONS)).cast("int")
    second = F.pmod(F.xxhash64(node, F.lit(2)), F.lit(POSITIONS)).cast("int")
    branches = F.pmod(F.xxhash64(node, F.lit(3)), F.lit(1000)) < round(1000 * (100 / percent - 1))
    child = lambda p: F.xxhash64(node, p, F.element_at(sketch_col, p + 1))
    return F.array_distinct(F.when(branches, F.array(child(pick), child(second))).otherwise(F.array(child(pick))))


def links(spark: SparkSession, docs: DataFrame, classes: DataFrame, words: int, percent: int, leaf: int = LEAF) -> DataFrame:
    """Edges (a, b) whose components are those of all links; docs: (key, text), classes: (rep, n_shingles, sketch), rep a key."""
    roots = F.flatten(F.array(*(_children(F.lit(1000 + t).cast("long"), F.col("sketch"), percent) for t in range(TREES))))
    level = classes.select("rep", F.explode(roots).alias("node"))
    likely = None
    for depth in range(DEEPEST + 1):
        met = level.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")
        level = shared_table(spark, level.join(met, "node").select("node", "rep", "size"), "nodes")
        small = level if depth == DEEPEST else level.filter(F.col("size") <= leaf)
        found = shared_table(spark, (
            small.select("node", "rep").join(classes, "rep").select("node", "rep", "n_shingles", "sketch")
            .repartition("node").sortWithinPartitions("node", "rep").mapInArrow(_likely(percent), "node long, a long, b long")), "likely")
        likely = found if likely is None else likely.unionByName(found)
        large = level.filter(F.col("size") > leaf)
        if depth == DEEPEST or large.isEmpty():
            break
        level = (large.join(classes.select("rep", "sketch"), "rep")
                 .select("rep", F.explode(_children(F.col("node"), F.col("sketch"), percent)).alias("node")))

    root = components(spark, likely.select("a", "b"))
    groups = root.select(F.col("vertex").alias("rep"), F.col("root").alias("key")).unionByName(
        root.select(F.col("root").alias("rep"), F.col("root").alias("key")).distinct())
    groups = groups.join(groups.groupBy("key").agg(F.count("*").alias("size")), "key")
    by_node = likely.select("node", F.explode(F.array("a", "b")).alias("rep")).distinct()
    members = (groups.filter(F.col("size") <= leaf).select("key", "rep").unionByName(
        by_node.join(groups.filter(F.col("size") > leaf).select("rep"), "rep").select(F.xxhash64("node").alias("key"), "rep")))
    members = shared_table(spark, members, "members")
    return (_texts_of(docs, members).repartition("key").sortWithinPartitions("key", "rep").mapInArrow(_confirm(words, percent), "a long, b long"))


def _texts_of(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(key, rep, text) of each member; rows of one document key have one text, and repeated ones count once."""
    return docs.select(F.col("key").alias("rep"), "text").join(members, "rep").select("key", "rep", "text").dropDuplicates(["key", "rep"])


def grouped(spark: SparkSession, documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, print, n_shingles, component_id, kept) for each document, ids as longs; print: hash of the text."""
    # Documents are told apart by a key of one long: doc_id, or a hash where a doc_id has several texts.
    docs = told_apart(spark, id_text(documents)).select(
        "doc_id", F.when(F.col("copy") == 0, F.col("doc_id")).otherwise(F.xxhash64("doc_id", "copy")).alias("key"),
        F.xxhash64("text").alias("print"), "text")
    features = shared_table(spark, docs.mapInArrow(_features(words), FEATURES), "features")
    classes = shared_table(spark, (
        features.filter("n_shingles > 0").groupBy("set_a", "set_b")
        .agg(F.min(F.struct("doc_id", "key", "n_shingles", "sketch")).alias("first"), F.count("*").alias("copies"))
        .select("set_a", "set_b", "copies", F.col("first.doc_id").alias("doc_id"), F.col("first.key").alias("rep"),
                F.col("first.n_shingles").alias("n_shingles"), F.col("first.sketch").alias("sketch"))), "classes")
    edges = links(spark, docs, classes.select("rep", "n_shingles", "sketch"), words, percent)
    root = components(spark, edges)
    members = (classes.select("set_a", "set_b", "copies", "doc_id", "rep").join(root, F.col("rep") == root["vertex"], "left")
               .withColumn("root", F.coalesce("root", "rep")))
    # Keys that are hashes don't order as doc_ids do: the first document of a component is found by both.
    first = members.groupBy("root").agg(F.min(F.struct("doc_id", "rep")).alias("first"), F.count("*").alias("classes"))
    # Classes of one document without a link need no entry.
    named = members.join(first, "root").filter("copies > 1 OR classes > 1").select(
        "set_a", "set_b", F.col("first.doc_id").alias("component_id"), F.col("first.rep").alias("first_key"))
    return (features.drop("sketch").join(named, ["set_a", "set_b"], "left")
            .select("doc_id", "print", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                    (F.col("key") == F.coalesce("first_key", "key")).alias("kept")))


def near_duplicates(spark: SparkSession, documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each document."""
    return grouped(spark, documents, words, percent).select(restore_id("doc_id"), "n_shingles", restore_id("component_id"), "kept")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links all documents by 4-word shingles at a Jaccard similarity of 0.8 or more."""
    return near_duplicates(spark, table(spark, sf_dir, "documents", "doc_id", "text"), words=4, percent=80)


#: Classes of equal sets, pairs of classes by shared shingles, and the least doc_id that links reach.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS t FROM documents),
g AS (SELECT doc_id, CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 4 THEN [array_to_string(t, ' ')]
  ELSE list_distinct(list_transform(range(1, len(t) - 2), lambda i: array_to_string(t[i:i + 3], ' '))) END AS s FROM w),
f AS (SELECT doc_id, len(s) AS n, md5(array_to_string(list_sort(s), chr(10))) AS h, s FROM g),
c AS (SELECT h, min(doc_id) AS rep, any_value(n) AS n FROM f WHERE n > 0 GROUP BY h),
e AS (SELECT c.rep, c.n, unnest(f.s) AS x FROM c JOIN f ON f.doc_id = c.rep),
p AS (SELECT a.rep AS u, b.rep AS v, any_value(a.n) AS m, any_value(b.n) AS k, count(*) AS i
      FROM e a JOIN e b ON a.x = b.x AND a.rep < b.rep AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n) GROUP BY 1, 2),
l AS (SELECT u, v FROM p WHERE 100 * i >= 80 * (m + k - i)),
b AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r(origin, pos) AS (SELECT rep, rep FROM c UNION SELECT r.origin, b.v FROM r JOIN b ON b.u = r.pos),
z AS (SELECT origin AS rep, min(pos) AS root FROM r GROUP BY origin)
SELECT f.doc_id, CAST(f.n AS BIGINT) AS n_shingles, coalesce(z.root, f.doc_id) AS component_id,
  f.doc_id = coalesce(z.root, f.doc_id) AS kept
FROM f LEFT JOIN c USING (h) LEFT JOIN z ON z.rep = c.rep AND f.n > 0
"""
