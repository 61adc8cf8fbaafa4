"""Merkle dataset manifest: 8-ary trees over documents, kept as postorder append logs.

Each language is a tree whose leaves are its documents by doc_id; the languages'
roots are the leaves of one more tree.  Leaves are cut at multiples of 8**4, and one
builder closes each aligned piece: it appends a node as soon as its last child is
there, so the log is in postorder, and the nodes of a piece stand together.  A tree
of more than 8**4 leaves goes on with the pieces' roots as the next builders' leaves.

Where a node stands follows from the sizes of the subtrees before it (``positions``),
so a proof finds siblings by arithmetic: no node stores a link.  Proofs are taken from
the top down: each piece gets its own root's proof, reads its piece of the log and
hands every member its siblings and the rest.  All work goes by (tree, piece), of at
most 8**4 members, so no task grows with a language.

Defined results.  Null fields hash as ``-``; a null and an empty text differ.  Null
ids come first, rows of one doc_id are ordered by their leaf hash, and rows that are
the same have a leaf each (which of them is which can't be told).  A null doc_id is
never tampered with.  A null language is a tree of its own, before all others, and
differs from ``''``.  No rows give no rows.  Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
from binascii import hexlify

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import blocks_of_groups, shared_table, table
from rivulet.operators.windows import row_number_skew_safe

FAN = 8
#: Levels that one builder closes, and the members of its piece.
LEVELS = 4
PIECE = FAN ** LEVELS

LOG = "tree string, n long, level int, idx long, position long, digest binary"
#: What one (tree, piece) reads: its root's proof (0), its nodes (1), its documents (2).
PART = "tree string, piece long, kind int, position long, n long, idx long, digest binary, extra binary, doc_id long"
PROVED = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    h = 0
    while FAN ** h < n:
        h += 1
    return h


def positions(level: int, idx: np.ndarray, n: int) -> np.ndarray:
    """Places in the log of the nodes idx of a level, in a tree of n leaves.

    A whole node follows all nodes of its own and lower levels up to its end, and those
    higher ones that ended earlier; a node cut short by the tree's end follows all whole
    nodes and the cut ones below it.
    """
    end = (np.asarray(idx, np.int64) + 1) * FAN ** level
    whole = np.full(len(end), -1, np.int64)
    cut = 0
    for t in range(height(n) + 1):
        whole += end // FAN ** t if t <= level else (end - 1) // FAN ** t
        cut += -(-n // FAN ** t) if t < level else n // FAN ** t
    return np.where(end <= n, whole, cut)


def digest(*parts: bytes) -> bytes:
    """sha256 of digests as hex text."""
    return hashlib.sha256(b"".join(map(hexlify, parts))).digest()


# ---------------------------------------------------------------- leaves

def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(tree, doc_id, leaf, tampered): a document's hash, and that of its text with A-Z as a-z where ``tampered`` holds."""
    id_, text, lang = F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")

    def leaf(body: Column) -> Column:
        fields = [field(c) for c in (id_, F.col("source"), lang, F.col("n_chars"), body)]
        return F.unhex(F.sha2(F.concat(*fields).cast("binary"), 256))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = F.when(tampered, leaf(F.translate(text, upper, upper.lower()))) if tampered is not None else F.lit(None).cast("binary")
    return docs.select(lang.alias("tree"), id_.alias("doc_id"), leaf(text).alias("leaf"), changed.alias("tampered"))


# ---------------------------------------------------------------- builders

def _pieces(blocks, keys=("tree", "piece")):
    """Each (tree, piece) of sorted Arrow blocks as one table."""
    for block in blocks_of_groups(blocks, keys):
        change = np.zeros(block.num_rows + 1, bool)
        change[[0, -1]] = True
        for key in keys:
            values = block.column(key).to_numpy()
            change[1:-1] |= values[1:] != values[:-1]
        cuts = np.flatnonzero(change)
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield block.slice(a, b - a)


def _build(base: int):
    """mapInArrow function: the nodes of each piece whose members are nodes of level ``base``."""
    names = [c.split()[0] for c in LOG.split(", ")]
    schema = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()),
                        ("position", pa.int64()), ("digest", pa.binary())])

    def run(batches):
        for part in _pieces(batches):
            n, first = part.column("n")[0].as_py(), part.column("idx")[0].as_py()
            nodes = part.column("digest").to_pylist()
            levels, rows = [], []
            for level in range(base, min(base + LEVELS, height(n)) + 1):
                if level > base:
                    nodes = [digest(*nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)]
                    first //= FAN
                idx = first + np.arange(len(nodes))
                levels.append((np.full(len(nodes), level, np.int32), idx, positions(level, idx, n)))
                rows += nodes
            level, idx, position = (np.concatenate(x) for x in zip(*levels))
            order = np.argsort(position)  # the order in which nodes are complete
            columns = [pa.array([part.column("tree")[0].as_py()] * len(order), pa.string()), pa.array(np.full(len(order), n)),
                       pa.array(level[order]), pa.array(idx[order]), pa.array(position[order]),
                       pa.array([rows[i] for i in order], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names).cast(schema)
    return run


def append_logs(spark: SparkSession, members: DataFrame) -> list[DataFrame]:
    """Logs of the trees of ``members`` (tree, idx, n, digest), one table for each four levels, leaves first."""
    logs: list[DataFrame] = []
    most = members.agg(F.max("n")).first()[0] or 1
    for base in range(0, max(height(most), 1), LEVELS):
        pieces = (members.withColumn("piece", F.expr(f"idx div {PIECE}")).repartition("tree", "piece")
                  .sortWithinPartitions("tree", "piece", "idx"))
        logs.append(shared_table(spark, pieces.mapInArrow(_build(base), LOG), "merkle-log", free=False))
        above = base + LEVELS
        members = logs[-1].filter((F.col("level") == above) & (F.col("n") > FAN ** above)).select("tree", "idx", "n", "digest")
    return logs


def roots(logs: list[DataFrame]) -> DataFrame:
    """(tree, digest) of each tree's root: the last node of its log."""
    out = None
    for k, log in enumerate(logs):
        low, high = LEVELS * k, LEVELS * (k + 1)
        size = F.col("n") > (FAN ** low if k else 0)
        whole = log.filter(size & (F.col("n") <= FAN ** high) & (F.col("idx") == 0))
        # The only level whose first node holds the whole tree and whose children, if any, are several.
        top = whole.filter(" or ".join(f"(level = {h} and n <= {FAN ** h} and n > {FAN ** (h - 1) if h else 0})"
                                       for h in range(low, high + 1))).select("tree", "digest")
        out = top if out is None else out.unionByName(top)
    return out


# ---------------------------------------------------------------- proofs

def _place(place: int, run: bytes) -> bytes:
    """One level of a proof: place in the run, number of siblings, siblings."""
    others = run[:32 * place] + run[32 * place + 32:]
    return bytes((place, len(others) // 32)) + others


def steps(proof: bytes):
    """(place, siblings) of each level of a proof, upwards."""
    at = 0
    while at < len(proof):
        end = at + 2 + 32 * proof[at + 1]
        yield proof[at], proof[at + 2:end]
        at = end


def fold(leaf: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its proof give."""
    for place, others in steps(proof):
        leaf = digest(others[:32 * place], leaf, others[32 * place:])
    return leaf


def _member_proofs(part: pa.Table, base: int):
    """(idx, digest, proof) of each member of a piece, and its tree's root, from the piece's log and its root's proof."""
    kind = part.column("kind").to_numpy()
    head = part.slice(0, 1)
    above, subroot = head.column("digest")[0].as_py(), head.column("extra")[0].as_py()
    log = part.slice(1, int((kind == 1).sum()))
    n, piece = log.column("n")[0].as_py(), part.column("piece")[0].as_py()
    stored, nodes = log.column("position").to_numpy(), log.column("digest").to_pylist()
    runs = []
    for level in range(base, min(base + LEVELS, height(n))):
        width = FAN ** (LEVELS - (level - base))
        first, last = piece * width, min((piece + 1) * width, -(-n // FAN ** level))
        at = np.searchsorted(stored, positions(level, np.arange(first, last), n))
        runs.append(b"".join(nodes[i] for i in at))
    count = len(runs[0]) // 32 if runs else 1
    for i in range(count):
        proof, k = [], i
        for run in runs:
            place, begin = k % FAN, 32 * (k - k % FAN)
            proof.append(_place(place, run[begin:begin + 32 * FAN]))
            k //= FAN
        yield piece * PIECE + i, (runs[0][32 * i:32 * i + 32] if runs else nodes[0]), b"".join(proof) + above, subroot


def _hand_down(base: int):
    """mapInArrow function: the proof of each member of a piece."""
    def run(batches):
        for part in _pieces(batches):
            tree = part.column("tree")[0].as_py()
            idx, _, proofs, subroot = zip(*_member_proofs(part, base))
            yield pa.RecordBatch.from_arrays([pa.array([tree] * len(idx), pa.string()), pa.array(idx, pa.int64()),
                                              pa.array(proofs, pa.binary()), pa.array(subroot, pa.binary())],
                                             names=["tree", "idx", "proof", "subroot"])
    return run


def _prove(batches):
    """mapInArrow function: each document's proof, folded from its tampered leaf where it has one."""
    for part in _pieces(batches):
        docs = part.filter(pa.compute.equal(part.column("kind"), 2))
        given = dict(zip(docs.column("idx").to_pylist(), zip(docs.column("doc_id").to_pylist(), docs.column("extra").to_pylist())))
        out: dict[str, list] = {c.split()[0]: [] for c in PROVED.split(", ")}
        for idx, leaf, proof, subroot in _member_proofs(part, 0):
            id_, tampered = given[idx]
            row = (id_, leaf.hex(), subroot.hex(), hashlib.sha256(hexlify(b"".join(s for _, s in steps(proof)))).hexdigest(),
                   fold(leaf if tampered is None else tampered, proof).hex())
            for values, value in zip(out.values(), row):
                values.append(value)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("doc_id", pa.int64())] + [(c, pa.string()) for c in list(out)[1:]]))


def _parts(base: int, log: DataFrame, above: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """Rows of PART by (tree, piece): the proofs ``above`` (tree, idx, proof, subroot), nodes of a log, documents."""
    null = F.lit(None)
    inside = F.col("level") < base + LEVELS
    piece = F.expr(" ".join(f"when level = {base + k} then idx div {FAN ** (LEVELS - k)}" for k in range(LEVELS)).join(("case ", " end")))
    shape = {c.split()[0]: c.split()[1] for c in PART.split(", ")}

    def rows(df: DataFrame, **given: Column) -> DataFrame:
        return df.select(*[given.get(c, null).cast(t).alias(c) for c, t in shape.items()])
    out = rows(above, tree=F.col("tree"), piece=F.col("idx"), kind=F.lit(0), digest=F.col("proof"), extra=F.col("subroot"))
    out = out.unionByName(rows(log.filter(inside), tree=F.col("tree"), piece=piece, kind=F.lit(1), position=F.col("position"),
                               n=F.col("n"), digest=F.col("digest")))
    if docs is not None:
        out = out.unionByName(rows(docs, tree=F.col("tree"), piece=F.expr(f"idx div {PIECE}"), kind=F.lit(2), idx=F.col("idx"),
                                   extra=F.col("tampered"), doc_id=F.col("doc_id")))
    return out.repartition("tree", "piece").sortWithinPartitions("tree", "piece", "kind", "position")


def _from_above(logs: list[DataFrame], given: DataFrame, upto: int, spark: SparkSession) -> DataFrame:
    """Proofs of the piece roots that log ``upto`` needs: handed down through the logs above it.

    ``given`` (tree, proof, subroot) are the roots' own; a tree enters at the log that closes it.
    """
    sizes = logs[0].filter("level = 0 and idx = 0").select(F.col("tree").alias("of"), "n")
    entering = given.join(sizes, F.col("tree").eqNullSafe(F.col("of"))).select("tree", F.lit(0).cast("long").alias("idx"), "proof", "subroot", "n")
    above = None
    for k in range(len(logs) - 1, upto - 1, -1):
        low, high = FAN ** (LEVELS * k) if k else 0, FAN ** (LEVELS * (k + 1))
        own = entering.filter((F.col("n") > low) & (F.col("n") <= high)).drop("n")
        above = own if above is None else above.unionByName(own)
        if k > upto:
            names = "tree string, idx long, proof binary, subroot binary"
            above = shared_table(spark, _parts(LEVELS * k, logs[k], above).mapInArrow(_hand_down(LEVELS * k), names), "merkle-proofs", free=False)
    return above


class Manifest:
    """Trees of a documents table: logs, roots and proofs.

    ``docs`` (tree, doc_id, idx, n, leaf, tampered); ``logs`` and ``top`` are the
    languages' and their roots' append logs.
    """

    def __init__(self, spark: SparkSession, docs: DataFrame, tampered: Column | None = None):
        self.spark = spark
        rows = shared_table(spark, leaves(docs, tampered), "merkle-leaves")
        self.empty = rows.isEmpty()
        if self.empty:
            return
        numbered = row_number_skew_safe(rows, "tree", ["doc_id", "leaf"], "idx")
        counts = rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("tree", "__tree")
        self.docs = shared_table(spark, numbered.join(counts, F.col("tree").eqNullSafe(F.col("__tree"))).drop("__tree")
                                 .withColumn("idx", F.col("idx") - 1), "merkle-docs")
        self.logs = append_logs(spark, self.docs.select("tree", "idx", "n", F.col("leaf").alias("digest")))
        subroots = shared_table(spark, roots(self.logs).withColumn("all", F.lit(0)), "merkle-roots", free=False)
        ordered = row_number_skew_safe(subroots, "all", ["tree"], "idx")
        self.subroots = shared_table(spark, ordered.select("tree", (F.col("idx") - 1).alias("idx"), "digest"), "merkle-subroots", free=False)
        n = self.subroots.count()
        self.top = append_logs(spark, self.subroots.select(F.lit(None).cast("string").alias("tree"), "idx", F.lit(n).cast("long").alias("n"), "digest"))
        self.root = bytes(roots(self.top).first()["digest"])

    def proofs(self) -> DataFrame:
        """A row per document: leaf, subroot, proof_sha256 and the root folded from its tampered leaf, else its own."""
        if self.empty:
            return self.spark.createDataFrame([], PROVED)
        spark = self.spark
        whole = spark.createDataFrame([(None, b"", self.root)], "tree string, proof binary, subroot binary")
        above = _from_above(self.top, whole, 0, spark)
        names = "tree string, idx long, proof binary, subroot binary"
        top = _parts(0, self.top[0], above).mapInArrow(_hand_down(0), names).select("idx", "proof")
        given = shared_table(spark, self.subroots.join(top, "idx").select("tree", "proof", F.col("digest").alias("subroot")), "merkle-given", free=False)
        pieces = _from_above(self.logs, given, 0, spark)
        return _parts(0, self.logs[0], pieces, self.docs).mapInArrow(_prove, PROVED)


def third_of_ids() -> Column:
    """Documents whose decimal id has a crc32 that 3 divides."""
    return F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 3 == 0


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roots, proofs and tamper checks of ``documents``."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    manifest = Manifest(spark, docs, third_of_ids())
    root = F.lit(None if manifest.empty else manifest.root.hex()).cast("string")
    return (manifest.proofs().withColumn("root", root).withColumn("verified", F.col("folded_root") == F.col("root"))
            .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))


# ---------------------------------------------------------------- the same in SQL

def _sql(levels: int = 9) -> str:
    """DuckDB SQL for op13, over trees of up to 8**levels leaves."""
    def fields(text: str) -> str:
        return " || ".join(f"(case when {c} is null then '-' else strlen({c}::varchar) || ':' || {c}::varchar end)"
                           for c in ("doc_id", "source", "lang", "n_chars", text))
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda r, i: xor(r >> 1, case when r % 2 = 1 then 3988292384 else 0 end))"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda ch: ascii(ch)::bigint)), lambda c, b: {bits}), 4294967295)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tree = "case when lang is null then '0' else '1' || lang end"
    parts = [f"""
l0 as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx,
    row_number() over () as row_id, case when doc_id is not null and {crc} % 3 = 0 then changed else leaf end as cur, '' as proof
  from (select doc_id, {tree} as tree, sha256({fields('text')}) as leaf,
          sha256({fields(f"translate(text, '{upper}', '{upper.lower()}')")}) as changed from documents)),
n0 as (select tree, idx, leaf as digest, count(*) over (partition by tree) as m from l0),
d0 as (select row_id, doc_id, leaf, tree, idx, cur, proof from l0)"""]

    def climb(k: int, n: str, d: str, a: str) -> str:
        """Level k + 1 of nodes and of each document's path; one node alone stays."""
        return f"""
{a}r{k} as (select tree, idx // 8 as idx, list(digest order by idx) as run, any_value(m) as m from {n} group by tree, idx // 8),
{a}n{k} as (select tree, idx, case when m = 1 then run[1] else sha256(array_to_string(run, '')) end as digest, count(*) over (partition by tree) as m from {a}r{k}),
{a}d{k} as (
  select d.row_id, d.doc_id, d.leaf, d.tree, d.idx // 8 as idx,
    case when r.m = 1 then cur else sha256(array_to_string(run[:d.idx % 8], '') || cur || array_to_string(run[d.idx % 8 + 2:], '')) end as cur,
    case when r.m = 1 then proof else proof || array_to_string(run[:d.idx % 8], '') || array_to_string(run[d.idx % 8 + 2:], '') end as proof
  from {d} d join {a}r{k} r on d.tree = r.tree and d.idx // 8 = r.idx)"""
    n, d = "n0", "d0"
    for k in range(levels):
        parts.append(climb(k, n, d, "s"))
        n, d = f"sn{k}", f"sd{k}"
    parts.append(f"""
subroots as (select tree, digest, row_number() over (order by tree) - 1 as place from {n}),
tn as (select 't' as tree, place as idx, digest, count(*) over () as m from subroots),
td as (select d.row_id, d.doc_id, d.leaf, 't' as tree, place as idx, d.cur, d.proof from {d} d join subroots s on d.tree = s.tree)""")
    n, d = "tn", "td"
    for k in range(levels):
        parts.append(climb(k, n, d, "t"))
        n, d = f"tn{k}", f"td{k}"
    return "with" + ",".join(parts) + f"""
select l.doc_id, l.leaf, s.digest as subroot, r.digest as root, sha256(d.proof) as proof_sha256, d.cur as folded_root, d.cur = r.digest as verified
from {d} d join l0 l on l.row_id = d.row_id join subroots s on s.tree = l.tree cross join {n} r"""


ORACLE_SQL = _sql()
