"""Helpers shared by the corpus operators: tables, shared folder, Arrow blocks."""

from __future__ import annotations

import base64
import functools
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import checkpoint_dir, release

#: Stands for a null id inside an operator (ids are longs); turned back on the way out.
NULL_ID = -(1 << 63)


def ship(spark: SparkSession) -> None:
    """Give executors this package, once a context: they may not have it on their path."""
    context = spark.sparkContext
    if getattr(context, "_rivulet_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="rivulet-code-"), "rivulet_package.zip")  # read by the driver, which serves it
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    context._rivulet_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table, whatever else it carries."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def id_text(df: DataFrame, rest: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text) with null ids as NULL_ID and null texts as empty; other columns as one struct, ``rest``."""
    columns = [F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
               F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")]
    if rest:
        columns.append(F.struct(*(F.col(f"`{c}`") for c in rest)).alias("rest"))
    return df.select(*columns)


def told_apart(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` of ``id_text`` with ``copy``: 0, or the text's hash where a doc_id has several texts.

    (doc_id, copy) names a text whatever its doc_id.  The ids with several texts are
    written first, so that Spark knows how few they are and need not shuffle texts for them.
    """
    print_ = F.xxhash64("text")
    several = shared_table(spark, docs.groupBy("doc_id").agg(F.min(print_).alias("low"), F.max(print_).alias("high"))
                           .filter("low <> high").select("doc_id", F.lit(True).alias("several")), "several")
    return (docs.join(several, "doc_id", "left").withColumn("copy", F.when(F.col("several"), print_).otherwise(F.lit(0).cast("long")))
            .drop("several"))


def restore_id(column: str = "doc_id"):
    """The id column with NULL_ID turned back into null."""
    return F.nullif(F.col(column), F.lit(NULL_ID)).alias(column)


def shared_table(spark: SparkSession, df: DataFrame, name: str, free: bool = True) -> DataFrame:
    """Write ``df`` as Parquet into the cluster's shared folder and read it back.

    Cuts lineage: a lost executor later recomputes from these files only.  The
    path is new on every call, so a retried query never reads a half-written one.
    The finished job's shuffle files go when the driver collects its garbage; that
    is asked for here rather than left to the next periodic collection, unless ``free``
    is off, for jobs that shuffle little.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    schema = df.schema
    del df
    if free:
        release(spark)
    return spark.read.schema(schema).parquet(path)


def blocks_of_groups(batches, keys: tuple[str, ...], rows: int = 1 << 17):
    """Arrow tables of about ``rows`` rows that never split a run of equal keys.

    The input must be sorted (or at least grouped) by ``keys``; a block ends at
    a change of key, so whole groups are seen together without one block for
    each group.
    """
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        change = np.zeros(count, bool)
        for key in keys:
            values = whole.column(key).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        cuts = np.flatnonzero(change)
        if len(cuts):
            yield whole.slice(0, cuts[-1])
            rest = whole.slice(cuts[-1]).combine_chunks()
        else:
            rest = whole
        held, count = rest.to_batches(), rest.num_rows
        if not len(cuts):
            rows *= 2
    if count:
        yield pa.Table.from_batches(held).combine_chunks()


def segments(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of arange(start, start + length) over all pairs."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """A public tokenizer's file: in ``folder``, or where public_tokenizers keeps it."""
    if folder:
        return f"{folder.rstrip('/')}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id of a ``.tiktoken`` file."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@functools.lru_cache(maxsize=4)
def byte_encoder(name: str = "byte_bpe_50k.tiktoken", folder: str | None = None,
                 special: str | None = "<|endoftext|>"):
    """A byte-level BPE encoder; the special string keeps the id after the ranks."""
    import public_tokenizers
    import tiktoken

    ranks = byte_ranks(tokenizer_path(name, folder))
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={special: len(ranks)} if special else {})


def crc_fold(column: str, modulus: int):
    """crc32 of an id written as text, modulo ``modulus``; null ids count as ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus
