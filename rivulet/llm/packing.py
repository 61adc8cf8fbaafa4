"""Order-preserving packing of documents into training sequences.

Documents are read in table order as one stream of token ids, each followed by
the end id 0.  Sequence cuts may fall at document ends, at sentence ends inside
a document (for a penalty) and, where a stretch without any such boundary is
longer than a sequence, at the sequence length (for a larger penalty).  The cuts
minimise

    sum over sequences of  padding + cut penalty + a fixed cost

by dynamic programming over the boundaries.  Padding is linear in the length, so
the best start for a boundary is the minimum of ``cost + position`` over the
boundaries at most ``SIZE`` back: a sliding-window minimum, held in a monotone
queue, one push and one pop a boundary.  A sequence whose length is a power of
two is not padded; those ten starts are looked up by position.

Every scan task packs its own documents, so nothing is shuffled and a lost
executor only repeats its own tasks (file splits are read in a fixed order).
The stream is solved in blocks of ``BLOCK`` tokens; the boundaries behind the
cheapest end near a block's edge go on to the next block, so memory is bounded
and no document is cut at a block edge.

Defined results: null or empty text is the end id alone; equal or repeated rows
are packed one by one in table order; null doc_id stays null; an empty table
gives no row; other columns are ignored; a document of any length is cut only
where the rules above allow it.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from rivulet.llm.common import byte_encoder, table, tokenizer_path

SIZE, END_ID = 1024, 0
SENTENCE_PENALTY, HARD_PENALTY, SEQUENCE_COST = 2, 64, 16
BLOCK = 1 << 18
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_SPECIAL = "<|endoftext|>"


@functools.lru_cache(maxsize=1)
def _whole_tokenizer(folder: str | None):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json", folder))


def token_ids(text: str, folder: str | None = None) -> np.ndarray:
    """Ids of byte_bpe_50k without special tokens added, then the end id."""
    encoder = byte_encoder(folder=folder)
    try:
        ids = (np.array(encoder.encode(text, allowed_special="all"), np.uint32) if _SPECIAL in text
               else encoder.encode_to_numpy(text, disallowed_special=()))
    except BaseException as error:  # the fast encoder's regex gives up on some endless runs
        if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
            raise
        ids = np.array(_whole_tokenizer(folder).encode(text, add_special_tokens=False).ids, np.uint32)
    return np.append(ids, np.uint32(END_ID))


@functools.lru_cache(maxsize=1)
def sentence_ends(folder: str | None = None) -> np.ndarray:
    """For each id, whether its text ends a sentence or a line."""
    encoder = byte_encoder(folder=folder)
    ends = re.compile(rb"[.!?\n]['\")\]]*\s*$")
    return np.array([bool(ends.search(encoder.decode_single_token_bytes(i))) for i in range(encoder.n_vocab)])


def boundaries(ids: np.ndarray, doc_ends: np.ndarray, folder: str | None = None, size: int = SIZE,
               sentence_penalty: int = SENTENCE_PENALTY, hard_penalty: int = HARD_PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which the stream may be cut, with the penalty of each.

    Never more than ``size`` apart; 0 is not among them, the stream's end may be.
    """
    at = np.flatnonzero(sentence_ends(folder)[ids]) + 1
    at = np.union1d(at, doc_ends)
    edge = np.r_[0, at, len(ids)]
    gaps = np.diff(edge)
    if (wide := np.flatnonzero(gaps > size)).size:
        at = np.union1d(at, np.concatenate([np.arange(edge[i] + size, edge[i + 1], size) for i in wide]))
    hard = ~np.isin(at, edge)
    penalty = np.where(hard, hard_penalty, sentence_penalty)
    penalty[np.isin(at, doc_ends)] = 0
    return at.astype(np.int64), penalty


def best_cuts(at: np.ndarray, penalty: np.ndarray, end: int | None, size: int = SIZE,
              sequence_cost: int = SEQUENCE_COST) -> list[int]:
    """Cuts of least cost from 0 to ``end``; None: to the cheapest late boundary."""
    places, costs = [0, *at.tolist()], [0, *penalty.tolist()]
    best, back = [0] * len(places), [0] * len(places)
    index = {0: 0}
    powers = [1 << k for k in range(size.bit_length() - 1)]
    queue = deque([0])  # boundaries by rising best + place: the first is the cheapest start in reach
    for j in range(1, len(places)):
        place = places[j]
        while places[queue[0]] < place - size:
            queue.popleft()
        i = queue[0]
        cost = best[i] + places[i] + size - place
        for power in powers:
            k = index.get(place - power)
            if k is not None and best[k] < cost:
                cost, i = best[k], k
        best[j], back[j] = cost + costs[j] + sequence_cost, i
        index[place] = j
        value = best[j] + place
        while queue and best[queue[-1]] + places[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    j = len(places) - 1
    if end is None:
        # The rest is packed with what follows, so compare costs less what each leaves.
        late = [k for k in range(len(places)) if places[k] >= places[-1] - size]
        j = min(late, key=lambda k: best[k] - places[k])
    cuts = []
    while j:
        cuts.append(places[j])
        j = back[j]
    return cuts[::-1]


def _emit(docs: list[list], ids: np.ndarray, cuts: list[int], first_sequence: int) -> list[tuple]:
    """Piece rows of the stream up to the last cut; docs: [doc_id, begin, end, before, doc_tokens]."""
    rows = []
    cut, sequence_start = 0, 0
    for doc in docs:
        name, begin, end, before, total = doc
        at = begin
        while at < end and cut < len(cuts):
            stop = min(end, cuts[cut])
            rows.append((name, before + at - begin, stop - at, zlib.crc32(ids[at:stop].tobytes()), total,
                         first_sequence + cut, at - sequence_start))
            at = stop
            if at == cuts[cut]:
                cut, sequence_start = cut + 1, cuts[cut]
    return rows


class Packer:
    """Packs a stream of documents; memory is one block and the longest document."""

    def __init__(self, first_sequence: int, folder: str | None = None, block: int = BLOCK, size: int = SIZE):
        self.sequence, self.folder, self.block, self.size = first_sequence, folder, block, size
        self.docs: list[list] = []
        self.ids: list[np.ndarray] = []
        self.count = 0

    def add(self, name, ids: np.ndarray) -> list[tuple]:
        self.docs.append([name, self.count, self.count + len(ids), 0, len(ids)])
        self.ids.append(ids)
        self.count += len(ids)
        return self.flush(last=False) if self.count >= self.block else []

    def flush(self, last: bool) -> list[tuple]:
        if not self.count:
            return []
        ids = np.concatenate(self.ids)
        at, penalty = boundaries(ids, np.array([d[2] for d in self.docs]), self.folder, self.size)
        cuts = best_cuts(at, penalty, len(ids) if last else None, self.size)
        rows = _emit(self.docs, ids, cuts, self.sequence)
        self.sequence += len(cuts)
        done = cuts[-1] if cuts else 0
        self.docs = [[name, max(begin, done) - done, end - done, before + max(0, done - begin), total]
                     for name, begin, end, before, total in self.docs if end > done]
        self.ids, self.count = [ids[done:].copy()], len(ids) - done
        return rows


def _pack(folder: str | None, block: int):
    kinds = [pa.int64()] * 7
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def batch_of(rows):
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches):
        packer = Packer(TaskContext.get().partitionId() << 40, folder, block)
        for batch in batches:
            rows = []
            names_, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                rows += packer.add(names_[i].as_py(), token_ids(texts[i].as_py() or "", folder))
                if len(rows) >= 4096:
                    yield batch_of(rows)
                    rows = []
            yield batch_of(rows)
        yield batch_of(packer.flush(last=True))
    return run


def pack(documents: DataFrame, tokenizer_folder: str | None = None, block: int = BLOCK) -> DataFrame:
    """Pieces of all documents: which ids of each lie where in which sequence."""
    rows = documents.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(_pack(tokenizer_folder, block), SCHEMA)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 1024 tokens."""
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"))
