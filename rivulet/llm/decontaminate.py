"""Benchmark passages in documents, found by edit distance on words.

Words are runs of bytes other than ASCII punctuation, space and controls, A-Z as
a-z, so markup characters and punctuation between words don't matter.  An item
of m words occurs in a document if at most ``floor(m * (100 - percent) / 100)``
word edits turn it into some run of the document's words.

Method: every window of an item's size goes through a CGK embedding
(Chakraborty, Goldenberg, Koucky): a walk over 3m steps that writes the current
word and moves on when a random function of step and word says so, which maps
edit distance to Hamming distance.  A repetition samples ``BITS`` embedded
symbols as a bucket key; item and window meet if their keys agree in one of the
repetitions, whose number follows from the target recall.  Pairs that meet are
confirmed by exact edit distance.

Only windows that can match are embedded: of an item cut into one block more
than it may have edits, one block stands unedited in any occurrence, so a window
starts within that many words of where a block of its item, found by hash,
puts it.  This loses no occurrence.

The benchmark is the stated query set.  It goes to the tasks in blocks of at
most ``BLOCK_BYTES`` of text, one pass over the documents for each block;
documents are only scanned, never shuffled.

Defined results: items under ``LEAST`` words or null take no part; null text
has no words; an item row that repeats gives its own hits under its own item_id;
repeated documents give a hit each; a null doc_id stays null; occurrences of one
item that overlap in a document are one hit, the closest (the first of equals);
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import segments, table
from rivulet.llm.shingles import scramble, sequences, span_hashes

LEAST, PERCENT, RECALL, BITS = 5, 80, 0.99, 2
#: Chance that a sampled symbol of an occurrence at the allowed distance agrees (measured: 0.45 to 0.6).
AGREE = 0.45
BLOCK_BYTES = 16 << 20

HITS = "doc_id long, item_id long, begin int, end int, edits int, item_words int"
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[*range(48), *range(58, 65), *range(91, 97), *range(123, 128)]] = True
_PAD = np.uint64(0)
_LINE = np.array([10], np.uint8)


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, begin, end) of each word of UTF-8 bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SEPARATOR[data]
    edge = np.diff(inside)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return span_hashes(data, begin, end), begin, end


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def repetitions(recall: float = RECALL, bits: int = BITS, agree: float = AGREE) -> int:
    """Independent repetitions that reach the recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agree ** bits))


def embed_keys(rows: np.ndarray, count: int, bits: int = BITS) -> np.ndarray:
    """Bucket keys (repetition, row): ``bits`` sampled symbols of each repetition's CGK embedding."""
    lines, m = rows.shape
    rng = np.random.Generator(np.random.PCG64([3, count, m]))
    odd = rng.integers(0, 1 << 63, (3 * m, count, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    sampled: dict[int, list[int]] = {}
    for r in range(count):
        # A walk leaves the text after 2m steps on average; later symbols say little.
        for step in rng.choice(max(bits, 2 * m), bits, replace=False).tolist():
            sampled.setdefault(step, []).append(r)
    padded = np.concatenate([rows, np.full((lines, 1), _PAD)], axis=1).ravel()
    base = np.arange(lines) * (m + 1)
    at, keys = np.zeros((count, lines), np.int64), np.zeros((count, lines), np.uint64)
    for step in range(max(sampled) + 1):
        symbol = padded[base + at]
        for r in sampled.get(step, ()):
            keys[r] = scramble(keys[r] * np.uint64(0x9E3779B97F4A7C15) + symbol[r])
        at += (symbol * odd[step] >> np.uint64(63)).astype(np.int64)
        np.minimum(at, m, out=at)
    return keys


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least word edits between the item and a prefix of text, and that prefix's length (the longest of equals)."""
    row = np.arange(len(text) + 1)
    ramp = np.arange(len(text) + 1)
    for i, word in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != word))
        row = np.minimum.accumulate(new - ramp) + ramp
    end = len(row) - 1 - int(np.argmin(row[::-1]))
    return int(row[end]), end


class Index:
    """Items by size: their words, seed blocks and bucket keys."""

    def __init__(self, items: list[tuple[int, str | None]], percent: int = PERCENT, recall: float = RECALL):
        self.repetitions = repetitions(recall)
        self.ids, self.words = [], []
        for item_id, text in items:
            words = words_of(as_bytes(text))[0]
            if len(words) >= LEAST:
                self.ids.append(item_id)
                self.words.append(words)
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.edits = self.sizes * (100 - percent) // 100
        seeds: dict[int, list] = {}
        for i, words in enumerate(self.words):
            blocks = int(self.edits[i]) + 1
            size = len(words) // blocks
            hashes = sequences(words, size)
            seeds.setdefault(size, []).extend((int(hashes[b * size]), i, b * size) for b in range(blocks))
        #: by block size: sorted hashes, their items and offsets, and a bit table that most words fail
        self.seeds = {}
        for size, rows in seeds.items():
            rows.sort()
            hashes = np.array([r[0] for r in rows], np.uint64)
            bits = max(16, 4 + len(rows).bit_length())
            bitmap = np.zeros(1 << bits, bool)
            bitmap[hashes >> np.uint64(64 - bits)] = True
            self.seeds[size] = (hashes, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), bitmap, np.uint64(64 - bits))
        #: by item size: the items, and for each repetition their sorted keys
        self.groups = {}
        for size in np.unique(self.sizes).tolist():
            members = np.flatnonzero(self.sizes == size)
            rows = np.stack([self.words[i] for i in members])
            keys = embed_keys(rows, self.repetitions)
            orders = np.argsort(keys, axis=1, kind="stable")
            self.groups[size] = (members, [(k[o], o) for k, o in zip(keys, orders, strict=True)])

    def seeded(self, words: np.ndarray) -> np.ndarray:
        """Positions where some item's block may start (all of those that do, few others)."""
        at = [np.flatnonzero(bitmap[sequences(words, size) >> shift])
              for size, (_, _, _, bitmap, shift) in self.seeds.items() if len(words) >= size]
        return np.unique(np.concatenate(at)) if at else np.zeros(0, np.int64)

    def windows(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(size, start) of the windows that a block of some item of that size allows."""
        found = []
        for size, (hashes, items, offsets, bitmap, shift) in self.seeds.items():
            if len(words) < size:
                continue
            here = sequences(words, size)
            at = np.flatnonzero(bitmap[here >> shift])
            if not len(at):
                continue
            low, high = np.searchsorted(hashes, here[at], "left"), np.searchsorted(hashes, here[at], "right")
            hit = segments(low, high - low)
            place = np.repeat(at, high - low) - offsets[hit]
            item = items[hit]
            edits = self.edits[item]
            span = 2 * edits + 1
            start = segments(place - edits, span)
            found.append(np.stack([np.repeat(self.sizes[item], span), start]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.concatenate(found, axis=1)
        # A window may hang over the document's edges by the edits allowed.
        pairs = np.unique(pairs[:, (pairs[1] > -pairs[0]) & (pairs[1] < len(words))], axis=1)
        return pairs[0], np.maximum(pairs[1], 0)

    def candidates(self, words: np.ndarray) -> set[tuple[int, int]]:
        """(item, start) of windows that meet an item in some repetition."""
        met = set()
        sizes, starts = self.windows(words)
        for size in np.unique(sizes).tolist():
            own = np.unique(starts[sizes == size])
            members, tables = self.groups[size]
            padded = np.concatenate([words, np.full(size, _PAD)])
            for a in range(0, len(own), 4096):
                part = own[a:a + 4096]
                rows = padded[part[:, None] + np.arange(size)]
                for mine, (keys, order) in zip(embed_keys(rows, self.repetitions), tables, strict=True):
                    low, high = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
                    hit = segments(low, high - low)
                    met.update(zip(members[order[hit]].tolist(), np.repeat(part, high - low).tolist(), strict=True))
        return met

    def hits(self, words: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item, first word, end word, edits), overlapping occurrences of an item merged."""
        by_item: dict[int, list[int]] = {}
        for item, start in self.candidates(words):
            by_item.setdefault(item, []).append(start)
        out = []
        for item, starts in sorted(by_item.items()):
            own, allowed = self.words[item], int(self.edits[item])
            best: list[tuple[int, int, int]] = []
            exact_until = -1
            for start in sorted(starts):
                if start < exact_until:
                    continue
                text = words[start:start + len(own) + allowed]
                if len(text) >= len(own) and np.array_equal(text[:len(own)], own):
                    edits, length = 0, len(own)
                    exact_until = start + length
                else:
                    edits, length = edit_distance(own, text)
                if edits <= allowed and length:
                    best.append((start, start + length, edits))
            kept: list[tuple[int, int, int]] = []
            for start, end, edits in sorted(best, key=lambda x: (x[2], x[0])):
                if all(end <= a or start >= b for a, b, _ in kept):
                    kept.append((start, end, edits))
            out += [(item, *k) for k in sorted(kept)]
        return out


def joined(texts, size: int = 1 << 20):
    """Texts of a column put together, a line feed after each, up to ``size`` bytes or one text:
    ((row, begin, end) of each, bytes)."""
    places, parts, at = [], [], 0
    for row, text in enumerate(texts):
        if not text.is_valid or not (length := len(text.as_buffer())):
            continue
        places.append((row, at, at + length))
        parts += [np.frombuffer(text.as_buffer(), np.uint8), _LINE]
        at += length + 1
        if at >= size:
            yield np.array(places), np.concatenate(parts)
            places, parts, at = [], [], 0
    if places:
        yield np.array(places), np.concatenate(parts)


def _search(index: Index):
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]

    def run(batches):
        for batch in batches:
            rows = []
            names = batch.column(0).to_pylist()
            for places, data in joined(batch.column(1)):
                words, begin, end = words_of(data)
                # Blocks across two texts only call for a look at texts that hold none.
                first = np.searchsorted(begin, places[:, 1])
                for k in np.unique(np.searchsorted(first, index.seeded(words), "right") - 1).tolist():
                    row, offset, _ = places[k].tolist()
                    a, z = first[k], first[k + 1] if k + 1 < len(first) else len(words)
                    rows += [(names[row], index.ids[item], int(begin[a + u]) - offset, int(end[a + v - 1]) - offset, edits,
                              int(index.sizes[item])) for item, u, v, edits in index.hits(words[a:z])]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["doc_id", "item_id", "begin", "end", "edits", "item_words"])
    return run


def find_passages(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT,
                  recall: float = RECALL, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Hits (doc_id, item_id, begin, end, edits, item_words); begin and end count the text's UTF-8 bytes."""
    docs = documents.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text")
    out = None
    for index in _indices(benchmark, percent, recall, block_bytes):
        hits = docs.mapInArrow(_search(index), HITS)
        out = hits if out is None else out.unionByName(hits)
    return out


def _indices(benchmark: DataFrame, percent: int, recall: float, block_bytes: int):
    """The benchmark in blocks of bounded size, one at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(2 * size / block_bytes))
    for k in range(blocks):
        own = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k)
        yield Index([(r[0], r[1]) for r in own.sort("item_id", "text").collect()], percent, recall)


def _clean(index: Index):
    search = _search(index)

    def run(batches):
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), batch.column("text")], names=["doc_id", "text"])
            hit = np.zeros(batch.num_rows, bool)
            for found in search([texts]):
                hit[found.column("doc_id").to_numpy()] = True
            yield batch.filter(pa.array(~hit))
    return run


def drop_contaminated(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT,
                      recall: float = RECALL, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without a passage, all columns as they were; a scan, whatever the ids."""
    rows = documents.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string"
    for index in _indices(benchmark, percent, recall, block_bytes):
        rows = rows.mapInArrow(_clean(index), schema)
    return rows.select("row.*")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage in every document."""
    return find_passages(spark, table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
