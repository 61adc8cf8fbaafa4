"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public byte-level
vocabulary.  A word's probability is the sum over all its segmentations into
pieces, by the forward algorithm over its bytes; a text's is the product over
its words.  The prediction is the language under which the text is likeliest,
the score its posterior under equal priors.

Words are runs of letters, lower-cased; digits, punctuation and markup say
nothing.  The vocabulary holds every byte, so every word has a segmentation.

Training counts pieces of all training texts: a task cuts the words of a batch
with the public tokenizer and sends one row for each (language, piece), so what is shuffled and collected is bounded by
languages times the vocabulary (``MOST_LANGUAGES`` checks the former).  Scoring
only scans: distinct words of a batch go through the forward algorithm once, in
numpy, words of like length together, over a rolling window as long as the
vocabulary's longest piece.  A word over ``LONG`` bytes goes alone, block by block, in
time that follows its length.

Defined results: null text or text without a letter is ``und`` with score 0, so
is any text if nothing was learned; rows with null text or language teach
nothing; ties between languages go to the smaller name; every row is returned,
repeated ones alike; a word of any length is scored whole, by pieces of any
length; a null doc_id counts as '' in the fold; an empty table gives no row; other
columns are ignored.
"""

from __future__ import annotations

import functools
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import byte_encoder, byte_ranks, crc_fold, table, tokenizer_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
UND, SMOOTHING, MOST_LANGUAGES = "und", 0.5, 1000
#: Distinct words whose scores a task keeps between batches.
KNOWN = 300_000
#: Longest piece, in bytes, that a segmentation may use: any of the vocabulary.
PIECE = math.inf
#: Words that go through the forward algorithm together.
TOGETHER = 1 << 12
#: Words over so many bytes go alone, block by block.
LONG, LONG_BLOCK = 2048, 1 << 16
_WORD = re.compile(r"[^\W\d_]+")
_BASE, _SPREAD = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xC2B2AE3D27D4EB4F)
_SLOTS = 22
_SHIFT = np.uint64(64 - _SLOTS)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _count(folder: str | None):
    """Batches of (text, lang) to (lang, piece, count)."""
    def run(batches):
        encoder = byte_encoder(VOCABULARY, folder, None)
        for batch in batches:
            by_lang: dict[str, np.ndarray] = {}
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                counts = by_lang.setdefault(lang.as_py(), np.zeros(encoder.n_vocab, np.int64))
                if words := words_of(text.as_py()):
                    pieces = encoder.encode_to_numpy(" " + " ".join(words), disallowed_special=())
                    if len(pieces) < 4096:
                        np.add.at(counts, pieces, 1)
                    else:
                        counts += np.bincount(pieces, minlength=len(counts))
            for lang, counts in by_lang.items():
                known = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(known), pa.string()), pa.array(known, pa.int64()),
                     pa.array(counts[known], pa.int64())], names=["lang", "piece", "n"])
    return run


class Model:
    """Piece log probabilities of each language, and the forward algorithm."""

    def __init__(self, languages: list[str], counts: np.ndarray, folder: str | None = None, smoothing: float = SMOOTHING):
        self.languages, self.folder = languages, folder
        self.known: dict[str, np.ndarray] = {}
        self.chance = (counts + smoothing) / (counts.sum(axis=0) + smoothing * len(counts))

    def __getstate__(self):
        return {"languages": self.languages, "folder": self.folder, "chance": self.chance, "known": {}}

    @functools.cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
        """Sorted keys of pieces, where each slot of leading bits starts among them,
        their probabilities (the last row is 'no piece'), the fullest slot, and the longest piece."""
        ranks = byte_ranks(tokenizer_path(VOCABULARY, self.folder))
        pieces = list(ranks.items())
        keys = np.zeros(len(pieces), np.uint64)
        width = max(len(p) for p, _ in pieces)
        data = np.zeros((len(pieces), width), np.uint64)
        length = np.array([len(p) for p, _ in pieces])
        for row, (piece, _) in enumerate(pieces):
            data[row, :len(piece)] = np.frombuffer(piece, np.uint8)
        for k in range(width):
            keys = np.where(k < length, keys * _BASE + data[:, k] + np.uint64(1), keys)
        keys *= _SPREAD
        order = np.argsort(keys)
        keys = keys[order]
        chance = self.chance[np.array([i for _, i in pieces])[order]]
        slots = np.searchsorted(keys, np.arange(1 << _SLOTS, dtype=np.uint64) << np.uint64(64 - _SLOTS))
        most = int(np.diff(np.r_[slots, len(keys)]).max())
        return (np.r_[keys, np.zeros(most, np.uint64)], slots.astype(np.int32),
                np.concatenate([chance, np.zeros((1, chance.shape[1]))]), most, width)

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """log10 probability (word, language), summed over all segmentations."""
        out = np.zeros((len(words), len(self.languages)))
        length = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-length, kind="stable")
        alone = int((length > LONG).sum())
        for i in order[:alone].tolist():
            out[i] = self._forward_long(words[i])
        for a in range(alone, len(words), TOGETHER):
            part = order[a:a + TOGETHER]
            out[part] = self._forward([words[i] for i in part.tolist()], length[part])
        return out

    def _forward(self, words: list[bytes], length: np.ndarray) -> np.ndarray:
        """Scores of words, the longest first; a step leaves out those that have ended."""
        keys, slots, chance, most, width = self.table
        nothing, n = len(chance) - 1, int(length[0])
        flat, first = np.frombuffer(b"".join(words), np.uint8), np.cumsum(length) - length
        out = np.zeros((len(words), len(self.languages)))
        # Slot i % ring holds the chance of the first i bytes, over 10 ** scale: as far back as a piece reaches.
        ring = min(width, n) + 1
        forward = np.zeros((ring, len(words), len(self.languages)))
        forward[0] = 1
        scale = np.zeros((ring, len(words), 1))
        own = np.zeros((ring, len(words)), np.uint64)  # hash of bytes i .. j
        for j in range(n):
            count = int(np.searchsorted(-length, -j))  # words of over j bytes
            slot_now, slot_next, used = j % ring, (j + 1) % ring, min(j + 1, ring)
            own[slot_now] = 0
            hashes = own[:used, :count]
            hashes *= _BASE
            hashes += flat[first[:count] + j].astype(np.uint64) + np.uint64(1)
            key = hashes * _SPREAD
            slot = slots[key >> _SHIFT]
            at = np.full(key.shape, nothing)
            for m in range(most):
                same = keys[slot + m] == key
                at[same] = slot[same] + m
            begins = [k for k in range(used) if k != slot_next]
            top = scale[begins, :count].max(axis=0)
            new = np.zeros((count, len(self.languages)))
            for k in begins:
                rows = np.flatnonzero(at[k] != nothing)
                if len(rows):
                    new[rows] += forward[k, rows] * (chance[at[k, rows]] * 10.0 ** (scale[k, rows] - top[rows]))
            high = new.max(axis=1, keepdims=True)
            forward[slot_next, :count] = new / high
            scale[slot_next, :count] = top + np.log10(high)
            ended = slice(int(np.searchsorted(-length, -j - 1)), count)  # words of j + 1 bytes
            out[ended] = np.log10(np.maximum(forward[slot_next, ended], 1e-300)) + scale[slot_next, ended]
        return out

    def _forward_long(self, word: bytes) -> np.ndarray:
        """Scores of one long word.  The pieces that begin in a block are found at once, a
        length at a time; then each position hands its chance on to the ends of its pieces."""
        keys, slots, chance, most, width = self.table
        nothing, n, out = len(chance) - 1, len(word), np.zeros(len(self.languages))
        ahead = [[1.0] + [0.0] * width for _ in self.languages]  # chances of the next positions, over 10 ** scale
        for a in range(0, n, LONG_BLOCK):
            size = min(LONG_BLOCK, n - a)
            data = np.frombuffer(word, np.uint8, min(size + width, n - a), a).astype(np.uint64) + np.uint64(1)
            hashes, begin, end, piece = np.zeros(size, np.uint64), [], [], []
            for k in range(1, min(width, len(data)) + 1):
                count = min(size, len(data) - k + 1)
                hashes = hashes[:count] * _BASE + data[k - 1:k - 1 + count]
                key = hashes * _SPREAD
                slot = slots[key >> _SHIFT]
                at = np.full(count, nothing)
                for m in range(most):
                    same = keys[slot + m] == key
                    at[same] = slot[same] + m
                hit = np.flatnonzero(at != nothing)
                begin.append(hit)
                end.append(hit + k)
                piece.append(at[hit])
            begin = np.concatenate(begin)
            order = np.argsort(begin, kind="stable")
            first = np.searchsorted(begin[order], np.arange(size + 1)).tolist()
            end, piece = np.concatenate(end)[order].tolist(), np.concatenate(piece)[order]
            for lang in range(len(self.languages)):
                each = chance[piece, lang].tolist()
                total = ahead[lang] + [0.0] * size
                for i in range(size):
                    here = total[i]
                    for m in range(first[i], first[i + 1]):
                        total[end[m]] += here * each[m]
                    if here < 1e-100:
                        high = max(total[i + 1:i + 1 + width])
                        if high < 1e-100:
                            total[i + 1:i + 1 + width] = [x / high for x in total[i + 1:i + 1 + width]]
                            out[lang] += math.log10(high)
                ahead[lang] = total[size:size + width + 1]
        return out + np.log10(np.maximum([x[0] for x in ahead], 1e-300))

    def _distinct_scores(self, words: list[str]) -> np.ndarray:
        """log10 probability (word, language); words seen before come from a bounded store."""
        if len(self.known) > KNOWN:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        scores = self.word_scores([(" " + w).encode() for w in new])
        self.known.update(zip(new, scores, strict=True))
        return np.array([self.known[w] for w in words])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Predicted language and score of each text."""
        flat, lengths = [], []
        for text in texts:
            words = words_of(text or "")
            lengths.append(len(words))
            flat += words
        if not self.languages or not flat:
            return [UND] * len(texts), np.zeros(len(texts))
        flat, distinct = pd.factorize(np.array(flat, object))
        scores = self._distinct_scores(distinct.tolist())
        total = np.zeros((len(flat) + 1, len(self.languages)))
        np.cumsum(scores[flat], axis=0, out=total[1:])
        end = np.cumsum(lengths)
        text_scores = total[end] - total[end - lengths]
        best = text_scores.argmax(axis=1)
        posterior = 1 / (10.0 ** np.maximum(text_scores - text_scores.max(axis=1, keepdims=True), -300)).sum(axis=1)
        spoken = np.array(lengths) > 0
        return ([self.languages[b] if s else UND for b, s in zip(best, spoken, strict=True)], np.where(spoken, posterior, 0.0))


def train(documents: DataFrame, folder: str | None = None) -> Model:
    """Model of the non-null languages of (text, lang); counts are over all rows."""
    given = documents.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(
        "text IS NOT NULL AND lang IS NOT NULL")
    rows = (given.mapInArrow(_count(folder), "lang string, piece long, n long").groupBy("lang", "piece")
            .agg(F.sum("n").alias("n")))
    # The wide part arrives as arrays of a language, not as rows.
    found = rows.groupBy("lang").agg(F.collect_list("piece").alias("piece"), F.collect_list("n").alias("n")).sort("lang").collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"{len(found)} languages; the model is broadcast and holds at most {MOST_LANGUAGES}")
    counts = np.zeros((byte_encoder(VOCABULARY, folder, None).n_vocab, len(found)))
    for k, row in enumerate(found):
        counts[row["piece"], k] = row["n"]
    return Model([r["lang"] for r in found], counts, folder)


def _predict(model: Model, width: int = 1000):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, width):
                part = batch.slice(at, width)
                langs, scores = model.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(part.num_columns)), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=[*part.schema.names, "lang_pred", "lang_score"])
    return run


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """Rows with a text column, and lang_pred and lang_score beside what they hold; only the text is read."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    return documents.mapInArrow(_predict(model), f"{fields}, lang_pred string, lang_score double")


def accepted(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents with a language the model is sure of, all columns as they were."""
    rows = documents.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    return identify(rows, model).filter((F.col("lang_pred") != UND) & (F.col("lang_score") >= least)).select("row.*")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicts the language of all documents from the other two thirds of the folds."""
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    fold = crc_fold("doc_id", 3)
    model = train(documents.filter(fold != 1))
    given = documents.select("doc_id", (fold == 1).alias("held_out"), F.col("text").cast("string").alias("text"))
    return identify(given, model).select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))
