"""Phrase collocation mining by Toivonen's sampling method.

A sample of the pieces proposes: phrases that are frequent in it, at a lowered
threshold, length by length.  A pass over all texts then counts what was proposed
together with its negative border: every phrase that was not proposed but whose two
parts (without its last, without its first word) were; at length one, every other
word.  A border phrase that turns out frequent breaks the proposal: an expansion pass
counts the phrases that it newly makes possible, and, as their counts are not known
yet, also the longer ones that these would make possible.  That closes it: by
induction on the length, every frequent phrase has been counted, as its parts are
frequent or were counted in the same pass, whatever the sample was.

Passes count by 64-bit hashes; which phrases a task sends is decided by a bitmap of at
most ``BITMAP`` bits, the only thing broadcast.  Two phrases with one hash and false
members of the bitmap can only add phrases to count.  So a last pass sends the words
of all phrases whose hash is frequent, and counts are summed by language and phrase:
these are exact.  Texts are read in blocks of about ``BLOCK`` bytes (longer texts are cut
between pieces), and each block counts its phrases before it sends them, so a frequent
phrase costs a row a block.

Defined results.  A null text is empty; a null language is ``und`` and one with a
language of that name.  Rows that are the same count each.  No rows, or no frequent
phrase, give no rows.  Other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.llm.common import shared_table, table
from rivulet.llm.shingles import scramble, span_hashes

#: Words of the longest phrase, occurrences of a frequent one, percent of a phrase's
#: occurrences at which a longer one replaces it, phrases listed a language.
LONGEST = 5
SUPPORT = 100
COVERED = 100
LISTED = 2000
#: One piece in SAMPLE proposes; a phrase is proposed from this many standard deviations below the threshold.
SAMPLE = 8
MARGIN = 2.0
#: Most bits of a membership bitmap; bytes of text that are looked at together.
BITMAP = 1 << 28
BLOCK = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0: part of a word, 1: between words, 2: between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_END = re.compile(rb"[.,;:!?\x0A-\x0D]")


class Members:
    """A set of 64-bit hashes as a bitmap; may hold more than was put in."""

    def __init__(self, bits: bytes):
        self.bits = np.frombuffer(bits, np.uint8)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.bits):
            return np.zeros(len(hashes), bool)
        at = hashes & np.uint64(8 * len(self.bits) - 1)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def members(hashes: DataFrame) -> bytes:
    """Bitmap of a column ``h``: 16 bits a hash, up to BITMAP bits, made in slices by tasks."""
    count = hashes.count()
    if not count:
        return b""
    size = min(BITMAP, 1 << max(16, (16 * count - 1).bit_length()))
    width = min(size, 1 << 20)

    def fill(batches):
        slices: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) & np.uint64(size - 1)
            part = (at // np.uint64(width)).astype(np.int64)
            for p in np.unique(part):
                bits = slices.setdefault(int(p), np.zeros(width, bool))
                bits[(at[part == p] % np.uint64(width)).astype(np.int64)] = True
        yield pa.RecordBatch.from_pydict({"part": pa.array(list(slices), pa.int64()), "bits": pa.array(
            [np.packbits(b, bitorder="little").tobytes() for b in slices.values()], pa.binary())})
    rows = hashes.withColumn("part", F.expr(f"(h & {size - 1}L) div {width}L")).repartition("part").select("h")
    out = np.zeros(size // 8, np.uint8)
    for row in rows.mapInArrow(fill, "part long, bits binary").collect():  # at most BITMAP bits in all
        begin = row["part"] * (width // 8)
        out[begin:begin + width // 8] |= np.frombuffer(row["bits"], np.uint8)
    return out.tobytes()


# ---------------------------------------------------------------- phrases of a block

class Block:
    """Words of some texts: ``code`` (which different (language, word)) and ``piece`` of each, in order."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        kind = _KIND[data]
        edge = np.diff((kind == 0).astype(np.int8), prepend=0, append=0)
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[begin]
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.langs, lang = np.unique(np.array(langs, object), return_inverse=True)
        lang = np.repeat(lang, np.diff(np.searchsorted(begin, starts)))
        letters, offsets = _LOWER[data[kind == 0]], np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        _, at, letters_ = coded.dictionary.buffers()
        at = np.frombuffer(at, np.int64)[:len(coded.dictionary) + 1] if len(begin) else np.zeros(1, np.int64)
        words = span_hashes(np.frombuffer(letters_, np.uint8)[:at[-1]] if at[-1] else np.zeros(0, np.uint8), at[:-1], at[1:])
        pair = lang * max(1, len(words)) + coded.indices.to_numpy()
        there = np.zeros(len(self.langs) * max(1, len(words)), bool)
        there[pair] = True
        self.code = (np.cumsum(there) - 1)[pair]
        self.lang_of, word_of = np.divmod(np.flatnonzero(there), max(1, len(words)))
        names = np.array([xxhash.xxh3_64_intdigest(n.encode(), 1) for n in self.langs], np.uint64)
        self.hash = scramble(words[word_of] + names[self.lang_of] * _MIX) if len(words) else words
        self._letters, self._lengths = letters, end - begin

    def phrases_at(self, places: np.ndarray, k: int) -> pa.Array:
        """The k words at each place, one space between them."""
        ends = np.cumsum(self._lengths + 1)
        joined = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
        inside = np.ones(len(joined), bool)
        inside[ends - 1] = False
        joined[inside] = self._letters
        whole, begin, end = joined.tobytes(), (ends - self._lengths - 1)[places].tolist(), (ends - 1)[places + k - 1].tolist()
        return pa.array([whole[a:b] for a, b in zip(begin, end)], pa.binary()).cast(pa.string())

    def langs_at(self, places: np.ndarray) -> pa.Array:
        return pa.array(self.langs[self.lang_of[self.code[places]]].tolist(), pa.string())


def phrases(block: Block, known: Members, counted: Members | None, longest: int, expand: bool = False):
    """For each length k: hashes of the block's different phrases, their counts, their first places, and which are new.

    A phrase of several words is looked at if both its parts are ``known``; it is new
    unless it was also looked at with ``counted`` in the place of known.  All words are
    looked at, and new if counted is None.  ``expand``: new phrases pass for known ones.
    """
    n, ids, hashes = len(block.code), block.code, block.hash
    places = np.arange(n)
    old = np.full(len(hashes), counted is not None)
    for k in range(1, longest + 1):
        marked = (hashes << np.uint64(3)) | np.uint64(k)
        first = np.zeros(len(hashes), np.int64)
        codes = ids[places]
        first[codes[::-1]] = places[::-1]
        yield k, marked, np.bincount(codes, minlength=len(hashes)), first, ~old
        if k == longest or not len(places):
            return
        good = known(marked) | ~old if expand else known(marked)
        before = old & counted(marked) if counted is not None else old
        # Places of two phrases that follow each other inside a piece.
        here = places[(places + k < n) & good[codes]]
        here = here[block.piece[here] == block.piece[here + k]]
        here = here[ids[here + 1] >= 0]
        here = here[good[ids[here + 1]]]
        coded = pa.array(ids[here] * np.int64(max(1, len(hashes))) + ids[here + 1]).dictionary_encode()
        left, right = np.divmod(coded.dictionary.to_numpy(), np.int64(max(1, len(hashes))))
        ids = np.full(n, -1, np.int64)
        ids[here] = coded.indices.to_numpy()
        old = before[left] & before[right]
        hashes = scramble(hashes[left] * _MIX + hashes[right]) if len(left) else hashes[:0]
        places = here


def cut(text: bytes, size: int):
    """A text in parts of about ``size`` bytes, cut between pieces."""
    while len(text) > size and (end := _END.search(text, size)):
        yield text[:end.end()]
        text = text[end.end():]
    yield text


def blocks(batches, size: int = BLOCK):
    """Blocks of about ``size`` bytes of rows (text, lang)."""
    texts, langs, held = [], [], 0
    for batch in batches:
        for whole, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for text in cut(whole, size):
                texts.append(text)
                langs.append(lang)
                held += len(text)
                if held >= size:
                    yield Block(texts, langs)
                    texts, langs, held = [], [], 0
    if texts:
        yield Block(texts, langs)


# ---------------------------------------------------------------- passes

def frequent(spark: SparkSession, texts: DataFrame, proposal: DataFrame | None, least: int, longest: int) -> DataFrame:
    """Hashes ``h`` of all phrases with ``least`` occurrences in ``texts`` (perhaps of a few others), a phrase's length in the low bits.

    With a proposal: a pass over it and its border, and one more if the border has
    frequent phrases.  Without one, a pass a length, each proposed by those before.
    """
    context = spark.sparkContext
    known, past, found = proposal, None, None
    bits = context.broadcast(members(known) if known is not None else b"")
    while True:
        expand = proposal is not None and past is not None

        def count(batches, bits=bits, past=past, expand=expand):
            now, before = Members(bits.value), Members(past.value) if past is not None else None
            for block in blocks(batches):
                each = [(h[new], c[new]) for _, h, c, _, new in phrases(block, now, before, longest, expand)]
                hashes, counts = (np.concatenate(x) for x in zip(*each))
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))], names=["h", "c"])
        rows = texts.mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).filter(F.col("c") >= least)
        new = shared_table(spark, rows.select("h"), "phrases-found")
        found = new if found is None else shared_table(spark, found.unionByName(new).distinct(), "phrases-known", free=False)
        # Frequent phrases that were not proposed, and can be part of a longer one.
        border = new.filter(F.col("h").bitwiseAND(7) < longest)
        if known is not None:
            border = border.join(known, "h", "left_anti")
        if past is not None:
            past.destroy()
        if expand or border.isEmpty():
            bits.destroy()
            return found
        known, bits, past = found, context.broadcast(members(found)), bits


def sampled(texts: DataFrame, share: int) -> DataFrame:
    """(text, lang): of each text about one piece in ``share``."""
    def pick(batches):
        for batch in batches:
            out, langs = [], []
            for i, (text, lang) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                data = np.frombuffer(text, np.uint8)
                ends = np.flatnonzero(_KIND[data] == 2)
                begin, end = np.concatenate([[0], ends + 1]), np.concatenate([ends, [len(data)]])
                seed = np.uint64(xxhash.xxh3_64_intdigest(text, i))
                chosen = np.flatnonzero(scramble(seed + np.arange(len(begin), dtype=np.uint64) * _MIX) % np.uint64(share) == 0)
                if len(chosen):
                    out.append(b"\n".join(text[begin[j]:end[j]] for j in chosen))
                    langs.append(lang)
            yield pa.RecordBatch.from_pydict({"text": pa.array(out, pa.binary()), "lang": pa.array(langs, pa.string())})
    return texts.mapInArrow(pick, "text binary, lang string")


COUNTED = "lang string, phrase string, k int, f long"


def _counted(lang: pa.Array, phrase: pa.Array, k: int, f: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang, phrase, pa.array(np.full(len(f), k, np.int32)), pa.array(f.astype(np.int64))], names=["lang", "phrase", "k", "f"])


def exact_counts(spark: SparkSession, texts: DataFrame, hashes: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, k, f) of all phrases whose hash is among ``hashes``; k = 0: all words of the language."""
    bits = spark.sparkContext.broadcast(members(hashes))

    def count(batches):
        known = Members(bits.value)
        for block in blocks(batches):
            for k, h, counts, first, _ in phrases(block, known, None, longest):
                if k == 1:
                    totals = np.bincount(block.lang_of, counts, len(block.langs)).astype(np.int64)
                    yield _counted(pa.array(block.langs.tolist(), pa.string()), pa.array([""] * len(totals)), 0, totals)
                keep = np.flatnonzero(known(h))
                places = first[keep]
                yield _counted(block.langs_at(places), block.phrases_at(places, k), k, counts[keep])
    return texts.mapInArrow(count, COUNTED).groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f"))


def mined(spark: SparkSession, docs: DataFrame, least: int = SUPPORT, longest: int = LONGEST, share: int = SAMPLE,
          margin: float = MARGIN) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases (lang, phrase, k, f) of 1 to ``longest`` words, and (lang, n), all words of each language."""
    texts = docs.select(F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
                        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    mean = least / share
    lowered = max(1, int(mean - margin * (mean * (1 - 1 / share)) ** 0.5))
    proposal = frequent(spark, shared_table(spark, sampled(texts, share), "phrases-sample"), None, lowered, longest)
    found = frequent(spark, texts, shared_table(spark, proposal, "phrases-proposed", free=False), least, longest)
    counts = shared_table(spark, exact_counts(spark, texts, found, longest).filter((F.col("f") >= least) | (F.col("k") == 0)), "phrases-counts")
    return counts.filter("k > 0"), counts.filter("k = 0").select("lang", F.col("f").alias("n"))


# ---------------------------------------------------------------- scores

def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, k, a, l, r, n, score) of phrases of several words, by their worst cut."""
    words = F.split("phrase", " ")
    long = counts.filter("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    long = long.select("*", F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ").alias("first"),
                       F.array_join(F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("rest"))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = long.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    # Whole numbers of 38 digits: 1000 a n and l r stay below for counts under 10 ** 17.
    score = F.expr("(1000 * cast(a as decimal(17, 0)) * cast(n as decimal(17, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    worst = both.groupBy("lang", "phrase", "k", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("w"))
    return worst.select("lang", "phrase", "k", "a", "w.l", "w.r", "n", "w.score")


def uncovered(counts: DataFrame, found: DataFrame, covered: int = COVERED) -> DataFrame:
    """``found`` without phrases inside a longer frequent one with ``covered`` percent of their occurrences.

    One more word is enough to look at: phrases between the two have as many.
    """
    words, k = F.split("phrase", " "), F.col("k")
    parts = F.array(F.array_join(F.slice(words, F.lit(1), k - 1), " "), F.array_join(F.slice(words, F.lit(2), k - 1), " "))
    longer = counts.filter("k > 2").select("lang", F.explode(parts).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    return (found.join(longer, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered)).drop("longer"))


def best(found: DataFrame, listed: int = LISTED, salts: int = 64) -> DataFrame:
    """The first ``listed`` of each language with their rank: first those of each salt, then of the language."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = (found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
              .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= listed))
    return (salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .filter(F.col("rank") <= listed).drop("salt"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-bound phrases of each language of ``documents``."""
    counts, totals = mined(spark, table(spark, sf_dir, "documents", "text", "lang"))
    return best(uncovered(counts, scored(counts, totals))).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


# ---------------------------------------------------------------- the same in SQL

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE_SQL = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?
-
]')) as piece
  from documents),
words as (select lang, regexp_extract_all(piece, '[^ 	]+') as w from pieces),
totals as (select lang, sum(len(w))::bigint as n from words group by lang),
spots as (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from words, unnest(range(1, {LONGEST + 1})) as t(k)),
counts as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, any_value(w[i:i + k - 1]) as w, count(*) as f from spots group by all having count(*) >= {SUPPORT}),
cuts as (
  select c.lang, c.phrase, c.f as a, cut, x.f as l, y.f as r, n, (1000 * c.f::hugeint * n) // (x.f::hugeint * y.f) as score
  from (select *, unnest(range(1, k)) as cut from counts where k > 1) c
  join counts x on x.lang = c.lang and x.phrase = array_to_string(c.w[:cut], ' ')
  join counts y on y.lang = c.lang and y.phrase = array_to_string(c.w[cut + 1:], ' ')
  join totals t on t.lang = c.lang),
worst as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inner_ as (
  select lang, array_to_string(w[i:i + m - 1], ' ') as phrase, max(f) as f
  from (select lang, w, f, k, m, unnest(range(1, k - m + 2)) as i from counts, unnest(range(2, {LONGEST})) as t(m) where m < k) group by all)
select * from (
  select w.lang, row_number() over (partition by w.lang order by score desc, a desc, w.phrase) as rank, w.phrase, a, l, r, n, score::bigint as score
  from worst w left join inner_ i on i.lang = w.lang and i.phrase = w.phrase where i.f is null or 100 * i.f < {COVERED} * a)
where rank <= {LISTED}"""
