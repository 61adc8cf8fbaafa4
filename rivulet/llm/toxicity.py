"""Toxicity by a weighted finite-state pattern grammar over clauses.

A text is cut into clauses at punctuation.  Five transducers read a clause word
by word and are composed into one machine: insults and threats (weighted words
and word beginnings), targets, negation and reported speech.  The machine's state
remembers whether a negation is in reach, whether speech is being reported and
whether somebody has been addressed; a matched insult or threat leaves with its
weight, scaled by that state, so ``not an idiot`` or ``he said ...`` counts less
than an insult aimed at someone.  Clauses are scored, not words, and a text's
score comes from its matched clauses by logistic regression.

The weighted words are learned: for every word and word beginning of three to
six letters, the toxic and other training documents that hold it are counted
over all labelled rows; patterns that clearly lean towards toxic documents make
the lexicon (``LEXICON`` at most, the clearest first, as it is broadcast).  The
regression is fitted on at most ``FIT_ROWS`` labelled rows, picked by a hash of
their doc_id; both bounds are parameters of the classifier only.

Defined results: null text is empty; a text without a match gets the regression's
score for no match; without training labels of both kinds every score is the
share of toxic ones, 0 if there are none; label rows with a null take no part;
several labels of a doc_id teach once each; every row is returned, repeated ones
alike; a null doc_id counts as '' in the fold; an empty table gives no row; other
columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import crc_fold, id_text, restore_id, shared_table, table

LEXICON, FIT_ROWS = 4096, 200_000
#: Least toxic documents that hold a pattern, and its least log odds.
SUPPORT, LEAST_WEIGHT = 3, 1.0
BEGINNINGS = (3, 4, 5, 6)

# Words of the grammar in English, German, French and Spanish (own choice, fixed values).
THREATS = frozenset("kill hurt destroy beat punish töten schlagen vernichten tuer frapper détruire matar golpear destruir".split())
TARGETS = frozenset("you your yours they them their he she him her du dich dein ihr euch sie tu toi ton vous votre ils tú te ti tus usted ustedes ellos".split())
NEGATIONS = frozenset("not no never nobody without nicht kein keine nie ohne pas jamais non ni sans nunca sin".split())
REPORTS = frozenset("said says quoted claimed wrote called sagte sagt schrieb nannte dit écrit appelé dijo dice escribió llamó".split())

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.!?;:,\n|()\"]+")

#: Words a negation reaches.
REACH = 3


# -- transducers: (state, symbol) -> (state, factor); symbols are sets of word classes --

def negation(state: int, classes: frozenset) -> tuple[int, float]:
    """Counts down from a negation; what is matched meanwhile counts a quarter."""
    return (REACH if "negation" in classes else max(0, state - 1)), 0.25 if state else 1.0


def reported(state: int, classes: frozenset) -> tuple[int, float]:
    """After a verb of saying the rest of the clause counts half."""
    return int(state or "report" in classes), 0.5 if state else 1.0


def targeted(state: int, classes: frozenset) -> tuple[int, float]:
    """Once somebody is addressed, what is matched counts half as much again."""
    now = int(state or "target" in classes)
    return now, 1.5 if now else 1.0


def matched(state: int, classes: frozenset) -> tuple[int, float]:
    """Passes insults and threats on, blocks other words; a threat needs a verb's full form only."""
    return 0, float("insult" in classes) + 2.0 * float("threat" in classes)


def compose(*machines):
    """One machine over tuples of states: each machine scales what the one before lets out."""
    def run(states, classes):
        factor, after = 1.0, []
        for machine, state in zip(machines, states, strict=True):
            state, own = machine(state, classes)
            after.append(state)
            factor *= own
        return tuple(after), factor
    return run


def compiled(machine, start: tuple, alphabet: list[frozenset]) -> tuple[np.ndarray, np.ndarray]:
    """Tables (state, symbol) of next states and factors of all states in reach of ``start``."""
    names, todo, rows = {start: 0}, [start], []
    for state in todo:
        row = []
        for symbol in alphabet:
            after, factor = machine(state, symbol)
            if after not in names:
                names[after] = len(names)
                todo.append(after)
            row.append((names[after], factor))
        rows.append(row)
    table_ = np.array(rows)
    return table_[:, :, 0].astype(int), table_[:, :, 1]


CLASSES = ("insult", "threat", "target", "negation", "report")
ALPHABET = [frozenset(c for k, c in enumerate(CLASSES) if bits >> k & 1) for bits in range(1 << len(CLASSES))]
NEXT, FACTOR = compiled(compose(matched, negation, reported, targeted), (0, 0, 0, 0), ALPHABET)
_NEXT, _FACTOR = NEXT.tolist(), FACTOR.tolist()


class Grammar:
    """The composed machine with a lexicon of weighted patterns."""

    FEATURES = 6

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.words: dict[str, tuple[int, float]] = {}

    def __getstate__(self):
        return {"lexicon": self.lexicon, "words": {}}

    def read(self, word: str) -> tuple[int, float]:
        """Symbol of a word, and its weight."""
        found = self.words.get(word)
        if found is None:
            if len(self.words) > 300_000:
                self.words.clear()
            weight = max([self.lexicon.get(word, 0.0), *(self.lexicon.get(word[:k] + "*", 0.0) for k in BEGINNINGS if len(word) > k)])
            threat = word in THREATS
            symbol = ((weight > 0) | threat << 1 | (word in TARGETS) << 2 | (word in NEGATIONS) << 3 | (word in REPORTS) << 4)
            found = self.words[word] = (symbol, weight or (1.0 if threat else 0.0))
        return found

    def clause(self, words: list[tuple[int, float]]) -> float:
        """Score of one clause."""
        state, score = 0, 0.0
        for symbol, weight in words:
            factor = _FACTOR[state][symbol]
            state = _NEXT[state][symbol]
            score += factor * weight
        return score

    def features(self, text: str) -> list[float]:
        """Of the matched clauses: most and total score, their number and shares."""
        total, most, clauses, hits, words_seen = 0.0, 0.0, 0, 0, 0
        read = self.read
        for part in _CLAUSE.split(text.lower()):
            words = [read(w) for w in _WORD.findall(part)]
            if not words:
                continue
            clauses += 1
            words_seen += len(words)
            if any(s & 3 for s, _ in words):
                score = self.clause(words)
                total, most, hits = total + score, max(most, score), hits + 1
        return [np.log1p(total), most, np.log1p(hits), hits / max(1, clauses), total / max(1, words_seen), np.log1p(words_seen)]


def _patterns(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return words | {w[:k] + "*" for w in words for k in BEGINNINGS if len(w) > k}


def _count(batches):
    """Batches of (text, toxic) to (pattern, toxic documents, others); pattern '' counts all."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                for pattern in _patterns(text) | {""}:
                    seen.setdefault(pattern, [0, 0])[1 - toxic] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()),
                 pa.array([v[1] for v in seen.values()], pa.int64())], names=["pattern", "toxic", "other"])


def learn_lexicon(labelled: DataFrame, most: int = LEXICON) -> tuple[dict[str, float], int, int]:
    """Weighted patterns of (text, toxic), and the numbers of toxic and other documents."""
    counts = (labelled.mapInArrow(_count, "pattern string, toxic long, other long").groupBy("pattern")
              .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).filter(F.col("toxic") >= F.when(F.col("pattern") == "", 0).otherwise(SUPPORT)))
    # The row of all documents comes with the candidates, in one job; both are bounded.
    counts = counts.persist()
    try:
        everything = counts.filter("pattern = ''").first()
        toxic, other = (everything["toxic"], everything["other"]) if everything else (0, 0)
        if not toxic or not other:
            return {}, toxic, other
        odds = F.log((F.col("toxic") + 0.5) / (toxic - F.col("toxic") + 0.5)) - F.log((F.col("other") + 0.5) / (other - F.col("other") + 0.5))
        error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5))
        # Weight: log odds less two standard errors, so a lucky rare word weighs little.
        weight = odds - 2 * error
        rows = (counts.filter("pattern <> ''").select("pattern", weight.alias("weight")).filter(F.col("weight") >= LEAST_WEIGHT)
                .orderBy(F.desc("weight"), "pattern").limit(most).collect())
        return {r["pattern"]: float(r["weight"]) for r in rows}, toxic, other
    finally:
        counts.unpersist()


def fit(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the first coefficient is the intercept."""
    x = np.concatenate([np.ones((len(features), 1)), features], axis=1)
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - labels) + penalty * beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), gradient)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _features(grammar: Grammar):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                rows = [grammar.features(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "features"])
    return run


def score(spark: SparkSession, documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS,
          lexicon_size: int = LEXICON) -> DataFrame:
    """(doc_id, score) for each document; ``labels`` (doc_id, toxic) are those that may be learned from."""
    docs = id_text(documents)
    given = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        "doc_id IS NOT NULL AND toxic IN (0, 1)")
    # The join moves texts whatever the size of the labels: the same plan at every size.
    lexicon, toxic, other = learn_lexicon(docs.join(given.hint("merge"), "doc_id").select("text", "toxic"), lexicon_size)
    features = shared_table(spark, docs.mapInArrow(_features(Grammar(lexicon)), "doc_id long, features array<double>"), "features")
    share = toxic / max(1, toxic + other)
    if not lexicon:
        return features.select(restore_id(), F.lit(float(share)).alias("score"))
    chance = min(1.0, fit_rows / (toxic + other))
    picked = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(chance * (1 << 20))
    sample = features.join(given.filter(picked), "doc_id").select("doc_id", "features", "toxic").collect()
    sample.sort()
    x, y = np.array([r["features"] for r in sample]).reshape(-1, Grammar.FEATURES), np.array([r["toxic"] for r in sample], float)
    if len(sample) == 0 or y.min() == y.max():
        return features.select(restore_id(), F.lit(float(share)).alias("score"))
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    beta = fit((x - mean) / spread, y)
    slope = beta[1:] / spread
    logit = F.lit(float(beta[0] - slope @ mean))
    for k, b in enumerate(slope.tolist()):
        logit = logit + F.col("features")[k] * F.lit(b)
    return features.select(restore_id(), (1 / (1 + F.exp(-logit))).alias("score"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores all documents, learning from labels outside fold 0 of five."""
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    scored = score(spark, documents, labels.filter(crc_fold("doc_id", 5) != 0))
    return scored.select("doc_id", (crc_fold("doc_id", 5) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
