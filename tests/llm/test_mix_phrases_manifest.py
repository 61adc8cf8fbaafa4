"""Mixing, phrase mining and the Merkle manifest against SQL and brute force, odd inputs included."""
import random
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import collocations, merkle, mixing

DDL = "doc_id long, source string, lang string, n_chars long, text string, tree string, no long, print string, idx long, h string"


def odd_rows():
    """Nulls, empty and long texts, repeats, several texts of one id, columns with clashing names."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(12)] + ["São", "ßa", "日本", "A", "a"]
    some = [" ".join(rnd.choices(words, k=rnd.randint(0, 40))) + rnd.choice([".", "!", "", "\n"]) for _ in range(60)]
    rows = [(i, f"s{i % 4}", ["en", "de", None, ""][i % 7 % 4], len(t), t) for i, t in enumerate(some)]
    rows += [(3, "s1", "en", 1, "one id another text"), (None, None, None, None, None), (None, "s0", "en", 5, "no id"),
             (None, "s0", "en", 5, "no id"), (100, None, "und", 0, ""), (101, "é", "en", 9, " \t\r\n\x0b\x0c "),
             (102, "s2", "en", 30, "EXACT copy of a Row, of a Row"), (103, "big", "fr", 300_000, "long text. Long word " * 15_000),
             (104, "s0", "en", 20_000, "x" * 20_000)]
    rows += [(7, "s3", "en", 11, "many times over")] * 30
    return [r + ("t", 1, "p", 2, "h") for r in rows]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return write(spark, odd_rows(), tmp_path_factory.mktemp("odd"))


def write(spark, rows, folder):
    spark.createDataFrame(rows, DDL).repartition(5).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def sql_rows(folder, sql, columns):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(columns)
    at = [names.index(c) for c in columns]
    return sorted(tuple(str(r[i]) for i in at) for r in result.fetchall())


def rows_of(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


QUERIES = {"op11": (mixing.op11_mix_sources, mixing.ORACLE_SQL), "op12": (collocations.op12_collocations, collocations.ORACLE_SQL),
           "op13": (merkle.op13_merkle_manifest, merkle.ORACLE_SQL)}


@pytest.mark.parametrize("name", QUERIES)
def test_queries_equal_their_sql(spark, small, oracle, odd, name):
    query, sql = QUERIES[name]
    df = query(spark, small)
    assert rows_of(df) == oracle(sql, df.columns)
    df = query(spark, odd)
    assert rows_of(df) == sql_rows(odd, sql, df.columns)


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, tmp_path, name):
    spark.createDataFrame([], DDL).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES[name][0](spark, str(tmp_path)).collect() == []


def test_a_table_without_words(spark, tmp_path):
    folder = write(spark, [(1, "a", "en", 0, "", "", 0, "", 0, ""), (2, None, None, None, None, "", 0, "", 0, "")], tmp_path)
    assert [(r["doc_id"], r["target"], r["taken"]) for r in mixing.op11_mix_sources(spark, folder).orderBy("doc_id").collect()] == [(1, 0.0, 0), (2, 0.0, 0)]
    assert collocations.op12_collocations(spark, folder).collect() == []
    assert merkle.op13_merkle_manifest(spark, folder).count() == 2


# -- mixing --

def by_rounds(words, weights=(5, 2, 1), share=Fraction(3, 2), most=2):
    """Targets as told: shares by weight, the excess of those above their bound dealt again."""
    names = sorted((n for n in words if n is not None), key=lambda n: n) + ([None] if None in words else [])
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    target, open_ = dict.fromkeys(names, Fraction(0)), set(names)
    rest = share * sum(words.values())
    while rest and open_:
        whole = sum(weight[n] for n in open_)
        for n in open_:
            target[n] += rest * weight[n] / whole
        over = {n for n in open_ if target[n] > most * words[n]}
        rest = sum(target[n] - most * words[n] for n in over)
        for n in over:
            target[n] = Fraction(most * words[n])
        open_ -= over
    return target


@pytest.mark.parametrize("block, shard", [(8, 16), (100_000, 4)])
def test_mix_of_small_blocks(spark, odd, block, shard):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    mix = mixing.Mix(spark, docs, block=block, shard=shard)
    df = mix.taken().cache()
    rows = df.collect()
    assert rows_of(df) == sql_rows(odd, mixing._sql(block, shard), df.columns)
    words = Counter()
    for r in rows:
        words[r["source"]] += r["size"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    want, got = by_rounds(words), Counter()
    for r in rows:
        got[r["source"]] += r["taken"]
        assert r["source_size"] == words[r["source"]] and r["target"] == pytest.approx(float(want[r["source"]]))
    assert all(0 <= want[s] - got[s] < 1 + 1e-9 for s in words)
    # Slots: whole shards without gaps; each slot has one source.
    slots = mix.slots.select("shard", "slot", "no").collect()
    total = len(slots)
    assert sorted((r["shard"], r["slot"]) for r in slots) == [(i // shard, i % shard) for i in range(total)]


def test_texts_of_the_mix(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    mix = mixing.Mix(spark, docs, block=16, shard=32)
    texts, taken = mix.texts().collect(), mix.taken()
    assert sum(len(r["text"].split(" ")) for r in texts) == taken.agg(F.sum("taken")).first()[0]
    per = {(r["source"], w) for r in docs.collect() for w in (r["text"] or "").split()}
    assert all((r["source"], w) in per for r in texts for w in r["text"].split(" "))
    # A source taken twice in whole has each word twice.
    twice = {r["source"] for r in taken.collect() if r["target"] == 2 * r["source_size"]}
    assert twice
    for source in twice:
        want = Counter(w for r in docs.collect() if r["source"] == source for w in (r["text"] or "").split())
        got = Counter(w for r in texts if r["source"] == source for w in r["text"].split(" "))
        assert got == Counter({w: 2 * c for w, c in want.items()})


def test_shards_draw_their_counts(spark):
    """Counts of a shard scatter about their means as a multinomial does; totals are exact."""
    plan = spark.createDataFrame([(0, 6000), (1, 3000), (2, 1000)], "no long, slots long")
    rows = mixing.shard_counts(spark, plan, 10_000, 100).collect()
    assert Counter({n: sum(r["count"] for r in rows if r["no"] == n) for n in (0, 1, 2)}) == Counter({0: 6000, 1: 3000, 2: 1000})
    first = np.array([next(r["count"] for r in rows if (r["shard"], r["no"]) == (s, 0)) for s in range(100)])
    assert abs(first.mean() - 60) < 1e-9 and 12 < first[:95].var() < 45     # 100 * 0.6 * 0.4 = 24
    assert all(sum(r["count"] for r in rows if r["shard"] == s) == 100 for s in range(100))


@pytest.mark.parametrize("n", [1, 2, 97])
def test_permutations(spark, n):
    keys = mixing.round_keys(F.lit(n).cast("long"), "t")
    got = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), keys, "t")).collect()]
    assert sorted(got) == list(range(n))
    if n > 9:
        assert got != sorted(got) and abs(np.corrcoef(got, range(n))[0, 1]) < 0.7


def test_running_totals_over_pieces(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("at"), (F.col("id") % 5).alias("v"))
    got = mixing.before(df, "v", "at", "past", "k").collect()
    past = Counter()
    for r in sorted(got, key=lambda r: r["at"]):
        assert r["past"] == past[r["k"]]
        past[r["k"]] += r["v"]


# -- phrases --

def counted(rows, longest, least):
    out = Counter()
    for text, lang in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for sep in ".,;:!?\n\x0b\x0c\r":
            low = low.replace(sep, "\n")
        for piece in low.split("\n"):
            words = piece.replace("\t", " ").split(" ")
            words = [w for w in words if w]
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    out[lang or "und" if lang is None else lang, " ".join(words[i:i + k]), k] += 1
    return {key: c for key, c in out.items() if c >= least}


@pytest.mark.parametrize("share", [4, 10 ** 9])
def test_mining_does_not_depend_on_the_sample(spark, share, monkeypatch):
    """A sample of everything, of a part and of nothing (all is found through border failures)."""
    rnd = random.Random(share)
    words = [f"w{i}" for i in range(9)]
    rows = [(" ".join(rnd.choices(words, weights=range(9, 0, -1), k=40)) + rnd.choice(". ") + "Big  Deal\tbig deal is here!", rnd.choice(["a", "b", None]))
            for _ in range(120)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    counts, totals = collocations.mined(spark, docs, least=25, share=share)
    assert {(r["lang"], r["phrase"], r["k"]): r["f"] for r in counts.collect()} == counted(rows, 5, 25)
    want = Counter()
    for (lang, _, k), c in counted(rows, 1, 1).items():
        want[lang] += c
    assert {r["lang"]: r["n"] for r in totals.collect()} == want


def test_false_members_change_nothing(spark, monkeypatch):
    rows = [("a b c d a b c e f", "x")] * 30 + [(f"q{i} r{i} s", "x") for i in range(200)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(collocations, "BITMAP", 8)      # nearly every hash seems to be a member
    counts, _ = collocations.mined(spark, docs, least=30)
    assert {(r["lang"], r["phrase"], r["k"]): r["f"] for r in counts.collect()} == counted(rows, 5, 30)


def test_long_texts_are_cut_between_pieces():
    text = b"one two three. " * 50 + b"x" * 500 + b" tail, end"
    parts = list(collocations.cut(text, 64))
    assert b"".join(parts) == text and all(p[-1:] in b".," for p in parts[:-1]) and max(map(len, parts)) < 600


def test_scores_of_more_than_64_bits(spark):
    big = 3 * 10 ** 12
    counts = spark.createDataFrame([("x", "p", 1, big), ("x", "q", 1, big + 1), ("x", "p q", 2, big - 7)], "lang string, phrase string, k int, f long")
    totals = spark.createDataFrame([("x", 10 ** 14)], "lang string, n long")
    row = collocations.scored(counts, totals).first()
    assert row["score"] == 1000 * (big - 7) * 10 ** 14 // (big * (big + 1))


def test_listed_first(spark):
    rows = [("x", f"p{i} q", 2, 100 + i % 3, i % 5) for i in range(500)]
    found = spark.createDataFrame(rows, "lang string, phrase string, k int, a long, score long")
    got = [(r["rank"], r["phrase"]) for r in collocations.best(found, listed=40, salts=4).orderBy("rank").collect()]
    want = sorted(rows, key=lambda r: (-r[4], -r[3], r[1]))[:40]
    assert got == [(i + 1, r[1]) for i, r in enumerate(want)]


# -- manifest --

def postorder(n):
    """(level, idx) of the nodes of a tree of n leaves as an appender completes them."""
    out, h = [], merkle.height(n)

    def visit(level, idx):
        if level:
            below = -(-n // 8 ** (level - 1))
            for child in range(8 * idx, min(8 * idx + 8, below)):
                visit(level - 1, child)
        out.append((level, idx))
    visit(h, 0)
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 72, 73, 511, 512, 513, 520, 4097])
def test_positions_are_those_of_the_postorder(n):
    for position, (level, idx) in enumerate(postorder(n)):
        assert merkle.positions(level, np.array([idx]), n)[0] == position


def test_large_trees_and_many_languages(spark, tmp_path):
    """A language of more than 8**4 leaves, and more than 8**4 languages."""
    rows = [(i // 2 if i < 50 else i, "s", "en", i, f"Text {i}") for i in range(4500)]
    rows += [(10_000 + i, "s", f"l{i}", i, "T") for i in range(4200)]
    folder = write(spark, [r + ("", 0, "", 0, "") for r in rows], tmp_path)
    df = merkle.op13_merkle_manifest(spark, folder).cache()
    assert rows_of(df) == sql_rows(folder, merkle.ORACLE_SQL, df.columns)
    assert df.count() == len(rows) and df.select("root").distinct().count() == 1


def test_the_log_is_in_postorder_without_gaps(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, f"t{i}") for i in range(700)], "doc_id long, source string, lang string, n_chars long, text string")
    manifest = merkle.Manifest(spark, docs)
    log = manifest.logs[0].orderBy("position").collect()
    assert [(r["level"], r["idx"]) for r in log] == postorder(700) and [r["position"] for r in log] == list(range(len(log)))


def test_one_changed_letter_is_found(spark):
    ddl = "doc_id long, source string, lang string, n_chars long, text string"
    rows = [(i, "s", "en", 1, f"text {i}") for i in range(100)]
    whole = merkle.Manifest(spark, spark.createDataFrame(rows, ddl), F.lit(True))
    assert all(r["folded_root"] == whole.root.hex() for r in whole.proofs().collect())      # nothing to lower-case
    rows[37] = (37, "s", "en", 1, "Text 37")
    other = merkle.Manifest(spark, spark.createDataFrame(rows, ddl), F.lit(True))
    assert other.root != whole.root
    assert [r["doc_id"] for r in other.proofs().collect() if r["folded_root"] != other.root.hex()] == [37]
