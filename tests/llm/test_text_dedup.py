"""Suffix dedup and near-dedup against SQL and brute force, with odd inputs."""
import hashlib
import random

import numpy as np
import pytest

from rivulet.llm import near_dedup, suffix_dedup
from rivulet.llm.common import id_text, told_apart
from rivulet.llm.components import components
from rivulet.llm.queries import ORACLE_SQL, QUERIES
from rivulet.llm.shingles import sequences, shingle_set, word_hashes

DOCS = "doc_id long, text string, kind string, start int, bucket int"


def brute_cut(docs):
    """(n_bytes, n_removed, n_spans, sha256) by doc_id, by a dictionary of all strings."""
    first = {}
    for doc_id, text in sorted((d, (t or "").encode()) for d, t in docs):
        for s in range(len(text) - 99):
            first.setdefault(text[s:s + 100], (doc_id, s))
    out = {}
    for doc_id, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - 99):
            if first[data[s:s + 100]] < (doc_id, s):
                gone[s:s + 100] = True
        kept = bytes(np.frombuffer(data, np.uint8)[~gone]) if data else b""
        spans = int(np.sum(np.diff(np.r_[False, gone].astype(int)) == 1))
        out[doc_id] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def odd_docs(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, base = prose(60), prose(300)
    docs = [(i, prose(rng.randrange(1, 80))) for i in range(40)]
    docs += [(100 + i, prose(20) + passage + prose(20)) for i in range(15)]
    docs += [(200 + i, base if i % 2 else base[:400] + "x" + base[400:]) for i in range(8)]
    docs += [(300, "a" * 500), (301, "ab" * 300), (302, "Shti " * 200), (303, None), (304, ""), (305, "é" * 99), (306, "x" * 99)]
    docs += [(400, prose(30_000)), (401, "ab" * 150 + "a" * 120)]
    return docs


@pytest.mark.parametrize("wide", [suffix_dedup.WIDE, 3])
def test_cut_equals_brute_force(spark, wide):
    docs = odd_docs()
    frame = spark.createDataFrame([(d, t, "k", 7, 9) for d, t in docs], DOCS)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in suffix_dedup.remove_repeats(spark, frame, wide=wide, rest=("kind", "start")).collect()}
    assert got == brute_cut(docs)


def test_piecewise_runs_find_the_same_repeats(spark, monkeypatch):
    docs = [(d, t) for d, t in odd_docs(2) if d != 400]
    monkeypatch.setattr(suffix_dedup, "PIECE", 333)
    found = [suffix_dedup.runs(np.frombuffer(t.encode(), np.uint8)) for _, t in docs if t and len(t.encode()) >= 100]
    assert all((c > 0).all() and (np.diff(s) > 0).all() and int(c.sum()) == s[-1] + c[-1] for _, _, s, c in found)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = "one two three " * 30
    frame = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], "doc_id long, text string")
    rows = suffix_dedup.remove_repeats(spark, frame).collect()
    kept = {r["doc_id"]: r["n_removed"] for r in rows}
    assert len(rows) == 4 and None in kept
    # The null id comes first, so only what it repeats itself goes there.
    assert kept[1] == kept[2] == len(text) and kept[None] < len(text)
    assert suffix_dedup.remove_repeats(spark, frame.limit(0)).count() == 0


@pytest.mark.parametrize("wide", [suffix_dedup.WIDE, 3])
def test_repeated_rows_open_nothing_more(spark, wide):
    """Copies of one row, null ids too: the same runs and fragments as from one row of each, and the same cuts."""
    rng = random.Random(4)
    prose = lambda n: " ".join(str(rng.random()) for _ in range(n))
    passage = prose(30)
    texts = [(d, f"{prose(15)} {passage} {prose(15)} {passage[:300]}") for d in (1, 2, 3, None, None)]
    sizes, cuts = [], set()
    for copies in (1, 20, 80):
        rows = texts + [texts[0], texts[3]] * (copies - 1)
        rng.shuffle(rows)
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
        docs = told_apart(spark, id_text(frame))
        found, fragments = suffix_dedup._open_contexts(spark, docs, wide)
        fragments = fragments.filter("bytes IS NOT NULL").select("bucket", "part", "doc_id", "copy", "start")
        sizes.append((found.count(), fragments.count()))
        cuts.add(tuple(sorted({(str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["kept_sha256"])
                               for r in suffix_dedup.remove_repeats(spark, frame, wide=wide).collect()})))
    # A run may be settled in its batch and again in its class; a text stands in each of the eight tasks at most.
    assert len(cuts) == 1
    assert all(0 < found <= 2 * sizes[0][0] and fragments <= 8 * sizes[0][1] for found, fragments in sizes), sizes
    assert sizes[2][0] <= 2 * sizes[1][0] and sizes[2][1] <= 2 * sizes[1][1], sizes


def test_suffix_query_equals_sql(spark, small, oracle):
    df = QUERIES["op1_suffix_dedup"](spark, small)
    assert sorted(tuple(str(x) for x in r) for r in df.collect()) == oracle(ORACLE_SQL["op1_suffix_dedup"], df.columns)


def test_refine_sorts_to_full_depth():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1500:1700] = data[100:300]
    ends = len(data) - np.arange(len(data))
    suffixes = np.arange(len(data) - 99)
    ids = suffix_dedup.refine(data, suffixes, ends)
    strings = [bytes(data[s:s + 100]) for s in suffixes]
    assert len(set(ids.tolist())) == len(set(strings))
    order = np.argsort(ids, kind="stable")
    assert [strings[i] for i in order] == sorted(strings)


# -- near duplicates --

def jaccard_components(docs, words, percent):
    sets = {}
    for d, t in docs:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w)} if 0 < len(w) < words else {tuple(w[i:i + words]) for i in range(len(w) - words + 1)}
    label = {d: d for d in sets}
    names = sorted(sets)
    changed = True
    links = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {d: (len(sets[d]), label[d]) for d in sets}


def mutated(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10 ** 6)}"
    return " ".join(words)


def near_docs(seed=4):
    rng = random.Random(seed)
    docs, n = [], 0
    for _ in range(12):
        base = [f"b{rng.randrange(400)}" for _ in range(rng.randrange(40, 160))]
        for _ in range(rng.randrange(1, 25)):
            docs.append((n, mutated(rng, base, rng.randrange(0, 6))))
            n += 1
    docs += [(1000 + i, " ".join(f"u{rng.randrange(10 ** 5)}" for _ in range(50)) + " all rights reserved by them here") for i in range(60)]
    docs += [(2000, None), (2001, ""), (2002, "  \t"), (2003, "two words"), (2004, "TWO  words"), (2005, "one"), (2006, docs[0][1].upper())]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("leaf", [near_dedup.LEAF, 8])
def test_components_equal_brute_force(spark, monkeypatch, leaf):
    docs = near_docs()
    monkeypatch.setattr(near_dedup.links, "__defaults__", (leaf,))
    frame = spark.createDataFrame([(d, t, "n", 1) for d, t in docs], "doc_id long, text string, node string, rep int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(spark, frame, words=4).collect()}
    assert got == jaccard_components(docs, 4, 80)


def test_near_query_equals_sql(spark, small, oracle):
    df = QUERIES["op6_near_dedup"](spark, small)
    got = sorted(tuple(str(x) for x in r) for r in df.collect())
    assert got == oracle(ORACLE_SQL["op6_near_dedup"], df.columns)


def test_near_empty_and_repeated_rows(spark):
    frame = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, None)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in near_dedup.near_duplicates(spark, frame).collect())
    assert got == [("5", "None", False), ("5", "None", False), ("7", "7", True), ("None", "None", True)]
    assert near_dedup.near_duplicates(spark, frame.limit(0)).count() == 0


def test_repeated_rows_are_compared_once(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f h")]
    members = spark.createDataFrame([(7, 1), (7, 2), (8, 2)], "key long, rep long")
    for copies in (1, 200):
        docs = spark.createDataFrame(rows + rows[:1] * copies, "key long, text string").repartition(8)
        assert sorted((r["key"], r["rep"]) for r in near_dedup._texts_of(docs, members).collect()) == [(7, 1), (7, 2), (8, 2)]


def test_similar_forest_connects_what_links_connect():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 60, 100, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, 100 - k, replace=False), rng.integers(0, 1 << 60, k, dtype=np.uint64)]))
            for k in rng.integers(0, 20, 60)]
    exact = [(x, y) for y in range(60) for x in range(y) if 100 * len(np.intersect1d(sets[x], sets[y])) >= 80 * len(np.union1d(sets[x], sets[y]))]
    found = near_dedup.similar_forest(sets, 80)
    assert set(found) <= set(exact) and len(found) < 60

    def roots(edges):
        label = list(range(60))
        for _ in range(60):
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        return label
    assert roots(found) == roots(exact)


def test_star_contraction_on_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901), (901, 900), (5, 5)], "a long, b long")
    got = {r["vertex"]: r["root"] for r in components(spark, edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 901: 900}
    assert components(spark, edges.limit(0)).count() == 0


def test_word_hashes_fold_case_and_split_on_ascii_space():
    a = word_hashes(np.frombuffer("The  quick\tÉté\x0bend".encode(), np.uint8))
    b = word_hashes(np.frombuffer(b"the quick", np.uint8))
    assert len(a) == 4 and a[0] == b[0] and a[1] == b[1]
    assert len(shingle_set(b"", 4)) == 0 and len(sequences(a, 9)) == 1


# -- different texts of one doc_id --

def several_texts(seed=9):
    rng = random.Random(seed)
    prose = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    passage, base = prose(30), prose(120).split()
    texts = [prose(10) + " " + passage + " " + prose(40), prose(60) + " " + prose(40), prose(10) + " " + passage + " " + prose(20)]
    near = [" ".join(base), " ".join(base[:-1] + ["other"]), " ".join(["another"] + base[1:])]
    return texts, near


@pytest.mark.parametrize("wide", [suffix_dedup.WIDE, 0])
@pytest.mark.parametrize("name", [None, 5])
def test_texts_of_one_id_are_cut_each_by_their_own_repeats(spark, name, wide):
    texts, _ = several_texts()
    frame = spark.createDataFrame([(name, t) for t in texts] + [(9, texts[0])], "doc_id long, text string")
    got = {(r["doc_id"], r["n_bytes"]): r for r in suffix_dedup.remove_repeats(spark, frame, wide=wide).collect()}
    assert len(got) == 4
    clean = got[(name, len(texts[1]))]
    assert clean["n_removed"] == 0 and clean["text"] == texts[1]
    # One of the two texts with the passage loses it, whichever comes first by hash; a later doc_id loses all.
    assert got[(9, len(texts[0]))]["n_removed"] == len(texts[0])
    lost = sorted(got[(name, len(t))]["n_removed"] for t in (texts[0], texts[2]))
    common = max(n for n in range(len(texts[0])) if any(texts[0][a:a + n] in texts[2] for a in range(len(texts[0]) - n + 1)))
    assert lost == [0, common]


@pytest.mark.parametrize("name", [None, 5])
def test_near_copies_of_one_id_are_linked(spark, name):
    import corpus_pipeline

    texts, near = several_texts()
    frame = spark.createDataFrame([(name, t) for t in texts + near] + [(9, near[0]), (3, None)], "doc_id long, text string")
    rows = near_dedup.near_duplicates(spark, frame).collect()
    assert len(rows) == 8 and sum(r["kept"] for r in rows) == 5
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] == 9] == [(name, False)]
    left = [r["text"] for r in corpus_pipeline.near_dedup_stage(spark, frame, "").collect()]
    assert sorted(t or "" for t in left if t not in near) == sorted(["", *texts]) and sum(t in near for t in left) == 1


def test_a_wide_string_sends_a_row_a_block():
    import pyarrow as pa

    rng = random.Random(11)
    line = bytes(rng.choice(b"abcdefgh") for _ in range(120))
    texts = [bytes(rng.choice(b"abcdefgh") for _ in range(50)) + line for _ in range(300)]
    opened = [[{"bucket": 7, "contexts": 9, "start": 40, "count": 31}]] * len(texts)
    kinds = pa.list_(pa.struct([("bucket", pa.int64()), ("contexts", pa.int64()), ("start", pa.int32()), ("count", pa.int32())]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array([0] * 300, pa.int64()), pa.array(texts, pa.binary()),
                                        pa.array(opened, kinds)], names=["doc_id", "copy", "text", "open"])
    rows = [r for b in suffix_dedup._fragments(3)([batch.slice(0, 150), batch.slice(150)]) for r in b.to_pylist()]
    keys = [(r["bucket"], r["part"]) for r in rows if r["bytes"] is not None]
    first = {}
    for d, text in enumerate(texts):
        for at in range(40, 71):
            first.setdefault(text[at:at + 100], (d, at))
    assert len(keys) == len(set(keys)) == len(first)
    # All other places leave as settled runs: a row for each document, not for each string.
    settled = [r for r in rows if r["bytes"] is None]
    assert {(r["doc_id"], at) for r in settled for at in range(r["start"], r["start"] + r["count"])} == {
        (d, at) for d, text in enumerate(texts) for at in range(40, 71) if first[text[at:at + 100]] != (d, at)}
    assert len(settled) == 299
