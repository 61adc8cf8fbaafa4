"""Language ID, language model, toxicity and neighbours: brute force, held-out quality, odd inputs."""
import collections
import itertools
import time
import math
import re
import zlib

import numpy as np
import pytest

from rivulet.llm import attention, language_id, lm_score, neighbours, toxicity
from rivulet.llm.common import byte_encoder, byte_ranks, tokenizer_path
from rivulet.llm.queries import QUERIES

MIDDLE = "/root/testdata/sf0.01"


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


# -- language ID --

def test_forward_sums_all_segmentations():
    ranks = byte_ranks(tokenizer_path(language_id.VOCABULARY))
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 50, (len(ranks), 3)).astype(float)
    model = language_id.Model(["a", "b", "c"], counts)
    words = [b" the", b" nation", "é".encode(), b"x", "日本語".encode(), b"zzzzzz", " größe".encode()]
    for word, got in zip(words, model.word_scores(words)):
        total = np.zeros(3)
        for cuts in itertools.chain.from_iterable(itertools.combinations(range(1, len(word)), k) for k in range(len(word))):
            edge = [0, *cuts, len(word)]
            parts = [word[a:b] for a, b in zip(edge, edge[1:])]
            if all(p in ranks and len(p) <= language_id.PIECE for p in parts):
                total += np.prod([model.chance[ranks[p]] for p in parts], axis=0)
        assert np.allclose(got, np.log10(total), rtol=1e-9)


def test_one_very_long_word():
    ranks = byte_ranks(tokenizer_path(language_id.VOCABULARY))
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 50, (len(ranks), 2)).astype(float)
    model = language_id.Model(["a", "b"], counts)
    # One language at a time: together, the short-word form holds the one behind at 300 decades.
    single = [language_id.Model(["x"], counts[:, k:k + 1]) for k in range(2)]
    letters = np.frombuffer("abcdefghij".encode(), np.uint8)
    for data in (b"international" * 400, "слово".encode() * 600, bytes(rng.choice(letters, language_id.LONG_BLOCK + 3000))):
        want = [m._forward([data], np.array([len(data)]))[0, 0] for m in single]
        assert np.allclose(model._forward_long(data), want, rtol=1e-9)
        assert (model.word_scores([data, b"x"])[0] == model._forward_long(data)).all()
    # 5 MB without a break go through.
    start = time.time()
    langs, score = model.predict(["international" * 400_000, "x"])
    assert len(langs) == 2 and np.isfinite(score).all() and time.time() - start < 120


def test_languages_of_held_out_documents(spark):
    rows = QUERIES["op7_language_id"](spark, MIDDLE).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang").collect()}
    assert {r["doc_id"] for r in rows} == set(truth) and all(r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in rows)
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"]]
    assert np.mean(held) > 0.98 and all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_texts(spark):
    train = spark.createDataFrame([("the end of the day", "en"), ("das ende der welt", "de"), (None, "fr"), ("x", None)] * 3, "text string, lang string")
    model = language_id.train(train)
    assert model.languages == ["de", "en"]
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 %% !"), (4, "the " * 20_000), (4, "the " * 20_000), (None, "der die das"), (6, "w" * 5000)],
                                "doc_id long, text string")
    got = [(r["doc_id"], r["lang_pred"], r["lang_score"]) for r in language_id.identify(odd, model).collect()]
    assert [g[1] for g in got] == ["und", "und", "und", "en", "en", "de", got[6][1]] and got[0][2] == 0.0
    assert language_id.train(train.limit(0)).predict(["the end"]) [0] == ["und"]
    # Clashing names: the pipeline's filter carries every column through.
    clash = odd.selectExpr("doc_id", "text", "1 AS lang_pred", "'y' AS lang_score", "map('a', 1) AS row")
    kept = language_id.accepted(clash, model)
    assert kept.columns == clash.columns and sorted(str(r["doc_id"]) for r in kept.collect())[-1] == "None"


# -- language model --

def test_windows_score_each_position_once():
    lengths = np.array([0, 1, 31, 32, 33, 58, 59, 500])
    text, start, first, end = attention.windows(lengths)
    for t, n in enumerate(lengths.tolist()):
        seen = [p for k in np.flatnonzero(text == t) for p in range(first[k], end[k])]
        assert seen == list(range(n))
    assert ((first - start)[start > 0] == attention.CONTEXT - attention.STRIDE).all()


def little_model():
    rng = np.random.default_rng(2)
    encoder = byte_encoder(lm_score.VOCABULARY, None, None)
    texts = [lm_score.subwords(" ".join(rng.choice(["the", "cat", "sat", "on", "mats", "Zebra"], 30))) for _ in range(40)]
    end = encoder.n_vocab
    ids, lengths = lm_score._flat(texts, end)
    classes = lm_score.Classes(np.bincount(ids, minlength=end + 1).astype(float))
    own, _, rows, before = classes.features(ids, lengths)
    pairs = np.zeros((attention.INPUTS * attention.BEFORE, attention.CLASSES))
    inside = np.zeros((attention.CLASSES + 1, end + 1))
    np.add.at(pairs, (rows, own), 1)
    np.add.at(inside, (before, ids), 1)
    trie = lm_score.Trie([b"the", b"cat", b"mats", b"mat"], np.array([50.0, 20, 5, 9]))
    trie.share[:] = 0.6
    trie.share[0] = 0
    model = lm_score.Model(classes, pairs, inside, trie, None)
    model.copy_share = np.array([0, 0.3, 0.8])
    return model, end


def test_chances_of_all_ids_sum_to_one():
    model, end = little_model()
    head = lm_score.subwords("Zebra sat on the mats sat on the cat sat")
    for cut in (len(head), len(head) - 1, 3):
        own = head[:cut]
        # A text that goes on with id i, without its end: the last chance of (own, i).
        lengths = np.array([cut + 1])
        each = np.zeros(end + 1)
        ids = np.append(own, 0)
        chance, opening = model.attend(ids, lengths)
        _, last, rows, before = model.classes.features(ids, lengths)
        at = max(0, cut + 1 - attention.CONTEXT)
        weights, total = model.attention.class_weights(model.attention.forward(last[None, at:])[0][-1:], rows[-1:])
        by_class = weights[0] / total[0]
        alone = by_class[model.classes.own] * model.inside[before[-1]]
        assert abs(alone.sum() - 1) < 1e-3 and abs(alone[lm_score.opens_word()].sum() - opening[-1]) < 1e-3
        for i in range(0, end + 1):
            if alone[i] > 1e-6 or i % 101 == 0:
                ids[-1] = i
                bucket, known = model.mixed(np.append(chance[:-1], alone[i]), np.append(opening[:-1], opening[-1]), ids, lengths)
                guess, matched = lm_score.copied(ids, lengths)
                share, copy = model.trie.share[bucket[-1]], model.copy_share[matched[-1]]
                each[i] = (1 - copy) * (share * known[-1] + (1 - share) * alone[i]) + copy * (guess[-1] == i)
        assert 0.9 < each.sum() < 1.01


def test_scoring_does_not_depend_on_the_batch():
    model, _ = little_model()
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 500, n) for n in (0, 1, 5, 40, 200, 33)]
    together = model.score(texts)
    assert np.allclose(together, [model.score([t])[0] for t in texts], rtol=1e-4)
    assert (together < 0).all()


def test_gradients_are_right():
    rng = np.random.default_rng(5)
    net = attention.Attention(20, np.log(np.full((64, 8), 1 / 8, np.float32)), context=6, width=4)
    ids, rows, target = rng.integers(0, 20, (3, 6)), rng.integers(0, 64, (3, 6)), rng.integers(-1, 8, (3, 6))
    less = np.zeros((3, 6), np.float32)
    _, gradient = net.gradients(ids, rows, target, less)
    for name, weights in net.p.items():
        at = np.unravel_index(np.abs(gradient[name]).argmax(), weights.shape)
        held, around = weights[at], []
        for step in (1e-2, -1e-2):
            weights[at] = held + step
            around.append(net.gradients(ids, rows, target, less)[0])
        weights[at] = held
        assert abs((around[0] - around[1]) / 2e-2 - gradient[name][at]) < 2e-3


def test_copies_look_back_in_the_same_text():
    ids = np.array([1, 2, 3, 4, 1, 2, 3, 9, 1, 2, 3, 4])
    guess, matched = lm_score.copied(ids, np.array([8, 4]))
    assert guess[7] == 4 and matched[7] == 1 and guess[11] == -1
    ids = np.array([*range(10), *range(10)])
    guess, matched = lm_score.copied(ids, np.array([20]))
    assert (guess[13:] == ids[13:]).all() and (matched[16:] == 2).all()


def test_base_scores_equal_brute_force(spark):
    docs = [(d, t) for d, t in [(i, f"Word{i % 7} the\tTHE é{i} end") for i in range(60)] + [(70, None), (71, ""), (72, " \n "), (None, "the null")]]
    frame = spark.createDataFrame([(d, t, 1.0, 2) for d, t in docs + docs[:1]], "doc_id long, text string, score double, row int")
    from rivulet.llm.common import crc_fold
    from pyspark.sql import functions as F

    got = lm_score.score(spark, frame, crc_fold("doc_id", 10) == F.lit(0)).collect()
    words = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    counts = collections.Counter(w for d, t in docs + docs[:1] if fold(d, 10) for w in [*words(t), b" "])
    total, distinct = sum(counts.values()), len(counts)
    assert len(got) == len(docs) + 1
    by_id = {d: t for d, t in docs}
    for r in got:
        own = [*words(by_id[r["doc_id"]]), b" "]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert r["held_out"] == (fold(r["doc_id"], 10) == 0) and r["n_tokens"] == len(own)
        assert r["n_known"] == sum(counts[w] > 0 for w in own) and r["train_tokens"] == total
        assert abs(r["base_score"] - base) < 1e-9 and r["score"] < 0
    assert lm_score.score(spark, frame.limit(0), crc_fold("doc_id", 10) == F.lit(0)).count() == 0


def test_word_sums_are_one_row_a_text_however_many_tasks(spark, monkeypatch):
    from rivulet.llm.common import crc_fold
    from pyspark.sql import functions as F

    docs = [(i, " ".join(f"w{(i * k) % 97} Common" for k in range(1 + i % 40))) for i in range(150)] + [(200, None), (None, "common"), (3, "w1")]
    made, logs = spark.sparkContext.accumulator(0), lm_score._logs

    def counting(batches):
        for batch in logs(batches):
            made.add(batch.num_rows)
            yield batch
    monkeypatch.setattr(lm_score, "_logs", counting)
    # Several batches of texts, and as many tasks as there are partitions.
    monkeypatch.setattr(lm_score, "BATCH_ROWS", 16, raising=False)
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for name, value in held.items():
        spark.conf.set(name, value)
    try:
        frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        got = lm_score.score(spark, frame, crc_fold("doc_id", 10) == F.lit(0)).collect()
    finally:
        for name in held:
            spark.conf.unset(name)
    assert made.value == len(got) == len(docs)
    words = lambda t: [*(t or "").lower().split(), ""]
    counts = collections.Counter(w for d, t in docs if fold(d, 10) for w in words(t))
    total, distinct = sum(counts.values()), len(counts)
    want = [sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words(t)) for _, t in docs]
    assert np.allclose(sorted(r["base_score"] for r in got), sorted(want), rtol=1e-12)
    assert sum(r["n_known"] for r in got) == sum(counts[w] > 0 for _, t in docs for w in words(t))


# -- toxicity --

def test_grammar_weighs_context():
    grammar = toxicity.Grammar({"idiot": 2.0, "mor*": 1.0})
    read = lambda text: grammar.clause([grammar.read(w) for w in text.split()])
    plain, aimed, denied, told = read("an idiot"), read("you idiot"), read("not an idiot"), read("he said idiot") / 1.5
    assert denied < told < plain < aimed and read("a day out") == 0 and read("moron") == 1.0
    assert read("kill") > 0 and grammar.features("")[0] == 0.0


def test_composition_multiplies_what_each_machine_lets_out():
    run = toxicity.compose(toxicity.matched, toxicity.negation)
    state, factor = run((0, 0), frozenset({"negation"}))
    assert state == (0, toxicity.REACH) and factor == 0
    assert run(state, frozenset({"insult"})) == ((0, toxicity.REACH - 1), 0.25)


def test_toxicity_of_held_out_documents(spark):
    rows = QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.1").collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = sum(a == b == 1 for a, b in held)
    assert right / sum(a for a, _ in held) > 0.9 and right / sum(b for _, b in held) > 0.85
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in rows)


def test_toxicity_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (1, None, 0.5), (None, "x", 1.0), (3, "", 2.0)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert sorted(r["score"] for r in toxicity.score(spark, docs, none).collect()) == [0.0] * 4
    some = spark.createDataFrame([(1, 1), (1, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    assert toxicity.score(spark, docs, some).count() == 4
    assert toxicity.score(spark, docs.limit(0), some).count() == 0


# -- neighbours --

def brute(ids, vectors, every, k):
    out = {}
    for q in sorted({int(i) for i in ids if i is not None and i % every == 0}):
        v = vectors[ids.index(q)]
        order = sorted((-float((x * v).sum()), -(1 << 63) if i is None else i) for i, x in zip(ids, vectors) if i != q)
        out[q] = [i for _, i in order[:k]]
    return out


def test_recall_of_learned_partitions(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids, vectors = [r["vec_id"] for r in rows], [np.array(r["embedding"], float) for r in rows]
    exact = brute(ids, vectors, 20, 20)
    got = {}
    for r in QUERIES["op5_neighbours"](spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(exact)
    recall = np.mean([len({v for _, v, _ in got[q]} & set(exact[q])) / 20 for q in exact])
    assert recall >= 0.9
    for q, near in got.items():
        near.sort()
        assert [n for n, *_ in near] == list(range(1, 21))
        assert all((a[2], -a[1]) > (b[2], -b[1]) for a, b in zip(near, near[1:]))


def test_neighbours_of_odd_vectors(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(0, 60)]
    common = rng.normal(size=8).tolist()
    rows += [(i, common) for i in range(100, 160)] + [(200, None), (220, [0.0] * 8), (240, [float("nan")] * 8), (260, [1.0, None] + [0.0] * 6),
                                                       (280, [float("inf")] * 8), (300, [1.0, 2.0]), (320, []), (None, rows[3][1]), (40, rows[40][1])]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, rank int, v int")
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 2)
    got = {}
    for r in neighbours.search(spark, frame, every=20, k=20, parts=2, probes=2).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    fine = [(i, np.array(v)) for i, v in rows if v and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)]
    exact = brute([i for i, _ in fine], [v for _, v in fine], 20, 20)
    null = -(1 << 63)
    assert {q: [null if v is None else v for _, v, _ in sorted(x, key=lambda y: y[0])] for q, x in got.items()} == exact
    assert neighbours.search(spark, frame.limit(0)).count() == 0
    few = neighbours.search(spark, frame.filter("vec_id < 5"), every=2, k=20).collect()
    assert len(few) == 3 * 4


def test_parts_are_balanced():
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(600, 8)) + np.repeat(rng.normal(size=(6, 8)) * 4, 100, axis=0)
    graph = neighbours.neighbour_graph(vectors)
    own = neighbours.balanced_parts(vectors, graph, 6)
    assert np.bincount(own, minlength=6).max() <= math.ceil(neighbours.SLACK * 100)
    assert (own[graph] == own[:, None]).mean() > 0.5


@pytest.mark.parametrize("lengths", [[0], [3, 0, 2]])
def test_shifted_stays_in_its_text(lengths):
    lengths = np.array(lengths) + 1
    values = np.arange(lengths.sum())
    starts = np.cumsum(lengths) - lengths
    out = lm_score._shifted(values, starts, 2, -1)
    for s, n in zip(starts.tolist(), lengths.tolist()):
        assert out[s:s + min(2, n)].tolist() == [-1] * min(2, n) and out[s + 2:s + n].tolist() == values[s:s + n][:-2].tolist()


def test_long_pieces_and_long_words_are_segmented_in_all_ways():
    ranks = byte_ranks(tokenizer_path(language_id.VOCABULARY))
    rng = np.random.default_rng(7)
    model = language_id.Model(["a", "b"], rng.integers(0, 50, (len(ranks), 2)).astype(float))
    longest = max(map(len, ranks))
    words = ["international", "relationship", "x", "und", "слово" * 11, "日本語の文章" * 9, "internationalrelationship" * 12]
    for word, got in zip(words, model._distinct_scores(words), strict=True):
        data = (" " + word).encode()
        total = [np.ones(2)] + [np.zeros(2) for _ in data]
        scale = 0
        for j in range(1, len(data) + 1):
            for i in range(max(0, j - longest), j):
                if data[i:j] in ranks:
                    total[j] = total[j] + total[i] * model.chance[ranks[data[i:j]]]
            if total[j].max() < 1e-100:  # all chances so far over one power of ten
                total = [t * 1e80 for t in total]
                scale += 80
        assert np.allclose(got, np.log10(total[-1]) - scale, rtol=1e-9)
    assert any(len(p) > 12 for p in ranks if b" international".startswith(p))


# -- training on all texts --

def test_training_windows_hold_each_position_once():
    ids, lengths = np.arange(100, 160), np.array([1, 24, 25, 10])
    got = lm_score.training_windows(ids, lengths)
    assert sorted(got[:, 2:][got[:, 2:] >= 0].tolist()) == ids.tolist()
    assert got[:, :2].tolist() == [[-1, -1], [-1, -1], [-1, -1], [147, 148], [-1, -1]]


def test_every_training_text_is_trained_on(spark, monkeypatch):
    """More texts than any bound, all counted in the class maps, the copies and the windows."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(lm_score, "SHARD_IDS", 20_000)
    texts = [f"text {i} says word{i % 50} and word{i % 7} again and word{i % 7} again" for i in range(4000)]
    rows = spark.createDataFrame([(i, t, i % 10 == 0) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
    read = rows.repartition(3).mapInArrow(lm_score._read(None), lm_score.ROWS).localCheckpoint()
    lengths = [len(lm_score.subwords(t)) + 1 for i, t in enumerate(texts) if i % 10]
    assert read.filter("id IS NOT NULL").agg(F.sum("seen")).first()[0] == sum(lengths)
    trained = []
    step = lm_score._train

    def watched(*a):
        trained.append(a[2])
        return step(*a)
    monkeypatch.setattr(lm_score, "_train", watched)
    counts = read.filter("word IS NOT NULL").groupBy("word").agg(F.sum("train").alias("c"))
    began = lm_score.Attention(lm_score.INPUTS, np.zeros((1, lm_score.CLASSES), np.float32)).p
    model, shared = lm_score.learn(read, counts)
    assert trained == list(range(2 * lm_score.ROUNDS))
    assert any(np.abs(model.attention.p[n] - began[n]).max() > 1e-4 for n in began)
    windows = sum(-(-n // lm_score.CONTEXT) for n in lengths)
    texts_ = read.filter("row IS NOT NULL AND NOT held_out").select("ids")
    out = texts_.mapInArrow(lm_score._train(shared, model.fitted(), 0, 1e-3), "kind int, at long, n long").groupBy("kind").agg(F.sum("n").alias("n"))
    assert {r["kind"]: r["n"] for r in out.collect()}[2] == windows


def test_texts_are_encoded_part_by_part(monkeypatch):
    """Ids are those of whole texts; a part that comes again isn't encoded again."""
    rng = np.random.default_rng(8)
    bits = [" ", "  ", "\t", "\n", " \n", " ", " ", "\x85", "\x1c", "a", "B", "é", "'s", "12", "!", "…", "“", "语", "🙂", "word", "<|endoftext|>"]
    texts = ["", " ", " a", "a ", "\n a"] + ["".join(rng.choice(bits, rng.integers(0, 40))) for _ in range(800)]
    encoded = [t.encode() for t in texts]
    flat, counts = lm_score.subwords_of(encoded)
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [lm_score.subwords(t).tolist() for t in texts]

    monkeypatch.setattr(lm_score, "GROUP", 200)
    groups = [encoded[g] for g in lm_score._groups(encoded)]
    assert sum(groups, []) == encoded and len(groups) > 5

    encoder = byte_encoder(lm_score.VOCABULARY, None, None)
    given = []

    class Watched:
        def encode_to_numpy(self, text, **options):
            given.append(len(text))
            return encoder.encode_to_numpy(text, **options)
    sizes = lm_score._id_bytes()
    monkeypatch.setattr(lm_score, "_id_bytes", lambda folder: sizes)
    monkeypatch.setattr(lm_score, "byte_encoder", lambda *a: Watched())
    lm_score.subwords_of([b"the same words again" + b" and again" * 5000] * 20)
    assert sum(given) < 1000


def test_a_chunk_of_windows_is_prepared_once(monkeypatch):
    """One step for each BATCH, features and the trie's judgement for all windows together."""
    model, _ = little_model()
    rng = np.random.default_rng(9)
    sample = lm_score.training_windows(rng.integers(0, 500, 24 * 300), np.array([24 * 300]))
    steps, judged = [], []
    gradients, mixed = model.attention.gradients, model.mixed
    monkeypatch.setattr(model.attention, "gradients", lambda *a: steps.append(len(a[0])) or gradients(*a))
    monkeypatch.setattr(model, "mixed", lambda *a, **k: judged.append(len(a[2])) or mixed(*a, **k))
    got = model.train(sample, attention.Adam(model.attention.p), 1e-3)
    assert steps == [64, 64, 64, 64, 44] and judged == [24 * 300]
    assert len(got) == 64 * lm_score.RATIO_BINS and 0 < got.sum() <= 24 * 300
