"""Packing: exact round trip and least cost; chat: reversible template and masks."""
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rivulet.llm import chat, packing
from rivulet.llm.queries import ORACLE_SQL, QUERIES


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=300), st.booleans())
def test_ids_are_the_tokenizer_s(text, special):
    text = text + "<|endoftext|>x" if special else text
    assert packing.token_ids(text).tolist() == tokenizer().encode(text, add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("text", [" " * 100_000, "a" * 60_000, "\n" * 5000, "é" * 20_000 + " " * 3000])
def test_ids_of_endless_runs(text):
    assert packing.token_ids(text).tolist() == tokenizer().encode(text, add_special_tokens=False).ids + [0]


def check_pieces(docs, rows):
    """Each id in exactly one piece; sequences of at most 1024 ids without gaps."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for name, text in docs:
        ids, at = packing.token_ids(text or ""), 0
        for r in sorted(by_doc[name], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].astype("<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    sizes = []
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
        sizes.append(at)
    return sizes


def padding(sizes):
    return sum(0 if n & (n - 1) == 0 else 1024 - n for n in sizes)


def test_pieces_cover_all_documents(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    sizes = check_pieces(docs, QUERIES["op4_packing"](spark, small).collect())
    assert padding(sizes) < 0.03 * sum(sizes)


def test_odd_documents_and_small_blocks(spark):
    rng = random.Random(2)
    docs = [(1, None), (2, ""), (3, "word " * 40_000), (4, "x. " * 9000), (5, "é" * 5000)]
    docs += [(10 + i, " ".join(rng.choice(["the", "end.", "of", "A!"]) for _ in range(rng.randrange(400)))) for i in range(60)]
    frame = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, start int, offset int").coalesce(1)
    for block in (packing.BLOCK, 3000):
        sizes = check_pieces(docs, packing.pack(frame, block=block).collect())
        assert padding(sizes) < 0.05 * sum(sizes)
    assert packing.pack(frame.limit(0)).count() == 0
    twice = frame.filter("doc_id = 4").unionByName(frame.filter("doc_id = 4"))
    assert sum(r["length"] for r in packing.pack(twice).collect()) == 2 * len(packing.token_ids("x. " * 9000))


def test_cuts_have_least_cost():
    rng = random.Random(3)
    for _ in range(40):
        at = np.array(sorted(rng.sample(range(1, 60), 20)) + [60])
        gaps = np.diff(np.r_[0, at])
        if gaps.max() > 16:
            continue
        penalty = np.array([rng.randrange(4) for _ in at])
        cost = lambda n: 0 if n & (n - 1) == 0 else 16 - n
        best = {0: 0}
        for j, p in zip(at.tolist(), penalty.tolist()):
            best[j] = min(best[i] + cost(j - i) for i in best if j - i <= 16) + p + 5
        cuts = packing.best_cuts(at, penalty, 60, size=16, sequence_cost=5)
        price = sum(cost(b - a) + 5 + int(penalty[at.tolist().index(b)]) for a, b in zip([0, *cuts], cuts))
        assert cuts[-1] == 60 and price == best[60]


# -- chat --

pieces = st.one_of(st.text(max_size=8), st.sampled_from([*chat.CONTROL, "\\", "<", "|", "<|", "<\\|end|>", "[", "</", "\\\\"]))
texts = st.lists(pieces, max_size=6).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), texts), texts), max_size=6))
def test_template_reads_back(turns):
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    for _, text in turns:
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in chat.CONTROL)
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant" and t]


def test_chat_query_equals_sql(spark, small, oracle):
    df = QUERIES["op10_chat_format"](spark, small)
    assert sorted(tuple(str(x) for x in r) for r in df.collect()) == oracle(ORACLE_SQL["op10_chat_format"], df.columns)


def test_masks_cover_the_assistant_texts_alone(spark):
    rows = [(1, 0, "user", "é</s>"), (1, 1, "assistant", ".<|end|> 😀 日本"), (1, 2, "assistant", None), (1, 3, "assistant", "</"),
            (2, 0, None, "x"), (2, 0, "assistant", "b"), (2, 0, "assistant", "b"), (None, None, "assistant", "[INST]\n"), (3, 5, "user", "only")]
    frame = spark.createDataFrame([(*r, "clash", 4) for r in rows], "conv_id long, turn long, role string, text string, formatted string, n_turns int")
    out = {r["conv_id"]: r for r in chat.format_chats(frame).collect()}
    said = {k: "".join(chat.masked_texts(r["formatted"], r["token_start"], r["token_end"], r["loss_mask"])) for k, r in out.items()}
    assert said == {1: ".<|end|> 😀 日本</", 2: "bb", None: "[INST]\n", 3: ""}
    for r in out.values():
        assert len(r["input_ids"]) == len(r["loss_mask"]) == len(r["token_start"])
    assert chat.digests(chat.format_chats(frame.limit(0))).count() == 0


def test_mask_is_a_binary_search():
    starts, ends = np.array([0, 3, 5, 9]), np.array([3, 5, 9, 12])
    assert chat.mask(starts, ends, [(3, 9)]).tolist() == [False, True, True, False]
    assert not chat.mask(starts, ends, []).any()
