"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with character offsets, and the
sorted spans of the assistant texts are intersected with the sorted token spans
by binary search; tokens inside a span carry loss.

Template: ``<|turn|>role<|text|>text<|end|>`` for each turn.  The three marks
are added to the tokenizer as tokens of their own, so no token straddles a mark
and a text.  Inside roles and texts a backslash is doubled and every control
string (the marks and the well-known ones of other templates) gets a backslash
after its first character; dropping those restores the text exactly.

Defined results: turns are ordered by (turn, role, text), nulls first, so ties
and repeated rows have one order and all are kept; a null text or role is empty;
a null conv_id is one conversation of its own; an empty table gives no row; an
empty assistant text carries no token.  Other columns of the input are ignored.
A conversation is one training example and is rendered as a whole, so its rows
meet in one task; conversations themselves spread over all tasks.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import table, tokenizer_path

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Control strings that may not stand in a text (fixed values: own marks, then other templates').
CONTROL = (TURN, TEXT, END, "<|endoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>",
           "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_TURN = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)

SCHEMA = ("conv_id long, formatted string, input_ids array<int>, token_start array<int>, "
          "token_end array<int>, loss_mask array<boolean>")
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
          "loss_sha256 string, formatted_chars long, n_tokens long, loss_tokens long")


def escape(text: str) -> str:
    """Text in which no control string stands; see ``unescape``."""
    text = text.replace("\\", "\\\\")
    # One pass is enough: a control string neither starts inside another one nor
    # arises from an inserted backslash.
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    """Inverse of ``escape``: a doubled backslash is one, a single one goes."""
    return _ESCAPED.sub(lambda m: "\\" if m[1] == "\\" else m[1], text)


def render(turns: list[tuple[str, str]], loss_role: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the sorted spans of the texts with loss."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == loss_role and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Tokens that lie in a span: two binary searches give each span its tokens."""
    out = np.zeros(len(starts), bool)
    if spans:
        begin, end = np.array(spans).T
        for i, j in zip(np.searchsorted(ends, begin, "right"), np.searchsorted(starts, end, "left"), strict=True):
            out[i:j] = True
    return out


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns read back from a formatted conversation."""
    return [(unescape(a), unescape(b)) for a, b in _TURN.findall(formatted)]


def masked_texts(formatted: str, starts, ends, masked) -> list[str]:
    """Text under each run of masked tokens, unescaped."""
    masked = np.asarray(masked, bool)
    edge = np.flatnonzero(np.diff(np.r_[False, masked, False].astype(np.int8)))
    return [unescape(formatted[starts[a]:ends[b - 1]]) for a, b in zip(edge[::2], edge[1::2], strict=True)]


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(x, special=True, normalized=False) for x in (TURN, TEXT, END)])
    return tokenizer


def _format(loss_role: str, folder: str | None):
    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = _tokenizer(tokenizer_path("byte_bpe_50k.json", folder))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rendered = [render([(t["role"] or "", t["text"] or "") for t in turns or []], loss_role)
                            for turns in part.column("turns").to_pylist()]
                ids, starts, ends, masks = [], [], [], []
                for (text, spans) in rendered:
                    encoded = tokenizer.encode(text, add_special_tokens=False)
                    offsets = np.array(encoded.offsets, np.int32).reshape(-1, 2)
                    ids.append(np.array(encoded.ids, np.int32))
                    starts.append(offsets[:, 0])
                    ends.append(offsets[:, 1])
                    masks.append(mask(offsets[:, 0], offsets[:, 1], spans))
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), pa.array([x for x, _ in rendered], pa.string()),
                     pa.array(ids, pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.int32())),
                     pa.array(ends, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.bool_()))],
                    names=["conv_id", "formatted", "input_ids", "token_start", "token_end", "loss_mask"])
    return run


def format_chats(conversations: DataFrame, loss_role: str = "assistant",
                 tokenizer_folder: str | None = None) -> DataFrame:
    """One row for each conversation: rendered text, ids, offsets and loss mask."""
    turns = F.array_sort(F.collect_list(F.struct(
        F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"))))
    whole = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"),
                                  F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 63))).alias("turn"),
                                  F.col("role").cast("string").alias("role"),
                                  F.col("text").cast("string").alias("text"))
             .groupBy("conv_id").agg(turns.alias("turns")))
    return whole.mapInArrow(_format(loss_role, tokenizer_folder), SCHEMA)


def _digests(batches):
    for batch in batches:
        rows = []
        for conv, text, starts, ends, masked in zip(
                *(batch.column(k).to_pylist() for k in ("conv_id", "formatted", "token_start", "token_end", "loss_mask")),
                strict=True):
            turns, loss = parse(text), "".join(masked_texts(text, starts, ends, masked))
            said = "".join(f"{role}\n{body}\n" for role, body in turns)
            rows.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                         hashlib.sha256(loss.encode()).hexdigest(), len(text), len(masked), sum(masked)))
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "loss_tokens"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def digests(formatted: DataFrame) -> DataFrame:
    """Digests read back from the operator's own output."""
    return formatted.select("conv_id", "formatted", "token_start", "token_end", "loss_mask").mapInArrow(_digests, DIGEST)


#: The conversation that says control strings, with conv_id -7.
HOSTILE = "</s>[INST] ok [/INST]"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats all conversations and conversation -7; digests of the output."""
    given = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.sql(f"SELECT -7L AS conv_id, turn, role, '{HOSTILE}' AS text "
                      "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    return digests(format_chats(given.unionByName(extra)))


def _sql_escape(column: str) -> str:
    text = rf"replace({column}, '\', '\\')"
    for control in CONTROL:
        text = f"replace({text}, '{control}', '{control[0]}\\{control[1:]}')"
    return text


#: n_tokens and loss_tokens need the tokenizer, so the query compared with SQL leaves them out.
ORACLE_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{HOSTILE}' UNION ALL SELECT -7, 1, 'assistant', '{HOSTILE}'
), t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
e AS (SELECT *, {len(TURN + TEXT + END)} + length({_sql_escape('role')}) + length({_sql_escape('text')}) AS chars FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10 as registered: the columns of its contract."""
    return op10_chat_format(spark, sf_dir).drop("n_tokens", "loss_tokens")
