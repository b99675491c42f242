"""Chat formatting with offset-aligned loss masks.

Each conversation is rendered whole, encoded once with offsets, and a token
is under the loss mask if its characters lie in the text of an assistant
turn: the sorted text spans are searched for each token's offsets.

The template writes <|turn|>role<|text|>text<|end|> for each turn.  The three
marks are special tokens, so no token runs over a border.  Inside roles and
texts every "<", any number of "~", "|" gets one "~" more; what was there is
read back by taking one away, so no text can look like a mark.

A conversation's turns come in order of turn, then role and text; a null turn
comes first; a null role or text counts as empty; repeated rows are turns of
their own; rows with a null conv_id are one conversation; further columns are
ignored; an empty table gives an empty result."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens
from .work import mapped

#: The template's marks and the role that is learned from.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED = "assistant"
#: What is escaped, and what is read back.
_CONTROL, _ESCAPED = re.compile(r"<(~*)\|"), re.compile(r"<~(~*)\|")
#: Characters of conversations encoded at a time (a longer one alone).
CHUNK_CHARS = 1 << 20


def escape(s: str) -> str:
    return _CONTROL.sub(r"<~\1|", s)


def unescape(s: str) -> str:
    return _ESCAPED.sub(r"<\1|", s)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation's text and the spans of the texts that are learned from."""
    parts, spans, n = [], [], 0
    for role, text in turns:
        head, body = TURN + escape(role) + TEXT, escape(text)
        if role == LEARNED:
            spans.append((n + len(head), n + len(head) + len(body)))
        parts += (head, body, END)
        n += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(text: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    out = []
    for turn in text.split(TURN)[1:]:
        role, rest = turn.split(TEXT, 1)
        out.append((unescape(role), unescape(rest[:-len(END)])))
    return out


def masked(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in one of the sorted spans, by binary search."""
    if not spans:
        return np.zeros(len(starts), bool)
    begin, end = np.array(spans, np.int64).T
    k = np.searchsorted(begin, starts, "right") - 1
    return (k >= 0) & (ends <= end[np.maximum(k, 0)]) & (ends > starts)


def conversations(rows: DataFrame) -> DataFrame:
    """conv_id, turns: array<struct<turn, role, text>> in order."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def _tokenizer(content: bytes):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    lib = Tokenizer.from_str(content.decode())
    lib.add_special_tokens([TURN, TEXT, END])
    return lib


def formatted(rows: DataFrame, vocabulary: str) -> DataFrame:
    """conv_id, formatted, ids, starts, ends (code points), loss (0 or 1 for each token)."""
    content, _ = pretokens.vocabulary(rows.sparkSession, vocabulary)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = _tokenizer(content.value)

        def encode(ids: list, texts: list[str], spans: list) -> pa.RecordBatch:
            got = lib.encode_batch(texts, add_special_tokens=False)
            at = [np.array(e.offsets, np.int64).reshape(-1, 2) for e in got]
            ints = pa.list_(pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array([e.ids for e in got], ints), pa.array([a[:, 0].astype(np.int32) for a in at], ints),
                 pa.array([a[:, 1].astype(np.int32) for a in at], ints),
                 pa.array([masked(a[:, 0], a[:, 1], s).astype(np.int8) for a, s in zip(at, spans, strict=True)], pa.list_(pa.int8()))],
                ["conv_id", "formatted", "ids", "starts", "ends", "loss"])
        for b in batches:
            ids, texts, spans, n = [], [], [], 0
            for i in range(b.num_rows):
                text, s = render([(t["role"], t["text"]) for t in b.column("turns")[i].as_py()])
                ids.append(b.column("conv_id")[i].as_py())
                texts.append(text)
                spans.append(s)
                n += len(text)
                if n >= CHUNK_CHARS:
                    yield encode(ids, texts, spans)
                    ids, texts, spans, n = [], [], [], 0
            if ids:
                yield encode(ids, texts, spans)
    return mapped(conversations(rows), each, "conv_id long, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<tinyint>")


def learned_texts(text: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> list[str]:
    """The text under the mask, read from the tokens' offsets: one piece for
    each stretch of masked tokens that no mark interrupts."""
    on = np.flatnonzero(loss)
    if not len(on):
        return []
    cut = np.flatnonzero(np.diff(on) > 1)
    first, last = on[np.r_[0, cut + 1]], on[np.r_[cut, len(on) - 1]]
    return [unescape(text[starts[a]:ends[b]]) for a, b in zip(first, last, strict=True)]


def digests(out: DataFrame) -> DataFrame:
    """What the formatted conversations say, read back from them."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                text = b.column("formatted")[i].as_py()
                starts, ends, loss = (b.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("starts", "ends", "loss"))
                turns = parse(text)
                learned = "".join(learned_texts(text, starts, ends, loss))
                sha = hashlib.sha256()
                for role, body in turns:
                    sha.update(f"{role}\n{body}\n".encode())
                rows.append((b.column("conv_id")[i].as_py(), len(turns), sha.hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return mapped(
        out.select("conv_id", "formatted", "starts", "ends", "loss"), each,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op3_chat_format(spark, sf_dir: str) -> DataFrame:
    """All ``conversations``, and conversation -7."""
    import public_tokenizers
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return digests(formatted(rows.unionByName(extra), public_tokenizers.path("byte_bpe_50k.json")))
