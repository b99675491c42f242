"""Chat formatting: exact round trip of turns and learned texts."""

import hashlib
from collections import defaultdict

import public_tokenizers

from quire.llm import chat

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
ROWS = [
    (1, 0, "system", "Be brief."), (1, 2, "assistant", "Hi <|end|> there <|turn|>assistant<|text|>x"), (1, 1, "user", "<~|text|> a < | b <~~|"),
    (2, 0, "assistant", None), (2, 1, "assistant", "  \n spaces \n\n"), (2, 2, "assistant", "<|endoftext|>"), (2, 3, "user", ""),
    (3, 0, "assistant", "é𝔘🤦🏽‍♂️ é <"), (3, 0, "assistant", "é𝔘🤦🏽‍♂️ é <"), (3, 1, None, "| no role"), (3, None, "user", "first"), (3, 1, "as<|text|>sistant", "odd role"),
    (None, 0, "assistant", "null id"), (5, 0, "assistant", "long text " * 50_000), (5, 1, "assistant", "|>"),
]


def brute(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append(((t is not None, t or 0), r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        said = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def test_round_trip(spark):
    rows = spark.createDataFrame([(*r, "z") for r in ROWS], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(chat.formatted(rows, VOCAB)).collect()}
    assert got == brute(ROWS)


def test_mask_and_offsets(spark):
    rows = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    for r in chat.formatted(rows, VOCAB).collect():
        assert len(r.ids) == len(r.starts) == len(r.ends) == len(r.loss)
        at = 0
        for role, text in chat.parse(r.formatted):
            body = chat.escape(text)
            a = r.formatted.index(chat.TEXT, at) + len(chat.TEXT)
            inside = [bool(m) for s, e, m in zip(r.starts, r.ends, r.loss, strict=True) if s >= a and e <= a + len(body)]
            assert all(x == (role == "assistant") for x in inside)
            at = a + len(body)


def test_escape_is_reversible():
    for s in ("", "<", "|", "<|", "<~|", "<~~~|>", "<<||", "<|turn|>", "<~<|~|"):
        assert chat.unescape(chat.escape(s)) == s and "<|" not in chat.escape(s)


def test_query_and_empty_table(spark, sf_dir, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    got = {r.conv_id: tuple(r)[1:5] for r in chat.op3_chat_format(spark, sf_dir).collect()}
    assert got == brute([*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)])
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r.conv_id for r in chat.op3_chat_format(spark, str(tmp_path)).collect()] == [-7]
