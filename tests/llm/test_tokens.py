"""Token files and counts against the library's own encoding."""

import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quire.llm import pretokens, tokencount, tokenfile

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " \n\t ", "Hello, World!", "don't we'll I'M 'sword ''s 's's x'tis rock'n'roll they'VE o'rE ,'s 's", "ÀÉÎõü ÑANDÚ straße İstanbul ΣΊΣΥΦΟΣ", "é ﬁ Å 한국어 日本語 中文字 ١٢٣ ½ Ⅷ x²",
    "<|endoftext|> inside <|startoftext|>text", "<| endoftext |> <|Endoftext|>", "a\x00b\x1cc\x85d\xa0e f　g​h", "emoji 👩‍👩‍👧 𝔘𝔫𝔦", "1234 56.78 $9,999.00 #tag @me a1b2", "word " * 30_000,
    "Ünïcödé" * 400, "'" * 50 + "s", "tab\tnew\nline", "the", "The the THE",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch(["" if t is None else t for t in texts], add_special_tokens=False)]


def test_array_form_equals_library(library):
    enc = pretokens.Encoder(open(PATH, "rb").read(), ".json")
    points = [c for c in range(0x10000) if pretokens.KIND[c] != pretokens.HARD]
    texts = TEXTS + [f"a{chr(c)}b {chr(c)}1{chr(c)}{chr(c)} '{chr(c)} {chr(c)}'s x'll{chr(c)}" for c in points[::7]]
    for _ in range(2):  # the second time from the table
        ids, at = enc.encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == ids_of(library, texts)
    enc.clear()
    assert enc.encode(pa.array([], pa.string()))[1].tolist() == [0]


def test_counts(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], None), (None, "two words", "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    got = sorted(map(tuple, tokencount.token_counts(d, PATH).collect()), key=repr)
    n = [len(x) for x in ids_of(library, [t for _, t, _ in rows])]
    assert got == sorted(((i, len((t or "").encode()), k, k > 2048) for (i, t, _), k in zip(rows, n, strict=True)), key=repr)
    assert tokencount.token_counts(d.limit(0), PATH).collect() == []


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_other_vocabularies(spark, name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece
        n = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode([t or "" for t in TEXTS])]
    else:
        n = [len(x) for x in ids_of(Tokenizer.from_file(path), TEXTS)]
    d = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    assert [r.n_tokens for r in tokencount.token_counts(d, path).orderBy("doc_id").collect()] == n


def test_single_words_are_single(library):
    enc = pretokens.Encoder(open(PATH, "rb").read(), ".json")
    assert len(enc.single_words()) > 30_000


def expect(library, rows):
    out, start = [], 0
    data = sorted(((i is not None, i or 0, zlib.crc32(b := struct.pack(f"<{len(x) + 1}I", *x, 2)), len(b) // 4) for (i, _), x in
                   zip(rows, ids_of(library, [t for _, t in rows]), strict=True)))
    for known, i, crc, n in data:
        out.append((i if known else None, start, n, crc))
        start += n
    return out


def test_file_round_trip(spark, library, tmp_path):
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(3, "repeated"), (3, "repeated"), (None, "no id")] + [(1000 + i, f"short text {i}") for i in range(1500)]
    d = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, seq int").repartition(6)
    got = sorted(map(tuple, tokenfile.token_file(d, PATH, f"{tmp_path}/t").collect()), key=lambda r: r[1])
    assert got == expect(library, rows)
    some = tokenfile.read_tokens(spark, f"{tmp_path}/t", [9, 1003]).collect()
    want = {i: x for (i, _), x in zip(rows, ids_of(library, [t for _, t in rows]), strict=True) if i in (9, 1003)}
    assert {r.doc_id: r.ids[:-1] for r in some} == want


def test_query_and_empty_table(spark, library, sf_dir, tmp_path):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, tokenfile.op4_token_file(spark, sf_dir).collect())) == expect(library, rows)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert tokenfile.token_file(none, PATH).collect() == []


def test_dictionary_helps_and_is_checked(spark, tmp_path):
    samples = [tokenfile.serialised(np.arange(i, i + 60) % 400) for i in range(500)]
    d = tokenfile.trained(samples)
    import zstandard
    packed = [zstandard.ZstdCompressor(level=3, dict_data=tokenfile.codec(d)).compress(s) for s in samples]
    assert sum(map(len, packed)) < 0.7 * sum(len(zstandard.compress(s, 3)) for s in samples)
    assert tokenfile.trained([]) == b"" and tokenfile.codec(b"") is None


def test_long_words_with_one_polynomial_hash():
    """The Thue-Morse word and its complement."""
    import numpy as np
    from quire.llm import words
    import pyarrow as pa
    for n in (512, 1024, 4096):
        a = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
        b = a.translate({97: "b", 98: "a"})
        texts = [a, b, f"{b} x {a}", " ".join(a), " ".join(b)]
        h, first = words.word_hashes(pa.array(texts))
        assert h[0] == h[4] and h[1] == h[2] and h[0] != h[1]
        nodes = words.segment_hashes(h, first[:-1], first[1:])
        assert len({int(x) for x in nodes}) == 5
        with open(PATH, "rb") as f:
            ids, at = pretokens.Encoder(f.read(), ".json").encode(pa.array(texts))
        lib = Tokenizer.from_file(PATH)
        assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:], strict=True)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert np.unique(words.segment_hashes(np.arange(5000, dtype=np.uint64), np.arange(600), np.arange(600) + 300)).size == 600
