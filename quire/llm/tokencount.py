"""Token counts with a whole-token shortcut.

Which strings of the vocabulary encode alone as one token is proved once on
the driver with the library itself.  A pre-token that is one of them counts
one; only the rest is merged, by the library, once for each distinct
pre-token and worker (see ``pretokens``).

Null texts count as empty: no bytes, no tokens.  Rows are independent, so
repeated rows give repeated results; further columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens
from .words import chunks, segment_hashes, utf8
from .work import mapped

#: Tokens beyond which a document is over the limit.
LIMIT = 2048
_SLOTS = 20


def shortcut(single: np.ndarray) -> np.ndarray:
    """The hashes by their leading bits; of two that share them one stays, the other is merged like the rest."""
    table = np.zeros(1 << _SLOTS, np.uint64)
    table[(single >> np.uint64(64 - _SLOTS)).astype(np.int64)] = single
    return table


def count(enc: pretokens.Encoder, table: np.ndarray, column: pa.Array) -> np.ndarray:
    """Tokens of each text."""
    easy, points, at = enc.split(column)
    n = np.zeros(len(easy), np.int64)
    if easy.any():
        start, end, first = pretokens.pretokens(points, at)
        keep = np.repeat(easy, np.diff(first))
        h = segment_hashes(pretokens.VALUE[np.minimum(points, 0x10000)], start, end)
        size = (table[(h >> np.uint64(64 - _SLOTS)).astype(np.int64)] == h).astype(np.int64)
        rest = np.flatnonzero((size == 0) & keep)
        e = enc.entries(h[rest], points, start[rest], end[rest])
        size[rest] = enc.at[e + 1] - enc.at[e]
        total = np.r_[0, np.cumsum(size)]
        n = total[first[1:]] - total[first[:-1]]
    if not easy.all():
        hard = np.flatnonzero(~easy)
        n[hard] = [len(x) for x in enc.whole(["" if t is None else t for t in column.take(pa.array(hard)).to_pylist()])]
    return n


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document."""
    content, kind = pretokens.vocabulary(docs.sparkSession, path)
    table = docs.sparkSession.sparkContext.broadcast(pretokens.Encoder(content.value, kind).single_words())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, whole = pretokens.encoder(content.value, kind), shortcut(table.value)
        for b in chunks(batches):
            n = count(enc, whole, b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(utf8(b.column("text"))[1]), pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit, pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return mapped(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), each,
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``."""
    import public_tokenizers
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
