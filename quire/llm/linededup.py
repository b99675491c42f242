"""Line dedup with a once-seen and a twice-seen Bloom filter.

Every task notes the keys of its documents' lines in two filters: keys seen in
a document, and keys seen in two.  Merging two tasks' filters, the keys that
both once-filters may hold go to the twice-filter, so it misses no repeat.
Only lines that the twice-filter suspects are shuffled, as a 128-bit hash and
a document id; they are counted exactly, and the document that keeps the line
is chosen.  The filters' size follows the text up to ``MAX_BITS``; beyond it
more lines are suspected, which costs shuffle but changes no result.

A key is the line without ASCII white space at both ends, in ASCII lower case.
Null and empty texts are one empty line; rows with the same doc_id are one
document for the count, and each keeps or loses its own lines; a null doc_id
counts as one document, below all others; columns beyond doc_id and text are
ignored; an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import chunks
from .work import mapped, new_path, stored

#: Least code points of a key, least documents that hold it, white space.
LEAST_LENGTH = 40
LEAST_DOCS = 5
SPACE = b" \t\n\x0b\x0c\r"
#: Bits of a filter at most (16 MB; 2.2 GB of text a hash range), of a merged piece, and for each line that is expected.
MAX_BITS = 1 << 27
PIECE_BITS = 1 << 17
BITS_A_LINE = 6
#: Bytes of text for each line that is expected.
BYTES_A_LINE = 100
PROBES = 3
#: Confirmed keys up to which they are broadcast (about 30 MB); beyond, a join brings them.
MAX_KEYS = 200_000


def key_of(line: bytes, least: int = LEAST_LENGTH) -> bytes | None:
    """The line's key, or None if it is too short to count."""
    k = line.strip(SPACE)
    if len(k) < least or len(k) < 4 * least and not k.isascii() and len(k.decode()) < least:
        return None
    return k.lower()


def _keys(text: bytes | None, least: int) -> set[bytes]:
    from xxhash import xxh3_128_digest
    return {xxh3_128_digest(k) for line in (text or b"").split(b"\n") if (k := key_of(line, least)) is not None}


def _probes(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key (two 64-bit halves), all within one piece."""
    piece = keys[:, 0] % np.uint64(bits // PIECE_BITS) * np.uint64(PIECE_BITS)
    step = keys[:, 1] | np.uint64(1)
    return np.stack([piece + ((keys[:, 0] >> np.uint64(32)) + np.uint64(i) * step) % np.uint64(PIECE_BITS) for i in range(PROBES)], axis=1)


def _has(bits: np.ndarray, probes: np.ndarray) -> np.ndarray:
    return (bits[probes >> np.uint64(3)] >> (probes & np.uint64(7)).astype(np.uint8) & 1).astype(bool).all(axis=1)


def _put(bits: np.ndarray, probes: np.ndarray) -> None:
    at = probes.ravel()
    np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def _text_keys(batches: Iterator[pa.RecordBatch], least: int):
    """(doc_id of each key, or None; keys) of the texts' lines."""
    for b in chunks(batches):
        docs = [_keys(t, least) for t in b.column("text").cast(pa.binary()).to_pylist()]
        keys = np.frombuffer(b"".join(k for d in docs for k in d), np.uint64).reshape(-1, 2)
        row = np.repeat(np.arange(len(docs)), np.array([len(d) for d in docs], np.int64))
        yield b.column("doc_id").take(pa.array(row)) if "doc_id" in b.schema.names else None, keys


def _written_keys(batches: Iterator[pa.RecordBatch], least: int):
    """The same of a table of keys."""
    for b in batches:
        yield b.column("doc_id"), np.stack([b.column(c).to_numpy().view(np.uint64) for c in ("hi", "lo")], axis=1)


def repeats_filter(lines: DataFrame, bits: int, least: int = LEAST_LENGTH, read=_text_keys) -> np.ndarray:
    """The merged twice-seen filter of ``bits`` bits."""
    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for _, keys in read(batches, least):
            if len(keys):
                keys, n = np.unique(keys, axis=0, return_counts=True)
                at = _probes(keys, bits)
                _put(twice, at[_has(once, at) | (n > 1)])
                _put(once, at)
        step = PIECE_BITS // 8
        for p in range(0, len(once), step):
            if once[p:p + step].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p // step], pa.int32()), pa.array([once[p:p + step].tobytes()], pa.binary()), pa.array([twice[p:p + step].tobytes()], pa.binary())],
                    ["piece", "once", "twice"])

    def merge(pieces: pd.DataFrame) -> pd.DataFrame:
        once, twice = np.zeros(PIECE_BITS // 8, np.uint8), np.zeros(PIECE_BITS // 8, np.uint8)
        for o, t in zip(pieces["once"], pieces["twice"], strict=True):
            o = np.frombuffer(o, np.uint8)
            twice |= np.frombuffer(t, np.uint8) | once & o
            once |= o
        return pd.DataFrame({"piece": pieces["piece"].iloc[:1], "twice": [twice.tobytes()]})

    # Few tasks, so that there are few filters to merge; a pair's lines are few enough for that.
    tasks = 2 * lines.sparkSession.sparkContext.defaultParallelism
    partial = mapped(lines.coalesce(tasks), note, "piece int, once binary, twice binary")
    out = np.zeros(bits // 8, np.uint8)
    for r in partial.groupBy("piece").applyInPandas(merge, "piece int, twice binary").toLocalIterator():
        at = r.piece * PIECE_BITS // 8
        out[at:at + PIECE_BITS // 8] = np.frombuffer(r.twice, np.uint8)
    return out


def filter_size(docs: DataFrame, most: int = MAX_BITS) -> tuple[int, int]:
    """Bits of a filter, a power of two of at most ``most`` (a piece at least), and the hash ranges that have one."""
    need = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BYTES_A_LINE * BITS_A_LINE
    bits = PIECE_BITS
    while bits < need and 2 * bits <= most:
        bits *= 2
    return bits, max(1, -(-need // bits))


def _picked(lines: DataFrame, twice: np.ndarray, least: int, read) -> DataFrame:
    """(key, doc_id) of the lines that ``twice`` may hold."""
    bits = 8 * len(twice)
    twice = lines.sparkSession.sparkContext.broadcast(twice)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys in read(batches, least):
            may = _has(twice.value, _probes(keys, bits)) if len(keys) else np.zeros(0, bool)
            raw = keys[may].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([raw[i:i + 16] for i in range(0, len(raw), 16)], pa.binary()), ids.filter(pa.array(may))], ["key", "doc_id"])
    return mapped(lines, pick, "key binary, doc_id long")


def _key_table(docs: DataFrame, least: int) -> DataFrame:
    """hi, lo (halves of a line's key) and doc_id, sorted by lo within each task."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys in _text_keys(batches, least):
            keys = keys.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), ids], ["hi", "lo", "doc_id"])
    return stored(mapped(docs, write, "hi long, lo long, doc_id long").sortWithinPartitions("lo"), "line-keys")


def suspects(docs: DataFrame, bits: int, ranges: int = 1, least: int = LEAST_LENGTH) -> DataFrame:
    """(key, doc_id) of the lines that a twice-seen filter may hold."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if ranges == 1:
        return _picked(docs, repeats_filter(docs.select("text"), bits, least), least, _text_keys)
    keys = _key_table(docs, least)
    path = new_path(docs.sparkSession, "suspects")
    ends = [-(1 << 63) + (i << 64) // ranges for i in range(ranges + 1)]
    for first, end in zip(ends, ends[1:], strict=False):
        own = keys.filter(F.col("lo").between(first, end - 1))
        _picked(own, repeats_filter(own, bits, least, _written_keys), least, _written_keys).write.mode("append").parquet(path)
    return docs.sparkSession.read.schema("key binary, doc_id long").parquet(path)


def dedup(docs: DataFrame, least_docs: int = LEAST_DOCS, least_length: int = LEAST_LENGTH, max_keys: int = MAX_KEYS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, n_lines, n_dropped and the kept text of every document."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    suspected = suspects(docs, *filter_size(docs, max_bits), least_length).distinct()
    confirmed = stored(suspected.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep"))
                       .filter(F.col("n") >= least_docs).select("key", "keep"), "repeated-lines")
    few = confirmed.count() <= max_keys
    keepers = spark.sparkContext.broadcast({bytes(r.key): r.keep for r in confirmed.collect()} if few else None)
    if few:
        given = docs.select("doc_id", "text")
    else:
        lost = (suspected.join(confirmed, "key")
                .filter(~F.col("doc_id").eqNullSafe(F.col("keep")))
                .groupBy(F.col("doc_id").alias("id")).agg(F.collect_set("key").alias("lost")))
        given = docs.join(lost, F.col("doc_id").eqNullSafe(F.col("id")), "left").select("doc_id", "text", "lost")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        for b in chunks(batches):
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()
            lists = b.column("lost").to_pylist() if keepers.value is None else [None] * len(ids)
            n_lines, n_dropped, kept = [], [], []
            for i, text, lost in zip(ids, texts, lists, strict=True):
                lost = set(lost or ())
                lines = (text or b"").split(b"\n")
                stay = []
                for line in lines:
                    if (k := key_of(line, least_length)) is not None:
                        k = xxh3_128_digest(k)
                        if k in lost if keepers.value is None else k in keepers.value and keepers.value[k] != i:
                            continue
                    stay.append(line)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.utf8())],
                ["doc_id", "n_lines", "n_dropped", "text"])
    return mapped(given, strip, "doc_id long, n_lines long, n_dropped long, text string")


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``."""
    kept = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
