"""Token ids of documents in a compressed, indexed binary format.

A file set is a folder with two Parquet tables.  ``dictionary``: one row with
the zstandard dictionary, trained on a bounded sample of serialised id arrays,
and its SHA-256.  ``blocks``: rows in ascending doc_id order; a block holds
some documents' frames one after the other, their offsets, doc_ids and token
counts, and the dictionary's hash.  Each document is a frame of its own
(little-endian unsigned 32-bit ids), so reading one decompresses one.

Null texts count as empty and hold only the end id.  A null doc_id comes
before all others; rows with equal doc_ids are kept, in order of their
checksum; further columns are ignored; an empty table gives an empty set."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import pretokens
from .work import mapped, new_path, stored

#: Fixed value: the id that ends each document.
END = 2
#: Documents of the dictionary's sample, bytes taken of each, bytes of the dictionary.
SAMPLE_DOCS = 512
SAMPLE_BYTES = 1 << 14
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
#: A block's documents and bytes at most (one larger document is a block alone).
BLOCK_DOCS = 1024
BLOCK_BYTES = 1 << 22

BLOCKS = ("part int, seq long, dictionary string, first_id long, last_id long, n_tokens long, doc_ids array<long>, sizes array<long>, "
          "offsets array<long>, frames binary")


def serialised(ids: np.ndarray) -> bytes:
    return np.append(ids, END).astype("<u4").tobytes()


def trained(samples: list[bytes]) -> bytes:
    """A dictionary for the samples; with too few to train on, their text itself."""
    import zstandard
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def codec(dictionary: bytes):
    import zstandard
    magic = dictionary[:4] == (0xEC30A437).to_bytes(4, "little")
    kind = zstandard.DICT_TYPE_FULLDICT if magic else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(dictionary, dict_type=kind) if len(dictionary) >= 8 else None


def _sample(docs: DataFrame, content, kind: str) -> list[bytes]:
    ids = [r.doc_id for r in docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).collect()]

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens, at in pretokens.encoded(batches, content.value, kind):
            yield pa.RecordBatch.from_arrays([pa.array(
                [serialised(tokens[a:b])[:SAMPLE_BYTES] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], ["ids"])
    rows = mapped(docs.filter(F.col("doc_id").isin([i for i in ids if i is not None])), take, "ids binary")
    return sorted(bytes(r.ids) for r in rows.limit(4 * SAMPLE_DOCS).collect())


def write_tokens(docs: DataFrame, folder: str, vocabulary: str) -> None:
    """Encode every document and write the file set."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    content, kind = pretokens.vocabulary(spark, vocabulary)
    dictionary = trained(_sample(docs, content, kind))
    sha = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(sha, bytearray(dictionary))], "sha256 string, dictionary binary").write.parquet(f"{folder}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=codec(shared.value), write_checksum=True)
        for b, tokens, at in pretokens.encoded(batches, content.value, kind):
            raw = [serialised(tokens[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(r) // 4 for r in raw], pa.int64()), pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                 pa.array([packer.compress(r) for r in raw], pa.binary())], ["doc_id", "n_tokens", "crc", "frame"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        ids, sizes, frames, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            row = lambda x: pa.array([x], pa.list_(pa.int64()))
            known = [i for i in ids if i is not None]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([sha]), pa.array([min(known, default=None)], pa.int64()),
                 pa.array([max(known, default=None)], pa.int64()), pa.array([sum(sizes)], pa.int64()), row(ids), row(sizes),
                 row([0, *np.cumsum([len(f) for f in frames]).tolist()]), pa.array([b"".join(frames)], pa.binary())],
                ["part", "seq", "dictionary", "first_id", "last_id", "n_tokens", "doc_ids", "sizes", "offsets", "frames"])
        for b in batches:
            for i, n, f in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n_tokens", "frame")), strict=True):
                if ids and (len(ids) >= BLOCK_DOCS or held + len(f) > BLOCK_BYTES):
                    yield block()
                    ids, sizes, frames, held, seq = [], [], [], 0, seq + 1
                ids.append(i)
                sizes.append(n)
                frames.append(f)
                held += len(f)
        if ids:
            yield block()

    frames = stored(mapped(docs, encode, "doc_id long, n_tokens long, crc long, frame binary"), "frames")
    frames = frames.repartitionByRange("doc_id", "crc").sortWithinPartitions("doc_id", "crc")
    mapped(frames.select("doc_id", "n_tokens", "frame"), pack, BLOCKS).write.parquet(f"{folder}/blocks")


def _dictionary(spark: SparkSession, folder: str):
    row = spark.read.parquet(f"{folder}/dictionary").first()
    data = bytes(row.dictionary)
    if hashlib.sha256(data).hexdigest() != row.sha256:
        raise ValueError("the dictionary does not match its hash")
    return spark.sparkContext.broadcast((row.sha256, data))


def read_tokens(spark: SparkSession, folder: str, doc_ids: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """part, seq, doc_id, local (ids of the block before it), n_tokens, ids_crc32
    and, on request, ids.  ``doc_ids``: only these (their blocks' other
    frames are not decompressed)."""
    shared = _dictionary(spark, folder)
    wanted = None if doc_ids is None else frozenset(doc_ids)
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    if wanted:
        blocks = blocks.filter(F.exists(F.array(*[F.lit(i) for i in wanted]), lambda i: (i >= F.col("first_id")) & (i <= F.col("last_id"))))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        sha, dictionary = shared.value
        opener = zstandard.ZstdDecompressor(dict_data=codec(dictionary))
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in ("part", "seq", "dictionary", "doc_ids", "sizes", "offsets", "frames")}
                if r["dictionary"] != sha:
                    raise ValueError("a block was written with another dictionary")
                use = [i for i, d in enumerate(r["doc_ids"]) if wanted is None or d in wanted]
                raw = [opener.decompress(r["frames"][r["offsets"][i]:r["offsets"][i + 1]]) for i in use]
                before = np.r_[0, np.cumsum(r["sizes"])]
                cols = [pa.array([r["part"]] * len(use), pa.int32()), pa.array([r["seq"]] * len(use), pa.int64()),
                        pa.array([r["doc_ids"][i] for i in use], pa.int64()), pa.array(before[use].tolist() if use else [], pa.int64()),
                        pa.array([len(x) // 4 for x in raw], pa.int64()), pa.array([zlib.crc32(x) for x in raw], pa.int64())]
                if with_ids:
                    cols.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in raw], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names)
    names = ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    schema = "part int, seq long, doc_id long, local long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return mapped(blocks.select("part", "seq", "dictionary", "doc_ids", "sizes", "offsets", "frames"), unpack, schema)


def starts(spark: SparkSession, folder: str) -> DataFrame:
    """(part, seq, before): ids of all blocks before each.  Sums go over the
    parts first, so only one row a part meets in one task."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").select("part", "seq", "n_tokens")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return (blocks.withColumn("here", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part")
            .select("part", "seq", (F.col("base") + F.col("here")).alias("before")))


def token_file(docs: DataFrame, vocabulary: str, folder: str | None = None) -> DataFrame:
    """Write the documents and read them back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")
    write_tokens(docs, folder, vocabulary)
    return (read_tokens(spark, folder, with_ids=False).join(starts(spark, folder), ["part", "seq"])
            .select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"))


def op4_token_file(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``."""
    import public_tokenizers
    return token_file(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
