"""Trie of conversation prefixes from vertical bitmaps.

Conversations are dealt by ranges of conv_id and cut into shards of bounded
size.  A shard holds a bitset of its conversations for every (position, turn)
that occurs.  From the root on, depth first, a node's bitset is intersected
with the posting of the next turn of its first remaining conversation: that is
a child, its popcount the number of members; what ended before is the end list.

The nodes of all shards are merged by a hash of their prefix: members add up,
the smallest member is the least.  Sums over subtrees need each node once:

* A node that one shard alone has keeps the sums of that shard, for all below
  it lies in the same shard.
* A node of several shards is counted by the first of them.  Each shard adds
  up, for the nodes that it shares, what it counts there and what its own
  private children hold; the shards' parts are summed by node.

So no step goes through the depths one by one and none sees all conversations.
End lists are hashed as a stream in order of the shards.

A conversation's turns come in order of turn (null first), then role and hash
of the text; a null role or text counts as empty; repeated rows are turns of
their own; rows with a null conv_id belong to no conversation and are left out;
further columns are ignored; an empty table has no nodes, not even a root.
Turns and prefixes are told apart by 256- and 128-bit hashes.  One
conversation's turns (40 bytes each) have to fit in a task."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import mapped, stored

#: Conversations and turns from which a shard ends with the next block of ids.
CONVERSATIONS, TURNS = 4096, 1 << 18
#: Conversations of a block, and the turns that they may borrow are fewer than this.
BLOCK, BORROWED = 100, 6

_LOCAL = ("shard long, seq int, up int, a long, b long, pa long, pb long, depth long, first long, n long, chars long, kids long, "
          "leaves long, once long, total long, ends string")


def turns(rows: DataFrame) -> DataFrame:
    """base, conv_id, turn, role, said (hash of role and text), chars."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    c = F.col("conv_id").cast("long")
    return rows.filter(c.isNotNull()).select(
        (c - c % BLOCK).alias("base"), c.alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("said"), F.length(text).cast("long").alias("chars"))


def borrowed(conv_id: int) -> int:
    return crc32(str(conv_id).encode()) % BORROWED


def _shards(batches: Iterator[pa.RecordBatch], most: int = CONVERSATIONS) -> Iterator[list[tuple[int, list]]]:
    """Lists of (conv_id, rebuilt turns), by conv_id, from rows in order of
    block, with the block's first conversation at its head."""
    shard, size, base, now, own, head = [], 0, None, None, [], []

    def close() -> None:
        nonlocal head, size
        if now == base:
            head = own[:BORROWED]
        h = borrowed(now)
        shard.append((now, own if now == base else head[:h] + own[h:]))
        size += len(shard[-1][1])
    for b in batches:
        for of, conv_id, said, chars in zip(*(b.column(c).to_pylist() for c in ("base", "conv_id", "said", "chars")), strict=True):
            if (of, conv_id) != (base, now):
                if now is not None:
                    close()
                if of != base:
                    if len(shard) >= most or size >= TURNS:
                        yield sorted(shard, key=lambda c: c[0])
                        shard, size = [], 0
                    base, head = of, []
                now, own = conv_id, []
            own.append((said, chars))
    if now is not None:
        close()
        yield sorted(shard, key=lambda c: c[0])


def _bits(x: int) -> Iterator[int]:
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


def local_trie(shard: list[tuple[int, list]]) -> list[tuple]:
    """The nodes of a shard, parents before children: seq, up (the parent's
    seq), key, the parent's key, depth, first member, members, characters of the
    last text, children, and over the subtree: childless nodes, characters,
    characters times members; and the end list."""
    posting: dict[tuple[int, bytes], int] = defaultdict(int)
    ended: dict[int, int] = defaultdict(int)
    for i, (_, said) in enumerate(shard):
        for d, (turn, _) in enumerate(said):
            posting[d, turn] |= 1 << i
        ended[len(said)] |= 1 << i
    root = bytes(16)
    nodes, stack = [], [((1 << len(shard)) - 1, 0, root, root, -1, 0)]
    while stack:
        members, d, key, above, up, chars = stack.pop()
        ends = members & ended[d]
        seq, rest, kids = len(nodes), members ^ ends, 0
        nodes.append([seq, up, key, above, d, shard[(members & -members).bit_length() - 1][0], members.bit_count(), chars, 0, 0, chars, chars * members.bit_count(),
                      ",".join(str(shard[i][0]) for i in _bits(ends)) if ends else None])
        while rest:
            turn, n = shard[(rest & -rest).bit_length() - 1][1][d]
            child = rest & posting[d, turn]
            rest ^= child
            kids += 1
            stack.append((child, d + 1, hashlib.blake2b(key + turn, digest_size=16).digest(), key, seq, n))
        nodes[seq][8], nodes[seq][9] = kids, int(not kids)
    for x in reversed(nodes):
        if x[1] >= 0:
            for k in (9, 10, 11):
                nodes[x[1]][k] += x[k]
    return nodes


def _local(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    half = lambda k, i: int.from_bytes(k[8 * i:8 * i + 8], "big", signed=True)
    schema = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[c.split()[1]]) for c in _LOCAL.split(", ")])
    for shard in _shards(batches, most):
        nodes = local_trie(shard)
        for i in range(0, len(nodes), 1 << 14):
            rows = [(shard[0][0], seq, up, half(key, 0), half(key, 1), half(above, 0), half(above, 1), *rest) for seq, up, key, above, *rest in nodes[i:i + (1 << 14)]]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _shared_sums(t: pa.Table) -> pa.Table:
    """A shard's part of the subtree sums of the nodes that it shares."""
    rows = sorted(t.select(["seq", "up", "a", "b", "leaves", "once", "chars", "kids", "owned", "childless"]).to_pylist(), key=lambda r: -r["seq"])
    leaves, once = defaultdict(int), defaultdict(int)
    out = []
    for r in rows:
        # What is counted here, and what private children hold: all but this node and its shared children.
        leaves[r["seq"]] += (r["owned"] and r["childless"]) + r["leaves"] - (r["kids"] == 0)
        once[r["seq"]] += (r["chars"] if r["owned"] else 0) + r["once"] - r["chars"]
        out.append((r["a"], r["b"], leaves[r["seq"]], once[r["seq"]]))
        leaves[r["up"]] += leaves[r["seq"]] - r["leaves"]
        once[r["up"]] += once[r["seq"]] - r["once"]
    return pa.table([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b", "leaves", "once"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of node and shard: one hash for each node's end lists in a row."""
    now, sha = None, None
    out: list[tuple] = []

    def flushed() -> pa.RecordBatch:
        rows = list(zip(*out, strict=True)) or [[], [], []]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.string())], ["a", "b", "ends_sha256"])
    for batch in batches:
        for key in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ends")), strict=True):
            if key[:2] != now:
                if now is not None:
                    out.append((*now, sha.hexdigest()))
                now, sha = key[:2], hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(key[2].encode())
        yield flushed()
    if now is not None:
        out.append((*now, sha.hexdigest()))
    yield flushed()


def prefix_trie(conversations: DataFrame, most: int = CONVERSATIONS) -> DataFrame:
    """One row for each node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  ``most``: the
    conversations from which a shard ends with the next block."""
    said = turns(conversations).repartitionByRange("base").sortWithinPartitions(
        "base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "role", "said")
    local = stored(mapped(said.select("base", "conv_id", "said", "chars"), lambda batches: _local(batches, most), _LOCAL), "trie")
    key = ["a", "b"]
    nodes = stored(local.groupBy(*key).agg(
        F.min("first").alias("conv_id"), F.sum("n").alias("n_convs"), F.count(F.lit(1)).alias("shards"), F.min("shard").alias("owner"), F.min("depth").alias("depth"),
        F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.sum("total").alias("total"), F.min("leaves").alias("leaves"), F.min("once").alias("once")), "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, key, "left"), "nodes")
    shared = nodes.filter("shards > 1").select(*key, "owner", F.col("n_children").isNull().alias("childless"))
    parts = local.join(shared, key).withColumn("owned", F.col("shard") == F.col("owner")).groupBy("shard").applyInArrow(_shared_sums, "a long, b long, leaves long, once long")
    sums = parts.groupBy(*key).agg(F.sum("leaves").alias("all_leaves"), F.sum("once").alias("all_once"))
    ends = mapped(local.filter("ends is not null").select(*key, "shard", "ends").repartition(*key).sortWithinPartitions(*key, "shard").select(*key, "ends"),
                  _digests, "a long, b long, ends_sha256 string")
    above = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(sums, key, "left").join(ends, key, "left").join(above, ["pa", "pb"], "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.coalesce("all_leaves", "leaves").alias("n_leaves"), (F.col("total") - F.coalesce("all_once", "once")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """All ``conversations``, rebuilt as their blocks say."""
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
