"""Near-duplicates by BagMinHash signatures, bands and exact verification.

A document is the multiset of its shingles of five words.  For each shingle
the integer weight range is covered by a tower of intervals (0,1], (1,2],
(2,4], (4,8], ...; each carries a Poisson process of its own, whose points
have a time, a signature component and a weight level found by halving the
interval.  A document sees the points up to its weight of the shingle; the
first point of each component is its signature, and two signatures agree in a
component with the probability of the weighted Jaccard similarity.
Generation stops as soon as no later point can come first.

Documents of equal words are one node.  Nodes that share a band's bucket are
candidates; within a bucket all are compared with a leader (the node that
shares most buckets), so a large group costs links in proportion to its size.
A bucket that then holds several components, if its nodes are FEW, has them
compared across components.  The nodes of larger ones are put, once for each
node, into buckets of their rarest shingles, which loses no pair (see
``_rarest``).  Of these, buckets that are large and open again are split by
the shingles that their nodes have beyond the leader's (see ``_split``), and
the smaller buckets are treated alike; what is open at the end is compared
across components, so no pair that shares a bucket stays open.
Similarity is verified exactly: shingles are numbered by occurrence, so the
multisets are sets.  Components come from alternating star contraction.

Texts of fewer than five words, but not none, are one shingle.  Texts without
words are alike only if they are equal; null and empty ones are never alike.
A null doc_id is smaller than all others; rows that repeat are copies; further
columns are ignored; an empty table gives an empty result.  Nodes are 64-bit
hashes of the word sequence."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .work import free_name, mapped, stored

#: Words of a shingle, least similarity, bands and components of a band: at a
#: similarity of 0.8 a pair shares no bucket once in 30,000 times.
SHINGLE = 5
SIMILARITY = 0.8
BANDS = 26
ROWS = 5
#: Rows of ids that are broadcast at most.
MOST_IDS = 1_000_000
#: Nodes of an open bucket that are compared with each other directly.
FEW = 16
#: Slots in which common shingles are counted (a table of 2 MB for each worker), and the
#: share of a task's nodes that makes a shingle common there.
SLOTS = 1 << 18
COMMON = 1 / 256
#: Rounds with leaders before all open pairs are compared.
LEADER_ROUNDS = 3

_STEP = np.uint64(0xD1342543DE82EF95)


def shingles(h: np.ndarray, first: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all shingles of rows of word hashes."""
    n = np.diff(first)
    m = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    row = np.repeat(np.arange(len(n)), m)
    start = first[row] + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
    return row, words.segment_hashes(h, start, np.minimum(start + size, first[row + 1]))


def multiset(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, count) of the distinct shingles of each row."""
    if not len(h):
        return row, h, np.zeros(0, np.int64)
    key = words.mix(h + row.astype(np.uint64) * _STEP)
    order = np.argsort(key)
    new = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
    return row[order[new]], h[order[new]], np.diff(np.r_[new, len(h)])


def bag_min_hash(row: np.ndarray, h: np.ndarray, weight: np.ndarray, rows: int, m: int = BANDS * ROWS) -> np.ndarray:
    """Signatures (rows x m) of multisets: the time of the first point of each component."""
    out = np.full(rows * m, np.inf)
    # Intervals of each element: one for weight 1, and one more for each power of two that is begun.
    n = np.ones(len(h), np.int64)
    heavy = np.flatnonzero(weight > 1)
    n[heavy] = 1 + np.ceil(np.log2(weight[heavy])).astype(np.int64)
    e = np.repeat(np.arange(len(h)), n)
    j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    low = np.where(j > 0, 1 << np.maximum(j - 1, 0), 0)
    width = np.where(j > 0, low, 1)
    key, row, most = words.mix(h[e] ^ words.mix(j.astype(np.uint64) + np.uint64(11))), row[e], weight[e] - low
    x, k = np.zeros(len(key)), 0
    while len(key):
        g = int(min(64, max(1, (1 << 15) // len(key))))
        r = words.mix(key[:, None] + (np.arange(k + 1, k + g + 1, dtype=np.uint64) * _STEP)[None, :])
        step = -np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
        at = x[:, None] + np.cumsum(step / width[:, None], axis=1)
        r = words.mix(r ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        part = ((r >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        ok = (at < out.reshape(rows, m).max(axis=1)[row][:, None])
        if (width > 1).any():
            level = ((r & np.uint64(0xFFFFFFFF)) * width.astype(np.uint64)[:, None] >> np.uint64(32)).astype(np.int64)
            ok &= level < most[:, None]
        np.minimum.at(out, (row[:, None] * m + part)[ok], at[ok])
        x, k = at[:, -1], k + g
        on = x < out.reshape(rows, m).max(axis=1)[row]
        key, x, row, most, width = key[on], x[on], row[on], most[on], width[on]
    return out.reshape(rows, m)


def band_hashes(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit hash for each band."""
    parts = signatures.astype(np.float32).view(np.uint32).astype(np.uint64).reshape(len(signatures), bands, -1)
    acc = np.tile(words.mix(np.arange(bands, dtype=np.uint64) + np.uint64(5)), (len(signatures), 1))
    for i in range(parts.shape[2]):
        acc = words.mix(acc + parts[:, :, i])
    return acc


def with_hash(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of the text; both tell the rows apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_hash"))


def _small(ids: DataFrame) -> DataFrame:
    """For a join: broadcast while there are few rows of ids (at most 24 MB), else left to a shuffle."""
    return F.broadcast(ids) if ids.count() <= MOST_IDS else ids


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, node, n (shingles), bands."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in words.chunks(batches):
            h, first = words.word_hashes(b.column("text"))
            nodes = words.segment_hashes(h, first[:-1], first[1:]).view(np.int64)
            row, sh = shingles(h, first)
            row, sh, n = multiset(row, sh)
            total = np.bincount(row, n, b.num_rows).astype(np.int64)
            some = np.flatnonzero(total)
            at = np.zeros(b.num_rows, np.int64)
            at[some] = np.arange(len(some))
            bands = band_hashes(bag_min_hash(at[row], sh, n, len(some))).view(np.int64) if len(some) else np.zeros((0, BANDS), np.int64)
            # Texts without words: their own bytes, unless they are empty.
            empty = np.diff(words.utf8(b.column("text"))[1]) == 0
            plain = b.column("text_hash").to_numpy(zero_copy_only=False)
            nodes = np.where(total > 0, nodes, plain)
            length = np.where(total > 0, BANDS, 0)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(nodes, pa.int64(), mask=empty), pa.array(total, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)], pa.int32()), pa.array(bands.ravel()))],
                ["doc_id", "text_hash", "node", "n", "bands"])
    return mapped(with_hash(docs), sign, "doc_id long, text_hash long, node long, n long, bands array<long>")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """node, s: each node's shingles, numbered by occurrence, as a set."""
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in words.chunks(batches):
            row, sh, n = multiset(*shingles(*words.word_hashes(b.column("text"))))
            e = np.repeat(np.arange(len(n)), n)
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            s, row = words.mix(sh[e] + nth.astype(np.uint64) * _STEP).view(np.int64), row[e]
            order = np.argsort(row, kind="stable")
            at = np.searchsorted(row[order], np.arange(b.num_rows + 1))
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(s[order]))], ["node", "s"])
    return mapped(texts.select("node", "text"), take, "node long, s array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of the edges (u, v): the least node of each component."""
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    e = stored(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    last = state(e)
    while last[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        e = stored(small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = state(e)
        if now == last:
            break
        last = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def joined(found: DataFrame | None, edges: DataFrame) -> DataFrame:
    """(node, component) with further edges (u, v): only the components that
    they connect are contracted again."""
    if found is None:
        return stored(components(edges), "components")
    if edges.isEmpty():
        return found
    of = lambda n: found.select(F.col("node").alias(n), F.col("component").alias(f"of_{n}"))
    ends = edges.join(of("u"), "u", "left").join(of("v"), "v", "left").select(F.coalesce("of_u", "u").alias("u"), F.coalesce("of_v", "v").alias("v"))
    upper = stored(components(ends), "upper")
    raised = found.join(upper.select(F.col("node").alias("component"), F.col("component").alias("upper")), "component", "left")
    return stored(raised.select("node", F.coalesce("upper", "component").alias("component"))
                  .unionByName(upper.join(found, "node", "left_anti")), "components")


def verified(pairs: DataFrame, sets: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs (u, v) whose multisets overlap enough."""
    a, b = sets.select(F.col("node").alias("u"), F.col("s").alias("su")), sets.select(F.col("node").alias("v"), F.col("s").alias("sv"))
    both = F.size(F.array_intersect("su", "sv"))
    return (pairs.join(a, "u").join(b, "v").withColumn("both", both)
            .filter(F.col("both") >= F.lit(least) * (F.size("su") + F.size("sv") - F.col("both"))).select("u", "v"))


def _fit(n: str, m: str, least: float) -> F.Column:
    """Multisets of sizes this different can't be similar enough."""
    return F.least(n, m) >= F.lit(least) * F.greatest(n, m)


def _commonness(sets: DataFrame) -> np.ndarray:
    """For each slot about how many nodes hold its shingles.  It only puts
    shingles in an order, so counts that tasks leave out cost time, not links."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, nodes = np.zeros(SLOTS, np.int64), 0
        for b in batches:
            n += np.bincount(b.column("s").flatten().to_numpy().view(np.uint64) & np.uint64(SLOTS - 1), minlength=SLOTS)
            nodes += b.num_rows
        at = np.flatnonzero(n >= max(2, COMMON * nodes))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["slot", "c"])
    out = np.zeros(SLOTS, np.int64)
    for r in mapped(sets.select("s"), count, "slot int, c long").groupBy("slot").agg(F.sum("c").alias("c")).toLocalIterator():
        out[r.slot] = r.c
    return out


def _rarest(buckets: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Rows (bucket, node, n, degree, component) that hold every link still to be
    found among the nodes of open buckets (the same columns, v and m).

    Multisets of n and m shingles that are similar share c * (n + m) or more of
    them.  In one order of all shingles, the first that they share is then among
    the first n - c * (n + m) + 1 of each; m is no less than least * n and the
    least size met in a bucket.  The order is from rare to common, so a passage
    that many documents hold makes no bucket unless they hold little else."""
    c = least / (1 + least)
    smallest = buckets.groupBy("bucket").agg(F.min("n").alias("smallest"))
    nodes = buckets.join(smallest, "bucket").groupBy("node").agg(
        F.first("n").alias("n"), F.first("degree").alias("degree"), F.first("component").alias("component"), F.min("smallest").alias("smallest"))
    taken = F.col("n") - F.ceil(F.lit(c) * (F.col("n") + F.greatest(F.lit(least) * F.col("n"), F.col("smallest"))) - F.lit(1e-9)) + 1
    nodes = stored(nodes.select("node", "n", "degree", "component", F.greatest(F.lit(1), taken).cast("int").alias("taken")).join(sets, "node"), "wide")
    common = buckets.sparkSession.sparkContext.broadcast(_commonness(nodes))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, first = b.column("s").flatten().to_numpy(), np.r_[0, np.cumsum(b.column("s").value_lengths().to_numpy())]
            row = np.repeat(np.arange(b.num_rows), np.diff(first))
            order = np.lexsort((s, common.value[s.view(np.uint64) & np.uint64(SLOTS - 1)], row))
            keep = np.arange(len(s)) - first[row] < b.column("taken").to_numpy()[row]
            of = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays([pa.array(s[order][keep])] + [b.column(x).take(of) for x in ("node", "n", "degree", "component")],
                                             ["bucket", "node", "n", "degree", "component"])
    rare = stored(mapped(nodes, put, "bucket long, node long, n long, degree long, component long"), "rarest")
    return _mixed(rare)


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components."""
    mixed = rows.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a != b").select("bucket")
    return rows.join(mixed, "bucket").select("bucket", "node", "n", "degree", "component")


def _split(buckets: DataFrame, sets: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(rows, pairs) that hold every link still to be found in open buckets
    (bucket, node, n, degree, component, v, m: the leader and its size).

    Let i be the overlap of a node with the leader.  If two nodes share no
    shingle outside the leader's, each has their whole overlap in its own i;
    so both i must reach the overlap that their sizes ask for.  Hence two
    nodes either share a shingle outside the leader, and meet in the smaller
    bucket of that shingle, or each is small enough for the other's i.

    A node of n shingles shares at least c * (n + m) with any similar one of m,
    so t = c * (n + m) - i or more of them outside the leader; m is no less
    than least * n and the least size met with that leader.  In one order of all
    shingles, the first that two nodes share outside it is then among the first
    d - t + 1 of their d: a node is put into those buckets only."""
    c = least / (1 + least)
    a, b = sets.select("node", F.col("s").alias("su")), sets.select(F.col("node").alias("v"), F.col("s").alias("sv"))
    apart = stored(buckets.filter("node != v").select("node", "v", "degree", "component").distinct().join(a, "node").join(b, "v").select(
        "node", "v", "degree", "component", F.size("su").alias("n"), F.size(F.array_intersect("su", "sv")).alias("i"), F.array_except("su", "sv").alias("d")), "apart")
    smallest = buckets.groupBy("v").agg(F.min("n").alias("smallest"))
    shared = F.lit(c) * (F.col("n") + F.greatest(F.lit(least) * F.col("n"), F.col("smallest")))
    t = F.greatest(F.lit(1), F.ceil(shared - F.col("i") - F.lit(1e-9)).cast("int"))
    prefix = F.slice(F.array_sort("d"), F.lit(1), F.greatest(F.lit(0), F.size("d") - t + 1))
    finer = stored(apart.join(smallest, "v").select("node", "n", "degree", "component", F.explode(F.transform(prefix, lambda s: F.xxhash64("v", s))).alias("bucket")), "finer")
    rows = _mixed(finer)
    cap = F.floor(F.col("i") / F.lit(c) + F.lit(1e-9)) - F.col("n")
    sized = buckets.join(apart.select("node", "v", "i"), ["node", "v"]).select(
        "bucket", "node", "n", "component", cap.alias("cap"), (F.col("i") < F.lit(c) * (F.col("n") + F.col("m"))).alias("away"))
    limits = sized.groupBy("bucket").agg(F.min("n").alias("least_n"), F.max(F.when(F.col("away"), F.col("cap"))).alias("most_cap")).filter("most_cap >= least_n")
    sized = stored(sized.join(limits, "bucket"), "sized")
    left = sized.filter("away and cap >= least_n").select("bucket", F.col("node").alias("p"), F.col("n").alias("pn"), F.col("cap").alias("pc"), F.col("component").alias("pk"))
    right = sized.filter("n <= most_cap").select("bucket", F.col("node").alias("q"), F.col("n").alias("qn"), F.col("cap").alias("qc"), F.col("component").alias("qk"))
    pairs = left.join(right, "bucket").filter("pk != qk and qn <= pc and pn <= qc").select(F.least("p", "q").alias("u"), F.greatest("p", "q").alias("v"))
    return rows, pairs.distinct()


def links(rows: DataFrame, sets: DataFrame, least: float = SIMILARITY, rounds: int = LEADER_ROUNDS) -> DataFrame:
    """(node, component) of all nodes that are similar to one with which they
    share a bucket.  rows: bucket, node, n, degree."""
    found, rest = None, None
    rows = rows.withColumn("component", F.col("node"))
    for k in range(rounds + 1):
        leader = rows.groupBy("bucket").agg(F.max(F.struct("degree", "node", "n", "component")).alias("x"), F.count(F.lit(1)).alias("k")).select(
            "bucket", F.col("x.node").alias("v"), F.col("x.n").alias("m"), F.col("x.component").alias("of"), "k")
        if k < rounds:
            pairs = rows.join(leader, "bucket").filter(F.col("component") != F.col("of"))
        else:
            # The components in a bucket but its largest, against all others in it.
            each = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("c"))
            largest = each.groupBy("bucket").agg(F.max(F.struct("c", "component")).alias("x")).select("bucket", F.col("x.component").alias("of"))
            minor = rows.join(largest, "bucket").filter("component != of").select("bucket", F.col("node").alias("v"), F.col("n").alias("m"), F.col("component").alias("of"))
            pairs = rows.join(minor, "bucket").filter(F.col("component") != F.col("of"))
        pairs = pairs.filter(_fit("n", "m", least)).select(F.least("node", "v").alias("u"), F.greatest("node", "v").alias("v"))
        pairs = pairs if rest is None else pairs.unionByName(rest)
        new = stored(verified(pairs.distinct(), sets, least), "links")
        found = joined(found, new)
        if k == rounds:
            break
        now = rows.drop("component").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        # Open: more than the leader and another, in more than one component.
        open_ = now.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a != b").select("bucket")
        now = stored(now.join(open_, "bucket").join(leader.filter("k > 2").select("bucket", "v", "m"), "bucket"), "open")
        if now.isEmpty():
            break
        now = stored(now.join(now.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")), "bucket"), "sized")
        large = now.filter(F.col("size") > FEW).drop("size")
        rows, rest = (_rarest(large, sets, least), None) if k == 0 else _split(large, sets, least)
        few = now.filter((F.col("size") <= FEW) & (F.col("node") != F.col("v")))
        p, q = (few.select("bucket", F.col("node").alias(x), F.col("n").alias(f"{x}n"), F.col("component").alias(f"{x}k")) for x in "pq")
        direct = p.join(q, "bucket").filter((F.col("p") < F.col("q")) & (F.col("pk") != F.col("qk")) & _fit("pn", "qn", least)).select(F.col("p").alias("u"), F.col("q").alias("v"))
        rows, rest = stored(rows, "rows"), stored(direct.distinct() if rest is None else rest.unionByName(direct.distinct()), "rest")
    return found


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, class_id (least doc_id of its class), class_hash (that
    document's text_hash), class_size, for every document."""
    rows = stored(signed(docs), "signed")
    nodes = stored(rows.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")), "nodes")
    each = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = stored(each.join(shared, "bucket"), "shared")
    degree = shared.groupBy("node").agg(F.sum("c").alias("degree"))
    buckets = stored(shared.join(degree, "node").select("bucket", "node", "n", "degree"), "buckets")
    wanted = stored(nodes.join(degree.select("node"), "node", "left_semi").select("node", F.col("rep.doc_id").alias("id"), F.col("rep.text_hash").alias("hash")), "wanted")
    d = with_hash(docs)
    texts = d.join(_small(wanted), d.doc_id.eqNullSafe(wanted.id) & (d.text_hash == wanted.hash)).select("node", "text")
    sets = shingle_sets(texts)
    if not rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").isEmpty():
        sets = sets.groupBy("node").agg(F.first("s").alias("s"))  # rows that repeat
    sets = stored(sets, "shingles")
    found = links(buckets, sets, least)
    of = nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "rep", "copies")
    whole = of.groupBy("component").agg(F.min("rep").alias("rep"), F.sum("copies").alias("size"))
    of = of.select("node", "component").join(whole, "component").select(F.col("node").alias("of"), "rep", "size")
    return rows.join(of, rows.node == of.of, "left").select(
        "doc_id", "text_hash", F.when(F.col("rep").isNull(), F.col("doc_id")).otherwise(F.col("rep.doc_id")).alias("class_id"),
        F.coalesce("rep.text_hash", "text_hash").alias("class_hash"), F.coalesce("size", F.lit(1)).cast("long").alias("class_size"))


def representatives(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The documents (all columns) that stay: of each class the one with the least doc_id."""
    found = stored(classes(docs, least), "classes")
    first = F.col("class_id").eqNullSafe(F.col("doc_id")) & (F.col("class_hash") == F.col("text_hash"))
    # Names that no column of the documents has.
    id_, hash_, own = (free_name(docs, x) for x in ("__id", "__hash", "__text_hash"))
    key = [F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)]
    lost = stored(found.filter(~first).select(*key).distinct(), "lost")
    again = found.filter(first & (F.col("class_size") > 1)).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(id_, hash_)
    d = docs.withColumn(own, F.xxhash64(F.col("text").cast("string")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(hash_))
    kept = d.join(_small(lost), same, "left_anti")
    if not again.isEmpty():
        # The document that stays is there in several equal rows: one of them does.
        again = stored(again, "again")
        kept = kept.join(again, same, "left_anti").unionByName(d.join(again, same, "left_semi").dropDuplicates(["doc_id", own]))
    return kept.drop(own)


def op2_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``."""
    found = classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "class_id", "class_size", (F.col("class_id").eqNullSafe(F.col("doc_id")) & (F.col("class_hash") == F.col("text_hash"))).alias("stays"))
