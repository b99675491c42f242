"""Near-duplicates by SimHash fingerprints and the generalised pigeonhole principle.

A fingerprint's bit is set if it is set in more than half of the hashes
(XXH64, seed 42) of the text's shingles of three words.  Two fingerprints are
linked if they differ in at most two bits.

The 64 bits are dealt into groups, correlated bits together.  If a fingerprint
allows t_i differing bits in group i, and the t_i + 1 add up to three, every
fingerprint within two bits agrees with it in some group up to its t_i (-1: the
group is not asked).  Each fingerprint has thresholds of its own: a dynamic
program over the groups takes those with the least probes and candidates, the
latter estimated from the distances within blocks of eight bits.  So a group
whose value is frequent is left out, and others are asked more widely.  The
probes are looked up in an index of all fingerprints by group and value, and
the candidates are verified on all bits.

A value of more than MOST fingerprints is never asked.  Fingerprints that no
thresholds serve otherwise (inside dense clusters) are compared with each other
exactly by their neighbours: two differ in at most two bits just if they share
a value within one bit of both, and all that share one differ in at most two;
so each is put to its 65 neighbours, where at most 65 meet, and linked with the
least of them.  A pair with at least one fingerprint outside is found by that
one's probes.  No link is lost, and rows stay in proportion to the fingerprints.

Words are separated by space, tab, line feed, vertical tab, form feed and
carriage return; A-Z count as a-z; fewer than three words are one shingle; a
null text, or one without words, has fingerprint zero and is linked like any
other.  A null doc_id is the least of a component only where all are null;
rows that repeat are rows of their own; further columns are ignored; an empty
table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .neardup import components
from .work import mapped, stored

#: Words of a shingle, seed of the hash, differing bits of a link.
SHINGLE, SEED, DIFFER = 3, 42, 2
#: Fingerprints of a group's value up to which it is asked.
MOST = 64
#: Rows that a fingerprint costs by its neighbours: itself and one for each bit.
NEIGHBOURS = 65
#: Shingles whose bits are counted at a time, and bits of a block of the estimate.
SLICE, BLOCK = 1 << 16, 8

_NEVER = 1e18


def fingerprint(text: bytes) -> int:
    """The SimHash of a text, as a signed 64-bit integer."""
    import xxhash
    w = text.lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    end = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    start = np.r_[0, end[:-1] + 1]
    last = end[SHINGLE - 1:] if len(w) > SHINGLE else end[-1:]
    h = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(start.tolist(), last.tolist())), np.uint64, len(last))  # noqa: B905
    ones = sum(np.unpackbits(h[i:i + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64) for i in range(0, len(h), SLICE))
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp for every row."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in words.chunks(batches):
            fp = [fingerprint(t or b"") for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp, pa.int64())], ["doc_id", "fp"])
    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), each, "doc_id long, fp long")


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _summed(fps: DataFrame, count, cells: int) -> np.ndarray:
    """count(fps of a batch) -> array of ``cells`` numbers, added up over all."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for b in batches:
            total += count(b.column("fp").to_numpy())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["cell", "n"])
    out = np.zeros(cells, np.int64)
    for r in mapped(fps.select("fp"), each, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r.cell] = r.n
    return out


def correlation(fps: DataFrame) -> np.ndarray:
    """The absolute correlations of the 64 bits over all fingerprints."""
    def together(fp: np.ndarray) -> np.ndarray:
        x = np.c_[_bits(fp), np.ones(len(fp), np.uint8)].astype(np.float64)
        return (x.T @ x).astype(np.int64).ravel()
    n = _summed(fps, together, 65 * 65).reshape(65, 65).astype(float)
    mean = n[64, :64] / max(1, n[64, 64])
    cov = n[:64, :64] / max(1, n[64, 64]) - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 0))
    return np.abs(cov / np.maximum(np.outer(sd, sd), 1e-12)) * (np.outer(sd, sd) > 0)


def grouped(corr: np.ndarray, m: int) -> list[list[int]]:
    """The bits in m groups of like widths; a group grows by the bit that is
    most correlated with those it has."""
    left, out = list(range(64)), []
    for k in range(m):
        group = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < (64 + k) // m:
            group.append(max(left, key=lambda b: (corr[b, group].sum(), -b)))
            left.remove(group[-1])
        out.append(group)
    return out


def values(fp: np.ndarray, groups: list[list[int]]) -> np.ndarray:
    """The value of each group (column) of each fingerprint (row)."""
    return np.stack([sum(((fp >> np.int64(b)) & np.int64(1)) << np.int64(j) for j, b in enumerate(g)) for g in groups], 1)


class Estimate:
    """Expected numbers of fingerprints within 0, 1 and 2 bits of a group's
    value, as if blocks of bits were independent."""

    def __init__(self, fps: DataFrame, groups: list[list[int]], n: int):
        self.blocks = [[g[i:i + BLOCK] for i in range(0, len(g), BLOCK)] for g in groups]
        flat = [b for bs in self.blocks for b in bs]

        def count(fp: np.ndarray) -> np.ndarray:
            v = values(fp, flat)
            return np.concatenate([np.bincount(v[:, i], minlength=1 << BLOCK) for i in range(len(flat))])
        share = _summed(fps, count, len(flat) << BLOCK).reshape(len(flat), -1) / max(1, n)
        x = np.arange(1 << BLOCK)
        apart = np.unpackbits((x[:, None] ^ x[None, :]).astype(np.uint8).reshape(-1, 1), axis=1).sum(1).reshape(len(x), -1)
        # near[block][value][k]: the share of the fingerprints at k bits there.
        self.near = np.stack([share @ (apart == k) for k in range(DIFFER + 1)], 2)
        self.n = n

    def __call__(self, fp: np.ndarray) -> np.ndarray:
        """(fingerprint, group, radius)"""
        out, at = [], 0
        for blocks in self.blocks:
            p = np.zeros((len(fp), DIFFER + 1))
            p[:, 0] = 1
            v = values(fp, blocks)
            for i in range(len(blocks)):
                q = self.near[at, v[:, i]]
                p = np.stack([sum(p[:, j] * q[:, k - j] for j in range(k + 1)) for k in range(DIFFER + 1)], 1)
                at += 1
            out.append(np.cumsum(p, 1) * self.n)
        return np.stack(out, 1)


def _probes(width: int, radius: int) -> np.ndarray:
    """What a value is changed by to get all within the radius."""
    one = np.int64(1) << np.arange(width, dtype=np.int64)
    i, j = np.triu_indices(width, 1)
    return np.concatenate([np.zeros(1, np.int64), one, one[i] | one[j]][:radius + 1])


def thresholds(expected: np.ndarray, frequent: np.ndarray, widths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(t, cost): for each fingerprint the thresholds of its groups, -1 for one
    that is not asked, with the least probes and expected candidates."""
    n, m = frequent.shape
    budget = DIFFER + 1
    best = np.full((n, budget + 1), _NEVER)
    best[:, 0] = 0
    took = np.zeros((m, n, budget + 1), np.int64)
    for i in range(m):
        cost = np.zeros((n, budget + 1))
        for t in range(DIFFER + 1):
            cost[:, t + 1] = np.where(frequent[:, i], _NEVER, len(_probes(widths[i], t)) + expected[:, i, t])
        new = np.full_like(best, np.inf)
        for b in range(budget + 1):
            for u in range(b + 1):
                c = best[:, b - u] + cost[:, u]
                took[i, c < new[:, b], b] = u
                new[:, b] = np.minimum(new[:, b], c)
        best = new
    t, b = np.zeros((n, m), np.int64), np.full(n, budget)
    for i in reversed(range(m)):
        u = took[i, np.arange(n), b]
        t[:, i], b = u - 1, b - u
    return t, best[:, budget]


def group_count(n: int) -> int:
    """So many groups that n fingerprints of fair bits take the least probes and candidates."""
    def cost(m: int) -> float:
        widths = [(64 + k) // m for k in range(m)]
        expected = np.array([[[n * len(_probes(w, r)) / 2.0 ** w for r in range(DIFFER + 1)] for w in widths]])
        return float(thresholds(expected, np.zeros((1, m), bool), widths)[1][0])
    return min((4, 3, 2), key=lambda m: round(cost(m), 1))


def links(fps: DataFrame, n: int) -> DataFrame:
    """(u, v) rows that connect all of the n distinct fingerprints ``fp`` that
    differ in at most DIFFER bits, some of them through others."""
    groups = grouped(correlation(fps), group_count(n))
    widths = [len(g) for g in groups]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = values(b.column("fp").to_numpy(), groups)
            yield pa.RecordBatch.from_arrays([b.column("fp"), *[pa.array(v[:, i]) for i in range(len(groups))]], names)
    names = ["fp", *[f"v{i}" for i in range(len(groups))]]
    dealt = stored(mapped(fps.select("fp"), deal, ", ".join(f"{c} long" for c in names)), "dealt")
    index = dealt.select("fp", F.posexplode(F.array(*names[1:])).alias("part", "value"))
    frequent = stored(index.groupBy("part", "value").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > MOST).select("part", "value"), "frequent")
    flagged = dealt
    for i, c in enumerate(names[1:]):
        own = frequent.filter(F.col("part") == i).select(F.col("value").alias(c), F.lit(True).alias(f"f{i}"))
        flagged = flagged.join(own, c, "left")
    estimate = Estimate(dealt, groups, n)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy()
            often = np.stack([np.array(b.column(f"f{i}").is_valid()) for i in range(len(groups))], 1)
            t, cost = thresholds(estimate(fp), often, widths)
            dense = cost > NEIGHBOURS
            v = values(fp, groups)
            x, part, value = [], [], []
            for i in range(len(groups)):
                for r in range(DIFFER + 1):
                    at = np.flatnonzero((t[:, i] == r) & ~dense)
                    to = _probes(widths[i], r)
                    x.append(np.repeat(at, len(to)))
                    part.append(np.full(len(at) * len(to), i, np.int32))
                    value.append((v[at, i][:, None] ^ to[None, :]).ravel())
            x, part, value = (np.concatenate(a) for a in (x, part, value))
            order = np.argsort(x, kind="stable")
            asked = pa.StructArray.from_arrays([pa.array(part[order], pa.int32()), pa.array(value[order])], ["part", "value"])
            ends = np.searchsorted(x[order], np.arange(len(fp) + 1))
            yield pa.RecordBatch.from_arrays([b.column("fp"), pa.array(dense), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), asked)], ["fp", "dense", "asked"])
    planned = stored(mapped(flagged.select("fp", *[f"f{i}" for i in range(len(groups))]), plan, "fp long, dense boolean, asked array<struct<part:int,value:long>>"), "planned")
    def asked(rows: DataFrame) -> DataFrame:
        return rows.select("fp", F.explode("asked").alias("p")).select("fp", "p.part", "p.value")
    # A wide probe may come upon a frequent value after all.
    late = stored(asked(planned.filter(F.size("asked") > DIFFER + 1)).join(frequent, ["part", "value"]).select("fp").distinct(), "late")
    probes = asked(planned.filter(~F.col("dense")).join(late, "fp", "left_anti"))
    other = index.join(frequent, ["part", "value"], "left_anti").select("part", "value", F.col("fp").alias("v"))
    found = (probes.withColumnRenamed("fp", "u").join(other, ["part", "value"])
             .filter((F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= DIFFER)).select("u", "v"))
    dense = planned.filter("dense").select("fp").unionByName(late)
    near = dense.select("fp", F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(int(np.int64(np.uint64(1) << np.uint64(b))))) for b in range(64)])).alias("z"))
    met = near.groupBy("z").agg(F.collect_list("fp").alias("all")).filter(F.size("all") > 1)
    return found.unionByName(met.select(F.explode("all").alias("u"), F.array_min("all").alias("v")).filter("u != v")).distinct()


def simhash_components(docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id (the least doc_id that links reach) for every row."""
    rows = stored(fingerprints(docs), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    of = components(stored(links(nodes, nodes.count()), "links")).withColumnRenamed("node", "fp")
    each = nodes.join(of, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = each.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.join(each.select("fp", "component").join(least, "component").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op13_simhash(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``."""
    found = simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
