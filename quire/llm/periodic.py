"""Runs of periodic words, found with string synchronising sets.

A run is a stretch of consecutive words whose smallest period is q (words q
apart are identical), of max(LEAST, 2q) words or more, that no neighbouring
word extends.  For t = 2, 4, 8, ... the periods of [3t, 6t) are found so:

* Every fragment of t words has a name, made by sorting pairs of names of t/2
  (exact, no hash); its identifier is a hash of the name, or infinite where
  the fragment itself has a period of t/3 or less.
* A position is synchronising if the least identifier of the t + 1 fragments
  from it on is that of the first or the last.  That depends on the 2t words
  after it only, so equal contexts are selected alike.
* Two synchronising positions with equal contexts, 3t to 6t apart, propose
  their distance as a period.  Equal contexts lie more than t/3 apart, so a
  position has less than 18 partners.
* No position is selected inside a highly periodic region (a run of a period
  up to t/3, known from a smaller t; periods below 6 are found by comparing
  the words directly).  A run whose first period has any other part is
  proposed nevertheless; one whose first period lies in such a region as a
  whole is the meeting of two regions of one period p, and their phases give
  its periods modulo p.

Proposals are extended word by word, those of one run together; a multiple of
a run's smallest period has the same ends and is dropped.

Words are separated by space, tab, line feed, vertical tab, form feed and
carriage return.  A null or empty text has no words; a null doc_id is kept;
rows that repeat are rows of their own; further columns are ignored; an empty
table gives an empty result.  One text has to fit in a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .work import mapped

#: Words of a run at least.
LEAST = 12
#: Periods below this are found by direct comparison.
DIRECT = 6
#: Cells of a block of words compared at a time.
CELLS = 1 << 20

_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def _stretches(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.r_[np.int8(0), flag.astype(np.int8), np.int8(0)])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _direct(w: np.ndarray) -> np.ndarray:
    """(start, end, period) rows of all stretches of a period below DIRECT; one
    word shorter than a run, as the larger scales ask for regions of 3t - 1."""
    out = []
    for q in range(1, min(DIRECT, len(w))):
        s, e = _stretches(w[q:] == w[:-q])
        long = e + q - s >= LEAST - 1
        out.append(np.stack([s[long], e[long] + q, np.full(long.sum(), q)], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def _doubled(name: np.ndarray, pos: np.ndarray, t: int) -> np.ndarray:
    """Names of the fragments of 2t words from those of t words; -1 where a
    fragment occurs once or leaves the positions that are kept."""
    out = np.full(len(pos), -1, np.int64)
    if len(pos) <= t:
        return out
    at = np.flatnonzero((name[:-t] >= 0) & (name[t:] >= 0) & (pos[t:] - pos[:-t] == t))
    if not len(at):
        return out
    key = name[at] * (name.max() + 1) + name[at + t]
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.r_[True, key[1:] != key[:-1]]
    many = ~(new & np.r_[new[1:], True])
    out[at[order[many]]] = np.cumsum(new)[many]
    return out


def _selected(name: np.ndarray, context: np.ndarray, pos: np.ndarray, t: int, regions: np.ndarray) -> np.ndarray:
    """Indices of the synchronising positions whose context occurs again."""
    n = len(pos)
    if n <= t:
        return np.zeros(0, np.int64)
    own = np.where(name >= 0, words.mix(name) >> np.uint64(1), _NEVER)
    if len(regions):
        inside = np.zeros(n + 1, np.int64)
        np.add.at(inside, np.searchsorted(pos, regions[:, 0]), 1)
        np.add.at(inside, np.searchsorted(pos, regions[:, 1] - t, "right"), -1)
        own[np.cumsum(inside[:-1]) > 0] = _NEVER
    least, width = own.copy(), 1
    while width < t:
        least[:-width] = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-t], own[t:])
    return np.flatnonzero((context[:-t] >= 0) & (least != _NEVER) & ((least == own[:-t]) | (least == own[t:])))


def _pairs(context: np.ndarray, x: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of all pairs with equal contexts, 3t to 6t apart."""
    order = np.argsort(context, kind="stable")
    c, x = context[order], x[order]
    i, lag, found = np.arange(len(x)), 0, []
    while len(i):
        lag += 1
        i = i[i + lag < len(x)]
        i = i[(c[i + lag] == c[i]) & (x[i + lag] - x[i] < 6 * t)]
        d = x[i + lag] - x[i]
        found.append((x[i][d >= 3 * t], d[d >= 3 * t]))
    return tuple(np.concatenate(a) if found else np.zeros(0, np.int64) for a in (zip(*found, strict=True) if found else ((), ())))


def _spread(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, k) for k below n[i], for every i."""
    i = np.repeat(np.arange(len(n)), n)
    return i, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _meetings(name: np.ndarray, pos: np.ndarray, t: int, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, start, end) of the stretches that two highly periodic regions
    of one period make where they meet: the words of [start, end) recur the
    period later."""
    none = np.zeros(0, np.int64)
    r = regions[regions[:, 1] - regions[:, 0] >= 3 * t - 1]
    r = r[np.lexsort((r[:, 0], r[:, 2]))]
    k = np.flatnonzero((r[1:, 2] == r[:-1, 2]) & (r[1:, 0] <= r[:-1, 1])) if len(r) > 1 else none
    if not len(k):
        return none, none, none
    one, two = r[k], r[k + 1]
    # The phase: where the last t words of the first region stand in the second.
    j, o = _spread(one[:, 2])
    y, z = one[j, 1] - t, two[j, 0] + o
    hit = name[np.searchsorted(pos, y)] == name[np.minimum(np.searchsorted(pos, z), len(pos) - 1)]
    j, shift = j[hit], (z - y)[hit]
    p = one[j, 2]
    first = 3 * t + (shift - 3 * t) % p
    i, k = _spread(np.maximum(0, (6 * t - 1 - first) // p + 1))
    q, one, two = first[i] + k * p[i], one[j[i]], two[j[i]]
    lo, hi = np.maximum(one[:, 0], two[:, 0] - q), np.minimum(one[:, 1], two[:, 1] - q)
    ok = hi - lo >= q
    return q[ok], lo[ok], hi[ok]


def _extended(w: np.ndarray, q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stretches [lo, hi), whose words recur q later, as far as they go;
    stretches that meet become one."""
    left = np.zeros(len(q), bool)
    right, step = left.copy(), 32
    while True:
        order = np.lexsort((lo, q))
        q, lo, hi, left, right = (a[order] for a in (q, lo, hi, left, right))
        far = np.cumsum(np.r_[0, np.diff(q) != 0]) * (len(w) + 1) if len(q) else lo
        end = np.maximum.accumulate(hi + far)
        first = np.flatnonzero(np.r_[True, (lo + far)[1:] > end[:-1]]) if len(q) else lo
        if len(first) < len(q):
            group = np.cumsum(np.isin(np.arange(len(q)), first)) - 1
            most = np.maximum.reduceat(hi, first)
            right = np.logical_or.reduceat(right & (hi == most[group]), first)
            q, lo, hi, left = q[first], lo[first], most, left[first]
        if left.all() and right.all():
            return q, lo, hi
        for at in np.array_split(np.flatnonzero(~right), max(1, len(q) * step // CELLS)):
            i = hi[at][:, None] + np.arange(step)
            ok = i + q[at][:, None] < len(w)
            same = ok & (w[np.where(ok, i, 0)] == w[np.where(ok, i + q[at][:, None], 0)])
            n = np.where(same.all(1), step, same.argmin(1))
            hi[at] += n
            right[at] = n < step
        for at in np.array_split(np.flatnonzero(~left), max(1, len(q) * step // CELLS)):
            i = lo[at][:, None] - 1 - np.arange(step)
            ok = i >= 0
            same = ok & (w[np.where(ok, i, 0)] == w[np.where(ok, i + q[at][:, None], 0)])
            n = np.where(same.all(1), step, same.argmin(1))
            lo[at] -= n
            left[at] = n < step
        step *= 2


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of rows with the same ends the one with the smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    return runs[np.r_[True, (np.diff(runs[:, :2], axis=0) != 0).any(1)]] if len(runs) else runs


def repetitions(w: np.ndarray) -> np.ndarray:
    """(start, end, period) rows of all runs of a sequence of whole numbers, by start, then period."""
    runs = _smallest(_direct(w))
    pos, t = np.arange(len(w)), 2
    name = _doubled(w, pos, 1)
    while True:
        context = _doubled(name, pos, t)
        if not (context >= 0).any():
            break
        regions = runs[3 * runs[:, 2] <= t]
        at = _selected(name, context, pos, t, regions)
        x, q = _pairs(context[at], pos[at], t)
        more, lo, hi = _meetings(name, pos, t, regions)
        q, lo, hi = _extended(w, np.r_[q, more], np.r_[x, lo], np.r_[x + 2 * t, hi])
        long = hi - lo >= q
        runs = _smallest(np.concatenate([runs, np.stack([lo, hi + q, q], 1)[long]]))
        # Only words of fragments that occur again go on.
        again = np.flatnonzero(context >= 0)
        cover = np.zeros(len(pos) + 2 * t + 1, np.int64)
        np.add.at(cover, again, 1)
        np.add.at(cover, again + 2 * t, -1)
        kept = np.cumsum(cover[:len(pos)]) > 0
        pos, name, t = pos[kept], context[kept], 2 * t
    runs = runs[runs[:, 1] - runs[:, 0] >= np.maximum(LEAST, 2 * runs[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def fold(doc_id: int | None, w: list[bytes]) -> list[bytes]:
    """The texts of the registered query: those of some documents are made periodic."""
    if doc_id is None or not w:
        return w
    h, n = crc32(str(doc_id).encode()), len(w)
    if h % 10:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + (w[a:a + p] * ((n - a) // p + 1))[:n - a]


def periodic_runs(docs: DataFrame, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, runs (array of start, length, period, by start, then period) and
    collapsed, for every row: the words outside of runs and those of each run's
    first period, joined by spaces.  ``change`` may alter the words first."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in words.chunks(batches):
            texts, ids, first, base = [], [], [0], 0
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), strict=True):
                # bytes.split() knows just these six characters.
                w = (text or b"").split()
                w = change(doc_id, w) if change else w
                number: dict[bytes, int] = {}
                ids.append(np.fromiter((number.setdefault(x, len(number)) for x in w), np.int64, len(w)) + base)
                base += len(number)
                first.append(first[-1] + len(w))
                texts.append(w)
            runs, first = repetitions(np.concatenate(ids)), np.array(first)
            extra = np.zeros(first[-1] + 1, np.int64)
            np.add.at(extra, runs[:, 0] + runs[:, 2], 1)
            np.add.at(extra, runs[:, 1], -1)
            gone = np.cumsum(extra) > 0
            to = np.searchsorted(runs[:, 0], first)
            collapsed = []
            for i, w in enumerate(texts):
                if to[i] < to[i + 1]:
                    w = [x for x, g in zip(w, gone[first[i]:first[i + 1]].tolist(), strict=True) if not g]
                collapsed.append(b" ".join(w))
            begin = runs[:, 0] - first[np.searchsorted(first, runs[:, 0], "right") - 1]
            spans = pa.StructArray.from_arrays([pa.array(x) for x in (begin, runs[:, 1] - runs[:, 0], runs[:, 2])], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(to, pa.int32()), spans), pa.array(collapsed, pa.binary()).cast(pa.string())],
                ["doc_id", "runs", "collapsed"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mapped(rows, find, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, some made periodic (see ``fold``)."""
    found = periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), fold)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
