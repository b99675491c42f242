"""Benchmark decontamination with a positional inverted index.

``build_index`` stores the postings (term -> positions) of the training
documents in blocks of documents; a block is one row and holds the sorted
postings of its own documents, so neither a frequent term nor a long document
meets in one task.  ``search`` takes the windows of the benchmark, orders the
terms of each by how often the whole corpus has them, and intersects the
offset-adjusted postings lists from the rarest term on, block by block.

Terms are 64-bit hashes of words (see ``words``).  A window is ``window``
consecutive words of an item; an item of fewer words, but not none, is one
window.  Windows go to the tasks in groups of at most ``MAX_WINDOWS``, so what
is broadcast is bounded; further groups are searched in the same index.  The
windows' item lists go with them up to ``MAX_ENTRIES`` entries; beyond, each
distinct list has a number, and a Spark join resolves the numbers found.

Null or empty texts have no words and are not hit; an item without words has
no window; repeated documents and items are each handled as a row of their
own, and an item_id that comes twice is one item; a null item_id is left out
of the lists; further columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .work import mapped, stored

#: Words of a window.
WINDOW = 10
#: Proximity of the query: words from a window's rarest word within which its others lie.  A window has at most
#: ``WINDOW`` - 1 there as it is; one more lets a word be put in or moved past its end.
SLOP = WINDOW
#: Windows searched at a time: with ten terms, 16 MB of hashes.
MAX_WINDOWS = 200_000
#: Entries of all windows' item lists up to which they go to the tasks with the windows (8 MB); beyond, only the
#: number of each distinct list does, and the items are joined to what was found.
MAX_ENTRIES = 1_000_000
#: Beyond so many distinct benchmark terms (16 MB of hashes), the index keeps all terms.
MAX_TERMS = 2_000_000

INDEX = "block long, terms array<long>, counts array<long>, positions array<int>, doc_id array<long>, base array<int>, n_words array<int>"
HITS = "block long, row int, doc_id long, n_words long, spans array<struct<start:int,end:int>>, items array<long>, near_items array<long>"


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(terms, items): the distinct windows of the benchmark and the items that have them."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in words.chunks(batches):
            h, first = words.word_hashes(b.column("text"))
            h = h.view(np.int64)
            ids = b.column("item_id").to_pylist()
            terms, items = [], []
            for i, (s, e) in enumerate(zip(first[:-1], first[1:], strict=True)):
                for k in range(s, max(s + 1, e - size + 1) if e > s else s):
                    terms.append(h[k:min(e, k + size)])
                    items.append(ids[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.list_(pa.int64())), pa.array(items, pa.int64())], ["terms", "item_id"])
    return (benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(cut, "terms array<long>, item_id long")
            .groupBy("terms").agg(F.sort_array(F.collect_set("item_id")).alias("items")))


def build_index(docs: DataFrame, terms: np.ndarray | None = None) -> DataFrame:
    """The stored index, a row for each block of documents.  ``terms``: sorted
    hashes that it is restricted to (None: all).  Positions count the words of
    a block; between two documents one position stays free, so that no phrase
    runs over it."""
    kept = docs.sparkSession.sparkContext.broadcast(terms) if terms is not None else None

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        for b in words.chunks(batches):
            h, first = words.word_hashes(b.column("text"))
            h = h.view(np.int64)
            n = np.diff(first)
            base = first[:-1] + np.arange(len(n))
            pos = np.arange(len(h)) + words.runs(first)
            if kept is not None:
                known = kept.value
                at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                has = known[at] == h if len(known) else np.zeros(len(h), bool)
                h, pos = h[has], pos[has]
            order = np.argsort(h, kind="stable")
            h, pos = h[order], pos[order].astype(np.int32)
            new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
            row = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), row(h[new], pa.int64()), row(np.diff(np.r_[new, len(h)]), pa.int64()), row(pos, pa.int32()),
                 row(b.column("doc_id"), pa.int64()), row(base.astype(np.int32), pa.int32()), row(n.astype(np.int32), pa.int32())],
                ["block", "terms", "counts", "positions", "doc_id", "base", "n_words"])
            block += 1
    return stored(mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), post, INDEX), "postings")


def frequencies(index: DataFrame) -> DataFrame:
    """(term, n): how often the corpus has each indexed term."""
    each = index.select(F.explode(F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("n"))).alias("t"))
    return each.groupBy(F.col("t.term").alias("term")).agg(F.sum("t.n").alias("n"))


def intersect(terms: np.ndarray, begin: np.ndarray, positions: np.ndarray, need: np.ndarray, offset: np.ndarray, length: np.ndarray,
              near: tuple[np.ndarray, np.ndarray, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of all exact occurrences in a block's postings, or with
    ``near`` (documents' first and last positions, words) the places of the
    rarest term that have all others within so many words in the document.
    need, offset: a row for each window with its terms, rarest first, and
    their places in the window; places from ``length`` on are unused."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(terms) or not len(need):
        return none
    at = np.minimum(np.searchsorted(terms, need), len(terms) - 1)
    used = np.arange(need.shape[1]) < length[:, None]
    there = np.flatnonzero(((terms[at] == need) | ~used).all(axis=1))
    if not len(there):
        return none
    lead = at[there, 0]
    n = begin[lead + 1] - begin[lead]
    win = np.repeat(there, n)
    pos = positions[np.repeat(begin[lead], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)].astype(np.int64)
    if near is None:
        pos -= offset[win, 0]
    else:
        doc = np.searchsorted(near[0], pos, "right") - 1
        low, high = np.maximum(pos - near[2], near[0][doc]), np.minimum(pos + near[2], near[1][doc])
    key = np.repeat(np.arange(len(terms), dtype=np.int64), np.diff(begin)) << 32 | positions
    for j in range(1, need.shape[1]):
        on = j < length[win]
        base = at[win, j].astype(np.int64) << 32
        if near is None:
            want = base | np.maximum(pos + offset[win, j], 0)
            k = np.minimum(np.searchsorted(key, want), len(key) - 1)
            ok = ~on | (key[k] == want) & (pos >= 0)
        else:
            k = np.searchsorted(key, base | low)
            ok = ~on | (k < len(key)) & (key[np.minimum(k, len(key) - 1)] <= (base | high))
            low, high = low[ok], high[ok]
        win, pos = win[ok], pos[ok]
    if near is None:
        win, pos = win[pos >= 0], pos[pos >= 0]
    return win, pos


def search(index: DataFrame, wanted: DataFrame, df: DataFrame, slop: int | None = None, max_windows: int = MAX_WINDOWS,
           max_entries: int = MAX_ENTRIES) -> DataFrame:
    """HITS: a row for each indexed document, with the merged spans (in words)
    of all window occurrences and the items that they belong to; with ``slop``
    also the items a window of which lies there in proximity: all its words
    within ``slop`` words of its rarest one, in any order, in one document."""
    spark = index.sparkSession
    n, entries = wanted.agg(F.count(F.lit(1)), F.sum(F.size("items"))).first()
    if (entries or 0) > max_entries:
        lists = stored(wanted.select("items").distinct().select(F.monotonically_increasing_id().alias("list"), "items"), "lists")
        numbered = stored(wanted.join(lists, "items").select("terms", F.array("list").alias("items")), "numbered")
        hits = _resolved(stored(search(index, numbered, df, slop, max_windows, n), "hits"), lists, "items")
        return hits if slop is None else _resolved(stored(hits, "hits-resolved"), lists, "near_items")
    groups = max(1, -(-n // max_windows))
    # The windows' terms with their frequencies, rarest first.
    ranked = (wanted.select("terms", "items", F.posexplode("terms").alias("place", "term"))
              .join(df, "term", "left")
              .groupBy("terms").agg(F.first("items").alias("items"), F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place"))).alias("rare"))
              .select("terms", "items", F.col("rare.place").alias("order")))
    if groups > 1:
        ranked = stored(ranked, "windows")
    out = None
    for g in range(groups):
        mine = ranked.filter(F.pmod(F.xxhash64("terms"), F.lit(groups)) == g) if groups > 1 else ranked
        hits = mapped(index, _searcher(spark, mine.toArrow(), slop), HITS)
        out = hits if out is None else out.unionByName(hits)
    if groups > 1:
        out = (out.groupBy("block", "row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_items")))).alias("near_items")))
    return out


def _resolved(hits: DataFrame, lists: DataFrame, column: str) -> DataFrame:
    """The hits with the items of the lists whose numbers ``column`` has; those
    without any, which are most, take no part in the join.  Each distinct combination of lists is resolved once, whatever number of
    documents has it, and its items are made distinct before they are grouped."""
    found = hits.filter(F.size(column) > 0)
    each = (found.select(F.col(column).alias("lists")).distinct().select("lists", F.explode("lists").alias("list")).join(lists, "list")
            .select("lists", F.explode("items").alias("item"))
            .groupBy("lists").agg(F.sort_array(F.collect_set("item")).alias("__resolved")))
    resolved = (found.join(each, found[column] == each["lists"], "left")
                .withColumn(column, F.coalesce("__resolved", F.array().cast("array<long>"))).select(*hits.columns))
    return resolved.unionByName(hits.filter(F.size(column) == 0))


def _searcher(spark, table: pa.Table, slop: int | None):
    table = table.combine_chunks()
    terms, order = table.column("terms").to_pylist(), table.column("order").to_pylist()
    items = [[x for x in i if x is not None] for i in table.column("items").to_pylist()]
    wide = max(map(len, terms), default=1)
    need, offset = np.zeros((len(terms), wide), np.int64), np.zeros((len(terms), wide), np.int64)
    length = np.array([len(t) for t in terms], np.int64)
    for i, (t, o) in enumerate(zip(terms, order, strict=True)):
        offset[i, :len(o)] = o
        need[i, :len(o)] = np.asarray(t)[o]
    to = spark.sparkContext.broadcast((need, offset, length, np.array([x for i in items for x in i], np.int64), np.cumsum([0, *map(len, items)])))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        need, offset, length, items, item_at = to.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values for c in ("terms", "counts", "positions", "doc_id", "base", "n_words")}
                np_ = {c: row[c].to_numpy(zero_copy_only=False) for c in ("terms", "counts", "positions", "base", "n_words")}
                begin = np.r_[0, np.cumsum(np_["counts"])].astype(np.int64)
                args = np_["terms"], begin, np_["positions"].astype(np.int64), need, offset, length
                base, n_words = np_["base"].astype(np.int64), np_["n_words"].astype(np.int64)
                win, pos = intersect(*args)
                doc = np.searchsorted(base, pos, "right") - 1
                size = length[win]
                spans_at, spans = _merged(doc, pos - base[doc], size, len(base))
                found_at, found = _items(doc, win, items, item_at, len(base))
                near_at, near = np.zeros(len(base) + 1, np.int64), np.zeros(0, np.int64)
                if slop is not None:
                    win, pos = intersect(*args, near=(base, base + n_words - 1, slop))
                    doc = np.searchsorted(base, pos, "right") - 1
                    near_at, near = _items(doc, win, items, item_at, len(base))
                lists = lambda at, x: pa.ListArray.from_arrays(pa.array(at, pa.int32()), x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(base), batch.column("block")[i].as_py()), pa.int64()), pa.array(np.arange(len(base)), pa.int32()),
                     row["doc_id"].cast(pa.int64()), pa.array(n_words, pa.int64()),
                     lists(spans_at, pa.StructArray.from_arrays([pa.array(spans[:, 0], pa.int32()), pa.array(spans[:, 1], pa.int32())], ["start", "end"])),
                     lists(found_at, pa.array(found, pa.int64())), lists(near_at, pa.array(near, pa.int64()))],
                    ["block", "row", "doc_id", "n_words", "spans", "items", "near_items"])
    return find


def _merged(doc: np.ndarray, start: np.ndarray, size: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching spans of a document joined; where each document's begin."""
    if not len(doc):
        return np.zeros(n + 1, np.int64), np.zeros((0, 2), np.int64)
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    far = np.int64(1) << 32
    reach = np.maximum.accumulate(doc * far + start + size[order])
    new = np.r_[True, doc[1:] * far + start[1:] > reach[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(doc) - 1]
    spans = np.stack([start[new], reach[last] - doc[new] * far], axis=1)
    return np.searchsorted(doc[new], np.arange(n + 1)), spans


def _items(doc: np.ndarray, win: np.ndarray, items: np.ndarray, item_at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct items of each document's windows."""
    if len(doc):
        doc, win = np.unique(np.stack([doc, win]), axis=1)
    k = item_at[win + 1] - item_at[win] if len(win) else np.zeros(0, np.int64)
    each = items[np.repeat(item_at[win], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)] if k.sum() else np.zeros(0, np.int64)
    pairs = np.unique(np.stack([np.repeat(doc, k), each]), axis=1) if len(each) else np.zeros((2, 0), np.int64)
    return np.searchsorted(pairs[0], np.arange(n + 1)), pairs[1]


def covered(spans) -> F.Column:
    """Words inside sorted (start, end) spans, which may overlap."""
    begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to"))
    return F.aggregate(spans, begin, lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["to"], s["start"])).cast("long")).alias("n"),
        F.greatest(a["to"], s["end"]).alias("to")), lambda a: a["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int | None = None,
                  max_windows: int = MAX_WINDOWS, max_terms: int = MAX_TERMS, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """doc_id, n_words, n_hit, spans, items, near_items for every document."""
    wanted = stored(windows(benchmark, window), "wanted")
    vocabulary = wanted.select(F.explode("terms").alias("term")).distinct()
    terms = None
    if vocabulary.count() <= max_terms:
        terms = np.sort(np.array([r.term for r in vocabulary.collect()], np.int64))
    index = build_index(docs, terms)
    hits = search(index, wanted, frequencies(index), slop, max_windows, max_entries)
    return hits.select("block", "row", "doc_id", "n_words", covered(F.col("spans")).alias("n_hit"), "spans", "items", "near_items")


def _report(found: DataFrame) -> DataFrame:
    """The query's columns, with those of the proximity matches behind them."""
    digest = lambda x: F.sha2(F.array_join(F.array_sort(F.transform(x, lambda i: i.cast("string"))), ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        digest("items").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
                        F.size("near_items").cast("long").alias("n_near_items"), digest("near_items").alias("near_items_sha256"))


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return _report(contamination(docs, bench)).drop("n_near_items", "near_items_sha256")


def op9_decontamination_near(spark, sf_dir: str) -> DataFrame:
    """The same, with the items that a document has in proximity (``SLOP``)."""
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return _report(contamination(docs, bench, slop=SLOP))
