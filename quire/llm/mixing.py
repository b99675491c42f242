"""Mixing sources to target weights by weighted fair queueing, with DataFrame
functions only.

Each source's documents are shuffled by a hash.  A document's virtual finish
time is its source's cumulative words up to and with it, divided by the
source's target; further passes over a source carry on from its last word.
The mix is the prefix, in virtual time, that the total budget holds.

Cumulative sums go over ranges of at most about ``ROWS`` documents of one
source, then over the ranges, so a source with a third of all rows is split
like any other, and so are the rows of one doc_id.  The global order is dealt into ranges of virtual time;
only the range in which the budget ends is sorted row by row, every other
lies wholly inside or outside.

A null text has no words; a null source is a source of its own, the last one;
empty documents are never taken; rows that repeat are documents of their own;
further columns stay as they are; an empty table gives an empty mix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import free_name, stored

#: Words; weights by rank of the source; most passes over a source.
WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
#: Documents of a range, about.
ROWS = 4096
#: Equal rows that are numbered in one task at most.
REPEATS = ROWS // 16


def sizes(docs: DataFrame, seed: int = 7, uid: str | None = None) -> DataFrame:
    """uid, doc_id, source, size, place (the hash of doc_id, text and source): one row for each document.
    ``uid``: the column that has the documents' numbers (None: they are numbered here)."""
    return docs.select(
        (F.col(uid) if uid else F.monotonically_increasing_id()).alias("uid"), "doc_id", "source",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS)).cast("long").alias("size"),
        F.xxhash64("doc_id", F.lit(seed), "text", "source").alias("place"))


def spread(sized: DataFrame) -> DataFrame:
    """The documents with a place each: a hash (63 bits) of their doc_id, text
    and source, and of their number among equal rows.  Equal rows stand for
    each other, so the places do not depend on how the rows are dealt into
    files.  Rows that come more than ``REPEATS`` times are numbered in two
    steps, within the partition that read them and then over the partitions,
    so that no task sees all of them."""
    often = stored(sized.groupBy("place").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > REPEATS)
                   .select("place", F.lit(True).alias("often")), "often")
    # The upper bits of a row's number are those of its partition.
    there = sized.join(often, "place", "left").withColumn("part", F.when(F.col("often"), F.shiftrightunsigned("uid", 33)).otherwise(F.lit(-1)))
    parts = there.filter("often").groupBy("place", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("place", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("place", "part").orderBy("uid")) + F.coalesce("before", F.lit(0))
    return (there.join(parts, ["place", "part"], "left").withColumn("nth", nth)
            .withColumn("place", F.shiftrightunsigned(F.xxhash64("place", "nth"), 1)).drop("often", "part", "before", "nth"))


def targets(sized: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, share: float = 1.0) -> DataFrame:
    """source, src, n_rows, source_size, target: one row for each source.

    Water filling: with the sources in ascending order of cap / weight, the
    level that the budget reaches is the largest quotient of the budget left
    by those before and the weights from there on."""
    each = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("source_size"))
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    each = (each.withColumn("src", F.row_number().over(rank) - 1)
            .withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.pmod("src", F.lit(len(weights)))).cast("double"))
            .withColumn("cap", F.col("source_size").cast("double") * most))
    all_ = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(all_) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    return (each.withColumn("level", level).withColumn("level", F.max("level").over(all_))
            .select("source", "src", "n_rows", "source_size", F.least("cap", F.col("weight") * F.col("level")).alias("target")))


def finish_times(sized: DataFrame, by_source: DataFrame) -> DataFrame:
    """The documents with ``finish``: the cumulative words of the first pass up to and with each."""
    ranges = F.ceil(F.col("n_rows") / F.lit(ROWS)).cast("long")
    sized = spread(sized)
    there = (sized.join(by_source, sized.source.eqNullSafe(by_source.source)).drop(by_source.source)
             .withColumn("range", F.shiftright(F.shiftright("place", 32) * ranges, 31)))
    sums = there.groupBy("src", "range").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("src", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("src", "range").orderBy("place", "doc_id", "size", "uid").rowsBetween(Window.unboundedPreceding, 0)
    return (there.withColumn("inside", F.sum("size").over(inside)).join(sums, ["src", "range"])
            .withColumn("finish", F.col("before") + F.col("inside")).drop("range", "before", "inside"))


def times(copy: Column) -> Column:
    """Virtual finish time of a document's pass 0, 1, ..."""
    return (copy * F.col("source_size") + F.col("finish")).cast("double") / F.col("target")


def order_of(copy: Column) -> Column:
    return F.struct(times(copy).alias("time"), F.col("src").alias("src"), F.col("finish").alias("finish"), copy.cast("int").alias("copy"))


def budget_end(timed: DataFrame, share: float = 1.0, most: int = MOST) -> tuple | None:
    """(time, src, finish, copy) of the last document that the budget holds."""
    part = timed.filter((F.col("size") > 0) & (F.col("target") > 0))
    n, total = part.agg(F.count(F.lit(1)), F.sum("size")).first()
    if not n:
        return None
    budget = int(total * share)
    copies = part.select("size", F.explode(F.array(*[order_of(F.lit(c)) for c in range(most)])).alias("at"))
    # A range holds the documents of an equal stretch of virtual time.
    copies = copies.withColumn("range", F.floor(F.col("at.time") * F.lit(-(-n // ROWS))))
    up_to = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    sums = copies.groupBy("range").agg(F.sum("size").alias("words")).withColumn("to", F.sum("words").over(up_to))
    cut = sums.filter(F.col("to") > budget).orderBy("range").first()
    if cut is None:
        last = copies.agg(F.max("at").alias("at")).first().at
        return tuple(last)
    rest = budget - (cut["to"] - cut.words)
    sorted_ = copies.filter(F.col("range") == cut["range"]).withColumn(
        "to", F.sum("size").over(Window.partitionBy("range").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)))
    last = sorted_.filter(F.col("to") <= rest).agg(F.max("at").alias("at")).first().at
    if last is None:
        last = copies.filter(F.col("range") < cut["range"]).agg(F.max("at").alias("at")).first().at
    return tuple(last) if last is not None else None


def taken(timed: DataFrame, end: tuple | None, most: int = MOST) -> DataFrame:
    """The documents with ``passes``: how often the mix takes each."""
    if end is None:
        return timed.withColumn("passes", F.lit(0))
    time, src, finish, copy = end
    last = F.struct(F.lit(time).alias("time"), F.lit(src).alias("src"), F.lit(finish).cast("long").alias("finish"), F.lit(copy).alias("copy"))
    passes = sum((order_of(F.lit(c)) <= last).cast("int") for c in range(most))
    return timed.withColumn("passes", F.when((F.col("size") > 0) & (F.col("target") > 0), passes).otherwise(0))


def plan(sized: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, share: float = 1.0, seed: int = 7) -> DataFrame:
    """Every document with its source's target and how often it is taken."""
    sized = stored(sized, "sizes")
    timed = stored(finish_times(sized, targets(sized, weights, most, share)), "finish")
    return taken(timed, budget_end(timed, share, most), most)


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, share: float = 1.0, seed: int = 7) -> DataFrame:
    """The mix itself: the documents in order of virtual time, each as often as it is taken."""
    uid, at = free_name(docs, "__uid"), free_name(docs, "__at")
    kept = stored(docs.withColumn(uid, F.monotonically_increasing_id()), "mix-input")
    chosen = plan(sizes(kept, seed, uid), weights, most, share, seed).filter(F.col("passes") > 0)
    each = chosen.select(F.col("uid").alias(uid), F.explode(F.array_compact(F.array(
        *[F.when(F.col("passes") > c, order_of(F.lit(c))) for c in range(most)]))).alias(at))
    return kept.join(each, uid).orderBy(at).select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_source_mix(spark, sf_dir: str) -> DataFrame:
    """All ``documents``."""
    mixed = plan(sizes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("passes")).alias("taken"))
