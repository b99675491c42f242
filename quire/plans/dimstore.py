"""The article dimension in hash buckets.

An article lies in bucket ``pmod(xxhash64(article_id), n)``; the log names the
folder of each bucket.  A run reads the buckets of its keys, merges them and
writes them anew in a folder of its own; the others are neither read nor
written.  Beside each bucket lie its monitoring counts, so figures over the
whole dimension add up those of the buckets; when a bucket is replaced its
counts go with it, and no row has to be taken back one by one.

Before a run commits, what it wrote is checked: article_id unique (all rows of
a key lie in one bucket) and the dimension's rules."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators import dimension as dim
from quire.operators import validate as val
from quire.sources.commitlog import CommitLog, State
from quire.sources.tables import Workspace, schema_of

#: Buckets of a new workspace.  ``rebucket`` changes them as the dimension grows.
BUCKETS = 64
STATS_SCHEMA = "source_platform string, category string, n long, earliest_pub date, latest_pub date"


def bucket_of(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _folders(ws: Workspace, state: State, kind: str, buckets: list[int] | None = None) -> list[str]:
    found = state.buckets if buckets is None else {b: state.buckets[str(b)] for b in buckets if str(b) in state.buckets}
    return [f"{ws.path('dim_articles')}/{kind}/{folder}/bucket={b}" for b, folder in sorted(found.items(), key=lambda x: int(x[0]))]


def view(ws: Workspace, state: State, buckets: list[int] | None = None) -> DataFrame | None:
    """The dimension as of a state, or some buckets of it; None if nothing is there."""
    folders = _folders(ws, state, "data", buckets)
    return ws.spark.read.schema(schema_of("dim_articles")).parquet(*folders) if folders else None


def lookup(ws: Workspace, keys: DataFrame, state: State | None = None) -> DataFrame | None:
    """The dimension rows of the article_ids in ``keys``: only their buckets are read."""
    state = state or CommitLog(ws).state()
    if not state.n_buckets:
        return None
    rows = view(ws, state, touched(keys, state.n_buckets))
    return None if rows is None else rows.join(keys.select("article_id").distinct(), "article_id", "left_semi")


def touched(keys: DataFrame, n: int) -> list[int]:
    """The buckets of the keys: at most n numbers."""
    return sorted(r[0] for r in keys.select(bucket_of(F.col("article_id"), n)).distinct().collect())


def _write(ws: Workspace, rows: DataFrame, n: int, folder: str) -> None:
    """Rows and monitoring counts by bucket, in a new folder."""
    root = ws.path("dim_articles")
    rows.withColumn("bucket", bucket_of(F.col("article_id"), n)).repartition("bucket").write.partitionBy("bucket").parquet(f"{root}/data/{folder}")
    written = ws.spark.read.schema(schema_of("dim_articles").add("bucket", "integer")).parquet(f"{root}/data/{folder}")
    bad = dim.duplicate_keys(written).count()
    if bad:
        raise val.SchemaError("dim_articles", [f"{bad} article_ids occur more than once"])
    written.groupBy("bucket", "source_platform", "category").agg(
        F.count(F.lit(1)).alias("n"), F.min("pub_date").alias("earliest_pub"), F.max("pub_date").alias("latest_pub")
    ).repartition("bucket").write.partitionBy("bucket").parquet(f"{root}/stats/{folder}")


class Upsert:
    """J7 into the buckets.  ``entry(state)`` does the work for the buckets
    that have changed since it was last asked, so a run that comes second
    redoes those that the first one replaced too, and no others."""

    def __init__(self, ws: Workspace, incoming: DataFrame, now: Column, new_id: Column, name: str):
        self.ws, self.incoming, self.now, self.new_id, self.name = ws, incoming, now, new_id, name
        self.based_on: dict[int, str | None] = {}
        self.written: dict[int, str] = {}
        self.n: int | None = None
        self.rewritten: list[list[int]] = []

    def entry(self, state: State) -> dict:
        n = state.n_buckets or BUCKETS
        if n != self.n:
            self.n, self.based_on, self.written = n, dict.fromkeys(touched(self.incoming, n), ""), {}
        stale = [b for b, folder in self.based_on.items() if folder != state.buckets.get(str(b))]
        if stale:
            some = self.incoming.filter(bucket_of(F.col("article_id"), n).isin(stale)) if len(stale) < n else self.incoming
            folder = f"{self.name}-{uuid.uuid4().hex[:8]}"
            # by staging order, so an older row that was reopened replaces no newer one
            _write(self.ws, dim.upsert(view(self.ws, state, stale), some, self.now, order="_src_pk", new_id=self.new_id), n, folder)
            self.based_on.update({b: state.buckets.get(str(b)) for b in stale})
            self.written.update(dict.fromkeys(stale, folder))
            self.rewritten.append(stale)
        return {"n_buckets": n, "buckets": {str(b): folder for b, folder in self.written.items()}}


def rebucket(ws: Workspace, n: int) -> State:
    """The whole dimension dealt into n buckets, as one commit."""
    def entry(state: State) -> dict:
        rows = view(ws, state)
        if rows is None:
            return {"kind": "rebucket", "n_buckets": n}
        folder = f"rebucket-{uuid.uuid4().hex[:8]}"
        _write(ws, rows, n, folder)
        return {"kind": "rebucket", "n_buckets": n, "all_buckets": True, "buckets": {str(b): folder for b in touched(rows, n)}}
    return CommitLog(ws).commit(entry)


# --- monitoring from the buckets' counts (A7-A9, O4, O6) ------------------------
def monitoring_state(ws: Workspace, state: State | None = None) -> DataFrame:
    """source_platform, category, n, earliest_pub, latest_pub by bucket."""
    folders = _folders(ws, state or CommitLog(ws).state(), "stats")
    if not folders:
        return ws.spark.createDataFrame([], STATS_SCHEMA)
    return ws.spark.read.schema(STATS_SCHEMA).parquet(*folders)


def stats(ws: Workspace) -> DataFrame:
    """A9 without reading the dimension."""
    of = lambda platform: F.coalesce(F.sum(F.when(F.col("source_platform") == platform, F.col("n"))), F.lit(0))
    return monitoring_state(ws).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), of(dim.GFG).alias("gfg_count"), of(dim.MEDIUM).alias("medium_count"),
                                    F.min("earliest_pub").alias("earliest_pub"), F.max("latest_pub").alias("latest_pub"))


def by_platform(ws: Workspace) -> DataFrame:
    """A7 / O6 without reading the dimension."""
    return monitoring_state(ws).groupBy("source_platform").agg(
        F.sum("n").alias("article_count"), F.min("earliest_pub").alias("earliest_pub"), F.max("latest_pub").alias("latest_pub"))


def top_categories(ws: Workspace, n: int = 10) -> DataFrame:
    """O4 without reading the dimension."""
    return (monitoring_state(ws).filter(F.col("category").isNotNull()).groupBy("category").agg(F.sum("n").alias("article_count"))
            .orderBy(F.col("article_count").desc(), F.col("category").asc()).limit(n))
