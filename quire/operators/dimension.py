"""The unified article dimension: source mappings, in-batch dedupe, upsert on
the business key, and the monitoring queries over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.scalars import (first_author, first_tag, parse_mixed_date,
                                     platform_count_key)
from quire.operators.rules import DIM_RULES
from quire.operators.staging import dedupe_keep_last
from quire.operators.validate import annotate, check_table_level, failure_cases, violations_column

# Platform labels of the two sources.
GFG = "GFG"
MEDIUM = "Medium"
DIM_COLUMNS = ["article_id", "source_platform", "title", "author", "pub_date", "link",
               "category", "is_valid"]
DIM_VALUE_COLUMNS = [c for c in DIM_COLUMNS if c != "article_id"]


def gfg_to_dim(clean: DataFrame, pk: str = "id") -> DataFrame:
    """Clean article-CSV staging rows -> dimension rows (plus the
    staging key ``_src_pk`` for ordering and the processed ledger)."""
    return clean.select(
        F.col("article_id"), F.lit(GFG).alias("source_platform"), F.col("title"),
        F.col("author_id").alias("author"),
        parse_mixed_date(F.col("last_updated")).alias("pub_date"),
        F.col("link"), F.col("category"), F.lit(True).alias("is_valid"),
        F.col(pk).alias("_src_pk"))


def feed_to_dim(clean: DataFrame, pk: str = "id") -> DataFrame:
    """Clean feed staging rows -> dimension rows; author and
    category are the first entries of the JSON author / tag arrays."""
    return clean.select(
        F.col("id_rss").alias("article_id"), F.lit(MEDIUM).alias("source_platform"),
        F.col("title"), first_author(F.col("authors")).alias("author"),
        parse_mixed_date(F.col("published")).alias("pub_date"),
        F.col("link"), first_tag(F.col("tags")).alias("category"),
        F.lit(True).alias("is_valid"), F.col(pk).alias("_src_pk"))


def union_sources(*frames: DataFrame) -> DataFrame:
    """All sources in one frame (by name)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def latest_per_key(rows: DataFrame, order_col: str = "_src_pk") -> DataFrame:
    """In-batch duplicates on article_id: the last by staging order wins."""
    return dedupe_keep_last(rows, ["article_id"], order_col)


def guard(rows: DataFrame) -> DataFrame:
    """K1 guard: the dimension's NOT NULL / allowed-values rules as
    failure cases (empty when the batch may be written)."""
    return failure_cases(annotate(rows.select(*DIM_COLUMNS), DIM_RULES), "article_id")


def guard_violations(rows: DataFrame) -> Column:
    """K1 guard as a column over ``rows``: the violations of each row."""
    check_table_level(rows.select(*DIM_COLUMNS), DIM_RULES)
    return violations_column(DIM_RULES, set(DIM_COLUMNS))


def duplicate_keys(rows: DataFrame) -> DataFrame:
    """K1 guard: business keys that occur more than once."""
    return rows.groupBy("article_id").count().filter(F.col("count") > 1)


def upsert(existing: DataFrame | None, incoming: DataFrame, now: Column | None = None,
           id_base: int = 0, order: str | None = None, new_id: Column | None = None) -> DataFrame:
    """Merge ``incoming`` (unique article_id) into ``existing``.

    ``order`` names a column of both (the staging order within a platform);
    it is kept, and a row that is older than the one it meets changes nothing.

    Matched keys take the incoming values, keep ``created_at`` and set
    ``updated_at`` = now; new keys get both timestamps = now and a fresh
    surrogate ``id`` (``id_base`` + a unique, non-contiguous number, or
    ``new_id`` over the incoming columns); keys not in the batch stay as they
    are.  One full outer join on article_id;
    with both sides partitioned on the key it is a co-located sort-merge."""
    now = now if now is not None else F.current_timestamp()
    kept = [order] if order else []
    fresh = F.col("_new_id") if new_id is not None else F.lit(id_base) + F.monotonically_increasing_id()
    inc = incoming.select(*DIM_COLUMNS, *kept, *([new_id.alias("_new_id")] if new_id is not None else [])).withColumn("_in", F.lit(True))
    if existing is None:
        return inc.select(
            fresh.alias("id"),
            *DIM_COLUMNS, now.alias("created_at"), now.alias("updated_at"), *kept)
    e = existing.alias("e")
    i = inc.alias("i")
    j = e.join(i, F.col("e.article_id") == F.col("i.article_id"), "full_outer")
    hit = F.col("i._in").isNotNull()
    if order:
        older = ((F.col("i.source_platform") == F.col("e.source_platform"))
                 & (F.col(f"i.{order}") < F.col(f"e.{order}")))
        hit = hit & ~F.coalesce(older, F.lit(False))
    vals = [F.when(hit, F.col(f"i.{c}")).otherwise(F.col(f"e.{c}")).alias(c)
            for c in DIM_VALUE_COLUMNS]
    return j.select(
        F.coalesce(F.col("e.id"), fresh).alias("id"),
        F.coalesce(F.col("e.article_id"), F.col("i.article_id")).alias("article_id"),
        *vals,
        F.coalesce(F.col("e.created_at"), now).alias("created_at"),
        F.when(hit, now).otherwise(F.col("e.updated_at")).alias("updated_at"),
        *[F.when(hit, F.col(f"i.{c}")).otherwise(F.col(f"e.{c}")).alias(c) for c in kept])


def upsert_counts(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Inserted vs updated keys of a batch (for the run report)."""
    keys = incoming.select("article_id").distinct()
    if existing is None:
        return keys.agg(F.count(F.lit(1)).alias("inserted"), F.lit(0).cast("long").alias("updated"))
    ek = existing.select("article_id", F.lit(True).alias("_e"))
    j = keys.join(ek, "article_id", "left")
    return j.agg(F.count_if(F.col("_e").isNull()).alias("inserted"),
                 F.count_if(F.col("_e").isNotNull()).alias("updated"))


# --- monitoring queries (A7-A9, O4-O6) -------------------------------------
def stats(dim: DataFrame) -> DataFrame:
    """Total, per-platform counts and publication date range, one pass."""
    return dim.agg(F.count(F.lit(1)).alias("total"),
                   F.count_if(F.col("source_platform") == GFG).alias("gfg_count"),
                   F.count_if(F.col("source_platform") == MEDIUM).alias("medium_count"),
                   F.min("pub_date").alias("earliest_pub"),
                   F.max("pub_date").alias("latest_pub"))


def platform_counts(dim: DataFrame) -> DataFrame:
    """A7 + F16: ``<platform>_count`` keys with their article counts, for any
    set of platforms (the long form of the stats record)."""
    return dim.groupBy(platform_count_key(F.col("source_platform")).alias("stat")) \
              .agg(F.count(F.lit(1)).alias("value"))


def by_platform(dim: DataFrame) -> DataFrame:
    """Articles and publication range per platform."""
    return dim.groupBy("source_platform").agg(
        F.count(F.lit(1)).alias("article_count"),
        F.min("pub_date").alias("earliest_pub"), F.max("pub_date").alias("latest_pub"))


def top_categories(dim: DataFrame, n: int = 10) -> DataFrame:
    """The n largest categories (NULL category excluded; ties by name)."""
    return (dim.filter(F.col("category").isNotNull()).groupBy("category")
               .agg(F.count(F.lit(1)).alias("article_count"))
               .orderBy(F.col("article_count").desc(), F.col("category").asc()).limit(n))


def recent(dim: DataFrame, n: int = 20, order_col: str = "created_at") -> DataFrame:
    """The n latest rows by ``order_col`` (ties by article_id)."""
    return dim.orderBy(F.col(order_col).desc_nulls_last(), F.col("article_id").asc()).limit(n)
