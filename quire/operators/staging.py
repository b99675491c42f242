"""Source-specific normalisation into staging rows, and keep-last dedupe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quire.functions.scalars import (nested_to_json, null_to_empty, parse_human_date,
                                     parse_mixed_date, to_iso_date_text,
                                     to_staging_timestamp_text, url_slug)

GFG_STAGING_COLUMNS = ["article_id", "title", "author_id", "last_updated", "link", "category"]
FEED_STAGING_COLUMNS = ["title", "title_detail", "summary", "summary_detail", "link", "id_rss",
                        "published", "published_parsed", "updated", "tags", "authors"]
FEED_JSON_COLUMNS = ["title_detail", "summary_detail", "tags", "authors"]
FEED_SCALAR_COLUMNS = ["title", "summary", "link", "id_rss", "published_parsed"]
FEED_DATE_COLUMNS = ["published", "updated"]
#: Repeated keys that are broadcast at most, when wide rows are deduplicated.
MOST_REPEATED = 500_000


def _col_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(StringType())


def transform_gfg(df: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
    """P1 (+F1, F2, F3): article CSV rows -> staging rows.  article_id is the
    second-to-last path part of the link; last_updated '02 Jan, 2023' becomes
    '2023-01-02 00:00:00' text, unparsable dates NULL."""
    extra = [c for c in keep if c in df.columns]
    return df.select(
        *extra,
        url_slug(F.col("link")).alias("article_id"),
        F.col("title").cast("string").alias("title"),
        F.col("author_id").cast("string").alias("author_id"),
        to_staging_timestamp_text(parse_human_date(F.col("last_updated"))).alias("last_updated"),
        F.col("link").cast("string").alias("link"),
        F.col("category").cast("string").alias("category"))


def flatten_feed(df: DataFrame, feed_col: str | None = "feed",
                 pos_col: str | None = "pos", keep: Sequence[str] = ()) -> DataFrame:
    """P2 (+F4, F5, F8) without A11, row by row: feed entries -> staging rows.
    ``id`` becomes ``id_rss``; nested fields become JSON text ('{}' when
    absent); dates become 'YYYY-MM-DD' (NULL when unparsable); scalar text
    NULL -> ''."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    cols: dict[str, Column] = {}
    for c in FEED_STAGING_COLUMNS:
        src = "id" if c == "id_rss" else c
        if c in FEED_JSON_COLUMNS:
            cols[c] = nested_to_json(F.col(src), fields[src]) if src in fields else F.lit("{}")
        elif c in FEED_DATE_COLUMNS:
            cols[c] = to_iso_date_text(parse_mixed_date(_col_or_null(df, src)))
        elif c in FEED_SCALAR_COLUMNS:
            cols[c] = null_to_empty(_col_or_null(df, src))
        else:
            cols[c] = _col_or_null(df, src).cast("string")
    extra = [c for c in [feed_col, pos_col, *keep] if c and c in df.columns]
    return df.select(*extra, *[v.alias(k) for k, v in cols.items()])


def feed_keys(flat: DataFrame, feed_col: str | None = "feed") -> list[str]:
    """What tells the entries of a feed apart."""
    return ([feed_col] if feed_col and feed_col in flat.columns else []) + ["link", "id_rss"]


def transform_feed(df: DataFrame, feed_col: str | None = "feed",
                   pos_col: str | None = "pos", keep: Sequence[str] = ()) -> DataFrame:
    """``flatten_feed``; then duplicates on (link, id_rss) within one feed
    keep the last entry (A11)."""
    flat = flatten_feed(df, feed_col, pos_col, keep)
    if pos_col and pos_col in flat.columns:
        flat = keep_last_in_place(flat, feed_keys(flat, feed_col), pos_col)
    return flat


def keep_last_in_place(df: DataFrame, keys: Sequence[str], order_col: str, most: int = MOST_REPEATED) -> DataFrame:
    """A11 for wide rows: only the keys and ``order_col``, which must tell the
    rows of a key apart, are shuffled.  The keys that repeat come back with
    their last ``order_col`` and every earlier row of theirs is left out while
    the wide rows are scanned.  They are counted first: none, and the rows stay
    as they are; up to ``most``, and they are broadcast; beyond, both sides are
    joined by a shuffle."""
    again = (df.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
               .agg(F.max(order_col).alias("_last"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).drop("_n"))
    n = again.count()
    if not n:
        return df
    earlier = F.col(order_col) < F.col("_last")
    for i, k in enumerate(keys):
        earlier = earlier & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return df.join(F.broadcast(again) if n <= most else again, earlier, "left_anti")


def dedupe_keep_last(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """One row per key, the one with the greatest ``order_col``.

    ``max_by`` over a struct of the other columns is a partial aggregate: a
    key holding a third of all rows is reduced map-side before the shuffle,
    unlike ``row_number`` over a window, which sorts every copy."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    q = lambda c: "`" + c.replace("`", "``") + "`"
    # (SQL text: one parse instead of a JVM call per column)
    packed = F.expr(f"max_by(struct({', '.join(q(c) for c in rest)}), {q(order_col)})").alias("_last")
    return df.groupBy(*keys).agg(packed).selectExpr(
        *[q(c) if c in keys else f"_last.{q(c)} AS {q(c)}" for c in df.columns])
