"""Registered article-ETL queries (scalars, staging, validation, quarantine,
dimension, ledger, monitoring) over the test tables, with DuckDB oracles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import scalars as S
from quire.operators import dimension as dim
from quire.operators import ledger as led
from quire.operators import staging as stg
from quire.operators import validate as val
from quire.operators import profile as prof
from quire.operators.rules import GFG_RULES, MEDIUM_RULES
from quire.plans import testdata as td

T0 = "2024-01-01 00:00:00"
T1 = "2024-02-01 00:00:00"
SINCE = "2024-06-01"


# --- shared inputs -----------------------------------------------------------
def art_staging(spark: SparkSession, sf: str) -> DataFrame:
    return stg.transform_gfg(td.article_rows(spark, sf))


def feed_staging(spark: SparkSession, sf: str) -> DataFrame:
    return stg.transform_feed(td.feed_entries(spark, sf)).withColumnRenamed("pos", "id")


def art_validation(spark, sf):
    return val.validate(art_staging(spark, sf), GFG_RULES, "id")


def feed_validation(spark, sf):
    return val.validate(feed_staging(spark, sf), MEDIUM_RULES, "id")


def broken_validations(spark, sf):
    """Both sources, with every check failing somewhere."""
    return (val.validate(td.broken_articles(art_staging(spark, sf)), GFG_RULES, "id"),
            val.validate(td.broken_feed(feed_staging(spark, sf)), MEDIUM_RULES, "id"))


def dim_gfg_rows(spark, sf):
    return dim.gfg_to_dim(art_validation(spark, sf).clean)


def dim_feed_rows(spark, sf):
    return dim.feed_to_dim(feed_validation(spark, sf).clean)


def dim_loaded(spark, sf, now=None):
    """GFG batch, then feed batch, each deduped then upserted."""
    now = now if now is not None else F.lit(T0).cast("timestamp")
    d = dim.upsert(None, dim.latest_per_key(dim_gfg_rows(spark, sf)), now)
    return dim.upsert(d, dim.latest_per_key(dim_feed_rows(spark, sf)), now)


# --- queries ---------------------------------------------------------------
def q_url_slug(spark, sf):
    p = td.table(spark, sf, "pages")     # light per-row work, html not read
    return p.select("page_id", "url", S.url_slug(F.col("url")).alias("article_id"))


def _human_raw():
    bad = F.col("o_orderkey") % 10 == 0
    return F.when(bad, F.concat(F.lit("31 Feb, "), F.year("o_orderdate").cast("string"))) \
        .otherwise(F.date_format("o_orderdate", "dd MMM, yyyy"))


def q_parse_human_date(spark, sf):
    o = td.table(spark, sf, "orders").select("o_orderkey", _human_raw().alias("raw"))
    return o.select("o_orderkey", "raw",
                    S.to_staging_timestamp_text(S.parse_human_date(F.col("raw"))).alias("last_updated"))


def _mixed_raw():
    k = F.col("o_orderkey")
    rfc = F.concat(F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss"),
                   F.when(k % 2 == 0, F.lit(" GMT")).otherwise(F.lit(" +0000")))
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return F.when(k % 3 == 0, rfc).when(k % 3 == 1, iso).otherwise(F.lit("not a date"))


def q_mixed_dates(spark, sf):
    o = td.table(spark, sf, "orders").select("o_orderkey", _mixed_raw().alias("raw"))
    return o.select("o_orderkey", "raw",
                    S.to_iso_date_text(S.parse_mixed_date(F.col("raw"))).alias("published"))


def q_nested_to_json(spark, sf):
    e = td.feed_entries(spark, sf)
    f = {x.name: x.dataType for x in e.schema.fields}
    return e.select(F.col("pos").alias("doc_id"),
                    *[S.nested_to_json(F.col(c), f[c]).alias(c)
                      for c in ("title_detail", "tags", "authors")],
                    S.nested_to_json(F.col("title"), f["title"]).alias("title_json"))


def q_first_tag_author(spark, sf):
    s = feed_staging(spark, sf)
    return s.select("id", S.first_tag(F.col("tags")).alias("category"),
                    S.first_author(F.col("authors")).alias("author"))


def q_numeric_coerce(spark, sf):
    e = td.table(spark, sf, "events")
    raw = F.when(F.col("event_type") == "error", F.lit(":")).otherwise(F.col("value").cast("string"))
    return e.select("event_id", S.to_number(raw).alias("VALUE"))


def q_gfg_staging(spark, sf):
    return art_staging(spark, sf)


def q_feed_staging(spark, sf):
    return feed_staging(spark, sf)


def q_dedupe_keep_last(spark, sf):
    d = td.table(spark, sf, "documents")   # shuffles on text right away
    return stg.dedupe_keep_last(d, ["text"], "doc_id")


def q_dq_failures(spark, sf):
    a = art_validation(spark, sf).failures.withColumn("source_table", F.lit(GFG_RULES.table))
    f = feed_validation(spark, sf).failures.withColumn("source_table", F.lit(MEDIUM_RULES.table))
    return a.unionByName(f)


def q_dq_failure_count(spark, sf):
    return val.failure_count(feed_validation(spark, sf).annotated)


def q_dq_quarantine(spark, sf):
    return feed_validation(spark, sf).quarantine()


def q_dq_clean(spark, sf):
    return feed_validation(spark, sf).clean


def q_dq_report(spark, sf):
    return val.dq_report(q_dq_failures(spark, sf))


def _both(validations, part):
    a, b = (part(v).withColumn("source_table", F.lit(v.rules.table)) for v in validations)
    return a.unionByName(b)


def q_dq_broken_failures(spark, sf):
    return _both(broken_validations(spark, sf), lambda v: v.failures)


def q_dq_broken_report(spark, sf):
    return val.dq_report(q_dq_broken_failures(spark, sf))


def q_dq_broken_count(spark, sf):
    return _both(broken_validations(spark, sf), lambda v: val.failure_count(v.annotated))


def q_dq_broken_quarantine(spark, sf):
    return _both(broken_validations(spark, sf), lambda v: v.quarantine())


def q_dq_broken_clean(spark, sf):
    return _both(broken_validations(spark, sf), lambda v: v.clean.select("id", "title", "link"))


def q_dq_profile(spark, sf):
    """Profiles of four runs, merged from their rows; the exact part."""
    def runs(v):
        return prof.batch_profile(v.annotated.withColumn("run_id", F.col("id") % 4), v.rules, ["run_id"])
    return prof.readable(prof.merge_profiles(_both(broken_validations(spark, sf), runs))).select("source_table", "column", *prof.EXACT)


def q_dq_completeness(spark, sf):
    return val.completeness(art_staging(spark, sf), stg.GFG_STAGING_COLUMNS)


def q_dim_gfg(spark, sf):
    return dim_gfg_rows(spark, sf).select(*dim.DIM_COLUMNS)


def q_dim_feed(spark, sf):
    return dim_feed_rows(spark, sf).select(*dim.DIM_COLUMNS)


def q_dim_union(spark, sf):
    return dim.union_sources(dim_gfg_rows(spark, sf), dim_feed_rows(spark, sf)).select(*dim.DIM_COLUMNS)


def q_dim_duplicate_keys(spark, sf):
    return dim.duplicate_keys(dim.union_sources(dim_gfg_rows(spark, sf), dim_feed_rows(spark, sf)))


def q_ledger_state(spark, sf):
    return led.current_state(_ledger(spark, sf))


def q_dim_load(spark, sf):
    return dim_loaded(spark, sf).select(*dim.DIM_COLUMNS, "created_at", "updated_at")


def q_dim_upsert(spark, sf):
    rows = dim_feed_rows(spark, sf)
    doc = F.col("_src_pk")
    existing = dim.upsert(None, rows.filter(doc % 2 == 0), F.lit(T0).cast("timestamp"))
    changed = rows.filter(doc % 4 == 0).withColumn("title", F.concat("title", F.lit(" [rev]")))
    incoming = rows.filter(doc % 2 == 1).unionByName(changed)
    out = dim.upsert(existing, incoming, F.lit(T1).cast("timestamp"))
    return out.select(*dim.DIM_COLUMNS, "created_at", "updated_at")


def q_dim_upsert_counts(spark, sf):
    rows = dim_feed_rows(spark, sf)
    doc = F.col("_src_pk")
    existing = dim.upsert(None, rows.filter(doc % 2 == 0), F.lit(T0).cast("timestamp"))
    incoming = rows.filter((doc % 2 == 1) | (doc % 4 == 0))
    return dim.upsert_counts(existing, incoming)


def _ledger(spark, sf):
    labels = td.table(spark, sf, "labels")
    t = MEDIUM_RULES.table
    run1 = led.mark_processed(labels, t, "doc_id", 1, F.lit(T0))
    run2 = led.reopen(labels.filter(F.col("toxic") == 1), t, "doc_id", 2, F.lit(T1))
    return run1.unionByName(run2)


def q_unprocessed(spark, sf):
    s = feed_staging(spark, sf)
    return led.unprocessed(s, _ledger(spark, sf), MEDIUM_RULES.table, "id").select("id", "id_rss", "title")


def q_dim_stats(spark, sf):
    return dim.stats(dim_loaded(spark, sf))


def q_dim_platform_counts(spark, sf):
    return dim.platform_counts(dim_loaded(spark, sf))


def q_dim_by_platform(spark, sf):
    return dim.by_platform(dim_loaded(spark, sf))


def q_dim_top_categories(spark, sf):
    return dim.top_categories(dim_loaded(spark, sf), 10)


def q_dim_recent(spark, sf):
    return dim.recent(dim_loaded(spark, sf), 20, "pub_date").select("article_id", "source_platform",
                                                                    "title", "pub_date")


def q_dim_latest(spark, sf):
    """The latest 20 of a dimension whose feeds were loaded a month after the articles."""
    d = dim.upsert(None, dim.latest_per_key(dim_gfg_rows(spark, sf)), F.lit(T0).cast("timestamp"))
    d = dim.upsert(d, dim.latest_per_key(dim_feed_rows(spark, sf)), F.lit(T1).cast("timestamp"))
    return dim.recent(d, 20).select("article_id", "source_platform", "title", "created_at")


def q_sql_params(spark, sf):
    d = dim_loaded(spark, sf).select(*dim.DIM_COLUMNS)
    return spark.sql(
        "SELECT article_id, title, pub_date FROM {d} "
        "WHERE source_platform = :platform AND pub_date >= :since",
        args={"platform": dim.MEDIUM, "since": dt.date.fromisoformat(SINCE)}, d=d)


QUERIES = {
    "url_slug": q_url_slug,
    "parse_human_date": q_parse_human_date,
    "mixed_dates": q_mixed_dates,
    "nested_to_json": q_nested_to_json,
    "first_tag_author": q_first_tag_author,
    "numeric_coerce": q_numeric_coerce,
    "gfg_staging": q_gfg_staging,
    "feed_staging": q_feed_staging,
    "dedupe_keep_last": q_dedupe_keep_last,
    "dq_failures": q_dq_failures,
    "dq_failure_count": q_dq_failure_count,
    "dq_quarantine": q_dq_quarantine,
    "dq_clean": q_dq_clean,
    "dq_report": q_dq_report,
    "dq_completeness": q_dq_completeness,
    "dq_broken_failures": q_dq_broken_failures,
    "dq_broken_report": q_dq_broken_report,
    "dq_broken_count": q_dq_broken_count,
    "dq_broken_quarantine": q_dq_broken_quarantine,
    "dq_broken_clean": q_dq_broken_clean,
    "dq_profile": q_dq_profile,
    "dim_gfg": q_dim_gfg,
    "dim_feed": q_dim_feed,
    "dim_union": q_dim_union,
    "dim_duplicate_keys": q_dim_duplicate_keys,
    "ledger_state": q_ledger_state,
    "dim_load": q_dim_load,
    "dim_upsert": q_dim_upsert,
    "dim_upsert_counts": q_dim_upsert_counts,
    "unprocessed": q_unprocessed,
    "dim_stats": q_dim_stats,
    "dim_by_platform": q_dim_by_platform,
    "dim_platform_counts": q_dim_platform_counts,
    "dim_top_categories": q_dim_top_categories,
    "dim_recent": q_dim_recent,
    "dim_latest": q_dim_latest,
    "sql_params": q_sql_params,
}

# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# ---------------------------------------------------------------------------
_FEED = f"""
feed_stg AS (
  SELECT source AS feed, doc_id AS id, split_part(text, chr(10), 1) AS title,
    '{{"language":"' || lang || '","type":"text/plain"}}' AS title_detail,
    text AS summary,
    '{{"language":"' || lang || '","type":"text/html"}}' AS summary_detail,
    'https://' || source || '.example.org/p/' || CAST(doc_id AS VARCHAR) || '/' AS link,
    CAST(doc_id AS VARCHAR) AS id_rss,
    strftime(DATE '{td.FEED_DAY0}' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d') AS published,
    '' AS published_parsed,
    strftime(DATE '{td.FEED_DAY0}' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d') AS updated,
    CASE WHEN doc_id % 7 <> 0 THEN '[{{"term":"' || lang || '"}}]' ELSE '{{}}' END AS tags,
    '[{{"name":"' || source || '"}}]' AS authors
  FROM documents)"""

_ART = f"""
art_stg AS (
  SELECT page_id AS id, string_split(url, '/')[-2] AS article_id,
    NULLIF(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '') AS title,
    NULLIF(regexp_extract(url, '^https?://([^./]+)', 1), '') AS author_id,
    strftime(DATE '{td.ARTICLE_DAY0}' + CAST(page_id % 400 AS INTEGER), '%Y-%m-%d %H:%M:%S') AS last_updated,
    url AS link,
    NULLIF(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS category
  FROM pages)"""


# The two rule tables as SQL, written out: (column, check, condition under
# which it fails).  Not derived from the RuleSets that they test.
_ART_FAILS = [
    ("article_id", "not_nullable", "article_id IS NULL"),
    ("article_id", "article_id cannot be empty", "article_id = ''"),
    ("title", "not_nullable", "title IS NULL"),
    ("title", "title too short", "length(title) < 6"),
    ("title", "title too long", "length(title) > 200"),
    ("author_id", "invalid author_id format", "NOT regexp_full_match(author_id, '[a-zA-Z0-9_-]+')"),
    ("last_updated", "invalid datetime format", "NOT regexp_full_match(last_updated, '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}')"),
    ("link", "missing valid URL", "NOT regexp_matches(link, 'https?://[a-zA-Z0-9.-]+[.][a-zA-Z]{2,}')"),
]
_FEED_FAILS = [
    ("id_rss", "not_nullable", "id_rss IS NULL"),
    ("id_rss", "id_rss cannot be empty", "id_rss = ''"),
    ("title", "not_nullable", "title IS NULL"),
    ("title", "title too short", "length(title) < 3"),
    ("title", "title too long", "length(title) > 500"),
    ("title_detail", "title_detail must be valid JSON format", "left(title_detail, 1) NOT IN ('{', '[')"),
    ("summary", "summary too long", "length(summary) > 5000"),
    ("summary_detail", "summary_detail must be valid JSON format", "left(summary_detail, 1) NOT IN ('{', '[')"),
    ("link", "missing valid URL", "NOT regexp_matches(link, 'https?://[a-zA-Z0-9.-]+[.][a-zA-Z]{2,}')"),
    ("published", "published must be in format YYYY-MM-DD", "NOT regexp_full_match(published, '[0-9]{4}-[0-9]{2}-[0-9]{2}')"),
    ("published_parsed", "published_parsed too long", "length(published_parsed) > 200"),
    ("updated", "updated must be in format YYYY-MM-DD", "NOT regexp_full_match(updated, '[0-9]{4}-[0-9]{2}-[0-9]{2}')"),
    ("tags", "tags must be valid JSON array", "left(tags, 1) <> '['"),
    ("authors", "authors must be valid JSON array", "left(authors, 1) <> '['"),
]
_ART_TABLE, _FEED_TABLE = "stg_gfg_articles", "stg_medium_articles"


def _failures_sql(fails: list, table: str, src: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS source_table, CAST(id AS VARCHAR) AS pk_value, '{col}' AS \"column\", '{check}' AS \"check\", CAST({col} AS VARCHAR) AS failure_case "
        f"FROM {src} WHERE {failed}" for col, check, failed in fails)


def _any_failed(fails: list, column: str | None = None) -> str:
    return "coalesce(" + " OR ".join(f"({f})" for col, _, f in fails if column in (None, col)) + ", false)" if fails else "false"


def _quarantine_sql(fails: list, table: str, src: str, n_columns: int) -> str:
    cases = ", ".join(f"CASE WHEN {_any_failed(fails, c)} THEN '{c}' END" for c in dict.fromkeys(c for c, _, _ in fails))
    return f"""SELECT '{table}' AS source_table, 'id' AS pk_column_name, CAST(id AS VARCHAR) AS pk_value,
       CAST({n_columns} AS INTEGER) AS total_columns, 'Failed columns: ' || concat_ws(', ', {cases}) AS validation_error
FROM {src} WHERE {_any_failed(fails)}"""


# The staging rows that td.broken_articles and td.broken_feed make, written out.
_BROKEN = """
art_bad AS (SELECT * REPLACE (
    CASE id % 20 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE article_id END AS article_id,
    CASE id % 20 WHEN 2 THEN NULL WHEN 3 THEN 'short' WHEN 4 THEN repeat('t', 201) WHEN 8 THEN 'abc' WHEN 10 THEN 'sixsix' WHEN 11 THEN repeat('t', 200) ELSE title END AS title,
    CASE id % 20 WHEN 5 THEN 'a b' WHEN 9 THEN NULL WHEN 13 THEN 'ok_-9' ELSE author_id END AS author_id,
    CASE id % 20 WHEN 6 THEN '2024-1-2' WHEN 12 THEN NULL ELSE last_updated END AS last_updated,
    CASE id % 20 WHEN 7 THEN 'ftp://x' WHEN 8 THEN 'none' WHEN 14 THEN 'see https://ex.org/x' ELSE link END AS link) FROM art_stg),
feed_bad AS (SELECT * REPLACE (
    CASE id % 40 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE id_rss END AS id_rss,
    CASE id % 40 WHEN 2 THEN NULL WHEN 3 THEN 'ab' WHEN 4 THEN repeat('t', 501) WHEN 18 THEN 'x' WHEN 19 THEN 'abc' WHEN 20 THEN repeat('t', 500) ELSE title END AS title,
    CASE id % 40 WHEN 5 THEN 'x' WHEN 14 THEN '[' ELSE title_detail END AS title_detail,
    CASE id % 40 WHEN 6 THEN repeat('s', 5001) WHEN 15 THEN repeat('s', 5000) ELSE summary END AS summary,
    CASE id % 40 WHEN 7 THEN '' ELSE summary_detail END AS summary_detail,
    CASE id % 40 WHEN 8 THEN 'nolink' ELSE link END AS link,
    CASE id % 40 WHEN 9 THEN '2024/01/01' WHEN 16 THEN NULL ELSE published END AS published,
    CASE id % 40 WHEN 10 THEN repeat('p', 201) WHEN 21 THEN repeat('p', 200) ELSE published_parsed END AS published_parsed,
    CASE id % 40 WHEN 11 THEN 'soon' ELSE updated END AS updated,
    CASE id % 40 WHEN 12 THEN '{}' WHEN 17 THEN NULL WHEN 18 THEN '{' ELSE tags END AS tags,
    CASE id % 40 WHEN 13 THEN 'Ann' WHEN 18 THEN '' ELSE authors END AS authors) FROM feed_stg)"""


_DIM = f"""
art_clean AS (SELECT * FROM art_stg WHERE NOT {_any_failed(_ART_FAILS)}),
feed_clean AS (SELECT * FROM feed_stg WHERE NOT {_any_failed(_FEED_FAILS)}),
dim_g AS (
  SELECT article_id, 'GFG' AS source_platform, title, author_id AS author,
         CAST(substr(last_updated, 1, 10) AS DATE) AS pub_date, link, category,
         true AS is_valid, id AS src_pk FROM art_clean),
dim_f AS (
  SELECT id_rss AS article_id, 'Medium' AS source_platform, title,
         json_extract_string(authors, '$[0].name') AS author,
         TRY_CAST(published AS DATE) AS pub_date, link,
         json_extract_string(tags, '$[0].term') AS category,
         true AS is_valid, id AS src_pk FROM feed_clean),
g_last AS (SELECT * FROM dim_g QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY src_pk DESC) = 1),
f_last AS (SELECT * FROM dim_f QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY src_pk DESC) = 1),
dim_all AS (
  SELECT coalesce(g.article_id, f.article_id) AS article_id,
         CASE WHEN f.article_id IS NOT NULL THEN f.source_platform ELSE g.source_platform END AS source_platform,
         CASE WHEN f.article_id IS NOT NULL THEN f.title ELSE g.title END AS title,
         CASE WHEN f.article_id IS NOT NULL THEN f.author ELSE g.author END AS author,
         CASE WHEN f.article_id IS NOT NULL THEN f.pub_date ELSE g.pub_date END AS pub_date,
         CASE WHEN f.article_id IS NOT NULL THEN f.link ELSE g.link END AS link,
         CASE WHEN f.article_id IS NOT NULL THEN f.category ELSE g.category END AS category,
         true AS is_valid,
         TIMESTAMP '{T0}' AS created_at, TIMESTAMP '{T0}' AS updated_at
  FROM g_last g FULL OUTER JOIN f_last f ON g.article_id = f.article_id)"""

_W = f"WITH {_FEED}, {_ART}"
_WD = f"{_W}, {_DIM}"
_DIMCOLS = "article_id, source_platform, title, author, pub_date, link, category, is_valid"


_FAILURES = f"""{_W}, failures AS (
{_failures_sql(_ART_FAILS, _ART_TABLE, 'art_stg')}
UNION ALL
{_failures_sql(_FEED_FAILS, _FEED_TABLE, 'feed_stg')})"""
_WB = f"{_W}, {_BROKEN}"
_BROKEN_FAILURES = f"""{_WB}, failures AS (
{_failures_sql(_ART_FAILS, _ART_TABLE, 'art_bad')}
UNION ALL
{_failures_sql(_FEED_FAILS, _FEED_TABLE, 'feed_bad')})"""


def _profile_sql(fails: list, table: str, src: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{table}' AS source_table, '{c}' AS "column", count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_null,
  (SELECT count(*) FROM failures f WHERE f.source_table = '{table}' AND f."column" = '{c}') AS n_failures,
  min(length({c}))::INTEGER AS min_length, max(length({c}))::INTEGER AS max_length FROM {src}""" for c in columns)



ORACLE = {
    "url_slug": "SELECT page_id, url, string_split(url, '/')[-2] AS article_id FROM pages",
    "parse_human_date": """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 10 = 0 THEN '31 Feb, ' || CAST(year(o_orderdate) AS VARCHAR)
       ELSE strftime(o_orderdate, '%d %b, %Y') END AS raw,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL
       ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d %H:%M:%S') END AS last_updated
FROM orders""",
    "mixed_dates": """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S')
            || CASE WHEN o_orderkey % 2 = 0 THEN ' GMT' ELSE ' +0000' END
       WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ')
       ELSE 'not a date' END AS raw,
  CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS published
FROM orders""",
    "nested_to_json": """
SELECT doc_id,
  '{"language":"' || lang || '","type":"text/plain"}' AS title_detail,
  CASE WHEN doc_id % 7 <> 0 THEN '[{"term":"' || lang || '"}]' ELSE '{}' END AS tags,
  '[{"name":"' || source || '"}]' AS authors,
  '{}' AS title_json
FROM documents""",
    "first_tag_author": f"""{_W}
SELECT id, json_extract_string(tags, '$[0].term') AS category,
       json_extract_string(authors, '$[0].name') AS author FROM feed_stg""",
    "numeric_coerce": """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS VALUE FROM events""",
    "gfg_staging": f"{_W} SELECT * FROM art_stg",
    "feed_staging": f"{_W} SELECT * FROM feed_stg",
    "dedupe_keep_last": """
SELECT doc_id, text, lang, source, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) = 1""",
    "dq_failures": f"{_FAILURES} SELECT * FROM failures",
    "dq_failure_count": f"""{_W}, f AS ({_failures_sql(_FEED_FAILS, _FEED_TABLE, 'feed_stg')})
SELECT (SELECT count(*) FROM f) AS n_failures,
       (SELECT count(DISTINCT pk_value) FROM f) AS n_failed_rows,
       (SELECT count(*) FROM feed_stg) AS n_rows""",
    # feed, id and the 11 staging columns
    "dq_quarantine": f"{_W} {_quarantine_sql(_FEED_FAILS, _FEED_TABLE, 'feed_stg', 13)}",
    "dq_broken_failures": f"{_BROKEN_FAILURES} SELECT * FROM failures",
    "dq_broken_report": f"""{_BROKEN_FAILURES}
SELECT source_table, "column", "check", count(*) AS n_failures FROM failures
GROUP BY source_table, "column", "check\"""",
    "dq_broken_count": f"""{_BROKEN_FAILURES}
SELECT '{_ART_TABLE}' AS source_table, count(*) AS n_failures, count(DISTINCT pk_value) AS n_failed_rows, (SELECT count(*) FROM art_bad) AS n_rows
FROM failures WHERE source_table = '{_ART_TABLE}'
UNION ALL SELECT '{_FEED_TABLE}', count(*), count(DISTINCT pk_value), (SELECT count(*) FROM feed_bad) FROM failures WHERE source_table = '{_FEED_TABLE}'""",
    "dq_broken_quarantine": f"""{_WB}
{_quarantine_sql(_ART_FAILS, _ART_TABLE, 'art_bad', 7)}
UNION ALL
{_quarantine_sql(_FEED_FAILS, _FEED_TABLE, 'feed_bad', 13)}""",
    "dq_broken_clean": f"""{_WB}
SELECT '{_ART_TABLE}' AS source_table, id, title, link FROM art_bad WHERE NOT {_any_failed(_ART_FAILS)}
UNION ALL SELECT '{_FEED_TABLE}', id, title, link FROM feed_bad WHERE NOT {_any_failed(_FEED_FAILS)}""",
    "dq_profile": f"""{_BROKEN_FAILURES}
{_profile_sql(_ART_FAILS, _ART_TABLE, 'art_bad', ["article_id", "title", "author_id", "last_updated", "link", "category"])}
UNION ALL
{_profile_sql(_FEED_FAILS, _FEED_TABLE, 'feed_bad', ["id_rss", "title", "title_detail", "summary", "summary_detail", "link", "published", "published_parsed", "updated", "tags", "authors"])}""",
    "dim_latest": f"""{_WD}
SELECT coalesce(f.article_id, g.article_id) AS article_id, CASE WHEN f.article_id IS NOT NULL THEN 'Medium' ELSE 'GFG' END AS source_platform,
       CASE WHEN f.article_id IS NOT NULL THEN f.title ELSE g.title END AS title,
       CASE WHEN g.article_id IS NOT NULL THEN TIMESTAMP '{T0}' ELSE TIMESTAMP '{T1}' END AS created_at
FROM g_last g FULL OUTER JOIN f_last f ON g.article_id = f.article_id
ORDER BY created_at DESC, article_id LIMIT 20""",
    "dq_clean": f"{_W} SELECT * FROM feed_stg WHERE NOT {_any_failed(_FEED_FAILS)}",
    "dq_report": f"""{_FAILURES}
SELECT source_table, "column", "check", count(*) AS n_failures FROM failures
GROUP BY source_table, "column", "check\"""",
    "dq_completeness": f"""{_W}
SELECT avg(CAST(article_id IS NOT NULL AS DOUBLE)) AS article_id,
       avg(CAST(title IS NOT NULL AS DOUBLE)) AS title,
       avg(CAST(author_id IS NOT NULL AS DOUBLE)) AS author_id,
       avg(CAST(last_updated IS NOT NULL AS DOUBLE)) AS last_updated,
       avg(CAST(link IS NOT NULL AS DOUBLE)) AS link,
       avg(CAST(category IS NOT NULL AS DOUBLE)) AS category
FROM art_stg""",
    "dim_gfg": f"{_WD} SELECT {_DIMCOLS} FROM dim_g",
    "dim_feed": f"{_WD} SELECT {_DIMCOLS} FROM dim_f",
    "dim_union": f"{_WD} SELECT {_DIMCOLS} FROM dim_g UNION ALL SELECT {_DIMCOLS} FROM dim_f",
    "dim_duplicate_keys": f"""{_WD}
SELECT article_id, count(*) AS count FROM (SELECT article_id FROM dim_g UNION ALL SELECT article_id FROM dim_f)
GROUP BY article_id HAVING count(*) > 1""",
    "ledger_state": f"""
WITH led AS (SELECT CAST(doc_id AS VARCHAR) AS pk_value, 'processed' AS state, 1 AS run_seq FROM labels
             UNION ALL SELECT CAST(doc_id AS VARCHAR), 'open', 2 FROM labels WHERE toxic = 1)
SELECT '{_FEED_TABLE}' AS source_table, pk_value, arg_max(state, run_seq) AS state
FROM led GROUP BY pk_value""",
    "dim_load": f"{_WD} SELECT * FROM dim_all",
    "dim_upsert": f"""{_WD},
ex AS (SELECT * FROM f_last WHERE src_pk % 2 = 0),
inc AS (SELECT * FROM f_last WHERE src_pk % 2 = 1
        UNION ALL SELECT * REPLACE (title || ' [rev]' AS title) FROM f_last WHERE src_pk % 4 = 0)
SELECT coalesce(e.article_id, i.article_id) AS article_id,
       coalesce(i.source_platform, e.source_platform) AS source_platform,
       CASE WHEN i.article_id IS NOT NULL THEN i.title ELSE e.title END AS title,
       CASE WHEN i.article_id IS NOT NULL THEN i.author ELSE e.author END AS author,
       CASE WHEN i.article_id IS NOT NULL THEN i.pub_date ELSE e.pub_date END AS pub_date,
       CASE WHEN i.article_id IS NOT NULL THEN i.link ELSE e.link END AS link,
       CASE WHEN i.article_id IS NOT NULL THEN i.category ELSE e.category END AS category,
       true AS is_valid,
       CASE WHEN e.article_id IS NOT NULL THEN TIMESTAMP '{T0}' ELSE TIMESTAMP '{T1}' END AS created_at,
       CASE WHEN i.article_id IS NOT NULL THEN TIMESTAMP '{T1}' ELSE TIMESTAMP '{T0}' END AS updated_at
FROM ex e FULL OUTER JOIN inc i ON e.article_id = i.article_id""",
    "dim_upsert_counts": f"""{_WD}
SELECT count(*) FILTER (WHERE src_pk % 2 = 1) AS inserted,
       count(*) FILTER (WHERE src_pk % 4 = 0) AS updated
FROM f_last""",
    "unprocessed": f"""{_W},
led AS (SELECT CAST(doc_id AS VARCHAR) AS pk_value, 'processed' AS state, 1 AS run_seq FROM labels
        UNION ALL SELECT CAST(doc_id AS VARCHAR), 'open', 2 FROM labels WHERE toxic = 1),
cur AS (SELECT pk_value, arg_max(state, run_seq) AS state FROM led GROUP BY pk_value)
SELECT id, id_rss, title FROM feed_stg f
WHERE NOT EXISTS (SELECT 1 FROM cur WHERE cur.pk_value = CAST(f.id AS VARCHAR) AND cur.state = 'processed')""",
    "dim_stats": f"""{_WD}
SELECT count(*) AS total, count(*) FILTER (WHERE source_platform = 'GFG') AS gfg_count,
       count(*) FILTER (WHERE source_platform = 'Medium') AS medium_count,
       min(pub_date) AS earliest_pub, max(pub_date) AS latest_pub FROM dim_all""",
    "dim_by_platform": f"""{_WD}
SELECT source_platform, count(*) AS article_count, min(pub_date) AS earliest_pub,
       max(pub_date) AS latest_pub FROM dim_all GROUP BY source_platform""",
    "dim_platform_counts": f"""{_WD}
SELECT lower(source_platform) || '_count' AS stat, count(*) AS value FROM dim_all
GROUP BY lower(source_platform) || '_count'""",
    "dim_top_categories": f"""{_WD}
SELECT category, count(*) AS article_count FROM dim_all WHERE category IS NOT NULL
GROUP BY category ORDER BY article_count DESC, category ASC LIMIT 10""",
    "dim_recent": f"""{_WD}
SELECT article_id, source_platform, title, pub_date FROM dim_all
ORDER BY pub_date DESC NULLS LAST, article_id ASC LIMIT 20""",
    "sql_params": f"""{_WD}
SELECT article_id, title, pub_date FROM dim_all
WHERE source_platform = 'Medium' AND pub_date >= DATE '{SINCE}'""",
}
