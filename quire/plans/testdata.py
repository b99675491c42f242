"""Bindings of the library's inputs to the driver's test tables.

The reference reads an observations CSV, an article CSV and RSS feeds; the
test tables are a TPC-H-like star plus text tables.  These functions derive
inputs of the same shape from them with Spark (so every query's work grows
with the tables):

* ``observations``: order counts per nation x year x status, as a long
  statistics table (status F -> persons held, O -> capacity, P -> a third
  indicator that the analytics must ignore), in absolute numbers and per
  100,000 customers of the nation.
* ``article_rows``: article-CSV-shaped rows from ``pages``.
* ``feed_entries``: feed-entry-shaped rows (nested title/summary details,
  tag and author arrays, RFC 2822 / ISO dates) from ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.indicators import CAPACITY, HELD, UNIT_NUMBER, UNIT_PER_100K

# Fixed values of the bindings (ours, not the reference's).
OTHER_INDICATOR = "Persons held before trial"
PER_100K = 100000.0
FEED_DAY0 = "2024-01-01"
ARTICLE_DAY0 = "2023-01-01"


_SCHEMAS: dict[tuple[str, str], object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its footer schema is read once per session and then
    passed explicitly, so later reads start no schema-inference job."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long observations: geo, TIME_PERIOD, unit, indic_cr, OBS_VALUE (text)."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # Count per customer first: a customer holding a third of all orders
    # collapses into a handful of rows map-side before the join shuffles.
    per_cust = (orders.groupBy("o_custkey", F.year("o_orderdate").alias("yr"), "o_orderstatus")
                      .agg(F.count(F.lit(1)).alias("n")))
    counts = (per_cust.join(customer, per_cust.o_custkey == customer.c_custkey)
                      .groupBy("c_nationkey", "yr", "o_orderstatus")
                      .agg(F.sum("n").alias("n")))
    ncust = customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("ncust"))
    k = counts.join(ncust, "c_nationkey").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"))
    indic = (F.when(F.col("o_orderstatus") == "F", F.lit(HELD))
              .when(F.col("o_orderstatus") == "O", F.lit(CAPACITY))
              .otherwise(F.lit(OTHER_INDICATOR)))
    n = F.col("n").cast("double")
    units = F.array(
        F.struct(F.lit(UNIT_NUMBER).alias("unit"), n.alias("v")),
        F.struct(F.lit(UNIT_PER_100K).alias("unit"),
                 (n * F.lit(PER_100K) / F.col("ncust").cast("double")).alias("v")))
    return (k.select(F.col("n_name").alias("geo"), F.col("yr").cast("string").alias("TIME_PERIOD"),
                     indic.alias("indic_cr"), F.explode(units).alias("u"))
             .select("geo", "TIME_PERIOD", F.col("u.unit").alias("unit"), "indic_cr",
                     F.col("u.v").cast("string").alias("OBS_VALUE")))


def order_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long observations with many rows to a cell: one for each order, its
    price as the value and its key as the input position."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    indic = (F.when(F.col("o_orderstatus") == "F", F.lit(HELD))
              .when(F.col("o_orderstatus") == "O", F.lit(CAPACITY))
              .otherwise(F.lit(OTHER_INDICATOR)))
    return (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
                  .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                  .select(F.col("n_name").alias("geo"), F.year("o_orderdate").cast("string").alias("TIME_PERIOD"),
                          F.lit(UNIT_NUMBER).alias("unit"), indic.alias("indic_cr"),
                          F.col("o_totalprice").cast("string").alias("OBS_VALUE"), F.col("o_orderkey").alias("_pos")))


def article_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article-CSV rows: id (page_id), title (<title> text), author_id (first
    host label), last_updated ('dd MMM, yyyy' text), link (url), category
    (the page's lang attribute)."""
    pages = table(spark, sf_dir, "pages")
    day = F.date_add(F.lit(ARTICLE_DAY0).cast("date"), (F.col("page_id") % 400).cast("int"))
    return pages.select(
        F.col("page_id").alias("id"),
        F.nullif(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1), F.lit("")).alias("title"),
        F.nullif(F.regexp_extract("url", r"^https?://([^./]+)", 1), F.lit("")).alias("author_id"),
        F.date_format(day, "dd MMM, yyyy").alias("last_updated"),
        F.col("url").alias("link"),
        F.nullif(F.regexp_extract("html", r'<html lang="([^"]*)"', 1), F.lit("")).alias("category"))


def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed entries as a feed parser / XML reader delivers them: nested
    details, tag and author arrays (tags missing for every 7th document),
    RFC 2822 ``published`` and ISO ``updated`` text."""
    docs = table(spark, sf_dir, "documents")
    day = F.date_add(F.lit(FEED_DAY0).cast("date"), (F.col("doc_id") % 365).cast("int"))
    tags = F.when(F.col("doc_id") % 7 != 0, F.array(F.struct(F.col("lang").alias("term"))))
    return docs.select(
        F.col("source").alias("feed"),
        F.col("doc_id").alias("pos"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.struct(F.col("lang").alias("language"), F.lit("text/plain").alias("type")).alias("title_detail"),
        F.col("text").alias("summary"),
        F.struct(F.col("lang").alias("language"), F.lit("text/html").alias("type")).alias("summary_detail"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/p/"),
                 F.col("doc_id").cast("string"), F.lit("/")).alias("link"),
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.date_format(day, "EEE, dd MMM yyyy"), F.lit(" 10:00:00 GMT")).alias("published"),
        F.lit(None).cast("string").alias("published_parsed"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:00:00.000Z")).alias("updated"),
        tags.alias("tags"),
        F.array(F.struct(F.col("source").alias("name"))).alias("authors"))


def broken_articles(staging: DataFrame) -> DataFrame:
    """Article staging rows in which every check fails for some id (by its
    remainder modulo 20), and values at the limits pass."""
    r = F.col("id") % 20
    return (staging
            .withColumn("article_id", F.when(r == 0, F.lit(None)).when(r == 1, "").otherwise(F.col("article_id")))
            .withColumn("title", F.when(r == 2, F.lit(None)).when(r == 3, "short").when(r == 4, F.repeat(F.lit("t"), 201)).when(r == 8, "abc")
                        .when(r == 10, "sixsix").when(r == 11, F.repeat(F.lit("t"), 200)).otherwise(F.col("title")))
            .withColumn("author_id", F.when(r == 5, "a b").when(r == 9, F.lit(None)).when(r == 13, "ok_-9").otherwise(F.col("author_id")))
            .withColumn("last_updated", F.when(r == 6, "2024-1-2").when(r == 12, F.lit(None)).otherwise(F.col("last_updated")))
            .withColumn("link", F.when(r == 7, "ftp://x").when(r == 8, "none").when(r == 14, "see https://ex.org/x").otherwise(F.col("link"))))


def broken_feed(staging: DataFrame) -> DataFrame:
    """Feed staging rows in which every check fails for some id (by its
    remainder modulo 40), and values at the limits pass."""
    r, c = F.col("id") % 40, F.col
    return (staging
            .withColumn("id_rss", F.when(r == 0, F.lit(None)).when(r == 1, "").otherwise(c("id_rss")))
            .withColumn("title", F.when(r == 2, F.lit(None)).when(r == 3, "ab").when(r == 4, F.repeat(F.lit("t"), 501)).when(r == 18, "x")
                        .when(r == 19, "abc").when(r == 20, F.repeat(F.lit("t"), 500)).otherwise(c("title")))
            .withColumn("title_detail", F.when(r == 5, "x").when(r == 14, "[").otherwise(c("title_detail")))
            .withColumn("summary", F.when(r == 6, F.repeat(F.lit("s"), 5001)).when(r == 15, F.repeat(F.lit("s"), 5000)).otherwise(c("summary")))
            .withColumn("summary_detail", F.when(r == 7, "").otherwise(c("summary_detail")))
            .withColumn("link", F.when(r == 8, "nolink").otherwise(c("link")))
            .withColumn("published", F.when(r == 9, "2024/01/01").when(r == 16, F.lit(None)).otherwise(c("published")))
            .withColumn("published_parsed", F.when(r == 10, F.repeat(F.lit("p"), 201)).when(r == 21, F.repeat(F.lit("p"), 200)).otherwise(c("published_parsed")))
            .withColumn("updated", F.when(r == 11, "soon").otherwise(c("updated")))
            .withColumn("tags", F.when(r == 12, "{}").when(r == 17, F.lit(None)).when(r == 18, "{").otherwise(c("tags")))
            .withColumn("authors", F.when(r == 13, "Ann").when(r == 18, "").otherwise(c("authors"))))
