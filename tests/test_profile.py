"""Quality profiles merged over runs, against a profile of all rows at once."""

from pyspark.sql import functions as F

from quire.operators import profile as prof
from quire.operators import validate as val
from quire.operators.rules import GFG_RULES
from quire.plans import etl_queries as eq
from quire.plans import pipeline as pl
from quire.sources.tables import Workspace

from test_commit import articles


def test_merged_runs_equal_one_profile(spark):
    rows = spark.range(20_000).select(
        F.col("id"), F.concat(F.lit("a"), F.col("id") % 7000).alias("article_id"), F.repeat(F.lit("t"), (F.col("id") % 300).cast("int")).alias("title"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("bob"), F.col("id"))).alias("author_id"), F.lit(None).cast("string").alias("last_updated"),
        F.lit("https://ex.org/x").alias("link"), F.lit("c").alias("category"))
    annotated = val.annotate(rows, GFG_RULES)
    whole = prof.readable(prof.batch_profile(annotated, GFG_RULES))
    runs = prof.batch_profile(annotated.withColumn("run", F.col("id") % 9), GFG_RULES, ["run"])
    merged = {r.column: r for r in prof.readable(prof.merge_profiles(runs, ["column"])).collect()}
    assert runs.count() == 9 * 6
    for r in whole.collect():
        m = merged[r.column]
        assert [m[c] for c in prof.EXACT] == [r[c] for c in prof.EXACT]
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in merged]).first()
    for c, m in merged.items():
        assert abs(m.distinct_estimate - exact[c]) <= 0.06 * exact[c], (c, m.distinct_estimate, exact[c])
    assert abs(merged["title"].median_length - 150) <= 8 and merged["title"].n_failures == 20_000 // 300 * 105 + 6
    assert merged["last_updated"].n_null == 20_000 and merged["last_updated"].median_length is None and merged["last_updated"].min_length is None


def test_profile_of_an_empty_batch(spark):
    rows = val.annotate(spark.createDataFrame([], "id long, article_id string, title string, author_id string, last_updated string, link string, category string"), GFG_RULES)
    got = prof.readable(prof.batch_profile(rows, GFG_RULES)).collect()
    assert len(got) == 6 and all(r.n_rows == r.n_failures == r.distinct_estimate == 0 and r.median_length is None for r in got)


def test_runs_add_up(spark, tmp_dir):
    ws = Workspace(spark, f"{tmp_dir}/ws")
    pl.run_source(ws, pl.GFG, articles(spark, range(30)).unionByName(articles(spark, range(3), title="{}")), "r1")
    pl.run_source(ws, pl.GFG, articles(spark, range(20, 60)), "r2")
    got = {r.column: r for r in pl.quality_profile(ws).collect()}
    assert got["title"].n_rows == 73 and got["title"].n_failures == 3 and got["title"].min_length == 1
    assert abs(got["article_id"].distinct_estimate - 60) <= 3 and got["category"].n_null == 24


def test_every_check_fails_somewhere(spark):
    rows = eq.q_dq_broken_report(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 22 and all(r.n_failures > 0 for r in rows)
