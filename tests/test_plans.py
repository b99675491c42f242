"""Plan assertions: the physical plans keep the properties the design relies on."""

import pytest

import __spark_entry__ as E
from quire.plans.registry import all_queries

SF = "/root/testdata/sf0.001"


def plan(spark, name: str) -> str:
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(all_queries()) - {"page_main_text", "page_main_text_native", "enrich_once"}))
def test_no_python_in_native_queries(spark, name):
    p = plan(spark, name)
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_html_extraction_is_arrow_batched(spark):
    p = plan(spark, "page_main_text")
    assert "ArrowEvalPython" in p and "BatchEvalPython" not in p


def test_topk_is_limited_in_each_task(spark):
    p = plan(spark, "extremes_highest")
    assert p.count("WindowGroupLimit") == 2 and "Partial" in p and "Final" in p


@pytest.mark.parametrize("name", ["over_threshold", "extremes_lowest", "extremes_highest", "bar_data"])
def test_trends_scan_orders_once(spark, name):
    p = plan(spark, name)
    assert p.count("/orders.parquet") == 1 and "LeftSemi" not in p


@pytest.mark.parametrize("name", sorted(n for n in all_queries() if n.startswith(("dim_", "dq_")) or n in ("sql_params", "feed_staging", "unprocessed")))
def test_no_exchange_carries_wide_text(spark, name):
    df = E.queries()[name](spark, SF)
    formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    blocks = [b for b in formatted.split("\n\n") if ") Exchange" in b or ") BroadcastExchange" in b]
    assert not [b for b in blocks for wide in ("summary#", "text#", "html#") if wide in b.split("Arguments")[0]]


def test_occupancy_needs_no_join_of_pivots(spark):
    one = plan(spark, "occupancy")
    two = plan(spark, "occupancy_join")
    # the only joins in the one-shuffle form are the ones building observations
    assert one.count("Join") < two.count("Join")


def test_validation_adds_no_shuffle(spark):
    staging = plan(spark, "feed_staging").count("Exchange")
    assert plan(spark, "dq_clean").count("Exchange") == staging
    assert plan(spark, "dq_failures").count("Exchange") == staging + plan(spark, "gfg_staging").count("Exchange")


def test_scans_read_only_needed_columns(spark):
    p = plan(spark, "url_slug")
    assert "ReadSchema: struct<page_id:bigint,url:string>" in p
    assert "Exchange" not in p                      # light work: no spread shuffle
