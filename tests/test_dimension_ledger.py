import datetime as dt

from pyspark.sql import functions as F

from quire.operators import dimension as dim
from quire.operators import ledger as led
from quire.operators import staging as stg

SCHEMA = ("article_id string, source_platform string, title string, author string, "
          "pub_date date, link string, category string, is_valid boolean, _src_pk long")
T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 2, 1)


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def a(key, title, pk):
    return (key, "GFG", title, "bob", dt.date(2023, 1, 2), f"https://ex.org/{key}/", "easy", True, pk)


def ts(x):
    return F.lit(x).cast("timestamp")


def test_load_twice_only_updated_at_moves(spark):
    batch = dim.latest_per_key(rows(spark, [a("k1", "Title one", 1), a("k2", "Title two", 2)]))
    d0 = dim.upsert(None, batch, ts(T0))
    d1 = dim.upsert(d0, batch, ts(T1)).collect()
    for r in d1:
        assert r.created_at == T0 and r.updated_at == T1
    assert sorted(r.id for r in d1) == sorted(r.id for r in d0.collect())


def test_changed_title_keeps_created_at(spark):
    d0 = dim.upsert(None, rows(spark, [a("k1", "Title one", 1), a("k2", "Title two", 2)]), ts(T0))
    d1 = {r.article_id: r for r in
          dim.upsert(d0, rows(spark, [a("k1", "Changed", 3), a("k3", "New one", 4)]), ts(T1),
                     id_base=100).collect()}
    assert d1["k1"].title == "Changed" and d1["k1"].created_at == T0 and d1["k1"].updated_at == T1
    assert d1["k2"].updated_at == T0
    assert d1["k3"].created_at == T1 and d1["k3"].id >= 100
    assert len({r.id for r in d1.values()}) == 3


def test_in_batch_duplicate_last_wins(spark):
    b = dim.latest_per_key(rows(spark, [a("k1", "first", 1), a("k1", "last", 5), a("k1", "mid", 3)]))
    assert [r.title for r in b.collect()] == ["last"]
    assert dim.duplicate_keys(b).count() == 0


def test_guard_catches_bad_platform(spark):
    bad = rows(spark, [("k", "Other", "t", None, None, None, None, True, 1)])
    assert [r.check for r in dim.guard(bad).collect()] == ["source_platform not allowed"]


def test_dedupe_keep_last_per_group(spark):
    df = spark.createDataFrame([("f", "l", "1", 1, "a"), ("f", "l", "1", 2, "b"),
                                ("g", "l", "1", 0, "c")], "feed string, link string, id_rss string, "
                                                          "pos long, v string")
    got = {(r.feed, r.v) for r in stg.dedupe_keep_last(df, ["feed", "link", "id_rss"], "pos").collect()}
    assert got == {("f", "b"), ("g", "c")}


def test_ledger_reopen(spark):
    stage = spark.createDataFrame([(i,) for i in range(5)], "id long")
    l1 = led.mark_processed(stage.filter("id < 4"), "t", "id", 1, ts(T0))
    l2 = led.reopen(stage.filter("id = 1"), "t", "id", 2, ts(T1))
    ledger = l1.unionByName(l2)
    assert sorted(r.id for r in led.unprocessed(stage, ledger, "t").collect()) == [1, 4]
    assert led.unprocessed(stage, ledger, "other").count() == 5


def test_keep_last_with_a_hot_key(spark):
    # one key holds a third of all rows; the partial max_by keeps the result exact
    n = 3000
    rows = [("hot" if i % 3 == 0 else f"k{i}", i, f"v{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "key string, pos long, v string").repartition(8)
    out = {r.key: r.v for r in stg.dedupe_keep_last(df, ["key"], "pos").collect()}
    assert len(out) == 1 + 2 * n // 3
    assert out["hot"] == f"v{max(i for i in range(n) if i % 3 == 0)}"
    plan = stg.dedupe_keep_last(df, ["key"], "pos")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan          # reduced map-side before the shuffle
