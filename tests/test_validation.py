import pytest
from pyspark.sql import functions as F

from quire.operators import staging as stg
from quire.operators import validate as val
from quire.operators.rules import GFG_RULES, MEDIUM_RULES, rules_for

TITLE_201 = "t" * 201
ROWS = [
    # id, title, author_id, last_updated, link, category -> failed columns
    (1, "Sorting a list", "bob_7", "02 Jan, 2023", "https://ex.org/sorting-a-list/", "easy", None),
    (2, "Sorting a list", "bob_7", "2 Jan, 2023", "https://ex.org/s2/", "easy", None),
    (3, "Short", "bob", "02 Jan, 2023", "https://ex.org/short/", "easy", "Failed columns: title"),
    (4, TITLE_201, "bob", "02 Jan, 2023", "https://ex.org/long/", "easy", "Failed columns: title"),
    (5, "Good title", "bob smith", "junk", "https://ex.org/g/", None, "Failed columns: author_id"),
    (6, "Good title", None, None, None, None, "Failed columns: article_id"),
    (7, "Good title", "bob", "31 Feb, 2023", "not-a-url", "hard", "Failed columns: article_id, link"),
    (8, "Good title", "bob", "02 Jan, 2023", "https://ex.org/no-slash", "easy", None),
    (9, None, "bob", "02 Jan, 2023", "https://ex.org/na/", "easy", "Failed columns: title"),
]


@pytest.fixture()
def gfg(spark):
    raw = spark.createDataFrame([r[:6] for r in ROWS],
                                "id long, title string, author_id string, last_updated string, "
                                "link string, category string")
    return stg.transform_gfg(raw)


def test_gfg_quarantine_reasons(gfg):
    v = val.validate(gfg, GFG_RULES)
    got = {r.pk_value: r.validation_error for r in v.quarantine().collect()}
    exp = {str(r[0]): r[6] for r in ROWS if r[6]}
    assert got == exp
    assert {r.id for r in v.clean.collect()} == {r[0] for r in ROWS if not r[6]}


def test_split_is_complete(gfg):
    v = val.validate(gfg, GFG_RULES)
    assert v.clean.count() + v.failed.count() == gfg.count()
    cnt = val.failure_count(v.annotated).first()
    assert cnt.n_failed_rows == v.failed.count()
    assert cnt.n_failures == v.failures.count()


def test_failure_cases_long_form(gfg):
    rows = val.validate(gfg, GFG_RULES).failures.filter(F.col("pk_value") == "7").collect()
    assert [(r.column, r.check) for r in rows] == [
        ("article_id", "not_nullable"), ("link", "missing valid URL")]
    nulls = val.validate(gfg, GFG_RULES).failures.filter(F.col("pk_value") == "6").collect()
    assert [(r.column, r.check, r.failure_case) for r in nulls] == [("article_id", "not_nullable", None)]


def test_table_level_errors_always_raise(spark):
    df = spark.createDataFrame([(1, 5)], "id long, title int")
    with pytest.raises(val.SchemaError) as e:
        val.annotate(df, GFG_RULES)
    checks = {c for _, c, _ in e.value.failures}
    assert "column_in_dataframe" in checks and any(c.startswith("dtype") for c in checks)


def test_unknown_table(spark):
    with pytest.raises(ValueError):
        rules_for("stg_unknown")


def test_feed_rules(spark):
    entries = spark.createDataFrame(
        [("f", 1, "ok title", None, "s" * 5001, None, "https://ex.org/1/", "1",
          "Fri, 23 Jan 2026 10:00:00 GMT", None, None, None, None),
         ("f", 2, "ab", None, "x", None, "https://ex.org/2/", "2", "bad", None, None,
          [("a",)], [("Ann",)])],
        "feed string, pos long, title string, title_detail struct<type:string>, summary string, "
        "summary_detail struct<type:string>, link string, id string, published string, "
        "published_parsed string, updated string, tags array<struct<term:string>>, "
        "authors array<struct<name:string>>")
    s = stg.transform_feed(entries).withColumnRenamed("pos", "id")
    got = {r.pk_value: r.validation_error
           for r in val.validate(s, MEDIUM_RULES).quarantine().collect()}
    assert got == {"1": "Failed columns: summary, tags, authors", "2": "Failed columns: title"}
