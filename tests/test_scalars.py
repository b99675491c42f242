import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from quire.functions import scalars as S


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_url_slug(spark):
    got = one_col(spark, ["https://ex.org/sorting-a-list/", "https://ex.org/no-slash", "x", None],
                  S.url_slug)
    assert got == ["sorting-a-list", "ex.org", None, None]


def test_parse_human_date(spark):
    got = one_col(spark, ["02 Jan, 2023", "2 Jan, 2023", "31 Feb, 2023", "junk", None],
                  S.parse_human_date)
    d = dt.date(2023, 1, 2)
    assert got == [d, d, None, None, None]
    txt = one_col(spark, ["02 Jan, 2023"], lambda c: S.to_staging_timestamp_text(S.parse_human_date(c)))
    assert txt == ["2023-01-02 00:00:00"]


def test_parse_mixed_date(spark):
    vals = ["Fri, 23 Jan 2026 10:00:00 GMT", "Fri, 23 Jan 2026 10:00:00 +0000",
            "2026-01-23T10:00:00.000Z", "2026-01-23", "23 Jan 2026", "bad", None,
            "2026-02-31", "Fri, 23 Jan 2026 23:30:00 -0500"]
    got = one_col(spark, vals, lambda c: S.to_iso_date_text(S.parse_mixed_date(c)))
    assert got == ["2026-01-23"] * 5 + [None, None, None, "2026-01-23"]


def test_first_tag_and_author(spark):
    cases = {
        '[{"term":"a"},{"term":"b"}]': ("a", None),
        '[{"name":"Ann"}]': (None, "Ann"),
        '["s"]': ("s", "s"),
        '[{"term":5}]': ("5", None),
        "[7]": (None, None), "[]": (None, None), "{}": (None, None),
        '{"term":"no"}': (None, None), "x": (None, None),
    }
    keys = list(cases) + [None]
    tags = one_col(spark, keys, S.first_tag)
    authors = one_col(spark, keys, S.first_author)
    assert tags == [cases[k][0] for k in cases] + [None]
    assert authors == [cases[k][1] for k in cases] + [None]


def test_nested_to_json(spark):
    df = spark.createDataFrame([([("a",)],), (None,)], "tags array<struct<term:string>>")
    f = df.schema["tags"].dataType
    got = [r[0] for r in df.select(S.nested_to_json(F.col("tags"), f)).collect()]
    assert got == ['[{"term":"a"}]', "{}"]
    s = spark.createDataFrame([("x",)], "t string")
    assert s.select(S.nested_to_json(F.col("t"), s.schema["t"].dataType)).first()[0] == "{}"


def test_numeric_coercion(spark):
    got = one_col(spark, ["12.5", " 7 ", ":", "NaN", None, "1e3"], S.to_number)
    assert got == [12.5, 7.0, None, None, None, 1000.0]
    assert one_col(spark, ["2022", "2022.0", "2022.5", "abc"], S.to_year) == [2022, 2022, None, None]


def test_round_half_even_matches_numpy(spark):
    rng = np.random.default_rng(7)
    a = rng.integers(1, 5000, 3000).astype(float)
    b = rng.integers(1, 5000, 3000).astype(float)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    got = [r[0] for r in df.select(S.ratio_pct(F.col("a"), F.col("b"))).collect()]
    exp = list(np.round(a / b * 100, 2))
    assert got == exp
    assert one_col(spark, [0.0], lambda c: S.ratio_pct(F.lit(5.0), c), "double") == [None]


def test_clean_text(spark):
    raw = " a\t b\n\nc\u00a0d "
    assert one_col(spark, [raw], S.clean_text) == ["a b c d"]
    spaces = "x" + " " * 4000 + "y"
    assert one_col(spark, [spaces], S.clean_text) == ["x y"]
    long = "w" * 20000
    assert one_col(spark, [long], S.clean_text) == [long]


def test_clean_text_limits_on_request(spark):
    limited = lambda c: S.clean_text(c, S.CLEAN_MAX_CHARS, S.CLEAN_MIN_CHARS, S.CLEAN_RAW_THRESHOLD)
    spaces = "x" + " " * 4000 + "y"
    assert one_col(spark, [spaces], limited) == [spaces]
    assert one_col(spark, ["w" * 20000], limited) == ["w" * 15000]


def test_na_tokens(spark):
    got = one_col(spark, ["NA", "null", "N/A", "ok", "nan", ""], S.na_to_null)
    assert got == [None, None, None, "ok", None, None]


def test_null_fields_stay_in_json(spark):
    df = spark.sql("SELECT named_struct('a', CAST(NULL AS string), 'b', 1) AS x, array(named_struct('t', CAST(NULL AS string))) AS y")
    got = df.select(*[S.nested_to_json(F.col(c), df.schema[c].dataType).alias(c) for c in ("x", "y")]).first()
    assert tuple(got) == ('{"a":null,"b":1}', '[{"t":null}]')
