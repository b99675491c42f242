"""Property tests: Spark column functions against small Python models of the
documented behaviour, on generated inputs."""

import json
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import scalars as S
from quire.operators import indicators as ind

WS = (" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2005\u200a"
      "\u2028\u2029\u202f\u205f\u3000")
NOT_WS = "ab\u200b\u00e9\u00b7x"   # zero-width space is not whitespace for Python either
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))


def model_cleanup(raw: str) -> str:
    """The documented cleanup rule, with Python's own Unicode ``\\s``."""
    cleaned = re.sub(r"\s+", " ", raw).strip()
    if len(cleaned) < 1000 and len(raw) > 3000:
        return raw[:15000]
    return cleaned[:15000]


def model_first(text, field):
    try:
        v = json.loads(text)
    except (TypeError, ValueError):
        return None
    if isinstance(v, list) and v:
        if isinstance(v[0], dict) and field in v[0]:
            x = v[0][field]
            if x is None or isinstance(x, (dict, list)):
                return None if x is None else json.dumps(x, separators=(",", ":"))
            return str(x).lower() if isinstance(x, bool) else str(x)
        if isinstance(v[0], str):
            return v[0]
    return None


@SETTINGS
@given(st.lists(st.text(alphabet=WS + NOT_WS, max_size=60), min_size=1, max_size=30))
def test_cleanup_matches_python_whitespace(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(S.clean_text(F.col("t"))).collect()]
    assert got == [model_cleanup(t) for t in texts]


scalar = st.one_of(st.none(), st.integers(-5, 5), st.text(alphabet="ab c", max_size=4), st.booleans())
element = st.one_of(scalar, st.dictionaries(st.sampled_from(["term", "name", "x"]), scalar, max_size=2))
doc = st.one_of(st.lists(element, max_size=3), st.dictionaries(st.sampled_from(["term", "x"]), scalar, max_size=2), scalar)


@SETTINGS
@given(st.lists(doc, min_size=1, max_size=20))
def test_first_json_item_matches_model(spark, docs):
    texts = [json.dumps(d) for d in docs] + ["not json", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.orderBy("i").select(S.first_tag(F.col("t")), S.first_author(F.col("t"))).collect()
    assert [r[0] for r in rows] == [model_first(t, "term") for t in texts]
    assert [r[1] for r in rows] == [model_first(t, "name") for t in texts]


def test_occupancy_ignores_input_partitioning(spark):
    rows = []
    for g in range(30):
        for y in (2020, 2021):
            for unit in (ind.UNIT_NUMBER, ind.UNIT_PER_100K):
                rows.append((f"G{g}", str(y), unit, ind.HELD, str(50 + g * 3 + y % 7)))
                rows.append((f"G{g}", str(y), unit, ind.CAPACITY, str(60 + (g * 7) % 23)))
    df = spark.createDataFrame(rows, "geo string, TIME_PERIOD string, unit string, indic_cr string, "
                                     "OBS_VALUE string")
    a = sorted(map(tuple, ind.occupancy(ind.load_and_clean(df.coalesce(1))).collect()))
    b = sorted(map(tuple, ind.occupancy(ind.load_and_clean(df.repartition(7, "OBS_VALUE"))).collect()))
    assert a == b and len(a) == 60
