import pytest

from quire.operators import chartdata as cd
from quire.operators import indicators as ind

H, C = ind.HELD, ind.CAPACITY
N, P = ind.UNIT_NUMBER, ind.UNIT_PER_100K


def obs_rows():
    rows = []

    def both(geo, year, held_n, cap_n, held_p, cap_p):
        for unit, h, c in ((N, held_n, cap_n), (P, held_p, cap_p)):
            if h is not None:
                rows.append((geo, year, unit, H, h))
            if c is not None:
                rows.append((geo, year, unit, C, c))

    both("Aland", "2022", "120", "100", "12.5", "10")
    both("Bland", "2022", "100", "100", "5", "5")
    both("Cland", "2022", "50", None, "5", "5")          # capacity missing -> dropped
    rows += [("Dland", "2022", N, H, "10"), ("Dland", "2022", N, C, "20")]  # no per-100k
    both("Eland", "2022", ":", "10", "1", "1")           # broken value -> dropped
    both("Fland", "2023", "10", "10", "1", "1")          # after max_year
    both("Gland", "abc", "10", "10", "1", "1")           # bad year
    both("Hland", "2022", "5", "0", "1", "1")            # zero capacity -> ratio NULL
    rows.append(("Iland", "2022", N, H, None))           # first non-null wins
    both("Iland", "2022", "7", "8", "1", "2")
    rows.append(("Aland", "2022", N, "Persons held before trial", "999"))  # ignored indicator
    return rows


@pytest.fixture()
def occ(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(obs_rows())],
                               "pos long, geo string, TIME_PERIOD string, unit string, "
                               "indic_cr string, OBS_VALUE string")
    return ind.occupancy(ind.load_and_clean(df), pos="pos")


def test_occupancy_rows(occ):
    got = {r.geo: r for r in occ.collect()}
    assert set(got) == {"Aland", "Bland", "Hland", "Iland"}
    assert got["Aland"].OCC_ABS == 120.0 and got["Aland"].OCC_PER_100K == 125.0
    assert got["Bland"].OCC_ABS == 100.0
    assert got["Hland"].OCC_ABS is None
    assert got["Iland"].PRISONERS_NUM == 7.0 and got["Iland"].OCC_ABS == 87.5
    assert occ.columns == ind.OCCUPANCY_COLUMNS


def test_join_form_equals_one_shuffle_form(spark, occ):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(obs_rows())],
                               "pos long, geo string, TIME_PERIOD string, unit string, "
                               "indic_cr string, OBS_VALUE string")
    j = ind.occupancy_by_join(ind.load_and_clean(df), pos="pos")
    assert sorted(map(tuple, j.collect())) == sorted(map(tuple, occ.collect()))


def test_threshold_is_strict(occ):
    assert {r.geo for r in ind.over_threshold(occ, 2022).collect()} == {"Aland"}
    rep = ind.threshold_report(occ, 2022).first()
    assert (rep.n_over, rep.n_total) == (1, 4)


def test_extremes_direction_and_ties(spark):
    rows = [("A", 2022, 90.0), ("B", 2022, 90.0), ("C", 2022, 50.0), ("D", 2022, 120.0),
            ("A", 2021, 10.0), ("E", 2022, None)]
    df = spark.createDataFrame(rows, "geo string, YEAR int, OCC_ABS double")
    top = {r.geo for r in ind.extremes(df, 2022, 2, "top").collect()}
    worst = {r.geo for r in ind.extremes(df, 2022, 2, "worst").collect()}
    assert top == {"C", "A"}            # smallest; tie between A and B -> A
    assert worst == {"D", "A"}
    assert ind.extremes(df, 2022, 2, "top").filter("geo = 'A'").count() == 2   # whole series
    with pytest.raises(ValueError):
        ind.extremes(df, 2022, 2, "best")


def test_compare_groups_and_unpivot(spark):
    rows = [("A", 2022, 100.0), ("B", 2022, 50.0), ("C", 2022, 75.123), ("D", 2022, 80.0),
            ("A", 2021, 1.0)]
    df = spark.createDataFrame(rows, "geo string, YEAR int, OCC_ABS double")
    g = {r.REGION: r for r in ind.compare_groups(df, "A, B", ["C"], 2022).collect()}
    assert g["North"].mean == 75.0 and g["North"]["count"] == 2
    assert g["South"].max == 75.12 and g["Other"]["count"] == 1
    long = cd.unpivot_metrics(ind.compare_groups(df, "A, B", ["C"], 2022))
    assert long.count() == 12
    assert {r.Metric for r in long.collect()} == {"Mean", "Min", "Max", "Count"}


def test_focus_and_report(spark, occ):
    f = ind.focus_trends(occ, "Aland, Zland")
    assert [r.geo for r in f.collect()] == ["Aland"]
    r = ind.load_report(occ).first()
    assert (r.n_rows, r.n_geos, r.min_year, r.max_year) == (4, 4, 2022, 2022)
