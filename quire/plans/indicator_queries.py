"""Registered indicator-analytics queries over the test tables and their
DuckDB oracle SQL (same column names, same rounding)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.operators import chartdata as cd
from quire.operators import indicators as ind
from quire.plans import testdata as td

# Parameters of the registered queries.
YEAR = 2000
TOP_N = 5
THRESHOLD = 100.0
REGION1 = "NATION_0, NATION_5, NATION_10, NATION_15, NATION_20"
REGION2 = ["NATION_1", "NATION_6", "NATION_11", "NATION_16"]
FOCUS = ["NATION_3", "NATION_7", "NATION_19", "NATION_22"]


def obs_clean(spark: SparkSession, sf: str) -> DataFrame:
    return ind.load_and_clean(td.observations(spark, sf))


def occupancy(spark: SparkSession, sf: str) -> DataFrame:
    return ind.occupancy(obs_clean(spark, sf))


def q_obs_clean(spark, sf):
    return obs_clean(spark, sf)


def q_pivot_first(spark, sf):
    return ind.pivot_first(obs_clean(spark, sf), ind.UNIT_NUMBER)


def q_pivot_first_ordered(spark, sf):
    return ind.pivot_first(ind.load_and_clean(td.order_observations(spark, sf)), ind.UNIT_NUMBER)


def q_extremes_report(spark, sf):
    return ind.extremes_report(occupancy(spark, sf), YEAR, TOP_N)


def q_occupancy(spark, sf):
    return occupancy(spark, sf)


def q_occupancy_join(spark, sf):
    return ind.occupancy_by_join(obs_clean(spark, sf))


def q_over_threshold(spark, sf):
    return ind.over_threshold(occupancy(spark, sf), YEAR, THRESHOLD)


def q_threshold_report(spark, sf):
    return ind.threshold_report(occupancy(spark, sf), YEAR, THRESHOLD)


def q_extremes_lowest(spark, sf):
    return ind.extremes(occupancy(spark, sf), YEAR, TOP_N, "top")


def q_extremes_highest(spark, sf):
    return ind.extremes(occupancy(spark, sf), YEAR, TOP_N, "worst")


def q_compare_groups(spark, sf):
    return ind.compare_groups(occupancy(spark, sf), REGION1, REGION2, YEAR)


def q_focus_trends(spark, sf):
    return ind.focus_trends(occupancy(spark, sf), FOCUS)


def q_load_report(spark, sf):
    return ind.load_report(occupancy(spark, sf))


def q_unpivot_metrics(spark, sf):
    return cd.unpivot_metrics(q_compare_groups(spark, sf))


def q_line_series(spark, sf):
    return cd.line_series(q_focus_trends(spark, sf))


def q_bar_data(spark, sf):
    return cd.bar_data(q_extremes_highest(spark, sf).filter(f"YEAR = {YEAR}"), "geo", "OCC_ABS")


QUERIES = {
    "obs_clean": q_obs_clean,
    "pivot_first": q_pivot_first,
    "pivot_first_ordered": q_pivot_first_ordered,
    "extremes_report": q_extremes_report,
    "occupancy": q_occupancy,
    "occupancy_join": q_occupancy_join,
    "over_threshold": q_over_threshold,
    "threshold_report": q_threshold_report,
    "extremes_lowest": q_extremes_lowest,
    "extremes_highest": q_extremes_highest,
    "compare_groups": q_compare_groups,
    "focus_trends": q_focus_trends,
    "load_report": q_load_report,
    "unpivot_metrics": q_unpivot_metrics,
    "line_series": q_line_series,
    "bar_data": q_bar_data,
}

# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# ---------------------------------------------------------------------------
_OBS = f"""
per_cust AS (
  SELECT o_custkey, year(o_orderdate) AS yr, o_orderstatus, count(*) AS n
  FROM orders GROUP BY o_custkey, year(o_orderdate), o_orderstatus),
counts AS (
  SELECT c.c_nationkey, p.yr, p.o_orderstatus, sum(p.n) AS n
  FROM per_cust p JOIN customer c ON p.o_custkey = c.c_custkey
  GROUP BY c.c_nationkey, p.yr, p.o_orderstatus),
ncust AS (SELECT c_nationkey, count(*) AS ncust FROM customer GROUP BY c_nationkey),
k AS (
  SELECT n.n_name AS geo, CAST(k.yr AS VARCHAR) AS TIME_PERIOD,
         CASE k.o_orderstatus WHEN 'F' THEN '{ind.HELD}' WHEN 'O' THEN '{ind.CAPACITY}'
              ELSE '{td.OTHER_INDICATOR}' END AS indic_cr,
         CAST(k.n AS DOUBLE) AS n, CAST(nc.ncust AS DOUBLE) AS ncust
  FROM counts k JOIN ncust nc ON k.c_nationkey = nc.c_nationkey
  JOIN nation n ON k.c_nationkey = n.n_nationkey),
obs AS (
  SELECT geo, TIME_PERIOD, '{ind.UNIT_NUMBER}' AS unit, indic_cr, CAST(n AS VARCHAR) AS OBS_VALUE FROM k
  UNION ALL
  SELECT geo, TIME_PERIOD, '{ind.UNIT_PER_100K}' AS unit, indic_cr,
         CAST(n * {td.PER_100K} / ncust AS VARCHAR) AS OBS_VALUE FROM k),
obs_num AS (
  SELECT *, TRY_CAST(TIME_PERIOD AS DOUBLE) AS y_d,
         CASE WHEN NOT isnan(TRY_CAST(OBS_VALUE AS DOUBLE)) THEN TRY_CAST(OBS_VALUE AS DOUBLE) END AS VALUE
  FROM obs),
obs_clean AS (
  SELECT geo, TIME_PERIOD, unit, indic_cr, OBS_VALUE,
         CASE WHEN y_d = floor(y_d) THEN CAST(y_d AS INTEGER) END AS YEAR, VALUE
  FROM obs_num WHERE y_d = floor(y_d) AND CAST(y_d AS INTEGER) <= {ind.DEFAULT_MAX_YEAR}),
wide AS (
  SELECT geo, YEAR,
    first(VALUE) FILTER (WHERE unit = '{ind.UNIT_NUMBER}' AND indic_cr = '{ind.HELD}') AS PRISONERS_NUM,
    first(VALUE) FILTER (WHERE unit = '{ind.UNIT_NUMBER}' AND indic_cr = '{ind.CAPACITY}') AS CAPACITY_NUM,
    first(VALUE) FILTER (WHERE unit = '{ind.UNIT_PER_100K}' AND indic_cr = '{ind.HELD}') AS PRISONERS_100K,
    first(VALUE) FILTER (WHERE unit = '{ind.UNIT_PER_100K}' AND indic_cr = '{ind.CAPACITY}') AS CAPACITY_100K
  FROM obs_clean WHERE VALUE IS NOT NULL GROUP BY geo, YEAR),
occ AS (
  SELECT geo, YEAR, PRISONERS_NUM, CAPACITY_NUM,
         round_even(PRISONERS_NUM / NULLIF(CAPACITY_NUM, 0) * 100, 2) AS OCC_ABS,
         PRISONERS_100K, CAPACITY_100K,
         round_even(PRISONERS_100K / NULLIF(CAPACITY_100K, 0) * 100, 2) AS OCC_PER_100K
  FROM wide
  WHERE PRISONERS_NUM IS NOT NULL AND CAPACITY_NUM IS NOT NULL
    AND PRISONERS_100K IS NOT NULL AND CAPACITY_100K IS NOT NULL)"""


def _with(body: str) -> str:
    return f"WITH {_OBS}\n{body}"


def _in_list(items) -> str:
    from quire.functions.scalars import split_trim_literal
    return ", ".join(f"'{x}'" for x in split_trim_literal(items))


_GROUPS = f"""
grp AS (
  SELECT CASE WHEN geo IN ({_in_list(REGION1)}) THEN 'North'
              WHEN geo IN ({_in_list(REGION2)}) THEN 'South' ELSE 'Other' END AS REGION,
         OCC_ABS
  FROM occ WHERE YEAR = {YEAR}),
stats AS (
  SELECT REGION, round_even(avg(OCC_ABS), 2) AS mean, round_even(min(OCC_ABS), 2) AS min,
         round_even(max(OCC_ABS), 2) AS max, count(OCC_ABS) AS count
  FROM grp GROUP BY REGION)"""

ORACLE = {
    "obs_clean": _with("SELECT * FROM obs_clean"),
    "pivot_first": _with(f"""
SELECT geo, YEAR,
  first(VALUE) FILTER (WHERE indic_cr = '{ind.HELD}') AS PRISONERS_NUM,
  first(VALUE) FILTER (WHERE indic_cr = '{ind.CAPACITY}') AS CAPACITY_NUM
FROM obs_clean WHERE unit = '{ind.UNIT_NUMBER}' AND VALUE IS NOT NULL
  AND indic_cr IN ('{ind.HELD}', '{ind.CAPACITY}')
GROUP BY geo, YEAR"""),
    "pivot_first_ordered": f"""
SELECT n_name AS geo, CAST(year(o_orderdate) AS INTEGER) AS YEAR,
  arg_min(CAST(o_totalprice AS DOUBLE), o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS PRISONERS_NUM,
  arg_min(CAST(o_totalprice AS DOUBLE), o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS CAPACITY_NUM
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus IN ('F', 'O') AND o_totalprice IS NOT NULL AND year(o_orderdate) <= {ind.DEFAULT_MAX_YEAR}
GROUP BY n_name, year(o_orderdate)""",
    "extremes_report": _with(f"""
SELECT CAST(least({TOP_N}, count(DISTINCT CASE WHEN OCC_ABS IS NOT NULL THEN geo END)) AS BIGINT) AS n_extreme,
       count(DISTINCT geo) AS n_total
FROM occ WHERE YEAR = {YEAR}"""),
    "occupancy": _with("SELECT * FROM occ"),
    "occupancy_join": _with("SELECT * FROM occ"),
    "over_threshold": _with(f"""
SELECT geo, YEAR, OCC_ABS FROM occ
WHERE geo IN (SELECT geo FROM occ WHERE YEAR = {YEAR} AND OCC_ABS > {THRESHOLD})"""),
    "threshold_report": _with(f"""
SELECT count(DISTINCT CASE WHEN OCC_ABS > {THRESHOLD} THEN geo END) AS n_over,
       count(DISTINCT geo) AS n_total
FROM occ WHERE YEAR = {YEAR}"""),
    "extremes_lowest": _with(f"""
SELECT geo, YEAR, OCC_ABS FROM occ WHERE geo IN (
  SELECT geo FROM occ WHERE YEAR = {YEAR} AND OCC_ABS IS NOT NULL
  ORDER BY OCC_ABS ASC, geo ASC LIMIT {TOP_N})"""),
    "extremes_highest": _with(f"""
SELECT geo, YEAR, OCC_ABS FROM occ WHERE geo IN (
  SELECT geo FROM occ WHERE YEAR = {YEAR} AND OCC_ABS IS NOT NULL
  ORDER BY OCC_ABS DESC, geo ASC LIMIT {TOP_N})"""),
    "compare_groups": _with(f", {_GROUPS}\nSELECT * FROM stats"),
    "focus_trends": _with(f"SELECT geo, YEAR, OCC_ABS FROM occ WHERE geo IN ({_in_list(FOCUS)})"),
    "load_report": _with("""
SELECT count(*) AS n_rows, count(DISTINCT geo) AS n_geos, min(YEAR) AS min_year,
       max(YEAR) AS max_year FROM occ"""),
    "unpivot_metrics": _with(f""", {_GROUPS},
stats_wide AS (SELECT REGION, CAST(mean AS DOUBLE) AS mean, CAST(min AS DOUBLE) AS min,
                CAST(max AS DOUBLE) AS max, CAST(count AS DOUBLE) AS count FROM stats),
long AS (UNPIVOT stats_wide ON "mean", "min", "max", "count" INTO NAME Metric VALUE Value)
SELECT REGION, upper(Metric[1]) || Metric[2:] AS Metric, Value,
       round_even(Value, 1) AS ValueRounded
FROM long"""),
    "line_series": _with(f"SELECT YEAR, OCC_ABS, geo FROM occ WHERE geo IN ({_in_list(FOCUS)})"),
    "bar_data": _with(f"""
SELECT geo, OCC_ABS, OCC_ABS AS text FROM occ WHERE YEAR = {YEAR} AND geo IN (
  SELECT geo FROM occ WHERE YEAR = {YEAR} AND OCC_ABS IS NOT NULL
  ORDER BY OCC_ABS DESC, geo ASC LIMIT {TOP_N})"""),
}
