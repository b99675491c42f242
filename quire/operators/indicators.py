"""Long-format indicator analytics: clean, pivot, ratio, threshold, top-k,
group comparison, focus trends and load reports.

Every operator is a DataFrame -> DataFrame function.  Exchanges happen only
in the (geo, YEAR) aggregation, the per-group statistics and the semi-joins;
all of them aggregate partially on the map side first.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.scalars import (ratio_pct, round_half_even, split_trim_literal,
                                     to_number, to_year)

# ---------------------------------------------------------------------------
# Fixed values (indicator codes, units and output names of the reference)
# ---------------------------------------------------------------------------
HELD = "Actual number of persons held in prison"
CAPACITY = "Official prison capacity - persons"
UNIT_NUMBER = "Number"
UNIT_PER_100K = "Per hundred thousand inhabitants"
OCCUPANCY_COLUMNS = ["geo", "YEAR", "PRISONERS_NUM", "CAPACITY_NUM", "OCC_ABS",
                     "PRISONERS_100K", "CAPACITY_100K", "OCC_PER_100K"]
TREND_COLUMNS = ["geo", "YEAR", "OCC_ABS"]
REGION_LABELS = ("North", "South", "Other")
DEFAULT_MAX_YEAR = 2022


def load_and_clean(df: DataFrame, max_year: int = DEFAULT_MAX_YEAR,
                   time_col: str = "TIME_PERIOD", value_col: str = "OBS_VALUE") -> DataFrame:
    """Q-A: keep every input column, add numeric YEAR and VALUE, keep
    YEAR <= max_year (NULL years drop out of the comparison)."""
    return (df.withColumn("YEAR", to_year(F.col(time_col)))
              .withColumn("VALUE", to_number(F.col(value_col)))
              .filter(F.col("YEAR") <= F.lit(max_year)))


def _first_non_null(value: Column, cond: Column, pos: Column) -> Column:
    """Value at the smallest position among rows where ``cond`` holds and the
    value is present (pandas ``aggfunc='first'``).  NULL orderings are
    skipped by ``min_by``, so filtered-out rows never win."""
    keep = cond & value.isNotNull()
    return F.min_by(F.when(keep, value), F.when(keep, pos))


def _with_pos(df: DataFrame, pos: str | None, value: str = "VALUE") -> tuple[DataFrame, Column]:
    """The input order "first" goes by: the column ``pos``, else the readers'
    ``_source_file`` and ``_pos``.  Without either there is no first row; the
    least value is taken, whatever the partitioning."""
    if pos is not None:
        return df, F.col(pos)
    order = [c for c in ("_source_file", "_pos") if c in df.columns]
    return df, F.struct(*order) if "_pos" in order else F.col(value)


def pivot_first(df: DataFrame, unit: str,
                columns: Mapping[str, str] | None = None,
                index: Sequence[str] = ("geo", "YEAR"), pivot_col: str = "indic_cr",
                value: str = "VALUE", pos: str | None = None,
                unit_col: str = "unit") -> DataFrame:
    """A1: long -> wide for one unit; one output column per pivot value
    (explicit values, so no extra job discovers them; other values are
    ignored), first non-null value by input position, groups without any
    value dropped."""
    columns = dict(columns or {HELD: "PRISONERS_NUM", CAPACITY: "CAPACITY_NUM"})
    df, p = _with_pos(df.filter(F.col(unit_col) == F.lit(unit)), pos, value)
    df = df.filter(F.col(value).isNotNull() & F.col(pivot_col).isin(list(columns)))
    aggs = [_first_non_null(F.col(value), F.col(pivot_col) == F.lit(k), p).alias(v)
            for k, v in columns.items()]
    return df.groupBy(*index).agg(*aggs)


def occupancy(df_clean: DataFrame, pos: str | None = None,
              index: Sequence[str] = ("geo", "YEAR")) -> DataFrame:
    """A2: absolute and per-100k occupancy in one aggregation.

    The reference builds two pivots and inner-joins them; that is the same as
    one group-by over (geo, YEAR) with four conditional "first" aggregates,
    keeping groups where all four are present -- one shuffle, no join."""
    df, p = _with_pos(df_clean.filter(F.col("VALUE").isNotNull()
                                      & F.col("unit").isin(UNIT_NUMBER, UNIT_PER_100K)
                                      & F.col("indic_cr").isin(HELD, CAPACITY)), pos)
    u, i, v = F.col("unit"), F.col("indic_cr"), F.col("VALUE")
    wide = df.groupBy(*index).agg(
        _first_non_null(v, (u == UNIT_NUMBER) & (i == HELD), p).alias("PRISONERS_NUM"),
        _first_non_null(v, (u == UNIT_NUMBER) & (i == CAPACITY), p).alias("CAPACITY_NUM"),
        _first_non_null(v, (u == UNIT_PER_100K) & (i == HELD), p).alias("PRISONERS_100K"),
        _first_non_null(v, (u == UNIT_PER_100K) & (i == CAPACITY), p).alias("CAPACITY_100K"),
    ).dropna(subset=["PRISONERS_NUM", "CAPACITY_NUM", "PRISONERS_100K", "CAPACITY_100K"])
    return wide.select(
        *index, "PRISONERS_NUM", "CAPACITY_NUM",
        ratio_pct(F.col("PRISONERS_NUM"), F.col("CAPACITY_NUM")).alias("OCC_ABS"),
        "PRISONERS_100K", "CAPACITY_100K",
        ratio_pct(F.col("PRISONERS_100K"), F.col("CAPACITY_100K")).alias("OCC_PER_100K"))


def occupancy_by_join(df_clean: DataFrame, pos: str | None = None) -> DataFrame:
    """J1 form of A2: two pivots inner-joined on (geo, YEAR).  Kept as its own
    operator; ``occupancy`` is the one-shuffle plan."""
    num = pivot_first(df_clean, UNIT_NUMBER, pos=pos).dropna()
    num = num.withColumn("OCC_ABS", ratio_pct(F.col("PRISONERS_NUM"), F.col("CAPACITY_NUM")))
    per = pivot_first(df_clean, UNIT_PER_100K,
                      {HELD: "PRISONERS_100K", CAPACITY: "CAPACITY_100K"}, pos=pos).dropna()
    per = per.withColumn("OCC_PER_100K",
                         ratio_pct(F.col("PRISONERS_100K"), F.col("CAPACITY_100K")))
    return num.join(per, ["geo", "YEAR"], "inner").select(*OCCUPANCY_COLUMNS)


def trends_for(df: DataFrame, keys: DataFrame, key: str = "geo",
               bounded: bool = False) -> DataFrame:
    """J2 + P11: the (geo, YEAR, OCC_ABS) series of the members in ``keys``.
    ``bounded`` marks a key set whose size is fixed by construction (top-k):
    only then is it broadcast by hint; otherwise AQE decides from the
    measured size at run time."""
    k = keys.select(key).distinct()
    if bounded:
        k = F.broadcast(k)
    return df.join(k, key, "left_semi").select(*TREND_COLUMNS)


def over_threshold(df: DataFrame, year: int, threshold: float = 100.0) -> DataFrame:
    """Q-B: members whose OCC_ABS is strictly above ``threshold`` in ``year``,
    with their whole series.  The member's rows are flagged in a window, so
    ``df`` is made once and not joined with itself."""
    over = F.max((F.col("YEAR") == year) & (F.col("OCC_ABS") > threshold)).over(Window.partitionBy("geo"))
    return df.withColumn("_over", over).filter("_over").select(*TREND_COLUMNS)


def threshold_report(df: DataFrame, year: int, threshold: float = 100.0) -> DataFrame:
    """The counts the reference prints: members over the threshold and all
    members in the year, in one aggregation."""
    y = df.filter(F.col("YEAR") == year)
    return y.agg(
        F.count_distinct(F.when(F.col("OCC_ABS") > threshold, F.col("geo"))).alias("n_over"),
        F.count_distinct("geo").alias("n_total"))


def extremes_report(df: DataFrame, year: int, n: int = 10) -> DataFrame:
    """How many members the top-k report of ``year`` holds (those with a
    value, n at most) and how many there are."""
    y = df.filter(F.col("YEAR") == year)
    valued = F.count_distinct(F.when(F.col("OCC_ABS").isNotNull(), F.col("geo")))
    return y.agg(F.least(F.lit(n).cast("long"), valued).alias("n_extreme"),
                 F.count_distinct("geo").alias("n_total"))


def extremes(df: DataFrame, year: int, n: int = 10, direction: str = "top") -> DataFrame:
    """Q-C: "top" = the n smallest OCC_ABS in ``year``, "worst" = the n
    largest (the reference's code, not its docstring); ties keep the
    geo-ascending order.  Each row gets its member's value of the year from a
    window; the members are ranked by it, and each task passes on the rows of
    its n first ones only, so ``df`` is made once and the last ranking sees n
    members of each task."""
    if direction not in ("top", "worst"):
        raise ValueError(f"unknown direction {direction!r}: top takes the smallest values, worst the largest")
    best = F.max if direction == "worst" else F.min
    value = best(F.when(F.col("YEAR") == year, F.col("OCC_ABS"))).over(Window.partitionBy("geo"))
    order = F.col("_value").desc() if direction == "worst" else F.col("_value").asc()
    ranked = (df.withColumn("_value", value).filter(F.col("_value").isNotNull())
                .withColumn("_rank", F.dense_rank().over(Window.orderBy(order, F.col("geo").asc()))))
    return ranked.filter(F.col("_rank") <= n).select(*TREND_COLUMNS)


def assign_group(geo: Column, groups: Sequence[tuple[str, Iterable[str]]],
                 other: str = "Other") -> Column:
    """The first group whose member list holds ``geo``, else ``other``."""
    expr = None
    for label, members in groups:
        cond = geo.isin(split_trim_literal(members))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(other) if expr is None else expr.otherwise(F.lit(other))


def compare_groups(df: DataFrame, region1, region2, year: int,
                   value: str = "OCC_ABS") -> DataFrame:
    """Q-D / A3: mean, min, max, count of ``value`` per region in ``year``,
    rounded to 2 decimals; members of neither list fall into "Other"."""
    north, south, other = REGION_LABELS
    region = assign_group(F.col("geo"), [(north, region1), (south, region2)], other)
    v = F.col(value)
    return (df.filter(F.col("YEAR") == year)
              .withColumn("REGION", region)
              .groupBy("REGION")
              .agg(round_half_even(F.avg(v)).alias("mean"),
                   round_half_even(F.min(v)).alias("min"),
                   round_half_even(F.max(v)).alias("max"),
                   F.count(v).alias("count")))


def focus_trends(df: DataFrame, members) -> DataFrame:
    """Q-E: series of a user-given member list (literal list, so ``isin``)."""
    return df.filter(F.col("geo").isin(split_trim_literal(members))).select(*TREND_COLUMNS)


def load_report(df: DataFrame) -> DataFrame:
    """Rows, distinct members and year range in one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_distinct("geo").alias("n_geos"),
                  F.min("YEAR").alias("min_year"),
                  F.max("YEAR").alias("max_year"))


def sort_series(df: DataFrame) -> DataFrame:
    """O1: (geo, YEAR) order, applied only where a sink needs it."""
    return df.orderBy("geo", "YEAR")
