"""Quality profile of staging batches, mergeable over runs.

A run's profile has one row for each rule column: rows, NULLs, failed checks,
shortest and longest value, and two sketches (distinct values, lengths).  Any
set of runs is merged from these rows; no staging row is read again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.rules import RuleSet
from quire.operators.validate import VIOLATIONS

EXACT = ["n_rows", "n_null", "n_failures", "min_length", "max_length"]


def batch_profile(annotated: DataFrame, rules: RuleSet, by: Sequence[str] = ()) -> DataFrame:
    """One aggregation of annotated rows: ``by``, column, EXACT, and the
    sketches ``distinct_sketch`` and ``length_sketch``."""
    def figures(c: str) -> Column:
        n = F.length(c)
        failed = F.size(F.filter(VIOLATIONS, lambda v: v["column"] == c))
        return F.struct(
            F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(c).isNull()).alias("n_null"),
            F.coalesce(F.sum(failed), F.lit(0)).cast("long").alias("n_failures"), F.min(n).alias("min_length"), F.max(n).alias("max_length"),
            F.hll_sketch_agg(c).alias("distinct_sketch"), F.kll_sketch_agg_bigint(n.cast("long")).alias("length_sketch")).alias(f"_{c}")
    wide = annotated.groupBy(*by).agg(*[figures(r.column) for r in rules.columns])
    return wide.select(*by, F.explode(F.array(*[f"_{r.column}" for r in rules.columns])).alias("p")).select(*by, "p.*")


def merge_profiles(profiles: DataFrame, by: Sequence[str] = ("source_table", "column")) -> DataFrame:
    """The profiles of several batches as one."""
    return profiles.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_null", "n_failures")], F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_bigint("length_sketch").alias("length_sketch"))


def readable(profile: DataFrame) -> DataFrame:
    """The sketches as numbers: distinct values (within a few per cent) and the
    median length (of the values that are not NULL)."""
    some = F.col("n_null") < F.col("n_rows")
    return profile.withColumn("distinct_estimate", F.hll_sketch_estimate("distinct_sketch")) \
        .withColumn("median_length", F.when(some, F.kll_sketch_get_quantile_bigint("length_sketch", F.lit(0.5)))) \
        .drop("distinct_sketch", "length_sketch")
