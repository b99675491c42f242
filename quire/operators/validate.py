"""Single-pass validation, failure cases, clean/quarantine split and DQ report.

``annotate`` adds one ``_violations`` column, an array of
``struct<column, check, failure_case>``, built by one projection: every rule
of every column is evaluated in the same pass, with no UDF and no shuffle.
Everything else (failure cases, counts, the split, quarantine records) is a
filter, ``explode`` or aggregation over that column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.rules import (COLUMN_PRESENT, DTYPE, NOT_NULLABLE, RuleSet,
                                   rules_for)

VIOLATIONS = "_violations"
FAILED_PREFIX = "Failed columns: "


class SchemaError(ValueError):
    """Table-level validation failure (missing column, wrong type).  Always
    raised, even when row-level failures exist too."""

    def __init__(self, table: str, failures: list[tuple[str, str, str]]):
        self.table = table
        self.failures = failures
        super().__init__(f"{table}: the table does not have the columns its rules ask for: {failures}")


def table_level_failures(df: DataFrame, rules: RuleSet) -> list[tuple[str, str, str]]:
    """(column, check, detail) for missing required columns,
    columns of the wrong type and, for strict rule sets, extra columns."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for r in rules.columns:
        if r.column not in fields:
            if r.required:
                out.append((r.column, COLUMN_PRESENT, r.column))
            continue
        if r.dtype is not None and fields[r.column] != r.dtype:
            out.append((r.column, f"{DTYPE}('{r.dtype.simpleString()}')",
                        fields[r.column].simpleString()))
    if rules.strict:
        extra = [c for c in fields if c not in rules.column_names() and not c.startswith("_")]
        out += [(c, "column_in_schema", c) for c in extra]
    return out


def check_table_level(df: DataFrame, rules: RuleSet) -> None:
    failures = table_level_failures(df, rules)
    if failures:
        raise SchemaError(rules.table, failures)


def _violation(column: str, check: str, failed: Column, value: Column) -> Column:
    return F.when(failed, F.struct(F.lit(column).alias("column"), F.lit(check).alias("check"),
                                   value.cast("string").alias("failure_case")))


def violation_exprs(rules: RuleSet, present: set[str]) -> list[Column]:
    out = []
    for r in rules.columns:
        if r.column not in present:
            continue
        c = F.col(r.column)
        if not r.nullable:
            out.append(_violation(r.column, NOT_NULLABLE, c.isNull(), F.lit(None)))
        for chk in r.checks:
            # a check that yields NULL on a present value counts as failed
            failed = c.isNotNull() & ~F.coalesce(chk.predicate(c), F.lit(False))
            out.append(_violation(r.column, chk.name, failed, c))
    return out


_EXPR_CACHE: dict[tuple, tuple[RuleSet, Column]] = {}


def violations_column(rules: RuleSet, present: set[str]) -> Column:
    """The ``_violations`` expression for a rule set over the present
    columns.  Built once per session and rule set: building it is a few
    hundred Python-to-JVM calls, running it is one projection."""
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    key = (sc.applicationId if sc else None, id(rules), tuple(sorted(present)))
    if key not in _EXPR_CACHE:
        exprs = violation_exprs(rules, present)
        if not exprs:
            arr = F.array().cast("array<struct<column:string,check:string,failure_case:string>>")
        else:
            arr = F.array_compact(F.array(*exprs))
        _EXPR_CACHE[key] = (rules, arr)   # keeps ``rules`` alive so id() stays unique
    return _EXPR_CACHE[key][1]


def annotate(df: DataFrame, rules: RuleSet | str) -> DataFrame:
    """V1: check table-level rules (raise), then add ``_violations``."""
    rules = rules_for(rules) if isinstance(rules, str) else rules
    check_table_level(df, rules)
    return df.withColumn(VIOLATIONS, violations_column(rules, set(df.columns)))


def failure_cases(annotated: DataFrame, pk: str = "id") -> DataFrame:
    """V4: one row per failed check: pk_value, column, check, failure_case.
    ``explode_outer`` + a filter above it: the filter Catalyst infers for a
    plain ``explode`` is pushed below the rule projection and would evaluate
    every rule twice."""
    return (annotated.select(F.col(pk).cast("string").alias("pk_value"),
                             F.explode_outer(VIOLATIONS).alias("v"))
                     .filter(F.col("v").isNotNull())
                     .select("pk_value", "v.column", "v.check", "v.failure_case"))


def failure_count(annotated: DataFrame) -> DataFrame:
    """V3 / V5: failed checks and failed rows, one aggregation."""
    n = F.size(VIOLATIONS)
    return annotated.agg(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("n_failures"),
                         F.count_if(n > 0).alias("n_failed_rows"),
                         F.count(F.lit(1)).alias("n_rows"))


def clean_rows(annotated: DataFrame) -> DataFrame:
    """V10, clean side: rows without violations, annotation dropped."""
    return annotated.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)


def failed_rows(annotated: DataFrame) -> DataFrame:
    """V10, failed side (J4): complete failed rows with their violations."""
    return annotated.filter(F.size(VIOLATIONS) > 0)


def error_summary(v: Column | None = None) -> Column:
    """V7: 'Failed columns: a, b' -- distinct columns in rule order."""
    v = F.col(VIOLATIONS) if v is None else v
    cols = F.array_distinct(F.transform(v, lambda x: x["column"]))
    return F.when(F.size(cols) > 0, F.concat(F.lit(FAILED_PREFIX), F.array_join(cols, ", "))) \
        .otherwise(F.lit(FAILED_PREFIX + "unknown"))


def quarantine_records(annotated: DataFrame, source_table: str, pk: str = "id",
                       total_columns: int | None = None) -> DataFrame:
    """V8: one quarantine record per failed row."""
    if total_columns is None:
        total_columns = len([c for c in annotated.columns if not c.startswith("_")])
    return failed_rows(annotated).select(
        F.lit(source_table).alias("source_table"),
        F.lit(pk).alias("pk_column_name"),
        F.col(pk).cast("string").alias("pk_value"),
        F.lit(total_columns).cast("int").alias("total_columns"),
        error_summary().alias("validation_error"))


def dq_report(failures: DataFrame) -> DataFrame:
    """Failure counts per (source_table, column, check).  Input: rows
    with ``source_table, column, check`` (``failure_cases`` + a source tag)."""
    return failures.groupBy("source_table", "column", "check").agg(
        F.count(F.lit(1)).alias("n_failures"))


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of non-NULL values per column, one aggregation."""
    return df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns])


@dataclass
class Validation:
    """Result of validating one staging batch; all members are lazy."""
    annotated: DataFrame
    rules: RuleSet
    pk: str

    @property
    def clean(self) -> DataFrame:
        return clean_rows(self.annotated)

    @property
    def failed(self) -> DataFrame:
        return failed_rows(self.annotated)

    @property
    def failures(self) -> DataFrame:
        return failure_cases(self.annotated, self.pk)

    def quarantine(self, total_columns: int | None = None) -> DataFrame:
        return quarantine_records(self.annotated, self.rules.table, self.pk, total_columns)


def validate(df: DataFrame, rules: RuleSet | str, pk: str = "id") -> Validation:
    rules = rules_for(rules) if isinstance(rules, str) else rules
    return Validation(annotate(df, rules), rules, pk)
