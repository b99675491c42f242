"""Declarative data-quality rules.

A ``RuleSet`` lists column rules; each column rule says whether the column
must be present, whether NULL is allowed, which type it must have and which
value checks apply.  A value check is a function ``Column -> Column`` (true
= pass), so any built-in Spark expression can be a rule.  Value checks skip
NULLs; a NULL in a non-nullable column is reported once, as ``not_nullable``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# Names of the table-level and null checks.
NOT_NULLABLE = "not_nullable"
COLUMN_PRESENT = "column_in_dataframe"
DTYPE = "dtype"


@dataclass(frozen=True)
class Check:
    name: str
    predicate: Callable[[Column], Column]
    # The same predicate as SQL text over ``{c}``, for reports and oracles.
    sql: str | None = None


def custom(name: str, predicate: Callable[[Column], Column], sql: str | None = None) -> Check:
    return Check(name, predicate, sql)


def min_length(n: int, name: str) -> Check:
    return Check(name, lambda c: F.length(c) >= F.lit(n), f"length({{c}}) >= {n}")


def max_length(n: int, name: str) -> Check:
    return Check(name, lambda c: F.length(c) <= F.lit(n), f"length({{c}}) <= {n}")


def non_empty(name: str) -> Check:
    return Check(name, lambda c: F.length(c) > F.lit(0), "length({c}) > 0")


def matches(pattern: str, name: str) -> Check:
    """Match anchored at the start (Python ``re.match``); the pattern brings
    its own ``$`` when the whole value must match.  Java's ``\\d`` is ASCII
    only, which makes digit rules stricter than Python's."""
    anchored = pattern if pattern.startswith("^") else f"^(?:{pattern})"
    return Check(name, lambda c: c.rlike(anchored),
                 "regexp_matches({c}, '" + anchored.replace("'", "''") + "')")


def contains(pattern: str, name: str) -> Check:
    """The pattern occurs anywhere in the value (``re.search``)."""
    return Check(name, lambda c: c.rlike(pattern),
                 "regexp_matches({c}, '" + pattern.replace("'", "''") + "')")


def starts_with_any(prefixes: Sequence[str], name: str) -> Check:
    def pred(c: Column) -> Column:
        out = None
        for p in prefixes:
            t = c.startswith(p)
            out = t if out is None else (out | t)
        return out
    sql = " OR ".join(f"starts_with({{c}}, '{p}')" for p in prefixes)
    return Check(name, pred, f"({sql})")


def allowed_values(values: Iterable[str], name: str) -> Check:
    vals = list(values)
    return Check(name, lambda c: c.isin(vals),
                 "{c} IN (" + ", ".join("'" + v.replace("'", "''") + "'" for v in vals) + ")")


@dataclass(frozen=True)
class ColumnRule:
    column: str
    nullable: bool = True
    required: bool = True
    dtype: DataType | None = field(default_factory=StringType)
    checks: tuple[Check, ...] = ()


@dataclass(frozen=True)
class RuleSet:
    table: str
    columns: tuple[ColumnRule, ...]
    strict: bool = False          # False: extra columns are allowed

    def column_names(self) -> list[str]:
        return [r.column for r in self.columns]

    def fingerprint(self) -> str:
        """A hash of everything that decides a verdict: another limit, pattern,
        message, type or column order gives another one."""
        said = [(r.column, r.nullable, r.required, r.dtype.simpleString() if r.dtype else None,
                 [(c.name, c.sql, str(c.predicate(F.col(r.column)))) for c in r.checks]) for r in self.columns]
        return hashlib.sha256(repr((self.table, self.strict, said)).encode()).hexdigest()


# ---------------------------------------------------------------------------
# The two staging rule sets (limits, patterns and messages as in
# the reference's validation schemas).
# ---------------------------------------------------------------------------
URL_PATTERN = r"https?://[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
STAGING_TS_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
AUTHOR_ID_PATTERN = r"^[a-zA-Z0-9_-]+$"

GFG_RULES = RuleSet("stg_gfg_articles", (
    ColumnRule("article_id", nullable=False, checks=(non_empty("article_id cannot be empty"),)),
    ColumnRule("title", nullable=False, checks=(min_length(6, "title too short"),
                                                max_length(200, "title too long"))),
    ColumnRule("author_id", checks=(matches(AUTHOR_ID_PATTERN, "invalid author_id format"),)),
    ColumnRule("last_updated", checks=(matches(STAGING_TS_PATTERN, "invalid datetime format"),)),
    ColumnRule("link", checks=(contains(URL_PATTERN, "missing valid URL"),)),
    ColumnRule("category"),
))

MEDIUM_RULES = RuleSet("stg_medium_articles", (
    ColumnRule("id_rss", nullable=False, checks=(non_empty("id_rss cannot be empty"),)),
    ColumnRule("title", nullable=False, checks=(min_length(3, "title too short"),
                                                max_length(500, "title too long"))),
    ColumnRule("title_detail", checks=(starts_with_any(["{", "["], "title_detail must be valid JSON format"),)),
    ColumnRule("summary", checks=(max_length(5000, "summary too long"),)),
    ColumnRule("summary_detail", checks=(starts_with_any(["{", "["], "summary_detail must be valid JSON format"),)),
    ColumnRule("link", checks=(contains(URL_PATTERN, "missing valid URL"),)),
    ColumnRule("published", checks=(matches(ISO_DATE_PATTERN, "published must be in format YYYY-MM-DD"),)),
    ColumnRule("published_parsed", checks=(max_length(200, "published_parsed too long"),)),
    ColumnRule("updated", checks=(matches(ISO_DATE_PATTERN, "updated must be in format YYYY-MM-DD"),)),
    ColumnRule("tags", checks=(starts_with_any(["["], "tags must be valid JSON array"),)),
    ColumnRule("authors", checks=(starts_with_any(["["], "authors must be valid JSON array"),)),
))

# The dimension's own constraints, checked before every write (K1).
DIM_RULES = RuleSet("dim_articles", (
    ColumnRule("article_id", nullable=False, checks=(non_empty("article_id cannot be empty"),)),
    ColumnRule("source_platform", nullable=False,
               checks=(allowed_values(["GFG", "Medium"], "source_platform not allowed"),)),
    ColumnRule("title", nullable=False),
))

RULE_SETS = {r.table: r for r in (GFG_RULES, MEDIUM_RULES, DIM_RULES)}


def rules_for(table: str) -> RuleSet:
    """V2: the rule set registered for a staging table; unknown -> error."""
    try:
        return RULE_SETS[table]
    except KeyError:
        raise ValueError(f"no rules are registered for {table!r}") from None
