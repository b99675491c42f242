"""All registered queries (name -> callable(spark, sf_dir)) and oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.plans import etl_queries, indicator_queries, text_queries
from quire.session import apply_required_conf

_MODULES = [indicator_queries, etl_queries, text_queries]


def _pinned(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_required_conf(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict:
    out = {}
    for m in _MODULES:
        out.update({k: _pinned(v) for k, v in m.QUERIES.items()})
    return out


def all_oracles() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed + article staging -> single-pass validation -> clean rows ->
    deduped upsert into the dimension -> per-platform summary."""
    apply_required_conf(spark)
    return etl_queries.q_dim_by_platform(spark, sf_dir)
