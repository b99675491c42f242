"""Processed-state ledger for staging rows (append-only).

The reference flips a ``processed`` flag with ``UPDATE ... WHERE id IN (...)``
over a driver-side key list.  Here every state change is a row
``(source_table, pk_value, state, run_seq, at)`` appended by a distributed
write; the current state of a key is its row with the highest
``(run_seq, at)``.  Re-opening keys for remediation appends ``open`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROCESSED = "processed"
OPEN = "open"
LEDGER_COLUMNS = ["source_table", "pk_value", "state", "run_seq", "at"]
LEDGER_SCHEMA = ("source_table string, pk_value string, state string, "
                 "run_seq long, at timestamp")


def entries(keys: DataFrame, source_table: str, pk: str, state: str, run_seq: int,
            at: Column | None = None) -> DataFrame:
    """Ledger rows for the keys in ``keys`` (no key list on the
    driver, no bound-variable limit)."""
    at = at if at is not None else F.current_timestamp()
    return keys.select(F.lit(source_table).alias("source_table"),
                       F.col(pk).cast("string").alias("pk_value"),
                       F.lit(state).alias("state"),
                       F.lit(run_seq).cast("long").alias("run_seq"),
                       at.cast("timestamp").alias("at"))


def mark_processed(keys: DataFrame, source_table: str, pk: str, run_seq: int,
                   at: Column | None = None) -> DataFrame:
    return entries(keys, source_table, pk, PROCESSED, run_seq, at)


def reopen(keys: DataFrame, source_table: str, pk: str, run_seq: int,
           at: Column | None = None) -> DataFrame:
    return entries(keys, source_table, pk, OPEN, run_seq, at)


def current_state(ledger: DataFrame) -> DataFrame:
    """Latest state per (source_table, pk_value); a partial aggregate, so a
    key with many state changes is reduced before the shuffle."""
    return ledger.groupBy("source_table", "pk_value").agg(
        F.max_by("state", F.struct("run_seq", "at")).alias("state"))


def unprocessed(staging: DataFrame, ledger: DataFrame, source_table: str,
                pk: str = "id") -> DataFrame:
    """Staging rows whose current state is not ``processed``."""
    done = (current_state(ledger.filter(F.col("source_table") == source_table))
            .filter(F.col("state") == PROCESSED).select("pk_value"))
    return staging.join(done, staging[pk].cast("string") == done["pk_value"], "left_anti")
