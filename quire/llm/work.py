"""Intermediate tables in the cluster's shared folder.

A table that several steps read is written once and reread, which cuts the
lineage: a lost executor costs the tasks it ran, not the steps before."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of rows in a batch for a Python worker (one longer row is a batch alone).
BATCH_BYTES = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.  Only where the session
    names none (tests) a scratch folder is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="quire-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/quire-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and return the reread table."""
    path = path or new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mapped(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes, not by rows alone, so what
    an executor and its workers hold does not grow with the texts' lengths.
    A limit that the session has set stays."""
    conf, limit = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if limit not in conf.getAll:
        conf.set(limit, str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    there = {c.lower() for c in docs.columns}
    while name in there:
        name += "_"
    return name
