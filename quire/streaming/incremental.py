"""G1: the article ETL as a Structured Streaming job over landed files.

A file-source stream (XML feeds, article CSVs or Parquet) with
``trigger(availableNow=True)`` picks up only files it has not seen (the
stream checkpoint replaces the processed flag for new input); each
micro-batch runs the same staging / validation / quarantine / upsert /
ledger steps as a batch run, with ``run_id`` = the batch id, so a batch
replayed after a failure rewrites its own partitions (idempotent sink).

The stream checkpoint lies in the workspace, one for each source and path, and
goes with it on reset.  The run id names the checkpoint's query too, so batches
counted anew by a fresh checkpoint are not taken for committed ones.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.plans import pipeline as pl
from quire.sources import files as fs
from quire.sources.tables import Workspace


#: Feed files of a micro-batch at most; their names pass through the driver.
FILES_PER_BATCH = 10_000


def _landed_files(spark: SparkSession, path: str) -> DataFrame:
    """The paths of newly landed files; their content is not read here, so
    files without any item are seen (and rejected) too."""
    return (spark.readStream.format("binaryFile")
            .schema("path string, modificationTime timestamp, length long, content binary")
            .option("maxFilesPerTrigger", FILES_PER_BATCH).load(path).select("path"))


def _file_columns(df: DataFrame) -> DataFrame:
    # the row position needs monotonically_increasing_id, which streams refuse:
    # it is added per micro-batch (``_with_pos``)
    return df.withColumn("_source_file", F.col("_metadata.file_path")) \
             .withColumn("_block", F.col("_metadata.file_block_start"))


def _with_pos(batch: DataFrame) -> DataFrame:
    return batch.withColumn("_pos", F.struct(F.col("_block").alias("block"),
                                             F.monotonically_increasing_id().alias("row"))) \
                .drop("_block")


def _csv_stream(spark: SparkSession, path: str) -> DataFrame:
    return _file_columns(
        spark.readStream.option("header", True).option("escape", '"').option("multiLine", True)
        .schema(fs.ARTICLE_CSV_SCHEMA).csv(path))


def start(ws: Workspace, source: str, path: str, checkpoint: str | None = None,
          query_name: str | None = None):
    """Start the availableNow stream for ``source`` ('medium' feeds or 'gfg'
    CSVs) landed under ``path``; returns the StreamingQuery."""
    spark = ws.spark
    profile = pl.PROFILES[source]
    of_path = hashlib.sha256(path.encode()).hexdigest()[:16]
    checkpoint = checkpoint or f"{ws.root}/_checkpoints/{source}/{of_path}"
    stream = _landed_files(spark, path) if source == "medium" else _csv_stream(spark, path)

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        # the query's id is stored in the checkpoint and stays the same on restarts
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("the stream's query id is not set")
        run_id = f"{source}-{query_id[:8]}-batch-{batch_id}"
        if source == "medium":
            paths = [r.path for r in batch.collect()]     # at most FILES_PER_BATCH
            raw, rejected = fs.read_feeds(spark, paths, f"{ws.root}/_work/run_id={run_id}/feed_items")
            pl.store_rejected(ws, rejected, run_id)
        else:
            from quire.functions.scalars import na_to_null
            batch = _with_pos(batch)
            raw = batch.select(*[na_to_null(F.col(c)).alias(c) if not c.startswith("_") else F.col(c)
                                 for c in batch.columns])
        pl.run_source(ws, profile, raw, run_id)

    w = (stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def run_available(ws: Workspace, source: str, path: str, checkpoint: str | None = None) -> None:
    """Process every file that has arrived since the last call, then stop."""
    q = start(ws, source, path, checkpoint)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
