"""Workspace of Parquet tables in one shared folder: schema registry,
create / drop / reset (K2-K4), guarded writes (K1), CSV export (K5),
default columns (K6), table listing (S10) and parameterised SQL (S7).

Writes that belong to a run go to a ``[source_table=<t>/]run_id=<id>``
partition with dynamic partition overwrite, so re-running a failed run replaces its own output
instead of appending it twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.operators.ledger import LEDGER_SCHEMA

# Table schemas (StructType DDL); ``id`` is unique but not contiguous.
SCHEMAS = {
    "stg_gfg_articles": ("id long, ingested_at timestamp, article_id string, title string, "
                         "author_id string, last_updated string, link string, category string, "
                         "run_id string"),
    "stg_medium_articles": ("id long, ingested_at timestamp, title string, title_detail string, "
                            "summary string, summary_detail string, link string, id_rss string, "
                            "published string, published_parsed string, updated string, "
                            "tags string, authors string, run_id string"),
    "dim_articles": ("id long, article_id string, source_platform string, title string, "
                     "author string, pub_date date, link string, category string, "
                     "is_valid boolean, created_at timestamp, updated_at timestamp, _src_pk long"),
    "dq_quarantine": ("id long, run_timestamp timestamp, source_table string, pk_column_name string, "
                      "pk_value string, total_columns int, validation_error string, run_id string"),
    "ledger": LEDGER_SCHEMA + ", run_id string",
    "runs": ("run_id string, run_seq long, source_table string, at timestamp, staged long, "
             "pending long, checked long, clean long, quarantined long, dim_rows long, buckets long"),
    "dq_profile": ("source_table string, column string, n_rows long, n_null long, n_failures long, min_length int, "
                   "max_length int, distinct_sketch binary, length_sketch binary, run_id string"),
    "rejected_files": "source_file string, reason string, corrupt_records long, run_id string",
}
# What ``total_columns`` says in the quarantine, the width of
# the staging tables with their processed flag (kept in the ledger here).
STAGING_WIDTH = {"stg_gfg_articles": 9, "stg_medium_articles": 14}


def schema_of(name: str) -> StructType:
    if name not in SCHEMAS:
        raise ValueError(f"no table {name!r} is registered")
    return StructType.fromDDL(SCHEMAS[name])


def _escaped(value: str) -> str:
    """A partition value as Spark writes it in a folder's name."""
    return "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{[]^\x7f" or ord(c) < 32 else c for c in value)


class Workspace:
    """Tables under ``root`` (a shared folder on a cluster)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- paths and file system -------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def exists(self, name: str) -> bool:
        """The table has been created."""
        fs, p = self._fs(self.path(name))
        return bool(fs.exists(p))

    def columns(self, name: str) -> list[str]:
        """Column listing."""
        return self.read(name).columns

    # --- K2-K4 ------------------------------------------------------------
    def create(self, name: str) -> bool:
        """K2: create an empty table with the registered schema if absent."""
        if self.exists(name):
            return False
        schema_of(name)
        fs, p = self._fs(self.path(name))
        return bool(fs.mkdirs(p))

    def drop(self, name: str) -> bool:
        """K3."""
        fs, p = self._fs(self.path(name))
        return bool(fs.delete(p, True)) if fs.exists(p) else False

    def reset(self) -> None:
        """K4: remove every table of the workspace (opt-in, never implicit):
        the registered tables, the dimension store, open queues and run work
        folders."""
        for name in ["log", "log_state", *SCHEMAS, "ledger_snapshot", "_work", "_guard", "_checkpoints", *[f"queue_{t}" for t in STAGING_WIDTH]]:
            self.drop(name)

    # --- reads and writes ---------------------------------------------------
    def read(self, name: str) -> DataFrame:
        if name == "runs":
            return self._runs()
        if not self.exists(name):
            self.create(name)
        return self.spark.read.schema(schema_of(name)).parquet(self.path(name))

    def _runs(self) -> DataFrame:
        """The run reports, from the entries of the commit log."""
        schema = schema_of("runs")
        if not self.exists("log"):
            return self.spark.createDataFrame([], schema)
        fields = ", ".join(f"{f.name}: {'string' if f.name == 'at' else f.dataType.simpleString()}" for f in schema)
        rows = self.spark.read.schema(f"report struct<{fields}>").json(self.path("log")).filter("report IS NOT NULL").select("report.*")
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in schema])

    def write(self, df: DataFrame, name: str, mode: str = "append",
              partition_by: list[str] | None = None) -> None:
        """K1: write with the registered column order and types.  Modes:
        append, errorifexists ('fail'), overwrite ('replace', and
        'delete_rows': all rows go, the registered schema stays), and
        ``overwrite_partitions`` (dynamic: only the partitions present in
        ``df`` are replaced)."""
        out = self._aligned(df, name)
        mode = {"fail": "errorifexists", "replace": "overwrite", "delete_rows": "overwrite"}.get(mode, mode)
        w = out.write
        if mode == "overwrite_partitions":
            w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        else:
            w = w.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(name))

    def _aligned(self, df: DataFrame, name: str) -> DataFrame:
        schema = schema_of(name)
        missing = [c for c in schema.names if c not in df.columns]
        if missing:
            raise ValueError(f"{name}: missing columns {missing}")
        return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])

    def write_run(self, df: DataFrame, name: str, **partition: str) -> None:
        """Idempotent per run: replaces the ``run_id`` partition(s) in ``df``
        (per source table where the table is shared by sources, so two
        sources loaded under one run id never replace each other's rows).
        With the partition's values given it is replaced by an empty ``df`` too."""
        keys = ["source_table", "run_id"] if "source_table" in schema_of(name).names else ["run_id"]
        if not partition:
            return self.write(df, name, "overwrite_partitions", keys)
        folder = "/".join(f"{k}={_escaped(partition[k])}" for k in keys)
        self._aligned(df, name).drop(*keys).write.mode("overwrite").parquet(f"{self.path(name)}/{folder}")

    def sql(self, statement: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
        """Parameterised SQL over workspace tables (``{name}`` refers to
        a table of the workspace or a frame passed by keyword; ``:p`` are
        bound parameters, never string-pasted)."""
        refs = {n: self.read(n) for n in SCHEMAS if "{" + n + "}" in statement}
        refs.update(frames)
        return self.spark.sql(statement, args=args, **refs)


def ingest(ws: "Workspace", df: DataFrame, table: str, transform=None,
           run_id: str | None = None) -> DataFrame:
    """Generic ingest -- optional ``transform(df)``, then the rows
    aligned to the registered schema (absent columns NULL, ``ingested_at`` =
    now) and appended; with ``run_id`` the run's partition is replaced
    instead, so the ingest can be repeated safely.  Returns the written
    frame (lazy)."""
    schema = schema_of(table)
    out = df.transform(transform) if transform else df
    if "ingested_at" in schema.names and "ingested_at" not in out.columns:
        out = with_defaults(out)
    if run_id is not None:
        out = out.withColumn("run_id", F.lit(run_id))
    out = out.select(*[(F.col(f.name) if f.name in out.columns else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])
    if run_id is not None and "run_id" in schema.names:
        ws.write_run(out, table)
    else:
        ws.write(out, table, "append")
    return out


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows (a limit, pushed into the scan)."""
    return df.limit(n)


def with_defaults(df: DataFrame, now: Column | None = None, **flags) -> DataFrame:
    """K6: timestamp defaults (``ingested_at`` / ``created_at`` ... = now)."""
    now = now if now is not None else F.current_timestamp()
    for name in flags.get("timestamps", ("ingested_at",)):
        df = df.withColumn(name, now)
    return df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sort_by: tuple[str, ...] = ()) -> None:
    """K5: CSV result with a header (one directory of part files).  With
    ``sort_by`` the rows are in order within and across the files (O1)."""
    if sort_by:
        df = df.orderBy(*sort_by)
    df.write.mode(mode).option("header", True).csv(path)
