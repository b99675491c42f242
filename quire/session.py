"""SparkSession defaults used by tests, bench and the pipeline CLI.

Library functions never build a session themselves: they take the caller's
session, so a cluster's own settings (shuffle partitions, checkpoint dir,
memory) win.  ``get_session`` is for local runs only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every query relies on for deterministic text/date output.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "quire", extra: dict | None = None) -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = SparkSession.builder.master(master).appName(app_name)
    conf = {**REQUIRED_CONF, **LOCAL_CONF,
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": os.environ.get("QUIRE_DRIVER_MEMORY", "8g")}
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir; set a scratch one only when unset
    (tests and local runs).  On a cluster the shared folder named in
    ``spark.checkpoint.dir`` is used as is."""
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        cur = spark.sparkContext.getCheckpointDir()
    if not cur:
        cur = tempfile.mkdtemp(prefix="quire-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
        spark.sparkContext.setCheckpointDir(cur)
    return cur


def apply_required_conf(spark: SparkSession) -> None:
    """Pin the settings our text/date formatting depends on."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
