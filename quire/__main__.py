"""Command line: one ETL run over landed files (the reference's ``main``).

    python -m quire run --workspace DIR [--csv PATH ...] [--feeds PATH ...]
                        [--run-id ID] [--stream] [--reset]
    python -m quire stats --workspace DIR
    python -m quire maintain --workspace DIR [--buckets N] [--grace-hours H]

``run`` loads each given source as one batch (or, with ``--stream``, every
file that arrived since the last streamed batch) and prints the run reports
and the dimension summary.  ``maintain`` compacts the ledger, deals the
dimension into another number of buckets if asked to, and removes files that
no state of the last hours names.  The session comes from ``spark-submit`` on a
cluster; locally a ``local[*]`` session is made.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    """The session of spark-submit, with the cluster's own settings."""
    return SparkSession.builder.appName("quire").getOrCreate()


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="quire")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    r.add_argument("--workspace", required=True)
    r.add_argument("--csv", nargs="*", default=[])
    r.add_argument("--feeds", nargs="*", default=[])
    r.add_argument("--run-id", default=None)
    r.add_argument("--stream", action="store_true")
    r.add_argument("--reset", action="store_true",
                   help="drop every table of the workspace first (opt-in)")
    s = sub.add_parser("stats")
    s.add_argument("--workspace", required=True)
    m = sub.add_parser("maintain")
    m.add_argument("--workspace", required=True)
    m.add_argument("--buckets", type=int, default=None)
    m.add_argument("--grace-hours", type=float, default=24.0)
    a = ap.parse_args(argv)

    from quire.plans import dimstore, retention
    from quire.plans import pipeline as pl
    from quire.session import apply_required_conf
    from quire.sources import files as fs
    from quire.sources.tables import Workspace

    spark = _session()
    apply_required_conf(spark)
    ws = Workspace(spark, a.workspace)
    if a.cmd == "run" and a.reset:
        ws.reset()
    if a.cmd == "run":
        run_id = a.run_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
        if a.stream:
            from quire.streaming import incremental as inc
            for p in a.csv:
                inc.run_available(ws, "gfg", p)
            for p in a.feeds:
                inc.run_available(ws, "medium", p)
        else:
            if a.csv:
                pl.run_source(ws, pl.GFG, fs.read_article_csv(spark, a.csv), run_id).show(truncate=False)
            if a.feeds:
                entries, rejected = fs.read_feeds(
                    spark, a.feeds, work_dir=f"{ws.root}/_work/run_id={run_id}/feed_items")
                pl.store_rejected(ws, rejected, run_id)
                rejected.show(truncate=False)
                pl.run_source(ws, pl.MEDIUM, entries, run_id).show(truncate=False)
    if a.cmd == "maintain":
        pl.compact_ledger(ws)
        if a.buckets:
            dimstore.rebucket(ws, a.buckets)
        print(f"{len(retention.clean(ws, dt.timedelta(hours=a.grace_hours)))} folders removed")
        return
    # from the buckets' counts: the dimension is not read
    dimstore.stats(ws).show(truncate=False)
    dimstore.by_platform(ws).show(truncate=False)
    if a.cmd == "stats":
        # open quarantine: the latest record per key, grouped by reason
        pl.latest_quarantine(ws).groupBy("source_table", "validation_error").count() \
            .orderBy("source_table", "validation_error").show(truncate=False)


if __name__ == "__main__":
    main()
