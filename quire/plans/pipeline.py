"""The article ETL run (I5) and its run report.

One call of ``run_source`` = one batch of one source:

1. land    raw rows -> staging columns, row by row, into the run's work folder
2. begin   an entry of the commit log numbers the run and gives it a range of
           ids as long as the batch needs
3. stage   in-feed duplicates out (only keys are shuffled), ids in input
           order -> ``run_id`` partition
4. select  the rows to check: this run's partition plus the rows of the open
           queue that were reopened or that other rules have judged.  Work is
           O(batch + those), never a scan of all staging history
5. check   single-pass validation, written once to the work folder (cuts
           lineage; the consumers below read it)
6. park    quarantine records first (Q16), ``run_id`` partition
7. load    in-batch dedupe -> guard -> upsert into the buckets of its keys
8. mark    ledger rows for the loaded keys
9. commit  one log entry names the new buckets, the new open queue and the
           report.  If another run has committed meanwhile, the buckets and
           the queue that it replaced too are done again on its result

Nothing that a run writes is seen before its entry, every write goes to the
run's own partition or folder, and a committed run is not applied twice.  A run
that is begun anew under the same id takes over: the earlier attempt can no
longer commit.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quire.operators import dimension as dim
from quire.operators import ledger as led
from quire.operators import profile as prof
from quire.operators import staging as stg
from quire.operators import validate as val
from quire.operators.rules import GFG_RULES, MEDIUM_RULES, RuleSet
from quire.plans import dimstore
from quire.sources.commitlog import CommitLog, State, Superseded
from quire.sources.files import materialize
from quire.sources.tables import STAGING_WIDTH, Workspace, _escaped, schema_of

#: Sources that surrogate keys of the dimension leave room for.
MOST_SOURCES = 16


@dataclass(frozen=True)
class SourceProfile:
    staging_table: str
    rules: RuleSet
    transform: Callable[[DataFrame], DataFrame]   # raw rows (with _sid) -> staging columns, row by row
    to_dim: Callable[[DataFrame], DataFrame]
    number: int                                   # tells the sources' surrogate keys apart
    keys: Callable[[DataFrame], list[str]] | None = None   # of rows that keep the last one only
    pk: str = "id"


GFG = SourceProfile("stg_gfg_articles", GFG_RULES,
                    lambda df: stg.transform_gfg(df, keep=("_sid",)), dim.gfg_to_dim, 0)
MEDIUM = SourceProfile("stg_medium_articles", MEDIUM_RULES,
                       lambda df: stg.flatten_feed(df, feed_col="feed", pos_col="_sid"),
                       dim.feed_to_dim, 1, stg.feed_keys)
PROFILES = {"gfg": GFG, "medium": MEDIUM}


def committed_runs(ws: Workspace) -> DataFrame:
    return ws.read("runs")


def current_dimension(ws: Workspace) -> DataFrame | None:
    """The current article dimension (None before any load)."""
    return dimstore.view(ws, CommitLog(ws).state())


def _queue(ws: Workspace, table: str, state: State) -> DataFrame:
    """The open queue, with the fingerprint of the rules that judged a row."""
    schema = schema_of(table).add("_rules", "string")
    path = state.queues.get(table)
    return ws.spark.read.schema(schema).parquet(path) if path else ws.spark.createDataFrame([], schema)


def open_queue(ws: Workspace, table: str) -> DataFrame:
    """Staging rows still open for ``table``: quarantined or reopened."""
    return _queue(ws, table, CommitLog(ws).state()).drop("_rules")


class _QueueChange:
    """A queue without the rows that a run has checked, and with those that
    failed; written anew where another commit has changed the queue."""

    def __init__(self, ws: Workspace, table: str, checked: DataFrame, opened: DataFrame, name: str):
        self.ws, self.table, self.checked, self.opened, self.name = ws, table, checked, opened, name
        self.based_on: str | None = ""
        self.path: str | None = None

    def entry(self, state: State) -> dict:
        now = state.queues.get(self.table)
        if now != self.based_on:
            self.path = f"{self.ws.path('queue_' + self.table)}/{self.name}-{uuid.uuid4().hex[:8]}"
            rest = _queue(self.ws, self.table, state).join(self.checked.select("id"), "id", "left_anti")
            rest.unionByName(self.opened).write.parquet(self.path)
            self.based_on = now
        return {self.table: self.path}


def _key(table: str, run_id: str) -> str:
    return f"{table}/{run_id}"


def _report(ws: Workspace, **values) -> dict:
    return {f.name: values.get(f.name) for f in schema_of("runs")}


def run_source(ws: Workspace, profile: SourceProfile, raw: DataFrame, run_id: str,
               now: dt.datetime | None = None) -> DataFrame:
    spark, table, log = ws.spark, profile.staging_table, CommitLog(ws)
    own = (F.col("run_id") == run_id) & (F.col("source_table") == table)
    done = committed_runs(ws).filter(own)
    if not done.isEmpty():
        return done                                  # committed already: replay is a no-op
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    now_c = F.lit(now).cast("timestamp")
    work = f"{ws.root}/_work/run_id={_escaped(run_id)}/{table}-{uuid.uuid4().hex[:8]}"

    # 1-2. land: ids follow input order (numbered at the scan, before any shuffle)
    landed_obs = Observation("landed")
    profile.transform(raw.withColumn("_sid", F.monotonically_increasing_id())) \
        .observe(landed_obs, F.max("_sid").alias("max_id")).write.parquet(f"{work}/landed")
    top = landed_obs.get["max_id"]
    run_seq, first_id = log.begin(_key(table, run_id), table, 0 if top is None else top + 1)

    # 3. stage
    landed = spark.read.parquet(f"{work}/landed")
    if profile.keys:
        landed = stg.keep_last_in_place(landed, profile.keys(landed), "_sid")
    staged_obs = Observation("staged")
    ws.write_run(landed.withColumn("id", F.lit(first_id) + F.col("_sid")).withColumn("ingested_at", now_c).withColumn("run_id", F.lit(run_id))
                 .observe(staged_obs, F.count(F.lit(1)).alias("n")), table, run_id=run_id)

    # 4-5. rows that these rules have judged already stay as they are
    rules = profile.rules.fingerprint()
    queue = _queue(ws, table, log.state())
    same = F.col("_rules").eqNullSafe(rules)
    carried = queue.filter(same).count()
    staging_cols = schema_of(table).names
    batch = spark.read.schema(schema_of(table)).option("basePath", ws.path(table)).parquet(f"{ws.path(table)}/run_id={_escaped(run_id)}")
    # (new ids are above every queued id, and ``reopen`` keeps the queue unique)
    pending = batch.select(*staging_cols).unionByName(queue.filter(~same).select(*staging_cols))
    annotated = val.annotate(pending, profile.rules)
    chk_obs = Observation("checked")
    annotated.observe(chk_obs, F.count(F.lit(1)).alias("n"), F.count_if(F.size(val.VIOLATIONS) == 0).alias("clean")) \
        .write.parquet(f"{work}/checked")
    checked = spark.read.parquet(f"{work}/checked")
    v = val.Validation(checked, profile.rules, profile.pk)
    c = chk_obs.get

    # 6. quarantine first: a failure here stops the run before anything loads
    q = v.quarantine(STAGING_WIDTH[table]).withColumn("run_timestamp", now_c).withColumn("run_id", F.lit(run_id))
    ws.write_run(q.withColumn("id", F.xxhash64("source_table", "pk_value", "run_id")), "dq_quarantine", source_table=table, run_id=run_id)
    parked = _QueueChange(ws, table, checked, v.failed.select(*staging_cols, F.lit(rules).alias("_rules")), f"run-{run_seq}") if c["n"] else None

    ws.write_run(prof.batch_profile(checked.filter(F.col("run_id") == run_id), profile.rules).withColumn("source_table", F.lit(table)).withColumn("run_id", F.lit(run_id)),
                 "dq_profile", source_table=table, run_id=run_id)

    # 7. dimension: dedupe in batch, guard, upsert of the touched buckets (a
    # batch without clean rows leaves them in place)
    upsert, dim_rows = None, 0
    if c["clean"] > 0:
        # written once, and guarded meanwhile: the bucket numbers and the upsert read it
        in_obs = Observation("incoming")
        latest = dim.latest_per_key(profile.to_dim(v.clean))
        incoming = materialize(latest.observe(in_obs, F.count(F.lit(1)).alias("n"), F.count_if(F.size(dim.guard_violations(latest)) > 0).alias("bad")), f"{work}/incoming")
        dim_rows = in_obs.get["n"]
        if in_obs.get["bad"]:
            # every failure is stored; the error names the table and the count
            failures = f"{ws.root}/_guard/run_id={_escaped(run_id)}/{table}"
            dim.guard(incoming).write.mode("overwrite").parquet(failures)
            raise val.SchemaError("dim_articles", [f"{in_obs.get['bad']} rows, stored in {failures}"])
        new_id = F.col("_src_pk") * MOST_SOURCES + profile.number
        upsert = dimstore.Upsert(ws, incoming, now_c, new_id, f"run-{run_seq}")

    # 8. ledger: counts with the commit only
    marks = led.mark_processed(v.clean.select(profile.pk), table, profile.pk, run_seq, now_c) \
        .withColumn("run_id", F.lit(run_id))
    ws.write_run(marks, "ledger", source_table=table, run_id=run_id)

    # 9. commit
    def entry(state: State) -> dict:
        if state.begun.get(_key(table, run_id)) != run_seq:
            raise Superseded(f"run {run_id!r} of {table} was begun again, or has committed")
        changed = upsert.entry(state) if upsert else {}
        report = _report(ws, run_id=run_id, run_seq=run_seq, source_table=table, at=f"{now.isoformat()}Z", staged=staged_obs.get["n"], pending=c["n"] + carried,
                         checked=c["n"], clean=c["clean"], quarantined=c["n"] + carried - c["clean"], dim_rows=dim_rows, buckets=len(changed.get("buckets", {})))
        return {"kind": "run", "ends": _key(table, run_id), "queues": parked.entry(state) if parked else {}, "marks": [[table, run_id]], "report": report, **changed}
    log.commit(entry)
    return committed_runs(ws).filter(own)


def store_rejected(ws: Workspace, rejected: DataFrame, run_id: str) -> None:
    """The feed files that gave no rows in a run, with the reason."""
    ws.write_run(rejected.withColumnRenamed("_source_file", "source_file")
                 .withColumn("run_id", F.lit(run_id)), "rejected_files", run_id=run_id)


def reopen(ws: Workspace, keys: DataFrame, table: str, run_id: str, pk: str = "id",
           now: dt.datetime | None = None) -> None:
    """Put staging keys back in the queue for the next run (a semi-join
    of staging with the keys -- remediation is rare, so this is the one
    place that reads the whole staging table)."""
    if not committed_runs(ws).filter(F.col("run_id") == run_id).isEmpty():
        raise ValueError(f"run id {run_id!r} is committed already; a reopen needs one of its own")
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    log, key = CommitLog(ws), _key(table, run_id)
    seq, _ = log.begin(key, table, 0)
    # written once: the ledger rows and the queue go by the same keys
    keys = materialize(keys.select(F.col(pk).alias("id")).distinct(), f"{ws.root}/_work/run_id={_escaped(run_id)}/{table}-reopened-{uuid.uuid4().hex[:8]}")
    rows = led.reopen(keys, table, "id", seq, F.lit(now).cast("timestamp")).withColumn("run_id", F.lit(run_id))
    ws.write_run(rows, "ledger", source_table=table, run_id=run_id)
    opened = ws.read(table).join(keys, "id", "left_semi").select(*schema_of(table).names, F.lit(None).cast("string").alias("_rules"))
    queue = _QueueChange(ws, table, keys, opened, f"reopen-{seq}")

    def entry(state: State) -> dict:
        if state.begun.get(key) != seq:
            raise Superseded(f"reopening {run_id!r} of {table} was begun again, or has committed")
        return {"kind": "reopen", "ends": key, "queues": queue.entry(state), "marks": [[table, run_id]],
                "report": _report(ws, run_id=run_id, run_seq=seq, source_table=table, at=f"{now.isoformat()}Z", staged=0)}
    log.commit(entry)


# --- the ledger: a snapshot of the states, and the committed runs after it -------
def ledger_entries(ws: Workspace, state: State | None = None) -> DataFrame:
    """The committed ledger rows that decide every key's state: the snapshot's
    and those of the runs after it.  Rows of runs that never committed, and
    those that the snapshot stands for, are not read."""
    state = state or CommitLog(ws).state()
    schema, spark = schema_of("ledger"), ws.spark
    folders = [f"{ws.path('ledger')}/source_table={_escaped(t)}/run_id={_escaped(r)}" for t, r in state.tail]
    rows = spark.read.schema(schema).option("basePath", ws.path("ledger")).parquet(*folders) if folders else spark.createDataFrame([], schema)
    return rows.unionByName(spark.read.schema(schema).parquet(state.ledger)) if state.ledger else rows


def compact_ledger(ws: Workspace) -> State:
    """One row for each key, the one that decides, in place of all so far."""
    def entry(state: State) -> dict:
        path = f"{ws.path('ledger_snapshot')}/{uuid.uuid4().hex}"
        rows = ledger_entries(ws, state).groupBy("source_table", "pk_value").agg(
            F.max_by(F.struct("state", "run_seq", "at", "run_id"), F.struct("run_seq", "at")).alias("r")).select("source_table", "pk_value", "r.*")
        rows.repartition("source_table", F.pmod(F.xxhash64("pk_value"), F.lit(dimstore.BUCKETS))).write.partitionBy("source_table").parquet(path)
        return {"kind": "ledger", "ledger": path, "covered": state.tail}
    return CommitLog(ws).commit(entry)


def quality_profile(ws: Workspace) -> DataFrame:
    """The staged batches of all committed runs as one profile for each column."""
    runs = committed_runs(ws).select("run_id", "source_table")
    return prof.readable(prof.merge_profiles(ws.read("dq_profile").join(runs, ["run_id", "source_table"], "left_semi")))


def unprocessed(ws: Workspace, table: str) -> DataFrame:
    """The staging rows of committed runs that are not processed."""
    return led.unprocessed(ws.read(table), ledger_entries(ws), table)


def latest_quarantine(ws: Workspace) -> DataFrame:
    """Q4: one quarantine row per (source_table, pk_value), the latest run's."""
    q = ws.read("dq_quarantine")
    return q.groupBy("source_table", "pk_value").agg(
        F.max_by(F.struct(*[c for c in q.columns if c not in ("source_table", "pk_value")]),
                 "run_timestamp").alias("r")).select("source_table", "pk_value", "r.*")
