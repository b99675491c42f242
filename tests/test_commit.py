"""The commit log and what it holds together: bucketed dimension, open queue,
ledger snapshot, monitoring counts, retention."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from quire.operators import dimension as dim
from quire.operators import ledger as led
from quire.operators import validate as val
from quire.operators.rules import GFG_RULES, RuleSet, max_length
from quire.plans import dimstore, retention
from quire.plans import pipeline as pl
from quire.sources.commitlog import SNAPSHOT_EVERY, CommitLog, State, Superseded
from quire.sources.tables import Workspace

NOW = dt.datetime(2024, 1, 1)


def articles(spark, ids, title="Title of {}", author="bob"):
    rows = [(title.format(i), author, "02 Jan, 2023", f"https://ex.org/a{i}/", "easy" if i % 3 else None) for i in ids]
    return spark.createDataFrame(rows, "title string, author_id string, last_updated string, link string, category string")


def feed(spark, ids, title="Entry {}"):
    rows = [("f", title.format(i), f"https://ex.org/f{i}/", f"f{i}", [("t",)], [("Ann",)]) for i in ids]
    return spark.createDataFrame(rows, "feed string, title string, link string, id string, tags array<struct<term:string>>, authors array<struct<name:string>>")


def dimension(ws):
    return {r.article_id: r for r in pl.current_dimension(ws).collect()}


def between(monkeypatch, run_id, act):
    """Calls act() when the run is about to put its commit for the first time."""
    put, todo = CommitLog._put, [act]

    def late(self, folder, version, content):
        if (content.get("report") or {}).get("run_id") == run_id and todo:
            todo.pop()()
        return put(self, folder, version, content)
    monkeypatch.setattr(CommitLog, "_put", late)


def test_a_run_reads_and_writes_its_buckets_only(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(dimstore, "BUCKETS", 64)
    ws = Workspace(spark, f"{tmp_dir}/ws")
    pl.run_source(ws, pl.GFG, articles(spark, range(400)), "r1", now=NOW)
    first, before = CommitLog(ws).state(), dimension(ws)
    assert len(first.buckets) > 40
    read = []
    view = dimstore.view
    monkeypatch.setattr(dimstore, "view", lambda ws, state, buckets=None: read.append(buckets) or view(ws, state, buckets))
    r2 = pl.run_source(ws, pl.GFG, articles(spark, [3, 7, 1000], "Changed {}"), "r2").first()
    second = CommitLog(ws).state()
    changed = [b for b in second.buckets if second.buckets[b] != first.buckets.get(b)]
    assert r2.dim_rows == 3 and 1 <= r2.buckets == len(changed) <= 3
    assert [sorted(map(str, b)) for b in read if b is not None] == [sorted(changed)]
    monkeypatch.undo()
    now = dimension(ws)
    assert len(now) == 401 and now["a3"].title == "Changed 3" and now["a3"].id == before["a3"].id
    assert now["a3"].created_at == NOW and now["a3"].updated_at > NOW and now["a5"] == before["a5"]
    files = dimstore.lookup(ws, spark.createDataFrame([("a3",), ("nowhere",)], "article_id string"))
    assert [r.article_id for r in files.collect()] == ["a3"]
    assert len({os.path.dirname(f) for f in files.inputFiles()}) <= 2


def test_log_entries_are_put_once(spark, tmp_dir):
    ws = Workspace(spark, f"{tmp_dir}/ws")
    log = CommitLog(ws)
    assert log.state() == State() and log._put(log.dir, 1, {"kind": "x"}) and not log._put(log.dir, 1, {"kind": "y"})
    assert log._read(f"{log.dir}/{1:020d}.json") == {"kind": "x"}
    wins = []

    def attempt():
        wins.extend(v for v in range(2, 30) if log._put(log.dir, v, {"kind": "z"}))
    threads = [threading.Thread(target=attempt) for _ in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(wins) == list(range(2, 30))


def test_state_from_snapshot_and_tail(spark, tmp_dir):
    log = CommitLog(Workspace(spark, f"{tmp_dir}/ws"))
    for i in range(2 * SNAPSHOT_EVERY + 3):
        assert log.begin(f"t/r{i}", "t", 10) == (i + 1, 10 * i)
    assert log._versions(log.snapshots) == [SNAPSHOT_EVERY, 2 * SNAPSHOT_EVERY]
    whole = State()
    for v in log._versions(log.dir):
        whole = whole.after(log._read(f"{log.dir}/{v:020d}.json"))
    assert log.state() == whole and log.state(5).next_ids == {"t": 50}


def test_two_sources_at_once(spark, tmp_dir, monkeypatch):
    """The second commit redoes the buckets that both replaced, and no others."""
    monkeypatch.setattr(dimstore, "BUCKETS", 64)
    ws = Workspace(spark, f"{tmp_dir}/ws")
    pl.run_source(ws, pl.GFG, articles(spark, range(300)), "r1")
    upserts = []
    init = dimstore.Upsert.__init__
    monkeypatch.setattr(dimstore.Upsert, "__init__", lambda self, *a: upserts.append(self) or init(self, *a))
    between(monkeypatch, "slow", lambda: pl.run_source(ws, pl.MEDIUM, feed(spark, range(20)), "fast"))
    pl.run_source(ws, pl.GFG, articles(spark, range(290, 320), "Slow {}"), "slow")
    slow, fast = upserts
    assert len(fast.rewritten) == 1 and len(slow.rewritten) == 2
    assert set(slow.rewritten[1]) == set(slow.rewritten[0]) & set(fast.rewritten[0]) != set(slow.rewritten[0])
    now = dimension(ws)
    assert set(now) == {f"a{i}" for i in range(320)} | {f"f{i}" for i in range(20)}
    assert all(now[f"a{i}"].title == f"Slow {i}" for i in range(290, 320)) and len({r.id for r in now.values()}) == 340


def test_one_source_twice_at_once(spark, tmp_dir, monkeypatch):
    """No id twice, no lost row of either open queue."""
    ws = Workspace(spark, f"{tmp_dir}/ws")
    bad = lambda ids: articles(spark, ids, title="{}")  # noqa: E731  too short
    pl.run_source(ws, pl.GFG, bad(range(3)), "r1")
    between(monkeypatch, "slow", lambda: pl.run_source(ws, pl.GFG, articles(spark, [10, 11]).unionByName(bad([20])), "fast"))
    r = pl.run_source(ws, pl.GFG, articles(spark, [12]).unionByName(bad([21])), "slow").first()
    assert (r.pending, r.checked, r.clean, r.quarantined) == (5, 2, 1, 4)
    assert set(dimension(ws)) == {"a10", "a11", "a12"}
    assert sorted(r.article_id for r in pl.open_queue(ws, "stg_gfg_articles").collect()) == ["a0", "a1", "a2", "a20", "a21"]
    ids = [r.id for r in ws.read("stg_gfg_articles").collect()]
    assert len(ids) == len(set(ids)) == 8
    assert sorted(r.article_id for r in pl.unprocessed(ws, "stg_gfg_articles").collect()) == ["a0", "a1", "a2", "a20", "a21"]


def test_threads(spark, tmp_dir):
    ws, errors = Workspace(spark, f"{tmp_dir}/ws"), []

    def run(i):
        try:
            pl.run_source(ws, pl.GFG if i % 2 else pl.MEDIUM, (articles if i % 2 else feed)(spark, range(10 * i, 10 * i + 15)), f"r{i}")
        except Exception as e:  # noqa: BLE001  shown by the assertion
            errors.append(e)
    threads = [threading.Thread(target=run, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and ws.read("runs").count() == 4
    now = dimension(ws)
    assert set(now) == {f"a{i}" for k in (10, 30) for i in range(k, k + 15)} | {f"f{i}" for k in (0, 20) for i in range(k, k + 15)}
    assert len({r.id for r in now.values()}) == len(now)
    assert dimstore.stats(ws).first().total == len(now)


def test_a_run_begun_again_supersedes(spark, tmp_dir, monkeypatch):
    ws = Workspace(spark, f"{tmp_dir}/ws")
    between(monkeypatch, "r1", lambda: pl.run_source(ws, pl.GFG, articles(spark, [1]), "r1"))
    with pytest.raises(Superseded):
        pl.run_source(ws, pl.GFG, articles(spark, [1]), "r1")
    assert set(dimension(ws)) == {"a1"} and ws.read("runs").count() == 1


def test_nothing_of_a_failed_run_is_seen(spark, tmp_dir, monkeypatch):
    ws = Workspace(spark, f"{tmp_dir}/ws")
    pl.run_source(ws, pl.GFG, articles(spark, [1]), "r1")

    def fail():
        raise OSError("lost")
    between(monkeypatch, "r2", fail)
    with pytest.raises(OSError):
        pl.run_source(ws, pl.GFG, articles(spark, [1, 2], "Other {}"), "r2")
    assert dimension(ws)["a1"].title == "Title of 1" and set(dimension(ws)) == {"a1"}
    assert pl.ledger_entries(ws).count() == 1 and dimstore.stats(ws).first().total == 1
    pl.run_source(ws, pl.GFG, articles(spark, [1, 2], "Other {}"), "r2")
    assert {k: r.title for k, r in dimension(ws).items()} == {"a1": "Other 1", "a2": "Other 2"}
    assert pl.ledger_entries(ws).count() == 3 and ws.read("stg_gfg_articles").count() == 3


def test_unique_keys_are_checked_before_the_commit(spark, tmp_dir):
    ws = Workspace(spark, f"{tmp_dir}/ws")
    row = ("k", dim.GFG, "t", None, None, None, None, True, 1)
    twice = spark.createDataFrame([row, row], "article_id string, source_platform string, title string, author string, pub_date date, link string, category string, is_valid boolean, _src_pk long")
    with pytest.raises(val.SchemaError, match="more than once"):
        CommitLog(ws).commit(dimstore.Upsert(ws, twice, F.lit(NOW), F.col("_src_pk"), "x").entry)
    assert CommitLog(ws).state() == State() and pl.current_dimension(ws) is None


def check_monitoring(ws):
    d = pl.current_dimension(ws)
    assert dimstore.stats(ws).collect() == dim.stats(d).collect()
    assert sorted(dimstore.by_platform(ws).collect()) == sorted(dim.by_platform(d).collect())
    assert dimstore.top_categories(ws).collect() == dim.top_categories(d).collect()


def test_monitoring_counts_equal_a_recount(spark, tmp_dir):
    ws = Workspace(spark, f"{tmp_dir}/ws")
    assert dimstore.stats(ws).first().total == 0
    pl.run_source(ws, pl.GFG, articles(spark, range(200)), "r1")
    check_monitoring(ws)
    pl.run_source(ws, pl.MEDIUM, feed(spark, range(50)), "r1")
    check_monitoring(ws)
    newer = articles(spark, range(100, 150)).withColumn("category", F.lit("moved")).withColumn("last_updated", F.lit("05 Mar, 2025"))
    pl.run_source(ws, pl.GFG, newer, "r2")
    check_monitoring(ws)
    keys = pl.ledger_entries(ws).filter("run_id = 'r2'").select(F.col("pk_value").cast("long").alias("id")).limit(9)
    pl.reopen(ws, keys, "stg_gfg_articles", "fix")
    pl.run_source(ws, pl.GFG, articles(spark, []), "r3")
    check_monitoring(ws)
    dimstore.rebucket(ws, 7)
    assert CommitLog(ws).state().n_buckets == 7 and len(CommitLog(ws).state().buckets) == 7
    check_monitoring(ws)
    pl.run_source(ws, pl.GFG, articles(spark, range(195, 205), "Late {}"), "r4")
    check_monitoring(ws)
    assert dimension(ws)["a199"].title == "Late 199"


def test_ledger_snapshot_and_tail(spark, tmp_dir):
    ws = Workspace(spark, f"{tmp_dir}/ws")
    table = "stg_gfg_articles"

    def same():
        full = led.current_state(ws.read("ledger")).collect()
        assert sorted(led.current_state(pl.ledger_entries(ws)).collect()) == sorted(full)
        want = led.unprocessed(ws.read(table), ws.read("ledger"), table).select("id").collect()
        assert sorted(pl.unprocessed(ws, table).select("id").collect()) == sorted(want)
    pl.run_source(ws, pl.GFG, articles(spark, range(30)), "r1")
    pl.reopen(ws, ws.read(table).filter("article_id IN ('a1', 'a2')").select("id"), table, "fix")
    same()
    pl.compact_ledger(ws)
    assert CommitLog(ws).state().tail == [] and pl.ledger_entries(ws).count() == 30
    same()
    pl.run_source(ws, pl.GFG, articles(spark, range(40, 45)), "r2")
    same()
    files = pl.ledger_entries(ws).inputFiles()
    assert all("ledger_snapshot" in f or "run_id=r2" in f for f in files)
    pl.compact_ledger(ws)
    same()
    assert pl.ledger_entries(ws).count() == 35


def test_unchanged_rules_judge_a_row_once(spark, tmp_dir, monkeypatch):
    ws = Workspace(spark, f"{tmp_dir}/ws")
    pl.run_source(ws, pl.GFG, articles(spark, range(5), title="{}"), "r1")
    n = []
    annotate = val.annotate
    monkeypatch.setattr(val, "annotate", lambda df, rules: n.append(df.count()) or annotate(df, rules))
    r = pl.run_source(ws, pl.GFG, articles(spark, []), "r2").first()
    assert n == [0] and (r.pending, r.checked, r.quarantined) == (5, 0, 5)
    assert ws.read("dq_quarantine").filter("run_id = 'r2'").count() == 0 and pl.latest_quarantine(ws).count() == 5
    # another limit is another fingerprint: all are judged again, and pass
    import dataclasses
    title = dataclasses.replace(GFG_RULES.columns[1], checks=(max_length(200, "title too long"),))
    rules = RuleSet(GFG_RULES.table, (GFG_RULES.columns[0], title, *GFG_RULES.columns[2:]))
    assert rules.fingerprint() != GFG_RULES.fingerprint() == dataclasses.replace(GFG_RULES).fingerprint()
    r = pl.run_source(ws, dataclasses.replace(pl.GFG, rules=rules), articles(spark, []), "r3").first()
    assert (n[-1], r.checked, r.clean, r.quarantined) == (5, 5, 5, 0) and len(dimension(ws)) == 5
    ids = [r.id for r in ws.read("dq_quarantine").collect()]
    assert len(ids) == len(set(ids)) == 5


def test_retention_keeps_what_a_reader_needs(spark, tmp_dir):
    ws = Workspace(spark, f"{tmp_dir}/ws")
    pl.run_source(ws, pl.GFG, articles(spark, range(50)).unionByName(articles(spark, [99], title="{}")), "r1")
    reader = pl.current_dimension(ws)
    old = CommitLog(ws).state()
    pl.run_source(ws, pl.GFG, articles(spark, range(50), "Second {}"), "r2")
    pl.compact_ledger(ws)
    pl.compact_ledger(ws)
    assert retention.clean(ws, dt.timedelta(hours=1)) == []
    assert {r.title for r in reader.collect()} == {f"Title of {i}" for i in range(50)}
    # begun and not committed: its files are younger than the grace time
    log = CommitLog(ws)
    log.begin("stg_gfg_articles/r3", "stg_gfg_articles", 5)
    os.makedirs(f"{tmp_dir}/ws/dim_articles/data/run-99-x/bucket=1")
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=30)
    assert retention.clean(ws, dt.timedelta(hours=1), later) == []
    gone = retention.clean(ws, dt.timedelta(hours=1), later + dt.timedelta(hours=1))
    assert {os.path.basename(p) for p in gone} >= {*old.buckets.values(), "run-99-x"} and not os.path.isdir(f"{tmp_dir}/ws/_work/run_id=r1")
    assert {r.title for r in pl.current_dimension(ws).collect()} == {f"Second {i}" for i in range(50)}
    assert pl.open_queue(ws, "stg_gfg_articles").count() == 1 and pl.ledger_entries(ws).count() == 100
    check_monitoring(ws)
    assert retention.clean(Workspace(spark, f"{tmp_dir}/none"), dt.timedelta(0)) == []
