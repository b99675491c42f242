import os

from quire.plans import pipeline as pl
from quire.sources.tables import Workspace
from quire.streaming import incremental as inc

from test_sources_pipeline import BROKEN, FEED


def test_available_now_picks_up_only_new_files(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    with open(f"{landing}/quality.xml", "w") as f:
        f.write(FEED)
    ws = Workspace(spark, f"{tmp_dir}/ws")
    ckpt = f"{tmp_dir}/ckpt"
    inc.run_available(ws, "medium", landing, ckpt)
    runs = ws.read("runs").collect()
    assert len(runs) == 1 and runs[0].staged == 2
    assert {r.article_id for r in pl.current_dimension(ws).collect()} == {"https://ex.org/p/a1"}
    # nothing new: no new batch
    inc.run_available(ws, "medium", landing, ckpt)
    assert ws.read("runs").count() == 1
    # a new intact file and a broken one: only the intact file's items are staged
    with open(f"{landing}/lineage.xml", "w") as f:
        f.write(FEED.replace("a1", "c1").replace("a2", "c2"))
    with open(f"{landing}/broken.xml", "w") as f:
        f.write(BROKEN)
    inc.run_available(ws, "medium", landing, ckpt)
    runs = sorted(ws.read("runs").collect(), key=lambda r: r.run_seq)
    assert len(runs) == 2 and runs[1].staged == 2
    assert {r.article_id for r in pl.current_dimension(ws).collect()} == {
        "https://ex.org/p/a1", "https://ex.org/p/c1"}


def test_available_now_article_csv(spark, tmp_dir):
    from test_sources_pipeline import CSV
    landing = f"{tmp_dir}/csv"
    os.makedirs(landing)
    with open(f"{landing}/a.csv", "w") as f:
        f.write(CSV)
    ws = Workspace(spark, f"{tmp_dir}/ws")
    ckpt = f"{tmp_dir}/ckpt"
    inc.run_available(ws, "gfg", landing, ckpt)
    runs = ws.read("runs").collect()
    assert len(runs) == 1 and (runs[0].staged, runs[0].clean) == (3, 1)
    with open(f"{landing}/b.csv", "w") as f:
        f.write("title,author_id,last_updated,link,category\n"
                "Another good one,ann,\"05 Mar, 2024\",https://ex.org/another-good-one/,hard\n")
    inc.run_available(ws, "gfg", landing, ckpt)
    runs = sorted(ws.read("runs").collect(), key=lambda r: r.run_seq)
    assert len(runs) == 2 and runs[1].staged == 1
    # the two rows quarantined by the first batch are retried with the second
    assert runs[1].pending == 3 and runs[1].quarantined == 2
    assert {r.article_id for r in pl.current_dimension(ws).collect()} == {"sorting-a-list", "another-good-one"}


def _articles(ws):
    d = pl.current_dimension(ws)
    return set() if d is None else {r.article_id for r in d.collect()}


def test_every_workspace_fresh_checkpoint_and_reset_loads_every_file(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    with open(f"{landing}/quality.xml", "w") as f:
        f.write(FEED)
    first, second = Workspace(spark, f"{tmp_dir}/ws1"), Workspace(spark, f"{tmp_dir}/ws2")
    for ws in (first, second):
        inc.run_available(ws, "medium", landing)
        assert _articles(ws) == {"https://ex.org/p/a1"}
    # a fresh checkpoint counts its batches anew; its first batch is not taken for a committed one
    with open(f"{landing}/lineage.xml", "w") as f:
        f.write(FEED.replace("a1", "c1").replace("a2", "c2"))
    inc.run_available(first, "medium", landing, f"{tmp_dir}/fresh")
    assert _articles(first) == {"https://ex.org/p/a1", "https://ex.org/p/c1"}
    second.reset()
    assert _articles(second) == set()
    inc.run_available(second, "medium", landing)
    assert _articles(second) == {"https://ex.org/p/a1", "https://ex.org/p/c1"}


def test_reopen_refuses_a_committed_run_id(spark, tmp_dir):
    import pytest
    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    with open(f"{landing}/quality.xml", "w") as f:
        f.write(FEED)
    ws = Workspace(spark, f"{tmp_dir}/ws")
    inc.run_available(ws, "medium", landing)
    before = _articles(ws)
    used = ws.read("runs").first()
    with pytest.raises(ValueError):
        pl.reopen(ws, ws.read(used.source_table).select("id"), used.source_table, used.run_id)
    assert _articles(ws) == before and ws.read("runs").count() == 1


def test_stream_stores_rejected_files(spark, tmp_dir):
    import os.path
    from test_sources_pipeline import REASONS, land_mixed
    land_mixed(f"{tmp_dir}/landing")
    ws = Workspace(spark, f"{tmp_dir}/ws")
    inc.run_available(ws, "medium", f"{tmp_dir}/landing")
    got = {os.path.basename(r.source_file): r.reason for r in ws.read("rejected_files").collect()}
    assert got == REASONS
