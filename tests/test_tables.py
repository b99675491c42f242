import pytest
from pyspark.sql import functions as F

from quire.sources import files as fs
from quire.sources.tables import Workspace, schema_of, with_defaults, write_csv


def test_workspace_table_lifecycle(spark, tmp_dir):
    ws = Workspace(spark, f"{tmp_dir}/ws")
    assert not ws.exists("dq_quarantine")
    assert ws.create("dq_quarantine") and not ws.create("dq_quarantine")
    assert ws.read("dq_quarantine").count() == 0
    assert ws.columns("dq_quarantine") == [f.name for f in schema_of("dq_quarantine").fields]
    with pytest.raises(ValueError):
        schema_of("nope")
    assert ws.drop("dq_quarantine") and not ws.exists("dq_quarantine")


def test_write_modes_and_run_partitions(spark, tmp_dir):
    ws = Workspace(spark, f"{tmp_dir}/ws")
    rows = spark.createDataFrame([("t", "k", "v", 1, 1, "r1")],
                                 "source_table string, pk_value string, state string, "
                                 "run_seq long, x int, run_id string")
    led = with_defaults(rows, timestamps=("at",))
    ws.write_run(led, "ledger")
    ws.write_run(led, "ledger")                    # same run again: replaced, not doubled
    assert ws.read("ledger").count() == 1
    ws.write_run(led.withColumn("run_id", F.lit("r2")), "ledger")
    assert ws.read("ledger").count() == 2
    with pytest.raises(ValueError):
        ws.write(rows.drop("state"), "ledger")
    ws.write(led, "ledger", "replace")
    assert ws.read("ledger").count() == 1
    with pytest.raises(Exception):
        ws.write(led, "ledger", "fail")


def test_csv_export_and_reread(spark, tmp_dir):
    occ = spark.createDataFrame([("A", 2022, 1.0, 2.0, 50.0, 3.0, 4.0, 75.0)], fs.OCCUPANCY_SCHEMA)
    write_csv(occ, f"{tmp_dir}/occ")
    back = fs.read_occupancy(spark, f"{tmp_dir}/occ", "csv")
    assert back.collect() == occ.collect()


def test_observation_csv_keeps_all_columns(spark, tmp_dir):
    with open(f"{tmp_dir}/obs.csv", "w") as f:
        f.write("geo,TIME_PERIOD,unit,indic_cr,OBS_VALUE,freq\nA,2022,Number,x,:,A\nB,2021,Number,x,NA,A\n")
    df = fs.read_observations_csv(spark, f"{tmp_dir}/obs.csv")
    assert [c for c in df.columns if not c.startswith("_")] == ["geo", "TIME_PERIOD", "unit",
                                                                "indic_cr", "OBS_VALUE", "freq"]
    assert [r.OBS_VALUE for r in df.orderBy("geo").collect()] == [":", None]


def test_generic_ingest_aligns_and_replays(spark, tmp_dir):
    from quire.operators import staging as stg
    from quire.sources.tables import ingest, preview
    ws = Workspace(spark, f"{tmp_dir}/ws")
    raw = spark.createDataFrame([(1, "Sorting a list", "bob", "02 Jan, 2023", "https://ex.org/s/", "easy")],
                                "id long, title string, author_id string, last_updated string, "
                                "link string, category string")
    ingest(ws, raw, "stg_gfg_articles", stg.transform_gfg, run_id="r1")
    ingest(ws, raw, "stg_gfg_articles", stg.transform_gfg, run_id="r1")
    rows = ws.read("stg_gfg_articles").collect()
    assert len(rows) == 1 and rows[0].article_id == "s" and rows[0].ingested_at is not None
    assert preview(ws.read("stg_gfg_articles")).count() == 1
