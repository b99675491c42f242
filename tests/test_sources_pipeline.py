import os

from pyspark.sql import functions as F

from quire.plans import pipeline as pl
from quire.sources import files as fs
from quire.sources.tables import Workspace

FEED = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:atom="http://www.w3.org/2005/Atom">
<channel><title>t</title>
<item><title>First article here</title><link>https://ex.org/a1/</link><guid isPermaLink="false">https://ex.org/p/a1</guid><category>data</category><category>quality</category><dc:creator>Ann</dc:creator><pubDate>Fri, 23 Jan 2026 10:00:00 GMT</pubDate><atom:updated>2026-01-23T10:00:00.000Z</atom:updated><description>Hello</description></item>
<item><title>No tags here</title><link>https://ex.org/a2/</link><guid isPermaLink="false">https://ex.org/p/a2</guid><pubDate>bad</pubDate><description>x</description></item>
<item><title>First article again</title><link>https://ex.org/a1/</link><guid isPermaLink="false">https://ex.org/p/a1</guid><category>data</category><dc:creator>Ann</dc:creator><pubDate>Fri, 23 Jan 2026 10:00:00 +0000</pubDate><description>Hello2</description></item>
</channel></rss>
"""
BROKEN = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0"><channel>
<item><title>Good one</title><link>https://ex.org/b1/</link><guid>g1</guid></item>
<item><title>Broken <b>one</title><link>https://ex.org/b2/</link>
</channel></rss>
"""
CSV = ('title,author_id,last_updated,link,category\n'
       '"Sorting, a list",bob_7,"02 Jan, 2023",https://ex.org/sorting-a-list/,easy\n'
       'NA,bob,"2 Jan, 2023",https://ex.org/na/,null\n'
       '"Say ""hi""\nthere",x,junk,not-a-url,\n')


def land(tmp_dir):
    os.makedirs(f"{tmp_dir}/feeds")
    with open(f"{tmp_dir}/feeds/quality.xml", "w") as f:
        f.write(FEED)
    with open(f"{tmp_dir}/feeds/broken.xml", "w") as f:
        f.write(BROKEN)
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write(CSV)


def test_csv_source(spark, tmp_dir):
    land(tmp_dir)
    rows = fs.read_article_csv(spark, f"{tmp_dir}/a.csv").orderBy("_pos").collect()
    assert [r.title for r in rows] == ["Sorting, a list", None, 'Say "hi"\nthere']
    assert rows[1].category is None


def test_feed_source_rejects_whole_file(spark, tmp_dir):
    land(tmp_dir)
    entries, bad = fs.read_feeds(spark, f"{tmp_dir}/feeds")
    assert {r.feed for r in entries.collect()} == {"quality"}
    assert entries.count() == 3
    assert [os.path.basename(r._source_file) for r in bad.collect()] == ["broken.xml"]
    # parse-once form: the same result from a Parquet copy of the parsed items
    e2, bad2 = fs.read_feeds(spark, f"{tmp_dir}/feeds", work_dir=f"{tmp_dir}/work/items")
    assert sorted(map(tuple, e2.drop("pos").collect())) == sorted(map(tuple, entries.drop("pos").collect()))
    assert bad2.count() == 1


def test_pipeline_runs_are_replay_safe(spark, tmp_dir):
    land(tmp_dir)
    ws = Workspace(spark, f"{tmp_dir}/ws")
    csv = fs.read_article_csv(spark, f"{tmp_dir}/a.csv")
    entries, _ = fs.read_feeds(spark, f"{tmp_dir}/feeds")
    r1 = pl.run_source(ws, pl.GFG, csv, "r1").first()
    assert (r1.staged, r1.clean, r1.quarantined) == (3, 1, 2)
    r2 = pl.run_source(ws, pl.MEDIUM, entries, "r1").first()
    assert (r2.staged, r2.clean, r2.quarantined) == (2, 1, 1)     # in-feed duplicate removed
    again = pl.run_source(ws, pl.MEDIUM, entries, "r1").first()  # committed: no-op
    assert again.run_seq == r2.run_seq
    d = {r.article_id: r for r in pl.current_dimension(ws).collect()}
    assert set(d) == {"sorting-a-list", "https://ex.org/p/a1"}
    assert d["https://ex.org/p/a1"].title == "First article again"
    assert d["https://ex.org/p/a1"].category == "data" and d["https://ex.org/p/a1"].author == "Ann"
    # the quarantined feed row stays open (Q4); unchanged rules do not judge it again
    r3 = pl.run_source(ws, pl.MEDIUM, entries, "r2").first()
    assert r3.pending == 3 and r3.quarantined == 2 and r3.checked == 2
    q = pl.latest_quarantine(ws)
    assert q.filter(F.col("source_table") == "stg_medium_articles").count() == 2
    # reopen a loaded key: picked up again by the next run
    loaded = ws.read("ledger").filter("state = 'processed' AND source_table = 'stg_medium_articles'").select(F.col("pk_value").cast("long").alias("id"))
    pl.reopen(ws, loaded.limit(1), "stg_medium_articles", "fix1")
    r4 = pl.run_source(ws, pl.MEDIUM, entries.limit(0), "r3").first()
    assert r4.pending == 3          # 2 quarantined + 1 reopened
    assert ws.sql("SELECT count(*) AS n FROM {runs} WHERE run_seq >= :s", args={"s": 2}).first().n >= 3
    # surrogate keys stay unique across runs (ranges come from the commit log)
    stg_ids = ws.read("stg_medium_articles").select("id")
    assert stg_ids.distinct().count() == stg_ids.count() == 4
    dim_ids = pl.current_dimension(ws).select("id")
    assert dim_ids.distinct().count() == dim_ids.count() == 2
    # both sources ran under run id r1: neither replaced the other's records
    assert ws.read("runs").filter("run_id = 'r1'").count() == 2
    assert ws.read("dq_quarantine").filter("run_id = 'r1'").select("source_table").distinct().count() == 2


def test_command_line_run_and_stats(spark, tmp_dir, capsys):
    from quire.__main__ import main
    land(tmp_dir)
    ws_dir = f"{tmp_dir}/ws"
    main(["run", "--workspace", ws_dir, "--csv", f"{tmp_dir}/a.csv",
          "--feeds", f"{tmp_dir}/feeds", "--run-id", "cli"])
    main(["stats", "--workspace", ws_dir])
    out = capsys.readouterr().out
    assert "Failed columns: tags, authors" in out and "gfg_count" in out
    runs = Workspace(spark, ws_dir).read("runs").filter("run_id = 'cli'").count()
    assert runs == 2


ATOM = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title>
<entry><title type="text">Atom article here</title><link rel="self" href="https://ex.org/self"/><link href="https://ex.org/t1/"/><id>tag:t1</id><author><name>Ann</name></author><author><name>Bob</name></author><category term="data"/><published>2026-01-23T10:00:00Z</published><updated>2026-01-24T10:00:00Z</updated><summary>Hello</summary></entry>
<entry><title>No author</title><link rel="alternate" href="https://ex.org/t2/"/><id>tag:t2</id><updated>2026-01-24T10:00:00Z</updated><content type="html">Body</content></entry>
</feed>
"""
UNCLOSED = FEED.replace("</channel></rss>", "")
HTML = "<!DOCTYPE html>\n<html><body><p>502 Bad Gateway</p></body></html>\n"


def land_mixed(path):
    os.makedirs(path)
    for name, text in (("rss", FEED), ("atom", ATOM), ("unclosed", UNCLOSED), ("error", HTML), ("blank", "\n \n"), ("broken", BROKEN)):
        with open(f"{path}/{name}.xml", "w") as f:
            f.write(text)


REASONS = {"unclosed.xml": "root element not closed", "error.xml": "root element html",
           "blank.xml": "no element", "broken.xml": "records not parsed"}


def test_atom_entries_and_malformed_files(spark, tmp_dir):
    land_mixed(f"{tmp_dir}/feeds")
    for work in (None, f"{tmp_dir}/work/items"):
        entries, rejected = fs.read_feeds(spark, f"{tmp_dir}/feeds", work_dir=work)
        rows = {r.id: r for r in entries.collect()}
        assert {r.feed for r in rows.values()} == {"rss", "atom"} and entries.count() == 5
        a, b = rows["tag:t1"], rows["tag:t2"]
        assert (a.title, a.link, a.published, a.summary) == ("Atom article here", "https://ex.org/t1/", "2026-01-23T10:00:00Z", "Hello")
        assert [x.name for x in a.authors] == ["Ann", "Bob"] and [t.term for t in a.tags] == ["data"]
        assert (b.link, b.summary, b.authors, b.tags) == ("https://ex.org/t2/", "Body", None, None)
        assert {os.path.basename(r._source_file): r.reason for r in rejected.collect()} == REASONS


def test_files_of_no_bytes_are_rejected(spark, tmp_dir):
    land(tmp_dir)
    for name in ("none.xml", "_hidden.xml"):
        open(f"{tmp_dir}/feeds/{name}", "w").close()
    entries, rejected = fs.read_feeds(spark, f"{tmp_dir}/feeds")
    assert {os.path.basename(r._source_file): r.reason for r in rejected.collect()} == {"none.xml": "no element", "broken.xml": "records not parsed"}
    assert entries.count() == 3
    assert [os.path.basename(f) for f in fs.empty_files(spark, [f"{tmp_dir}/feeds/*.xml"])] == ["none.xml"]


def test_older_reopened_row_replaces_no_newer_one(spark, tmp_dir):
    land(tmp_dir)
    ws = Workspace(spark, f"{tmp_dir}/ws")
    entries, _ = fs.read_feeds(spark, f"{tmp_dir}/feeds")
    pl.run_source(ws, pl.MEDIUM, entries, "r1")
    pl.run_source(ws, pl.MEDIUM, entries.withColumn("title", F.concat("title", F.lit(" v2"))), "r2")
    first = ws.read("ledger").filter("state = 'processed' AND run_id = 'r1'").select(F.col("pk_value").cast("long").alias("id"))
    pl.reopen(ws, first, "stg_medium_articles", "fix1")
    pl.run_source(ws, pl.MEDIUM, entries.limit(0), "r3")
    assert [r.title for r in pl.current_dimension(ws).collect()] == ["First article again v2"]


def test_empty_retry_replaces_the_partition(spark, tmp_dir):
    ws = Workspace(spark, f"{tmp_dir}/ws")
    rows = spark.createDataFrame([("f.xml", "no element", 0, "r:1"), ("g.xml", "no element", 0, "r2")],
                                 "source_file string, reason string, corrupt_records long, run_id string")
    ws.write_run(rows, "rejected_files")
    ws.write_run(rows.limit(0), "rejected_files", run_id="r:1")
    assert [r.source_file for r in ws.read("rejected_files").collect()] == ["g.xml"]
    ws.write(rows, "rejected_files", "delete_rows")
    assert ws.read("rejected_files").count() == 2


def test_first_goes_by_file_and_position(spark, tmp_dir):
    from quire.operators import indicators as ind
    os.makedirs(f"{tmp_dir}/obs")
    head = "geo,TIME_PERIOD,unit,indic_cr,OBS_VALUE\n"
    row = "Aland,2020,{},{},{}\n"
    with open(f"{tmp_dir}/obs/a.csv", "w") as f:
        f.write(head + row.format(ind.UNIT_NUMBER, ind.HELD, "") + row.format(ind.UNIT_NUMBER, ind.HELD, 5))
    with open(f"{tmp_dir}/obs/b.csv", "w") as f:
        f.write(head + row.format(ind.UNIT_NUMBER, ind.HELD, 1) * 50)
    df = ind.load_and_clean(fs.read_observations_csv(spark, f"{tmp_dir}/obs"))
    assert ind.pivot_first(df, ind.UNIT_NUMBER).first().PRISONERS_NUM == 5.0


def test_feed_files_judged_by_well_formedness(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/feeds")
    good = {
        "trailing": FEED + "<!-- cached\nby </b> a plugin -->\n<!-- 0.2 s -->\n<?done now?>\n", "split": FEED.replace("</rss>", "</rss\n>"),
        "leading": FEED.replace("<rss", "<!-- <b> -->\n<rss", 1), "crlf": FEED.replace("\n", "\r\n") + "\n", "atom": ATOM + "<!--\nx\n-->",
        "gbk": FEED.replace("UTF-8", "GBK").replace("<title>t<", "<title>中文<"), "cp1252": FEED.replace("UTF-8", "windows-1252").replace("<title>t<", "<title>“x”<")}
    bad = {"amp": FEED.replace("<title>t<", "<title>a & b<"), "channel": FEED.replace("<title>t</title>", "<title>t"),
           "after": FEED + "</rss>\n", "utf16": FEED, "cut": FEED[:FEED.index("</channel>") + 4]}
    for name, text in (good | bad).items():
        with open(f"{tmp_dir}/feeds/{name}.xml", "wb") as f:
            f.write(text.encode({"utf16": "utf-16", "gbk": "gbk", "cp1252": "cp1252"}.get(name, "utf-8")))
    entries, rejected = fs.read_feeds(spark, f"{tmp_dir}/feeds")
    counts = {r.feed: r["count"] for r in entries.groupBy("feed").count().collect()}
    assert counts == {name: 2 if name == "atom" else 3 for name in good}
    reasons = {os.path.basename(r._source_file)[:-4]: r.reason for r in rejected.collect()}
    assert set(reasons) == set(bad) and reasons["utf16"] == "no element"
    errors = {os.path.basename(r._source_file)[:-4]: r.error for r in fs.feed_files(spark, f"{tmp_dir}/feeds").filter("error IS NOT NULL").collect()}
    assert set(errors) == set(bad) and reasons["cut"] == f"not well-formed: {errors['cut']}"
