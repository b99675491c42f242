"""Decontamination against a brute-force scan."""

import hashlib
import re

import pytest

from quire.llm import decontam

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, source string"


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, size=10):
    wins = {}
    for i, t in items:
        w = split(t)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + size]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (ids := wins.get(tuple(w[k:k + n]))):
                    hit |= set(range(k, k + n))
                    found |= ids
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((d, len(w), len(hit), len(found - {None}), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def key(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    long = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(1, f"Zero, {long.upper()}! thirteen", "a"), (2, None, None), (3, "", "a"), (4, "--- ...", "a"), (5, "short item", "b"),
            (5, "short item", "b"), (6, "a Short-ITEM here short\nitem", "b"), (7, "one two three four five six seven eight nine", "b"),
            (8, "ten eleven twelve", "b"), (9, "über façade x " * 5000 + long, "b"), (None, "the the the the", None), (10, long + " " + long, "c")]
    items = [(1, long), (2, "short item"), (3, None), (4, "!!"), (11, "Short item"), (2, "the the"), (None, "façade x über"), (12, "nothing like it anywhere")]
    path = str(tmp_path_factory.mktemp("decontam"))
    spark.createDataFrame(docs, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").withColumnRenamed("x", "y").write.parquet(f"{path}/benchmark.parquet")
    return path, [(d, t) for d, t, _ in docs], items


def test_against_brute_force(spark, folder):
    path, docs, items = folder
    assert key(decontam.op9_decontamination(spark, path).collect()) == key(brute(docs, items))


@pytest.mark.parametrize("options", [{"max_windows": 1}, {"max_windows": 2, "max_terms": 3}])
def test_groups_of_windows_and_full_index(spark, folder, options):
    path, docs, items = folder
    d, b = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "benchmark"))
    got = decontam.contamination(d, b, **options).collect()
    assert key((r.doc_id, r.n_words, r.n_hit) for r in got) == key(x[:3] for x in brute(docs, items))
    assert sorted(len(r["items"]) for r in got) == sorted(x[3] for x in brute(docs, items))


def test_proximity(spark):
    d = spark.createDataFrame([(1, "red x fox y quick"), (2, "quick"), (3, "red fox"), (4, "quick a b c d e red fox")], "doc_id long, text string")
    b = spark.createDataFrame([(7, "quick red fox")], "item_id long, text string")
    got = {r.doc_id: (r["items"], r.near_items) for r in decontam.contamination(d, b, slop=4).collect()}
    assert got == {1: ([], [7]), 2: ([], []), 3: ([], []), 4: ([], [])}


def test_empty_tables(spark):
    d, b = (spark.createDataFrame([], f"{k} long, text string") for k in ("doc_id", "item_id"))
    assert decontam.contamination(d, b).collect() == []
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [(r.doc_id, r.n_hit) for r in decontam.contamination(one, b).collect()] == [(1, 0)]


def test_given_tables(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert key(decontam.op9_decontamination(spark, sf_dir).collect()) == key(brute(docs, items))


def test_registered_proximity(spark, folder, tmp_path):
    from quire.llm.queries import QUERIES
    long = "one two three four five six seven eight nine ten eleven twelve".split()
    docs = [(1, " ".join(long)), (2, " ".join([*long[:6], "x", *long[6:]])), (3, " ".join([*long[:3], *long[4:8], long[3], *long[8:]])), (4, " ".join(long[:6] + ["x"] * 11 + long[6:])), (5, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, " ".join(long))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = QUERIES["op9_decontamination_near"](spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_items, r.contaminated, r.n_near_items) for r in got} == {
        1: (1, True, 1), 2: (0, False, 1), 3: (0, False, 1), 4: (0, False, 0), 5: (0, False, 0)}
    assert {r.near_items_sha256 for r in got if r.doc_id < 4} == {hashlib.sha256(b"7").hexdigest()}
    path, docs, items = folder
    near = QUERIES["op9_decontamination_near"](spark, path)
    assert key(near.drop("n_near_items", "near_items_sha256").collect()) == key(brute(docs, items))
    assert near.filter("n_near_items < n_items").count() == 0


@pytest.mark.parametrize("options", [{"max_entries": 0}, {"max_entries": 1, "max_windows": 2}])
def test_item_lists_are_joined_beyond_the_bound(spark, folder, options, monkeypatch):
    path, docs, items = folder
    shared = "a passage that every item has in it word for word here too"
    docs, items = [*docs, (20, shared), (21, shared)], [*items, *((100 + i, f"{shared} {i}") for i in range(30))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    sent = []
    searcher = decontam._searcher
    monkeypatch.setattr(decontam, "_searcher", lambda s, table, slop: sent.append(max(map(len, table.column("items").to_pylist()), default=0)) or searcher(s, table, slop))
    got = decontam.contamination(d, b, slop=4, **options).collect()
    assert max(sent) == 1
    sent.clear()
    whole = decontam.contamination(d, b, slop=4).collect()
    assert max(sent) == 30
    rows = lambda x: key((r.doc_id, r.n_words, r.n_hit, r["items"], r.near_items) for r in x)
    assert rows(got) == rows(whole) and len({r.doc_id: r["items"] for r in got}[20]) == 30
    assert key((r.doc_id, r.n_hit, len(r["items"])) for r in got) == key((x[0], x[2], x[3]) for x in brute(docs, items))
