"""Toxicity: held-out accuracy, folding, exceptions and edges."""

import math
import zlib

import pytest

from quire.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    import os
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    rows = toxicity.op5_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    both = sum(r.predicted and r.toxic for r in rows)
    assert both / sum(r.toxic for r in rows) > 0.88 and both / sum(r.predicted for r in rows) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


LEXICON = toxicity.Lexicon({"idiot": 5.0, "trash": 5.0, "scum*": 5.0}, ("trash can",), (-4.0, 2.0, 1.0))


@pytest.mark.parametrize("text,hit", [
    ("you idiot!", True), ("IDIOT", True), ("1d10t", True), ("an id1ot$$$", True), ("іdiоt", True), ("ｉｄｉｏｔ", True), ("idi​ot —", True), ("idiotic", False), ("xidiot", False),
    ("scumbag", True), ("escum", False), ("the trash can is full", False), ("trash can and trash", True), ("", False), (None, False), ("1234 500 $5", False), ("tr@sh", True),
])
def test_matching(text, hit):
    assert (toxicity.features(text, toxicity.automaton(LEXICON))[0] > 0) == hit


def tables(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id long, text string, toxicity string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learning_leaves_out_the_fold_and_bad_rows(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    docs = [(i, f"some words here {'nasty' if i % 4 == 0 else 'fine'} thing {i}", None) for i in range(400)] + [(None, "nasty", None), (3, None, "x")]
    d, labels = tables(spark, docs, [(i, 1, int(i % 4 == 0)) for i in ids] + [(None, 1, 1), (1, 1, None)])
    lexicon = toxicity.learn(d, labels)
    assert set(lexicon.weights) == {"nasty"}
    d2, wrong = tables(spark, docs, [(i, 1, int(i % 4 == 0 if i in ids else i % 4 != 0)) for i in range(400)])
    assert toxicity.learn(d2, wrong).weights == lexicon.weights
    got = toxicity.score(d, lexicon).collect()
    assert len(got) == len(docs) and all((r.toxicity >= 0.5) == ("nasty" in (r.text or "")) for r in got)
    assert toxicity.score(d, lexicon, "__s").columns == ["doc_id", "text", "toxicity", "__s"]


def test_no_labels_and_empty_table(spark):
    d, labels = tables(spark, [(1, "a", None), (2, "", None)], [])
    lexicon = toxicity.learn(d, labels)
    assert all(0 <= r.toxicity < 0.5 for r in toxicity.score(d, lexicon).collect())
    assert toxicity.score(d.limit(0), lexicon).collect() == []


@pytest.mark.parametrize("order", [("idiot", "idiot*"), ("idiot*", "idiot")])
def test_word_and_beginning_of_the_same_letters(order):
    weights = {"idiot": 5.0, "idiot*": 2.0}
    a = toxicity.automaton(toxicity.Lexicon({p: weights[p] for p in order}, ()))
    assert [toxicity.features(t, a)[0] for t in ("you idiot!", "idiotic")] == [pytest.approx(math.log1p(w)) for w in (5.0, 2.0)]


def test_sample_has_one_row_for_each_id(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    docs = [(i, f"text {i}", None) for i in ids] + [(ids[0], f"copy {k % 7}", None) for k in range(500)] + [(ids[0], None, None)]
    d, labels = tables(spark, docs, [(i, 1, i % 2) for i in ids])
    got = toxicity.labelled(d, labels).collect()
    assert len(got) == len(ids) and sorted(map(tuple, got), key=repr) == sorted(map(tuple, toxicity.labelled(d.repartition(3, "text"), labels).collect()), key=repr)
    assert len(toxicity.labelled(d, labels, 5).collect()) == 5


def test_exceptions_take_linear_time():
    import time
    lexicon = toxicity.Lexicon({"trash": 2.0, "can": 1.0}, ("trash can", "trash can lid"))
    a = toxicity.automaton(lexicon)
    assert toxicity.features("trash can trash", a) == toxicity.features("x x trash", a)
    assert toxicity.features("trash can lid", a) == (0.0, 0.0)
    start = time.time()
    assert toxicity.features("trash can " * 100_000, a) == (0.0, 0.0)
    assert time.time() - start < 20
