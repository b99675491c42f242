"""Mixing against water filling in Python and a driver-side queue."""

from collections import defaultdict

import pytest

from quire.llm import mixing


def fill(size, weights=(1, 2, 3), most=3):
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [s for s in size if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(size.values())
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > most * size[s]}
        if not over:
            target.update({s: left * w[s] / total for s in open_})
            break
        for s in over:
            target[s] = most * size[s]
            left -= target[s]
        open_ -= over
    return target


def check(rows, docs):
    import re
    size = defaultdict(int)
    for _, s, t in docs:
        size[s] += len(re.findall(mixing.WORDS, t or ""))
    target, took, longest = fill(size), defaultdict(int), defaultdict(int)
    assert len(rows) == len(docs)
    source = {d: s for d, s, _ in docs}
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s], abs=1e-6)
        assert r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        took[s] += r.taken
        longest[s] = max(longest[s], r.size)
    assert sum(took.values()) <= sum(size.values())
    slack = sum(longest.values())
    for s in size:
        assert target[s] - 2 * longest[s] - 1 <= took[s] + slack * 0.5 and took[s] <= target[s] + slack
    return took, target


def test_given_tables(spark, sf_dir):
    docs = [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = mixing.op7_source_mix(spark, sf_dir).collect()
    took, target = check(rows, docs)
    again = mixing.op7_source_mix(spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_near_targets_with_many_small_documents(spark, tmp_path):
    docs = [(i, "big" if i % 3 else f"s{i % 5}", "word " * (1 + i % 7)) for i in range(6000)]
    spark.createDataFrame(docs, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    took, target = check(mixing.op7_source_mix(spark, str(tmp_path)).collect(), docs)
    for s in target:
        assert took[s] == pytest.approx(target[s], abs=20)


def test_edges(spark, tmp_path):
    docs = [(1, None, "a b c"), (2, "x", None), (3, "x", ""), (4, "y", "one"), (5, "\U0001f600", "a b"), (6, "￿", "a b c d"), (None, "y", "two three"),
            (8, "z", "w " * 50_000), (9, "empty", " \t\n")]
    spark.createDataFrame([(*d, "t") for d in docs], "doc_id long, source string, text string, target string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = mixing.op7_source_mix(spark, str(tmp_path)).collect()
    assert len(rows) == 9 and {r.doc_id: r.size for r in rows}[8] == 50_000 and {r.doc_id: r.taken for r in rows}[3] == 0
    size = {None: 3, "x": 0, "y": 3, "\U0001f600": 2, "￿": 4, "z": 50_000, "empty": 0}
    by_id = {r.doc_id: r.target for r in rows}
    target = fill(size)
    for d, s, _ in docs:
        assert by_id[d] == pytest.approx(target[s])
    mixed = mixing.mix(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    assert mixed.columns == ["doc_id", "source", "text", "target"]
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in rows)


def test_repeated_rows_and_order(spark):
    docs = spark.createDataFrame([(1, "a", "x y")] * 4 + [(2, "b", "p q r s t u v w")], "doc_id long, source string, text string")
    rows = mixing.plan(mixing.sizes(docs)).collect()
    assert len(rows) == 5 and sum(r["size"] * r.passes for r in rows) <= 16
    got = mixing.mix(docs).collect()
    assert len(got) == sum(r.passes for r in rows)


def test_empty_table_and_plan(spark, sf_dir):
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.plan(mixing.sizes(none)).collect() == [] and mixing.mix(none).collect() == []
    plan = mixing.op7_source_mix(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_of_one_id_are_spread(spark):
    from pyspark.sql import functions as F
    n = 5 * mixing.ROWS
    docs = spark.range(3 * n).select(
        F.when(F.col("id") < n, F.lit(7)).when(F.col("id") < 2 * n, F.col("id")).alias("doc_id"), F.lit("a").alias("source"),
        F.when(F.col("id") % 2 == 0, F.lit("one text")).otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    sized = mixing.sizes(docs)
    timed = mixing.finish_times(mixing.stored(sized, "test-sizes"), mixing.targets(sized))
    ranges = timed.groupBy(F.shiftright(F.shiftright("place", 32) * 15, 31)).agg(F.count(F.lit(1)).alias("n")).collect()
    assert len(ranges) == 15 and max(r.n for r in ranges) < 1.2 * mixing.ROWS
    assert timed.agg(F.countDistinct("finish"), F.max("finish"), F.count(F.lit(1))).first() == (3 * n, 6 * n, 3 * n)
    # Every row has a place of its own, equal ones too.
    assert timed.select("place").distinct().count() == 3 * n


def test_further_columns_of_any_name_stay(spark):
    names = ["uid", "__uid", "__at", "target", "size", "place", "a.b"]
    docs = spark.createDataFrame([(i, "ab"[i % 2], "x y z", *[f"{c}{i}" for c in names]) for i in range(20)],
                                 ["doc_id", "source", "text", *names])
    got = mixing.mix(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert rows and all(tuple(r)[3:] == tuple(f"{c}{r.doc_id}" for c in names) for r in rows)
    plain = mixing.mix(docs.select("doc_id", "source", "text")).collect()
    assert [r.doc_id for r in rows] == [r.doc_id for r in plain]


def test_reruns_agree_however_rows_are_dealt(spark):
    """Half of the rows have one doc_id, a third are equal."""
    rows = [(7 if i % 2 else i, f"s{i % 3}" if i % 2 else "s0", "same words here" if i % 3 else " ".join(["w"] * (1 + i % 50)) + f" {i}") for i in range(6000)]
    found = []
    for n in (1, 66):
        d = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(n)
        plan = mixing.plan(mixing.sizes(d))
        found.append(sorted((r.doc_id, r.source, r.size, r.passes) for r in plan.collect()))
    assert found[0] == found[1]
    d = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed = [sorted(map(tuple, mixing.mix(d.repartition(n)).collect())) for n in (1, 66)]
    assert mixed[0] == mixed[1]
