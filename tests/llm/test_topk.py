"""Exact top-k against brute force."""

import numpy as np

from quire.llm import topk


def brute(rows, k=5):
    out = []
    good = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for i, q in sorted({(i, tuple(v)) for i, v in good if i % 50 == 0}):
        best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in good if j != i and len(v) == len(q))[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


def run(spark, rows, **options):
    d = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int").repartition(5)
    v = topk.whole_numbers(d)
    return sorted(map(tuple, topk.top_k(v, v.filter("vec_id % 50 = 0"), **options).collect()))


def vectors(n, dims=16, seed=3):
    x = np.random.default_rng(seed).normal(size=(n, dims)).astype(np.float32)
    return [(i, r.tolist()) for i, r in enumerate(x / np.linalg.norm(x, axis=1, keepdims=True))]


def test_against_brute_force_in_shards_and_blocks(spark):
    rows = vectors(700)
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, shard=90, block=4) == brute(rows)


def test_ties_and_edges(spark):
    same = [1.0, -0.5, 0.25]
    rows = [(i, same) for i in range(300)] + [(400, [0.0, 0.0, 0.0]), (401, None), (402, [1.0, None, 2.0]), (403, [1.0, float("nan"), 2.0]), (404, [float("inf"), 0.0, 0.0]),
                                              (450, [9.0, 9.0]), (451, [1.0, 1.0]), (500, [1.0]), (None, same), (550, []), (551, []), (50, same), (7, [3.0, 3.0, 3.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, shard=64, block=1) == brute(rows)


def test_bounds_stop_early_and_keep_the_result():
    rng = np.random.default_rng(0)
    v = np.floor(rng.normal(size=(4000, 12)) * 100).astype(np.int64)
    v[:40] = v[0]
    ids = rng.permutation(4000)
    lists = topk.Lists(v, ids)
    for q in (v[0], v[50], -v[3], np.zeros(12, np.int64)):
        got = lists.search(q, int(ids[1]))
        score = v @ q
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[1]][:5]
        assert got[0].tolist() == ids[order].tolist() and got[1].tolist() == score[order].tolist()


def test_given_tables_and_empty_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = sorted(map(tuple, topk.op10_top_k(spark, sf_dir).collect()))
    assert got == brute(rows)
    assert run(spark, []) == []


def test_queries_of_one_id_stay_apart(spark):
    """Two rows with the id of a query whose floors are -1 and -2."""
    rows = [(50, [-0.001, 0.5]), (50, [-0.006, 0.5])] + [(i, [i / 100, 0.1 * (i % 7)]) for i in range(11, 20)]
    v = topk.whole_numbers(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = topk.top_k(v, v.filter("vec_id % 50 = 0")).collect()
    assert len(got) == 10 and sorted(r["rank"] for r in got) == sorted([1, 2, 3, 4, 5] * 2)
    want = []
    for q in ([-1, 128], [-2, 128]):
        scored = sorted((-sum(a * int(b * 256 // 1) for a, b in zip(q, x, strict=True)), i) for i, x in rows if i != 50)
        want += [(i, -s) for s, i in scored[:5]]
    assert sorted((r.vec_id, r.score) for r in got) == sorted(want)
