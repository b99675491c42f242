"""SimHash components against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from quire.llm import simhash
from quire.llm.neardup import components


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), seed=42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def all_pairs(fps):
    """The least fingerprint of each one's component."""
    fps = sorted({*fps})
    a = np.array(fps, np.int64).view(np.uint64)
    root = list(range(len(a)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= 2):
            x, y = find(i), find(i + 1 + int(j))
            root[max(x, y)] = min(x, y)
    return {fps[i]: fps[find(i)] for i in range(len(a))}


def found(spark, fps):
    d = spark.createDataFrame([(x,) for x in sorted({*fps})], "fp long").repartition(4)
    of = {r.node: r.component for r in components(simhash.links(d, d.count())).collect()}
    return {x: of.get(x, x) for x in fps}


def cluster(rng, size, flips):
    base = rng.getrandbits(64)
    return [signed(base ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(flips + 1))})) for _ in range(size)]


@pytest.mark.parametrize("most", [64, 3])
def test_clusters_match_all_pairs(spark, monkeypatch, most):
    """Lone fingerprints, small and dense clusters, chains, a frequent part."""
    monkeypatch.setattr(simhash, "MOST", most)
    rng = random.Random(most)
    fps = [signed(rng.getrandbits(64)) for _ in range(400)] + cluster(rng, 400, 3) + cluster(rng, 150, 6)
    for _ in range(40):
        fps += cluster(rng, 4, 3)
    x = rng.getrandbits(64)
    for _ in range(60):
        x ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
        fps.append(signed(x))
    half = rng.getrandbits(32) << 32
    fps += [signed(half | rng.getrandbits(32)) for _ in range(300)] + [0, 1, 3, 7, -1, signed(1 << 63)]
    assert found(spark, fps) == all_pairs(fps)


def test_groups_hold_correlated_bits(spark):
    rng = np.random.default_rng(1)
    twin = rng.integers(0, 2, (3000, 32), dtype=np.uint8)
    bits = np.concatenate([twin, twin ^ (rng.random((3000, 32)) < 0.02)], 1).astype(np.uint8)
    fp = np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel()
    corr = simhash.correlation(spark.createDataFrame([(int(x),) for x in fp], "fp long"))
    for m in (2, 3, 4):
        groups = simhash.grouped(corr, m)
        assert sorted(b for g in groups for b in g) == list(range(64)) and max(map(len, groups)) - min(map(len, groups)) <= 1
        assert sum(((b + 32) % 64 in g) for g in groups for b in g) >= 60


def test_group_count_takes_the_cheaper():
    assert [simhash.group_count(n) for n in (1, 1000, 300_000, 10 ** 7, 10 ** 9, 10 ** 11)] == [4, 4, 3, 3, 2, 2]


def test_thresholds_leave_frequent_groups_out():
    often = np.array([[False] * 3, [True, False, False], [True, True, False], [True] * 3])
    t, cost = simhash.thresholds(np.zeros((4, 3, 3)), often, [22, 21, 21])
    assert t.tolist()[0] == [0, 0, 0] and t.tolist()[1][0] == -1 and sorted(t.tolist()[1]) == [-1, 0, 1] and t.tolist()[2] == [-1, -1, 2]
    assert (t[:3] + 1).sum(1).tolist() == [3, 3, 3] and cost[3] > 1e17
    uneven = np.zeros((1, 3, 3))
    uneven[0, 1] = [500, 900, 1000]
    t, _ = simhash.thresholds(uneven, often[:1], [22, 21, 21])
    assert t.tolist() == [[0, -1, 1]]


def expected(rows):
    fps = {t: signed(plain_fingerprint(t)) for _, t in rows}
    of = all_pairs(fps.values())
    least = {}
    for d, t in rows:
        c = of[fps[t]]
        least[c] = d if least.get(c) is None else least[c] if d is None else min(d, least[c])
    return sorted(((d, f"{fps[t] & (1 << 64) - 1:016x}", least[of[fps[t]]]) for d, t in rows), key=repr)


def test_edges(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "One two"), (4, "one TWO"), (4, "one TWO"), (4, "É two three"), (5, "é two three"), (None, "alone here with these words"),
            (6, "w " * 90_000), (7, "w " * 90_000 + "end"), (8, "a\x0bb c\x1cd"), (9, "lorem ipsum dolor sit amet " * 40), (10, "lorem ipsum dolor sit amet " * 41)]
    spark.createDataFrame([(d, t, 1, "c") for d, t in rows], "doc_id long, text string, fp int, component string").write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(map(tuple, simhash.op13_simhash(spark, str(tmp_path)).collect()), key=repr) == expected(rows)


def test_empty_table(spark):
    assert simhash.simhash_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_given_tables(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, simhash.op13_simhash(spark, sf_dir).collect()), key=repr) == expected(rows)
