"""Near-duplicates against all pairs, and the signatures against the exact similarity."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quire.llm import neardup, words

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def bag(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(docs, least=0.8):
    bags = [bag(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    posts = defaultdict(set)
    for i, b in enumerate(bags):
        for s in b:
            posts[s].add(i)
    for i, (_, t) in enumerate(docs):
        near = {j for s in bags[i] for j in posts[s] if j < i} if bags[i] else {j for j in range(i) if t and docs[j][1] == t}
        for j in near:
            if find(i) != find(j) and (not bags[i] or similarity(bags[i], bags[j]) >= least):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        ids[find(i)].append(d)
    rank = lambda x: (x is not None, x or 0)
    return sorted(((d, min(ids[find(i)], key=rank), len(ids[find(i)])) for i, (d, _) in enumerate(docs)), key=repr)


def found(spark, docs):
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, node int").repartition(4)
    return sorted(((r.doc_id, r.class_id, r.class_size) for r in neardup.classes(d).collect()), key=repr)


def family(rng, size, edits, n=300, start=0):
    base = [f"w{rng.randrange(5000)}" for _ in range(n)]
    out = [(start, " ".join(base))]
    for i in range(1, size):
        w = base[:]
        for _ in range(edits):
            w[rng.randrange(n)] = f"x{rng.randrange(10 ** 6)}"
        out.append((start + i, " ".join(w)))
    return out


def test_planted_families_match_all_pairs(spark):
    rng = random.Random(5)
    docs = family(rng, 60, 3) + family(rng, 30, 6, start=100) + family(rng, 20, 14, start=200) + family(rng, 2, 1, n=40, start=300)
    docs += [(400 + i, docs[0][1].upper()) for i in range(40)] + [(500 + i, "a b c") for i in range(3)] + [(600, "A-b,c"), (601, "a b c d e f")]
    # A chain: each but the ends is similar to its neighbours only.
    w = [f"c{i}" for i in range(400)]
    for i in range(12):
        docs.append((700 + i, " ".join(w)))
        for j in range(6):
            w[i * 30 + j * 5] = f"d{i}_{j}"
    assert found(spark, docs) == brute(docs)


def test_large_open_buckets_match_all_pairs(spark, monkeypatch):
    """A passage that makes up most of 150 documents, half of which are near copies of
    one or two others: large buckets of many components, split by rarest shingles."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(120)]
    docs = []
    for i in range(90):
        own = [f"o{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(25, 45))]
        docs.append((10 * i, " ".join(passage + own)))
        for j in range(i % 3):
            w = passage + own
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            docs.append((10 * i + j + 1, " ".join(w[rng.randrange(3):])))
    docs += [(2000 + i, " ".join(passage[:100 + i])) for i in range(20)]
    rows, real = [], neardup._rarest

    def rarest(buckets, *rest):
        rows.append(buckets.count())
        return real(buckets, *rest)
    monkeypatch.setattr(neardup, "_rarest", rarest)
    want = brute(docs)
    assert found(spark, docs) == want
    assert rows and rows[0] > 100 and len({c for _, c, _ in want}) > 20


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, ""), (4, "?!"), (5, "?!"), (6, "..."), (None, "one two three four five six"), (9, "One two three, four five six."), (8, "é è ü"),
            (7, "é è ü"), (10, "the same " * 20_000), (11, "the same " * 20_000 + "end"), (12, "lone text"), (12, "lone text"), (12, "other words with the same id")]
    assert found(spark, docs) == brute(docs)


def test_given_tables(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = [(r.doc_id, r.class_id, r.class_size) for r in neardup.op2_near_duplicates(spark, sf_dir).collect()]
    assert sorted(got, key=repr) == brute(docs)


def test_representatives(spark):
    docs = [(1, "a b c d e f", "x"), (2, "A b c d e f", "y"), (2, "A b c d e f", "y"), (1, "a b c d e f", "x"), (3, "", "z"), (3, "", "z"), (4, "k l m n o p", "x"), (None, None, None)]
    got = neardup.representatives(spark.createDataFrame(docs, "doc_id long, text string, node string"))
    assert got.columns == ["doc_id", "text", "node"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([docs[0], docs[4], docs[5], docs[6], docs[7]], key=repr)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.classes(none).collect() == [] and neardup.representatives(none).collect() == []


@pytest.mark.parametrize("counts", [({1: 1, 2: 3, 3: 9}, {1: 2, 2: 3, 4: 2}), ({i: 1 + i % 4 for i in range(60)}, {i: 1 + i % 3 for i in range(20, 80)}), ({1: 100}, {1: 64})])
def test_signatures_estimate_weighted_jaccard(counts):
    m = 4000
    a, b = counts
    h = words.mix(np.array([*a, *b], np.uint64) + np.uint64(99))
    row = np.array([0] * len(a) + [1] * len(b))
    sig = neardup.bag_min_hash(row, h, np.array([*a.values(), *b.values()]), 2, m)
    exact = sum(min(a.get(k, 0), b.get(k, 0)) for k in {*a, *b}) / sum(max(a.get(k, 0), b.get(k, 0)) for k in {*a, *b})
    assert abs((sig[0] == sig[1]).mean() - exact) < 4 * (exact * (1 - exact) / m) ** 0.5 + 1e-9
