"""Runs of periodic words against all stretches of all periods."""

import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import periodic


def brute(w):
    """Every stretch of every period, that of the smallest period kept."""
    found, n = {}, len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e, q) for (s, e), q in found.items())


def runs(w):
    return sorted(map(tuple, periodic.repetitions(np.array(w, np.int64)).tolist()))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=150))
def test_two_words(w):
    assert runs(w) == brute(w)


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("seed", range(40))
def test_built_sequences(seed):
    """Powers of powers, with and without flaws, side by side."""
    rng = random.Random(seed)
    w = []
    for _ in range(rng.randrange(1, 7)):
        u = [rng.randrange(rng.choice((2, 3, 40))) for _ in range(rng.randrange(1, 30))]
        for _ in range(rng.randrange(1, 3)):
            u = u * rng.randrange(1, 7) + u[:rng.randrange(len(u) + 1)]
            if rng.random() < 0.4:
                u[rng.randrange(len(u))] = rng.randrange(3)
        w += u[:400]
    assert runs(w) == brute(w)


@pytest.mark.parametrize("w", [
    [], [1], [1] * 11, [1] * 12, [1, 2] * 6, [1, 2] * 5 + [1], fibonacci(900), [0, 1] * 60 + [0] + [0, 1] * 60 + [0], ([0] * 60 + [1]) * 5,
    ([0, 1, 2] * 30 + [0]) * 4, ([0, 1] * 40 + [0, 0, 1]) * 3, [0, 0, 1] * 70 + [0, 1, 0] * 70, list(range(300)) * 2, list(range(300)) * 3 + [7] * 40])
def test_fixed_sequences(w):
    assert runs(w) == brute(w)


def test_long_repetition_is_near_linear():
    w = [*range(7)] * 150_000
    assert runs(w) == [(0, len(w), 7)]
    w = ([0] * 1000 + [1]) * 600
    assert (0, len(w), 1001) in runs(w)


SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def expected(doc_id, text, change):
    w = SPACE.findall(text or "")
    if change and doc_id is not None and w:
        h = crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    number = {x: i for i, x in enumerate(dict.fromkeys(w))}
    found = runs([number[x] for x in w]) if len(w) > 3000 else brute([number[x] for x in w])
    drop = {i for s, e, q in found for i in range(s + q, e)}
    best = max(found, key=lambda r: (r[1] - r[0], -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    s, n, q = (best[0], best[1] - best[0], best[2]) if best else (None, None, None)
    lines = "".join(f"{a},{b - a},{c}\n" for a, b, c in sorted(found, key=lambda r: (r[0], r[2])))
    return (doc_id, len(found), s, n, q, 1000 * n // q if best else None, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def test_edges(spark, tmp_path):
    rows = [(None, "a b " * 10), (1, None), (2, ""), (3, " \t\n"), (4, "x " * 30_000), (5, "É é " * 12), (5, "É é " * 12), (5, "other"), (6, "a b c " * 4 + "a\x0bb\x0cc\rd"), (7, "\x1c\x85 " * 13)]
    rows += [(100 + i, " ".join(str(j % 50) for j in range(i))) for i in range(60)]
    spark.createDataFrame([(d, t, 1, "r") for d, t in rows], "doc_id long, text string, runs int, collapsed string").write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in periodic.op11_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted((expected(d, t, True) for d, t in rows), key=repr)
    plain = periodic.periodic_runs(spark.createDataFrame([(1, "go go " * 6 + "end")], "doc_id long, text string")).first()
    assert plain.collapsed == "go end" and [tuple(r) for r in plain.runs] == [(0, 12, 1)]


def test_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_given_tables(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in periodic.op11_periodic_runs(spark, sf_dir).collect()]
    assert sorted(got) == sorted(expected(r.doc_id, r.text, True) for r in rows)
