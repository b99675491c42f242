"""The prefix trie against one built in Python, in one shard and in many."""

import hashlib
import random
from collections import defaultdict
from zlib import crc32

import pyarrow as pa
import pytest

from quire.llm import prefixtrie


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            own[c].append((turn is not None, turn or 0, role or "", said, text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(x)] for c, x in own.items()}
    members, ends, kids = defaultdict(set), defaultdict(list), defaultdict(set)
    for c in sorted(own):
        h = crc32(str(c).encode()) % 6
        base = abs(c) // 100 * 100 * (1 if c >= 0 else -1)
        said = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(said) + 1):
            members[said[:d]].add(c)
            if d:
                kids[said[:d - 1]].add(said[:d])
        ends[said].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, ())), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, ends.get(p, ()))).encode()).hexdigest()) for p, m in members.items()), key=repr)


def found(spark, rows, extra=False, most=prefixtrie.CONVERSATIONS):
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    if extra:
        d = d.selectExpr("*", "1 AS base", "'s' AS said", "2 AS shard", "3 AS a")
    return sorted((tuple(r) for r in prefixtrie.prefix_trie(d, most).collect()), key=repr)


def talk(rng, ids, words):
    """Conversations that share beginnings, whole conversations and single turns."""
    rows = []
    for c in ids:
        n = rng.randrange(0, 9)
        rows += [(c, t, rng.choice(("user", "assistant")) if t % 3 else "user", rng.choice(words)) for t in range(n)]
    return rows


@pytest.mark.parametrize("most", [4096, 100, 1])
def test_shards_match_one_trie(spark, most):
    rng = random.Random(most)
    rows = talk(rng, range(0, 1500), ["hi", "ok", "é" * 7]) + talk(rng, range(5000, 9000, 7), [f"t{i}" for i in range(4)])
    for c in range(20_000, 20_300):
        rows += [(c, t, "user", f"same {t}") for t in range(8)]
    assert found(spark, rows, most=most) == brute(rows)


def test_shards_are_cut_at_blocks():
    ids = [c for c in range(500) for _ in range(2)]
    batch = pa.record_batch([pa.array([c - c % 100 for c in ids]), pa.array(ids), pa.array([b"x"] * 1000), pa.array([1] * 1000)], ["base", "conv_id", "said", "chars"])
    got = list(prefixtrie._shards(iter([batch.slice(0, 333), batch.slice(333)]), 50))
    assert [[c for c, _ in s] for s in got] == [list(range(k, k + 100)) for k in range(0, 500, 100)]


def test_edges(spark):
    rows = [(-205, 1, "user", "a"), (-200, 1, "user", "b"), (-3, None, None, None), (-3, None, None, None), (-3, 0, "user", None), (0, 1, "user", "a"), (7, 1, "user", "long " * 50_000),
            (7, 1, "user", "tie"), (7, 1, "assistant", "tie"), (None, 1, "user", "a"), (None, None, None, None), (150, 3, "x", "y"), (199, 3, "x", "y"), (9_000_000_000_000, 1, "user", "a")]
    assert found(spark, rows, extra=True) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "a")]) == []


def test_long_conversations(spark):
    rows = [(c, t, "user", f"t{t}") for c in (1, 2, 101) for t in range(4000)] + [(102, t, "user", f"t{t % 3999}") for t in range(4100)]
    got = found(spark, rows)
    assert len(got) == len(brute_nodes(rows)) and max(r[1] for r in got) == 4100


def brute_nodes(rows):
    nodes = set()
    own = defaultdict(list)
    for c, _, _, text in rows:
        own[c].append(text)
    for c, said in own.items():
        h = crc32(str(c).encode()) % 6
        said = own.get(c - c % 100, [])[:h] + said[h:]
        key = b""
        nodes.add(key)
        for s in said:
            key = hashlib.sha256(key + s.encode()).digest()
            nodes.add(key)
    return nodes


def test_given_tables(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in prefixtrie.op12_prefix_trie(spark, sf_dir).collect()), key=repr) == brute(rows)
