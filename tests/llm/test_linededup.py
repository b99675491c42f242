"""Line dedup against a brute-force version."""

import hashlib
from collections import Counter, defaultdict

import pytest

from quire.llm import linededup

SPACE = " \t\n\x0b\x0c\r"


def brute(docs):
    lower = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            k = lower(line.strip(SPACE))
            if len(k) >= 40:
                holders[k].add(i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        stay = []
        for line in lines:
            ids = holders.get(lower(line.strip(SPACE)), ())
            if len(ids) < 5 or i == max(ids, key=lambda x: -1 if x is None else x):
                stay.append(line)
        out.append((i, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return out


LINE = "This line stands in many of the documents here, and is long enough."
EXACT = "é" * 39 + "Z"
DOCS = ([(i, f"own {i}\n{LINE}\n  {LINE.upper()}\t\nend") for i in range(8)] + [(i, EXACT + "\n" + EXACT[:-1]) for i in range(20, 25)]
        + [(i, f" {LINE} four only {i // 4}") for i in range(40, 44)] + [(50, None), (51, ""), (52, "\n\n"), (3, LINE), (3, LINE), (None, LINE + "\r\nx")]
        + [(60 + i, ("the same very long line of text " * 3000) + "\n" + "z" * 40) for i in range(6)])


@pytest.mark.parametrize("options", [{}, {"max_keys": 0}, {"max_bits": 1}])
def test_against_brute_force(spark, options):
    d = spark.createDataFrame([(i, t, "y") for i, t in DOCS], "doc_id long, text string, lost string").repartition(5)
    got = [(r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in linededup.dedup(d, **options).collect()]
    assert sorted(got, key=repr) == sorted(brute(DOCS), key=repr)


def test_given_tables(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, linededup.op6_line_dedup(spark, sf_dir).collect())) == sorted(brute(docs))


def test_filter_has_no_false_negatives_and_suspects_little(spark):
    rows = [(i, "\n".join(f"line {j} of document {i if j % 10 else 0}, as long as it has to be" for j in range(40))) for i in range(200)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = linededup.suspects(d, *linededup.filter_size(d)).groupBy("key").count().collect()
    assert sum(r["count"] == 200 for r in got) == 4 and len(got) < 4 + 0.2 * 200 * 36


def test_small_filters_in_hash_ranges_suspect_as_little(spark):
    """Text for nine times the filters' size: each range has its own pair, and the result is the same."""
    rows = [(i, "\n".join([f"line {j} of document {i}, one of very many that differ, and made one hundred letters long with this" for j in range(95)] + [LINE] * (i < 7)))
            for i in range(2000)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    bits, ranges = linededup.filter_size(d, 1)
    assert bits == linededup.PIECE_BITS and ranges >= 8
    got = linededup.suspects(d, bits, ranges).collect()
    assert sum(n >= 7 for n in Counter(r.key for r in got).values()) == 1
    assert len(got) < 0.05 * 95 * 2000
    out = [(r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in linededup.dedup(d, max_bits=1).collect()]
    assert sorted(out) == sorted(brute(rows))


def test_empty_table(spark):
    assert linededup.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []
