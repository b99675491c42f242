"""Toxicity by a weighted lexicon.

Texts are folded (lower case, homoglyphs, digits and signs that stand for
letters inside words), and the lexicon's patterns are found with one
Aho-Corasick automaton.  A pattern is a whole word or the beginning of words.
Hits inside an exception phrase do not count.  The hits' weights, as they are
and for each hundred words, give a score between 0 and 1.

The lexicon and the score's two slopes are learned from a bounded sample of
labelled documents (``SAMPLE``, by a hash of doc_id), whose words Spark
counts; scoring reads every text whole.  A label, lang, source or doc_id is
never an input of a score.

Null texts count as empty; an empty text gets the score of a text without
hits.  Rows with a null label or doc_id, or held out, teach nothing; without
any toxic label nothing is toxic.  Repeated rows are scored each; further
columns are ignored by the score; an empty table gives an empty result."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import chunks
from .work import mapped, stored

#: Labelled documents that are learned from, at most.
SAMPLE = 12_000
#: Documents held out of learning: crc32 of the id as text, modulo.
FOLDS = 5
#: Entries of the lexicon at most; least toxic documents of an entry; least share of toxic ones; lengths of word beginnings.
MOST_ENTRIES = 2_000
LEAST_DOCS = 4
LEAST_SHARE = 0.8
STEMS = range(4, 9)
#: Signs that stand for letters, and letters of other scripts that look like Latin ones (fixed values).
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ɑ": "a", "ı": "i", "ɡ": "g", "ℓ": "l",
}
#: Phrases in which a word of the lexicon does no harm.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "take out the trash", "class clown", "clown fish", "circus clown", "pond scum", "sore loser")

_TABLE = {ord(k): v for k, v in HOMOGLYPHS.items()}
_TABLE.update({0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)} | {0x200B: "", 0x200C: "", 0x200D: "", 0xAD: ""})
_SIGNED = re.compile(r"(?<![^\W_])[0134578@$]{1,2}(?=[^\W\d_])|(?<=[^\W\d_])[0134578@$]{1,3}(?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """The text as it is matched."""
    t = text.lower()
    try:
        t.encode("latin-1")
        if "\xad" in t:
            t = t.replace("\xad", "")
    except UnicodeEncodeError:
        t = t.translate(_TABLE)
    return _SIGNED.sub(lambda m: "".join(SIGNS[c] for c in m.group()), t)


class Lexicon(NamedTuple):
    """Patterns with their weights (a beginning of words ends in *), exception phrases, and the score's coefficients."""
    weights: dict
    exceptions: tuple
    coef: tuple = (-4.0, 0.0, 0.0)


def automaton(lexicon: Lexicon):
    import ahocorasick
    # A word, a beginning and an exception phrase of the same letters share a key.
    entries: dict[str, list] = {}
    for p, w in lexicon.weights.items():
        entries.setdefault(p.rstrip("*"), []).append((p, w))
    for p in lexicon.exceptions:
        entries.setdefault(p, []).append((None, 0.0))
    a = ahocorasick.Automaton()
    for key, of in entries.items():
        a.add_word(key, (len(key), of))
    if len(a):
        a.make_automaton()
    return a


def features(text: str, a) -> tuple[float, float]:
    """Sum of the weights of the hits, alone and for each hundred words, both as log1p."""
    if not text or not len(a):
        return 0.0, 0.0
    t = fold(text)
    hits, free = [], []
    for end, (size, entries) in a.iter(t):
        start, end = end - size + 1, end + 1
        if start and t[start - 1].isalnum():
            continue
        for p, w in entries:
            if p is None:
                free.append((start, end))
            elif p.endswith("*") or end == len(t) or not t[end].isalnum():
                hits.append((start, end, w))
    if not hits:
        return 0.0, 0.0
    if free:
        # By start, with the farthest end so far: the phrase that reaches farthest over a hit decides.
        free.sort()
        starts, reach = [s for s, _ in free], list(accumulate((e for _, e in free), max))
        hits = [h for h in hits if not ((k := bisect_right(starts, h[0])) and reach[k - 1] >= h[1])]
    # Of the patterns that match at one place the heaviest counts.
    best: dict[int, float] = {}
    for s, _, w in hits:
        best[s] = max(w, best.get(s, 0.0))
    total = sum(best.values())
    words = 1 + t.count(" ") + t.count("\n")
    return math.log1p(total), math.log1p(100 * total / words)


def _terms(text: str) -> set[str]:
    words = set(_WORD.findall(fold(text)))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


def _counts(sample: DataFrame) -> DataFrame:
    """(term, toxic, clean): in how many of the sample's documents of either kind a term is."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            both = Counter(), Counter()
            for t, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                both[y].update(_terms(t or ""))
            terms = list(both[0].keys() | both[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array([both[1][t] for t in terms], pa.int64()), pa.array([both[0][t] for t in terms], pa.int64())],
                ["term", "toxic", "clean"])
    each = mapped(sample, count, "term string, toxic long, clean long")
    return each.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def held_out(doc_id):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)) == 0


def labelled(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(text, toxic) of the documents that are learned from: of the rows that
    share a doc_id the one whose text has the least hash, so that there are
    at most ``most`` rows."""
    ids = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    # At most ``most`` rows of two numbers.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
    # Summed before the shuffle: a task sends one text for each id.
    return (rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text"), F.col("toxic"))).alias("least"))
            .select("least.text", "least.toxic"))


def learn(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Lexicon:
    sample = stored(labelled(docs, labels, most), "labelled")
    n = {r.toxic: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(1):
        return Lexicon({}, EXCEPTIONS)
    weight = F.log((F.col("toxic") + 0.5) / F.lit(n[1] + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(n.get(0, 0) + 1.0))
    rows = (_counts(sample).filter((F.col("toxic") >= LEAST_DOCS) & (F.col("toxic") >= LEAST_SHARE * (F.col("toxic") + F.col("clean"))))
            .withColumn("weight", weight).filter(F.col("weight") > 1)
            .orderBy((F.col("weight") * F.sqrt("toxic")).desc(), F.length("term"), "term").limit(20 * MOST_ENTRIES).collect())
    found = {r.term: r for r in rows}
    weights = {}
    # A beginning gives way to a longer pattern that finds nearly as much.
    covered = Counter()
    for r in rows:
        word = r.term.rstrip("*")
        for k in STEMS:
            if (stem := word[:k] + "*") != r.term and len(word) >= k:
                covered[stem] = max(covered[stem], r.toxic)
    rows = [r for r in rows if not r.term.endswith("*") or covered[r.term] < 0.95 * r.toxic]
    # A longer pattern is left out where a shorter one holds all it finds.
    for r in sorted(rows, key=lambda r: (len(r.term.rstrip("*")), not r.term.endswith("*"), r.term)):
        stems = [s for k in STEMS if (s := r.term.rstrip("*")[:k] + "*") in weights and s != r.term]
        if not stems or r.weight > max(found[s].weight for s in stems) + 1.0:
            weights[r.term] = float(r.weight)
    top = sorted(weights, key=lambda t: (-found[t].weight * math.sqrt(found[t].toxic), t))[:MOST_ENTRIES]
    lexicon = Lexicon({t: weights[t] for t in top}, EXCEPTIONS)
    x = np.array([[r.x0, r.x1, r.y] for r in _sample_features(sample, lexicon).collect()])
    return lexicon._replace(coef=_fit(x[:, :2], x[:, 2]))


def _sample_features(sample: DataFrame, lexicon: Lexicon) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(lexicon)
        for b in chunks(batches):
            x = [features(t or "", a) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v[0] for v in x], pa.float64()), pa.array([v[1] for v in x], pa.float64()), b.column("toxic").cast(pa.float64())], ["x0", "x1", "y"])
    return mapped(sample, each, "x0 double, x1 double, y double")


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 25) -> tuple:
    """Logistic regression by Newton's method, with a small ridge."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = np.clip(w + np.linalg.solve(h, x.T @ (y - p) - ridge * w), -50, 50)
    return tuple(float(v) for v in w)


def score(docs: DataFrame, lexicon: Lexicon, into: str = "toxicity") -> DataFrame:
    """The documents (all columns but one of the score's name) with ``into``, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    fields = [f for f in docs.schema.fields if f.name != into]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, (c0, c1, c2) = automaton(shared.value), shared.value.coef
        for b in chunks(batches):
            x = [features(t or "", a) for t in b.column("text").to_pylist()]
            s = [1 / (1 + math.exp(-max(-60.0, min(60.0, c0 + c1 * u + c2 * v)))) for u, v in x]
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in fields), pa.array(s, pa.float64())], [*(f.name for f in fields), into])
    from pyspark.sql import types as T
    return mapped(docs.select(*[docs[f"`{f.name}`"] for f in fields]), each, T.StructType([*fields, T.StructField(into, T.DoubleType())]))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text")
    scored = score(docs, learn(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"),
                         (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
