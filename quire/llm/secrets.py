"""Secret scan over whole texts, with DataFrame functions only.

Patterns give the base spans.  The method adds spans by entropy: over each
candidate string a window slides by one character, and the counts of its
characters, with the sum of c*log2(c), are kept up by one entry in and one
out.  Windows whose Shannon entropy reaches the class's threshold are joined
to spans, unless the candidate is on the allow-list, the window touches a
published part, or a base span holds it.
Everything is computed inside the document's own row: there is no shuffle,
and no group to be skewed.

Null texts count as empty and have no spans.  Equal rows give equal results,
row by row; columns beyond doc_id and text are ignored.  Spans are in code
points, end exclusive."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns of the base spans: kind, pattern, least length of the match or of group 2.
ASSIGN = r"""(?i:(?=[psta])(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

#: Character classes of the entropy scan: kind, alphabet, candidates, window, threshold in bits.
CLASSES = [
    ("entropy_hex", "0123456789abcdef", r"[0-9A-Fa-f]{20,}", 20, 3.0),
    ("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", r"[A-Za-z0-9+/_=-]{24,}", 24, 4.0),
]
#: Candidates that are no secrets: words of one case, runs of one or two
#: characters, paths of plain words (no repeated group: Java's would recurse).
ALLOW = [
    r"^[A-Z]?[a-z]+$", r"^[A-Z]+$", r"^[0-9]+$", r"^(.)\1*$", r"^(..)\1+$",
    r"^[A-Za-z]*[/_=-][A-Za-z/_=-]*$",
]
#: Parts of counting sequences and published examples.  A window is no secret where it touches one, or what
#: surrounds it up to a separator or ``REACH`` characters; the rest of the candidate counts.
PUBLISHED = [r"0123456789", r"abcdefghij", r"example"]
REACH = 24
_PART = r"[^/_=-]"
KINDS = ["assign", "access", "hex", *(c[0] for c in CLASSES)]
_BLOCK = 256


def running(lengths: Column) -> Column:
    """Inclusive running sums of an int array, in blocks, so that long arrays
    cost no quadratic time."""
    def sums(a: Column) -> Column:
        return F.aggregate(a, F.array().cast("array<int>"),
                           lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x)))
    n = F.greatest(F.ceil(F.size(lengths) / F.lit(_BLOCK)).cast("int"), F.lit(1))
    blocks = F.transform(F.sequence(F.lit(0), n - 1), lambda b: sums(F.slice(lengths, b * _BLOCK + 1, _BLOCK)))

    def whole(parts: Column) -> Column:
        ends = sums(F.transform(parts, lambda p: F.coalesce(F.try_element_at(p, F.lit(-1)), F.lit(0))))
        return F.flatten(F.transform(parts, lambda p, i: F.transform(
            p, lambda x: x + F.when(i > 0, F.get(ends, i - 1)).otherwise(F.lit(0)))))
    return F.get(F.transform(F.array(blocks), whole), F.lit(0))


def found(text: Column, pattern: str) -> Column:
    """array<struct<start, s>> of the leftmost matches that do not overlap."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)

    def place(both: Column) -> Column:
        hits, gaps = both["hits"], both["gaps"]
        steps = F.transform(gaps, lambda g, i: g + F.when(i > 0, F.length(F.get(hits, i - 1))).otherwise(F.lit(0)))
        return F.get(F.transform(F.array(running(steps)), lambda starts: F.transform(
            hits, lambda h, i: F.struct(F.get(starts, i).alias("start"), h.alias("s")))), F.lit(0))
    return F.get(F.transform(F.array(F.struct(hits.alias("hits"), gaps.alias("gaps"))), place), F.lit(0))


def span(start: Column, kind: int, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(kind).alias("kind"), end.cast("int").alias("end"))


def unpublished(s: Column) -> Column:
    """The candidate with NUL in place of each character of a published part and its surroundings."""
    marked = s
    for p in PUBLISHED:
        marked = F.regexp_replace(marked, f"(?i){p}", "\0" * len(p))
    around = rf"(?<=\x00{_PART}{{0,{REACH - 1}}}){_PART}|{_PART}(?={_PART}{{0,{REACH - 1}}}\x00)"
    return F.when(s.rlike("(?i)" + "|".join(PUBLISHED)), F.regexp_replace(marked, around, "\0")).otherwise(s)


def entropy_spans(s: Column, alphabet: str, window: int, threshold: float) -> Column:
    """array<struct<a, b>>: the joined windows of a candidate whose entropy reaches the threshold.
    A window with a character beyond the alphabet is none."""
    chars = F.lower(s) if alphabet == alphabet.lower() else s
    codes = F.transform(F.split(chars, ""), lambda c: F.position(c, F.lit(alphabet)) - 1)
    weigh = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    most = window * (math.log2(window) - threshold) + 1e-9
    pair = "array<struct<a:int,b:int>>"
    begin = F.struct(
        F.array_repeat(F.lit(0), len(alphabet)).alias("n"), F.lit(0.0).alias("sum"), F.lit(0).alias("i"), F.lit(0).alias("from"),
        F.lit(-1).alias("a"), F.lit(-1).alias("b"), F.array().cast(pair).alias("out"))

    def walk(codes: Column) -> Column:
        def step(st: Column, c: Column) -> Column:
            i = st["i"]
            gone = F.when(i >= window, F.get(codes, i - window)).otherwise(F.lit(-1))
            came_n, gone_n = F.get(st["n"], c), F.when(gone >= 0, F.get(st["n"], gone)).otherwise(F.lit(0))
            change = (F.when(c >= 0, F.get(weigh, came_n + 1) - F.get(weigh, came_n)).otherwise(F.lit(0.0))
                      + F.when(gone >= 0, F.get(weigh, gone_n - 1) - F.get(weigh, gone_n)).otherwise(F.lit(0.0)))
            total = st["sum"] + F.when(gone == c, F.lit(0.0)).otherwise(change)
            n = F.transform(st["n"], lambda x, k: x + (k == c).cast("int") - (k == gone).cast("int"))
            a, b = i - (window - 1), i + 1
            first = F.when(c < 0, b).otherwise(st["from"])
            hot = (a >= first) & (total <= most)
            new = hot & (a > st["b"])
            return F.struct(
                n.alias("n"), total.alias("sum"), b.alias("i"), first.alias("from"),
                F.when(new, a).otherwise(st["a"]).alias("a"), F.when(hot, b).otherwise(st["b"]).alias("b"),
                F.when(new & (st["a"] >= 0), F.concat(st["out"], F.array(F.struct(st["a"].alias("a"), st["b"].alias("b"))))).otherwise(st["out"]).alias("out"))
        return F.aggregate(codes, begin, step, lambda st: F.when(
            st["a"] >= 0, F.concat(st["out"], F.array(F.struct(st["a"].alias("a"), st["b"].alias("b"))))).otherwise(st["out"]))
    return F.get(F.transform(F.array(codes), walk), F.lit(0))


def scan(docs: DataFrame, text: str = "text", allow: list[str] | None = None) -> DataFrame:
    """The documents with ``base`` and ``added``: array<struct<start, kind, end>>,
    kind an index into KINDS, both sorted by start and kind."""
    known = lambda s: F.coalesce(*[F.when(s.rlike(p), F.lit(True)) for p in (ALLOW if allow is None else allow)], F.lit(False))
    t = F.coalesce(F.col(text), F.lit(""))
    assign = F.transform(F.filter(found(t, ASSIGN), lambda m: F.length(F.regexp_extract(m["s"], ASSIGN, 2)) >= ASSIGN_LEAST),
                         lambda m: span(m["start"], 0, m["start"] + F.length(m["s"])))
    plain = lambda p, k: F.transform(found(t, p), lambda m: span(m["start"], k, m["start"] + F.length(m["s"])))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    access = F.when(t.contains("AKIA"), plain(ACCESS, 1)).otherwise(none)
    more = []
    for k, (_, alphabet, pattern, window, threshold) in enumerate(CLASSES, 3):
        cands = F.filter(found(t, pattern), lambda m: ~known(m["s"]))
        more.append(F.flatten(F.transform(cands, lambda m: F.transform(  # noqa: B023 -- called at once
            entropy_spans(unpublished(m["s"]) if allow is None else m["s"], alphabet, window, threshold), lambda e: span(m["start"] + e["a"], k, m["start"] + e["b"])))))
    out = docs.withColumn("base", F.array_sort(F.concat(assign, access, plain(HEX, 2)))).withColumn("added", F.concat(*more))
    fresh = F.filter("added", lambda x: ~F.exists("base", lambda b: (b["start"] <= x["start"]) & (x["end"] <= b["end"])))
    return out.withColumn("added", F.array_sort(fresh))


def written(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    s = scan(docs)
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return s.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                    F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                    written(F.array_sort(F.concat("base", "added"))).alias("spans"))
