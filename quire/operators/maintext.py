"""T1 in the JVM: tags and text by regular expressions, elements matched by a
fold over the tags that carries the stack of open elements.

The tokens known here are the plain ones: start and end tags with quoted or
simple attributes, comments, a doctype, and script, style and title elements
before the body.  ``needs_parser`` tells the pages that hold anything else
(stray '<', scripts inside the body, rare character references, ...); only
those go to the HTML parser, which gives the same text."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.scalars import let

#: Elements without content, and the character references decoded here.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
REFERENCES = ["lt", "gt", "quot", "apos", "nbsp", "copy", "reg", "trade", "middot", "bull", "hellip", "ndash", "mdash",
              "lsquo", "rsquo", "ldquo", "rdquo", "laquo", "raquo", "euro", "pound", "sect", "deg", "times"]
#: Tags of a page up to which they are folded: the stack is copied at each.
MAX_TAGS = 20_000

_S = r"[ \t\n\r\f]"
_NAME = r"[a-zA-Z][a-zA-Z0-9:-]*+"
_ATTR = rf"""{_S}++[a-zA-Z_:@][a-zA-Z0-9_:.-]*+(?:="[^"<>]*+"|='[^'<>]*+'|=[^\s"'<>=`/]++)?+"""
_RAW = rf"<(?:script|style|title)(?:{_ATTR})*+{_S}*+>(?s:.*?)</(?:script|style|title){_S}*+>"
_TAG = rf"(?i)<!--(?s:.*?)-->|{_RAW}|<!doctype[^<>]*+>|</{_NAME}{_S}*+>|<{_NAME}(?:{_ATTR})*+{_S}*+/?+>"
_IS_RAW = r"(?i)^<(?:script|style|title)\b"
_STRIP = r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$"
_AMP, _JOINT = "\x01", "\x02"


def _ends(name: str) -> str:
    """A reference's end: the semicolon, which some may lack."""
    return r"(?:;|(?![a-zA-Z0-9;]))" if name in html5 else ";"


#: Decimal references of characters that stand for themselves, without '#' and '&'.
_DECIMAL = r"&#0*(?:3[2-4679]|[4-9][0-9]|1[01][0-9]|12[0-6]|1[6-9][0-9]|[2-9][0-9]{2}|[1-9][0-9]{3}|[1-4][0-9]{4});"
_KNOWN = "&(?:" + "|".join([f"{n}{_ends(n)}" for n in ["amp", *REFERENCES]] + [_DECIMAL[1:]]) + ")"


def needs_parser(html: Column, selectors: list[str]) -> Column:
    """Whether a page holds anything that the plain tokens don't cover."""
    odd = "|".join([
        r"<!--(?:-?>)", r"--(?:!|\s+)>",                                     # comments that end in other ways
        r"<(?i:textarea|iframe|noembed|noframes|xmp|noscript|plaintext|svg|math)\b",
        rf"</(?i:script|style|title){_S}++[^>\s]",
        rf"[\x00{_AMP}{_JOINT}\r]", r"&#[xX]",
    ])
    # Attributes that are given twice, hold a reference, or lie in another's value; only where a value that is looked for occurs.
    attributes = "|".join([
        r"""(?i)\s(?:class|data-testid)=(?:"[^"<>]*&|'[^'<>]*&|[^\s"'<>]*&)""",
        r"(?i)<[^<>]*\sclass\b[^<>]*\sclass\b", r"(?i)<[^<>]*\sdata-testid\b[^<>]*\sdata-testid\b",
        r"""(?i)<[^<>]*=(?:"[^"<>]*\s(?:class|data-testid)=|'[^'<>]*\s(?:class|data-testid)=)""",
    ])
    values = [x[1:] if x[0] == "." else x[1:-1].partition("=")[2].strip("'\"") for x in selectors if x[0] in ".["]
    names = [x for x in selectors if x[0] not in ".["]
    some_value = html.contains("&#")
    for v in values:
        some_value = some_value | html.contains(v)
    body = F.regexp_instr(html, F.lit(r"<(?i:body)[ \t\n\r\f>]"))
    before = F.substring(html, F.lit(1), body - 1)
    early = before.rlike("<(?i:" + "|".join(names) + r")\b")
    for v in values:
        early = early | before.contains(v)
    odd_tags = lambda tags: (F.size(tags) > MAX_TAGS) | F.exists(
        tags, lambda t: t.rlike(_IS_RAW) & (F.regexp_count(t, F.lit(r"<!--|</?(?i:script|style|title)")) > 2))
    left = let(F.regexp_replace(html, _TAG, _JOINT), lambda bare: F.when(F.instr(bare, "&") > 0, F.regexp_replace(bare, _KNOWN, "")).otherwise(bare))
    return F.coalesce(
        html.rlike(odd) | (F.regexp_count(html, F.lit(r"<(?i:body)[ \t\n\r\f/>]")) != 1) | left.rlike(r"<|&[a-zA-Z#]")
        | F.substring(html, body, F.length(html)).rlike(r"<(?i:script|style|title)\b") | early
        | (some_value & html.rlike(attributes)) | let(F.regexp_extract_all(html, F.lit(_TAG), F.lit(0)), odd_tags), F.lit(False))


def _decoded(text: Column) -> Column:
    """Character references as characters: the named ones first, the longer
    of two before the shorter, '&amp;' by way of a mark."""
    named = F.create_map(*[F.lit(x) for n in REFERENCES for x in (n, html5[f"{n};"])], F.lit("amp"), F.lit(_AMP))
    # A code point's four bytes, read as UTF-32.
    code = lambda r: F.decode(F.unhex(F.lpad(F.hex(F.regexp_extract(r, "[0-9]+", 0).cast("long")), 8, "0")), "UTF-32")
    char = lambda r: F.when(r.startswith("&#"), code(r)).otherwise(named[F.translate(r, "&;", "")])
    out = let(text, lambda t: F.aggregate(F.sort_array(F.array_distinct(F.regexp_extract_all(t, F.lit(_KNOWN), F.lit(0))), False), t,
                                          lambda s, r: F.replace(s, r, char(r))))
    return F.when(F.instr(text, "&") > 0, F.translate(out, _AMP, "&")).otherwise(text)


def _hits(tag: Column, name: Column, selectors: list[str]) -> Column:
    """Numbers of the selectors that a start tag matches (the last is the body)."""
    def attribute(a: str) -> Column:
        return F.translate(F.regexp_extract(tag, rf"""(?i)\s{a}=("[^"]*"|'[^']*'|[^\s"'<>=`/]+)""", 1), "\"'", "")
    cases = []
    for i, sel in enumerate([*selectors, "body"]):
        if sel.startswith("."):
            hit = tag.contains(sel[1:]) & F.array_contains(F.split(attribute("class"), r"\s+"), sel[1:])
        elif sel.startswith("["):
            a, _, value = sel[1:-1].partition("=")
            value = value.strip("'\"")
            hit = tag.contains(value) & (attribute(a) == value)
        else:
            hit = name == sel
        cases.append(F.when(hit, F.lit(i)))
    return F.array_compact(F.array(*cases))


def main_text(html: Column, selectors: list[str], min_chars: int) -> Column:
    """struct<raw_content, content_source> of a page of plain tokens."""
    n = len(selectors) + 1

    def token(tag: Column) -> Column:
        name = F.lower(F.regexp_extract(tag, rf"^</?({_NAME})", 1))
        closing, raw = tag.startswith("</"), tag.rlike(_IS_RAW) & ~tag.rlike("^<[^<]*>$")
        start = ~closing & (name != "") & ~raw
        return F.struct(F.when(~raw, name).otherwise("").alias("name"), closing.alias("closing"),
                        (F.endswith(tag, F.lit("/>")) | name.isin(VOID)).alias("empty"),
                        F.when(start, _hits(tag, name, selectors)).alias("hits"))

    none = F.array_repeat(F.lit(None).cast("int"), n)
    start = F.struct(F.lit(0).alias("k"), F.array().cast("array<string>").alias("open"), none.alias("at"), none.alias("depth"), none.alias("until"))

    def step(s: Column, t: Column) -> Column:
        """``k`` tags so far, names of the open elements; for each selector the
        tag that opened its element, its place on the stack, the tag that closed it."""
        k, size = s["k"], F.size(s["open"])
        new = lambda i: s["at"][i].isNull() & F.array_contains(t["hits"], i)
        spot = F.array_position(F.reverse(s["open"]), t["name"]).cast("int")
        level = F.when(t["closing"] & (spot > 0), size - spot + 1)     # the element that an end tag closes
        some = ~t["closing"] & (F.size(t["hits"]) > 0)
        numbers = F.sequence(F.lit(0), F.lit(n - 1))
        return F.struct(
            (k + 1).alias("k"),
            F.when(t["closing"], F.when(spot > 0, F.slice(s["open"], 1, size - spot)).otherwise(s["open"]))
             .when((t["name"] == "") | t["empty"], s["open"]).otherwise(F.array_append(s["open"], t["name"])).alias("open"),
            F.when(some, F.transform(numbers, lambda i: F.when(new(i), k).otherwise(s["at"][i]))).otherwise(s["at"]).alias("at"),
            F.when(some, F.transform(numbers, lambda i: F.when(new(i), size + 1).otherwise(s["depth"][i]))).otherwise(s["depth"]).alias("depth"),
            F.when(some & t["empty"], F.transform(numbers, lambda i: F.when(new(i), k).otherwise(s["until"][i])))
             .when(level.isNotNull(), F.transform(numbers, lambda i: F.when(s["until"][i].isNull() & (s["depth"][i] >= level), k).otherwise(s["until"][i])))
             .otherwise(s["until"]).alias("until"))

    def texts(parts: Column, f: Column) -> Column:
        """Each selector's text: the parts between its tags (null: no such element)."""
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(f["at"][i].isNotNull(), F.translate(_decoded(F.array_join(
            F.slice(parts, f["at"][i] + 2, F.coalesce(f["until"][i], F.size(parts) - 1) - f["at"][i]), _JOINT)), _JOINT, "")))

    def pick(found: Column) -> Column:
        out = None
        for i, sel in enumerate(selectors):
            when = F.when if out is None else out.when
            out = when(F.length(F.regexp_replace(found[i], _STRIP, "")) > min_chars, F.struct(found[i].alias("raw_content"), F.lit(sel).alias("content_source")))
        return out.otherwise(F.struct(F.coalesce(found[n - 1], F.lit("")).alias("raw_content"), F.lit("body").alias("content_source")))

    tags = F.regexp_extract_all(html, F.lit(_TAG), F.lit(0))
    folded = F.aggregate(F.transform(tags, token), start, step)
    found = let(folded, lambda f: let(F.split(html, _TAG, -1), lambda parts: texts(parts, f)))
    return F.when(html.isNotNull(), let(found, pick))
