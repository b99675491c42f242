"""Text preparation for enrichment: main-content extraction from stored
pages (T1), whitespace cleanup (T2), minimum-length gate (T3), prompt
messages (T4) and the scorer plug point (T5).

Only T1 runs Python: HTML needs a real tokenizer (script bodies, entities,
unclosed tags), so it is an Arrow-batched ``pandas_udf`` around the standard
library's ``html.parser`` -- a small per-row helper; the rest is native.  On
request pages of plain HTML are tokenised in the JVM (``maintext``).
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quire.functions.scalars import clean_text
from quire.operators import maintext

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# Content selectors tried in order; the first whose stripped text is longer
# than 1,500 characters wins, else the whole body text is used.
CONTENT_SELECTORS = ["article", "main", ".postArticle-content", ".pw-article-body",
                     "[data-testid='post-article-content']"]
MIN_SELECTOR_CHARS = 1500
MIN_CONTENT_CHARS = 1000
PROMPT_CONTENT_CHARS = 8000
DEFAULT_USER_TEMPLATE = "Process this content:\n\n{content}"
DEFAULT_SYSTEM_PROMPT = "You analyse articles and answer in JSON."

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
         "param", "source", "track", "wbr"}


def _selector_matcher(sel: str) -> Callable[[str, dict], bool]:
    if sel.startswith("."):
        cls = sel[1:]
        return lambda tag, attrs: cls in (attrs.get("class") or "").split()
    if sel.startswith("[") and sel.endswith("]"):
        name, _, val = sel[1:-1].partition("=")
        val = val.strip("'\"")
        return lambda tag, attrs: attrs.get(name) == val
    return lambda tag, attrs: tag == sel


class _TextCollector(HTMLParser):
    """textContent of the first element matching each selector, and of body."""

    def __init__(self, selectors):
        super().__init__(convert_charrefs=True)
        self.matchers = [_selector_matcher(s) for s in selectors] + [_selector_matcher("body")]
        self.found = [None] * len(self.matchers)     # list of text parts once matched
        self.stack: list[tuple[str, list[int]]] = []  # (tag, indexes opened by it)
        self.open: set[int] = set()

    def handle_starttag(self, tag, attrs):
        d = {k: (v or "") for k, v in attrs}
        opened = []
        for i, m in enumerate(self.matchers):
            if self.found[i] is None and m(tag, d):
                self.found[i] = []
                self.open.add(i)
                opened.append(i)
        if tag not in _VOID:
            self.stack.append((tag, opened))
        else:
            for i in opened:
                self.open.discard(i)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and self.stack and self.stack[-1][0] == tag:
            for i in self.stack.pop()[1]:
                self.open.discard(i)

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                for _, opened in self.stack[k:]:
                    for i in opened:
                        self.open.discard(i)
                del self.stack[k:]
                return

    def handle_data(self, data):
        for i in self.open:
            self.found[i].append(data)


def main_text_and_source(html: str | None, selectors=CONTENT_SELECTORS,
                         min_chars: int = MIN_SELECTOR_CHARS) -> tuple[str | None, str | None]:
    """T1 for one page: first selector text longer than ``min_chars`` after
    stripping, else the body text ('' when there is no body); and which of
    them it is (the selector, or 'body')."""
    if html is None:
        return None, None
    p = _TextCollector(selectors)
    p.feed(html)
    p.close()
    texts = ["".join(parts) if parts is not None else None for parts in p.found]
    for sel, t in zip(selectors, texts[:-1]):
        if t and len(t.strip()) > min_chars:
            return t, sel
    return texts[-1] or "", "body"


def extract_main_text(html: str | None, selectors=CONTENT_SELECTORS,
                      min_chars: int = MIN_SELECTOR_CHARS) -> str | None:
    return main_text_and_source(html, selectors, min_chars)[0]


@F.pandas_udf(StructType([StructField("raw_content", StringType()), StructField("content_source", StringType())]))
def main_text_udf(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([main_text_and_source(h) for h in html],
                        columns=["raw_content", "content_source"], dtype=object)


def page_main_text(pages: DataFrame, html_col: str = "html",
                   key_cols=("page_id", "url"), native: bool = False) -> DataFrame:
    """T1 + T2: extracted and cleaned main text per page, and the element it
    comes from.  ``native`` takes pages of plain HTML in the JVM (``maintext``)
    and gives only the others to the parser, at more CPU time."""
    keys = [c for c in key_cols if c in pages.columns]
    html = F.col(html_col)
    if native:
        # Tested once for each page; a plain page reaches the worker as a null.
        hard = F.col("hard")
        tested = pages.select(*keys, html.alias("html"), maintext.needs_parser(html, CONTENT_SELECTORS).alias("hard"))
        main = maintext.main_text(F.col("html"), CONTENT_SELECTORS, MIN_SELECTOR_CHARS)
        raw = tested.select(*keys, hard, F.when(~hard, main).alias("plain"), main_text_udf(F.when(hard, F.col("html"))).alias("parsed")) \
                    .select(*keys, F.when(hard, F.col("parsed")).otherwise(F.col("plain")).alias("main"))
    else:
        raw = pages.select(*keys, main_text_udf(html).alias("main"))
    return raw.select(*keys, clean_text(F.col("main.raw_content")).alias("content"),
                      F.col("main.content_source").alias("content_source"))


def length_gate(df: DataFrame, content_col: str = "content",
                min_chars: int = MIN_CONTENT_CHARS) -> DataFrame:
    """Every row kept, with ``accepted`` and the reason of rejection
    ('Content too short: n < m') instead of an exception per row."""
    n = F.length(F.col(content_col))
    ok = n >= F.lit(min_chars)
    return df.withColumn("content_length", n) \
             .withColumn("accepted", F.coalesce(ok, F.lit(False))) \
             .withColumn("reject_reason",
                         F.when(~F.coalesce(ok, F.lit(False)),
                                F.concat(F.lit("Content too short: "), F.coalesce(n, F.lit(0)).cast("string"),
                                         F.lit(f" < {min_chars}"))))


def render_template(template: str, content: Column,
                    max_chars: int | None = None) -> Column:
    """``template.format(len_content=len(content), content=content)`` as one
    ``concat`` (on request only the first ``max_chars`` characters); the
    template is parsed on the driver (it is a literal)."""
    parts = []
    for literal, field, _spec, _conv in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is None:
            continue
        if field == "len_content":
            parts.append(F.length(content).cast("string"))
        elif field == "content":
            parts.append(content if max_chars is None else F.substring(content, 1, max_chars))
        else:
            raise KeyError(field)
    return F.concat(*parts) if parts else F.lit("")


def prompt_messages(df: DataFrame, content_col: str = "content",
                    system_prompt: str = DEFAULT_SYSTEM_PROMPT,
                    user_template: str = DEFAULT_USER_TEMPLATE,
                    max_chars: int | None = PROMPT_CONTENT_CHARS) -> Column:
    """T4: the [system, user, ...] message list as array<struct<role, content>>.
    A text of more than ``max_chars`` characters goes on in further user
    messages, so every character arrives."""
    content = F.col(content_col)
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    first = F.array(message("system", F.lit(system_prompt)),
                    message("user", render_template(user_template, content, max_chars)))
    if max_chars is None:
        return first
    parts = F.ceil(F.length(content) / F.lit(max_chars)).cast("int")
    rest = F.when(parts > 1, F.transform(
        F.sequence(F.lit(1), F.greatest(parts - 1, F.lit(1))),
        lambda k: message("user", F.substring(content, k * max_chars + 1, F.lit(max_chars)))))
    return F.concat(first, F.coalesce(rest, F.slice(first, 1, 0)))


CONTENT_HASH = "content_hash"


def enrich_once(df: DataFrame, scorer: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str,
                store: str, content: str = "content") -> DataFrame:
    """T5, resumable: each distinct text is scored once, over all rows and all
    runs.  ``store`` is a folder of scores by content hash; texts that it has
    are not given to the scorer again, and new scores are added to it as a
    part of their own, so a run that fails leaves the store as it was.

    The scorer sees ``content_hash`` and ``content`` and returns content_hash
    and its columns (``schema``).  Every row of ``df`` comes back once, with
    the columns of its text's score (NULL for a NULL text).  One folder is for
    one scorer and version."""
    spark = df.sparkSession
    columns = StructType.fromDDL(schema)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = [f"{store}/{f.getPath().getName()}" for f in fs.listStatus(p)] if fs.exists(p) else []
    parts = [x for x in parts if not x.endswith(".tmp")]      # of a run that failed
    rows = df.withColumn(CONTENT_HASH, F.sha2(F.col(content).cast("binary"), 256))
    texts = rows.filter(F.col(content).isNotNull()).select(CONTENT_HASH, F.col(content).alias("content"))
    if parts:
        known = spark.read.schema(columns).parquet(*parts).select(CONTENT_HASH).distinct()
        texts = texts.join(known, CONTENT_HASH, "left_anti")
    texts = texts.groupBy(CONTENT_HASH).agg(F.first("content").alias("content"))
    part = f"{store}/part-{uuid.uuid4().hex}"
    texts.mapInPandas(scorer, columns).write.parquet(f"{part}.tmp")
    fs.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{part}.tmp"), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(part))
    scores = spark.read.schema(columns).parquet(*parts, part).dropDuplicates([CONTENT_HASH])
    return rows.join(scores, CONTENT_HASH, "left").drop(CONTENT_HASH)


def enrich(df: DataFrame, scorer: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
           schema: str, key: str = "article_id") -> DataFrame:
    """T5: run a user scorer over Arrow batches (``mapInPandas``) and join
    its output back on ``key``; the scorer must return ``key`` plus its
    own columns.  Of several scores of one key the first is taken, so rows
    do not multiply."""
    scores = df.mapInPandas(scorer, schema).dropDuplicates([key])
    return df.join(scores, key, "left")
