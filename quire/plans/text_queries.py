"""Registered text-preparation queries over ``documents`` and ``pages``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quire.functions.scalars import clean_text
from quire.operators import textprep as tp
from quire.plans import testdata as td
from quire.session import ensure_checkpoint_dir

SYSTEM_PROMPT = "You rate the quality of an article and answer in JSON."
USER_TEMPLATE = "Article ({len_content} characters):\n\n{content}"


def _cleaned_docs(spark, sf):
    d = td.table(spark, sf, "documents")
    return d.select("doc_id", clean_text(F.col("text")).alias("content"))


def q_text_cleanup(spark, sf):
    return _cleaned_docs(spark, sf)


def q_page_main_text(spark, sf):
    return tp.page_main_text(td.table(spark, sf, "pages"))


def q_page_main_text_native(spark, sf):
    """The same texts; only pages that plain tokens don't cover see the parser."""
    return tp.page_main_text(td.table(spark, sf, "pages"), native=True)


def q_min_length_gate(spark, sf):
    return tp.length_gate(_cleaned_docs(spark, sf)).select(
        "doc_id", "content_length", "accepted", "reject_reason")


def q_prompt_messages(spark, sf):
    # Rejected rows get no message list but stay, as turn -1 with the reason (outer generator).
    d = tp.length_gate(_cleaned_docs(spark, sf))
    msgs = tp.prompt_messages(d, "content", SYSTEM_PROMPT, USER_TEMPLATE)
    m = d.select("doc_id", "reject_reason", F.when(F.col("accepted"), msgs).alias("m"))
    return m.select("doc_id", "reject_reason", F.posexplode_outer("m").alias("turn", "msg")) \
            .select("doc_id", F.coalesce("turn", F.lit(-1)).alias("turn"),
                    F.coalesce("msg.role", F.lit("rejected")).alias("role"),
                    F.coalesce("msg.content", "reject_reason").alias("content"))


def _vowels(frames):
    """A scorer: how many of a, e, i, o and u a text has."""
    for f in frames:
        yield f.assign(vowels=f["content"].str.count("[aeiou]").astype("int64"))[["content_hash", "vowels"]]


def q_enrich_once(spark, sf):
    """T5 in two runs over one store: the second scores what the first has not."""
    docs = td.table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"))
    store = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quire-scores/{uuid.uuid4().hex}"
    schema = "content_hash string, vowels long"
    tp.enrich_once(docs.filter("doc_id % 2 = 0"), _vowels, schema, store)
    return tp.enrich_once(docs, _vowels, schema, store).select("doc_id", "vowels")


QUERIES = {
    "enrich_once": q_enrich_once,
    "text_cleanup": q_text_cleanup,
    "page_main_text": q_page_main_text,
    "page_main_text_native": q_page_main_text_native,
    "min_length_gate": q_min_length_gate,
    "prompt_messages": q_prompt_messages,
}

# Unicode whitespace as Python's str.isspace sees it, spelled out for RE2.
_WS = (r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
       r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")
_CLEAN = f"""
cleaned AS (
  SELECT doc_id, text, trim(regexp_replace(text, '{_WS}', ' ', 'g')) AS c FROM documents),
docs AS (
  SELECT doc_id,
    c AS content
  FROM cleaned)"""

# Oracle for page_main_text.  SQL has no HTML parser; on these generated
# pages (no scripts or styles inside <body>, no nested <article>, no <main>,
# only the entities below; an unclosed element ends where its parent ends)
# dropping comments and tags and decoding the
# entities gives the DOM text, so the UDF is checked against an independent
# derivation.  '&amp' is decoded last, so '&amp;lt;' stays '&lt;'.
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
             ("&copy;", "©"), ("&middot;", "·")]


def _strip_html(x: str) -> str:
    out = f"regexp_replace(regexp_replace({x}, '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', '', 'g')"
    for ent, ch in _ENTITIES:
        out = f"replace({out}, '{ent}', '{ch}')"
    # '&amp' decodes with or without its semicolon (HTML's legacy rule)
    return f"regexp_replace({out}, '&amp;?', '&', 'g')"


_PAGES = f"""
body AS (
  SELECT page_id, url,
    split_part(regexp_extract(html, '(?s)<body[^>]*>(.*)$', 1), '</body>', 1) AS body_html
  FROM pages),
raw AS (
  SELECT page_id, url, body_html,
    split_part(regexp_extract(body_html, '(?s)<article[^>]*>(.*)$', 1), '</article>', 1) AS art_html
  FROM body),
txt AS (SELECT page_id, url, {_strip_html('art_html')} AS art, {_strip_html('body_html')} AS body FROM raw),
picked AS (
  SELECT page_id, url,
    CASE WHEN length(regexp_replace(art, '^{_WS}|{_WS}$', '', 'g')) > {tp.MIN_SELECTOR_CHARS}
         THEN art ELSE body END AS text,
    CASE WHEN length(regexp_replace(art, '^{_WS}|{_WS}$', '', 'g')) > {tp.MIN_SELECTOR_CHARS}
         THEN 'article' ELSE 'body' END AS content_source
  FROM txt),
cleaned AS (SELECT page_id, url, content_source, trim(regexp_replace(text, '{_WS}', ' ', 'g')) AS c FROM picked)"""

ORACLE = {
    "enrich_once": "SELECT doc_id, length(regexp_replace(text, '[^aeiou]', '', 'g')) AS vowels FROM documents",
    "text_cleanup": f"WITH {_CLEAN} SELECT doc_id, content FROM docs",
    "page_main_text": f"""WITH {_PAGES}
SELECT page_id, url, c AS content, content_source FROM cleaned""",
    "min_length_gate": f"""WITH {_CLEAN}
SELECT doc_id, CAST(length(content) AS INTEGER) AS content_length,
       length(content) >= {tp.MIN_CONTENT_CHARS} AS accepted,
       CASE WHEN length(content) < {tp.MIN_CONTENT_CHARS}
            THEN 'Content too short: ' || CAST(length(content) AS VARCHAR) || ' < {tp.MIN_CONTENT_CHARS}' END
         AS reject_reason
FROM docs""",
    "prompt_messages": f"""WITH {_CLEAN}, ok AS (SELECT * FROM docs WHERE length(content) >= {tp.MIN_CONTENT_CHARS})
SELECT doc_id, 0 AS turn, 'system' AS role, '{SYSTEM_PROMPT}' AS content FROM ok
UNION ALL
SELECT doc_id, 1 AS turn, 'user' AS role,
       'Article (' || CAST(length(content) AS VARCHAR) || ' characters):' || chr(10) || chr(10)
       || substr(content, 1, {tp.PROMPT_CONTENT_CHARS}) AS content
FROM ok
UNION ALL
SELECT doc_id, CAST(1 + k AS INTEGER), 'user', substr(content, k * {tp.PROMPT_CONTENT_CHARS} + 1, {tp.PROMPT_CONTENT_CHARS})
FROM (SELECT *, unnest(range(1, (length(content) + {tp.PROMPT_CONTENT_CHARS} - 1) // {tp.PROMPT_CONTENT_CHARS})) AS k FROM ok)
UNION ALL
SELECT doc_id, -1, 'rejected',
       'Content too short: ' || CAST(length(content) AS VARCHAR) || ' < {tp.MIN_CONTENT_CHARS}'
FROM docs WHERE length(content) < {tp.MIN_CONTENT_CHARS}""",
}

ORACLE["page_main_text_native"] = ORACLE["page_main_text"]
