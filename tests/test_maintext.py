"""Main text in the JVM against the HTML parser, on generated pages."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import maintext
from quire.operators import textprep as tp

# The first 27 are common; most of the others send a page to the parser.
PIECES = ["<p>", "</p>", "<div class='x postArticle-content'>", "</div>", "<article>", "</article>", "<main id=a>", "</main>", "<b>", "</b>", "<br>", "<br/>",
          '<img class="pw-article-body">', '<section data-testid="post-article-content">', "</section>", "<!-- c -->", "a &amp; b", "&lt;x&gt;", "&amp;lt;", "&copy 20",
          "&#39;q&#8217;", "&&#97;mp;", "text " * 5, "é\U0001F600", "</nothing>", "<DIV CLASS=pw-article-body>", "\n \t",
          "<p/>", "</body>", "1 < 2", "<script>var a;</script>", "&ne; ", "&ampx", "<a href='x?a=1&b=2' title=\"t\">", "</a>", "&#38;lt;", "&am<!-- z -->p;", "<!-- <b> -->",
          "<a title=\" class='postArticle-content'\">", "<p class=a class=pw-article-body>", "<!-- a --!> b -->", "<textarea><b></textarea>", "<div class='pw-article&#45;body'>"]
HEADS = ["<!DOCTYPE html><html><head><title>T &amp; t</title><script>var t='<p>';</script></head>", "<html>", ""]
MIN_CHARS = 3


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_the_parser(spark, seed):
    rng = random.Random(seed)
    weights = [8 if i < 27 else 1 for i in range(len(PIECES))]
    pages = [rng.choice(HEADS) + rng.choice(["<body>", "<BODY class='q'>"]) + "".join(rng.choices(PIECES, weights, k=rng.randint(0, 15))) + rng.choice(["", "</body></html>"])
             for _ in range(400)]
    pages += [None, "", "no body", "<body>", "<article>before</article><body>x</body>", "<!-- <body> --><p>x", "<body>" + "<p>deep" * 300 + "<article>long</p>er</article>"]
    d = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "id long, html string")
    got = d.select("id", maintext.needs_parser(F.col("html"), tp.CONTENT_SELECTORS).alias("hard"),
                   maintext.main_text(F.col("html"), tp.CONTENT_SELECTORS, MIN_CHARS).alias("m")).collect()
    plain = [r for r in got if not r.hard]
    assert len(plain) > 100
    for r in plain:
        want = tp.main_text_and_source(pages[r.id], min_chars=MIN_CHARS)
        assert (tuple(r.m) if r.m else (None, None)) == want, pages[r.id]


def test_pages_of_either_kind_come_back_once(spark):
    pages = ["<body>a</body>", "<body>1 < 2</body>", None, "<body><article>" + "w  " * 600 + "</article></body>", "<body><script>s</script></body>"]
    d = spark.createDataFrame([(i, "u", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    assert sorted(map(tuple, tp.page_main_text(d, native=True).collect())) == sorted(map(tuple, tp.page_main_text(d).collect()))


def test_plain_pages_meet_no_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plain = pages.select(maintext.main_text(F.col("html"), tp.CONTENT_SELECTORS, tp.MIN_SELECTOR_CHARS))
    assert "Python" not in plain._jdf.queryExecution().executedPlan().toString()
    assert pages.filter(maintext.needs_parser(F.col("html"), tp.CONTENT_SELECTORS)).count() < 0.05 * pages.count()
