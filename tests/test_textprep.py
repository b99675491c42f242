from quire.operators import textprep as tp


def page(article="", main="", body_extra=""):
    return (f"<html><head><title>T</title><script>var t=\"</p>\";</script></head><body>"
            f"<nav>menu</nav>{body_extra}"
            + (f"<article><p><b>{article}</p></article>" if article else "")
            + (f"<main>{main}</main>" if main else "") + "<footer>f</footer></body></html>")


def test_article_wins_when_long():
    html = page(article="a" * 1501, main="m" * 2000)
    assert tp.extract_main_text(html) == "a" * 1501


def test_main_when_article_short():
    html = page(article="short", main="m" * 1600)
    assert tp.extract_main_text(html) == "m" * 1600


def test_body_fallback_and_entities():
    html = page(article="x &amp; y", body_extra="<div class='ad'>ad &lt;1&gt;</div><br>")
    assert tp.extract_main_text(html) == "menuad <1>x & yf"


def test_class_and_testid_selectors():
    html = ("<body><div class='x postArticle-content'>" + "c" * 1600 + "</div></body>")
    assert tp.extract_main_text(html) == "c" * 1600
    html2 = ("<body><section data-testid='post-article-content'>" + "d" * 1600 + "</section></body>")
    assert tp.extract_main_text(html2) == "d" * 1600


def test_script_text_inside_body_counts():
    html = "<body><p>a</p><script>var t=\"</p>\";</script></body>"
    assert tp.extract_main_text(html) == "avar t=\"</p>\";"


def test_page_main_text_udf(spark):
    df = spark.createDataFrame([(1, "u", page(article="w  " * 600))], "page_id long, url string, html string")
    r = tp.page_main_text(df).first()
    assert r.content == ("w " * 600).strip()


def test_gate_and_prompt(spark):
    df = spark.createDataFrame([(1, "x" * 999), (2, "y" * 1000), (3, "z{content}" * 1000)],
                               "id long, content string")
    g = {r.id: r for r in tp.length_gate(df).collect()}
    assert not g[1].accepted and g[1].reject_reason == "Content too short: 999 < 1000"
    assert g[2].accepted and g[2].reject_reason is None
    m = df.filter("id = 3").select(
        tp.prompt_messages(df, "content", "sys", "Len {len_content}: {content}").alias("m")).first().m
    assert m[0].role == "system" and m[0].content == "sys"
    assert m[1].content == "Len 10000: " + ("z{content}" * 1000)[:8000]


def test_enrich_plug_point(spark):
    df = spark.createDataFrame([("a", "text one"), ("b", "longer text two")], "article_id string, content string")

    def scorer(batches):
        for b in batches:
            yield b.assign(score=b.content.str.len().astype("double"))[["article_id", "score"]]

    out = {r.article_id: r.score for r in tp.enrich(df, scorer, "article_id string, score double").collect()}
    assert out == {"a": 8.0, "b": 15.0}


def test_long_texts_go_on_in_further_user_messages(spark):
    text = "".join(chr(97 + i % 26) for i in range(20_001))
    df = spark.createDataFrame([(text,), ("short",), (None,)], "content string")
    rows = df.select(tp.prompt_messages(df, "content", "sys", "{content}").alias("m")).collect()
    assert [len(r.m) for r in rows] == [4, 2, 2]
    assert "".join(m.content for m in rows[0].m[1:]) == text and {m.role for m in rows[0].m[1:]} == {"user"}


def counting(calls):
    def scorer(frames):
        for f in frames:
            with open(calls, "a") as log:
                log.writelines(f"{h}\n" for h in f["content_hash"])
            yield f.assign(n=f["content"].str.len().astype("int64"))[["content_hash", "n"]]
    return scorer


def test_each_text_is_scored_once(spark, tmp_dir):
    calls, store = f"{tmp_dir}/calls", f"{tmp_dir}/store"
    schema = "content_hash string, n long"

    def score(rows):
        df = spark.createDataFrame(rows, "article_id string, content string").repartition(3)
        return sorted(map(tuple, tp.enrich_once(df, counting(calls), schema, store).collect()), key=repr)

    def scored():
        with open(calls) as f:
            return f.read().split()
    rows = [("k1", "one"), ("k1", "one"), ("k2", "one"), ("k3", "three"), ("k4", None), (None, "")]
    want = sorted([(k, c, None if c is None else len(c)) for k, c in rows], key=repr)
    assert score(rows) == want and len(scored()) == 3
    assert score(rows) == want and len(scored()) == 3          # nothing is scored again
    more = [*rows, ("k9", "nine"), ("k9", "nine")]
    assert score(more) == sorted([(k, c, None if c is None else len(c)) for k, c in more], key=repr) and len(scored()) == 4


def test_failed_scorer_leaves_the_store(spark, tmp_dir):
    import pytest
    df = spark.createDataFrame([("k", "x")], "article_id string, content string")

    def fails(frames):
        for _ in frames:
            raise RuntimeError("no answer")
        yield
    with pytest.raises(Exception, match="no answer"):
        tp.enrich_once(df, fails, "content_hash string, n long", f"{tmp_dir}/store")
    calls = f"{tmp_dir}/calls"
    assert [r.n for r in tp.enrich_once(df, counting(calls), "content_hash string, n long", f"{tmp_dir}/store").collect()] == [1]


def test_repeated_keys_do_not_multiply_rows(spark):
    df = spark.createDataFrame([("k", "x"), ("k", "x")], "article_id string, content string")

    def scorer(frames):
        for f in frames:
            yield f.assign(score=1.0)[["article_id", "score"]]
    assert tp.enrich(df, scorer, "article_id string, score double").count() == 2
