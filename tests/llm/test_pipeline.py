"""The pipeline against brute-force versions of its stages."""

import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from quire.llm import mixing, toxicity
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_neardup import brute as classes


@pytest.fixture(scope="module")
def steps(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        out.append(docs)
    return out


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "text").collect()))


def test_columns(steps):
    assert all(df.columns == steps[0].columns for df in steps[1:5])


def test_toxic_documents_go(spark, sf_dir, steps):
    scored = toxicity.op5_toxicity(spark, sf_dir).filter("predicted = 0").select("doc_id").collect()
    assert [d for d, _ in rows(steps[1])] == sorted(r.doc_id for r in scored)
    assert steps[0].count() > steps[1].count() > 0.7 * steps[0].count()


def test_one_of_each_group_stays(steps):
    assert [d for d, _ in rows(steps[2])] == sorted(d for d, c, _ in classes(rows(steps[1])) if d == c)
    assert steps[2].count() < steps[1].count()


def test_contaminated_documents_go(spark, sf_dir, steps):
    items = list(map(tuple, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()))
    assert [d for d, _ in rows(steps[3])] == sorted(x[0] for x in contaminated(rows(steps[2]), items) if not x[5])
    assert steps[3].count() < steps[2].count()


def test_mix(steps):
    plan = mixing.plan(mixing.sizes(steps[3].select("doc_id", "source", "text"))).collect()
    assert [d for d, _ in rows(steps[4])] == sorted(r.doc_id for r in plan for _ in range(r.passes))
    words = lambda x: sum(len(re.findall(mixing.WORDS, t or "")) for _, t in x)
    assert 0.9 * words(rows(steps[3])) < words(rows(steps[4])) <= words(rows(steps[3]))


def test_tokens(steps):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = rows(steps[4])
    n = [len(e.ids) + 1 for e in lib.encode_batch([t or "" for _, t in texts], add_special_tokens=False)]
    got = sorted(map(tuple, steps[5].select("start", "doc_id", "n_tokens").collect()))
    assert [(d, k) for _, d, k in got] == [(d, k) for (d, _), k in sorted(zip(texts, n, strict=True), key=lambda x: x[0][0])]
    assert got[-1][0] + got[-1][2] == sum(n)


def test_edges(spark, sf_dir):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "a b c d e f g", "en", "s", 1), (4, "A b c d e f g", "en", "t", 1), (None, "lone words", "x", "s", 2),
         (5, "k l m n o p q r " * 4000, "en", None, 3)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumnRenamed("n_chars", "__hash")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        n = stage(spark, docs, sf_dir).count()
        assert n == (7, 6, 7)[k] if k < 3 else n <= 21
        if k < 4:
            assert stage(spark, docs.limit(0), sf_dir).columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).collect() == []


def test_clashing_columns_keep_their_values(spark, sf_dir):
    names = ["__toxicity", "__hash", "__text_hash", "__id", "__uid", "__at", "uid", "node", "bucket", "text_hash"]
    docs = spark.createDataFrame([(i, f"some plain words of document {i} and no other " * 3, "s", *[f"{i}-{n}" for n in names]) for i in range(6)],
                                 "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        got = out.collect()
        assert len(got) >= 4 and all(r[n] == f"{r.doc_id}-{n}" for r in got for n in names)
