"""A corpus pipeline from the operators of ``quire.llm``: toxic documents go,
one document of each group of near-duplicates stays, contaminated documents
go, the sources are mixed to their target weights, and the mix is written as
token ids and read back.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written and reread before the next stage; all but the last return the columns
of their input.  What each stage does with nulls, empty and repeated rows is
its operator's definition; an empty table passes through every stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontam, mixing, neardup, tokenfile, toxicity
from quire.llm.work import free_name, new_path

#: Score from which a document is toxic.
TOXIC = 0.5


def _columns(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in like.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = free_name(docs, "__toxicity")
    scored = toxicity.score(docs, toxicity.learn(docs, labels), score)
    return _columns(scored.filter(F.col(score) < TOXIC), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A text's hash takes the place of the doc_id: equal texts share their fate."""
    text_hash = F.xxhash64(F.col("text").cast("string"))
    found = decontam.contamination(docs.select(text_hash.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    own = free_name(docs, "__hash")
    hit = found.filter("n_hit > 0").select(F.col("doc_id").alias(own)).distinct()
    return _columns(docs.withColumn(own, text_hash).join(hit, own, "left_anti"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenfile.token_file(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("source_mix", mix_sources),
    ("token_file", write_tokens),
]

#: The learned lexicon, the near-duplicate classes and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
