"""Documents to tokens: five stages, each a training-data operator whose decisions take effect.

A stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the columns of
their input. ``run`` writes each stage's rows to the shared folder and reads them again.

In every stage nulls and empty texts count as empty, very long texts are read whole, further columns
go along whatever their names (those that a stage works with besides are its own and hidden), and an
empty table gives no rows. What a stage says of rows it says of each: repeated rows fare alike, and
only the join makes them one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.bpe import codec_digests
from strataflow.llm.common import written
from strataflow.llm.crf import score_quality, train_quality
from strataflow.llm.fertility import fitted_rules
from strataflow.llm.jaccard import class_survivors
from strataflow.llm.winnow import contamination


def _kept(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``stage`` leaves of ``docs``, with all columns as they were: those it doesn't need go by other names meanwhile."""
    hidden = {c: f"_column_{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text", "lang")}
    out = stage(docs.withColumnsRenamed(hidden))
    return out.select(*[F.col(hidden.get(c, c)).alias(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier takes for good.

    It is fitted on the labelled documents of ``docs`` outside the held-out part. Null and empty texts
    are scored as one empty line; rows without an id are scored like others.
    """
    model = train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _kept(docs, lambda df: score_quality(df, model).where("predicted = 1"))


def token_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the word counts and, under two vocabularies, the token bands of their language and script.

    The bands are measured on all clean labelled documents of ``docs``. Null and empty texts fail the
    word counts; a null ``lang`` has its script's bands.
    """
    vocabularies = tuple(map(public_tokenizers.path, ("piece_bpe_32k.model", "byte_bpe_50k.json")))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _kept(docs, lambda df: fitted_rules(df, labels, vocabularies).where("kept"))


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least id, on a tie the one of the least digest; rows without an id stay.

    Different texts of one id count as documents of their own, and repeated rows as one, of which any
    row stays. Null and empty texts are copies of each other.
    """

    def first_of_each(df: DataFrame) -> DataFrame:
        key = ["doc_id", "_text_digest"]
        digested = df.withColumn("_text_digest", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
        kept = digested.join(class_survivors(digested), key, "left_semi").dropDuplicates(key)
        return kept.drop("_text_digest").unionByName(df.where("doc_id is null"))

    return _kept(docs, first_of_each)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with a benchmark item, nor all words of a shorter one.

    Null and empty texts share none and stay; items without words or id are left out.
    """
    return _kept(docs, lambda df: contamination(df, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("n_hit = 0"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source (where there are such columns), n_tokens, the digests of ids and of decoded bytes, and the ids of every document.

    Null and empty texts have no ids.
    """
    return codec_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, carry=["doc_id", "lang", "source"], with_ids=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", token_rules),
    ("n-gram Jaccard join", one_of_each_class),
    ("benchmark decontamination", without_benchmarks),
    ("byte-level BPE", tokens),
]

#: SQL can't express the classifier, the vocabulary's figures or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{k}")
    return docs
