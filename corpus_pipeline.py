"""A training-data pipeline over the documents table, stage by stage; part of the subpackage llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read back as the next stage's
docs. All but the last return the columns of documents. What a stage has staged in the shared folder is deleted when a later
stage begins with docs that no longer read it.

In every stage rows that repeat an id and a text are judged alike, columns beside those of documents are carried along
whatever their names, texts of any length are taken whole, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parityline.llm import bpe, line_dedup, mixing, ngram_join, quality
from parityline.llm.common import drop_recorded, recorded, staged, text_of, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(f: Stage) -> Stage:
    """A stage that first deletes what earlier ones have left behind."""

    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_recorded(spark, docs)
        with recorded(spark):
            return f(spark, docs, sf_dir)

    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the classifier reject go.

    Null, empty and blank texts have fewer than ten words and go. A score exactly at the threshold keeps a document. Null ids
    are judged by their text as others are; they have no label.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage
def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go; n_chars follows the text, and every document stays.

    A null text stays null, and a text may become empty. Null ids keep their text. A similarity of exactly 0.8 is a match.
    """
    out = line_dedup.drop_repeated_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@_stage
def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one with the smallest id.

    Null, empty and wordless texts are one class. Rows without an id stay. A similarity of exactly 0.8 is a link.
    """
    return ngram_join.keep_one(docs)


@_stage
def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by the probabilities of raked source, language and topic weights.

    Null sources and languages are a value of their own; null, empty and blank texts have no tokens and are drawn with their
    cell; a null id draws as the empty text.
    """
    return mixing.sampled(docs, mixing.form(text_of("text")))


@_stage
def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the decoded text. Null and empty texts have no ids."""
    return bpe.encode_decode(docs, tokenizer_path("word_bpe_49k.json")).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("ngram_join", near_deduplication),
    ("mixing", mixing_to_weights),
    ("bpe", bpe_encoding),
]

#: The first stage's verdict comes from a fitted classifier and the last encodes, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each result is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
