"""Token counts through a digest cache.

Each text is normalised (runs of ASCII white space become one space, also at the ends, where the tokenizer drops
white space anyway; otherwise it is left as it is) and named by its SHA-256. The cache is a Parquet table of
(tokenizer, digest, n_tokens), tokenizer being the digest of the vocabulary file. Documents are joined to it by both
digests; of those without an entry one row for each digest is encoded, and the new counts are appended.

Edge cases: a null text counts as empty (0 bytes, 0 tokens); texts of any length are encoded whole; a null id is counted too; repeated rows and repeated ids each give a row; an
empty table gives an empty result and appends nothing; extra columns of the input are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityline.llm.common import kept, scratch, staged, steps, text_bytes, text_of, tokenizer_path
from parityline.llm.tokens import Encoder, drops_blanks, file_digest

CACHE = "tokenizer string, digest binary, n_tokens long"


def normalised(text: Column, tokenizer: str) -> Column:
    """What the digest is taken of; never changes a count."""
    if not drops_blanks(tokenizer):
        return text
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    cache: path of the cache table; it need not exist. Only this call's distinct misses are encoded and appended.
    """
    spark, version = docs.sparkSession, file_digest(tokenizer)
    text = text_of(text_col)
    digest = F.unhex(F.sha2(normalised(text, tokenizer), 256)).alias("digest")
    named = docs.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), digest)
    named = staged(named, "token-digests")

    def stored() -> DataFrame:
        return spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == version).select("digest", "n_tokens")

    try:
        before = stored().dropDuplicates(["digest"])
    except Exception as e:  # the first call: there is no cache yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        before = spark.createDataFrame([], "digest binary, n_tokens long")
    # One document for each digest that has no count. Copies meet as partial minima, not as rows.
    chosen = (
        named.groupBy("digest").agg(F.min(id_col).alias("_id")).join(before, "digest", "left_anti").select("_id", F.col("digest").alias("_digest"))
    )
    texts = docs.select(F.col(id_col).alias("_own"), digest, text_bytes(text_col).alias("text"))
    same = F.col("_own").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    misses = texts.join(chosen.hint("merge"), same).select("digest", "text")

    def encode(batches):
        encoder = kept(("encoder", tokenizer), lambda: Encoder(tokenizer))
        for batch in steps(batches, "text"):
            counts = [len(x) // 4 for x in encoder.encode(batch.column("text").to_pylist())]
            yield pa.record_batch([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])
        encoder.forget()

    (
        misses.mapInArrow(encode, "digest binary, n_tokens long")
        .groupBy("digest")  # rows that repeat id and text
        .agg(F.max("n_tokens").alias("n_tokens"))
        .select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")
        .write.mode("append")
        .parquet(cache)
    )
    # Staged, so that the planner may split a group of copies in the join.
    counts = staged(stored().groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "token-counts")
    return named.join(counts, "digest").select(
        id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, tokenizer_path("word_bpe_49k.json"), scratch(spark, "token-cache"))
