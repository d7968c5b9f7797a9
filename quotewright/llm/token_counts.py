"""Token counts through a cache of digests.

The cache is a table (content_digest, tokenizer_digest, n_tokens).  Rows are joined to it
by the digests of their content and of the tokenizer's file, only distinct contents that
it lacks are encoded, and their counts are appended.

* The content is the text itself, null taken as empty: a normal form that changes the
  text could change its count, so none is applied.
* Copies are cut within each task before texts are exchanged, so a content that a third
  of all rows hold reaches the encoder once a task at most.
* A lost executor repeats reads only.  Two jobs that append the same content at once
  leave two equal rows in the cache; reading keeps one.
* An empty table returns no rows and appends nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewright.llm import bpe
from quotewright.llm.common import shipped, unused

CACHE = "content_digest string, tokenizer_digest string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """The version of a tokenizer: its library's kind and the SHA-256 of its file."""
    with open(path, "rb") as file:
        return f"{path.rsplit('.', 1)[-1]}:{hashlib.sha256(file.read()).hexdigest()}"


def count_column(text: Column, path: str) -> Column:
    """Tokens of a text as the file's library gives them, without added special tokens."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        texts = texts.fill_null("")
        if path.endswith(".model"):
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_file=path).encode(texts.to_pylist(), num_threads=1)
            return pa.array([len(x) for x in pieces], pa.int64())
        try:
            return pa.array(bpe.load(path).counts(texts).astype(np.int64))
        except bpe.Unsupported:  # another kind of vocabulary
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            return pa.array([len(tokenizer.encode(x, add_special_tokens=False).ids) for x in texts.to_pylist()], pa.int64())

    return count(text)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts, one row for each content and tokenizer."""
    try:
        stored = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE)
    return stored.groupBy("content_digest", "tokenizer_digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache: str, tokenizer: str, text: str = "text", count: str = "n_tokens") -> DataFrame:
    """Add the token count of every row, and append what was missing to the cache."""
    spark = docs.sparkSession
    shipped(spark)
    version = tokenizer_digest(tokenizer)
    content = F.coalesce(docs[text].cast("string"), F.lit(""))
    digest = F.sha2(content, 256)
    known = read_cache(spark, cache).filter(F.col("tokenizer_digest") == version)
    misses = (
        docs.select(digest.alias("content_digest"), content.alias("content"))
        .dropDuplicates(["content_digest"])
        .join(known, "content_digest", "left_anti")
    )
    counted = misses.select(
        "content_digest", F.lit(version).alias("tokenizer_digest"), count_column(F.col("content"), tokenizer).alias("n_tokens")
    )
    counted.write.mode("append").parquet(cache)
    stored = read_cache(spark, cache).filter(F.col("tokenizer_digest") == version)
    own, theirs, number = unused(docs, "content_digest", "stored_digest", "stored_count")
    stored = stored.select(F.col("content_digest").alias(theirs), F.col("n_tokens").alias(number))
    joined = docs.withColumn(own, digest).join(stored, F.col(own) == F.col(theirs))
    return joined.select(*[f"`{c}`" for c in docs.columns if c != count], F.col(number).alias(count))
