"""The queries of the operators over their whole tables, and SQL for those that it can express."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewright.llm import ann, html_text, lexical, odd_sketch, packing, pii, quality, sharding, simhash, token_counts, tokens, url_reputation, whitening
from quotewright.llm.common import table, written
from quotewright.llm.oracles import ORACLES as ORACLES
from quotewright.sources.storage import fresh_path

#: The vocabulary of the queries; the operators take any path.
VOCABULARY = "byte_bpe_50k.json"
SHARDS = 24
TOKEN_LIMIT = 1024
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def vocabulary() -> str:
    return public_tokenizers.path(VOCABULARY)


def op1_hypergeometric_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = sharding.shuffle_to_shards(table(spark, sf_dir, "documents"), SHARDS)
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return moved.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract_text(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.cut_documents(docs, vocabulary())
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("pii", lambda x: x["kind"].isin(*pii.BASE))
    digest = F.sha2(pii.joined(base), 256).alias("base_sha256")
    return found.select("doc_id", *map(of, pii.BASE), digest, pii.joined(F.col("pii")).alias("spans"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = tokens.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary())
    both = tokens.decode(encoded, vocabulary())
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_digest_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    counted = token_counts.count_tokens(docs, fresh_path(spark, "token_counts"), vocabulary())
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def text_digest(text: str | None) -> bytes | None:
    """A digest of the whole text, whatever its white space; none if there is no text."""
    plain = " ".join((text or "").split())
    return hashlib.sha256(plain.encode()).digest() if plain else None


def _digest_column(text: Column) -> Column:
    @F.arrow_udf("binary")
    def digests(texts: pa.Array) -> pa.Array:
        return pa.array([text_digest(x.as_py()) for x in texts], pa.binary())

    return digests(text)


def _shown_column(page: Column) -> Column:
    """Digests of a page's main text with and without its title, struct<whole, body>."""

    @F.arrow_udf("struct<whole:binary,body:binary>")
    def digests(pages: pa.Array) -> pa.Array:
        parts = [html_text.title_and_body(x.as_py()) for x in pages]
        columns = [pa.array([text_digest(x) for x in texts], pa.binary()) for texts in (map(" ".join, parts), (b for _, b in parts))]
        return pa.StructArray.from_arrays(columns, names=["whole", "body"])

    return digests(page)


def page_outcomes(pages: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, n, bad) of every host: a page has the label of the documents whose whole text it shows.

    A document may hold the page's title or not: the text with it comes first.  Both tables
    are read once, and digests are saved before anything looks at them.
    """
    host, _ = url_reputation.host_and_path(F.col("url"))
    shown = written(pages.select(host.alias("host"), _shown_column(F.col("html")).alias("shown")), "page_digests")
    shown = written(shown.groupBy("host", "shown.whole", "shown.body").agg(F.count("*").alias("times")), "shown")
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    rated = labels.filter(bad.isNotNull()).groupBy("doc_id").agg(F.max(bad.cast("int")).alias("bad"))
    texts = written(docs.select("doc_id", _digest_column(F.col("text")).alias("key")), "text_digests").filter("key is not null")
    texts = written(texts.join(rated, "doc_id", "left").groupBy("key").agg(F.sum("bad").alias("bad"), F.count("bad").alias("n")), "texts")
    titled = texts.select(F.col("key").alias("whole"), F.lit(True).alias("titled"))
    key = F.when(F.col("titled"), F.col("whole")).otherwise(F.col("body"))
    contents = shown.join(titled, "whole", "left").select("host", key.alias("key"), "times")
    known = texts.filter("n > 0").select("key", (2 * F.col("bad") > F.col("n")).cast("int").alias("bad"))
    return url_reputation.host_outcomes(contents, known)


def op9_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: a page is bad if most labelled documents of its whole text are."""
    pages = table(spark, sf_dir, "pages")
    outcomes = page_outcomes(pages, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    judged = url_reputation.judge_urls(pages.select("page_id", "url"), url_reputation.reputations(outcomes), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    judged = quality.judge(quality.add_signals(docs).drop("text"))
    return judged.select("doc_id", *quality.SIGNALS, "base_failed", "kept")


def op11_geometric_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_bidiagonal_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_hypergeometric_sharding,
        op2_one_bit_neighbours,
        op3_tree_scoring,
        op4_simhash,
        op5_genetic_packing,
        op6_pii,
        op7_bpe,
        op8_digest_cache,
        op9_host_reputation,
        op10_host_rules,
        op11_geometric_blocks,
        op12_bidiagonal_whitening,
        op13_odd_sketches,
    )
}
