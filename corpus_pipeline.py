"""From documents to packed training sequences; each stage's rows are saved for the next.

* ``quality_rules``: documents that the rules or their host's verdict reject go.
* ``near_duplicates``: one document of each group of near copies stays.
* ``personal_data``: spans in the texts are replaced by their kind.
* ``packing``: the texts' tokens are packed; returns pieces with their place, not documents.

All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewright.llm import packing, pii, quality, simhash
from quotewright.llm.common import table, unused, written
from quotewright.llm.registry import vocabulary

#: The tokenizer's merges and the fingerprints' hash can't be expressed in SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clashing = [c for c in docs.columns if c.lower() in (*quality.SIGNALS, *quality.VERDICTS)]
    aside = dict(zip(clashing, unused(docs, *clashing), strict=True))  # the documents' own columns of these names
    judged = quality.judge(quality.add_signals(docs.withColumnsRenamed(aside)))
    return judged.filter("kept").select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask_pii(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.cut_documents(docs.select("doc_id", "text"), vocabulary())
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
