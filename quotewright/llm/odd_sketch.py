"""Near-duplicates by MinHash with odd sketches.

A text's set holds its distinct ``SHINGLE``-word shingles.  ``SAMPLES`` MinHash samples are folded
into an odd sketch, a bitmap in which bit ``hash(number, sample)`` is flipped once for
every sample: the XOR of two bitmaps holds the parity of the samples in which they differ, and
its population count estimates the similarity, most precisely where it is high.
``BAND`` samples at a time are hashed to a key, and texts that share a key are compared by their sketches.
Pairs whose count is no more than a pair at the threshold can be expected to
have (``most_bits``) are confirmed on full sets.

* Texts at the threshold share a key but for ``(1 - 0.8^5)^36``, 7 in 10 million pairs; more similar ones sooner.
* Equal sets are one class, so copies cost nothing.  Shingles are told apart by 64-bit hashes.
* Fewer words than a shingle make one; a text without words, or null, has an empty set
  and is linked with nothing, not even with another empty one.
* Rows without an id, and repeated rows, belong to their set's component; a component of nothing
  but null ids has a null id, and ``kept`` is false for a null id.  An empty table stays empty.
* Of the input only the two named columns are read; others may have any name.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm import verified
from quotewright.llm.common import shipped, written
from quotewright.llm.verified import Rule, mixed, node_column, node_id, set_digest, shingle_set, text_key, with_class

SHINGLE = 2
PERCENT = 80
BANDS = 36
BAND = 5
SAMPLES = BANDS * BAND
#: Bits of a sketch.
BITS = 512
#: Standard deviations that a pair at the threshold may lie above its expected count.
MARGIN = 5
SEED = 13
#: Shingles hashed at once.
AT_ONCE = 512


@lru_cache(maxsize=1)
def _factors() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 64, size=SAMPLES, dtype=np.uint64) | np.uint64(1)


def samples(hashes: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set: the least of its hashes under every permutation (an odd factor)."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max)
    for k in range(0, len(hashes), AT_ONCE):
        least = np.minimum(least, np.multiply.outer(_factors(), hashes[k : k + AT_ONCE]).min(axis=1))
    return least


def odd_sketch(least: np.ndarray) -> bytes:
    bit = mixed(least ^ mixed(np.arange(SAMPLES, dtype=np.uint64))) % np.uint64(BITS)
    odd = np.bincount(bit.astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, BAND).T:
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def similarity(apart: int) -> float:
    """The similarity that a XOR count stands for."""
    return 1 + BITS / (4 * SAMPLES) * math.log(max(1 - 2 * apart / BITS, 1e-9))


def most_bits(percent: int = PERCENT, margin: float = MARGIN) -> int:
    """The XOR count that pairs of at least this similarity hardly ever pass."""
    differ = 1 - percent / 100
    balls = 2 * SAMPLES * differ
    stays = math.exp(-2 * balls / BITS)
    from_samples = 2 * stays * math.sqrt(SAMPLES * differ * (1 - differ))
    from_folding = math.sqrt(BITS / 4 * (1 - math.exp(-4 * balls / BITS)))
    return math.ceil(BITS / 2 * (1 - stays) + margin * math.hypot(from_samples, from_folding))


SIGNED = "struct<size:long,digest:binary,code:binary,keys:array<long>>"
_SIGNED = pa.struct([("size", pa.int64()), ("digest", pa.binary()), ("code", pa.binary()), ("keys", pa.list_(pa.int64()))])


def signature_column(text: Column, shingle: int = SHINGLE) -> Column:
    @F.arrow_udf(SIGNED)
    def signatures(texts: pa.Array) -> pa.Array:
        out = []
        for x in texts:
            hashes = shingle_set(x.as_py(), shingle)
            if not len(hashes):
                out.append({"size": 0, "digest": None, "code": None, "keys": None})
                continue
            least = samples(hashes)
            out.append(
                {"size": len(hashes), "digest": set_digest(hashes), "code": odd_sketch(least), "keys": band_keys(least)}
            )
        return pa.array(out, _SIGNED)

    return signatures(text)


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    list_rows: int = verified.LIST_ROWS,
) -> DataFrame:
    """(doc id, n_shingles, component_id, kept) of every row."""
    shipped(docs.sparkSession)
    source = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    signed = source.select("doc_id", text_key(F.col("text")).alias("text_key"), signature_column(F.col("text"), shingle).alias("s"))
    rows = written(signed.select("doc_id", "text_key", "s.*"), "signatures")
    classes = rows.filter("size > 0").groupBy("digest").agg(
        F.min("doc_id").alias("smallest"),
        F.min("text_key").alias("text_key"),
        F.first("size").alias("size"),
        F.first("code").alias("code"),
        F.first("keys").alias("keys"),
        F.count("*").alias("rows"),
    )
    classes = written(classes.withColumn("node", node_column(F.col("smallest"), F.col("digest"))), "classes")
    rule = Rule(shingle, percent, most_bits(percent), list_rows=list_rows)
    found = verified.component_of(classes, F.col("keys"), source.select("text"), rule)
    named = classes.join(found, "node", "left").select(
        "digest", "rows", node_id(F.coalesce("component", "node")).alias("component_id")
    )
    joined = with_class(rows.filter("size > 0").select("doc_id", "size", "digest"), written(named, "named"), "digest")
    empty = rows.filter("size = 0").select("doc_id", "size", F.col("doc_id").alias("component_id"))
    every = joined.select("doc_id", "size", "component_id").unionByName(empty)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return every.select("doc_id", F.col("size").alias("n_shingles"), "component_id", kept.alias("kept"))
