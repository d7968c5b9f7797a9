"""SimHash near-duplicates by an inverted index of byte positions with count filtering.

A fingerprint has 64 bits over the XXH64 of its shingles.  Two fingerprints that differ in
at most ``MAX_BITS`` bits share at least ``8 - MAX_BITS`` of their eight positional bytes.
So both lie in the posting list of some ``m`` equal bytes among any ``MAX_BITS + m``
positions (3 of 7, or 4 of 8 for a larger corpus: the links are the same, the lists shorter).  In each list the shared positional bytes
of all pairs are tallied, pairs below the guaranteed count are dropped and the others are
verified by their bits.  Distinct fingerprints only are indexed, so copies cost nothing.

* Words are runs of anything but ASCII space; A-Z are lowered first.  Fewer words than a
  shingle make one shingle; a text without words, or null, has fingerprint 0 and is linked
  like any other.
* A list passes on a spanning forest of its links: no link between components is lost, and
  a group of n near copies never becomes n^2 rows.  A list over ``LIST_ROWS`` is compared
  in blocks, block against block, each pair of blocks in a task of its own.
* Rows without an id, and repeated rows, belong to their text's component; a component of
  nothing but null ids has a null id.  An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm import verified
from quotewright.llm.common import shipped, unused, written
from quotewright.llm.components import components, local_forest

SHINGLE = 4
SEED = 42
MAX_BITS = 4
#: Positional bytes that linked fingerprints share at least.
SHARED = 8 - MAX_BITS
#: Fingerprints compared with each other in one piece.
LIST_ROWS = 4096
#: From so many fingerprints on, lists are keyed by four bytes instead of three.
WIDE_INDEX = 1 << 28
#: Shingles whose bits are counted at once.
COUNTED = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, as a signed 64-bit number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    body = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    count = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(body[a:b], SEED) for a, b in zip(starts[:count].tolist(), last.tolist(), strict=True)], "<u8")
    votes = np.zeros(64, np.int64)
    for k in range(0, count, COUNTED):
        bits = np.unpackbits(hashes[k : k + COUNTED].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > count, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column) -> Column:
    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x.as_py()) for x in texts], pa.int64())

    return fingerprints(text)


def posting_lists(n_fingerprints: int) -> list[tuple[int, ...]]:
    """The sets of byte positions that lists are keyed by: some m of the 8 - SHARED + m
    first positions are equal in every pair that shares SHARED bytes."""
    m = SHARED if n_fingerprints >= WIDE_INDEX else SHARED - 1
    return list(combinations(range(8 - SHARED + m), m))


def _linked(prints: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that share enough bytes (tallied) and differ in few bits."""
    apart = prints[:, None] ^ others[None, :]
    shared = (apart.view(np.uint8).reshape(*apart.shape, 8) == 0).sum(axis=2, dtype=np.uint8)
    left, right = np.nonzero(shared >= SHARED)
    near = np.bitwise_count(apart[left, right]) <= MAX_BITS
    return left[near], right[near]


def _forest(prints: np.ndarray, others: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Spanning links among some fingerprints, or between two blocks of them."""
    whole = prints if others is None else np.concatenate([prints, others])
    right_at = 0 if others is None else len(prints)
    found: list[tuple[int, int]] = []
    for k in range(0, len(prints), 256):
        left, right = _linked(prints[k : k + 256].view(np.uint64), (prints if others is None else others).view(np.uint64))
        left, right = left + k, right + right_at
        ahead = left < right
        found += local_forest(left[ahead].tolist(), right[ahead].tolist())
    kept = local_forest([a for a, _ in found], [b for _, b in found])
    for a, b in kept:
        yield int(whole[a]), int(whole[b])


FOUND = "a long, b long, large_list long"


def _batch(a: list[int], b: list[int], large: list[int] | None = None) -> pa.RecordBatch:
    nothing, large = [None] * len(a), large or []
    columns = (a + [None] * len(large), b + [None] * len(large), nothing + large)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["a", "b", "large_list"])


def _compare_lists(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    """Spanning links of all lists, and the keys of lists that are too large to compare
    here; equal keys are neighbours."""
    edges = np.flatnonzero(np.diff(keys)) + 1
    starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(keys)]])
    sizes = ends - starts
    pair = starts[sizes == 2]
    apart = prints[pair].view(np.uint64) ^ prints[pair + 1].view(np.uint64)
    shared = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    near = pair[(shared >= SHARED) & (np.bitwise_count(apart) <= MAX_BITS)]
    a, b = prints[near].tolist(), prints[near + 1].tolist()
    longer = (sizes > 2) & (sizes <= LIST_ROWS)
    for x, y in zip(starts[longer].tolist(), ends[longer].tolist(), strict=True):
        for u, v in _forest(prints[x:y]):
            a.append(u)
            b.append(v)
    return _batch(a, b, keys[starts[sizes > LIST_ROWS]].tolist())


def _sorted_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists in key order; the last of a batch waits for the rest of it.  Of a list that is
    too large no more is held than shows that."""
    rest = np.zeros((2, 0), np.int64)
    for batch in batches:
        keys, prints = (np.concatenate([old, x.to_numpy()]) for old, x in zip(rest, batch.columns, strict=True))
        cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        rest = np.array([keys[cut:], prints[cut:]])[:, : LIST_ROWS + 1]
        if cut:
            yield _compare_lists(keys[:cut], prints[:cut])
    if rest.shape[1]:
        yield _compare_lists(*rest)


def _block_pairs(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    first, second = (np.sort(x.column("print").to_numpy()) for x in (left, right))
    pairs = list(_forest(first) if key[1].as_py() == key[2].as_py() else _forest(first, second))
    return pa.Table.from_batches([_batch([a for a, _ in pairs], [b for _, b in pairs])]).select(["a", "b"])


def _large_lists(postings: DataFrame, large: DataFrame) -> DataFrame:
    """Links of the lists with these keys, by pairs of blocks."""
    members = postings.join(large, "key")
    blocks = members.groupBy("key").agg(F.ceil(F.count("*") / LIST_ROWS).cast("int").alias("blocks"))
    dealt = members.join(written(blocks, "blocks"), "key")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    as_left = dealt.filter("block <= other").select("key", F.col("block").alias("i"), F.col("other").alias("j"), "print")
    as_right = dealt.filter("other <= block").select("key", F.col("other").alias("i"), F.col("block").alias("j"), "print")
    names = ("key", "i", "j", "print")
    cells = as_left.toDF(*names).groupBy("key", "i", "j").cogroup(as_right.toDF(*names).groupBy("key", "i", "j"))
    return cells.applyInArrow(_block_pairs, "a long, b long")


def links(prints: DataFrame) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints (``print``)."""
    sets = posting_lists(prints.count())
    keys = []
    for number, positions in enumerate(sets):
        key = F.lit(0).cast("long")
        for p in positions:
            key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned("print", 8 * p).bitwiseAND(F.lit(255)))
        keys.append(key * len(sets) + number)
    postings = prints.select(F.explode(F.array(*keys)).alias("key"), "print")
    found = written(postings.repartition("key").sortWithinPartitions("key").mapInArrow(_sorted_lists, FOUND), "list_links")
    out = found.filter("a is not null").select("a", "b")
    large = found.filter("large_list is not null").select(F.col("large_list").alias("key"))
    return out if large.isEmpty() else out.unionByName(_large_lists(postings, large))


def cluster(rows: DataFrame, doc_id: str, print_column: str) -> DataFrame:
    """(print, component, component_id) of every fingerprint of saved rows; a component
    is named by one of its fingerprints, and by its smallest id."""
    own = written(rows.groupBy(F.col(print_column).alias("print")).agg(F.min(doc_id).alias("smallest")), "prints")
    found = components(links(own.select("print"))).select(F.col("node").alias("print"), "component")
    joined = own.join(found, "print", "left").withColumn("component", F.coalesce("component", "print"))
    joined = written(joined, "component_prints")
    least = joined.groupBy("component").agg(F.min("smallest").alias("component_id"))
    return joined.join(least, "component").select("print", "component", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc id, fingerprint, component_id) of every row."""
    shipped(docs.sparkSession)
    rows = written(docs.select(F.col(doc_id).alias("doc_id"), fingerprint_column(docs[text]).alias("print")), "fingerprints")
    found = cluster(rows, "doc_id", "print")
    hexed = F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint")
    return rows.join(found, "print").select("doc_id", hexed, "component_id")


# One document of each group of similar texts


#: Similar texts share so many percent of their distinct shingles of so many words.
SIMILAR_SHINGLE, SIMILAR_PERCENT = 5, 80
#: Words of the shingles behind a wide fingerprint, and its 64-bit words.
WIDE_SHINGLE, WIDE_WORDS = 2, 8
#: Posting lists of a wide fingerprint, and the equal bytes that each is keyed by.
WIDE_LISTS, WIDE_KEY = 128, 3
#: What similar texts' wide fingerprints hardly ever fall short of.
WIDE_BITS, WIDE_SHARED = 118, 6


def wide_fingerprint(hashes: np.ndarray, words: int = WIDE_WORDS) -> bytes:
    """The majority of every bit over a set of shingle hashes, each spread to ``words`` 64-bit words."""
    salt = verified.mixed(np.arange(1, words + 1, dtype=np.uint64))
    votes = np.zeros(64 * words, np.int64)
    for k in range(0, len(hashes), COUNTED // 64):
        spread = verified.mixed(hashes[k : k + COUNTED // 64, None] ^ salt)
        bits = np.unpackbits(spread.view(np.uint8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * votes > len(hashes), bitorder="little").tobytes()


@lru_cache(maxsize=1)
def wide_positions() -> np.ndarray:
    """The byte positions that each posting list is keyed by."""
    rng = np.random.default_rng(SEED)
    return np.stack([rng.choice(8 * WIDE_WORDS, WIDE_KEY, replace=False) for _ in range(WIDE_LISTS)])


def wide_keys(code: Column) -> Column:
    @F.arrow_udf("array<long>")
    def keys(codes: pa.Array) -> pa.Array:
        held = codes.drop_null().to_pylist()
        matrix = np.frombuffer(b"".join(held), np.uint8).reshape(len(held), -1) if held else np.zeros((0, 8 * WIDE_WORDS), np.uint8)
        key = np.zeros((len(held), WIDE_LISTS), np.int64)
        for at in wide_positions().T:
            key = key << 8 | matrix[:, at]
        key = key * WIDE_LISTS + np.arange(WIDE_LISTS)
        rows = iter(key)
        return pa.array([next(rows) if x else None for x in codes.is_valid().to_pylist()], pa.list_(pa.int64()))

    return keys(code)


SIGNED = "struct<size:long,digest:binary,code:binary>"


def similar_signature(text: Column, shingle: int) -> Column:
    @F.arrow_udf(SIGNED)
    def signatures(texts: pa.Array) -> pa.Array:
        sizes, digests, codes = [], [], []
        for x in texts:
            hashes = verified.shingle_set(x.as_py(), shingle)
            sizes.append(len(hashes))
            digests.append(verified.set_digest(hashes))
            codes.append(wide_fingerprint(verified.shingle_set(x.as_py(), WIDE_SHINGLE)) if len(hashes) else None)
        columns = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(codes, pa.binary())]
        return pa.StructArray.from_arrays(columns, names=["size", "digest", "code"])

    return signatures(text)


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SIMILAR_SHINGLE, percent: int = SIMILAR_PERCENT
) -> DataFrame:
    """The rows that remain when every group of similar texts keeps one.

    Texts are linked if they share at least ``percent`` percent of their distinct shingles of
    ``shingle`` words, and groups are what links connect.  Candidates come from wide
    fingerprints: a posting list for each of ``WIDE_LISTS`` sets of byte positions,
    pairs with fewer shared bytes or more differing bits than similar texts have are
    dropped, the others are confirmed on the texts' full sets.  64 bits do not
    suffice here, as texts at the threshold differ in a seventh of them.  Texts
    without a word are copies of each other.

    That row stays that has the smallest id, ids before nulls; of several rows with that
    id in its group of equal sets, the one with the smallest content hash.
    """
    shipped(docs.sparkSession)
    own, digest, smallest, times, place = unused(docs, "own_class", "kept_digest", "kept_id", "kept_times", "kept_place")
    signed = docs.withColumn(own, similar_signature(docs[text], shingle))
    mine = F.struct(f"{own}.*", verified.text_key(F.col(text)).alias("text_key"), F.col(doc_id).cast("long").alias("id"))
    held = written(signed.withColumn(own, mine), "signed")
    classes = held.select(f"{own}.*").groupBy("digest").agg(
        F.min("id").alias("smallest"),
        F.min("text_key").alias("text_key"),
        F.first("size").alias("size"),
        F.first("code").alias("code"),
    )
    classes = written(classes.withColumn("node", verified.node_column(F.col("smallest"), F.col("digest"))), "classes")
    rule = verified.Rule(shingle, percent, WIDE_BITS, WIDE_SHARED)
    found = verified.component_of(classes, wide_keys(F.col("code")), held.select(F.col(text).alias("text")), rule)
    first = classes.join(found, "node", "left").filter("component is null or component = node")
    first = first.select(F.col("digest").alias(digest), F.col("smallest").alias(smallest))
    match = (F.col(f"{own}.digest") == F.col(digest)) & F.col(f"{own}.id").eqNullSafe(F.col(smallest))
    counted = held.select(own).join(first, match).groupBy(digest, smallest).agg(F.count("*").alias(times))
    counted = written(counted, "kept")
    columns = [f"`{c}`" for c in docs.columns]
    kept = held.join(counted, match)
    out = kept.filter(F.col(times) == 1).select(*columns)
    if not counted.filter(F.col(times) > 1).isEmpty():
        order = Window.partitionBy(digest, smallest).orderBy(F.xxhash64(*columns))
        repeated = kept.filter(F.col(times) > 1).withColumn(place, F.row_number().over(order))
        out = out.unionByName(repeated.filter(F.col(place) == 1).select(*columns))
    return out
