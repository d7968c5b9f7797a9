"""Links between texts that share most of their word shingles: candidates from posting
lists of compact codes, confirmed on the texts' whole shingle sets.

A class is one distinct set of shingles with a code (a bitmap) and some keys.  Classes that
share a key lie in one posting list.  In a list the codes are compared; pairs whose codes
and sizes can still belong to linked sets are candidates.  No list writes out all of its
candidates: it passes on a spanning forest of them, nearest codes first, whose pairs are
confirmed on full sets.  So all candidates of all lists lie inside families, the components of what
the forests connect, and most families are one component of confirmed links by then.  In the others
the members outside the largest component are compared with all: codes first, then full sets
by one product of matrices a block, of which again only a spanning forest of links is passed on.
So every candidate is confirmed, refused, or inside a component already.

A list over ``LIST_ROWS`` is cut into blocks that pass on forests of their own, and its members are one family.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.common import written
from quotewright.llm.components import components
from quotewright.operators.chunks import small_side

#: Classes compared with each other in one piece.
LIST_ROWS = 2048
#: Members of a cell that ask at once, and hashes whose holders are counted at once.
ASKING, HASHES_AT_ONCE = 256, 2048
#: So many pairs of sets are compared one by one.
FEW_PAIRS = 64
#: Pairs that one copy of a text is sent for.
HUB_PAIRS = 4096
#: Classes whose connections a task holds.
NODES_HELD = 1 << 18
#: Distinct words whose hashes a worker keeps.
WORDS_KEPT = 1 << 16
#: From so many equal rows on, a key is joined by broadcast; there are at most rows / HOT_ROWS of these.
HOT_ROWS = 100_000
HOT_KEYS = 100_000

#: Lists whose distances are held all at once.
TABLE_ROWS = 256

_FAR, _DONE = np.int32(1 << 30), np.int32((1 << 30) + 1)


class Rule(NamedTuple):
    """When two classes are linked, and which pairs of codes are worth the question."""

    shingle: int
    percent: int
    most_bits: int
    #: Equal bytes at equal places that a pair of codes has at least.
    shared_bytes: int = 0
    list_rows: int = LIST_ROWS


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Hashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles: A-Z lowered, words parted by
    ASCII white space; fewer words make one shingle, none an empty set."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(shingle, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(out)])
    return np.unique(out)


def set_digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def node_column(smallest: Column, digest: Column) -> Column:
    """A class's name: its smallest id (missing ones last) and part of its digest, so that
    names sort by that id and the smallest name of a component holds its smallest id."""
    flag = F.when(smallest.isNull(), F.lit("01")).otherwise(F.lit("00"))
    unsigned = F.coalesce(smallest, F.lit(0)).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    return F.unhex(F.concat(flag, F.lpad(F.hex(unsigned), 16, "0"), F.substring(F.hex(digest), 1, 16)))


def node_id(node: Column) -> Column:
    """The id that a name holds."""
    number = F.conv(F.substring(F.hex(node), 3, 16), 16, -10).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    return F.when(F.substring(F.hex(node), 1, 2) == "00", number)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.encode(F.coalesce(text, F.lit("")), "UTF-8")))


# Lists


class Members(NamedTuple):
    """The members of a list in order of their nodes."""

    words: np.ndarray
    sizes: np.ndarray
    groups: np.ndarray


def distances(m: Members, rows: np.ndarray, rule: Rule) -> np.ndarray:
    """Differing bits of some members' codes from all members', ``_FAR`` where no link is possible."""
    bits = np.zeros((len(rows), len(m.words)), np.int32)
    shared = np.zeros((len(rows), len(m.words)), np.int32)
    for w in range(m.words.shape[1]):
        apart = m.words[rows, w, None] ^ m.words[None, :, w]
        bits += np.bitwise_count(apart)
        if rule.shared_bytes:
            shared += (apart.view(np.uint8).reshape(*apart.shape, 8) == 0).sum(axis=2, dtype=np.int32)
    own = m.sizes[rows, None]
    far = (bits > rule.most_bits) | (100 * np.minimum(own, m.sizes) < rule.percent * np.maximum(own, m.sizes))
    bits[far | (shared < rule.shared_bytes)] = _FAR
    return bits


def forest(m: Members, rule: Rule) -> np.ndarray:
    """Pairs of a spanning forest of a list's candidates, nearest codes first (Prim's rule)."""
    count = len(m.words)
    every = np.arange(count)
    table = distances(m, every, rule) if count <= TABLE_ROWS else None
    near = np.full(count, _FAR)
    parent = np.zeros(count, np.int64)
    edges = []
    v = 0
    for _ in range(count - 1):
        near[v] = _DONE
        reach = distances(m, every[v : v + 1], rule)[0] if table is None else table[v]
        closer = reach < near
        closer &= near < _DONE
        near[closer], parent[closer] = reach[closer], v
        v = int(near.argmin())
        if near[v] < _FAR:
            edges.append((parent[v], v))
    return np.sort(np.array(edges, np.int64).reshape(-1, 2), axis=1)


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set on the left shares with each on the right; the sets are sorted."""
    if len(left) * len(right) <= FEW_PAIRS:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left]).reshape(len(left), -1)
    found = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.float32)
    for k in range(0, len(found), HASHES_AT_ONCE):
        part = found[k : k + HASHES_AT_ONCE]
        sides = []
        for sets in (left, right):
            held = np.zeros((len(sets), len(part)), np.float32)
            for row, x in enumerate(sets):
                x = x[np.searchsorted(x, part[0]) : np.searchsorted(x, part[-1], "right")]
                at = np.searchsorted(part, x)
                held[row, at[part[at] == x]] = 1
            sides.append(held)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def cross_links(m: Members, sets: list[np.ndarray], asks: np.ndarray, asked: np.ndarray, rule: Rule) -> list[tuple[int, int]]:
    """Links between those who ask and those who are asked, of different groups: a spanning forest."""
    group = m.groups.copy()
    out: list[tuple[int, int]] = []
    rows = np.flatnonzero(asks)
    for k in range(0, len(rows), ASKING):
        part = rows[k : k + ASKING]
        near = (distances(m, part, rule) < _FAR) & asked & (group[part, None] != group)
        who, whom = part[near.any(axis=1)], np.flatnonzero(near.any(axis=0))
        if not len(who):
            continue
        both = shared_counts([sets[x] for x in who], [sets[x] for x in whom])
        linked = 100 * both >= rule.percent * (m.sizes[who, None] + m.sizes[whom] - both)
        linked &= near[np.ix_(near.any(axis=1), whom)]
        for a, b in zip(*(x.tolist() for x in np.nonzero(linked)), strict=True):
            a, b = int(who[a]), int(whom[b])
            if group[a] != group[b]:
                group[group == group[b]] = group[a]
                out.append((a, b))
    return out


#: what: 0 a pair, 1 a list too large for one piece.
FOUND = "key long, a binary, b binary, what int"
_PAIR, _LARGE = 0, 1


def _found(keys: pa.Array, a: pa.Array, b: pa.Array, what: int) -> pa.RecordBatch:
    kind = pa.array(np.full(len(keys), what, np.int32))
    return pa.RecordBatch.from_arrays([keys, a, b, kind], names=["key", "a", "b", "what"])


def _codes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(len(column), -1)


def _list(table: pa.Table, rule: Rule) -> pa.RecordBatch:
    """The forest that one list passes on."""
    table = table.sort_by("node")
    members = Members(_codes(table.column("code")), table.column("size").to_numpy(), np.arange(table.num_rows))
    pairs, nodes = forest(members, rule), table.column("node").combine_chunks()
    a, b = (nodes.take(pa.array(x)) for x in pairs.T)
    return _found(pa.array(np.full(len(pairs), table.column("key")[0].as_py(), np.int64)), a, b, _PAIR)


def _twos(table: pa.Table, at: np.ndarray, rule: Rule) -> pa.RecordBatch:
    """The candidates of lists of two members, which most lists are, all at once."""
    first, second = table.take(pa.array(at)), table.take(pa.array(at + 1))
    words = _codes(first.column("code")) ^ _codes(second.column("code"))
    n, m = first.column("size").to_numpy(), second.column("size").to_numpy()
    near = np.bitwise_count(words).sum(axis=1, dtype=np.int32) <= rule.most_bits
    near &= (words.view(np.uint8) == 0).sum(axis=1) >= rule.shared_bytes
    near &= 100 * np.minimum(n, m) >= rule.percent * np.maximum(n, m)
    first, second = (x.filter(pa.array(near)).combine_chunks() for x in (first, second))
    a, b = first.column("node").combine_chunks(), second.column("node").combine_chunks()
    ahead = pc.less(a, b)
    return _found(first.column("key").combine_chunks(), pc.if_else(ahead, a, b), pc.if_else(ahead, b, a), _PAIR)


def _lists(rule: Rule):
    """Lists in order of their keys, one after another; of one that is too large no more is
    held than shows that, unless it is a block of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            edges = _edges(table, ("key", "block"))
            yield from _compared(table, edges[:-1], rule)
            rest = table.slice(edges[-2])
            if rest.num_rows > rule.list_rows and rest.column("block")[0].as_py() < 0:
                rest = rest.slice(0, rule.list_rows + 1)
        if rest is not None:
            yield from _compared(rest, _edges(rest, ("key", "block")), rule)

    return run


def _edges(table: pa.Table, columns: tuple[str, ...]) -> np.ndarray:
    new = np.zeros(table.num_rows - 1, bool)
    for c in columns:
        new |= np.diff(table.column(c).to_numpy()) != 0
    return np.concatenate([[0], np.flatnonzero(new) + 1, [table.num_rows]])


def _compared(table: pa.Table, edges: np.ndarray, rule: Rule) -> Iterator[pa.RecordBatch]:
    starts, sizes = edges[:-1], np.diff(edges)
    whole = table.column("block").to_numpy()[starts] < 0
    if (sizes == 2).any():
        yield _twos(table, starts[sizes == 2], rule)
    for at, size, undealt in zip(starts.tolist(), sizes.tolist(), whole.tolist(), strict=True):
        if size > rule.list_rows and undealt:
            nothing = pa.nulls(1, pa.binary())
            yield _found(table.column("key").slice(at, 1).combine_chunks(), nothing, nothing, _LARGE)
        elif size > 2:
            yield _list(table.slice(at, size).combine_chunks(), rule)


def _search(members: DataFrame, rule: Rule, name: str) -> DataFrame:
    columns = members.select("key", "block", "node", "size", "code")
    together = columns.repartition("key", "block").sortWithinPartitions("key", "block")
    return written(together.mapInArrow(_lists(rule), FOUND), name)


def shared_keys(classes: DataFrame, keys: Column) -> DataFrame:
    """(key, short) of the keys that several classes have, saved.

    Most keys belong to one class: these are dropped before codes are moved, by a sort of
    two numbers a key and a look at the neighbours.
    """
    each = classes.select(F.explode(keys).alias("key"), F.xxhash64("node").alias("short"))
    beside = Window.partitionBy("key").orderBy("short")
    near = [F.lag(F.lit(True)).over(beside).alias("before"), F.lead(F.lit(True)).over(beside).alias("behind")]
    return written(each.select("key", "short", *near).filter("before or behind").select("key", "short"), "shared_keys")


def _members(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of lists; two classes of one short name only make members that no confirmation links."""
    coded = classes.select(F.xxhash64("node").alias("short"), "node", "size", "code")
    return shared.join(coded, "short").select("key", "node", "size", "code")


def _blocks(members: DataFrame, list_rows: int) -> DataFrame:
    """Large lists cut into blocks."""
    counted = members.groupBy("key").agg(F.ceil(F.count("*") / (list_rows // 2)).alias("blocks"))
    dealt = members.join(written(counted, "blocks"), "key")
    return dealt.withColumn("block", F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int"))


# Confirmation


def _judged(rule: Rule):
    """Of rows (hub, salt, other, text), the hub's own text first, whether each other is linked to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            hubs, others, linked = [], [], []
            for h, other, text in zip(batch.column("hub").to_pylist(), batch.column("other").to_pylist(), batch.column("text"), strict=True):
                hashes = shingle_set(text.as_py(), rule.shingle)
                if other is None:
                    hub, own = h, hashes
                    continue
                both = len(np.intersect1d(own, hashes, assume_unique=True))
                hubs.append(hub)
                others.append(other)
                linked.append(100 * both >= rule.percent * (len(own) + len(hashes) - both))
            a, b = pa.array(hubs, pa.binary()), pa.array(others, pa.binary())
            ahead = pc.less(a, b)
            columns = [pc.if_else(ahead, a, b), pc.if_else(ahead, b, a), pa.array(linked, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "linked"])

    return run


def verdicts(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """(a, b, linked) of distinct pairs, saved.

    A pair meets at the one of its classes that has more pairs, whose text is sent once for
    ``HUB_PAIRS`` of them, so that a long text with many pairs is not repeated with each.
    """
    degree = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("pairs"))
    degree = written(degree, "degrees")
    of = lambda c: degree.select(F.col("node").alias(c), F.struct("pairs", F.col("node").alias("name")).alias(f"{c}_rank"))
    ranked = pairs.join(of("a"), "a").join(of("b"), "b")
    hub, other = F.greatest("a_rank", "b_rank"), F.least("a_rank", "b_rank")
    salt = F.pmod(F.xxhash64(other["name"]), F.ceil(hub["pairs"] / HUB_PAIRS)).cast("int")
    met = written(ranked.select(hub["name"].alias("hub"), salt.alias("salt"), other["name"].alias("other")), "met")
    nothing = F.lit(None).cast("binary")
    first = met.select("hub", "salt").distinct().join(texts.withColumnRenamed("node", "hub"), "hub")
    rest = met.join(texts.withColumnRenamed("node", "other"), "other")
    rows = first.select("hub", "salt", nothing.alias("other"), "text").unionByName(rest.select("hub", "salt", "other", "text"))
    ordered = rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.asc_nulls_first("other"))
    return written(ordered.select("hub", "other", "text").mapInArrow(_judged(rule), "a binary, b binary, linked boolean"), "verdicts")


def texts_of(nodes: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, text) of some classes, saved; ``texts`` has one column, ``text``."""
    keys = written(nodes.join(classes.select("node", "text_key"), "node"), "text_keys")
    keyed = texts.select(text_key(F.col("text")).alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    wanted = keyed.join(small_side(keys.select("text_key"), keys.count()), "text_key", "left_semi")
    wanted = wanted.groupBy("text_key").agg(F.first("text").alias("text"))
    return written(wanted.join(keys, "text_key").select("node", "text"), "texts")


# Families


def spanning(pairs: DataFrame) -> DataFrame:
    """Fewer (a, b) that connect the same: each task passes on what joins something new to it.

    Lists of one family give many pairs between the same classes; their components need only
    a forest of them.  A task that has met ``NODES_HELD`` classes forgets them and goes on.
    """

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[bytes, bytes] = {}

        def root(x: bytes) -> bytes:
            parent.setdefault(x, x)
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for batch in batches:
            if len(parent) > NODES_HELD:
                parent.clear()
            kept = []
            for k, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)):
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    kept.append(k)
            yield batch.take(pa.array(kept, pa.int64()))

    return pairs.select("a", "b").mapInArrow(thin, "a binary, b binary")


def _in_cells(rule: Rule):
    """Cells one after another: links between who asks and who is asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = _hashed(batch, rule)
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            edges = _edges(table, ("cell", "i", "j"))
            for at, end in zip(edges[:-2].tolist(), edges[1:-1].tolist(), strict=True):
                yield _cell_links(table.slice(at, end - at).combine_chunks(), rule)
            rest = table.slice(edges[-2])
        if rest is not None:
            yield _cell_links(rest.combine_chunks(), rule)

    return run


def _hashed(batch: pa.RecordBatch, rule: Rule) -> pa.Table:
    """The rows with their shingle sets in place of their texts."""
    sets = pa.array([shingle_set(x.as_py(), rule.shingle).tobytes() for x in batch.column("text")], pa.large_binary())
    kept = [c for c in batch.schema.names if c != "text"]
    return pa.Table.from_batches([batch]).select(kept).append_column("set", sets)


def _cell_links(cell: pa.Table, rule: Rule) -> pa.RecordBatch:
    cell = cell.sort_by([("node", "ascending"), ("side", "ascending")])
    names, sides = cell.column("node").to_pylist(), cell.column("side").to_numpy()
    first = np.array([k for k in range(len(names)) if not k or names[k] != names[k - 1]])
    asks, asked = np.maximum.reduceat(sides, first) == 1, sides[first] == 0  # who does both is there twice
    cell = cell.take(pa.array(first))
    labels: dict[bytes, int] = {}
    groups = np.array([labels.setdefault(x, len(labels)) for x in cell.column("component").to_pylist()])
    members = Members(_codes(cell.column("code")), cell.column("size").to_numpy(), groups)
    sets = [np.frombuffer(x, np.uint64) for x in cell.column("set").to_pylist()]
    nodes = cell.column("node").combine_chunks()
    pairs = np.sort(np.array(cross_links(members, sets, asks, asked, rule), np.int64).reshape(-1, 2), axis=1)
    a, b = (nodes.take(pa.array(x)) for x in pairs.T)
    return pa.RecordBatch.from_arrays([a, b], names=["a", "b"])


def _cells(families: DataFrame, rule: Rule) -> DataFrame:
    """A block of the members outside their family's largest component (side 1) with a block of
    all (side 0): (cell, i, j, side, node, size, code, component, text)."""
    groups = families.groupBy("family", "component").agg(F.count("*").alias("n"))
    largest = groups.groupBy("family").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"), F.sum("n").alias("n"), F.max("n").alias("most")
    )
    blocks = lambda c: F.ceil(c / (rule.list_rows // 2)).cast("int")
    sized = largest.select("family", "largest", blocks(F.col("n") - F.col("most")).alias("askers"), blocks(F.col("n")).alias("all"))
    dealt = families.join(written(sized, "sized"), "family")
    own = [F.xxhash64("family").alias("cell"), "node", "size", "code", "component", "text"]
    block = lambda c: F.pmod(F.xxhash64("node"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    asking = dealt.filter("component <> largest").select(*own, block("askers").alias("i"), "all")
    asking = asking.withColumn("j", every("all")).withColumn("side", F.lit(1)).drop("all")
    asked = dealt.select(*own, block("all").alias("j"), "askers").withColumn("i", every("askers"))
    return asking.unionByName(asked.withColumn("side", F.lit(0)).drop("askers"))


def component_of(classes: DataFrame, keys: Column, texts: DataFrame, rule: Rule) -> DataFrame:
    """(node, component) of the classes that have a link.

    ``classes`` is saved, with node, text_key, size (of the set), code and what ``keys`` is made
    of; ``texts`` holds the texts themselves, those of every ``text_key``.
    """
    shared = shared_keys(classes, keys)
    found = _search(_members(shared, classes).withColumn("block", F.lit(-1)), rule, "candidates")
    large = found.filter(F.col("what") == _LARGE).select("key")
    together = None
    if not large.isEmpty():
        members = written(_members(shared.join(large, "key"), classes), "large_lists")
        found = found.unionByName(_search(_blocks(members, rule.list_rows), rule, "large_candidates"))
        first = members.groupBy("key").agg(F.min("node").alias("a"))
        together = members.join(first, "key").select("a", F.col("node").alias("b")).filter("a <> b")
    pairs = written(found.filter(F.col("what") == _PAIR).select("a", "b").distinct(), "pairs")
    connected = pairs if together is None else pairs.unionByName(together)
    named = connected.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    kept_texts = texts_of(named, classes, texts)
    answers = verdicts(pairs, kept_texts, rule)
    links = answers.filter("linked").select("a", "b")
    joined = written(components(spanning(links)), "components")
    if together is None and answers.filter("not linked").isEmpty():
        return joined
    families = components(spanning(connected)).withColumnRenamed("component", "family").join(joined, "node", "left")
    families = written(families.withColumn("component", F.coalesce("component", "node")), "families")
    open_ = families.groupBy("family").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    unfinished = families.join(open_.filter("least <> most").select("family"), "family", "left_semi")
    coded = unfinished.join(classes.select("node", "size", "code"), "node").join(kept_texts, "node")
    cells = _cells(coded, rule).repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    more = written(cells.mapInArrow(_in_cells(rule), "a binary, b binary"), "more_links")
    return joined if more.isEmpty() else components(spanning(links.unionByName(more)))


def with_class(rows: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """Rows with the columns of their class; ``classes`` counts its rows as ``rows``.

    Classes of very many rows are few; they are broadcast after counting them, so that none
    of them gathers its rows in one task.
    """
    plain = classes.drop("rows")
    is_hot = F.col("rows") > HOT_ROWS
    many = classes.filter(is_hot).count()
    if not 0 < many <= HOT_KEYS:
        return rows.join(plain, key)
    hot = F.broadcast(classes.filter(is_hot).drop("rows"))
    rest = rows.join(hot.select(key), key, "left_anti").join(classes.filter(~is_hot).drop("rows"), key)
    return rows.join(hot, key).unionByName(rest)
