"""Encoding, decoding and counting against the libraries themselves."""

from __future__ import annotations

import hashlib
import random
import time

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quotewright.llm import bpe, registry, token_counts, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
EDGES = [
    "", " ", "  ", "\n", "a", "'s", " 's", "\n's x", "'S 's's", "it's we'll they've I'd 're 'tis", "''s", "!'s", "1's",
    "a  b", "a \n b", "a b", "　　a", "  x", "x  ", "tab\t\tend\t", "<|endoftext|>", "x<|endoftext|>  <|endoftext|>y",
    "a  <|endoftext|> b", "<|endoftext|", "é漢字😀 ½²٣ ǅ ́", "\x00\x01", "𐐀𐐁 \U0001f9d1‍\U0001f4bb", "_a_b_", "ab" * 3000, "=" * 5000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    pool = ["'s", "'", "re", "'re", " ", "  ", "\n", "\t", "a", "The", "1", "<|endoftext|>", "é", "　", "!", "ing", "😀"]
    mixed = ["".join(rng.choices(pool, k=rng.randrange(25))) for _ in range(1500)]
    real = [r[0] for r in duckdb.sql(f"select text from read_parquet('{SMALL}/documents.parquet')").fetchall()]
    return EDGES + mixed + real


def encoded(texts):
    out = []
    for first, ids in bpe.load(PATH).encode(pa.array(texts, pa.string())):
        out += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    return out


def test_ids_are_the_librarys(library, texts):
    assert encoded(texts) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_the_librarys(library, texts):
    counts = bpe.load(PATH).counts(pa.array([*texts, None], pa.string())).tolist()
    assert counts == [len(x.ids) for x in library.encode_batch([*texts, ""], add_special_tokens=False)]


def test_words_that_fail_the_check_are_merged_exactly():
    """Both ways in isolation: pairs of a valid word are compatible, others aren't."""
    codec = bpe.load(PATH)
    words = [b" tokenization", b" therehood", b"aaaaaaa", b"nnnnnn", b" underseaunder"]
    data = np.frombuffer(b"".join(words), np.uint8)
    edges = np.cumsum([0, *map(len, words)])
    count, exact = codec._merge(data, edges[:-1], edges[1:])
    owner = np.repeat(np.arange(len(words)), count)
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    assert codec._compatible(exact[inner], exact[inner + 1]).all()
    greedy_count, greedy = codec._propose(data, edges[:-1], edges[1:])
    for k in range(len(words)):
        mine = greedy[np.repeat(np.arange(len(words)), greedy_count) == k]
        good = codec._compatible(mine[:-1], mine[1:]).all()
        assert good == (mine.tolist() == exact[owner == k].tolist())


def test_key_table_finds_all_and_nothing_else():
    keys = np.random.default_rng(1).choice(1 << 40, 5000, replace=False)
    table = bpe.KeyTable(keys[:3000], np.arange(3000, dtype=np.int32))
    assert table.get(keys[:3000]).tolist() == list(range(3000))
    assert (table.get(keys[3000:]) == -1).all()


def test_other_vocabularies_are_refused():
    with pytest.raises(bpe.Unsupported):
        bpe.ByteBpe(public_tokenizers.path("word_bpe_49k.json"))


def test_columns_round_trip(spark, library):
    rows = [(k, t, "x") for k, t in enumerate(EDGES)] + [(None, None, None), (0, "", "y"), (0, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids_ string")
    out = tokens.decode(tokens.encode(docs, PATH), PATH).collect()
    assert len(out) == len(rows)
    for row in out:
        expected = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == expected
        assert row.decoded == (row.text or "") == library.decode(expected, skip_special_tokens=False)


def test_decoding_what_is_no_text(spark):
    ids = spark.createDataFrame([([50256, 7, 99999, -1, 171],), (None,), ([],)], "ids array<int>")
    library = Tokenizer.from_file(PATH)
    assert [r.decoded for r in tokens.decode(ids, PATH).collect()] == [library.decode([50256, 7, 171], skip_special_tokens=False), "", ""]


def test_op7_whole_table(spark, library):
    found = {r.doc_id: r for r in registry.op7_bpe(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(found) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text or "", add_special_tokens=False).ids
        row = found[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op8_whole_table(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = registry.op8_digest_cache(spark, SMALL).collect()
    expected = {k: (len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for k, t in docs.items()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in found} == expected
    assert all(r.over_limit == (r.n_tokens > 1024) for r in found)


def test_cache_encodes_only_distinct_misses(spark, tmp_path, library):
    cache = str(tmp_path / "cache")
    schema = "n_tokens string, content_digest string, text string"
    first = spark.createDataFrame([("x", "a", t) for t in ["one two", "one two", "", None, "three"]], schema)
    out = token_counts.count_tokens(first, cache, PATH)
    assert sorted((r.text or "", r.n_tokens, r.content_digest) for r in out.collect()) == sorted(
        (t, len(library.encode(t, add_special_tokens=False).ids), "a") for t in ["one two", "one two", "", "", "three"]
    )
    assert spark.read.parquet(cache).count() == 3
    # a stored count is used as it is: nothing known is encoded again
    spark.createDataFrame(
        [(hashlib.sha256(b"four").hexdigest(), token_counts.tokenizer_digest(PATH), 77)], token_counts.CACHE
    ).write.mode("append").parquet(cache)
    second = first.unionByName(spark.createDataFrame([("x", "b", "four"), ("x", "b", "five")], schema))
    out = token_counts.count_tokens(second, cache, PATH)
    assert out.count() == 7
    assert out.filter("text = 'four'").first().n_tokens == 77
    assert spark.read.parquet(cache).count() == 5


def test_cache_tells_tokenizers_apart(spark, tmp_path):
    cache, words = str(tmp_path / "cache"), ["Hello there, World", "", "tokens  and\nlines"]
    docs = spark.createDataFrame([(w,) for w in words], "text string")
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"):
        path = public_tokenizers.path(name)
        if name.endswith(".model"):
            piece = sentencepiece.SentencePieceProcessor(model_file=path)
            expected = {w: len(piece.encode(w)) for w in words}
        else:
            own = Tokenizer.from_file(path)
            own.no_truncation()
            expected = {w: len(own.encode(w, add_special_tokens=False).ids) for w in words}
        assert {r.text: r.n_tokens for r in token_counts.count_tokens(docs, cache, path).collect()} == expected
    assert spark.read.parquet(cache).groupBy("tokenizer_digest").count().filter(F.col("count") == 3).count() == 3


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.decode(tokens.encode(docs, PATH), PATH).count() == 0
    assert token_counts.count_tokens(docs, str(tmp_path / "cache"), PATH).count() == 0


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "AbcXYZ", "etaoinshr", "a", "日本語のテキスト"])
def test_long_words_in_pieces(letters):
    """Words without a space of every length around the pieces' borders, against the library."""
    rng = random.Random(len(letters))
    texts = ["".join(rng.choice(letters) for _ in range(n)) for n in (255, 256, 257, 288, 289, 511, 1000, 4097, 20_000)]
    texts.append(" ".join(texts))
    found = [ids[a:b].tolist() for first, ids in bpe.load(PATH).encode(pa.array(texts)) for a, b in zip(first[:-1], first[1:], strict=True)]
    assert found == [Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids for t in texts]


def test_a_word_of_a_megabyte_takes_seconds():
    rng = random.Random(4)
    word = pa.array(["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))])
    start = time.process_time()
    assert bpe.load(PATH).counts(word).sum() > 100_000
    assert time.process_time() - start < 20
