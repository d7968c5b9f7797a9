"""Signals by their definition, shrunk verdicts on hosts, and both SQL twins."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from checks.compare import compare, connect
from conftest import SMALL

from quotewright.llm import quality, registry


def by_definition(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None, "", " \t\r\n", "one", "a b c a b c", "a a a a a a", "a b c d a b c", "x\x0by\x0cz\x1cw\x85v\xa0u", "l\n l\nl\n\n\nl", "é # 😀 ** ||| <b>&",
    "p q r " * 40, "\n".join(["same line here"] * 60), " ".join(f"w{k}" for k in range(3000)) * 2,
]


def test_signals_of_odd_texts(spark):
    docs = spark.createDataFrame([(k, t, "w") for k, t in enumerate([*TEXTS, TEXTS[4]])], "doc_id int, text string, words_ string")
    rows = {r.doc_id: r for r in quality.add_signals(docs).collect()}
    assert len(rows) == len(TEXTS) + 1
    for k, text in enumerate([*TEXTS, TEXTS[4]]):
        found = tuple(rows[k][c] for c in quality.SIGNALS)
        assert found == by_definition(text), text
        assert rows[k].base_failed == (found[0] < 50 or 100 * found[4] > 50 * found[0])
        assert rows[k].words_ == "w"


@pytest.mark.parametrize("name", ["op9_host_reputation", "op10_host_rules"])
def test_whole_table_agrees_with_sql(spark, name):
    assert compare(registry.QUERIES[name](spark, SMALL), connect(SMALL), registry.ORACLES[name]) == ""


def test_whole_table_by_definition(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = registry.op10_host_rules(spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(tuple(r[c] for c in quality.SIGNALS) == by_definition(docs[r.doc_id]) for r in rows)
    assert not any(r.base_failed and r.kept for r in rows)


CLEAN = " ".join(f"word{k}" for k in range(60))
JUNK = " ".join(f"w{k}***" for k in range(60))


def test_bad_hosts_lose_their_doubtful_documents_only(spark):
    rows = [("bad", JUNK)] * 95 + [("bad", CLEAN)] * 5 + [("good", CLEAN)] * 95 + [("good", JUNK)] * 5
    rows += [("tiny", JUNK), (None, CLEAN), (None, CLEAN), (None, "short")] + [(f"h{k}", CLEAN) for k in range(20)]
    docs = spark.createDataFrame([(k, *r, "v") for k, r in enumerate(rows)], "doc_id int, source string, text string, host string")
    judged = quality.judge(quality.add_signals(docs)).collect()
    assert len(judged) == len(rows)
    for r in judged:
        expected = r.text == CLEAN or (r.text == JUNK and r.source != "bad")
        assert r.kept == expected, (r.source, r.text[:10], r.host_rate)
        assert r.host == "v"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id int, source string, text string")
    assert quality.judge(quality.add_signals(docs)).count() == 0


def test_prior_by_moments(spark):
    equal = spark.createDataFrame([(100, 10)] * 50, "n long, f long")
    mean, strength = quality.beta_prior(equal, "n", "f")
    assert mean == pytest.approx(0.1) and strength == pytest.approx(1 / quality.MIN_RHO - 1)
    apart = spark.createDataFrame([(100, 0)] * 50 + [(100, 100)] * 50, "n long, f long")
    mean, strength = quality.beta_prior(apart, "n", "f")
    assert mean == pytest.approx(0.5) and strength == pytest.approx(1 / quality.MAX_RHO - 1)


def test_no_python_on_the_main_path(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = quality.judge(quality.add_signals(docs))._jdf.queryExecution().toString()
    signals = quality.add_signals(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan + signals)
