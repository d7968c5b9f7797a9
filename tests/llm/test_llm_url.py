"""Rules and reputations of hosts."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from quotewright.llm import html_text, registry
from quotewright.llm import url_reputation as ur


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    best = None
    for verdict, rule in registry.RULES:
        own, slash, prefix = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + prefix) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best or (None, None)


URLS = [
    None, "", "no scheme.org/", "http://", "https://A.Example.ORG", "http://x.example.org/es/1?q=://z", "http://example.org/en/17#top",
    "http://example.org/en/2", "http://notexample.org/es/1", "http://a.com/fr/x", "http://a.com/FR/x", "http://com/de/", "http://ÀB.net?x",
    "ftp://h.co.uk:80/p\nq?r", "x://y://z/org/", "http://a.com/de",
]


def test_hosts_paths_and_rules(spark):
    rows = spark.createDataFrame([(k, u, "v", "h") for k, u in enumerate([*URLS, URLS[4]])], "page_id int, url string, verdict string, rate string")
    hosts = spark.createDataFrame([], "host string, labelled long, bad_rate double, bad_bound double, blocked boolean")
    judged = ur.judge_urls(rows, hosts, registry.RULES)
    found = {r.page_id: r for r in judged.collect()}
    assert len(found) == len(URLS) + 1
    for k, url in enumerate([*URLS, URLS[4]]):
        host, path = parts(url)
        rule, verdict = rule_of(host, path)
        assert (found[k].host, found[k].path, found[k].rule, found[k].verdict) == (host, path, rule, verdict or "allow"), url
    assert ur.judge_urls(rows.limit(0), hosts, registry.RULES).count() == 0


def test_too_many_rules():
    with pytest.raises(ValueError, match="at most"):
        ur.rule_column(F.lit("a"), F.lit("/"), [("allow", f"h{k}/") for k in range(1001)])


def test_registered_domains(spark):
    hosts = ["", "com", "a.com", "x.y.a.com", "b.co.uk", "x.b.co.uk", "h.org:8080"]
    rows = spark.createDataFrame([(h,) for h in hosts], "host string")
    found = [tuple(r) for r in rows.select(*ur.domain_and_suffix(F.col("host"))).collect()]
    assert found == [("", ""), ("com", "com"), ("a.com", "com"), ("a.com", "com"), ("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("h.org", "org")]


def test_shrinking(spark):
    """Much evidence blocks, little doesn't; a host without any leans on its domain."""
    outcomes = [("big.bad.net", 500, 480), ("small.good.net", 2, 2), ("new.bad.net", 0, 0), ("other.bad.net", 300, 290)]
    outcomes += [(f"h{k}.good.net", 50, k % 3) for k in range(30)] + [("z.org", 100, 0), ("", 1, 0)]
    rows = spark.createDataFrame(outcomes, "host string, n long, bad long")
    found = {r.host: r for r in ur.reputations(rows).collect()}
    assert len(found) == len(outcomes)
    assert found["big.bad.net"].blocked and found["other.bad.net"].blocked
    assert not found["small.good.net"].blocked and not found["z.org"].blocked
    assert found["small.good.net"].bad_rate > found["h0.good.net"].bad_rate
    assert found["new.bad.net"].bad_rate > found["small.good.net"].bad_rate
    assert 0.9 < found["big.bad.net"].bad_rate < 0.97


def test_no_labels_block_nobody(spark):
    rows = spark.createDataFrame([("a.com", 0, 0), ("b.org", 0, 0)], "host string, n long, bad long")
    assert not any(r.blocked for r in ur.reputations(rows).collect())
    assert ur.reputations(rows.limit(0)).count() == 0


def test_outcomes_are_counted_by_content(spark):
    pages = spark.createDataFrame([("a", "k1"), ("a", "k1"), ("a", "k2"), ("b", "k3"), ("", None)], "host string, key string")
    labels = spark.createDataFrame([("k1", 1), ("k1", 1), ("k1", 0), ("k2", 0), ("k2", 1), ("zz", 1)], "key string, bad int")
    assert {tuple(r) for r in ur.host_outcomes(pages, labels).collect()} == {("a", 3, 2), ("b", 0, 0), ("", 0, 0)}


def test_op9_whole_table(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = registry.op9_host_reputation(spark, SMALL).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    verdicts = Counter()
    for r in rows:
        host, path = parts(pages[r.page_id])
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") and verdict in (None, r.verdict)
        verdicts[(r.host, r.rule is None, r.verdict)] += 1
    assert all((h, True, "block") not in verdicts for h, free, v in verdicts if free and v == "allow")


def test_outcomes_of_the_whole_table(spark):
    """Every page's main text looked up among the labelled documents' whole texts."""
    pages, docs, labels = (spark.read.parquet(f"{SMALL}/{x}.parquet") for x in ("pages", "documents", "labels"))
    bad = {r.doc_id: int(r.toxic == 1 or r.quality == 0) for r in labels.collect()}
    marks = {}
    for r in docs.collect():
        text = " ".join((r.text or "").split())
        if text:
            marks.setdefault(text, []).extend([bad[r.doc_id]] if r.doc_id in bad else [])
    counts = {}
    for r in pages.collect():
        title, body = html_text.title_and_body(r.html)
        whole, body = " ".join(f"{title} {body}".split()), " ".join(body.split())
        found = marks.get(whole if whole in marks else body, [])
        n, b = counts.get(parts(r.url)[0], (0, 0))
        counts[parts(r.url)[0]] = (n + bool(found), b + (2 * sum(found) > len(found)))
    assert {r.host: (r.n, r.bad) for r in registry.page_outcomes(pages, docs, labels).collect()} == counts
    assert sum(n for n, _ in counts.values()) > 20 and sum(b for _, b in counts.values()) > 2


def test_a_page_takes_the_label_of_its_whole_text_only(spark, tmp_path):
    """Texts that begin alike are different texts; a label of one says nothing about the others."""
    rest = " ".join(f"word{k}, said" for k in range(60))
    texts = {1: f"Same opening.\nBad {rest}", 2: f"Same opening.\nOther  {rest}", 3: f"Same opening.\nGood\t{rest}", 4: f"Own title\nLast {rest}"}
    good = {f"good{k}.net": ("A title", 3) for k in range(6)}
    shown = {**good, "borrows.net": ("A title", 2), "bad.net": ("A title", 1), "titled.net": ("Own title", 4)}
    pages = []
    for host, (title, doc_id) in shown.items():
        body = "".join(f"<p>{x}</p>" for x in texts[doc_id].removeprefix("Own title\n").split("\n"))
        page = f"<html><body><nav><a href='/'>home</a></nav><article class='post'><h1 id='t'>{title}</h1>\n<!-- x --><p> </p>{body}</article></body></html>"
        pages += [(f"https://{host}/{k}", page) for k in range(100)]
    spark.createDataFrame([(k, *r) for k, r in enumerate(pages)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(1, 0, 1), (3, 1, 0), (4, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    tables = [spark.read.parquet(f"{tmp_path}/{x}.parquet") for x in ("pages", "documents", "labels")]
    verdicts = {(r.host, r.verdict) for r in registry.op9_host_reputation(spark, str(tmp_path)).collect()}
    assert verdicts == {*((h, "allow") for h in good), ("borrows.net", "allow"), ("bad.net", "block"), ("titled.net", "block")}
    outcomes = {tuple(r) for r in registry.page_outcomes(*tables).collect()}
    assert outcomes == {*((h, 100, 0) for h in good), ("borrows.net", 0, 0), ("bad.net", 100, 100), ("titled.net", 100, 100)}
