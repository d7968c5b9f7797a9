"""Personal data against the plain patterns, and what the method adds."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from quotewright.llm import pii, registry

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def checked_by_luhn(digits):
    doubled = [int(d) * (2 if k % 2 else 1) for k, d in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def base_by_definition(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and checked_by_luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda x: (x[1], pii.BASE.index(x[0])))


def base_of(text):
    return [x[:3] for x in pii.spans(text) if x[0] in pii.BASE]


@given(st.text(alphabet="ab.@-%+ 0123456789()[]é😀\n", max_size=80))
@settings(max_examples=1500, deadline=None)
def test_base_spans_of_any_text(text):
    assert base_of(text) == base_by_definition(text)


@pytest.mark.parametrize(
    "text",
    [
        "a@b@c.d", "a@b.c@d.e", "x@y.z.", "@a.b", "a.b+c%d@e-f.g-h.i!", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.1 1.2.3.0000007",
        "4111 1111-1111 1111", "4111  1111 1111 1111", "+1 (389) 555-5010", "+12345678", "é 4111111111111111 😀 a@b.cc", "",
    ],
)
def test_base_spans(text):
    assert base_of(text) == base_by_definition(text)


def test_base_spans_of_made_up_numbers():
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choices("0123456789 -.+()@ab", weights=[9] * 10 + [4, 4, 5, 1, 1, 1, 1, 2, 2], k=rng.randrange(70)))
        assert base_of(text) == base_by_definition(text)


def test_long_runs_take_linear_time():
    begun = time.time()
    for text in ("1" * 400_000, "a" * 400_000, "1 " * 200_000, "a@" * 100_000, "+1" * 100_000, "1." * 150_000, "a." * 200_000 + "@"):
        pii.spans(text)
    assert time.time() - begun < 30


def test_checksums_and_context_decide_on_added_kinds():
    kinds = lambda text: [x[0] for x in pii.spans(text)]
    assert kinds("account DE89 3704 0044 0532 0130 00 at the bank") == ["iban"]
    assert kinds("account DE89 3704 0044 0532 0130 01 at the bank") == []
    assert kinds("SSN 123-45-6789") == ["ssn"]
    assert kinds("serial 123-45-6789") == []
    assert kinds("ssn 666-45-6789") == []
    assert kinds("call (389) 555-5010") == ["local_phone"]
    assert kinds("part 389-555-5010") == []
    assert kinds("call +1 389 555-5010") == ["phone"]  # the base span keeps its ground
    assert pii.score("pay by card 4111111111111111", "card", 12, 28) > pii.score("order 4111111111111111", "card", 6, 22)


@pytest.mark.parametrize("behind", [" BIC COBADEFF", " EUR 500", " I wrote", " It", " USD", " 12 34", ", X", "\nA1", ""])
@pytest.mark.parametrize("number", ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"])
def test_ibans_end_where_their_country_says(number, behind):
    ibans = lambda text: [text[a:b] for k, a, b, _ in pii.spans(text) if k == "iban"]
    assert ibans(f"to {number}{behind}") == [number]
    assert ibans(f"A {number} GB82 WEST 1234 5698 7654 32{behind}") == [number, "GB82 WEST 1234 5698 7654 32"]
    assert ibans(f"AB12 3456 {number}{behind}")[-1:] == [number]
    assert ibans(f"to {number}x{behind}") == []


def test_ibans_take_linear_time():
    begun = time.time()
    for text in ("DE89 " * 80_000, "DE893704 " * 40_000, "DE89" * 100_000, "AA11 A " * 60_000):
        pii.spans(text)
    assert time.time() - begun < 30


def test_op6_whole_table(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = registry.op6_pii(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(docs)
    for r in rows:
        base = base_by_definition(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[0] == k for x in base) for k in pii.BASE)
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(",")) or not base


def test_masks_replace_spans_and_nothing_else(spark):
    rows = [(1, "write to a@b.cc now", 19), (2, "clean", 5), (3, None, None), (None, "", 0), (2, "clean", 5)]
    docs = spark.createDataFrame([(*r, "m") for r in rows], "doc_id long, text string, n_chars long, masked_text string")
    out = pii.mask_pii(docs)
    assert out.columns == docs.columns
    expected = [(1, "write to [EMAIL] now", 20, "m"), *[(*r, "m") for r in rows[1:]]]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(expected, key=str)
    assert pii.mask_pii(docs.limit(0)).count() == 0


def test_overlapping_spans_give_one_mark():
    assert pii.mask("0123456789", [("card", 2, 6, 1.0), ("phone", 4, 8, 1.0)]) == "01[CARD]89"


def test_empty_tables_and_clashing_columns(spark):
    rows = [(1, "mail a@b.cc", "old", "x"), (2, None, "old", "y"), (None, "", "old", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pii string, masked_text string")
    found = pii.find_pii(docs)
    assert sorted(found.columns) == sorted(docs.columns)
    spans = {r.doc_id: [(x["kind"], x["start"], x["end"]) for x in r.pii] for r in found.collect()}
    assert spans == {1: [("email", 5, 11)], 2: [], None: []}
    masked = {r.doc_id: (r.text, r.pii, r.masked_text) for r in pii.mask_pii(docs).collect()}
    assert masked == {1: ("mail [EMAIL]", "old", "x"), 2: (None, "old", "y"), None: ("", "old", None)}
    assert pii.find_pii(docs.limit(0)).count() == pii.mask_pii(docs.limit(0)).count() == 0
