"""Personal data: patterns propose spans, checksums confirm them, context adjusts scores.

Four base kinds (email, ip, card, phone) are fixed by their patterns and checks, leftmost
and without overlap within a kind, and always stay.  The others (iban, ssn, local_phone)
are proposed by a pattern, confirmed by a checksum or a check of their parts (ibans end where their country's length says), and stay if
their score, raised by words of their own kind and lowered by words of other numbers in
the 40 characters around, reaches ``ACCEPT``, unless they overlap a base span.

* Spans are in code points, ends exclusive; a null or empty text has none.
* Each text is read whole, by patterns that take time in proportion to its length.
* Rows, ties and other columns stay as they are; nothing is shuffled.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import shipped, unused

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone")
BASE = KINDS[:4]
ACCEPT = 0.5
WINDOW = 40

# The base patterns.  A run of digits is entered at its start only, so long runs stay cheap;
# an email is found from its @, for the same reason.
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_IBAN_REST = re.compile(r"(?: ?[A-Z0-9]){11,30}")
_TOKEN_END = re.compile(r"(?<=[A-Z0-9])(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]+")

#: Characters of a bank account number by country.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}

#: The score of a confirmed span of each kind without any context.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7, "ssn": 0.35, "local_phone": 0.35}
RAISE, LOWER = 0.3, 0.3
CONTEXT = {
    "email": {"email", "mail", "contact", "write"},
    "ip": {"ip", "address", "host", "server", "client"},
    "card": {"card", "visa", "mastercard", "credit", "debit", "payment", "pay"},
    "phone": {"phone", "call", "tel", "telephone", "mobile", "cell", "fax"},
    "iban": {"iban", "account", "bank", "transfer", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security", "taxpayer", "identification"},
    "local_phone": {"phone", "call", "tel", "telephone", "mobile", "cell", "fax", "contact"},
}
OTHER_NUMBERS = {"version", "build", "release", "order", "invoice", "serial", "isbn", "part", "item", "page", "section"}


def luhn(digits: str) -> bool:
    """The checksum of payment cards: every second digit from the right counts double."""
    total = sum(map(int, digits[::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The checksum of bank accounts: the number with its head moved to the end is 1 mod 97."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for found in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in found[0].split(".")):
            yield found.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        if found.end() - found.start() <= 40:  # 19 digits and 18 separators at most
            digits = found[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, found[0])) <= 15:
            yield found.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Ends are those of words; a country without a known length takes the longest that fits."""
    free = 0
    for head in _IBAN_HEAD.finditer(text):
        rest = _IBAN_REST.match(text, head.end()) if head.start() >= free else None
        if not rest:
            continue
        length = IBAN_LENGTHS.get(head[0][:2])
        ends = [x.start() for x in _TOKEN_END.finditer(text, head.end(), rest.end() + 1) if x.start() <= rest.end()]
        for end in reversed(ends):
            number = text[head.start() : end].replace(" ", "")
            if (len(number) == length if length else len(number) >= 15) and mod97(number):
                yield head.start(), end
                free = end
                break


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for found in _SSN.finditer(text):
        area, group, serial = found.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield found.span()


def _local_phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _LOCAL_PHONE.finditer(text):
        yield found.span()


_NUMBERS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "ssn": _ssns, "local_phone": _local_phones,
}


def score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's own score, adjusted by the words around."""
    around = text[max(0, start - WINDOW) : start] + " " + text[end : end + WINDOW]
    words = {x.lower() for x in _WORD.findall(around)}
    raised = RAISE if words & CONTEXT[kind] else 0.0
    lowered = LOWER if words & OTHER_NUMBERS else 0.0
    return round(min(1.0, max(0.0, SCORES[kind] + raised - lowered)), 2)


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score), by start and then by kind as listed."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for kind, propose in _NUMBERS.items():
            found += [(kind, a, b) for a, b in propose(text)]
    out = [(k, a, b, score(text, k, a, b)) for k, a, b in found if k in BASE]
    starts, ends = [], []
    for _, a, b, _ in sorted(out, key=lambda x: x[1]):  # the ground that base spans cover
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for kind, a, b in found:
        if kind not in BASE and bisect.bisect_right(ends, a) == bisect.bisect_left(starts, b):
            rated = score(text, kind, a, b)
            if rated >= ACCEPT:
                out.append((kind, a, b, rated))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def spans_column(text: Column) -> Column:
    """The spans of a text, array<struct<kind, start, end, score>>."""

    @F.arrow_udf("array<struct<kind:string,start:int,end:int,score:double>>")
    def find(texts: pa.Array) -> pa.Array:
        rows = [[dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in spans(t.as_py() or "")] for t in texts]
        return pa.array(rows, SPANS)

    return find(text)


def find_pii(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """Add the spans of a text column, in place of any column of that name."""
    shipped(docs.sparkSession)
    return docs.withColumn(into, spans_column(docs[text]))


def joined(found: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def mask(text: str, found: list[tuple[str, int, int, float]]) -> str:
    """The text with [KIND] in place of each span; overlapping spans give one mark."""
    out, at = [], 0
    for kind, start, end, _ in found:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_pii(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """Replace personal data in a text column; where a text changes, its length follows."""
    shipped(docs.sparkSession)

    @F.arrow_udf("string")
    def masked(texts: pa.Array) -> pa.Array:
        whole = [x.as_py() for x in texts]
        return pa.array([t and mask(t, spans(t)) for t in whole], pa.string())

    (clean,) = unused(docs, "masked_text")
    rows = docs.withColumn(clean, masked(docs[text]))
    columns = {text: F.col(clean)}
    if length in docs.columns:
        own = rows[length]
        changed = F.length(clean).cast(docs.schema[length].dataType)
        columns[length] = F.when(rows[text].eqNullSafe(F.col(clean)), own).otherwise(changed)
    return rows.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
