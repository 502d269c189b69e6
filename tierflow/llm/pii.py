r"""Personal data: regular expressions propose spans, checks confirm them, nearby words adjust their score.

The four base kinds (email, ip, card, phone) follow fixed patterns and checks: parts of an address at most 255, Luhn's sum
for cards, 8 to 15 digits for phones. They are always kept. The method adds kinds that need more evidence: bank account
numbers (``iban``, remainder 1 modulo 97), 13 to 15 digit cards (``card_short``, Luhn) and US social security numbers
(``ssn``), the latter two only with a fitting word nearby. A span's score starts from its kind and check and rises with
each of the kind's context words among the 48 characters before and 24 after it; added spans need a score of at least 0.5.

Offsets are code points, ends exclusive. Spans are sorted by kind, in the order of ``KINDS``, then by start.

Defined cases: a null or empty text has no spans; whole texts are searched, however long; other columns are kept.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone", "iban", "card_short", "ssn")
BASE_KINDS = KINDS[:4]
LEAST_SCORE = 0.5

# The patterns of the base kinds.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")  # a match always starts its run of digits
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")

_CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile"),
    "iban": ("iban", "bank", "account"),
    "card_short": ("card", "visa", "credit", "payment", "amex"),
    "ssn": ("ssn", "social security"),
}
_FLOOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.8, "card_short": 0.4, "ssn": 0.3}
_STEP = 0.2

SPAN = T.StructType([
    T.StructField("kind", T.StringType(), False),
    T.StructField("start", T.IntegerType(), False),
    T.StructField("end", T.IntegerType(), False),
    T.StructField("score", T.DoubleType(), False),
])


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def mod97(code: str) -> bool:
    """Whether an account number, its first four characters put last and letters read as 10 to 35, leaves 1 modulo 97."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    """Leftmost matches of the email pattern. The part before an ``@`` is looked up from the ``@``, in time linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and _LOCAL.match(text[first - 1]):
            first -= 1
        found = _EMAIL.match(text, first) if first < at else None
        if found:
            yield found.start(), found.end()
            done = found.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def _proposed(text: str):
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card" if len(digits) >= 16 else "card_short", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                yield "phone", m.start(), m.end()
    for m in _IBAN.finditer(text):
        code = m.group()
        while len(code) >= 15:  # capital words may follow the number
            if mod97(code.replace(" ", "")):
                yield "iban", m.start(), m.start() + len(code)
                break
            code = code.rpartition(" ")[0]
    for m in _SSN.finditer(text):
        yield "ssn", m.start(), m.end()


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """``(kind, start, end, score)`` of all personal data in one text."""
    found = []
    for kind, start, end in _proposed(text):
        near = (text[max(0, start - 48):start] + " " + text[end:end + 24]).lower()
        near_words = sum(bool(re.search(rf"\b{word}", near)) for word in _CONTEXT[kind])
        score = min(1.0, _FLOOR[kind] + _STEP * near_words)
        if kind in BASE_KINDS or score >= LEAST_SCORE:
            found.append((kind, start, end, score))
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


@F.arrow_udf(T.ArrayType(SPAN))
def spans(texts: pa.Array) -> pa.Array:
    """All spans of a text column."""
    rows = []
    for text in texts:
        value = text.as_py()
        rows.append([dict(zip(("kind", "start", "end", "score"), s)) for s in find_spans(value)] if value else [])
    kind = pa.list_(pa.struct([
        pa.field("kind", pa.string(), False), pa.field("start", pa.int32(), False), pa.field("end", pa.int32(), False), pa.field("score", pa.float64(), False)
    ]))
    return pa.array(rows, type=kind)


@F.arrow_udf(T.StringType())
def masked(texts: pa.Array, found: pa.Array) -> pa.Array:
    """The texts with every span replaced by its kind in brackets; where spans overlap, the one that starts first counts."""
    out = []
    for text, row in zip(texts.to_pylist(), found.to_pylist()):
        if text is None:
            out.append(None)
            continue
        pieces, done = [], 0
        for s in sorted(row or [], key=lambda s: (s["start"], -s["end"])):
            if s["start"] >= done:
                pieces += [text[done:s["start"]], f"[{s['kind']}]"]
            done = max(done, s["end"])
        out.append("".join([*pieces, text[done:]]))
    return pa.array(out, type=pa.string())


def listed(found: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_spans(found: Column) -> Column:
    return F.filter(found, lambda s: s["kind"].isin(*BASE_KINDS))
