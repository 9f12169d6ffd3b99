"""Operator 1: personal data.

Regular expressions propose spans, checksum validators (Luhn, mod-97) and value
checks confirm them, context words near a span adjust its score.

Defined results: a null text counts as empty; an empty text has no spans; a
null id is kept as is; repeated rows give repeated results; an empty table gives
an empty result; columns other than the two named ones are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import field, map_arrow, table, text_or_empty

BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds the method adds.  They are kept from ``THRESHOLD`` on; base kinds always.
EXTRA_KINDS = ("iban", "ssn", "secret")
KINDS = BASE_KINDS + EXTRA_KINDS
THRESHOLD = 0.6
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.25

#: Score before context, after the validator agreed.
START_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6,
               "iban": 0.9, "ssn": 0.4, "secret": 0.7}
CONTEXT_WORDS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "debit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "transfer"),
    "ssn": ("ssn", "social", "security"),
    "secret": ("token", "secret", "key", "password", "passwd", "bearer"),
}

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits that fails at its first digit fails at all others, so the
# possessive form with a look-behind finds the same spans in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9])[0-9a-f]{32,128}(?![A-Za-z0-9])")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        v = ord(ch) - 48
        total += v if k % 2 == 0 else (2 * v if v < 5 else 2 * v - 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    """ISO 7064 check of an account number: letters count 10 to 35."""
    turned = code[4:] + code[:4]
    return int("".join(str(int(ch, 36)) for ch in turned)) % 97 == 1


def _emails(text: str):
    """Leftmost non-overlapping addresses.  The local part's characters exclude
    ``@``, so each ``@`` is tried once with the run that touches it on the left."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text[start - 1]):
            start -= 1
        found = start < at and _DOMAIN.match(text, at + 1)
        if found:
            yield start, found.end()
            free = found.end()
            at = text.find("@", free)
        else:
            free = at + 1
            at = text.find("@", free)


def _ip_ok(s: str) -> bool:
    parts = [p.lstrip("0") for p in s.split(".")]
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def _card_ok(s: str) -> bool:
    d = _NOT_DIGIT.sub("", s)
    return 12 <= len(d) <= 19 and luhn(d)


def _phone_ok(s: str) -> bool:
    return 9 <= len(_NOT_DIGIT.sub("", s)) <= 15


def _iban_ok(s: str) -> bool:
    code = s.replace(" ", "")
    return 15 <= len(code) <= 34 and mod97(code)


def _ssn_ok(s: str) -> bool:
    a, b, c = s.split("-")
    return a not in ("000", "666") and a < "900" and b != "00" and c != "0000"


def _secret_ok(s: str) -> bool:
    return any(ch.isdigit() for ch in s) and any(ch.isalpha() for ch in s) and len(set(s)) >= 8


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: re.Pattern
    valid: object
    #: a character each match holds: texts without it are skipped
    needs: str


RULES = (Rule("ip", _IP, _ip_ok, "."), Rule("card", _CARD, _card_ok, ""),
         Rule("phone", _PHONE, _phone_ok, "+"), Rule("iban", _IBAN, _iban_ok, ""),
         Rule("ssn", _SSN, _ssn_ok, "-"), Rule("secret", _SECRET, _secret_ok, ""))
_ANY_DIGIT = re.compile(r"[0-9]")


@lru_cache(None)
def _context(kind: str) -> re.Pattern:
    return re.compile(r"\b(?:" + "|".join(CONTEXT_WORDS[kind]) + r")", re.I)


def _score(kind: str, text: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS]
    return min(1.0, START_SCORE[kind] + CONTEXT_BONUS * bool(_context(kind).search(near)))


def spans_of(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then kind as listed; code points."""
    found = []
    if "@" in text:
        found += [("email", a, b, _score("email", text, a, b)) for a, b in _emails(text)]
    if _ANY_DIGIT.search(text):
        for rule in RULES:
            if rule.needs in text:
                for m in rule.pattern.finditer(text):
                    if rule.valid(m[0]):
                        a, b = m.span()
                        score = _score(rule.kind, text, a, b)
                        if rule.kind in BASE_KINDS or score >= THRESHOLD:
                            found.append((rule.kind, a, b, score))
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return found


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id and ``spans`` (array of kind, start,
    end, score).  One narrow pass without a shuffle."""
    schema = T.StructType([field(docs, id_col), T.StructField("spans", T.ArrayType(SPAN))])

    def run(batch: pa.RecordBatch) -> list:
        spans = [[dict(zip(("kind", "start", "end", "score"), s)) for s in spans_of(t)]
                 for t in batch.column(1).to_pylist()]
        return [batch.column(0), spans]

    return map_arrow(docs.select(id_col, text_or_empty(text_col).alias("text")), run, schema)


def redact_text(text: str) -> str:
    """Spans become ``[KIND]``; overlapping spans merge under the first's kind."""
    out, free, open_span = [], 0, None
    for kind, a, b, _ in spans_of(text):
        if open_span and a < open_span[2]:
            open_span = (open_span[0], open_span[1], max(b, open_span[2]))
            continue
        if open_span:
            out += [text[free:open_span[1]], f"[{open_span[0].upper()}]"]
            free = open_span[2]
        open_span = (kind, a, b)
    if open_span:
        out += [text[free:open_span[1]], f"[{open_span[0].upper()}]"]
        free = open_span[2]
    return "".join(out) + text[free:] if out else text


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, personal data in the text replaced by ``[KIND]``.
    A null text stays null."""
    at = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> list:
        cols = batch.columns
        cols[at] = [t if t is None else redact_text(t) for t in cols[at].to_pylist()]
        return cols

    return map_arrow(docs, run, docs.schema)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"),
        F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"))
