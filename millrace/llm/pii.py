"""Personal data: patterns propose spans, checksums confirm them, nearby words move the score.

Four base kinds (``email``, ``ip``, ``card``, ``phone``) follow fixed patterns and stay whatever their score. The
method adds ``iban`` (mod-97) and ``secret`` (long hexadecimal values), which need a score of ``ACCEPT`` or more.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import mapped

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "secret")
ACCEPT = 0.7
#: Characters on either side of a span in which context words count.
NEAR = 40

#: Score before context; a passed checksum is part of it. Then what a context word of the kind adds.
SCORES = {"email": (0.9, 0.05), "ip": (0.6, 0.2), "card": (0.8, 0.15), "phone": (0.6, 0.3), "iban": (0.8, 0.15), "secret": (0.4, 0.5)}
CONTEXT = {
    "email": re.compile(r"\b(?:e-?mail|contact|write)\b", re.I), "ip": re.compile(r"\b(?:ip|host|server|address)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|credit|debit|payment)\b", re.I), "phone": re.compile(r"\b(?:phone|call|tel|mobile|fax)\b", re.I),
    "iban": re.compile(r"\b(?:iban|account|bank|konto)\b", re.I),
    "secret": re.compile(r"(?:token|secret|password|passwd|credential|api[ _-]?key|access[ _-]?key)", re.I)}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A try that fails at the first digit of a run fails at all others, so only first digits are tried: linear on long runs.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_HEX = re.compile(r"(?<![A-Za-z0-9])[A-Fa-f0-9]{32,}+(?![A-Za-z0-9])")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """The last digit makes the weighted sum a multiple of ten."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The account number, its first four characters moved to the end and letters as 10 to 35, leaves 1."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _emails(text: str):
    """Leftmost matches of local part, '@', dotted domain; found from each '@', so a text without one costs nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", at + 1)


def _ips(text: str):
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            yield m.span()


def _cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 13 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


def _ibans(text: str):
    for m in _IBAN.finditer(text):
        for end in range(m.end(), m.start() + 14, -1):
            account = text[m.start():end].replace(" ", "")
            if text[end - 1] != " " and not (end < len(text) and text[end].isalnum()) and len(account) >= 15 and mod97(account):
                yield m.start(), end
                break


def _secrets(text: str):
    for m in _HEX.finditer(text):
        if _DIGIT.search(m[0]):
            yield m.span()


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "secret": _secrets}


def find_spans(text: str) -> list[Span]:
    """All spans by kind as listed, then by start; ends are exclusive, places count code points."""
    found = []
    digits = _DIGIT.search(text) is not None
    for kind in BASE + ADDED:
        if kind == "email" and "@" not in text or kind != "email" and not digits or kind == "phone" and "+" not in text:
            continue
        for start, end in _FINDERS[kind](text):
            score, more = SCORES[kind]
            if CONTEXT[kind].search(text[max(0, start - NEAR):start]) or CONTEXT[kind].search(text[end:end + NEAR]):
                score += more
            if kind in BASE or score >= ACCEPT:
                found.append(Span(kind, start, end, round(score, 4)))
    return found


def as_text(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def detect_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and its spans as array of (kind, start_at, end_at, score).

    A null or empty text has no spans. Rows with a null or repeated id are answered one by one. Texts are read whole;
    each pattern is linear in the length of a text but for runs inside one match. An empty table gives no rows.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[{"kind": s.kind, "start_at": s.start, "end_at": s.end, "score": s.score} for s in find_spans(t)] if t else []
                 for t in batch.column("text").to_pylist()]
        item = pa.struct([("kind", pa.string()), ("start_at", pa.int64()), ("end_at", pa.int64()), ("score", pa.float64())])
        return pa.record_batch([batch.column("id"), pa.array(spans, pa.list_(item))], ["id", "spans"])

    schema = f"id {kind}, spans array<struct<kind:string,start_at:bigint,end_at:bigint,score:double>>"
    return mapped(source, of, schema).select(F.col("id").alias(id_col), "spans")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and span texts of ``detect_pii`` rows."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start_at"], s["end_at"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        id_col, *map(count, BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
