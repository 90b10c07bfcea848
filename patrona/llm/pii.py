"""Personal data: patterns propose spans, checksums and ranges confirm them, context words adjust a score.

Email addresses, IP addresses, payment cards (Luhn) and international phone numbers are
base kinds and always reported. Account numbers (IBAN, mod-97), card numbers of 12 or 13
digits, social security numbers, national identity numbers with a check letter, phone
numbers without a country prefix and addresses written with ``(at)`` are reported when
their score, raised or lowered by words nearby, reaches a threshold. Each pattern runs
in time linear in the text: emails start from their ``@``, digit runs never backtrack.

Defined cases: a null or empty text has no spans; very long texts are scanned whole;
repeated rows are scanned one by one; positions are code points, the end exclusive;
spans that start together are in order of their kind; an empty table has no rows; other
columns are ignored (``redact_pii`` keeps them).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrona.llm import text as T

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("iban", "short_card", "ssn", "id_letter", "tel", "email_at")
THRESHOLD = 0.5
#: Bytes before and after a span that are searched for context words.
BEFORE, AFTER = 48, 24
#: How much context words move a score.
RAISE, LOWER = 0.4, 0.3

#: Score of a confirmed span without any context.
_SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.8, "iban": 0.9, "short_card": 0.3, "ssn": 0.3,
           "id_letter": 0.3, "tel": 0.2, "email_at": 0.7}
_CONTEXT = {
    "email": rb"e-?mail|mailto|contact|correo|courriel|kontakt",
    "ip": rb"\bip\b|address|host|server|login|client|adresse|direcci",
    "card": rb"card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta",
    "phone": rb"phone|\btel|call|fax|mobil|cell|whatsapp|telefon|t\xc3\xa9l\xc3\xa9phone|tel\xc3\xa9fono|handy",
    "iban": rb"iban|account|bank|konto|compte|cuenta",
    "ssn": rb"\bssn\b|social security|tax(payer)? id",
    "id_letter": rb"\bdni\b|\bnif\b|identidad|identity|documento",
}
_CONTEXT |= {"short_card": _CONTEXT["card"], "tel": _CONTEXT["phone"], "email_at": _CONTEXT["email"]}
_CONTEXT = {kind: re.compile(words, re.IGNORECASE) for kind, words in _CONTEXT.items()}
_AGAINST = re.compile(rb"\bisbn|\bissn|order|invoice|version|tracking|serial|part no|example of|dummy|placeholder",
                      re.IGNORECASE)

#: Characters of an account number by country (public IBAN registry).
_IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24,
    "XK": 20}
#: Check letters of the Spanish identity number, by remainder of 23.
_ID_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"

_LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(rb"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(rb"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[\x20-]?[A-Za-z0-9]){11,30}")
_SSN = re.compile(rb"(?<![0-9-])([0-9]{3})([-\x20])([0-9]{2})\2([0-9]{4})(?![0-9-])")
_ID = re.compile(rb"(?<![A-Za-z0-9])([0-9]{8})-?([A-Z])(?![A-Za-z0-9])")
_TEL = re.compile(rb"(?<![0-9+])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20./-][0-9]{3,4}(?:[\x20.-][0-9]{2,4}){1,2}(?![0-9])")
_AT = re.compile(rb"\x20?[\[(]at[\])]\x20?", re.IGNORECASE)
_AT_DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]+|\.[A-Za-z0-9-]+)+", re.IGNORECASE)


def luhn(digits: bytes) -> bool:
    """Checksum of payment cards over ASCII digits."""
    total = 0
    for place, byte in enumerate(reversed(digits)):
        value = byte - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def mod_97(account: str) -> bool:
    """Checksum of an account number: first four characters last, letters as 10 to 35, remainder 1."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _digits(text: bytes) -> bytes:
    return bytes(b for b in text if 48 <= b <= 57)


def _emails(text: bytes, at_sign: re.Pattern | None, domain: re.Pattern) -> Iterator[tuple[int, int]]:
    """Leftmost local part before each sign and the domain after it; a part never reaches back over a sign."""
    free = 0
    marks = ((m.start(), m.end()) for m in at_sign.finditer(text)) if at_sign else _signs(text)
    for begin, end in marks:
        local = text[free:begin]
        start = free + len(local.rstrip(_LOCAL))
        found = domain.match(text, end) if start < begin else None
        if found:
            yield start, found.end()
        free = found.end() if found else end


def _signs(text: bytes) -> Iterator[tuple[int, int]]:
    at = text.find(b"@")
    while at >= 0:
        yield at, at + 1
        at = text.find(b"@", at + 1)


def _iban_end(text: bytes, start: int) -> int | None:
    """End of the account number that starts here, if its country's length and its checksum fit."""
    length = _IBAN_LENGTHS.get(text[start:start + 2].decode("ascii"))
    kept, at = [], start
    while length and at < len(text) and len(kept) < length:
        byte = text[at:at + 1]
        if byte.isalnum() and byte.isascii():
            kept.append(byte)
        elif byte not in (b" ", b"-"):
            return None
        at += 1
    if not length or len(kept) < length or text[at:at + 1].isalnum():
        return None
    return at if mod_97(b"".join(kept).decode("ascii")) else None


def proposals(text: bytes, digits: bool) -> Iterator[tuple[int, int, str]]:
    """Confirmed spans (start, end, kind) in bytes, before any score."""
    if b"@" in text:
        yield from ((a, b, "email") for a, b in _emails(text, None, _DOMAIN))
    if b"at]" in text or b"at)" in text or b"AT]" in text or b"AT)" in text:
        yield from ((a, b, "email_at") for a, b in _emails(text, _AT, _AT_DOMAIN))
    if not digits:
        return
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or b"0") <= 255 for p in (p.lstrip(b"0") for p in m[0].split(b"."))):
            yield m.start(), m.end(), "ip"
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            number = _digits(m[0])
            if 12 <= len(number) <= 19 and luhn(number):
                yield m.start(), m.end(), "card" if len(number) >= 14 else "short_card"
    if b"+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                yield m.start(), m.end(), "phone"
    for m in _IBAN.finditer(text):
        end = _iban_end(text, m.start())
        if end:
            yield m.start(), end, "iban"
    for m in _SSN.finditer(text):
        if m[1] not in (b"000", b"666") and m[1] < b"900" and m[3] != b"00" and m[4] != b"0000":
            yield m.start(), m.end(), "ssn"
    for m in _ID.finditer(text):
        if _ID_LETTERS[int(m[1]) % 23].encode() == m[2]:
            yield m.start(), m.end(), "id_letter"
    for m in _TEL.finditer(text):
        if 7 <= len(_digits(m[0])) <= 12:
            yield m.start(), m.end(), "tel"


def score(text: bytes, start: int, end: int, kind: str) -> float:
    """Score of a confirmed span, moved by the words around it, 0 to 1."""
    around = text[max(start - BEFORE, 0):start] + b" " + text[end:end + AFTER]
    value = _SCORES[kind]
    if _CONTEXT[kind].search(around):
        value += RAISE
    if _AGAINST.search(around):
        value -= LOWER
    return round(min(max(value, 0.0), 1.0), 3)


def find_spans(text: bytes, digits: bool = True, threshold: float = THRESHOLD) -> list[tuple[int, int, int, float]]:
    """(start, end, number of the kind, score) in bytes, by start, then kind.

    Base spans all stay. Of the others those below the threshold, inside a base span or
    overlapping one of their own with a higher score go.
    """
    found = [(a, b, kind, score(text, a, b, kind)) for a, b, kind in proposals(text, digits)]
    base = [s for s in found if s[2] in BASE_KINDS]
    kept = list(base)
    taken: list[tuple[int, int]] = []
    for span in sorted((s for s in found if s[2] not in BASE_KINDS and s[3] >= threshold),
                       key=lambda s: (-s[3], s[0], s[1])):
        a, b = span[:2]
        if not any(x <= a and b <= y for x, y, *_ in base) and not any(x < b and a < y for x, y in taken):
            taken.append((a, b))
            kept.append(span)
    return sorted(((a, b, KINDS.index(kind), value) for a, b, kind, value in kept), key=lambda s: (s[0], s[2]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple[bytes, list]]]]:
    digit = np.zeros(256, bool)
    digit[48:58] = True
    for rows, data, offsets in T.chunks(batches):
        raw = data.tobytes()
        numbers = T.per_text(digit[data], offsets)
        yield rows, [(raw[a:b], find_spans(raw[a:b], n > 0))
                     for a, b, n in zip(offsets[:-1].tolist(), offsets[1:].tolist(), numbers.tolist())]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())])


def _span_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in _scan(batches):
        found = []
        for text, spans in texts:
            if spans:
                points = np.r_[0, np.cumsum(T.code_points(np.frombuffer(text, np.uint8)))]
                spans = [{"kind": KINDS[kind], "start": int(points[a]), "stop": int(points[b]), "score": value}
                         for a, b, kind, value in spans]
            found.append(spans)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(found, pa.list_(_SPAN))],
                                         names=["doc_id", "found"])


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, found) of every document: the spans with kind, start, stop and score, in order."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _span_task, f"doc_id {kind}, found array<struct<kind:string,start:long,stop:long,score:double>>")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def summarise(found: DataFrame) -> DataFrame:
    """Counts by base kind, digest of the base spans, all spans, how many there are and the highest score."""
    spans = F.col("found")
    names = F.transform(spans, lambda s: s["kind"])
    counts = [(F.size(spans) - F.size(F.array_remove(names, kind))).cast("long").alias(f"n_{kind}")
              for kind in BASE_KINDS]
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"),
                        _listed(spans).alias("spans"), F.size(spans).cast("long").alias("n_spans"),
                        F.coalesce(F.array_max(F.transform(spans, lambda s: s["score"])), F.lit(0.0)).alias("top_score"))


def _redact_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, found in _scan(batches):
        texts = []
        for text, spans in found:
            parts, at = [], 0
            for a, b, kind, _ in spans:
                if a >= at:
                    parts += [text[at:a], b"[", KINDS[kind].encode(), b"]"]
                at = max(at, b)
            texts.append(b"".join([*parts, text[at:]]).decode("utf-8", "replace"))
        nulls = rows.column("text").is_null().to_pylist()
        texts = pa.array([None if gone else t for t, gone in zip(texts, nulls)], pa.string())
        yield rows.set_column(rows.schema.get_field_index("text"), "text", texts)


def redact_pii(docs: DataFrame) -> DataFrame:
    """The documents with each span replaced by its kind in brackets; all rows and columns stay."""
    return docs.mapInArrow(_redact_task, docs.schema)
