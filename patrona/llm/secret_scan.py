"""Secret scans: base patterns, and sliding-window entropy over candidate strings.

A candidate is a run of token characters. A window of fixed width slides over it;
counts of its characters and of its character classes are kept up step by step,
and the Shannon entropy follows from a running sum of c*log2(c). A window counts
when its class (hexadecimal of one case, one case with digits, mixed, mixed without two
digits) reaches the limit of that class; windows that touch are merged. What the
allow-list matches is taken out of a candidate, and base spans out of the spans.

Defined cases: a null or empty text has no spans; repeated rows are scanned one by
one; very long texts are scanned whole; spans that start together are in order of their
kind; positions are code points of the whole text; an empty table has no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from patrona.llm import text as T

KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
#: Least entropy in bits of a 20-character window, by class.
LIMITS = {"hex": 3.0, "one_case": 3.6, "mixed": 3.8, "letters": 4.0}
#: What is known not to be secret: a placeholder word, a row of characters, a UUID, a whole run of plain words.
_PLAIN = rb"[a-z]*(?:[A-Z]+[a-z]{2,})*[A-Z]*"  # letters whose capitals begin words
ALLOWED = re.compile(rb"example|sample|placeholder|dummy|x{6}|0123456789|123456789|abcdefgh|"
                     rb"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}|"
                     rb"(?-i:^%(w)b([-_./]%(w)b)*$)" % {b"w": _PLAIN}, re.IGNORECASE)

_ASSIGN = re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_KEYWORDS = (b"passw", b"secret", b"token", b"api")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_TOKEN = np.zeros(256, bool)
_TOKEN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
_C_LOG = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]
_DIGIT, _AF, _LOWER, _UPPER_AF, _UPPER, _MARK = range(6)
_CLASS = [_MARK] * 256
for _b in range(256):
    _c = chr(_b)
    if _b < 128 and _c.isalnum():
        if _c.isdigit():
            _CLASS[_b] = _DIGIT
        elif _c.isupper():
            _CLASS[_b] = _UPPER_AF if _c <= "F" else _UPPER
        else:
            _CLASS[_b] = _AF if _c <= "f" else _LOWER


def entropy_spans(candidate: bytes, limits: dict[str, float] = LIMITS) -> list[tuple[int, int]]:
    """Merged windows of a candidate whose entropy reaches the limit of their class."""
    counts, kinds, total, spans = [0] * 256, [0] * 6, 0.0, []
    for i, byte in enumerate(candidate):
        c = counts[byte]
        total += _C_LOG[c + 1] - _C_LOG[c]
        counts[byte] = c + 1
        kinds[_CLASS[byte]] += 1
        start = i + 1 - WINDOW
        if start < 0:
            continue
        letters = kinds[_AF] + kinds[_LOWER]
        upper = kinds[_UPPER] + kinds[_UPPER_AF]
        least = math.inf
        if kinds[_DIGIT] >= 2 and kinds[_DIGIT] < WINDOW:
            if not (kinds[_LOWER] or kinds[_UPPER] or kinds[_MARK] or kinds[_AF] and kinds[_UPPER_AF]):
                least = limits["hex"]
            elif not (letters and upper):
                least = limits["one_case"]
            else:
                least = limits["mixed"]
        elif kinds[_DIGIT] < 2 and not kinds[_MARK] and letters and upper:
            least = limits["letters"]
        if math.log2(WINDOW) - total / WINDOW >= least:
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
        left = candidate[start]
        c = counts[left]
        total += _C_LOG[c - 1] - _C_LOG[c]
        counts[left] = c - 1
        kinds[_CLASS[left]] -= 1
    return spans


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind) of assignments and access keys, in bytes."""
    spans = []
    lowered = text.lower()
    if any(word in lowered for word in _KEYWORDS):
        spans += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if b"AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    return spans


def outside(span: tuple[int, int], cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts of a span that lie outside the cuts, which are in order of their starts."""
    at, stop = span
    parts = []
    for a, b in cuts:
        if b > at and a < stop:
            if a > at:
                parts.append((at, a))
            at = max(at, b)
    if at < stop:
        parts.append((at, stop))
    return parts


def _long_runs(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, least: int) -> dict[int, list]:
    starts, ends = T.runs(table[data], offsets)
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    out: dict[int, list] = {}
    for text, a, b in zip((np.searchsorted(offsets, starts, "right") - 1).tolist(), starts.tolist(), ends.tolist()):
        out.setdefault(text, []).append((a, b))
    return out


def scan_chunk(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Each text with its (start, end, kind) spans in bytes, by start, then kind."""
    raw = data.tobytes()
    hexes, tokens = _long_runs(data, offsets, _HEX, 24), _long_runs(data, offsets, _TOKEN, WINDOW)
    for k, (begin, stop) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        text = raw[begin:stop]
        spans = base_spans(text) + [(a - begin, b - begin, 2) for a, b in hexes.get(k, ())]
        base = [(a, b) for a, b, _ in sorted(spans)]
        for a, b in tokens.get(k, ()):
            candidate = raw[a:b]
            known = [m.span() for m in ALLOWED.finditer(candidate)]
            for p, q in outside((0, len(candidate)), known):
                for x, y in entropy_spans(candidate[p:q]):
                    at = a - begin + p
                    spans += [(u, v, 3) for u, v in outside((at + x, at + y), base)]
        yield text, sorted(spans, key=lambda s: (s[0], s[2]))


def _name(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, b, kind in spans)


_FOUND = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long"


def _scan_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in T.chunks(batches):
        found = []
        for text, spans in scan_chunk(data, offsets):
            if spans:
                points = np.r_[0, np.cumsum(T.code_points(np.frombuffer(text, np.uint8)))]
                spans = [(int(points[a]), int(points[b]), kind) for a, b, kind in spans]
            base = [s for s in spans if s[2] < 3]
            kinds = [s[2] for s in spans]
            found.append((kinds.count(0), kinds.count(1), kinds.count(2),
                          hashlib.sha256(_name(base).encode()).hexdigest(), _name(spans), len(spans)))
        names = [c.split()[0] for c in _FOUND.split(", ")]
        columns = [pa.array(list(c), pa.string() if i in (3, 4) else pa.int64()) for i, c in enumerate(zip(*found))]
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *columns], names=["doc_id", *names])


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, counts by base kind, digest of the base spans, all spans) for every document (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scan_task, f"doc_id {kind}, {_FOUND}")


def _redact_task(mark: bytes):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in T.chunks(batches):
            texts = []
            for text, spans in scan_chunk(data, offsets):
                parts, at = [], 0
                for a, b, _ in spans:
                    if b <= at:
                        continue
                    if a >= at:
                        parts += [text[at:a], mark]
                    at = b
                texts.append(b"".join([*parts, text[at:]]).decode("utf-8", "replace"))
            column = rows.schema.get_field_index("text")
            nulls = rows.column(column).is_null()
            texts = pa.array([None if gone.as_py() else t for t, gone in zip(texts, nulls)], pa.string())
            yield rows.set_column(column, "text", texts)
    return task


def redact_secrets(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The documents with every span replaced by ``mark``; all rows and columns stay."""
    return docs.mapInArrow(_redact_task(mark.encode()), docs.schema)
