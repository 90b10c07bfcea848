"""Word scanning over Arrow text buffers, shared by the operators of this subpackage.

Everything works on the UTF-8 bytes of a batch at once with NumPy: no Python
object is made per word. Texts are whole; a null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of text handled at once inside a task; a longer single text is handled alone, whole.
CHUNK_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Words ``[^\x20\x09-\x0D]+``: every byte that is no ASCII white space.
SPACED = ~_SPACE

#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text: digits, letters, all beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x41:0x5B] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_STEP = np.uint64(0x9E3779B97F4A7C15)


def in_share(key: str, modulus: int, remainder: int) -> Column:
    """Condition: crc32 of the key as text leaves this remainder (false for a null key)."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % modulus == remainder, F.lit(False))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values evenly (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``max_bytes`` of text: (rows, bytes, offsets of the texts)."""
    for batch in batches:
        whole = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
        offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + len(whole) + 1]
        data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)
        start = 0
        while start < len(whole):
            end = int(np.searchsorted(offsets, offsets[start] + max_bytes, "right")) - 1
            end = min(max(end, start + 1), len(whole))
            own = offsets[start:end + 1]
            yield batch.slice(start, end - start), data[own[0]:own[-1]], own - own[0]
            start = end


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of marked bytes; no run reaches from one text into the next."""
    before = np.zeros(len(inside) + 1, bool)
    before[1:] = inside
    before[offsets] = False
    after = np.zeros(len(inside) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    return np.flatnonzero(inside & ~before[:-1]), np.flatnonzero(inside & ~after[1:]) + 1


class Words:
    """Words of several texts: byte ranges, 64-bit hashes, and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        inside = is_word[data]
        self.starts, self.ends = runs(inside, offsets)
        self.inside = inside
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        lengths = self.ends - self.starts
        if not len(lengths):
            self.hashes = np.zeros(0, np.uint64)
            return
        powers = np.cumprod(np.full(int(lengths.max()), 0x100000001B3 * 2 + 1, np.uint64))
        edge = np.zeros(len(lengths), np.int64)
        np.cumsum(lengths[:-1], out=edge[1:])
        place = np.arange(int(edge[-1] + lengths[-1])) - np.repeat(edge, lengths)
        values = (data[inside].astype(np.uint64) + np.uint64(1)) * powers[place]
        self.hashes = mix(np.add.reduceat(values, edge) + lengths.astype(np.uint64) * _STEP)

    def text_of(self) -> np.ndarray:
        """Index of the text that holds each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether they all belong to the same text."""
        n = len(self.hashes)
        out = np.zeros(n, np.uint64)
        for j in range(k):
            out[:max(n - j, 0)] += self.hashes[j:] * _gram_factor(j)
        left = np.repeat(self.first[1:], self.counts) - np.arange(n)
        return mix(out), left >= k


def _gram_factor(j: int) -> np.uint64:
    return np.uint64(pow(0xD6E8FEB86659FD93, j + 1, 1 << 64))


def gram_hash(words: list[str]) -> int:
    """The hash that :meth:`Words.grams` gives to exactly these words, as a signed 64-bit number."""
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    hashes, _ = Words(LOWER[data], np.array([0, len(data)]), SPACED).grams(len(words))
    return int(hashes[:1].view(np.int64)[0])


def per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marked bytes each text has."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def code_points(data: np.ndarray) -> np.ndarray:
    """Marks the first byte of each code point."""
    return (data & 0xC0) != 0x80
