"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a doubly linked list of parts. For every mergeable pair of
neighbours its left position stands in the bucket of the pair's merge rank; a
two-level bitmap over the ranks finds the lowest non-empty bucket by
find-first-set. Positions whose pair has changed since are stale and skipped when
their bucket is read. A merge costs a bounded number of steps whatever the length
of the pre-token. Many short pre-tokens share one queue: their lists stand side by
side in arrays and a bucket is merged in all of them at once.

Ranks come from a public rank file; a merge is any pair of parts whose joined
bytes have a rank, lowest rank first and leftmost among equals.

Defined cases: a null or empty text has no ids; repeated rows are encoded one by
one; a null id stays null; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from patrona.llm import text as T

#: Bytes, about, of the pieces remembered between calls, of both kinds, before they are forgotten; and those of an entry.
CACHE_BYTES, ENTRY_BYTES = 48 << 20, 220
#: Pre-tokens up to this length are merged side by side, longer ones one by one.
SHORT_BYTES = 64
#: Text encoded at once inside a task.
CHUNK_BYTES = 1 << 20
#: A space beside other white space does not always begin a token.
_OTHER_SPACE = re.compile(r" \s").search


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token bytes from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class RankQueue:
    """Buckets by rank, a bitmap of the non-empty buckets of every 256 ranks, and a bitmap of those above it."""

    def __init__(self):
        self.buckets: dict[int, list] = {}
        self.leaves: dict[int, int] = {}
        self.top = 0

    def push(self, rank: int, item) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(item)
            return
        self.buckets[rank] = [item]
        group = rank >> 8
        self.leaves[group] = self.leaves.get(group, 0) | 1 << (rank & 255)
        self.top |= 1 << group

    def pop(self) -> tuple[int, list]:
        """The lowest rank and its bucket, which leaves the queue."""
        group = (self.top & -self.top).bit_length() - 1
        bits = self.leaves[group]
        rank = group << 8 | (bits & -bits).bit_length() - 1
        bits &= bits - 1
        self.leaves[group] = bits
        if not bits:
            self.top &= self.top - 1
        return rank, self.buckets.pop(rank)


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token of any length."""
    get = ranks.get
    n = len(piece)
    end = list(range(1, n + 1))  # part at i covers piece[i:end[i]]; 0 once it is merged away
    before = list(range(-1, n - 1))
    pair = [-1] * n  # rank of the pair that begins at i, as last pushed
    queue = RankQueue()

    def note(at: int, joined: int | None) -> None:
        pair[at] = -1 if joined is None else joined
        if joined is not None:
            queue.push(joined, at)

    for i in range(n - 1):
        note(i, get(piece[i:i + 2]))
    while queue.top:
        rank, bucket = queue.pop()
        bucket.sort()
        for place, i in enumerate(bucket):
            if pair[i] != rank or not end[i]:
                continue  # stale: the part or its neighbour was merged meanwhile
            right = end[i]
            stop = end[right]
            end[i], end[right], pair[right], pair[i] = stop, 0, -1, -1
            if stop < n:
                before[stop] = i
                note(i, get(piece[i:end[stop]]))
            left = before[i]
            if left >= 0:
                note(left, get(piece[left:stop]))
            if -1 < pair[i] < rank or left >= 0 and -1 < pair[left] < rank:
                for later in bucket[place + 1:]:  # a lower rank goes first
                    queue.push(rank, later)
                break
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class PairTable:
    """Rank of two neighbouring tokens' joined bytes, for arrays of tokens: sorted keys of all splits of all tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, joined = [], []
        get = ranks.get
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left = get(token[:cut])
                if left is not None:
                    right = get(token[cut:])
                    if right is not None:
                        keys.append(left << 32 | right)
                        joined.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.joined = np.array(joined, np.int32)[order]
        self.single = np.array([get(bytes([b]), -1) for b in range(256)], np.int32)
        self.bytes = np.array([get(bytes([a, b]), -1) for a in range(256) for b in range(256)], np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.joined[at], -1) if len(self.keys) else np.full(len(keys), -1)


def _push_groups(queue: RankQueue, ranks: np.ndarray, at: np.ndarray) -> None:
    if len(ranks) == 1:
        queue.push(int(ranks[0]), at)
        return
    order = np.argsort(ranks if ranks.max() >> 16 else ranks.astype(np.uint16), kind="stable")  # 16 bits: radix sort
    ranks, at = ranks[order], at[order]
    cuts = (np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist()
    starts = [0, *cuts]
    for rank, start, stop in zip(ranks[starts].tolist(), starts, [*cuts, len(at)]):
        queue.push(rank, at[start:stop])


def encode_pieces(pieces: list[bytes], table: PairTable) -> list[list[int]]:
    """Ids of many short pre-tokens."""
    ids, counts = _merged(np.frombuffer(b"".join(pieces), np.uint8), np.array([len(p) for p in pieces], np.int64), table)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] if pieces else []


def _merged(data: np.ndarray, sizes: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of short pre-tokens that stand one after the other in ``data``, merged side by side through one rank queue.

    Returns all ids and their number per pre-token.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(len(sizes), np.int64)
    token = table.single[data]
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    stops = np.cumsum(sizes)
    full = sizes > 0
    after[stops[full] - 1] = -1
    before[stops[full] - sizes[full]] = -1
    alive = np.ones(n, bool)
    pair = np.full(n, -1, np.int32)
    pair[:-1] = table.bytes[data[:-1].astype(np.uint16) << 8 | data[1:]]
    pair[after < 0] = -1
    queue = RankQueue()
    first = np.flatnonzero(pair >= 0).astype(np.int32)
    if len(first):
        _push_groups(queue, pair[first], first)
    while queue.top:
        rank, bucket = queue.pop()
        if len(bucket) == 1:  # ascending as it is
            at = bucket[0]
        else:
            at = np.concatenate(bucket)
            at.sort()
            at = at[np.append(True, at[1:] != at[:-1])]
        at = at[pair[at] == rank]  # the others are stale
        if not len(at):
            continue
        right = after[at]
        stop = after[right]
        if len(at) > 1:
            close = (at[1:] == right[:-1]) | (at[1:] == stop[:-1])
            if close.any():  # of pairs that touch, the leftmost goes first; the others wait in their bucket
                wait = np.append(False, close)
                queue.push(rank, at[wait])
                at, right, stop = at[~wait], right[~wait], stop[~wait]
        token[at], after[at], pair[at], pair[right], alive[right] = rank, stop, -1, -1, False
        left = before[at]
        on, off = stop >= 0, left >= 0
        ahead, behind, next_part = at[on], left[off], stop[on]
        before[next_part] = ahead
        lead = np.concatenate([ahead, behind])
        joined = table.rank(token[lead], token[np.concatenate([next_part, at[off]])])
        pair[lead] = joined
        good = joined >= 0
        lead = lead[good]
        if len(lead):
            lead.sort()
            _push_groups(queue, pair[lead], lead)
    kept = np.zeros(n + 1, np.int64)
    np.cumsum(alive, out=kept[1:])
    return token[alive].astype(np.uint32), kept[stops] - kept[stops - sizes]


def _flat(values: pa.LargeBinaryArray | pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an array without nulls."""
    if not len(values):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    return offsets, np.frombuffer(values.buffers()[2] or b"", np.uint8)


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.LargeBinaryArray:
    """Array of the byte ranges between the offsets."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


class Codec:
    """Encoder and decoder for whole texts; remembers the ids of pieces between calls, a bounded number of them.

    Remembered ids are bytes, four an id: a list of them takes four times the memory.

    A text is cut before every space that something other than white space follows:
    with the public pattern a token never reaches across such a place. The distinct
    pieces between are split by the pattern, those alone that are not remembered.
    Whatever is done per piece of a text, token or id is done by Arrow for many texts.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, table: PairTable | None = None):
        import regex
        self.ranks, self.split, self.cut = ranks, regex.compile(pattern).findall, regex.compile(r" (?=\S)").split
        self.table = table or PairTable(ranks)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.whole = pa.array(ranks, pa.large_binary())
        self.whole_ids = np.fromiter(ranks.values(), np.uint32, len(ranks))
        every = range(max(ranks.values(), default=-1) + 1)
        self.token_bytes = pa.array([self.bytes_of.get(rank, b"") for rank in every], pa.large_binary())
        self.numbers = pa.array([b"%d," % rank for rank in every], pa.large_binary())
        self.spaced: dict[str, bytes] = {}
        self.held = 0

    def _token_ids(self, tokens: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of distinct tokens."""
        raw = tokens.cast(pa.large_binary())
        offsets, data = _flat(raw)
        sizes = np.diff(offsets)
        whole = pc.index_in(raw, self.whole)
        known = whole.is_valid().to_numpy(zero_copy_only=False)
        short, long = ~known & (sizes <= SHORT_BYTES), ~known & (sizes > SHORT_BYTES)
        some = raw.filter(pa.array(short))
        at, merged = _flat(some)
        merged, n_merged = _merged(merged[at[0]:at[-1]], np.diff(at), self.table)
        apart = [np.array(encode_piece(piece, self.ranks), np.uint32) for piece in raw.filter(pa.array(long)).to_pylist()]
        # all ids, kind after kind, and the place of each token among them
        places, counts = np.empty(len(raw), np.int64), [n_merged, [len(ids) for ids in apart], np.ones(known.sum(), int)]
        places[np.concatenate([np.flatnonzero(short), np.flatnonzero(long), np.flatnonzero(known)])] = range(len(raw))
        ids = np.concatenate([merged, *apart, self.whole_ids[whole.drop_null().to_numpy()]])
        return _binary(4 * _running(np.concatenate(counts)), ids.view(np.uint8)).take(pa.array(places))

    def _piece_ids(self, pieces: list[str]) -> pa.LargeBinaryArray:
        """Ids of pieces, each split by the pattern."""
        split = list(map(self.split, pieces))
        tokens = pa.array(list(chain.from_iterable(split)), pa.large_string()).dictionary_encode()
        at, data = _flat(self._token_ids(tokens.dictionary).take(tokens.indices))
        return _binary(at[_running(list(map(len, split)))], data)

    def _pieces(self, texts: pa.LargeStringArray) -> pa.LargeListArray:
        """The pieces of each text; the space before each but the first is left out."""
        odd = [("  " in text or text[-1:] == " " or _OTHER_SPACE(text) is not None) for text in texts.to_pylist()]
        pieces = pc.split_pattern(texts, " ")
        if any(odd):
            again = pa.array([self.cut(text) for text in texts.filter(pa.array(odd)).to_pylist()], pieces.type)
            order = np.arange(len(texts))
            order[odd] = len(texts) + np.arange(len(again))
            pieces = pa.concat_arrays([pieces, again]).take(pa.array(order))
        return pieces

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the offsets of the texts among them; null is empty."""
        pieces = self._pieces(pc.fill_null(texts.cast(pa.large_string()), ""))
        bounds = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset:pieces.offset + len(pieces) + 1].astype(np.int64)
        values, bounds = pieces.flatten(), bounds - bounds[0]
        later = np.ones(len(values), bool)
        later[bounds[:-1]] = False
        rest = values.filter(pa.array(later)).dictionary_encode()
        distinct = rest.dictionary.to_pylist()
        ids = list(map(self.spaced.get, distinct))
        new = [piece for piece, known in zip(distinct, ids) if known is None]
        found = self._piece_ids([" " + piece for piece in new] + values.filter(pa.array(~later)).to_pylist())
        learnt = dict(zip(new, found[:len(new)].to_pylist()))
        ids = [learnt[piece] if known is None else known for piece, known in zip(distinct, ids)]
        self._remember(learnt)
        codes = np.empty(len(values), np.int64)
        codes[later] = rest.indices.to_numpy()
        codes[~later] = len(distinct) + np.arange(len(pieces))
        at, data = _flat(pa.concat_arrays([pa.array(ids, pa.large_binary()), found[len(new):]]).take(pa.array(codes)))
        return data[:at[-1]].view(np.uint32), at[bounds] >> 2

    def _remember(self, learnt: dict[str, bytes]) -> None:
        if self.held > CACHE_BYTES:
            self.spaced.clear()
            self.held = 0
        self.spaced.update(learnt)
        self.held += sum(map(len, learnt)) + sum(map(len, learnt.values())) + len(learnt) * ENTRY_BYTES

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        ids, at = self.encode_column(pa.array(texts, pa.large_string()))
        return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def _running(counts) -> np.ndarray:
    """Sums of the counts before each place, and of all."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


#: The codec of a worker process, by the call it belongs to; the next task of the worker goes on with it.
_CODEC: dict[str, Codec] = {}


def _codec_task(setup, call: str, with_ids: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if call not in _CODEC:
            _CODEC.clear()
            _CODEC[call] = Codec(*setup.value)
        collecting = gc.isenabled()
        gc.disable()  # lists of tokens hold no cycles; counting references frees them
        try:
            for rows, _, _ in T.chunks(batches, max_bytes=CHUNK_BYTES):
                yield _encoded(_CODEC[call], rows, with_ids)
        finally:
            if collecting:
                gc.enable()
    return task


def _encoded(codec: Codec, rows: pa.RecordBatch, with_ids: bool) -> pa.RecordBatch:
    ids, at = codec.encode_column(rows.column("text"))
    counts, places = np.diff(at), pa.array(ids)
    shas = _digests(codec.numbers.take(places), at, 1)  # without the last comma
    columns = [rows.column("doc_id"), pa.array(counts), pa.array(shas),
               pa.array(_digests(codec.token_bytes.take(places), at, 0))]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if with_ids:
        columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names=names)


def _digests(parts: pa.LargeBinaryArray, at: np.ndarray, less: int) -> list[str]:
    """SHA-256 of the joined parts of each text, but for the last bytes."""
    offsets, data = _flat(parts)
    cuts = offsets[at].tolist()
    return [hashlib.sha256(data[a:max(a, b - less)]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:])]


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) for every whole text (doc_id, text).

    Pre-tokens are the matches of ``pattern``; ``ids`` are the token ids themselves.
    """
    setup = docs.sparkSession.sparkContext.broadcast((load_ranks(rank_file), pattern))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(_codec_task(setup, uuid.uuid4().hex, with_ids), schema)


def _decode_task(setup):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*setup.value)
        for rows in batches:
            texts = [codec.decode(ids or []).decode("utf-8", "replace") for ids in rows.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])
    return task


def decode_documents(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give an empty text."""
    setup = encoded.sparkSession.sparkContext.broadcast((load_ranks(rank_file), pattern))
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(_decode_task(setup), f"doc_id {kind}, text string")
