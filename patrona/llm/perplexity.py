"""Quality rules with n-gram perplexity.

A modified Kneser-Ney model of byte 5-grams is counted by Spark over all texts and
kept in sorted arrays; no byte is folded and no n-gram is left out. A document is
scored by the model of all others: its own counts are taken off at every order, so a
text cannot vouch for itself. It passes when its mean bits per byte lie inside the band
of its language and the base rules hold; a language of few documents takes the band of all.

No place holds the whole model. Each partition of the texts (a block) sums its n-grams and
deals them out by the three bytes before the last. What orders 4 and 5 need, counts of
an n-gram, of its context and of its ending, then stands together in one part, which
sends every block the figures of the block's own n-grams; a text asks for no others.
Orders 1 to 3 have at most 256**3 entries for any corpus: this is the bound under which
they are broadcast.

Defined cases: a null or empty text has no words, fails the base rules and has
null ``bits``; a null language is one of its own, apart from an empty one; repeated rows
are scored one by one, each without its own counts; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrona.llm import text as T
from patrona.scale import lookup_join, row_value
from patrona.session import discard, materialize

ORDER, BITS = 4, 6
#: Order of the model of whole bytes, and the orders that are broadcast; the others are dealt out in parts.
WIDE, SHARED, BYTE = 5, 3, 8
#: Texts and bytes scored at once inside a task; the number of a text stands above the n-gram in one long.
CHUNK_TEXTS, CHUNK_BYTES = 1 << 14, 1 << 18

#: 6-bit class of each byte: white space, line end, digits, marks, letters, capitals, beyond ASCII.
CLASSES = np.zeros(256, np.int32)
CLASSES[0x21:0x7F] = 3 + np.arange(0x21, 0x7F) % 9
CLASSES[0x0A] = 1
CLASSES[0x30:0x3A] = 2
CLASSES[0x61:0x7B] = 12 + np.arange(26)
CLASSES[0x41:0x5B] = 38 + np.arange(26) % 10
CLASSES[0x80:] = 48 + np.arange(128) % 16

_SYMBOL_BYTES = np.zeros(256, bool)
_SYMBOL_BYTES[list(b"#*$%&|<>")] = True


def gram_keys(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray = CLASSES, order: int = ORDER,
              bits: int = BITS) -> np.ndarray:
    """The n-gram of classes that ends at each byte; the text start counts as white space."""
    symbols = classes[data].astype(np.int64)
    keys = symbols.copy()
    begins = offsets[:-1]
    for back in range(1, order):
        earlier = np.zeros_like(symbols)
        earlier[back:] = symbols[:-back]
        for j in range(back):
            at = begins + j
            earlier[at[at < offsets[1:]]] = classes[0x20]
        keys |= earlier << (bits * back)
    return keys


def byte_grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The byte 5-gram that ends at each byte, exact."""
    return gram_keys(data, offsets, np.arange(256), WIDE, BYTE)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)


def _runs_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal values of a sorted array begin, and the run of each place."""
    change = np.ones(len(keys), bool)
    change[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(change), np.cumsum(change) - 1


def _by_context(keys: np.ndarray, values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Per context of sorted n-grams: the sum of the values, and how many are 1, 2 and 3 or more."""
    first, group = _runs_of(keys >> bits)
    kinds = np.bincount(group * 3 + np.minimum(values, 3) - 1, minlength=3 * len(first)).reshape(-1, 3)
    return np.bincount(group, values, len(first)).astype(np.int64), kinds


def _shorter(keys: np.ndarray, order: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct endings of that order, and how many of the n-grams end so."""
    return np.unique(keys & ((1 << (bits * order)) - 1), return_counts=True)


class GramModel:
    """Interpolated modified Kneser-Ney probabilities, in sorted arrays per order, of n-grams that are all known.

    An entry points to its context and to its ending, the entry of the order below.
    """

    def __init__(self, bits: int, below: GramModel | None = None):
        self.width = bits
        for name in ("keys", "values", "contexts", "context", "ending", "totals", "mass", "discounts", "share"):
            setattr(self, name, list(getattr(below, name)) if below else [])

    def add(self, keys: np.ndarray, values: np.ndarray, totals: np.ndarray, kinds: np.ndarray,
            discount: np.ndarray) -> None:
        """The next order: sorted n-grams and their counts; sums and kinds of the counts of each context."""
        first, context = _runs_of(keys >> self.width)
        mass = kinds @ discount[1:]
        if self.keys:
            ending = np.searchsorted(self.keys[-1], keys & ((1 << (self.width * len(self.keys))) - 1))
            lower = self.share[-1][ending]
        else:
            ending, lower = np.zeros(len(keys), np.int64), np.full(len(keys), 1 / (1 << self.width))
        share = (values - discount[np.minimum(values, 3)] + mass[context] * lower) / totals[context]
        for name, array in (("keys", keys), ("values", values), ("contexts", keys[first] >> self.width),
                            ("context", context.astype(np.int32)), ("ending", ending.astype(np.int32)),
                            ("totals", totals), ("mass", mass), ("discounts", discount), ("share", share)):
            getattr(self, name).append(array)

    def left_out_bits(self, keys: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
        """Total bits of each text under the model without that text's own counts.

        ``keys`` are the n-grams of the highest order and ``text`` the texts they stand in.
        """
        if not len(keys):
            return np.zeros(n_texts)
        order = len(self.keys)
        cells, own = np.unique((text.astype(np.int64) << (self.width * order)) | keys, return_counts=True)
        text, gram = cells >> (self.width * order), cells & ((1 << (self.width * order)) - 1)
        known = self.keys[-1]
        at = np.minimum(np.searchsorted(known, gram), len(known) - 1)
        if not np.array_equal(known[at], gram):
            raise ValueError("a text holds n-grams that were not counted: its rows changed between two reads")
        value, context, ending, discount = self.values[-1][at], self.context[-1][at], self.ending[-1][at], self.discounts[-1]
        rest = value - own
        first, group = _runs_of(cells >> self.width)  # n-grams of one text and context
        freed = discount[np.minimum(value, 3)] - discount[np.minimum(rest, 3)]
        total = self.totals[-1][context] - np.add.reduceat(own, first)[group]
        mass = self.mass[-1][context] - np.add.reduceat(freed, first)[group]
        gone = np.flatnonzero(rest == 0)
        lower = self._left_out(text, ending, text[gone], ending[gone], order - 1)
        bits = -np.log2(_interpolated(rest, discount, total, mass, lower))
        return np.bincount(text, bits * own, n_texts)

    def _left_out(self, text: np.ndarray, entry: np.ndarray, gone_text: np.ndarray, gone_entry: np.ndarray,
                  order: int) -> np.ndarray:
        """Probability of each (text, entry) of that order; each gone pair takes 1 off the entry's count in that text.

        Texts hold few n-grams that no other has, so the model as it stands is mended where one is gone.
        """
        if order == 0:
            return np.full(len(text), 1 / (1 << self.width))
        level = order - 1
        out = self.share[level][entry]
        if not len(gone_text):
            return out
        values, context, ending, discount = (getattr(self, name)[level] for name in (
            "values", "context", "ending", "discounts"))
        n_entries, n_contexts = len(values), len(self.totals[level])
        pairs, taken = np.unique(gone_text * n_entries + gone_entry, return_counts=True)
        pair_text, pair_entry = pairs // n_entries, pairs % n_entries
        before, after = values[pair_entry], values[pair_entry] - taken
        touched, place = np.unique(pair_text * n_contexts + context[pair_entry], return_inverse=True)
        off_total = np.bincount(place, taken, len(touched))
        off_mass = np.bincount(place, discount[np.minimum(before, 3)] - discount[np.minimum(after, 3)], len(touched))
        marked = np.zeros(int(text.max()) + 1, bool)
        marked[gone_text] = True
        some = np.flatnonzero(marked[text])
        text, entry = text[some], entry[some]
        none = after == 0
        lower = self._left_out(text, ending[entry], pair_text[none], ending[pair_entry[none]], level)
        own_context = text * n_contexts + context[entry]
        maybe = np.zeros(1 << 20, bool)
        maybe[touched & ((1 << 20) - 1)] = True
        change = maybe[own_context & ((1 << 20) - 1)]
        if level:
            change |= lower != self.share[level - 1][ending[entry]]
        some, text, entry, lower, own_context = (x[change] for x in (some, text, entry, lower, own_context))
        at, met = _found(touched, own_context)
        total = self.totals[level][context[entry]] - np.where(met, off_total[at], 0)
        mass = self.mass[level][context[entry]] - np.where(met, off_mass[at], 0)
        at, met = _found(pairs, text * n_entries + entry)
        rest = values[entry] - np.where(met, taken[at], 0)
        out[some] = _interpolated(rest, discount, total, mass, lower)
        return out

    def probability(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Probability of the last symbol of any n-grams, known or not, given the symbols before it."""
        if order == 0 or not len(self.keys[order - 1]):
            return np.full(len(keys), 1 / (1 << self.width))
        level = order - 1
        at, met = _found(self.keys[level], keys)
        out = self.share[level][at]
        new = np.flatnonzero(~met)
        if len(new):
            at, met = _found(self.contexts[level], keys[new] >> self.width)
            freed = np.where(met, self.mass[level][at] / self.totals[level][at], 1)
            out[new] = freed * self.probability(keys[new] & ((1 << (self.width * level)) - 1), level)
        return out

    def cost(self, keys: np.ndarray) -> np.ndarray:
        """Bits of the last symbol of each n-gram of the highest order, given the symbols before it."""
        return -np.log2(self.probability(keys, len(self.keys)))


class KneserNey(GramModel):
    """The model of n-grams and their counts, all orders at once."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int = ORDER, bits: int = BITS):
        super().__init__(bits)
        by_key = np.argsort(grams)
        levels = [(grams[by_key].astype(np.int64), counts[by_key].astype(np.int64))]
        for shorter in range(order - 1, 0, -1):  # lower orders count the distinct symbols before
            levels.insert(0, _shorter(levels[0][0], shorter, bits))
        for keys, values in levels:
            self.add(keys, values, *_by_context(keys, values, bits), _discounts(values))


def _found(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value in a sorted array, and whether it is there."""
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


def _interpolated(rest, discount, total, mass, lower) -> np.ndarray:
    kept = np.maximum(rest - discount[np.minimum(rest, 3)], 0)
    return np.where(total > 0, (kept + np.maximum(mass, 0) * lower) / np.maximum(total, 1), lower)


def _counts_of_counts(values: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(values, 5), minlength=6)[1:5]


def _discounts(values: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more; halves where a count is not met."""
    return _discounts_from(_counts_of_counts(values))


def _discounts_from(met: np.ndarray) -> np.ndarray:
    n1, n2, n3, n4 = met.astype(float)
    if not (n1 and n2 and n3):
        return np.array([0, 0.5, 0.75, 0.75])
    y = n1 / (n1 + 2 * n2)
    found = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(found, [0, 0.05, 0.05, 0.05], [0, 0.95, 1.9, 2.9])


def _packed(numbers: np.ndarray) -> bytes:
    return zlib.compress(numbers.astype(np.int64).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.int64)


def _chunks(rows: Iterable) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Rows (doc_id, text as bytes, lang) by about ``CHUNK_BYTES`` of text: (rows, bytes, offsets of the texts)."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1] or b"")
        if size >= CHUNK_BYTES or len(held) >= CHUNK_TEXTS:
            yield _chunk(held)
            held, size = [], 0
    if held:
        yield _chunk(held)


def _chunk(rows: list) -> tuple[list, np.ndarray, np.ndarray]:
    texts = [row[1] or b"" for row in rows]
    return rows, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _part_of(contexts: np.ndarray, parts: int) -> np.ndarray:
    """The part that holds these contexts: by their last three bytes."""
    return (T.mix((contexts & 0xFFFFFF).astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _block_counts(parts: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        keys, counts, n_rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for rows, data, offsets in T.chunks(batches, max_bytes=CHUNK_BYTES):
            n_rows += len(rows)
            found, n = np.unique(byte_grams(data, offsets), return_counts=True)
            keys.append(found)
            counts.append(n)
            if sum(map(len, keys[1:])) > max(len(keys[0]), 1 << 19):  # as much new as is held
                merged = _summed(keys, counts)
                keys, counts = [merged[0]], [merged[1]]
        keys, counts = _summed(keys, counts)
        part = _part_of(keys >> BYTE, parts)
        by_part = np.argsort(part, kind="stable")
        keys, counts, cuts = keys[by_part], counts[by_part], np.searchsorted(part[by_part], np.arange(parts + 1))
        for p in range(parts):
            own = slice(cuts[p], cuts[p + 1])
            if p == block or cuts[p] < cuts[p + 1]:
                yield pa.RecordBatch.from_pylist([{
                    "part": p, "block": block, "n_rows": n_rows if p == block else 0,
                    "grams": _packed(np.diff(keys[own], prepend=0)), "counts": _packed(counts[own])}])
    return task


def gram_counts(docs: DataFrame, parts: int) -> DataFrame:
    """(part, block, n_rows, grams, counts): how often each byte 5-gram occurs in each partition of the texts, by parts.

    A block's number of rows is told to the part of the same number.
    """
    return docs.select("text").mapInArrow(
        _block_counts(parts), "part long, block long, n_rows long, grams binary, counts binary")


def _part_figures(messages: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int, tuple]]:
    """What a part knows: for each block the figures of its n-grams, and for block 0 a share of those of all."""
    sent = [(block, n_rows, np.cumsum(_unpacked(keys)), _unpacked(counts)) for _, (block, n_rows, keys, counts) in messages]
    if not sent:
        return
    levels = [_summed([keys for _, _, keys, _ in sent], [counts for *_, counts in sent])]
    for order in range(WIDE - 1, SHARED - 1, -1):
        levels.append(_shorter(levels[-1][0], order, BYTE))
    shared, counted = levels.pop(), np.concatenate([_counts_of_counts(values) for _, values in levels])
    yield 0, ("all", _packed(counted), _packed(np.diff(shared[0], prepend=0)), _packed(shared[1]))
    levels = [(keys, values, keys[_runs_of(keys >> BYTE)[0]] >> BYTE, *_by_context(keys, values, BYTE))
              for keys, values in levels]
    for block, n_rows, own, _ in sent:
        figures = []
        for order, (keys, values, contexts, totals, kinds) in zip(range(WIDE, SHARED, -1), levels):
            wanted = _shorter(own, order, BYTE)[0]
            at = np.searchsorted(contexts, wanted[_runs_of(wanted >> BYTE)[0]] >> BYTE)
            figures += [values[np.searchsorted(keys, wanted)], totals[at], kinds[at].ravel()]
        yield block, ("own", n_rows, _packed(np.diff(own, prepend=0)), _packed(np.concatenate(figures)))


def _shared_figures(messages: Iterator[tuple[int, tuple]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Counts of counts of the orders that are dealt out and the n-grams of the highest shared one."""
    counted, keys, counts = np.zeros(4 * (WIDE - SHARED), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _, (kind, *packed) in messages:
        if kind == "all":
            some, diffs, n = map(_unpacked, packed)
            counted += some
            keys.append(np.cumsum(diffs))
            counts.append(n)
            if len(keys) > 8:
                merged = _summed(keys, counts)
                keys, counts = [merged[0]], [merged[1]]
    return [(counted, *_summed(keys, counts))]


def _with_rows(messages: Iterator[tuple[int, tuple]]) -> Iterator[list[tuple] | None]:
    """As many entries as the block has rows; the first holds all its figures."""
    own = [packed for _, (kind, *packed) in messages if kind == "own"]
    for i in range(sum(n_rows for n_rows, _, _ in own)):
        yield None if i else [packed for _, *packed in own]


def _block_model(shared: KneserNey, discounts: list[np.ndarray], packed: list[tuple]) -> GramModel:
    """The model of the n-grams of one block, in the order of its parts' messages and then sorted."""
    parts = [(np.cumsum(_unpacked(keys)), _unpacked(figures)) for keys, figures in packed]
    done, levels = [0] * len(parts), []
    for order in range(WIDE, SHARED, -1):
        taken = ([], [], [], [], [])
        for i, (own, figures) in enumerate(parts):
            keys = _shorter(own, order, BYTE)[0]
            contexts = keys[_runs_of(keys >> BYTE)[0]] >> BYTE
            cuts = done[i] + np.cumsum([0, len(keys), len(contexts), 3 * len(contexts)])
            values, totals, kinds = (figures[a:b] for a, b in zip(cuts[:-1], cuts[1:]))
            for into, array in zip(taken, (keys, values, contexts, totals, kinds.reshape(-1, 3))):
                into.append(array)
            done[i] = cuts[-1]
        keys, values, contexts, totals, kinds = map(np.concatenate, taken)
        by_key, by_context = np.argsort(keys), np.argsort(contexts)
        levels.append((keys[by_key], values[by_key], totals[by_context], kinds[by_context]))
    model = GramModel(BYTE, shared)
    for level, discount in zip(levels[::-1], discounts[::-1]):
        model.add(*level, discount)
    return model


def _repeated_words(words: T.Words, window: int = 8) -> np.ndarray:
    """Per text, words inside windows of 8 words that are found twice or more in the text."""
    keys, whole = words.grams(window)
    at = np.flatnonzero(whole)
    keys = keys[at] + T.mix(words.text_of()[at].astype(np.uint64) + np.uint64(1))
    by_key = np.argsort(keys)
    same = keys[by_key][1:] == keys[by_key][:-1]
    twice = at[by_key[np.r_[same, False] | np.r_[False, same]]] if len(at) else at
    edge = np.zeros(len(words.hashes) + window + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    covered = np.cumsum(edge)[:len(words.hashes)] > 0
    return T.per_text(covered, words.first)


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


_SCORED = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, n_bytes long, bits double")


def _score_task(model):
    def task(pairs: Iterator[tuple]) -> Iterator[tuple]:
        pairs = iter(pairs)
        head = next(pairs, None)
        if head is None:
            return
        own = _block_model(*model.value, head[1])
        for rows, data, offsets in _chunks(row for some in ([head], pairs) for row, _ in some):
            words = T.Words(data, offsets, T.SPACED)
            size = np.diff(offsets)
            text = np.repeat(np.arange(len(size)), size)
            bits = own.left_out_bits(byte_grams(data, offsets), text, len(size)) / np.maximum(size, 1)
            raw = data.tobytes()
            lines = [_repeated_lines(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            counts = (words.counts, T.per_text(words.inside & T.code_points(data), offsets),
                      T.per_text(_SYMBOL_BYTES[data], offsets), np.array(lines), _repeated_words(words), size)
            for (key, _, lang), *n, cost in zip(rows, *(c.tolist() for c in counts), bits.tolist()):
                yield key, lang, *n, cost if n[-1] else None
    return task


def _side_by_side(rows: RDD, figures: RDD) -> RDD:
    """Each row beside an entry of its block; a session may deal the figures out to more partitions than there are blocks."""
    more = figures.getNumPartitions() - rows.getNumPartitions()
    return (rows.union(rows.context.parallelize([], more)) if more > 0 else rows).zip(figures)


def scored_texts(docs: DataFrame) -> DataFrame:
    """Base counts, ``n_bytes`` and ``bits`` per byte of every document (doc_id, text, lang), written once.

    The texts are read twice, each time in the same partitions.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"), "lang").rdd
    blocks = max(rows.getNumPartitions(), 1)
    grams = materialize(gram_counts(docs, blocks), "perplexity-grams")
    dealt = grams.rdd.map(lambda r: (r[0], tuple(r[1:]))).partitionBy(blocks, int)
    figures = dealt.mapPartitions(_part_figures).partitionBy(blocks, int)
    counted, shared, n = spark.sparkContext.runJob(figures, _shared_figures, [0])[0]
    model = spark.sparkContext.broadcast((KneserNey(shared, n, SHARED, BYTE),
                                          [_discounts_from(some) for some in counted.reshape(-1, 4)]))
    if not rows.getNumPartitions():
        return materialize(spark.createDataFrame([], _SCORED), "perplexity")
    pairs = _side_by_side(rows, figures.mapPartitions(_with_rows))
    scored = materialize(spark.createDataFrame(pairs.mapPartitions(_score_task(model)), _SCORED, verifySchema=False),
                         "perplexity")
    discard(grams)
    return scored


def bands(scored: DataFrame, spread: float, least: float, least_documents: int) -> DataFrame:
    """(lang, middle, half): median bits and half the band, from exact medians of binned bits.

    One row per language of ``least_documents`` documents or more, and one for all under a null ``lang``.
    """
    bins = scored.where("not base_failed").groupBy("lang", F.round(F.col("bits") * 200).alias("bin")).count()
    bins = materialize(bins, "perplexity-bins")
    every = bins.groupBy("bin").agg(F.sum("count").alias("count")).withColumn("lang", F.lit(None).cast("string"))
    bins = bins.unionByName(every)
    middle = bins.groupBy("lang").agg(F.percentile("bin", 0.5, F.col("count")).alias("middle"),
                                      F.sum("count").alias("n"))
    away = bins.alias("b").join(middle.alias("m"), F.expr("b.lang <=> m.lang")).groupBy("b.lang", "middle", "n").agg(
        F.percentile(F.abs(F.col("bin") - F.col("middle")), 0.5, F.col("count")).alias("away"))
    return away.where((F.col("n") >= least_documents) | F.col("lang").isNull()).select(
        "lang", (F.col("middle") / 200).alias("middle"),
        F.greatest(F.lit(least), spread * 1.4826 * F.col("away") / 200).alias("half"))


def quality_rules(docs: DataFrame, spread: float = 1.5, least: float = 0.03, per_root_byte: float = 4.5,
                  least_documents: int = 50) -> DataFrame:
    """Base counts, ``bits`` per byte, band and ``kept`` for every document (doc_id, text, lang).

    The band of a language is its median +- the larger of ``least`` and ``spread``
    robust standard deviations; ``per_root_byte / sqrt(bytes)`` widens it for short texts.
    Languages of fewer than ``least_documents`` documents share the band of all.
    """
    scored = scored_texts(docs).withColumns({
        "lang": F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")),  # a null language is one of its own
        "base_failed": F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")})
    limits = materialize(bands(scored, spread, least, least_documents), "perplexity-bands")
    slack = per_root_byte / F.sqrt(F.greatest("n_bytes", F.lit(1)))
    shared = row_value(limits.where("lang is null").agg(F.max("middle").alias("m"), F.max("half").alias("h")))
    joined = lookup_join(scored, limits.where("lang is not null"), "lang").withColumn("_all", shared).withColumns({
        "middle": F.coalesce("middle", "_all.m"), "half": F.coalesce("half", "_all.h")}).withColumns({
        "lower_bits": F.col("middle") - F.col("half") - slack, "upper_bits": F.col("middle") + F.col("half") + slack})
    inside = F.col("bits").between(F.col("lower_bits"), F.col("upper_bits"))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", F.coalesce(~F.col("base_failed") & inside, F.lit(False)).alias("kept"),
                         "bits", "lower_bits", "upper_bits")
