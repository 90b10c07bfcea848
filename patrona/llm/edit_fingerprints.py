"""Document fingerprints by a randomised edit embedding.

All texts share one table of random bits. A walk reads the character it stands on
at every step and, as the bit of (step, character) says, moves on or stays. Two
texts a few edits apart fall back into step after each edit, so their edit distance
becomes a Hamming distance between the read sequences. The fingerprint samples that
sequence: of the first 2n steps of a text of n characters, those with the smallest
hashes, the same for all texts of a length and mostly the same for near lengths.
Likeness is the share of agreeing samples at steps that both fingerprints sampled.

Candidate pairs come from bit-sampled bands: each band draws four sampled steps by
their number, and documents that read the same there meet in a bucket. Large buckets are
split by further bands until they are small; pairs are verified by bounded edit distance
on whole texts, and groups are what verified pairs connect.

Texts are walked side by side, sorted by length; a walk covers the whole text.

Defined cases: a null text is an empty one; an empty text has an empty sample, two
of them are alike (1) and one is unlike any other text (0); rows that repeat an id
are documents of their own, in the order of their text; null ids come last; very long
texts are walked whole; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patrona.llm import text as T
from patrona.llm.components import components
from patrona.session import materialize

SAMPLES = 64
PERIOD = 4096
#: Characters walked side by side, at most, unless one text is longer.
GROUP_CHARS = 3 << 20

_random = np.random.default_rng(8)
_MOVES = _random.integers(0, 2, (PERIOD, 256), dtype=np.uint8)


def _codes(text: str) -> np.ndarray:
    """8-bit hash (1 to 255) of each code point; 0 stands for the end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return ((points * np.uint32(2654435761) >> np.uint32(8)) % np.uint32(255) + np.uint32(1)).astype(np.uint8)


def _step_hash(steps: np.ndarray) -> np.ndarray:
    x = steps.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


_sampled: dict[int, np.ndarray] = {}


def sampled_steps(n_chars: int) -> np.ndarray:
    """The sampled steps of a text of this length, ascending."""
    found = _sampled.get(n_chars)
    if found is None:
        found = np.arange(2 * n_chars)
        if len(found) > SAMPLES:
            found = np.sort(np.argpartition(_step_hash(found), SAMPLES)[:SAMPLES])
        if len(_sampled) > 50_000:
            _sampled.clear()
        _sampled[n_chars] = found
    return found


def _walk(codes: list[np.ndarray]) -> list[np.ndarray]:
    """Sampled characters of each walk; the texts are given by descending length."""
    width = len(codes[0]) + 1
    table = np.zeros((len(codes), width), np.uint8)
    for row, own in zip(table, codes):
        row[:len(own)] = own
    flat, at = table.ravel(), np.arange(len(codes), dtype=np.int64) * width
    steps = [sampled_steps(len(own)) for own in codes]
    samples = np.zeros((len(codes), SAMPLES), np.uint8)
    # All (step, text, place) to be read, in step order
    order = np.concatenate([np.stack([s, np.full(len(s), i), np.arange(len(s))], 1) for i, s in enumerate(steps)])
    order = order[np.argsort(order[:, 0], kind="stable")]
    cuts = np.searchsorted(order[:, 0], np.arange(2 * (width - 1) + 1)).tolist()
    ends = np.array([2 * len(own) for own in codes])
    live = np.searchsorted(-ends, -np.arange(2 * (width - 1)), "left").tolist()  # texts whose walk still goes on
    for step in range(2 * (width - 1)):
        n = live[step]
        read = flat[at[:n]]
        a, b = cuts[step], cuts[step + 1]
        if a < b:
            samples[order[a:b, 1], order[a:b, 2]] = read[order[a:b, 1]]
        at[:n] += _MOVES[step % PERIOD][read] & (read != 0)
    return [samples[i, :len(s)] for i, s in enumerate(steps)]


def fingerprints(texts: list[str]) -> list[str]:
    """``length:hex samples`` of each text."""
    codes = [_codes(t) for t in texts]
    order = sorted(range(len(texts)), key=lambda i: -len(codes[i]))
    out = [""] * len(texts)
    start = 0
    while start < len(order):
        longest = len(codes[order[start]]) + 1
        stop = start + max(1, GROUP_CHARS // longest)
        group = order[start:stop]
        for i, samples in zip(group, _walk([codes[i] for i in group])):
            out[i] = f"{len(codes[i])}:{samples.tobytes().hex()}"
        start = stop
    return out


def likeness(one: str, other: str) -> float:
    """Share of agreeing samples among the steps sampled in both; 0 if none is shared."""
    if one == other:
        return 1.0
    (n, x), (m, y) = (part.split(":") for part in (one, other))
    _, i, j = np.intersect1d(sampled_steps(int(n)), sampled_steps(int(m)), assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    a, b = np.frombuffer(bytes.fromhex(x), np.uint8)[i], np.frombuffer(bytes.fromhex(y), np.uint8)[j]
    shared = float((a == b).mean())
    return shared * min(int(n), int(m)) / max(int(n), int(m))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many first characters of the following one."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third] if third else text


_RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
           "near_next double")


def _results(ids: list, texts: list[str], following: list[str], own: list[str], after: list[str]) -> list[tuple]:
    changed = [edited(t, f) for t, f in zip(texts, following)]
    return [(i, len(t), hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest(), f, g, likeness(f, g), likeness(f, h))
            for i, t, c, f, g, h in zip(ids, texts, changed, own, fingerprints(changed), after)]


def _columns(rows: list[tuple], kind: pa.DataType) -> list[pa.Array]:
    types = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return [pa.array([r[c] for r in rows], t) for c, t in enumerate(types)]


def _pair_task(kind: pa.DataType):
    """Results of each document but the last of the task; that one and the first come out with their texts."""
    names = ["part", "edge", "doc_id", *[c.split()[0] for c in _RESULT.split(", ")], "text"]

    def out(part: int, edge: int, rows: list[tuple], texts: list) -> pa.RecordBatch:
        n = len(rows)
        return pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array([edge] * n, pa.int32()),
                                           *_columns(rows, kind), pa.array(texts, pa.string())], names=names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        waiting: tuple | None = None  # the last document so far: id, text, fingerprint
        for whole in batches:
            for start in range(0, len(whole), 1024):
                batch = whole.slice(start, 1024)
                ids = batch.column("doc_id").to_pylist()
                texts = [t or "" for t in batch.column("text").to_pylist()]
                own = fingerprints(texts)
                if waiting is None:
                    yield out(part, 1, [(ids[0], len(texts[0]), None, own[0], None, None, None)], [texts[0]])
                else:
                    ids, texts, own = [waiting[0], *ids], [waiting[1], *texts], [waiting[2], *own]
                rows = _results(ids[:-1], texts[:-1], texts[1:], own[:-1], own[1:])
                yield out(part, 0, rows, [None] * len(rows))
                waiting = (ids[-1], texts[-1], own[-1])
        if waiting is not None:
            yield out(part, 2, [(waiting[0], len(waiting[1]), None, waiting[2], None, None, None)], [waiting[1]])
    return task


def _edge_task(kind: pa.DataType):
    names = ["doc_id", *[c.split()[0] for c in _RESULT.split(", ")]]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            get = lambda c: b.column(c).to_pylist()
            rows = _results(get("doc_id"), get("text"), get("next_text"), get("fingerprint"), get("next_fingerprint"))
            yield pa.RecordBatch.from_arrays(_columns(rows, kind), names=names)
    return task


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edit with the next document, by descending doc_id.

    One range partitioning puts neighbours side by side. Only the first and last
    document of each partition are carried over to the next one.
    """
    spark = docs.sparkSession
    field = docs.select("doc_id").schema[0].dataType
    kind = pa.int64() if field.simpleString() == "bigint" else pa.int32() if field.simpleString() == "int" else pa.string()
    name, order = field.simpleString(), [F.col("doc_id").desc_nulls_last(), F.col("text")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    side = docs.select("doc_id", "text").repartitionByRange(n, order[0]).sortWithinPartitions(*order)
    found = materialize(side.mapInArrow(
        _pair_task(kind), f"part int, edge int, doc_id {name}, {_RESULT}, text string"), "fingerprints")
    # One first and one last document per partition that has any.
    heads = found.where("edge = 1").select("part", F.col("text").alias("next_text"),
                                           F.col("fingerprint").alias("next_fingerprint"))
    parts = heads.select("part")
    following = F.coalesce(F.lead("part").over(W.orderBy("part")), F.min("part").over(W.partitionBy()))
    links = parts.select("part", following.alias("next"))
    tails = found.where("edge = 2").select("part", "doc_id", "text", "fingerprint").join(links, "part")
    pending = tails.join(heads.withColumnRenamed("part", "next"), "next").select(
        "doc_id", "text", "fingerprint", "next_text", "next_fingerprint")
    last = pending.mapInArrow(_edge_task(kind), f"doc_id {name}, {_RESULT}")
    return found.where("edge = 0").drop("part", "edge", "text").unionByName(last)


def band_values(fingerprint: str, bands: int, width: int) -> list[int | None]:
    """One hash per band: of the (step, sample) pairs at the ``width`` sampled steps that the band draws first.

    A band draws by step number, so texts of near lengths, which sample mostly the same
    steps, read the same ones. A text of fewer samples has one band, of all of them.
    """
    n, samples = fingerprint.split(":")
    read = np.frombuffer(bytes.fromhex(samples), np.uint8).astype(np.uint64)
    if not len(read):
        return [None] * bands
    steps = sampled_steps(int(n)).astype(np.uint64)
    cells = T.mix(steps * np.uint64(257) + read + np.uint64(1))
    if len(read) <= width:
        return [int(cells.sum(dtype=np.uint64).view(np.int64)), *[None] * (bands - 1)]
    draw = T.mix(steps[None, :] + np.arange(1, bands + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15))
    picked = np.argpartition(draw, width - 1, axis=1)[:, :width]
    sums = cells[picked].sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)
    return T.mix(sums).view(np.int64).tolist()


def _band_task(bands: int, width: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [band_values(f, bands, width) for f in batch.column("fingerprint").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.list_(pa.int64()))],
                                             names=["doc_id", "bands"])
    return task


def banded(prints: DataFrame, bands: int, width: int, small: int) -> DataFrame:
    """(a, b), a < b: documents that meet in a bucket; ``prints`` has (doc_id, fingerprint), each id once.

    A bucket of more than ``small`` documents pairs each of them with its first one, and is
    split by the values of the bands after its own, one more at a time, until its parts
    are small. So a bucket of any size gives a few pairs a row, and none of its rows is dropped.
    """
    cut = materialize(prints.select(F.col("doc_id").cast("long").alias("doc_id"), "fingerprint").mapInArrow(
        _band_task(bands, width), "doc_id long, bands array<long>"), "edit-bands")
    rows = cut.select("doc_id", "bands", F.posexplode("bands").alias("band", "key")).where("key is not null")
    found = cut.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b")).limit(0)
    for depth in range(1, bands + 1):
        sizes = rows.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1")
        rows = materialize(rows.join(sizes, ["band", "key"]), "edit-buckets")
        few = rows.where(F.col("n") <= small).select("band", "key", "doc_id")
        pairs = (few.withColumnRenamed("doc_id", "a").join(few.withColumnRenamed("doc_id", "b"), ["band", "key"])
                 .where("a < b").select("a", "b"))
        rows = rows.where(F.col("n") > small)
        found = found.unionByName(pairs).unionByName(rows.where("doc_id <> first").select(
            F.col("first").alias("a"), F.col("doc_id").alias("b")))
        if depth == bands or rows.isEmpty():
            break
        further = F.coalesce(F.get("bands", F.pmod(F.col("band") + depth, F.lit(bands))), F.lit(0))
        rows = rows.select("doc_id", "bands", "band", F.xxhash64("key", further).alias("key"))
    return found.distinct()


def near_pairs(docs: DataFrame, prints: DataFrame, bands: int = 48, width: int = 4, most: int = 40,
               small: int = 256) -> DataFrame:
    """(a, b, distance), a < b: documents within ``most`` edits of each other, found by bands and verified on whole texts.

    In a bucket of more than ``small`` documents not every link is listed, but each document
    is compared with the first one and with those that agree with it in further bands.
    Of documents with equal texts the smallest id stands for all; they are not listed.
    Null ids, empty texts and rows that repeat an id of another text take no part.
    """
    texts = (docs.where("doc_id is not null and text <> ''").groupBy(F.sha2("text", 256).alias("_text"))
             .agg(F.min("doc_id").alias("doc_id")))
    own = docs.select("doc_id", "text").join(texts, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    firsts = prints.join(texts.select("doc_id").distinct(), "doc_id", "left_semi").where("n_chars > 0")
    firsts = firsts.select("doc_id", "fingerprint", "n_chars").dropDuplicates(["doc_id"])
    sizes = firsts.select("doc_id", "n_chars")
    pairs = (banded(firsts, bands, width, small)
             .join(sizes.select(F.col("doc_id").alias("a"), F.col("n_chars").alias("n")), "a")
             .join(sizes.select(F.col("doc_id").alias("b"), F.col("n_chars").alias("m")), "b")
             .where(F.abs(F.col("n") - F.col("m")) <= most).select("a", "b"))
    both = (pairs.join(own.select(F.col("doc_id").alias("a"), F.col("text").alias("s")), "a")
            .join(own.select(F.col("doc_id").alias("b"), F.col("text").alias("t")), "b"))
    return both.select("a", "b", F.levenshtein("s", "t", most).alias("distance")).where("distance >= 0")


def near_groups(docs: DataFrame, prints: DataFrame, **options) -> DataFrame:
    """(doc_id, group_id, n_links): the smallest id reachable over near pairs and equal texts, and the document's pairs."""
    links = materialize(near_pairs(docs, prints, **options).select("a", "b"), "edit-links")
    named = docs.where("doc_id is not null").select("doc_id", F.sha2("text", 256).alias("_text"))
    first = named.where("_text is not null").groupBy("_text").agg(F.min("doc_id").alias("first"))
    equal = named.join(first, "_text").select(F.col("doc_id").alias("u"), F.col("first").alias("v"))
    merged = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(equal))
    ends = links.select(F.col("a").alias("doc_id")).unionByName(links.select(F.col("b").alias("doc_id")))
    counts = ends.groupBy("doc_id").agg(F.count("*").alias("n_links"))
    return (named.select("doc_id").distinct().join(merged.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .join(counts, "doc_id", "left").select(
                "doc_id", F.coalesce("component", "doc_id").alias("group_id"),
                F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")))
