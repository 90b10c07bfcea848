"""Near-duplicate detection with an LSH forest over MinHash signatures.

A tree is a sorted order of the signatures that begins at its own place: four minima
make the least depth, a region, and eight more order the rows inside it, so that
neighbours in a crowded region agree on the longest prefix there is. Two documents of
similarity 0.8 share a region in one of 32 trees but for a chance of 5e-8.

1. Documents with equal shingle sets form classes; one of each goes on.
2. Longest-common-prefix neighbours of the first trees are candidates, unless their
   sketches (two bits of each minimum) rule out a link. They are confirmed on full
   shingle sets, and confirmed links are contracted to components.
3. Where a region of any tree still holds several components, its rows are compared with
   one document for the largest of them, that of most links: linear in the rows.
4. What is left is compared in full. In a region of at most ``SMALL`` rows the pairs of
   different components are candidates as above. Larger ones are put together where they
   share rows; the sets of such a cluster meet in tasks of two blocks of ``BLOCK`` rows,
   where all similarities are computed exactly and a task returns only links that join
   components, fewer than it has rows. No list of pairs of a crowded region is ever made.

Defined cases: a null or empty text has no shingle and links with nothing; rows
with a null id link with nothing and are kept; rows that repeat an id count as one
document of the shingles of each; very long texts are compared whole; an empty table
has no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrona.llm import text as T
from patrona.llm.components import components
from patrona.session import discard, materialize

TREES, DEPTH = 32, 4
#: Trees whose neighbours are candidates at first.
FIRST_TREES = 8
#: Rows of a region up to which its pairs are listed.
SMALL = 32
#: Rows of a cluster that meet as many others in one task, about; shingles of one matrix product there.
BLOCK, COLUMNS = 512, 4096
#: Parts of a class of equal documents in the join with its first one.
SALTS = 16
#: Minima of 128 whose two bits may differ, at any distance. At a similarity of 0.8 they number 19.2, with a
#: deviation of 4: the limit passes all but a few in a million such pairs.
MOST_BITS = 39
SKETCH = ["sketch1", "sketch2", "sketch3", "sketch4"]
FILTER_BITS = 26

_random = np.random.default_rng(20)
_A = _random.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)
_B = _random.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each text; fewer than k words are one shingle."""
    words = T.Words(T.LOWER[data], offsets, T.SPACED)
    hashes, whole = words.grams(k)
    out = []
    for first, count in zip(words.first[:-1].tolist(), words.counts.tolist()):
        if count >= k:
            out.append(np.unique(hashes[first:first + count - k + 1]))
        elif count:
            own = words.hashes[first:first + count] * np.array([3, 5, 7, 11, 13, 17, 19][:count], np.uint64)
            out.append(T.mix(own.sum(keepdims=True) + np.uint64(count)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of 128 hash functions, 32 bits each."""
    least = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 4096):
        part = _A[:, None] * shingles[None, start:start + 4096]
        part += _B[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least >> np.uint64(32)


def regions(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Region hash of each tree, and the next minima of its order (8 bits of each of eight)."""
    rows = sig.reshape(TREES, DEPTH)
    region = np.zeros(TREES, np.uint64)
    for j in range(DEPTH):
        region = T.mix(region + rows[:, j] + np.arange(TREES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    further = np.concatenate([np.roll(rows, -1, axis=0), np.roll(rows, -2, axis=0)], axis=1) >> np.uint64(24)
    deep = np.zeros(TREES, np.uint64)
    for j in range(2 * DEPTH):
        deep = deep << np.uint64(8) | further[:, j]
    return region, deep


def sketch(sig: np.ndarray) -> np.ndarray:
    """Two bits of each minimum, as two 64-bit numbers of lower bits and two of higher ones."""
    planes = [(sig >> np.uint64(i) & np.uint64(1)).astype(bool) for i in (0, 1)]
    return np.packbits(np.concatenate(planes)).view(np.uint64)


_SIGNED = ("n_shingles long, key1 long, key2 long, " + "".join(f"{c} long, " for c in SKETCH)
           + "region array<long>, deep array<long>")


def _lists(values: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate([*values, np.zeros(0, np.uint64)]).view(np.int64)
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _sign_task(k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for rows, data, offsets in T.chunks(batches):
            sets = shingle_sets(data, offsets, k)
            signatures = [signature(s) if len(s) else none for s in sets]
            trees = [regions(s) if len(s) else (none, none) for s in signatures]
            bits = np.array([sketch(s) if len(s) else [0] * len(SKETCH) for s in signatures], np.uint64).view(np.int64)
            sums = np.array([[s.sum(dtype=np.uint64), T.mix(s).sum(dtype=np.uint64)] for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(sums[:, 0].view(np.int64)), pa.array(sums[:, 1].copy().view(np.int64)),
                 *[pa.array(bits[:, i].copy()) for i in range(len(SKETCH))],
                 _lists([r for r, _ in trees]), _lists([d for _, d in trees])],
                names=["doc_id", "n_shingles", "key1", "key2", *SKETCH, "region", "deep"])
    return task


_CARRIED = ["region", "doc_id", "comp", *SKETCH]


def _alike(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which rows of the same region are paired."""
    differ = left[:, 3:] ^ right[:, 3:]
    count = np.bitwise_count((differ[:, :2] | differ[:, 2:]).view(np.uint64)).sum(axis=1)
    return count <= MOST_BITS


def _neighbour_task(reach: int):
    """Pairs of rows of one region at most ``reach`` apart; rows that may pair with those of another task as kinds 1 and 2.

    These are up to ``reach`` rows of the task's first region and of its last one. ``place`` counts the
    first rows from 0 and the last ones back from 1, so that their sum is the distance.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        carry = np.zeros((0, len(_CARRIED)), np.int64)
        head: list[np.ndarray] = []

        def out(kind: int, rows: np.ndarray, b: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, part, np.int32)),
                 pa.array(place.astype(np.int32)), *[pa.array(rows[:, i].copy()) for i in range(len(_CARRIED))],
                 pa.array(b.copy())], names=["kind", "part", "place", *_CARRIED, "b"])

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in _CARRIED], axis=1)
            if sum(map(len, head)) < reach:
                head.append(rows[:reach])
            whole = np.concatenate([carry, rows])
            for lag in range(1, reach + 1):
                left, right = whole[:-lag], whole[lag:]
                new = np.arange(len(right)) + lag >= len(carry)  # the later row is of this batch
                same = new & (left[:, 0] == right[:, 0])
                if not same.any():
                    continue
                left, right = left[same], right[same]
                hit = (left[:, 2] != right[:, 2]) & _alike(left, right)
                if hit.any():
                    yield out(0, left[hit], right[hit, 1], np.zeros(int(hit.sum())))
            carry = whole[-reach:]
        if len(carry):
            first = np.concatenate(head)[:reach]
            first, carry = first[first[:, 0] == first[0, 0]], carry[carry[:, 0] == carry[-1, 0]]
            yield out(1, first, first[:, 1], np.arange(len(first)))
            yield out(2, carry, carry[:, 1], np.arange(len(carry), 0, -1))
    return task


def candidates(rows: DataFrame, reach: int) -> DataFrame:
    """(a, b), a < b: neighbours in the sorted orders of rows (region, deep, doc_id, comp, sketch1, ...)."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ", ".join(f"{c} long" for c in (*_CARRIED, "b"))
    found = (rows.repartitionByRange(n, "region", "deep", "doc_id").sortWithinPartitions("region", "deep", "doc_id")
             .select(*_CARRIED).mapInArrow(_neighbour_task(reach), f"kind int, part int, place int, {columns}"))
    found = materialize(found, "forest-pairs")
    heads = found.where("kind = 1").select("region", "part", F.col("place").alias("after"), "b", *[
        F.col(c).alias(f"{c}_b") for c in ("comp", *SKETCH)])
    tails = found.where("kind = 2").withColumn("part", F.col("part") + 1).drop("b")
    lag = F.col("place") + F.col("after")
    differ = [F.col(c).bitwiseXOR(F.col(f"{c}_b")) for c in SKETCH]
    count = F.bit_count(differ[0].bitwiseOR(differ[2])) + F.bit_count(differ[1].bitwiseOR(differ[3]))
    alike = (lag <= reach) & (count <= MOST_BITS)
    heads = heads.select("*", F.col("region").alias("region_b"), F.col("part").alias("part_b")).drop("region", "part")
    across = tails.join(heads, (F.col("region") == F.col("region_b")) & (F.col("part") == F.col("part_b"))
                        & (F.col("comp") != F.col("comp_b")) & alike)
    pairs = found.where("kind = 0").select(F.col("doc_id").alias("a"), "b").unionByName(
        across.select(F.col("doc_id").alias("a"), "b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def mixed_regions(rows: DataFrame) -> DataFrame:
    """(region, n): regions that hold rows of several components, and how many rows."""
    return (rows.groupBy("region").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            .where("lo < hi").select("region", "n"))


def sketched(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches and numbers of shingles allow a link."""
    sketches = signed.where("doc_id is not null").select("doc_id", "n_shingles", *SKETCH)
    left = sketches.select(*[F.col(c).alias(f"{c}_a") for c in sketches.columns]).withColumnRenamed("doc_id_a", "a")
    right = sketches.select(*[F.col(c).alias(f"{c}_b") for c in sketches.columns]).withColumnRenamed("doc_id_b", "b")
    differ = [F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")) for c in SKETCH]
    count = F.bit_count(differ[0].bitwiseOR(differ[2])) + F.bit_count(differ[1].bitwiseOR(differ[3]))
    sized = F.expr(f"100 * least(n_shingles_a, n_shingles_b) >= {percent} * greatest(n_shingles_a, n_shingles_b)")
    return (pairs.join(left, "a").join(right, "b").where(sized & (count <= MOST_BITS)).select("a", "b").distinct())


def hub_pairs(rows: DataFrame, hubs: DataFrame) -> DataFrame:
    """(a, b), a < b: each row of a mixed region with the hub of the component that has most rows there.

    ``rows`` has (region, doc_id, comp), ``hubs`` has (comp, hub). One pair a row and region at most.
    """
    counts = rows.groupBy("region", "comp").count()
    largest = (counts.groupBy("region").agg(F.max(F.struct("count", (-F.col("comp")).alias("id"))).alias("most"),
                                            F.count("*").alias("n")).where("n > 1")
               .select("region", (-F.col("most.id")).alias("main")))
    met = rows.join(largest, "region").where("comp <> main").select("doc_id", "main").distinct()
    met = met.join(hubs.withColumnRenamed("comp", "main"), "main", "left").select(
        "doc_id", F.coalesce("hub", "main").alias("hub"))
    return met.select(F.least("doc_id", "hub").alias("a"), F.greatest("doc_id", "hub").alias("b")).distinct()


def small_pairs(rows: DataFrame) -> DataFrame:
    """(a, b), a < b: all rows of different components of a region; regions are small."""
    right = rows.select("region", F.col("doc_id").alias("b"), F.col("comp").alias("comp_b"))
    return (rows.withColumnRenamed("doc_id", "a").join(right, "region").where("a < b and comp <> comp_b")
            .select("a", "b").distinct())


def _block_links(percent: int):
    """Function giving links between two blocks of rows that join their components; a closure, sent by value."""
    columns = COLUMNS

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        first, second = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        pdf = pdf.sort_values("doc_id", kind="stable").reset_index(drop=True)
        block = pdf["block"].to_numpy()
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        ids, comps = pdf["doc_id"].to_numpy(), pdf["comp"].to_numpy()
        none = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        if not len(left) or not len(right) or len(np.unique(comps)) < 2:
            return none
        sets = pdf["shingles"].tolist()
        size = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), size)
        _values, word, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = often[word] > 1
        renumbered = np.cumsum(often > 1) - 1
        owner, word = owner[shared], renumbered[word[shared]]
        order = np.argsort(word, kind="stable")
        owner, word = owner[order], word[order]
        common = np.zeros((len(left), len(right)), np.float32)
        for start in range(0, int(word[-1]) + 1 if len(word) else 0, columns):
            a, b = np.searchsorted(word, [start, start + columns])
            cells = np.zeros((len(sets), columns), np.float32)
            cells[owner[a:b], word[a:b] - start] = 1
            common += cells[left] @ cells[right].T
        common = np.rint(common).astype(np.int64)
        union = size[left][:, None] + size[right][None, :] - common
        linked = (100 * common >= percent * union) & (comps[left][:, None] != comps[right][None, :])
        if first == second:
            linked &= np.triu(np.ones_like(linked), 1)
        root = {int(c): int(c) for c in comps}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c
        out = []
        for x, y in zip(*(v.tolist() for v in np.nonzero(linked))):
            u, v = find(int(comps[left[x]])), find(int(comps[right[y]]))
            if u != v:
                root[max(u, v)] = min(u, v)
                out.append((ids[left[x]], ids[right[y]]))
        return pd.DataFrame(out, columns=["a", "b"]) if out else none
    return links


def cluster_links(rows: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): links that join the components of large mixed regions.

    ``rows`` has (region, doc_id, comp). Rows of a region belong together, and so do
    regions that share a row.
    """
    least = rows.groupBy("region").agg(F.min("doc_id").alias("v"))
    edges = rows.join(least, "region").select(F.col("doc_id").alias("u"), "v").where("u <> v").distinct()
    cluster = components(edges).select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))
    members = (rows.select("doc_id", "comp").distinct().join(cluster, "doc_id", "left")
               .withColumn("cluster", F.coalesce("cluster", "doc_id")))
    sizes = members.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    placed = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    placed = materialize(placed, "forest-members")
    sets = _sets(docs, placed.select("doc_id").distinct(), k)
    held = materialize(placed.join(sets, "doc_id"), "forest-sets")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    met = held.withColumn("other", other).select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "doc_id", "comp", "shingles")
    return met.groupBy("cluster", "i", "j").applyInPandas(_block_links(percent), "a long, b long")


def _hubs(links: DataFrame, label: DataFrame) -> DataFrame:
    """(comp, hub): the document of most links of each component that has any, the smallest id of those."""
    ends = links.select(F.col("a").alias("doc_id")).unionByName(links.select(F.col("b").alias("doc_id")))
    most = (ends.groupBy("doc_id").count().join(label, "doc_id").groupBy("comp")
            .agg(F.max(F.struct("count", (-F.col("doc_id")).alias("id"))).alias("most")))
    return most.select("comp", (-F.col("most.id")).alias("hub"))


def _filter_words(ids: DataFrame) -> np.ndarray:
    """A bitmap of 2**26 bits with one bit per id: 8 MB for any number of ids."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    words = ids.select(bit.alias("bit")).groupBy(F.shiftright("bit", 5).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 as int))")).alias("bits")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 5), np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out


def _set_task(wanted, k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = wanted.value
        for batch in batches:
            bit = batch.column("bit").to_numpy()
            rows = batch.filter(pa.array((words[bit >> 5] >> (bit & 31)) & 1 == 1))
            for part, data, offsets in T.chunks(iter([rows])):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), _lists(shingle_sets(data, offsets, k))], names=["doc_id", "shingles"])
    return task


def _sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(doc_id, shingles) of the documents with these ids."""
    wanted = docs.sparkSession.sparkContext.broadcast(_filter_words(ids))
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    return (docs.select("doc_id", "text", bit.alias("bit"))
            .mapInArrow(_set_task(wanted, k), "doc_id long, shingles array<long>")
            .join(ids, "doc_id", "left_semi"))


def confirmed(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have at least ``percent`` % of their union in common."""
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    sets = _sets(docs, ids, k)
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (pairs.join(left, "a").join(right, "b")
            .where(100 * common >= percent * (F.size("x") + F.size("y") - common)).select("a", "b"))


def _classes(linkable: DataFrame) -> DataFrame:
    """(doc_id, comp): the smallest id of the documents with an equal set; large classes are joined in parts."""
    same = ["n_shingles", "key1", "key2"]
    several = (linkable.groupBy(*same).agg(F.min("doc_id").alias("comp"), F.count("*").alias("n")).where("n > 1")
               .select(*same, "comp", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    return (linkable.select("doc_id", *same, salt.alias("salt")).join(several, [*same, "salt"], "left")
            .select("doc_id", F.coalesce("comp", "doc_id").alias("comp")))


def _contracted(label: DataFrame, links: DataFrame) -> DataFrame:
    """The labels (doc_id, comp) after joining the components that links (a, b) connect."""
    ends = (links.join(label.select(F.col("doc_id").alias("a"), F.col("comp").alias("u")), "a")
            .join(label.select(F.col("doc_id").alias("b"), F.col("comp").alias("v")), "b").select("u", "v"))
    merged = components(ends).withColumnRenamed("node", "comp")
    return materialize(label.join(merged, "comp", "left")
                       .select("doc_id", F.coalesce("component", "comp").alias("comp")).distinct(), "forest-label")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every document (doc_id, text).

    ``component_id`` is the smallest id reachable over links of at least
    ``percent`` % similarity; ``kept`` marks the document with that id.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = materialize(docs.mapInArrow(_sign_task(shingle_words), f"doc_id long, {_SIGNED}"), "forest-signed")
    linkable = signed.where("n_shingles > 0 and doc_id is not null")
    own = docs.where("doc_id is not null")
    classes = label = materialize(_classes(linkable), "forest-classes")
    firsts = classes.where("doc_id = comp").select("doc_id")

    def in_trees(label: DataFrame, trees: int, *columns: str) -> DataFrame:
        chosen = label.join(firsts, "doc_id", "left_semi")
        cut = linkable.select("doc_id", *SKETCH, *[F.slice(c, 1, trees).alias(c) for c in ("region", "deep")])
        return cut.join(chosen, "doc_id").select(
            "doc_id", "comp", *SKETCH, F.inline(F.arrays_zip("region", "deep"))).select(*columns)

    seen = materialize(candidates(in_trees(label, FIRST_TREES, *_CARRIED, "deep"), 1), "forest-candidates")
    links = materialize(confirmed(own, seen, shingle_words, percent), "forest-links")
    label = _contracted(label, links)

    rows = in_trees(label, TREES, "region", "doc_id", "comp")
    rows = materialize(rows.join(mixed_regions(rows), "region").drop("n"), "forest-rows")
    near = sketched(hub_pairs(rows, _hubs(links, label)), signed, percent)
    near = materialize(near.join(seen, ["a", "b"], "left_anti"), "forest-candidates")
    discard(links)
    label = _contracted(label, confirmed(own, near, shingle_words, percent))

    mixed, rows = rows, rows.drop("comp").join(label, "doc_id")
    rows = materialize(rows.join(mixed_regions(rows), "region"), "forest-rows")
    discard(mixed)
    rest = sketched(small_pairs(rows.where(F.col("n") <= SMALL).drop("n")), signed, percent)
    rest = materialize(rest.join(seen.unionByName(near), ["a", "b"], "left_anti"), "forest-candidates")
    last = confirmed(own, rest, shingle_words, percent).unionByName(
        cluster_links(rows.where(F.col("n") > SMALL).drop("n"), own, shingle_words, percent))
    label = _contracted(label, last)
    discard(seen, near, rest, rows)

    whole = label.groupBy("doc_id").agg(F.min("comp").alias("component_id"))
    return signed.join(whole, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"))
