"""Merkle manifest of a table: a tree of SHA-256 digests per language, joined to one root, with a proof per row.

Slot pivot: conditional aggregates spread the children of a parent into eight slot
columns. The slots concatenated are the input of the parent's digest; leaving out the
own slot gives the siblings, in order. Levels are built from the leaves upwards, each
one a table with an eighth of the rows; then the siblings are handed down, a run of
eight at a time, so a proof is shuffled once for eight leaves. Positions come from a
range partitioning of (language, key): no group is ever in one task. Digests are kept
as 32 bytes and hashed as lower-case hexadecimal text.

Defined cases: a null value hashes as ``-`` and a null key is first in order; rows with
equal keys are ordered by their leaves and equal rows are leaves of their own; empty
and very long texts are hashed whole; a null language is a group of its own, the first;
an empty table has no rows and no root; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patrona.scale import fits_broadcast, lookup_join
from patrona.session import materialize

FANOUT = 8
_SHIFT = 3
_SLOTS = [f"s{j}" for j in range(FANOUT)]
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values in turn, each ``-`` or byte count, colon and value."""
    texts = [v.cast("string") for v in values]
    return F.unhex(F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256))


def positions(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Adds ``at``, the place of a row in its group ``grp`` from 0 on, and ``n``, the rows of the group.

    Rows are dealt by range of (grp, order) and numbered inside each part; the parts of
    a group are then added up in a table with one row per part and group.
    """
    keys = ["grp", *order]
    placed = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                             .withColumn("_id", F.monotonically_increasing_id())
                             .withColumn("_part", F.shiftright("_id", 33)), name)
    parts = placed.groupBy("grp", "_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    group = W.partitionBy("grp")
    before = F.sum("_rows").over(group.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.select("grp", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
                         F.sum("_rows").over(group).alias("n"))
    return (lookup_join(placed, parts, ["grp", "_part"], "inner")
            .withColumn("at", F.col("_id") + F.col("_shift")).drop("_id", "_part", "_shift"))


def slot_pivot(nodes: DataFrame, value: Column) -> DataFrame:
    """One row per run of eight nodes: (grp, run, n, s0..s7), a slot being null beyond the last node."""
    slot = F.col("at").bitwiseAND(FANOUT - 1)
    return (nodes.groupBy("grp", F.shiftright("at", _SHIFT).alias("run"))
            .agg(F.max("n").alias("n"), *[F.max(F.when(slot == j, value)).alias(s) for j, s in enumerate(_SLOTS)]))


def _joined(slots: Sequence[Column]) -> Column:
    empty = F.unhex(F.lit(""))
    return F.concat(*[F.coalesce(s, empty) for s in slots]) if slots else empty


def _steps(slots: Sequence[Column]) -> list[Column]:
    """For each slot the path of that child: what stands before and after it in its run, then the path of the run."""
    alone = F.col("n") == 1
    return [F.when(alone, F.col("path")).otherwise(F.concat(F.array(F.struct(
        _joined(slots[:j]).alias("a"), _joined(slots[j + 1:]).alias("b"))), F.col("path")))
        for j in range(FANOUT)]


def build_tree(nodes: DataFrame, payload: Column, digest: str = "digest") -> tuple[list[DataFrame], DataFrame]:
    """Levels of runs, lowest first, and the (grp, digest) of each group's top.

    ``nodes`` has (grp, at, n) and what ``payload`` reads, a struct with the node's
    digest. Groups differ in height: a run of a group with at most eight nodes is its top.
    """
    most = nodes.agg(F.max("n")).first()[0] or 1
    levels, tops, value = [], [], payload
    while True:
        runs = slot_pivot(nodes, value)
        slots = [F.col(f"{s}.{digest}") if not levels else F.col(s) for s in _SLOTS]
        own = F.unhex(F.sha2(_hex(_joined(slots)), 256))
        runs = materialize(runs.withColumn("digest", F.when(F.col("n") == 1, slots[0]).otherwise(own)),
                           f"merkle-level-{len(levels)}")
        levels.append(runs)
        tops.append(runs.where(F.col("n") <= FANOUT).select("grp", "digest"))
        if most <= FANOUT:
            break
        most = -(-most // FANOUT)
        nodes = runs.where(F.col("n") > FANOUT).select(
            "grp", F.col("run").alias("at"), F.ceil(F.col("n") / FANOUT).cast("long").alias("n"), "digest")
        value = F.col("digest")
    top = tops[0]
    for other in tops[1:]:
        top = top.unionByName(other)
    return levels, top


def hand_down(levels: Sequence[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest runs with ``path``: siblings above the run, level by level, as (before, after) structs.

    ``above`` has (grp, path, ...) for the top of each group; its other columns come along.
    """
    carried = [c for c in above.columns if c not in ("grp", "path")]
    above = materialize(above, "merkle-above")  # a row per group
    if fits_broadcast(above, max_rows=4096):
        above = F.broadcast(above)
    paths = None
    for level in range(len(levels) - 1, -1, -1):
        runs = levels[level].drop("digest")
        tops = runs.where(F.col("n") <= FANOUT).join(above, "grp")
        if paths is None:
            found = tops
        else:
            below = runs.where(F.col("n") > FANOUT).join(paths, ["grp", "run"])
            found = tops.unionByName(below)
        if level == 0:
            return found
        slots = [F.col(s) for s in _SLOTS]
        children = F.array(*[F.struct(s.isNotNull().alias("there"), (F.col("run") * FANOUT + j).alias("run"),
                                      step.alias("path")) for j, (s, step) in enumerate(zip(slots, _steps(slots)))])
        paths = (found.select("grp", *carried, F.explode(children).alias("_c")).where("_c.there")
                 .select("grp", "_c.run", "_c.path", *carried))
    raise AssertionError("a tree has a level")


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document.

    ``folded_root`` is recomputed from the siblings and a leaf whose text was lower-cased
    (A-Z) where 3 divides crc32(doc_id); elsewhere from the leaf itself.
    """
    key = F.crc32(F.col("doc_id").cast("string"))
    low = F.translate("text", _CAPITALS, _CAPITALS.lower())
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("grp"), "doc_id",
        leaf_digest([*fields, F.col("text")]).alias("leaf"),
        F.when(key % 3 == 0, leaf_digest([*fields, low])).alias("tampered"))
    levels, tops = build_tree(positions(leaves, ["doc_id", "leaf", "tampered"], "merkle-leaves"),
                              F.struct("doc_id", "leaf", "tampered"), "leaf")

    subroots = positions(tops.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest"),
                         ["name"], "merkle-subroots")
    upper, root = build_tree(subroots, F.struct("name", "digest"))
    found = root.first()
    root = F.lit(bytes(found["digest"]) if found else None).cast("binary")

    none = F.array().cast("array<struct<a:binary,b:binary>>")
    top = hand_down(upper, subroots.limit(1).select("grp", none.alias("path")))
    slots = [F.col(f"{s}.digest") for s in _SLOTS]
    above = top.select(F.explode(F.array(*[F.struct(F.col(f"{s}.name").alias("grp"), step.alias("path"),
                                                    F.col(f"{s}.digest").alias("subroot"))
                                           for s, step in zip(_SLOTS, _steps(slots))])).alias("_c")).select("_c.*")
    runs = hand_down(levels, above.where("subroot is not null"))

    slots = [F.col(f"{s}.leaf") for s in _SLOTS]
    rows = runs.select("subroot", F.explode(F.array(*[
        F.struct(F.col(s).alias("own"), step.alias("path")) for s, step in zip(_SLOTS, _steps(slots))])).alias("_c")
    ).where("_c.own is not null").select("subroot", "_c.own.*", "_c.path")
    proof = F.sha2(_hex(F.aggregate("path", F.unhex(F.lit("")), lambda acc, x: F.concat(acc, x["a"], x["b"]))), 256)
    folded = F.aggregate("path", F.coalesce("tampered", "leaf"), lambda acc, x: F.unhex(
        F.sha2(_hex(F.concat(x["a"], acc, x["b"])), 256)))
    return (rows.withColumn("folded", folded)
            .select("doc_id", _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
                    _hex(root).alias("root"), proof.alias("proof_sha256"), _hex(F.col("folded")).alias("folded_root"),
                    (F.col("folded") == root).alias("verified")))
