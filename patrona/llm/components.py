"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrona.session import discard, materialize

#: Edges in a file of a written round, about.
FILE_EDGES = 200_000


def _files(rows: int) -> int:
    return max(1, -(-rows // FILE_EDGES))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (u, v): the smallest node that can be reached.

    Each round links the larger neighbours of every node to its smallest one (large
    star), then the smaller ones (small star), and is written to the shared folder.
    Paths shrink by a constant factor a round; no node's neighbours meet in one task
    but through map-side minima and a join that adaptive execution splits.
    """
    now = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .where("u <> v").distinct(), "edges")
    files = _files(now.count())
    seen = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct()
        last, now = now, materialize(new.coalesce(files), "edges")  # no more rows than before, nor more files
        discard(last)
        state = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == seen:
            break
        seen, files = state, _files(state[0])
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
