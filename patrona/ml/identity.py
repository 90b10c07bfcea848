"""Cluster numbers that keep a meaning from one fit to the next.

k-means numbers its clusters by chance. ``ranked_clusters`` numbers them by the place of
their centres along a given direction, so that a name belongs to a kind of customer;
``matched_clusters`` gives the clusters of a new fit the numbers of the former one, by
the assignment that keeps most rows where they were.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ranks_along(centers: Sequence[Sequence[float]], direction: Sequence[float]) -> dict[int, int]:
    """Cluster -> rank of its centre along the direction, the highest first; ties by the centre itself."""
    place = {i: (-sum(w * x for w, x in zip(direction, c)), tuple(map(float, c))) for i, c in enumerate(centers)}
    return {cluster: rank for rank, cluster in enumerate(sorted(place, key=place.__getitem__))}


def renumber(cluster: str, numbers: Mapping[int, int]) -> SQLTransformer:
    """Stage that replaces the cluster column by the new numbers; it is saved with the model."""
    cases = " ".join(f"WHEN {old} THEN {new}" for old, new in sorted(numbers.items()))
    return SQLTransformer(statement=f"SELECT * EXCEPT (`{cluster}`), CASE `{cluster}` {cases} END AS `{cluster}` FROM __THIS__")


def ranked_clusters(model: PipelineModel, direction: Sequence[float], cluster: str = "cluster") -> PipelineModel:
    """The fitted pipeline, whose last stage is k-means, with clusters numbered along a direction of its features."""
    centers = [c.tolist() for c in model.stages[-1].clusterCenters()]
    return PipelineModel(stages=[*model.stages, renumber(cluster, ranks_along(centers, direction))])


def assignment(weights: Sequence[Sequence[float]]) -> list[int]:
    """Column of each row in the assignment of greatest total weight; at least as many columns as rows.

    Shortest augmenting paths over row and column potentials, cubic in the number of clusters.
    """
    rows, columns = len(weights), len(weights[0]) if weights else 0
    if columns < rows:
        raise ValueError("fewer columns than rows")
    row_potential, column_potential = [0.0] * (rows + 1), [0.0] * (columns + 1)
    row_of = [0] * (columns + 1)  # 0: free
    for start in range(1, rows + 1):
        row_of[0], column = start, 0
        least, previous, done = [float("inf")] * (columns + 1), [0] * (columns + 1), [False] * (columns + 1)
        while row_of[column]:
            done[column] = True
            row, delta, nearest = row_of[column], float("inf"), 0
            for c in range(1, columns + 1):
                if done[c]:
                    continue
                cost = -weights[row - 1][c - 1] - row_potential[row] - column_potential[c]
                if cost < least[c]:
                    least[c], previous[c] = cost, column
                if least[c] < delta:
                    delta, nearest = least[c], c
            for c in range(columns + 1):
                if done[c]:
                    row_potential[row_of[c]] += delta
                    column_potential[c] -= delta
                else:
                    least[c] -= delta
            column = nearest
        while column:
            row_of[column], column = row_of[previous[column]], previous[column]
    found = [0] * rows
    for c in range(1, columns + 1):
        if row_of[c]:
            found[row_of[c] - 1] = c - 1
    return found


def matched_numbers(both: DataFrame, former: str, latter: str, max_clusters: int = 1000) -> dict[int, int]:
    """New cluster -> former number, from rows that carry both; clusters without a partner get numbers of their own.

    Only the contingency table reaches the driver, one row per pair of clusters that meet.
    """
    counts = both.where(F.col(former).isNotNull() & F.col(latter).isNotNull()).groupBy(former, latter).count()
    cells = {(r[latter], r[former]): r["count"] for r in counts.limit(max_clusters * max_clusters).collect()}
    new, old = sorted({n for n, _o in cells}), sorted({o for _n, o in cells})
    if len(new) > max_clusters or len(old) > max_clusters:
        raise ValueError(f"more than {max_clusters} clusters")
    spare = [max(old, default=-1) + 1 + i for i in range(max(len(new) - len(old), 0))]
    numbers = [*old, *spare]
    picked = assignment([[float(cells.get((n, o), 0)) for o in numbers] for n in new])
    return {n: numbers[c] for n, c in zip(new, picked)}


def matched_clusters(both: DataFrame, former: str, latter: str) -> Column:
    """The new clusters under the former numbers, as a column over rows that carry the new ones."""
    out = F.lit(None).cast("int")
    for n, o in matched_numbers(both, former, latter).items():
        out = F.when(F.col(latter) == n, o).otherwise(out)
    return out
