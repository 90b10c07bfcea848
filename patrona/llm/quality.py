"""Quality classifier: random Fourier features, ridge normal equations, isotonic calibration.

Statistics of each text are standardised and mapped to cosines of random
directions, which approximate a Gaussian kernel. Every partition sums its part of
the normal equations; the sums are added by Spark and a ridge solution follows.
Raw scores of training rows that the ridge did not see are summed in bins, and
pool-adjacent-violators turns the bins into a rising score from 0 to 1.

Defined cases: a null or empty text has statistics of 0 and gets a score like any
other; very long texts are counted whole; a null label trains nothing; a document
labelled twice counts twice and rows that repeat a document are scored each; equal
statistics give equal scores; without training rows all scores are 0.5; an empty table
has no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrona.llm import text as T
from patrona.session import materialize

FEATURES = 256
BINS = 512

STATS = ("log_words", "word_chars", "capitals", "digits", "marks", "symbols", "bars", "spaces", "beyond_ascii",
         "words_per_line", "repeated_words", "repeated_grams", "repeated_lines", "sentence_ends", "longest_word")


def _mask(characters) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_CAPITAL = _mask(range(65, 91))
_DIGIT = _mask(b"0123456789")
_MARK = _mask(b for b in range(33, 127) if not chr(b).isalnum())
_SYMBOL = _mask(b"#*$%&<>^~_=+@")
_BAR = _mask(b"|!")
_END = _mask(b".?")
_BEYOND = _mask(range(128, 256))
_LINE = ~_mask(b"\n")


def _repeats(keys: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """How many keys of each owner equal an earlier one of the same owner."""
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    same = (keys[1:] == keys[:-1]) & (owner[1:] == owner[:-1])
    return np.bincount(owner[1:][same], minlength=count)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``STATS`` per text."""
    size = np.diff(offsets)
    words, lines = T.Words(data, offsets, T.SPACED), T.Words(data, offsets, _LINE)
    n, owner = len(size), words.text_of()
    chars, some_words = np.maximum(size, 1), np.maximum(words.counts, 1)
    some_lines = np.maximum(lines.counts, 1)
    grams, whole = words.grams(3)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, owner, words.ends - words.starts)
    inside = T.per_text(words.inside, offsets)

    def share(table: np.ndarray) -> np.ndarray:
        return T.per_text(table[data], offsets) / chars

    return np.stack([
        np.log1p(words.counts), inside / some_words, share(_CAPITAL), share(_DIGIT), share(_MARK), share(_SYMBOL),
        share(_BAR), 1 - inside / chars, share(_BEYOND), np.log1p(words.counts / some_lines),
        _repeats(words.hashes, owner, n) / some_words, _repeats(grams[whole], owner[whole], n) / some_words,
        _repeats(lines.hashes, lines.text_of(), n) / some_lines, T.per_text(_END[data], offsets) / some_words,
        np.log1p(longest)], axis=1)


def _stats_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in T.chunks(batches):
        values = statistics(data, offsets)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *[pa.array(values[:, i].copy()) for i in range(len(STATS))]],
                                         names=["doc_id", *STATS])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy() for c in STATS], axis=1)


class Fourier:
    """A constant, then cosines of fixed random directions of the standardised statistics."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, width: float = 3.0, seed: int = 10):
        random = np.random.default_rng(seed)
        self.mean, self.deviation = mean, deviation
        self.directions = random.normal(0, 1 / width, (len(mean), FEATURES))
        self.phases = random.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        z = np.clip((values - self.mean) / self.deviation, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / FEATURES)
        return np.concatenate([np.ones((len(z), 1)), waves], axis=1)


def _sums_task(fourier):
    """One row per matrix row and partition: sums of x x' and of x y."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        map_, size = fourier.value, FEATURES + 1
        gram, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            for start in range(0, len(batch), 4096):
                part = batch.slice(start, 4096)
                x = map_(_matrix(part))
                gram += x.T @ x
                right += x.T @ part.column("y").to_numpy()
        flat = np.concatenate([gram, right[:, None]], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(size), size + 1).astype(np.int32)),
             pa.array(np.tile(np.arange(size + 1), size).astype(np.int32)), pa.array(flat.ravel())],
            names=["i", "j", "v"])
    return task


def fit_ridge(rows: DataFrame, fourier, strength: float) -> np.ndarray:
    """Weights from normal equations that every partition sums on its own."""
    sums = (rows.mapInArrow(_sums_task(fourier), "i int, j int, v double").groupBy("i", "j")
            .agg(F.sum("v").alias("v")).toPandas())
    size = FEATURES + 1
    whole = np.zeros((size, size + 1))
    whole[sums["i"], sums["j"]] = sums["v"]
    return np.linalg.solve(whole[:, :size] + strength * np.eye(size), whole[:, size])


def _raw_task(fourier, weights):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        map_, w = fourier.value, weights.value
        for batch in batches:
            for start in range(0, max(len(batch), 1), 4096):
                part = batch.slice(start, 4096)
                names = [c for c in part.schema.names if c not in STATS]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(map_(_matrix(part)) @ w)],
                                                 names=[*names, "raw"])
    return task


def pool_adjacent_violators(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to the values (weighted least squares)."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights):
        blocks.append([value * weight, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            total, weight, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + weight, blocks[-1][2] + n]
    return np.concatenate([np.full(int(n), total / weight) for total, weight, n in blocks] or [np.zeros(0)])


def _bin(raw: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((raw + 0.5) / 2 * BINS))).cast("int")


def calibration(raw: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Centres of the filled bins of raw scores and their calibrated values, from summed labels."""
    bins = (raw.groupBy(_bin(F.col("raw")).alias("bin")).agg(F.count("*").alias("n"), F.sum("y").alias("good"))
            .orderBy("bin").toPandas())
    rising = pool_adjacent_violators((bins["good"] / bins["n"]).to_numpy(float), bins["n"].to_numpy(float))
    return (bins["bin"].to_numpy(float) + 0.5) / BINS * 2 - 0.5, rising


def _calibrated(raw: Column, centres: np.ndarray, values: np.ndarray) -> Column:
    """Linear between bin centres, plus a rise so small that equal steps keep the raw order."""
    if not len(centres):
        return F.lit(0.5)
    knots = np.concatenate([[-0.5], centres, [1.5]])
    levels = np.concatenate([values[:1], values, values[-1:]]) * 0.998 + np.linspace(0, 0.002, len(knots))
    x = F.greatest(F.lit(-0.5), F.least(F.lit(1.5), raw))
    k, v = F.lit(knots.tolist()), F.lit(levels.tolist())
    at = F.greatest(F.lit(1), F.least(F.lit(len(knots) - 1), F.size(F.filter(k, lambda c: c <= x))))
    low, high = F.get(k, at - 1), F.get(k, at)
    share = (x - low) / F.greatest(high - low, F.lit(1e-9))
    return F.get(v, at - 1) + share * (F.get(v, at) - F.get(v, at - 1))


def quality_scores(docs: DataFrame, labels: DataFrame, training, calibrating, label: str = "quality",
                   strength: float = 1e-2) -> DataFrame:
    """(doc_id, score) for every document (doc_id, text).

    ``training`` marks the labels for the ridge, ``calibrating`` those for the
    calibration; both are conditions on doc_id.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ", ".join(f"{c} double" for c in STATS)
    stats = materialize(docs.select("doc_id", "text").mapInArrow(_stats_task, f"doc_id {kind}, {columns}"), "quality")
    moments = stats.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("d")).alias(c) for c in STATS]).first()
    mean = np.array([moments[c]["m"] or 0.0 for c in STATS])
    deviation = np.array([max(moments[c]["d"] or 0.0, 1e-6) for c in STATS])
    fourier = spark.sparkContext.broadcast(Fourier(mean, deviation))
    known = labels.where(F.col(label).isNotNull()).select("doc_id", F.col(label).cast("double").alias("y"))
    rows = materialize(stats.join(known.where(training | calibrating), "doc_id"), "quality-rows")
    weights = spark.sparkContext.broadcast(fit_ridge(rows.where(training), fourier, strength))
    held = rows.where(calibrating).mapInArrow(_raw_task(fourier, weights), f"doc_id {kind}, y double, raw double")
    centres, values = calibration(held)
    raw = stats.mapInArrow(_raw_task(fourier, weights), f"doc_id {kind}, raw double")
    return raw.select("doc_id", _calibrated(F.col("raw"), centres, values).alias("score"))
