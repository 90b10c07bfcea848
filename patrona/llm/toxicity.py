"""Toxicity scores from subword-bag embeddings and a linear softmax.

A word is the mean of the embeddings of its hashed character n-grams, so a
misspelling never seen shares most vectors with the word it comes from. The words
of a window are averaged and go through a linear softmax; a document is as toxic as
its most toxic window, which keeps a single insult visible in a long text.
Embeddings and softmax are trained together in NumPy, on a bounded sample of
labelled documents (``sample`` documents, expected, of at most ``max_chars``).

The whole model is linear in the embeddings, so the score of a word is one number
and a text is scored by one lookup a word and running sums.

Defined cases: a null or empty text, or one without a word, scores the model's
value for an empty window; very long texts are scored whole; documents without a
label train nothing; without training rows, or where no training text holds a word, all
scores are 0.5; equal texts have equal scores and repeated rows are scored each; an empty
table has no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrona.llm import text as T
from patrona.scale import hash_unit

WORDS = re.compile(r"\w+")
BUCKETS, WIDTH = 1 << 18, 4
SHORTEST, LONGEST = 3, 6
WINDOW = 8
CACHE_WORDS = 200_000
#: Characters of a word that make n-grams; a longer word is cut into words of this length.
MAX_WORD = 32


def words_of(text: str | None) -> list[str]:
    words = WORDS.findall((text or "").lower())
    if max(map(len, words), default=0) <= MAX_WORD:
        return words
    return [w[i:i + MAX_WORD] for w in words for i in range(0, len(w), MAX_WORD)]


def subwords(word: str) -> list[int]:
    """Buckets of the word itself and of its character n-grams, ends marked."""
    marked = f"<{word}>"
    raw = [marked[i:i + n] for n in range(SHORTEST, LONGEST + 1) for i in range(len(marked) - n + 1)]
    return [crc32(g.encode()) % BUCKETS for g in (marked, *raw)]


class Bags:
    """Subword buckets of many words in one flat array."""

    def __init__(self, words: list[str]):
        flat, sizes = array("i"), array("i")
        for word in words:
            own = subwords(word)
            flat.extend(own)
            sizes.append(len(own))
        self.sizes = np.array(sizes, np.int64)
        self.flat = np.array(flat, np.int32)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def mean(self, values: np.ndarray) -> np.ndarray:
        """Mean of the buckets' values for each word."""
        if not len(self.sizes):
            return np.zeros((0, *values.shape[1:]))
        sums = np.add.reduceat(values[self.flat], self.starts, axis=0)
        return sums / (self.sizes[:, None] if values.ndim > 1 else self.sizes)


def window_means(scores: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Mean score of each window of ``width`` words; of all words where there are fewer."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    if len(scores) <= width:
        return total[-1:] / max(len(scores), 1)
    return (total[width:] - total[:-width]) / width


def _log_odds(bags: Bags, ids: list[np.ndarray], labels: np.ndarray, certain: float) -> np.ndarray:
    """Log odds of label 1 for texts that hold a bucket, 0 where they are not ``certain`` standard errors from 0."""
    held = np.zeros((2, BUCKETS))
    for own, label in zip(ids, labels):
        words = np.unique(own)
        buckets = [bags.flat[bags.starts[w]:bags.starts[w] + bags.sizes[w]] for w in words]
        if buckets:
            held[label, np.unique(np.concatenate(buckets))] += 1
    texts = np.array([(labels == 0).sum(), (labels == 1).sum()])[:, None]
    odds = np.log((held + 0.5) / (texts - held + 0.5))
    error = np.sqrt((1 / (held + 0.5) + 1 / (texts - held + 0.5)).sum(axis=0))
    out = odds[1] - odds[0]
    return np.where(np.abs(out) >= certain * error, out, 0.0)


def train(texts: list[str], labels: np.ndarray, rounds: int = 150, rate: float = 0.03, certain: float = 4.0,
          seed: int = 2) -> tuple[np.ndarray, float]:
    """Score of each bucket and the bias: embeddings and softmax trained jointly on each text's top window (Adam).

    The first dimension of the embeddings starts from the buckets' log odds, the
    others at random; buckets without certain odds are held at 0, since a text's top
    window would otherwise learn its rarest words by heart.
    """
    vocabulary: dict[str, int] = {}
    ids = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)], np.int64) for t in texts]
    if not vocabulary:  # no text holds a word: nothing to learn from
        return np.zeros(BUCKETS), 0.0
    bags = Bags(list(vocabulary))
    odds = _log_odds(bags, ids, labels, certain)
    live = (odds != 0)[:, None]
    random = np.random.default_rng(seed)
    params = {"e": random.normal(0, 0.02, (BUCKETS, WIDTH)) * live, "w": random.normal(0, 0.02, (WIDTH, 2)),
              "b": np.array([2.0, -2.0])}
    params["e"][:, 0] = odds
    params["w"][0] = [-2, 2]
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in params.items()}
    target = np.eye(2)[labels]
    for step in range(1, rounds + 1):
        if step % 5 == 1:  # look up each text's top window again
            scores = bags.mean(params["e"] @ (params["w"][:, 1] - params["w"][:, 0]))
            chosen = []
            for own in ids:
                at = int(window_means(scores[own]).argmax())
                chosen.append(own[at:at + WINDOW])
            flat = np.concatenate([*chosen, np.zeros(0, np.int64)])
            sizes = np.maximum([len(c) for c in chosen], 1)[:, None]
            text = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
            used, place = np.unique(flat, return_inverse=True)
            part = Bags([])
            part.sizes = bags.sizes[used]
            part.starts = np.cumsum(part.sizes) - part.sizes
            part.flat = np.concatenate([bags.flat[bags.starts[u]:bags.starts[u] + bags.sizes[u]] for u in used]
                                       or [np.zeros(0, np.int32)])
            owner = np.repeat(np.arange(len(used)), part.sizes)
        words = part.mean(params["e"])
        hidden = np.stack([np.bincount(text, words[place, k], len(chosen)) for k in range(WIDTH)], 1) / sizes
        logits = hidden @ params["w"] + params["b"]
        probs = np.exp(logits - logits.max(1, keepdims=True))
        probs /= probs.sum(1, keepdims=True)
        error = (probs - target) / len(labels)
        back = (error @ params["w"].T) / sizes
        to_word = np.stack([np.bincount(place, back[text, k], len(used)) for k in range(WIDTH)], 1)
        to_word /= part.sizes[:, None] if len(used) else 1
        grads = {"w": hidden.T @ error, "b": error.sum(0),
                 "e": np.stack([np.bincount(part.flat, to_word[owner, k], BUCKETS) for k in range(WIDTH)], 1) * live}
        for k, g in grads.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            params[k] -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return params["e"] @ (params["w"][:, 1] - params["w"][:, 0]), float(params["b"][1] - params["b"][0])


def training_rows(docs: DataFrame, labels: DataFrame, label: str, training, sample: int,
                  max_chars: int) -> tuple[list[str], np.ndarray]:
    """Texts and labels of a key-hash sample of the labelled training documents: ``sample`` rows, expected."""
    known = labels.where(training & F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("y"))
    chosen = known.where(hash_unit(F.col("doc_id").cast("string"), seed=22) * max(known.count(), 1) < sample)
    rows = (docs.select("doc_id", "text").where(F.length("text") <= max_chars).join(F.broadcast(chosen), "doc_id")
            .orderBy("doc_id").select("text", "y").toPandas())
    return rows["text"].tolist(), rows["y"].to_numpy(int)


def _score_task(model) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, bias = model.value
        place: dict[str, int] = {}
        known = np.zeros(0)
        for rows, _, _ in T.chunks(batches):
            texts = [words_of(t) for t in rows.column("text").to_pylist()]
            new = list({w for words in texts for w in words} - place.keys())
            if len(place) + len(new) > CACHE_WORDS:
                new, place, known = list({w for words in texts for w in words}), {}, known[:0]
            place.update(zip(new, range(len(place), len(place) + len(new))))
            known = np.concatenate([known, Bags(new).mean(buckets)])
            top = np.array([window_means(known[np.fromiter(map(place.__getitem__, words), np.int64, len(words))]).max()
                            for words in texts])
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(top + bias, -500, 500))))],
                names=["doc_id", "score"])
    return task


def toxicity(docs: DataFrame, labels: DataFrame, training, label: str = "toxic", sample: int = 8000,
             max_chars: int = 20_000) -> DataFrame:
    """(doc_id, score) for every document (doc_id, text); ``training`` marks the labels that may be learnt."""
    texts, y = training_rows(docs, labels, label, training, sample, max_chars)
    fitted = train(texts, y) if len(texts) else (np.zeros(BUCKETS), 0.0)
    model = docs.sparkSession.sparkContext.broadcast(fitted)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_score_task(model), f"doc_id {kind}, score double")
