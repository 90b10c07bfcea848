"""Language identification with segmentation-marginalised unigrams.

Each language holds a probability for every piece of a fixed public vocabulary. A
word's likelihood is the sum over all its segmentations into pieces, which a
forward algorithm finds; a document's is the product over its words. Probabilities
are fitted by expectation-maximisation on a bounded sample of training documents
(``docs_per_lang`` a language, expected, texts of at most ``max_chars``).

Words are runs of letters, lower-cased; a run of over 32 letters is scored in
runs of 32. Letters outside the vocabulary cost a fixed small probability.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
rows with a null language train nothing; without training rows all is ``und``; ties
go to the first language in order; rows that repeat a document are predicted, and
drawn for training, each; very long texts are predicted whole; an empty table has no
rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrona.llm import text as T
from patrona.scale import hash_unit

MAX_WORD, MAX_PIECE = 32, 7
_RUNS = re.compile(rf"[^\W\d_]{{1,{MAX_WORD}}}")
#: Numerals that are word characters but neither digits nor letters, such as fractions and raised numbers.
_NUMERALS = "".join(chr(c) for c in range(0x110000) if chr(c).isalnum() and not chr(c).isalpha() and not chr(c).isdecimal())
_LETTER = rf"[^\W\d_{re.escape(_NUMERALS)}]"
LETTERS = re.compile(rf"{_LETTER}+")
WORDS = re.compile(rf"{_LETTER}{{1,{MAX_WORD}}}")
START = "▁"
CACHE_WORDS = 150_000


def words_of(text: str) -> list[str]:
    """Lower-cased letter runs of a whole text, cut into runs of at most 32 letters."""
    lowered = text.lower()
    words = _RUNS.findall(lowered)
    # The exact pattern is slow; few texts hold a numeral of the kinds it leaves out.
    return words if not words or "".join(words).isalpha() else WORDS.findall(lowered)


def public_pieces(path: str) -> list[str]:
    """Pieces of the vocabulary file with lower-case letters only, the word start mark kept."""
    from sentencepiece import SentencePieceProcessor
    model = SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in pieces if len(p) <= MAX_PIECE and p == p.lower()
                   and (p == START or LETTERS.fullmatch(p.removeprefix(START)))})


class Pieces:
    """Sorted piece hashes; finds the pieces inside many words of one length at once."""

    _factor = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: list[str]):
        hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.unknown = len(pieces)

    def _hash(self, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(self._factor) + ord(c)) & ((1 << 64) - 1)
        return h

    def inside(self, words: list[str]) -> list[tuple[int, int, np.ndarray]]:
        """(start, end, piece per word; -1 where the substring is none) for words of one length."""
        n = len(words[0]) + 1
        letters = np.frombuffer((START + START.join(words)).encode("utf-32-le"), np.uint32).reshape(len(words), n)
        out = []
        for start in range(n):
            h = np.zeros(len(words), np.uint64)
            for end in range(start + 1, min(n, start + MAX_PIECE) + 1):
                h = h * self._factor + letters[:, end - 1].astype(np.uint64)
                at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                found = np.where(self.hashes[at] == h, self.order[at], -1)
                if end == start + 1:
                    found[found < 0] = self.unknown
                if (found >= 0).any():
                    out.append((start, end, found))
        return out


def forward(inside: list, probs: np.ndarray, count: int, length: int) -> np.ndarray:
    """Summed probability of all segmentations of each prefix: (length + 1, words, languages)."""
    alpha = np.zeros((length + 1, count, probs.shape[1]))
    alpha[0] = 1
    for start, end, piece in inside:  # starts ascend, so alpha[start] is complete
        hit = np.flatnonzero(piece >= 0)
        alpha[end, hit] += alpha[start, hit] * probs[piece[hit]]
    return alpha


def by_length(words: list[str], most: int = 20_000) -> Iterator[list[int]]:
    """Indices of words of equal length, ``most`` letters x 32 at a time."""
    order: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        order.setdefault(len(w), []).append(i)
    for own in order.values():
        for i in range(0, len(own), most):
            yield own[i:i + most]


def word_log_probs(words: list[str], pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """Natural log of each word's marginal probability per language."""
    out = np.zeros((len(words), probs.shape[1]))
    for own in by_length(words):
        group = [words[i] for i in own]
        out[own] = np.log(forward(pieces.inside(group), probs, len(own), len(group[0]) + 1)[-1])
    return out


def fit(counts: dict[str, Counter], vocabulary: list[str], rounds: int = 3,
        smoothing: float = 0.1) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities (pieces + unknown, languages) by expectation-maximisation."""
    langs, pieces = sorted(counts), Pieces(vocabulary)
    columns = []
    for lang in langs:
        words, weight = list(counts[lang]), np.array(list(counts[lang].values()), float)
        lengths = np.array([len(p) for p in vocabulary] + [1], float)
        probs = (64.0 ** -lengths)[:, None]
        probs[-1] = 1e-7
        for _ in range(rounds):
            expected = np.full((len(vocabulary) + 1, 1), smoothing)
            for own in by_length(words):
                group = [words[i] for i in own]
                n = len(group[0]) + 1
                inside = pieces.inside(group)
                alpha = forward(inside, probs, len(own), n)
                beta = np.zeros((n + 1, len(own)))
                beta[n] = weight[own] / alpha[n, :, 0]
                for start, end, piece in reversed(inside):
                    hit = np.flatnonzero(piece >= 0)
                    share = probs[piece[hit], 0] * beta[end, hit]
                    beta[start, hit] += share
                    expected[:, 0] += np.bincount(piece[hit], alpha[start, hit, 0] * share, len(expected))
            expected[-1] = max(smoothing, expected[-1, 0] * 1e-3)
            probs = expected / expected.sum()
        columns.append(probs[:, 0])
    return langs, np.array(columns).reshape(len(langs), len(vocabulary) + 1).T


def training_counts(docs: DataFrame, training, docs_per_lang: int, max_chars: int) -> dict[str, Counter]:
    """Word counts per language from a key-hash sample of the training documents."""
    usable = docs.where(training & F.col("lang").isNotNull())
    sizes = usable.groupBy("lang").agg(F.count("*").alias("_n"))
    drawn = hash_unit(F.col("doc_id").cast("string"), seed=9) * F.col("_n") < docs_per_lang
    ids = usable.select("doc_id", "lang").join(sizes, "lang").where(drawn).select("doc_id").distinct()
    chosen = usable.where(F.length("text") <= max_chars).join(F.broadcast(ids), "doc_id", "left_semi")
    counts: dict[str, Counter] = {}
    for row in chosen.select("lang", "text").toLocalIterator(prefetchPartitions=True):
        counts.setdefault(row["lang"], Counter()).update(words_of(row["text"]))
    return {lang: words for lang, words in counts.items() if words}


def _predictions(model, langs: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(rows, languages, scores) of each slice of the batches."""
    vocabulary, probs = model.value
    pieces = Pieces(vocabulary)
    place: dict[str, int] = {}
    known = np.zeros((0, len(langs)))
    for rows, _, _ in T.chunks(batches):
        texts = [words_of(t) if t else [] for t in rows.column("text").to_pylist()]
        new = list({w for words in texts for w in words} - place.keys())
        if len(place) + len(new) > CACHE_WORDS:
            new, place, known = list({w for words in texts for w in words}), {}, known[:0]
        if new:
            place.update(zip(new, range(len(place), len(place) + len(new))))
            known = np.concatenate([known, word_log_probs(new, pieces, probs)])
        best, score = [], []
        for words in texts:
            if not (words and langs):
                best.append("und")
                score.append(0.0)
                continue
            total = known[np.fromiter(map(place.__getitem__, words), np.int64, len(words))].sum(axis=0)
            top = int(total.argmax())
            best.append(langs[top])
            score.append(float(1 / np.exp(total - total[top]).sum()))
        yield rows, best, score


def _predict_task(model, langs: list[str]) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, best, score in _predictions(model, langs, batches):
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(best, pa.string()),
                                              pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])
    return task


def _keep_task(model, langs: list[str], least: float) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, best, score in _predictions(model, langs, batches):
            yield rows.filter(pa.array([b != "und" and s >= least for b, s in zip(best, score)], pa.bool_()))
    return task


def _fitted(docs: DataFrame, training, vocabulary: str, docs_per_lang: int, max_chars: int):
    pieces = public_pieces(vocabulary)
    langs, probs = fit(training_counts(docs, training, docs_per_lang, max_chars), pieces)
    return docs.sparkSession.sparkContext.broadcast((pieces, probs)), langs


def identify(docs: DataFrame, training, vocabulary: str, docs_per_lang: int = 400,
             max_chars: int = 20_000) -> DataFrame:
    """(doc_id, lang_pred, score) for every document; ``training`` marks the rows whose lang may be learnt.

    ``score`` is the posterior of the predicted language under equal priors.
    """
    model, langs = _fitted(docs, training, vocabulary, docs_per_lang, max_chars)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_predict_task(model, langs),
                                                    f"doc_id {kind}, lang_pred string, score double")


def known_languages(docs: DataFrame, training, vocabulary: str, least: float = 0.5, docs_per_lang: int = 400,
                    max_chars: int = 20_000) -> DataFrame:
    """The documents, all columns, whose language is predicted with a score of at least ``least``."""
    model, langs = _fitted(docs, training, vocabulary, docs_per_lang, max_chars)
    return docs.mapInArrow(_keep_task(model, langs, least), docs.schema)
