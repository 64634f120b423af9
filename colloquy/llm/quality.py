"""Quality by nearest neighbours in a latent-semantic space.

A text becomes counts of terms: shapes of its words (case, digits, symbols), the lower-cased words
themselves hashed, and a few facts about repetition. The log counts, weighted by inverse document
frequency, are projected on the leading right singular vectors of a bounded labelled sample. The
labelled vectors are broadcast; every text's cosines with all of them come from blocked matrix
products, and the nearest vote for their labels by similarity.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import labelled_sample, slices

SHAPES, WORDS, FACTS = 768, 1024, 64
TERMS = SHAPES + WORDS + FACTS
DIMENSIONS = 48
NEIGHBOURS = 15
TIED = 1e-6  # cosines so close count as equal
TEXTS_A_CLASS = 2500
CACHED = 200_000
LONG_WORD = 256  # longer words are worked out each time, so that the cache stays small

_RUNS = (
    (re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[0-9]+"), b"9"),
)
_AGAIN = re.compile(rb"(.)\1+", re.S)


class _Terms(dict):
    """word -> its shape's and its own term in one number, worked out once a word."""

    def __missing__(self, word: bytes) -> int:
        shape = word
        for pattern, letter in _RUNS:
            shape = pattern.sub(letter, shape)
        shape = _AGAIN.sub(rb"\1", shape)
        code = (zlib.crc32(shape) % SHAPES) * WORDS + zlib.crc32(word.lower()) % WORDS
        if len(word) > LONG_WORD:
            return code
        if len(self) >= CACHED:
            self.clear()
        self[word] = code
        return code


def _level(x: float, step: float, most: int) -> int:
    return min(most, int(x / step))


def term_counts(text: str, terms: _Terms) -> np.ndarray:
    """Log counts of the terms of one text."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    out = np.zeros(TERMS, np.float32)
    if not words:
        out[-1] = 1
        return out
    codes = np.fromiter(map(terms.__getitem__, words), np.int64, len(words))
    out[:SHAPES] = np.bincount(codes // WORDS, minlength=SHAPES)
    out[SHAPES : SHAPES + WORDS] = np.bincount(codes % WORDS, minlength=WORDS)
    n = len(words)
    out /= np.sqrt(n)
    out = np.log1p(out)
    lines = [x for x in raw.split(b"\n") if x]
    facts = out[SHAPES + WORDS :]
    strength = 2.0
    facts[_level(len(set(words)) / n, 0.0667, 15)] = strength
    facts[16 + _level(len(set(lines)) / max(1, len(lines)), 0.125, 8)] = strength
    facts[26 + _level(np.log2(n + 1), 1.5, 12)] = strength / 2
    facts[40 + _level(len(raw) / n, 1.0, 15)] = strength / 2
    return out


@dataclass
class QualityModel:
    """projection: terms x dimensions, idf folded in; vectors: unit rows of the labelled texts."""

    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    prior: float

    def embed(self, counts: np.ndarray) -> np.ndarray:
        x = counts @ self.projection
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def scores(self, counts: np.ndarray, neighbours: int = NEIGHBOURS, block: int = 1024) -> np.ndarray:
        """Votes of the nearest labelled vectors; labelled vectors are taken in blocks, all of them.

        All that are as near as the last of the nearest vote, too, so that ties need no order.
        """
        if not len(self.vectors):
            return np.full(len(counts), self.prior)
        x = self.embed(counts)
        blocks = [x @ self.vectors[start : start + block].T for start in range(0, len(self.vectors), block)]
        near = [np.partition(cos, max(0, cos.shape[1] - neighbours), axis=1)[:, -neighbours:] for cos in blocks]
        near = np.concatenate(near, axis=1)
        least = np.partition(near, max(0, near.shape[1] - neighbours), axis=1)[:, -neighbours:].min(axis=1, keepdims=True) - TIED
        votes, good = np.zeros(len(x)), np.zeros(len(x))
        for k, cos in enumerate(blocks):
            row, who = np.nonzero(cos >= least)
            vote = np.maximum(cos[row, who], 1e-3).astype(np.float64) ** 4 * self.weights[who + k * block]
            votes += np.bincount(row, vote, len(x))
            good += np.bincount(row, vote * self.labels[who + k * block], len(x))
        return good / votes


def _features(sample: DataFrame) -> list:
    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("class_rows", pa.int64()), ("terms", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _Terms()
        for part in slices(batches):
            rows = [term_counts(x, terms).astype(np.float16).tobytes() for x in part.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(rows, pa.binary())], schema=schema)

    typed = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "y", "class_rows", "text")
    return typed.mapInArrow(run, "doc_id long, y int, class_rows long, terms binary").collect()


def train_quality(
    documents: DataFrame, labels: DataFrame, train: Column,
    per_class: int = TEXTS_A_CLASS, dimensions: int = DIMENSIONS, label: str = "quality",
) -> QualityModel:
    """Fit on about per_class labelled texts of each class; their term counts (a few KB each) reach the driver.

    Without labelled texts the model gives every text the score 0.5; with one class, that class's label.
    """
    rows = sorted(_features(labelled_sample(documents, labels, label, train, per_class)))
    if not rows:
        empty = np.empty((0, 0), np.float32)
        return QualityModel(empty, empty, np.empty(0), np.empty(0), 0.5)
    x = np.frombuffer(b"".join(r["terms"] for r in rows), np.float16).reshape(len(rows), TERMS).astype(np.float32)
    y = np.array([r["y"] for r in rows], float)
    sizes = {r["y"]: r["class_rows"] for r in rows}
    took = {c: float((y == c).sum()) for c in sizes}
    weights = np.array([sizes[int(c)] / took[int(c)] for c in y])
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 0.1
    weighted = x * idf
    values, vectors = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    k = min(dimensions, len(rows))
    basis = vectors[:, ::-1][:, :k].astype(np.float32)
    projection = idf[:, None] * basis
    model = QualityModel(projection, np.empty((0, k), np.float32), y, weights / weights.max(), float(np.average(y, weights=weights)))
    model.vectors = model.embed(x).astype(np.float32)
    return model


def score_quality(documents: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """documents' columns with quality_score (0 to 1) and quality_pred added; columns of those names are replaced.

    A null text counts as empty; an empty text is scored like any other, by its neighbours.
    Repeated rows are kept and score alike.
    """
    shared = documents.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    # Bounded: terms x dimensions and 2 x per_class x dimensions numbers, a few MB.

    def run(text: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted, terms = pickle.loads(shared.value), _Terms()
        for column in text:
            got = [np.empty(0)]
            for k in range(0, len(column), 256):
                counts = np.stack([term_counts(x or "", terms) for x in column.slice(k, 256).to_pylist()])
                got.append(fitted.scores(counts))
            yield pa.array(np.concatenate(got), pa.float64())

    score = F.arrow_udf(run, "double", F.ArrowUDFType.SCALAR_ITER)
    rest = [c for c in documents.columns if c not in ("quality_score", "quality_pred")]
    out = documents.select(*rest, score(F.col("text")).alias("quality_score"))
    return out.withColumn("quality_pred", (F.col("quality_score") >= threshold).cast("int"))
