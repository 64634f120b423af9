"""Toxicity by multiple-instance learning.

Sentences are the instances: a sentence's chance is the logistic of the summed weights of its words,
a word's weight the sum of the weights of its features (the word and its first letters), and a
document's chance is the noisy-or of its sentences. Weights are not negative, so that no number of
harmless words hides an offending one, and are learnt from document labels alone; the learnt sentence chances then locate the offending sentences.
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

BUCKETS = 1 << 18
PREFIXES = (3, 4, 5, 6, 7, 8)
SEEN_IN = 4
TEXTS_A_CLASS = 3000
ROUNDS = 120
PENALTY = 1e-5
CACHED = 200_000
LONG_WORD = 256  # longer words are worked out each time, so that the cache stays small
OFFENDS = 0.5
DECISION = 0.7

_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
_PUNCTUATION = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~¡¿«»“”„‘’…"


def lowered(text: str) -> str:
    """text in lower case, character by character where a letter would become two, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower()[0] for c in text)


def word_features(word: str) -> list[int]:
    """Buckets of a word and of its first letters."""
    w = word.strip(_PUNCTUATION)
    if not w:
        return []
    names = [w, *(f"{w[:n]}-" for n in PREFIXES if len(w) >= n)]
    return [zlib.crc32(x.encode("utf-8", "replace")) % BUCKETS for x in names]


class _Weights(dict):
    """word -> summed weight of its features, worked out once a word."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = float(self.weights[word_features(word)].sum())
        if len(word) > LONG_WORD:
            return value
        if len(self) >= CACHED:
            self.clear()
        self[word] = value
        return value


@dataclass
class ToxicityModel:
    """weights and bias of a sentence's logit; slope and offset turn a document's logit into its chance."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def sentences(self, text: str, known: _Weights) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Spans of the text's sentences and their chances."""
        spans, logits = [], []
        for m in _SENTENCE.finditer(lowered(text)):
            words = m[0].split()
            if words:
                spans.append(m.span())
                logits.append(sum(map(known.__getitem__, words)))
        return spans, _logistic(np.array(logits, float) + self.bias)

    def document(self, chances: np.ndarray) -> float:
        none = np.log1p(-np.minimum(chances, 1 - 1e-9)).sum()
        some = -np.expm1(none)
        logit = np.log(max(some, 1e-12)) - none
        return float(_logistic(self.slope * logit + self.offset))


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _bags(sample: DataFrame) -> list:
    """Rows of (doc_id, y, class_rows, words, sentence of each word), words as indices into features."""
    schema = "doc_id long, y int, class_rows long, words array<string>, sentence array<int>"
    arrow = pa.schema(
        [("doc_id", pa.int64()), ("y", pa.int32()), ("class_rows", pa.int64()), ("words", pa.list_(pa.string())), ("sentence", pa.list_(pa.int32()))]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words, sentences = [], []
            for text in part.column(3).to_pylist():
                own = [x.split() for x in _SENTENCE.findall(lowered(text))]
                words.append([w for x in own for w in dict.fromkeys(x)])
                sentences.append([k for k, x in enumerate(own) for _ in dict.fromkeys(x)])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), pa.array(words, arrow.field(3).type), pa.array(sentences, arrow.field(4).type)],
                schema=arrow,
            )

    typed = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "y", "class_rows", "text")
    return typed.mapInArrow(run, schema)


def train_toxicity(
    documents: DataFrame, labels: DataFrame, train: Column,
    per_class: int = TEXTS_A_CLASS, rounds: int = ROUNDS, label: str = "toxic",
) -> ToxicityModel:
    """Fit on about per_class labelled texts of each class, whose words reach the driver.

    Without labelled texts every document scores 0.5; with one class the model leans to it.
    """
    rows = _bags(labelled_sample(documents, labels, label, train, per_class)).toLocalIterator()
    return fit_bags(sorted(rows, key=lambda r: r["doc_id"]), rounds)


def fit_bags(rows: list, rounds: int = ROUNDS) -> ToxicityModel:
    """Full-batch descent on the noisy-or likelihood of the documents; see _bags() for rows.

    A feature is learnt from only if at least SEEN_IN different texts have it.
    """
    index: dict[str, int] = {}
    word_ids, sentence_ids, owners, ys, sizes = [], [], [], [], {}
    n_sentences = 0
    seen: set[int] = set()
    for row in rows:
        if not row["words"] or (key := hash(tuple(row["words"]))) in seen:
            continue
        seen.add(key)
        word_ids.append(np.fromiter((index.setdefault(w, len(index)) for w in row["words"]), np.int32, len(row["words"])))
        kinds, own = np.unique(np.asarray(row["sentence"], np.int32), return_inverse=True)
        sentence_ids.append((own + n_sentences).astype(np.int32))
        owners.append(np.full(len(kinds), len(ys), np.int32))
        n_sentences += len(kinds)
        ys.append(row["y"])
        sizes[row["y"]] = row["class_rows"]
    if not ys:
        return ToxicityModel(np.zeros(BUCKETS, np.float32), 0.0, 0.0, 0.0)
    features = [word_features(w) for w in index]
    feature_word = np.repeat(np.arange(len(index)), [len(f) for f in features]).astype(np.int32)
    feature_ids = np.array([f for x in features for f in x], np.int32)
    first = np.concatenate([[0], np.cumsum([len(f) for f in features])])
    texts = np.zeros(BUCKETS, np.int32)
    for words in word_ids:
        own = np.unique(words)
        texts[np.unique(np.concatenate([feature_ids[first[w] : first[w + 1]] for w in own]))] += 1
    known = texts[feature_ids] >= SEEN_IN
    feature_word, feature_ids = feature_word[known], feature_ids[known]
    n_words = len(index)
    del index, features
    word_ids, sentence_ids, owners, y = map(np.concatenate, (word_ids, sentence_ids, owners, [np.array(ys, float)]))

    # Every fourth text only calibrates: its logit is not one that the weights were fitted to.
    fitted = np.arange(len(y)) % 4 != 3
    if len(set(y[~fitted])) < 2:
        fitted[:] = True
    share = fitted / fitted.sum()
    prior = {c: sizes[c] / (y == c).sum() for c in sizes}
    weight = np.array([prior[int(c)] for c in y])
    weight /= weight.mean()
    w, bias = np.zeros(BUCKETS), -5.0
    mean, square, mean_b, square_b = np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0
    rate, penalty = 0.15, PENALTY

    def chances() -> np.ndarray:
        of_word = np.bincount(feature_word, weights=w[feature_ids], minlength=n_words)
        return _logistic(np.bincount(sentence_ids, weights=of_word[word_ids], minlength=n_sentences) + bias)

    for t in range(1, rounds + 1):
        p = chances()
        none = np.exp(np.bincount(owners, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(y)))
        some = np.maximum(1 - none, 1e-9)
        slope = (np.where(y > 0, -none / some, 1.0) * share)[owners] * p
        of_word = np.bincount(word_ids, weights=slope[sentence_ids], minlength=n_words)
        grad = np.bincount(feature_ids, weights=of_word[feature_word], minlength=BUCKETS) + penalty * w
        grad_b = slope.sum()
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        mean_b, square_b = 0.9 * mean_b + 0.1 * grad_b, 0.99 * square_b + 0.01 * grad_b**2
        m, v = 1 - 0.9**t, 1 - 0.99**t
        w = np.maximum(w - rate * (mean / m) / (np.sqrt(square / v) + 1e-6), 0)
        bias -= rate * (mean_b / m) / (np.sqrt(square_b / v) + 1e-6)
    p = chances()
    none = np.bincount(owners, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(y))
    logit = np.log(np.maximum(-np.expm1(none), 1e-12)) - none
    held = ~fitted if not fitted.all() else fitted
    return ToxicityModel(w.astype(np.float32), float(bias), *_calibrate(logit[held], y[held], weight[held]))


def _calibrate(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset that put the best F1's logit at a chance of DECISION.

    The slope spreads the logits of the calibration documents; the cut is the middle of the
    widest run of equally good cuts, classes weighted as in the labelled rows.
    """
    order = np.argsort(logit, kind="stable")
    z, w, positive = logit[order], weight[order], y[order] > 0
    hits = np.cumsum((w * positive)[::-1])[::-1]
    false = np.cumsum((w * ~positive)[::-1])[::-1]
    f1 = 2 * hits / np.maximum(hits + false + (w * positive).sum(), 1e-12)
    best = int(f1.argmax())
    below = z[best - 1] if best else z[best] - 2.0
    cut = (z[best] + below) / 2
    slope = 4.0 / max(2.0, float(np.median(np.abs(z - cut))))
    return slope, float(np.log(DECISION / (1 - DECISION)) - slope * cut)


def score_toxicity(documents: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """documents' columns with toxic_score, toxic_pred and offending added; columns of those names are replaced.

    offending: spans (start, end, in characters) of sentences whose own chance is at least a half,
    with that chance, in text order. A null or empty text has no sentences and the lowest document chance.
    Repeated rows are kept and score alike.
    """
    shared = documents.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    kind = pa.struct(
        [("score", pa.float64()), ("offending", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))]
    )

    def run(text: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = pickle.loads(shared.value)
        known = _Weights(fitted.weights)
        for column in text:
            got = []
            for k in range(0, len(column), 256):
                for x in column.slice(k, 256).to_pylist():
                    spans, chances = fitted.sentences(x or "", known)
                    hits = [{"start": spans[i][0], "end": spans[i][1], "score": float(chances[i])} for i in np.flatnonzero(chances >= OFFENDS)]
                    got.append({"score": fitted.document(chances), "offending": hits})
            yield pa.array(got, kind)

    scored = F.arrow_udf(run, "score double, offending array<struct<start:int,end:int,score:double>>", F.ArrowUDFType.SCALAR_ITER)
    rest = [c for c in documents.columns if c not in ("toxic_score", "toxic_pred", "offending")]
    out = documents.select(*rest, scored(F.col("text")).alias("_toxic"))
    return out.select(
        *rest, F.col("_toxic.score").alias("toxic_score"),
        (F.col("_toxic.score") >= threshold).cast("int").alias("toxic_pred"), F.col("_toxic.offending").alias("offending"),
    )
