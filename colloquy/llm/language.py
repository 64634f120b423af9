"""Language identification by rank-order n-gram profiles (Cavnar and Trenkle, 1994).

A profile ranks the most frequent n-grams of a language's training texts; a text is ranked in the
same way, and the language whose profile is least out of place wins. Training counts are
summed by Spark over a bounded number of texts a language, chosen by hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.llm.common import share_below, slices

PROFILE = 300
TEXTS_A_LANGUAGE = 4000
MOST_LANGUAGES = 10_000
UNKNOWN = "und"

_table: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or 0 if it is no letter."""
    global _table
    if _table is None:
        lower = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                lower[c] = ord(low) if len(low) == 1 else c
        _table = lower
    return _table


def ngrams(text: str) -> np.ndarray:
    """Codes of all 1-, 2- and 3-grams of letters; a word is padded with one blank at each end."""
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")].astype(np.int64)
    if not codes.any():
        return np.empty(0, np.int64)
    codes = np.concatenate([[0], codes, [0]])
    keep = (codes != 0) | (np.concatenate([[1], codes[:-1]]) != 0)  # runs of blanks count as one
    codes = codes[keep]
    one = codes[codes != 0]
    two = (codes[:-1] << 21) | codes[1:]
    mid = codes[1:-1]
    three = ((codes[:-2] << 42) | (mid << 21) | codes[2:])[mid != 0]
    # A first bit a length keeps padded n-grams of different lengths apart.
    return np.concatenate([one, two | (1 << 62), three])


def ranked(grams: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent codes, most frequent first; of equals the smaller code."""
    values, counts = np.unique(grams, return_counts=True)
    if len(values) > size:
        least = np.partition(counts, -size)[-size]
        near = counts >= least
        values, counts = values[near], counts[near]
    return values[np.lexsort((values, -counts))][:size]


def language_profiles(
    documents: DataFrame, train: Column, size: int = PROFILE, texts_a_language: int = TEXTS_A_LANGUAGE
) -> dict[str, np.ndarray]:
    """language -> ranked n-gram codes, learnt from rows that satisfy train and have text and lang.

    About texts_a_language texts of each language are read, chosen by a hash of doc_id; what
    reaches the driver is size codes a language.
    """
    known = documents.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = known.groupBy("lang").agg(F.count("*").alias("rows"))
    if sizes.count() <= MOST_LANGUAGES:  # one row a language; a join by language would gather the hot one's texts
        sizes = F.broadcast(sizes)
    sample = known.join(sizes, "lang").where(
        share_below(F.col("doc_id"), F.least(F.lit(1.0), F.lit(float(texts_a_language)) / F.col("rows")))
    )
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 512):
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(ngrams(text))
            for lang, grams in by.items():
                values, counts = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values), pa.array(counts.astype(np.int64))], schema=schema
                )

    counts = sample.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    totals = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = totals.withColumn("rank", rank).where(F.col("rank") <= size).select("lang", "rank", "gram").collect()
    out: dict[str, list] = {}
    for row in sorted(rows):
        out.setdefault(row["lang"], []).append(row["gram"])
    return {lang: np.array(codes, np.int64) for lang, codes in sorted(out.items())}


def identify(text: str | None, profiles: tuple[list[str], np.ndarray, np.ndarray], size: int = PROFILE) -> tuple[str, float]:
    """(language, score) of one text; score is the distance saved against a profile with nothing in common."""
    names, grams, ranks = profiles
    own = ranked(ngrams(text), size) if text and names else ()
    if not len(own):
        return UNKNOWN, 0.0
    at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
    there = ranks[:, at]
    there = np.where(grams[at] == own, there, size)
    off = np.minimum(np.abs(there - np.arange(len(own))), size)
    off[there == size] = size
    distance = off.sum(axis=1) / (size * len(own))
    best = int(distance.argmin())
    return names[best], float(1 - distance[best])


def as_table(profiles: dict[str, np.ndarray], size: int = PROFILE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All codes in order, and for each language each code's rank, or size."""
    grams = np.unique(np.concatenate(list(profiles.values()))) if profiles else np.empty(0, np.int64)
    ranks = np.full((len(profiles), len(grams)), size, np.int64)
    for k, codes in enumerate(profiles.values()):
        ranks[k, np.searchsorted(grams, codes)] = np.arange(len(codes))
    return list(profiles), grams, ranks


def identify_languages(documents: DataFrame, profiles: dict[str, np.ndarray], size: int = PROFILE) -> DataFrame:
    """documents' columns with lang_pred and lang_score added (columns of those names are replaced).

    A null text, or one without a letter, is `und` with score 0, and so is every text if nothing
    was learnt. Of languages equally far the first by name is taken. Repeated rows are kept.
    """
    table = as_table(profiles, size)

    def run(text: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in text:
            got = [identify(x, table, size) for k in range(0, len(column), 256) for x in column.slice(k, 256).to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())], ["lang_pred", "lang_score"]
            )

    typed = F.arrow_udf(run, "lang_pred string, lang_score double", F.ArrowUDFType.SCALAR_ITER)
    rest = [c for c in documents.columns if c not in ("lang_pred", "lang_score")]
    out = documents.select(*rest, typed(F.col("text")).alias("_lang"))
    return out.select(*rest, F.col("_lang.lang_pred").alias("lang_pred"), F.col("_lang.lang_score").alias("lang_score"))
