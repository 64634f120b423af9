"""Keys under which a run of tokens and the rows that hold it meet, for containment joins.

Runs of fewer than WINDOW tokens meet under the run itself. Longer ones meet under minimizers: of the GRAM-token grams in every
WINDOW tokens the one with the least key. What stands in a row has its windows there too, so it has no minimizer that the row lacks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, GRAM = 8, 4
#: What a key is to its row: a run that only stands in it, a minimizer, or the whole of a short row.
INNER, MINIMIZER, WHOLE = 0, 1, 2
_BITS = 20
_PART = 500_000
_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(group: np.ndarray, name: np.ndarray, lengths: np.ndarray, h: np.ndarray, asked: np.ndarray | None, whole: bool) -> list[np.ndarray]:
    """key, proof (a second hash of short runs), name, size, of (minimizers of the row, or 1) and kind of rows with their tokens' hashes one after the other in h."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    start = np.cumsum(lengths) - lengths
    left = lengths[row] - (np.arange(len(h)) - start[row])
    padded = np.concatenate([h, np.zeros(WINDOW, np.uint64)])
    found = []
    sums = [np.zeros(len(h), np.uint64), np.zeros(len(h), np.uint64)]
    for m in range(1, WINDOW):
        sums = [s * f + padded[m - 1 : m - 1 + len(h)] for s, f in zip(sums, _FACTORS, strict=True)]
        if m == GRAM:
            grams = _mix(sums[0] ^ group[row] ^ np.uint64(WINDOW))
        if asked is None and not whole:
            continue
        own = lengths[row] == m
        at = np.flatnonzero((left >= m) & (own if whole else lengths[row] >= m))
        key = _mix(sums[0][at] ^ group[row[at]] ^ np.uint64(m << 8))
        if asked is not None:
            some = asked[(key >> np.uint64(64 - _BITS)).astype(np.int64)]
            at, key = at[some], key[some]
        kind = np.where(own[at], WHOLE, INNER)
        found.append((key, _mix(sums[1][at] + _mix(group[row[at]])), row[at], np.ones(len(at), np.int64), kind))
    if not whole:
        least = np.concatenate([grams, np.zeros(WINDOW, np.uint64)])
        low = least[: len(h)].copy()
        for k in range(1, WINDOW - GRAM + 1):
            np.minimum(low, least[k : k + len(h)], out=low)
        at = np.flatnonzero(left >= WINDOW)
        key, of = low[at], row[at]
        new = np.ones(len(at), bool)
        new[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
        key, of = key[new], of[new]
        count = np.bincount(of[_first(of, key)], minlength=len(lengths))
        found.append((key, np.zeros(len(key), np.uint64), of, count[of], np.full(len(key), MINIMIZER)))
    key, proof, of, many, kind = (np.concatenate(c) for c in zip(*found, strict=True))
    once = _first(of, key, proof, kind)
    key, proof, of, many, kind = key[once], proof[once], of[once], many[once], kind[once]
    return [key.view(np.int64), proof.view(np.int64), name[of], lengths[of], many, kind]


def _first(*columns: np.ndarray) -> np.ndarray:
    """Where rows of the columns stand for the first time."""
    order = np.lexsort(columns)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
    return order[new]


def _keyed(rows: DataFrame, asked: bytes | None, whole: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if asked is None else np.unpackbits(np.frombuffer(asked, np.uint8)).astype(bool)
        for batch in batches:
            group, name = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            lists = batch.column(2)
            h = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lengths)
            a = 0
            while a < len(lengths):  # rows of about _PART tokens at once
                before = ends[a] - lengths[a]
                b = max(a + 1, int(np.searchsorted(ends, before + _PART, side="right")))
                out = _keys(group[a:b].view(np.uint64), name[a:b], lengths[a:b], h[before : ends[b - 1]], bits, whole)
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in out], names=names)
                a = b

    names = ["key", "proof", "name", "size", "of", "kind"]
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def keyed_runs(texts: DataFrame, least: int) -> DataFrame:
    """(key, proof, name, size, of, kind) of rows (group, name, t), group and name being longs and t tokens, at least least of them: all that their runs can meet under.

    Runs shorter than WINDOW are given only if their hash is among those of the rows that are so short, by a bit table of fixed size; more of them pass as it fills.
    """
    hashed = texts.select("group", "name", F.transform("t", lambda x: F.xxhash64(x)).alias("h"))
    asked = None
    if least < WINDOW:
        short = _keyed(texts.where(F.size("t") < WINDOW).select("group", "name", F.transform("t", lambda x: F.xxhash64(x)).alias("h")), None, True)
        places = [r[0] for r in short.select(F.expr(f"shiftrightunsigned(key, {64 - _BITS})").alias("p")).distinct().collect()]
        table = np.zeros(1 << _BITS, bool)
        table[places] = True
        asked = np.packbits(table).tobytes() if places else None
    return _keyed(hashed, asked, False)
