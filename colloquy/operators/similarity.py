"""Similarity of token sequences and sets."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.session import Scratch


def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, list(x), list(y), autojunk=False).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def _longest(a: pd.Series, b: pd.Series) -> pd.Series:
    matches = (difflib.SequenceMatcher(None, list(x), list(y), autojunk=False).find_longest_match() for x, y in zip(a, b, strict=True))
    return pd.Series([m.size for m in matches], dtype="int64")


def sequence_ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp ratio of two token lists; two empty lists are equal."""
    return F.pandas_udf(_ratio, "double")(a, b)


def longest_run(a: Column, b: Column) -> Column:
    """Length of the longest run of tokens that two lists share."""
    return F.pandas_udf(_longest, "long")(a, b)


_BITS = 20
_WORDS = 4
_PART = 500_000
_BLOCK = 256
_CLASSES = 512
_HELD = 16_384


def jaccard_classes(rows: DataFrame, ident: str, tokens: str) -> DataFrame:
    """(id, class_id) of rows with tokens: the smallest id that has the same set of tokens."""
    return _classes(rows.where(F.size(tokens) > 0).select(F.col(ident).alias("id"), _set_name(tokens).alias("_set")))


def _set_name(tokens: str) -> Column:
    return F.sha2(F.to_json(F.array_sort(F.array_distinct(tokens))), 256)


def _classes(named: DataFrame) -> DataFrame:
    return named.join(named.groupBy("_set").agg(F.min("id").alias("class_id")), "_set").select("id", "class_id")


def _named(rows: DataFrame, ident: str, tokens: str, scratch: Scratch) -> DataFrame:
    """(id, _set, h) of rows with tokens: the name of the set and the sorted hashes of its tokens, which are spelt out once."""
    h = F.array_sort(F.transform(F.array_distinct(tokens), lambda x: F.xxhash64(x)))
    return scratch.save(rows.where(F.size(tokens) > 0).select(F.col(ident).alias("id"), _set_name(tokens).alias("_set"), h.alias("h")))


def _prefixes(sets: DataFrame, held: np.ndarray, threshold: float) -> DataFrame:
    """(key, prev, id, n, p, head, b0, ...) of sets (id, h): the tokens by which a set of n meets others, p being the token's place in the order of rarity, and the one before it.

    Those up to head are enough if the other set is as large or larger. b0, ... have a bit for each class of hashes, set if the set has an odd number of them.
    """
    bits = 64 * _WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lengths)
            a = 0
            while a < len(lengths):  # at most 4,096 rows of about _PART tokens at once
                before = ends[a] - lengths[a]
                b = min(a + 4096, max(a + 1, int(np.searchsorted(ends, before + _PART, side="right"))))
                h, n = flat[before : ends[b - 1]], lengths[a:b]
                row = np.repeat(np.arange(b - a), n)
                odd = np.bincount(row * bits + (h & np.uint64(bits - 1)).astype(np.int64), minlength=(b - a) * bits) & 1
                words = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(b - a, _WORDS)
                order = np.lexsort((h, held[(h >> np.uint64(64 - _BITS)).astype(np.int64)], row))
                place = np.arange(len(h)) - (np.cumsum(n) - n)[row] + 1
                kept = place <= (n - np.ceil(threshold * n - 1e-9) + 1)[row]
                key = h[order].view(np.int64)
                row, place, key, prev = row[kept], place[kept], key[kept], np.append(0, key[:-1])[kept]
                head = (n - np.ceil(2 * threshold / (1 + threshold) * n - 1e-9) + 1).astype(np.int64)
                columns = [pa.array(key), pa.array(prev), batch.column(0).take(pa.array(a + row)), *(pa.array(c.astype(np.int32)) for c in (n[row], place, head[row]))]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(np.ascontiguousarray(words[row, k])) for k in range(_WORDS)], names=names)
                a = b

    schema = f"key long, prev long, id {sets.schema['id'].dataType.simpleString()}, n int, p int, head int, " + ", ".join(f"b{k} long" for k in range(_WORDS))
    names = [c.split()[0] for c in schema.split(", ")]
    return sets.select("id", "h").mapInArrow(run, schema)


def side_by_side(pairs: DataFrame, left: DataFrame, right: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of left (a, ...) and right (b, ...) of each of different pairs (a, b), which are read more than once.

    Near rows hang together, so rows b go to the least partner that they have, _BLOCK or so at a time, and a row a goes to each block once, not once a pair.
    """
    least_a = pairs.groupBy("b").agg(F.min("a").alias("home"))
    homes = least_a.groupBy("home").agg(F.count("*").alias("n"))
    block = F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / _BLOCK))
    placed = scratch.save(least_a.join(homes, "home").select("b", "home", block.alias("block")))
    sent = pairs.join(placed, "b").groupBy("home", "block", "a").agg(F.collect_list("b").alias("bs"))  # those of a block
    return sent.join(left, "a").join(placed.join(right, "b"), ["home", "block"]).where(F.array_contains("bs", F.col("b")))


def _counts(sets: DataFrame) -> DataFrame:
    """(id, n, c) of sets (id, h): a byte for each of _CLASSES classes of hashes, how many of the set's n are in it, 255 for all beyond."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                lengths = part.column(1).value_lengths().to_numpy(zero_copy_only=False)
                of = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64) >> 20 & _CLASSES - 1
                cells = np.bincount(np.repeat(np.arange(part.num_rows) * _CLASSES, lengths) + of, minlength=part.num_rows * _CLASSES)
                c = pa.FixedSizeBinaryArray.from_buffers(pa.binary(_CLASSES), part.num_rows, [None, pa.py_buffer(np.minimum(cells, 255).astype(np.uint8))])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lengths.astype(np.int32)), c.cast(pa.binary())], names=["id", "n", "c"])

    return sets.select("id", "h").mapInArrow(run, f"id {sets.schema['id'].dataType.simpleString()}, n int, c binary")


def _not_apart(pairs: DataFrame, counts: DataFrame, threshold: float) -> DataFrame:
    """Those of different pairs (a, b) that counts (id, n, c) do not show to differ in more tokens than the threshold lets them.

    Rows b are dealt into blocks of about _HELD, each held by one task as their counts alone; a row a goes once to each block where it has partners.
    """
    kind = pairs.schema["b"].dataType.simpleString()
    right = pairs.select(F.col("b").alias("id")).distinct()
    blocks = max(1, -(-right.count() // _HELD))
    block = lambda x: F.pmod(F.xxhash64(x), F.lit(blocks)).cast("int").alias("block")
    held = right.join(counts, "id").select(block("id"), F.lit(0).alias("side"), "id", "n", "c", F.lit(None).cast(f"array<{kind}>").alias("others"))
    asked = pairs.groupBy(F.col("a").alias("id"), block("b")).agg(F.collect_list("b").alias("others")).join(counts, "id").select("block", F.lit(1).alias("side"), "id", "n", "c", "others")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, sizes, rows = None, [], [], []
        order = c_held = n_held = None
        for batch in batches:
            out_a, out_b = [], []
            part, side, name, n, c, others = (batch.column(k) for k in range(6))
            for i, (p, s, m) in enumerate(zip(part.to_pylist(), side.to_pylist(), n.to_pylist(), strict=True)):
                if p != at:
                    at, ids, sizes, rows, order = p, [], [], [], None
                counted = np.frombuffer(c[i].as_py(), np.uint8)
                if s == 0:
                    ids.append(name[i].as_py())
                    sizes.append(m)
                    rows.append(counted)
                    continue
                if order is None:  # all rows b of the block have come
                    ids = np.array(ids)
                    order = np.argsort(ids)
                    ids, n_held, c_held = ids[order], np.array(sizes)[order], np.stack(rows)[order]
                    sizes, rows = [], []
                b = np.array(others[i].as_py())
                found = np.searchsorted(ids, b)
                both = n_held[found] + m
                near = np.abs(c_held[found].astype(np.int16) - counted).sum(axis=1) <= both - 2 * (threshold / (1 + threshold) * both - 1e-9)
                if near.any():
                    b = b[near].tolist()
                    out_a += [name[i].as_py()] * len(b)
                    out_b += b
            yield pa.RecordBatch.from_arrays([pa.array(out_a, name.type), pa.array(out_b, name.type)], names=["a", "b"])

    rows = held.unionByName(asked).repartition(3 * blocks, "block").sortWithinPartitions("block", "side")
    return rows.mapInArrow(run, f"a {kind}, b {kind}")


def _links(named: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Links of sets (id, _set, h), a table of scratch that goes when it has been read."""
    firsts = named.groupBy("_set").agg(F.min("id").alias("id")).groupBy("id").agg(F.min("_set").alias("_set"))
    sets = scratch.save(named.join(firsts, ["_set", "id"], "left_semi").dropDuplicates(["_set", "id"]).select("id", "h"))
    scratch.drop(named)
    held = np.zeros(1 << _BITS, np.int64)
    found = sets.select(F.explode("h").alias("x")).groupBy(F.expr(f"shiftrightunsigned(x, {64 - _BITS})").alias("p")).agg(F.count("*").alias("n")).toPandas()
    held[found["p"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    pairs = scratch.save(_meeting(_prefixes(sets, held, threshold), threshold).distinct())
    scratch.release()
    counts = scratch.save(_counts(sets), compression="zstd")
    near = scratch.save(_not_apart(pairs, counts, threshold))
    scratch.drop(pairs, counts)
    scratch.release()
    full = side_by_side(near, sets.select(F.col("id").alias("a"), F.col("h").alias("ha")), sets.select(F.col("id").alias("b"), F.col("h").alias("hb")), scratch)
    met = F.size(F.array_intersect("ha", "hb"))
    return full.select("a", "b", (met / (F.size("ha") + F.size("hb") - met)).alias("jaccard")).where(F.col("jaccard") >= threshold)


def _meeting(prefix: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of sets that share a token of their prefixes and may reach the threshold by what their rows say, once for each run of tokens that both have."""
    x = prefix.where("p <= head").select("key", *[F.col(c).alias(c + "x") for c in prefix.columns if c not in ("key", "head")])
    y = prefix.select("key", *[F.col(c).alias(c + "y") for c in prefix.columns if c not in ("key", "head")])
    smaller = (F.col("nx") < F.col("ny")) | (F.col("nx") == F.col("ny")) & (F.col("idx") < F.col("idy"))
    both = F.col("nx") + F.col("ny")
    least = threshold / (1 + threshold) * both - 1e-9
    # At the first token that two sets share none was shared before it, so all others are behind it in both; prev is of the same set if p > 1.
    first = (1 + F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py")) >= least) & ((F.col("px") == 1) | (F.col("py") == 1) | (F.col("prevx") != F.col("prevy")))
    apart = sum((F.bit_count(F.col(f"b{k}x").bitwiseXOR(F.col(f"b{k}y"))) for k in range(1, _WORDS)), F.bit_count(F.col("b0x").bitwiseXOR(F.col("b0y"))))
    pairs = x.join(y, "key").where(smaller & (F.col("nx") >= threshold * F.col("ny") - 1e-9) & first & (apart <= both - 2 * least))
    return pairs.select(F.least("idx", "idy").alias("a"), F.greatest("idx", "idy").alias("b"))


def jaccard_links(rows: DataFrame, ident: str, tokens: str, threshold: float) -> DataFrame:
    """(a, b, jaccard): pairs a < b of jaccard_classes() whose sets reach the threshold; a set that many rows have is compared once.

    Tokens are ordered by how many sets hold a token of their class of hashes, rare ones first. Two sets can reach the threshold only if the first token that both have
    stands in the n - ceil(2 * threshold / (1 + threshold) * n) + 1 first of the smaller and the n - ceil(threshold * n) + 1 first of the larger, if enough
    tokens follow it, and if not more classes differ in parity than tokens may. All of this is asked where they meet. Pairs that pass are then told apart by how many tokens
    each class has, which is 512 bytes a set; only sets that pass this too are fetched and compared in full, by the 64-bit hashes of their tokens.
    """
    scratch = Scratch(rows.sparkSession, "jaccard")
    return _links(_named(rows, ident, tokens, scratch), threshold, scratch)


def jaccard_join(rows: DataFrame, ident: str, tokens: str, threshold: float) -> DataFrame:
    """(a, b, jaccard): all pairs a < b of rows whose token sets reach the threshold, those of equal sets too.

    Found by jaccard_links(); where many rows may have one set, use that and jaccard_classes(), as the pairs here grow with the square of the copies.
    """
    scratch = Scratch(rows.sparkSession, "jaccard")
    named = _named(rows, ident, tokens, scratch)
    members = scratch.save(_classes(named.select("id", "_set")))
    links = scratch.save(_links(named, threshold, scratch))
    one, other = members.select(F.col("class_id").alias("a"), F.col("id").alias("x")), members.select(F.col("class_id").alias("b"), F.col("id").alias("y"))
    far = links.join(one, "a").join(other, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "jaccard")
    near = one.join(other.withColumnRenamed("b", "a"), "a").where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b"), F.lit(1.0).alias("jaccard"))
    return far.unionByName(near)
