"""Approximate nearest neighbours by an adaptive scan over the dimensions.

``build_index`` deals all vectors to the nearest of a few centroids and packs each list into pieces of bounded size,
as rotated vectors in blocks of columns beside the originals. After a random rotation any d of the D dimensions
estimate the whole squared distance as D / d times their own, so ``search`` adds block after block and abandons a
candidate as soon as a hypothesis test says that its distance is above the query's k-th one: estimate > (1 + EPSILON / sqrt d)
times it. Survivors of the last block get their exact distance on the original vectors, in double precision.

A query first searches its nearest list, which gives the k-th distance that abandons most candidates of its other
lists early. How many lists are probed is measured on the sample that the centroids come from.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.session import Scratch

#: Numbers in the sample that centroids, rotation and probes are fitted on (8 bytes each, on the driver).
SAMPLE_VALUES = 4_000_000
MOST_LISTS = 1024
#: Numbers in a piece of a list, which is what a task holds at a time.
PIECE_VALUES = 32_768
QUERIES_A_CHUNK = 256
WIDTH = 16
EPSILON = 2.1
#: Share of the sample's own neighbours that the probed lists must hold.
WANTED = 0.98


@dataclass
class VectorIndex:
    """pieces: (list, n, ids, originals, blocks); all vectors of length dim, ids and rows as they came."""

    pieces: DataFrame
    dim: int
    mean: np.ndarray = field(repr=False)
    rotation: np.ndarray = field(repr=False)
    centroids: np.ndarray = field(repr=False)
    probes: int = 1


def takes_part(vector: Column) -> Column:
    """True for vectors that are not null, not empty, not all zero, and hold neither null nor a number that is not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part: with an id and a vector that can be measured, as doubles."""
    numbers = F.col(vector).cast("array<double>")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("vector")).where(F.col("vec_id").isNotNull() & takes_part(F.col("vector")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _fit(sample: np.ndarray, lists: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and Lloyd's centroids of the sample; an empty list keeps its centroid."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(8):
        near = _order(sample, centroids, 1)[:, 0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, sample)
        sizes = np.bincount(near, minlength=lists)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return sample.mean(axis=0), centroids


def _order(x: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centroids of each row, nearest first."""
    parts = []
    squares = (centroids**2).sum(axis=1)
    for a in range(0, len(x), 4096):
        d = squares - 2 * x[a : a + 4096] @ centroids.T
        near = np.argpartition(d, n - 1, axis=1)[:, :n] if n < len(centroids) else np.tile(np.arange(len(centroids)), (len(d), 1))
        parts.append(np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, axis=1), axis=1, kind="stable"), axis=1))
    return np.concatenate(parts) if parts else np.empty((0, n), np.int64)


def _probes(sample: np.ndarray, centroids: np.ndarray, k: int, wanted: float) -> int:
    """The least number of lists that hold the wanted share of the k neighbours that rows of the sample have in the sample."""
    asked = sample[:: max(1, len(sample) // 200)]
    own = _order(sample, centroids, 1)[:, 0]
    place = np.argsort(_order(asked, centroids, len(centroids)), axis=1)  # of each list in each query's order
    d = (sample**2).sum(axis=1) - 2 * asked @ sample.T
    near = np.argpartition(d, min(k, len(sample) - 1), axis=1)[:, : k + 1]
    ranks = np.sort(np.take_along_axis(place, own[near], axis=1).ravel())
    return int(ranks[min(len(ranks) - 1, math.ceil(wanted * len(ranks)))]) + 1


def build_index(vectors: DataFrame, vector: str = "embedding", k: int = 10, lists: int | None = None, sample_values: int = SAMPLE_VALUES, piece_values: int = PIECE_VALUES, seed: int = 12) -> VectorIndex | None:
    """Index every row of vectors (vec_id, vector) that takes part (see usable) and has the commonest length; None if there is none.

    Fitted on a sample of about sample_values numbers; every row is dealt to a list. A list of any size, one of copies included, is cut into pieces, which are
    different rows and tasks. Rows that repeat an id are candidates of their own.
    """
    scratch = Scratch(vectors.sparkSession, "vectors")
    rows = usable(vectors, vector)
    common = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.col("count").desc(), "dim").first()
    if common is None:
        return None
    dim, count = common
    rows = rows.where(F.size("vector") == dim)
    most = max(1000, sample_values // dim)
    some = rows.select("vector").sample(fraction=min(1.0, most / count), seed=seed).limit(most) if count > most else rows.select("vector")
    sample = _matrix(some.toArrow().column(0).combine_chunks(), dim)
    if not len(sample):
        sample = _matrix(rows.select("vector").limit(most).toArrow().column(0).combine_chunks(), dim)
    lists = min(lists or round(math.sqrt(count)) or 1, MOST_LISTS, len(sample))
    mean, centroids = _fit(sample, lists, seed)
    probes = _probes(sample, centroids, k, WANTED)
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))[0]

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for b in batches:
            if b.num_rows:
                near = _order(_matrix(b.column(1), dim), centroids, 1)[:, 0]
                salt = np.arange(seen, seen + b.num_rows)
                seen += b.num_rows
                yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), pa.array(salt), b.column(0), b.column(1)], names=["list", "salt", "vec_id", "vector"])

    dealt = scratch.save(rows.mapInArrow(deal, "list int, salt long, vec_id long, vector array<double>"))
    size = max(16, piece_values // dim)
    pieces = dealt.groupBy("list").agg(F.ceil(F.count("*") / size).cast("int").alias("pieces"))  # a row a list, MOST_LISTS at most
    split = dealt.join(F.broadcast(pieces), "list").withColumn("piece", F.pmod(F.xxhash64("salt", "vec_id"), F.col("pieces")).cast("int"))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at, n = None, 0

        def row() -> pa.RecordBatch:
            ids, x = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            turned = ((x - mean) @ rotation).astype(np.float32)
            blocks = [np.ascontiguousarray(turned[:, a : a + WIDTH]).tobytes() for a in range(0, dim, WIDTH)]
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([ids.tobytes()]), pa.array([x.tobytes()]), pa.array([blocks], pa.list_(pa.binary()))],
                names=["list", "n", "ids", "originals", "blocks"],
            )

        for b in batches:
            keys = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], axis=1)
            ids, x = b.column(2).to_numpy(), _matrix(b.column(3), dim)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), b.num_rows]
            for a, e in zip(cuts, cuts[1:]):
                if a == e:
                    continue
                key = tuple(int(v) for v in keys[a])
                while a < e:
                    if held and (key != at or n == size):
                        yield row()
                        held, n = [], 0
                    at, stop = key, min(e, a + size - n)
                    held.append((ids[a:stop], x[a:stop]))
                    a, n = stop, n + stop - a
        if held:
            yield row()

    packed = (
        split.repartition("list", "piece").sortWithinPartitions("list", "piece").select("list", "piece", "vec_id", "vector")
        .mapInArrow(pack, "list int, n int, ids binary, originals binary, blocks array<binary>")
    )
    out = scratch.save(packed)
    scratch.drop(dealt)
    return VectorIndex(out, dim, mean, rotation, centroids, probes)


def _scan(q: np.ndarray, query_ids: np.ndarray, bounds: np.ndarray, ids: np.ndarray, x: np.ndarray, blocks: list[np.ndarray], mean: np.ndarray, rotation: np.ndarray, k: int) -> Iterator[tuple[int, int, float]]:
    """For each query the nearest k at most of one piece that pass the tests: (query_id, vec_id, distance)."""
    turned = (q - mean) @ rotation
    squares = [(b.astype(np.float64) ** 2).sum(axis=1) for b in blocks]
    #: Above the rounding of 32-bit columns, below which no difference tells.
    slack = 1e-6 * (sum(squares).max() + (turned**2).sum(axis=1))
    width = blocks[0].shape[1]
    first = squares[0] + (turned[:, :width] ** 2).sum(axis=1)[:, None] - 2 * turned[:, :width] @ blocks[0].astype(np.float64).T
    for i in range(len(q)):
        bound = bounds[i]
        if not np.isfinite(bound):  # the k-th of the piece's first rows
            some = np.sort(((x[: 4 * k] - q[i]) ** 2).sum(axis=1)[ids[: 4 * k] != query_ids[i]])
            bound = math.sqrt(some[k - 1]) if len(some) >= k else math.inf
        alive, partial, d = np.arange(len(x)), first[i], 0
        for b, block in enumerate(blocks):
            if b:
                partial = partial + ((block[alive] - turned[i, d : d + block.shape[1]]) ** 2).sum(axis=1)
            d += block.shape[1]
            factor = 1.0 if d == len(mean) else (1 + EPSILON / math.sqrt(d)) ** 2 * d / len(mean)
            stays = ~(partial > factor * bound**2 + slack[i])  # also where it is no number
            alive, partial = alive[stays], partial[stays]
            if not len(alive):
                break
        alive = alive[ids[alive] != query_ids[i]]
        exact = np.sqrt(((x[alive] - q[i]) ** 2).sum(axis=1))
        for j in np.lexsort((ids[alive], exact))[:k]:
            yield int(query_ids[i]), int(ids[alive[j]]), float(exact[j])


def _searched(index: VectorIndex, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) of asked (query_id, vector, list, bound): each piece's best for each query that asks its list."""
    counts = asked.groupBy("list").agg(F.ceil(F.count("*") / QUERIES_A_CHUNK).alias("chunks"))  # a row a list
    chunk = F.pmod(F.xxhash64("query_id"), F.col("chunks"))
    chunks = asked.join(F.broadcast(counts), "list").groupBy("list", chunk.alias("chunk")).agg(F.collect_list(F.struct("query_id", "vector", "bound")).alias("asked"))
    dim, mean, rotation = index.dim, index.mean, index.rotation
    names, kinds = ["query_id", "vec_id", "score"], (pa.int64(), pa.int64(), pa.float64())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids, originals, blocks, asked = (batch.column(c)[r] for c in range(4))
                ids = np.frombuffer(ids.as_buffer(), np.int64)
                x = np.frombuffer(originals.as_buffer(), np.float64).reshape(-1, dim)
                parts = [np.frombuffer(b.as_buffer(), np.float32).reshape(len(ids), -1) for b in blocks.values]
                query_ids, q, bounds = (asked.values.field(c) for c in range(3))
                bounds = bounds.to_numpy(zero_copy_only=False)
                found = list(_scan(_matrix(q, dim), query_ids.to_numpy(), np.where(np.isnan(bounds), np.inf, bounds), ids, x, parts, mean, rotation, k))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

    joined = index.pieces.join(chunks, "list").select("ids", "originals", "blocks", "asked")
    return joined.mapInArrow(run, "query_id long, vec_id long, score double")


def search(index: VectorIndex | None, queries: DataFrame, vector: str = "embedding", k: int = 10, probes: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row of queries (vec_id, vector), nearest first, ties by vec_id.

    Queries are the rows that take part and have the index's length, one an id (the smallest vector of repeated ones). A query's candidates are all
    rows of other ids; with copies of a candidate's row each ranks. probes: lists searched, else what was measured when the index was built.
    """
    spark = queries.sparkSession
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n = min(probes or index.probes, len(index.centroids))
    dim, centroids = index.dim, index.centroids
    scratch = Scratch(spark, "neighbours")

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                order = _order(_matrix(b.column(1), dim), centroids, n).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(order.tolist(), pa.list_(pa.int32()))], names=["query_id", "vector", "lists"])

    rows = usable(queries, vector).where(F.size("vector") == dim).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = scratch.save(rows.mapInArrow(probe, "query_id long, vector array<double>, lists array<int>"))
    none = F.lit(None).cast("double").alias("bound")
    near = scratch.save(_best(_searched(index, asked.select("query_id", "vector", F.col("lists")[0].alias("list"), none), k), k))
    bound = near.where(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))
    others = asked.join(bound, "query_id", "left").select("query_id", "vector", F.explode(F.slice("lists", 2, max(n - 1, 1))).alias("list"), "bound")
    return _best(near.drop("rank").unionByName(_searched(index, others, k)), k)


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
