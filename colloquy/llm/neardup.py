"""Near-duplicate documents by b-bit MinHash.

1. A text's set of word shingles is hashed; texts with the same set form one class, whose smallest
   id stands for it from then on, so exact copies are never compared.
2. Each class gets one minimum for each of BANDS * ROWS hash functions. The minima of a band make its
   key; the low BITS of all of them, packed into longs, make the signature.
3. Within a band, every class is paired with one pivot of its key, chosen by hash (a star, so that a
   key shared by n classes makes n - 1 pairs, not n squared). The similarity estimated from equal
   bits, corrected for chance collisions, drops pairs that cannot be links; the rest are confirmed
   on their full sets, and the links' components are formed.
4. Keys whose classes still stand in several components are gone through in full, so that the stars
   lose no link: classes that such keys connect are dealt into blocks, and every pair of blocks is
   compared in a task of its own, which gives back only confirmed links between components.

With 32 bands of 5 rows a pair of similarity 0.8 meets in no band once in 300,000 times, one of 0.85
once in 30 million times.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.llm.common import slices
from colloquy.operators.graph import connected_components
from colloquy.session import Scratch

SHINGLE = 5
THRESHOLD = 80
BANDS, ROWS, BITS = 32, 5, 2
#: Classes in a block of step 4; a task holds two blocks of sets.
BLOCK = 512
#: A pair whose estimate lies this far below the threshold is no link: 6 standard deviations at 0.8.
SLACK = 0.24

_HASHES = BANDS * ROWS
_rng = np.random.default_rng(20240101)
_MULTIPLY = _rng.integers(1, 1 << 63, _HASHES, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, _HASHES, dtype=np.uint64)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Distinct 64-bit hashes of a text's word shingles, in order.

    A-Z are lower-cased; words are runs of anything but ASCII white space. A text of fewer words
    than a shingle, but at least one, has its whole sequence as one; others have none.
    """
    if not text:
        return np.empty(0, np.uint64)
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    if len(words) <= size:
        return np.array([digest(b" ".join(words))], np.uint64)
    if size == 1:
        grams: Iterable[bytes] = words
    elif size == 2:
        grams = {a + b" " + b for a, b in itertools.pairwise(words)}
    else:
        grams = {b" ".join(x) for x in zip(*[words[k:] for k in range(size)], strict=False)}
    return np.unique(np.fromiter(map(digest, grams), np.uint64, len(grams)))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function (the high 32 bits of an odd multiple) over the set."""
    out = np.full(_HASHES, 0xFFFFFFFF, np.uint64)
    for start in range(0, len(hashes), 512):
        values = hashes[None, start : start + 512] * _MULTIPLY[:, None]
        values += _ADD[:, None]
        np.minimum(out, values.min(axis=1) >> np.uint64(32), out=out)
    return out


def _signatures(documents: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, bits, keys) of every row."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bits", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64()))]
    )
    per_long = 64 // BITS
    shifts = (np.arange(per_long, dtype=np.uint64) * np.uint64(BITS))[None, :]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n, set_keys, bits, keys = [], [], [], []
            for text in part.column(1).to_pylist():
                hashes = shingle_hashes(text, size)
                n.append(len(hashes))
                if not len(hashes):
                    set_keys.append(None), bits.append(None), keys.append(None)
                    continue
                low = minima(hashes)
                set_keys.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                packed = (low & np.uint64((1 << BITS) - 1)).reshape(-1, per_long) << shifts
                bits.append(np.bitwise_or.reduce(packed, axis=1).view(np.int64))
                rows = low.reshape(BANDS, ROWS)
                keys.append(np.array([xxhash.xxh3_64_intdigest(bytes([b]) + rows[b].tobytes()) for b in range(BANDS)], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(set_keys, pa.binary()), pa.array(bits, schema.field(3).type), pa.array(keys, schema.field(4).type)],
                schema=schema,
            )

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, bits array<long>, keys array<long>")


def _estimate(a: Column, b: Column) -> Column:
    """Similarity estimated from the equal groups of bits, corrected for groups that are equal by chance."""
    ones = F.lit(int("01" * (64 // BITS), 2) if BITS == 2 else 0).cast("long")
    different = F.lit(0)
    for k in range(_HASHES * BITS // 64):
        x = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        different = different + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(ones))
    chance = 1.0 / (1 << BITS)
    return (1 - different / F.lit(float(_HASHES)) - chance) / (1 - chance)


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Those pairs (src, dst) whose full sets reach the threshold, in percent."""
    left = sets.select(F.col("rep").alias("src"), F.col("hashes").alias("a"))
    right = sets.select(F.col("rep").alias("dst"), F.col("hashes").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    met = pairs.join(left, "src").join(right, "dst").withColumn("both", both)
    return met.where(100 * F.col("both") >= threshold * (F.size("a") + F.size("b") - F.col("both"))).select("src", "dst")


def _across(located: DataFrame, bits: DataFrame, sets_of, least: float, threshold: int) -> DataFrame:
    """Links (src, dst) between components, among classes that keys connect.

    located: (rep, low, component), low being the pivot of one of rep's keys. A cluster of n classes
    makes ceil(n / BLOCK) blocks and a task for each pair of them; every class goes to as many tasks as
    there are blocks. Within a task, pairs come in order of their estimate, and pairs whose
    components have met there need no comparison.
    """
    clusters = connected_components(located.select(F.col("rep").alias("src"), F.col("low").alias("dst")))
    members = located.groupBy("rep").agg(F.first("component").alias("component")).join(clusters.withColumnRenamed("node", "rep").withColumnRenamed("component", "cluster"), "rep")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("n"), F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    members = members.join(sizes.select("cluster", blocks.alias("m")), "cluster").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("m")).cast("int"))
    full = members.join(bits, "rep").join(sets_of(members.select("rep", F.col("rep").alias("src"), F.col("rep").alias("dst"))), "rep")
    other = F.explode(F.sequence(F.lit(0), F.col("m") - 1))
    dealt = full.withColumn("other", other).select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "component", "bits", "hashes"
    )
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
        block, rep = rows["block"].to_numpy(), rows["rep"].to_numpy()
        component = rows["component"].to_numpy()
        packed = np.stack(rows["bits"].to_numpy(zero_copy_only=False)).view(np.uint64)
        hashes = rows["hashes"].combine_chunks()
        sizes = np.diff(hashes.offsets.to_numpy())
        sets: dict[int, set] = {}
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        def full_set(k: int) -> set:
            if k not in sets:
                sets[k] = set(hashes[k].values.to_numpy().tolist())
            return sets[k]

        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        pairs = []
        ones = np.uint64(int("01" * (64 // BITS), 2))
        chance = 1.0 / (1 << BITS)
        for k in a:
            x = packed[b] ^ packed[k]
            different = np.bitwise_count((x | (x >> np.uint64(1))) & ones).sum(axis=1)
            estimate = (1 - different / _HASHES - chance) / (1 - chance)
            near = (estimate >= least) & (component[b] != component[k]) & (100 * np.minimum(sizes[b], sizes[k]) >= threshold * np.maximum(sizes[b], sizes[k]))
            if i == j:
                near &= b > k
            at = np.flatnonzero(near)
            pairs.append(np.stack([estimate[at], np.full(len(at), k), b[at]], axis=1))
        found = []
        table = np.concatenate(pairs) if pairs else np.empty((0, 3))
        for _, x, y in table[np.argsort(-table[:, 0], kind="stable")]:
            x, y = int(x), int(y)
            p, q = find(int(component[x])), find(int(component[y]))
            if p != q:
                both = len(full_set(x) & full_set(y))
                if 100 * both >= threshold * (int(sizes[x]) + int(sizes[y]) - both):
                    root[p] = q
                    found.append((int(rep[x]), int(rep[y])))
        return pa.table([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], schema=schema)

    return dealt.groupBy("cluster", "i", "j").applyInArrow(run, "src long, dst long")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of documents (doc_id, text).

    Two rows are linked if 100 * intersection >= threshold * union of their shingle sets;
    component_id is the smallest doc_id that links reach, kept marks the row with that id. A text
    without words (null, empty, blank) has no shingles and is linked with nothing. Rows that
    repeat a doc_id are joined by it: every one gets the id's smallest component, and all are kept
    if they are that component's id. A null doc_id stays its own, unlinked and kept. An
    empty table gives an empty table; extra columns are not read.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "neardup")
    signed = scratch.save(_signatures(documents, shingle))
    usable = signed.where("set_key is not null and doc_id is not null")
    classes = scratch.save(
        usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.min_by(F.struct("bits", "keys"), "doc_id").alias("s"))
        .select("set_key", "rep", "s.bits", "s.keys")
    )

    bits = classes.select("rep", "bits")
    banded = classes.select("rep", F.explode("keys").alias("key"))
    pivot = F.min(F.struct(F.xxhash64("rep", "key"), "rep"))["rep"]
    shared = banded.groupBy("key").agg(pivot.alias("low"), F.count("*").alias("n")).where("n > 1")
    members = scratch.save(banded.join(shared.select("key", "low"), "key").select("key", "low", "rep"))
    stars = members.where("rep <> low").select("rep", "low").distinct()
    heads = bits.select(F.col("rep").alias("low"), F.col("bits").alias("low_bits"))
    least = threshold / 100 - SLACK
    pairs = stars.join(bits, "rep").join(heads, "low").where(_estimate(F.col("bits"), F.col("low_bits")) >= least)
    pairs = scratch.save(pairs.select(F.col("rep").alias("src"), F.col("low").alias("dst")))

    def sets_of(found: DataFrame) -> DataFrame:
        """Full sets of the classes that stand in found pairs, from their texts."""
        needed = found.select(F.explode(F.array("src", "dst")).alias("rep")).distinct().join(classes.select("rep", "set_key"), "rep")
        texts = documents.select(F.col("doc_id").cast("long").alias("rep"), "text").join(needed, "rep")
        schema = pa.schema([("rep", pa.int64()), ("hashes", pa.list_(pa.int64()))])

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                reps, rows = [], []
                for rep, text, key in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True):
                    hashes = shingle_hashes(text, shingle)
                    if xxhash.xxh3_128_digest(hashes.tobytes()) == key:  # an id may repeat with another text
                        reps.append(rep)
                        rows.append(hashes.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(rows, schema.field(1).type)], schema=schema)

        hashed = texts.select("rep", "text", "set_key").mapInArrow(run, "rep long, hashes array<long>")
        return hashed.dropDuplicates(["rep"])

    links = scratch.save(_confirmed(pairs, scratch.save(sets_of(pairs)), threshold))
    joined = connected_components(links)
    located = members.join(joined.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = located.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("n"))
    # A key of two classes is settled: its pair was a star.
    open_keys = located.join(mixed.where("c0 <> c1 and n > 2").select("key"), "key").select("rep", "low", "component")
    open_keys = scratch.save(open_keys.distinct())
    if not open_keys.isEmpty():
        more = scratch.save(_across(open_keys, bits, sets_of, least, threshold))
        joined = connected_components(links.unionAll(more))
    repeated = usable.groupBy("doc_id").agg(F.min("set_key").alias("x"), F.max("set_key").alias("y")).where("x <> y")
    if not repeated.isEmpty():  # an id with several texts ties their classes together
        tied = usable.join(repeated.select("doc_id"), "doc_id").join(classes.select("set_key", "rep"), "set_key")
        ties = tied.groupBy("doc_id").agg(F.min("rep").alias("low")).join(tied.select("doc_id", "rep"), "doc_id")
        joined = connected_components(
            joined.select(F.col("node").alias("src"), F.col("component").alias("dst")).unionAll(ties.select(F.col("rep").alias("src"), F.col("low").alias("dst")))
        )
    of_class = classes.select("set_key", "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    of_class = of_class.select("set_key", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "set_key").join(of_class, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id"))
    )


def drop_near_duplicates(documents: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """documents without the rows that near_duplicates() does not keep; one row remains of rows that repeat a kept id.

    Of such rows the first text remains. Rows without an id all remain.
    """
    gone = near_duplicates(documents, shingle, threshold).where(~F.col("kept")).select("doc_id").distinct()
    left = documents.join(gone, documents["doc_id"].cast("long") == gone["doc_id"], "left_anti")
    ids = documents.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("_rows"))
    repeated = ids.where("_rows > 1").select("_id")
    if repeated.isEmpty():
        return left
    met = left["doc_id"] == repeated["_id"]
    first = F.row_number().over(W.partitionBy("doc_id").orderBy("text"))
    one = left.join(repeated, met, "left_semi").withColumn("_place", first).where("_place = 1").drop("_place")
    return left.join(repeated, met, "left_anti").unionByName(one)
