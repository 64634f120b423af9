"""Language-model scoring by a hierarchical Pitman-Yor model.

Every word that training has, and the start of a text, is a context with a restaurant of its own; all
restaurants share one parent, whose dishes are the training words. The parent's base has no atoms: a word that
training lacks is one more event, which gets all the mass that is left for new words. No context, word or
pair of words is left out, however rare.

The seating is sampled by a blocked Gibbs sampler whose blocks are independent, so that Spark can draw them in parallel:

* the parent's masses given its customers (one for each table of the contexts): a Dirichlet draw with
  parameters customers - discount for each word and strength + discount * words for new ones;
* for each context an auxiliary x ~ Gamma(strength / discount + tables), which stands for the rising product
  of the strength in the restaurant's probability (as in Teh's sampler of the strength);
* given both, the pairs (context, word) are independent: c customers sit at t tables with probability in
  proportion to S(c, t) * (discount * x * mass of the word) ** t.

A sweep is one pass over the pairs that occur twice or more (one customer sits at one table) and gives back
sums of tables by context and by word. After burn-in, predictive probabilities are averaged over the sweeps.
Discounts come from the numbers of pairs (for the parent: of words) seen once and twice; strengths are STRENGTH.

Sizes: broadcast are the most frequent words (at most top_words, in both roles) and the most frequent pairs
of them (at most top_pairs). They only spare shuffles: all other words and pairs are tables, joined by
key, and being rarer than these none of them is hot. The draws do not depend on either bound.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import slices
from colloquy.llm.seating import gammas, mixed, tables, uniforms
from colloquy.session import Scratch

TOP_WORDS, TOP_PAIRS = 1 << 18, 1 << 19
BURN_IN, SAMPLES = 2, 3
SAMPLED = 4  # the most frequent words are told by one in so many documents
PARTS = 3  # documents are scored in so many parts, one after the other, so that fewer pairs lie on disk at a time
STRENGTH = 1.0
CACHED = 300_000
HELD = 3_000_000
END = b"\n"  # no word can hold it
ONCE, AGAIN, RARE_ONCE, RARE_AGAIN = range(4)  # kinds of pairs: seen once or more often; rare ones have a word that is not among the most frequent
SHIFT = 20
START = 0  # as a context; the most frequent words are numbered from 1, all others are negative hashes


def tokens(text: str | None) -> list[bytes]:
    """Words of a text after lower-casing A-Z, then the end token; a null text has that alone."""
    return [*(text or "").encode("utf-8", "replace").lower().split(), END]


def word_hash(word: bytes) -> int:
    """63 bits of a word's hash, as a negative number."""
    return (xxhash.xxh3_64_intdigest(word) | 1 << 63) - (1 << 64)


START_HASH = word_hash(b"\n\n")


def count_words(documents: DataFrame) -> DataFrame:
    """(h, c): every token's hash and count; counted within tasks first. Nothing but the choice of words to broadcast rests on it."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64())])

    def batch(counts: Counter) -> pa.RecordBatch:
        n = len(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.fromiter(map(word_hash, counts), np.int64, n)), pa.array(np.fromiter(counts.values(), np.int64, n))], schema=schema
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for part in slices(batches):
            for text in part.column(0).to_pylist():
                counts.update(tokens(text))
            if len(counts) > CACHED:
                yield batch(counts)
                counts.clear()
        if counts:
            yield batch(counts)

    return documents.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _most_frequent(counts: DataFrame, c: str, most: int) -> DataFrame:
    """The rows with the largest c: as many whole classes of equal c as have at most most rows together.

    The bound comes from the numbers of rows by c, so that nothing is sorted.
    """
    histogram = counts.groupBy(c).agg(F.count("*").alias("rows")).orderBy(F.desc(c)).limit(most + 1).toArrow()
    values, rows = histogram[c].to_numpy(), histogram["rows"].to_numpy()
    fits = int((np.cumsum(rows) <= most).sum())
    return counts.where(F.col(c) > (int(values[fits]) if fits < len(values) else 0))


class _Values(dict):
    """word -> its number, or its hash if it is not among the most frequent; worked out once a word."""

    def __init__(self, hashes: np.ndarray):
        super().__init__()
        self.numbers = {int(h): k + 1 for k, h in enumerate(hashes)}

    def __missing__(self, word: bytes) -> int:
        h = word_hash(word)
        value = self.numbers.get(h, h)
        if len(self) >= CACHED:
            self.clear()
        self[word] = value
        return value

    def pairs(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Contexts, words and the number of tokens of each text, one text after the other."""
        all_words = [tokens(x) for x in texts]
        sizes = np.fromiter(map(len, all_words), np.int64, len(all_words))
        w = np.fromiter(map(self.__getitem__, chain.from_iterable(all_words)), np.int64, int(sizes.sum()))
        u = np.empty_like(w)
        u[1:] = w[:-1]
        u[np.cumsum(sizes) - sizes] = START
        return u, w, sizes


def _alike(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows with equal keys: the place of one of them, and how many they are."""
    _, first, count = np.unique(mixed(*keys), return_index=True, return_counts=True)
    return first, count


def count_pairs(documents: DataFrame, top: np.ndarray) -> DataFrame:
    """(u, w, c, kind): customers of word w in the restaurant of context u; counted within tasks first."""
    schema = pa.schema([("u", pa.int64()), ("w", pa.int64()), ("c", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = _Values(top)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def batches_of(u: np.ndarray, w: np.ndarray, c: np.ndarray) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(u), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[k : k + 50_000]) for x in (u, w, c)], schema=schema)

        def flush() -> Iterator[pa.RecordBatch]:
            u, w = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            both = (u >= 0) & (w >= 0)
            keys, c = np.unique((u[both] << SHIFT) | w[both], return_counts=True)  # numbers of words are below 1 << SHIFT
            yield from batches_of(keys >> SHIFT, keys & ((1 << SHIFT) - 1), c)
            u, w = u[~both], w[~both]
            at, c = _alike(u, w)
            yield from batches_of(u[at], w[at], c)

        n = 0
        for part in slices(batches):
            u, w, _ = values.pairs(part.column(0).to_pylist())
            held.append((u, w))
            n += len(u)
            if n > HELD:
                yield from flush()
                n = 0
        if held:
            yield from flush()

    pairs = documents.select("text").mapInArrow(run, "u long, w long, c long")
    counted = pairs.groupBy("u", "w").agg(F.sum("c").alias("c"))
    rare, again = (F.col("u") < 0) | (F.col("w") < 0), F.col("c") > 1
    return counted.withColumn("kind", F.when(rare, RARE_ONCE).otherwise(ONCE) + again.cast("int"))


@dataclass
class PitmanYorModel:
    """Everything learnt. Arrays have a row for each kept sweep and a column for each of the most frequent words (0: start).

    x, mass: the draws that a sweep was seated with; t, n: the tables of each context and the parent's customers of each
    word that it gave; totals: all customers of the parent. pair_*: the most frequent pairs and what
    they add to the score of unseen and of seen texts (see _gains). contexts and words hold the same for the rest, pairs all pairs.
    """

    pairs: DataFrame = field(repr=False)
    contexts: DataFrame = field(repr=False)
    words: DataFrame = field(repr=False)
    tokens: int
    vocabulary: int
    discount: float
    parent_discount: float
    top: np.ndarray
    top_c: np.ndarray
    customers: np.ndarray
    x: np.ndarray
    t: np.ndarray
    mass: np.ndarray
    n: np.ndarray
    totals: np.ndarray
    pair_keys: np.ndarray
    pair_gains: np.ndarray
    least_top: int

    def of(self, kind: int) -> DataFrame:
        return self.pairs.where(F.col("kind") == kind)

    def base_log(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.tokens + 0.1 * (self.vocabulary + 1)))

    def parent(self, n: np.ndarray) -> np.ndarray:
        """The parent's probability of words, a row a sweep; n = 0 is a word that training lacks."""
        fresh = STRENGTH + self.parent_discount * self.vocabulary
        return np.where(n > 0, n.astype(np.float64) - self.parent_discount, fresh) / (STRENGTH + self.totals[:, None])

    def probability(self, c, seats, customers, t, parent) -> np.ndarray:
        """Averaged over the sweeps: c customers of the word at seats tables in a restaurant of so many customers at t tables."""
        own = np.maximum(c - self.discount * seats, 0)
        return ((own + (STRENGTH + self.discount * t) * parent) / (STRENGTH + customers)).mean(axis=0)

    def seats(self, c, hashes, x, mass) -> np.ndarray:
        """The kept sweeps' tables of pairs, drawn again as they were."""
        return np.stack([
            tables(c, self.discount * np.asarray(x[k], float) * np.asarray(mass[k], float), uniforms(hashes, BURN_IN + k), self.discount) for k in range(SAMPLES)
        ])

    def context_hashes(self) -> np.ndarray:
        return np.concatenate([[START_HASH], self.top]).astype(np.int64)


def _discount(once: int | None, twice: int | None) -> float:
    """The discount that leaves the expected number of dishes seen once and twice as they are."""
    once, twice = once or 0, twice or 0
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def _drawn(shape: Column, key: str, stream: int) -> Column:
    """Gamma draws for the rows of a table, by their key."""

    def draw(shape: pa.Array, key: pa.Array) -> pa.Array:
        return pa.array(gammas(shape.to_numpy(), key.to_numpy(), stream))

    return F.arrow_udf(draw, "double")(shape, F.col(key))


def _twice(c: str, value: int) -> Column:
    return F.sum((F.col(c) == value).cast("long"))


def _named(name: str) -> list[str]:
    return [f"{name}{k}" for k in range(SAMPLES)]


def train_lm(documents: DataFrame, train: Column, top_words: int = TOP_WORDS, top_pairs: int = TOP_PAIRS) -> PitmanYorModel:
    """Learn from all rows of documents (doc_id, text) that satisfy train; a null text counts as empty.

    Repeated rows count as often as they are. Without training rows every token is a word that training lacks, of probability 1.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "lm")
    learnt = documents.where(train)
    counts = scratch.save(count_words(learnt.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLED)) == 0)))
    frequent = _most_frequent(counts, "c", top_words).toArrow()
    h, c = frequent["h"].to_numpy(), frequent["c"].to_numpy()
    top = h[np.lexsort((h, -c))]
    pairs = scratch.save(count_pairs(learnt, top), "kind", "zstd")
    scratch.drop(counts)
    scratch.release()
    again = (F.col("c") > 1).cast("long")
    sides = [F.sum("c").alias("c"), F.count("*").alias("kinds"), F.sum(again).alias("again")]
    by_context = scratch.save(pairs.groupBy("u").agg(*sides), None, "zstd")
    by_word = scratch.save(pairs.groupBy("w").agg(*sides), None, "zstd")
    n, v = by_word.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    d = _discount(*pairs.agg(_twice("c", 1), _twice("c", 2)).first())
    d0 = _discount(*by_word.agg(_twice("kinds", 1), _twice("kinds", 2)).first())

    # The most frequent words, as arrays; place 0 is the start of a text.
    size = len(top) + 1
    dense = {}
    for side, table in (("u", by_context), ("w", by_word)):
        rows = table.where(F.col(side) >= 0).toArrow()  # at most top_words + 1
        for name in ("c", "kinds", "again"):
            dense[side, name] = np.zeros(size)
            dense[side, name][rows[side].to_numpy()] = rows[name].to_numpy()
    hashes = np.concatenate([[START_HASH], top]).astype(np.int64)
    t_u, n_w = dense["u", "kinds"], dense["w", "kinds"]
    sat_u, sat_w = dense["u", "again"] > 0, dense["w", "again"] > 0

    # The rest, as tables; those without a repeated pair never change.
    rest_u = scratch.save(by_context.where("u < 0 and again > 0").select("u", (F.col("kinds") - F.col("again")).alias("once")))
    rest_w = scratch.save(by_word.where("w < 0 and again > 0").select("w", (F.col("kinds") - F.col("again")).alias("once")))
    state_u = rest_u.join(by_context.select("u", F.col("kinds").cast("double").alias("t")), "u")
    state_w = rest_w.join(by_word.select("w", F.col("kinds").cast("double").alias("n")), "w")
    settled = by_word.where("again = 0").agg(F.coalesce(F.sum(F.col("kinds") - d0), F.lit(0.0))).first()[0]
    settled_n = by_word.where("again = 0").agg(F.coalesce(F.sum("kinds"), F.lit(0))).first()[0]
    kept: list[dict] = []
    passing = [by_context, by_word, rest_u, rest_w]
    for sweep in range(BURN_IN + SAMPLES):
        x = gammas(STRENGTH / d + t_u, hashes, 3 * sweep).astype(np.float32)
        mass = np.where(sat_w, gammas(np.where(sat_w, n_w - d0, 1.0), hashes, 3 * sweep + 1), 0.0)
        state_u = scratch.save(state_u.withColumn("x", _drawn(F.lit(STRENGTH / d) + F.col("t"), "u", 3 * sweep)))
        state_w = scratch.save(state_w.withColumn("mass", _drawn(F.col("n") - d0, "w", 3 * sweep + 1)))
        lump = gammas(np.array([max(settled, 1e-9), STRENGTH + d0 * v]), np.array([1, 2]), 3 * sweep + 2)
        total = mass.sum() + (state_w.agg(F.sum("mass")).first()[0] or 0.0) + (lump[0] if settled > 0 else 0.0) + lump[1]
        mass = (mass / total).astype(np.float32)
        shared = spark.sparkContext.broadcast(pickle.dumps((hashes, x, mass)))
        sums = scratch.save(_sweep(pairs, state_u, state_w, shared, d, total, sweep))
        shared.destroy()
        passing += [state_u, state_w, sums]
        rows = sums.where("key >= 0").toArrow()
        side, key, t = rows["side"].to_numpy(), rows["key"].to_numpy(), rows["t"].to_numpy()
        t_u, n_w = dense["u", "kinds"] - dense["u", "again"], dense["w", "kinds"] - dense["w", "again"]
        t_u[key[side == 0]] += t[side == 0]
        n_w[key[side == 1]] += t[side == 1]
        of = {s: sums.where(f"side = {s} and key < 0") for s in (0, 1)}
        after_u = rest_u.join(of[0].select(F.col("key").alias("u"), "t"), "u").select("u", "once", (F.col("once") + F.col("t")).alias("t"))
        after_w = rest_w.join(of[1].select(F.col("key").alias("w"), "t"), "w").select("w", "once", (F.col("once") + F.col("t")).alias("n"))
        if sweep >= BURN_IN:
            seated = n_w[sat_w].sum() + (after_w.agg(F.sum("n")).first()[0] or 0.0)
            kept.append({"x": x, "mass": mass, "t": t_u, "n": n_w, "total": seated + settled_n,
                         "u": state_u.select("u", "x").join(after_u, "u"), "w": state_w.select("w", F.col("mass") / total).toDF("w", "mass").join(after_w, "w")})
        state_u, state_w = after_u, after_w
        scratch.release()

    contexts, words = by_context.where("u < 0"), by_word.where("w < 0")
    for k, s in enumerate(kept):
        contexts = contexts.join(s["u"].select("u", F.col("t").alias(f"t{k}"), F.col("x").alias(f"x{k}")), "u", "left")
        words = words.join(s["w"].select("w", F.col("n").alias(f"n{k}"), F.col("mass").alias(f"mass{k}")), "w", "left")
    own = F.col("kinds").cast("double")
    contexts = contexts.select("u", F.col("c").alias("customers"), *[F.coalesce(x, own).alias(x) for x in _named("t")], *_named("x"))
    words = words.select("w", F.col("c").alias("cw"), *[F.coalesce(x, own).alias(x) for x in _named("n")], *_named("mass"))
    stack = {name: np.stack([s[name] for s in kept]).astype(np.float32) for name in ("x", "mass", "t", "n")}
    model = PitmanYorModel(
        pairs, scratch.save(contexts, None, "zstd"), scratch.save(words, None, "zstd"), n, v, d, d0, top, dense["w", "c"][1:], dense["u", "c"],
        **stack, totals=np.array([s["total"] for s in kept]), pair_keys=np.empty(0, np.int64), pair_gains=np.empty((2, 0), np.float32), least_top=0,
    )
    rows = _most_frequent(model.of(AGAIN), "c", top_pairs).toArrow()
    del state_u, state_w, after_u, after_w, kept, contexts, words, of
    scratch.drop(*passing)
    scratch.release()
    model.least_top = 1 << 62
    if rows.num_rows:
        u, w, c = (rows[x].to_numpy() for x in ("u", "w", "c"))
        keys = (u << SHIFT) | w
        order = np.argsort(keys)
        model.pair_keys, model.pair_gains, model.least_top = keys[order], _gains(model, u[order], w[order], c[order]), int(c.min())
    return model


def _sweep(pairs: DataFrame, state_u: DataFrame, state_w: DataFrame, shared, d: float, total: float, sweep: int) -> DataFrame:
    """(side, key, t): summed tables of each context (side 0) and of each word (side 1) after one sweep; shared: hashes, x and mass of frequent words."""
    schema = pa.schema([("side", pa.int32()), ("key", pa.int64()), ("t", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, x, mass = pickle.loads(shared.value)
        sums = np.zeros((2, len(hashes)))
        for b in batches:
            if not b.num_rows:
                continue
            u, w, c = (b.column(k).to_numpy() for k in range(3))
            keys = mixed(np.where(u < 0, u, hashes[np.maximum(u, 0)]), np.where(w < 0, w, hashes[np.maximum(w, 0)]))
            of_u, of_w = x[np.maximum(u, 0)].astype(float), mass[np.maximum(w, 0)].astype(float)
            if b.num_columns > 3:
                rare_x, rare_mass = (b.column(k).to_numpy(zero_copy_only=False) for k in (3, 4))
                of_u, of_w = np.where(u < 0, rare_x, of_u), np.where(w < 0, rare_mass / total, of_w)
            t = tables(c, d * of_u * of_w, uniforms(keys, sweep), d)
            for side, own in enumerate((u, w)):
                known = own >= 0
                np.add.at(sums[side], own[known], t[known])
                if not known.all():
                    rare, at = np.unique(own[~known], return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rare), side, np.int32)), pa.array(rare), pa.array(np.bincount(at, weights=t[~known]))], schema=schema
                    )
        for side in (0, 1):
            key = np.flatnonzero(sums[side])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), side, np.int32)), pa.array(key), pa.array(sums[side][key])], schema=schema)

    ddl = "side int, key long, t double"
    known = pairs.where(F.col("kind") == AGAIN).select("u", "w", "c").mapInArrow(run, ddl)
    others = _with_both(pairs.where(F.col("kind") == RARE_AGAIN), state_u.select("u", "x"), state_w.select("w", "mass"))
    return known.unionAll(others.select("u", "w", "c", "x", "mass").mapInArrow(run, ddl)).groupBy("side", "key").agg(F.sum("t").alias("t"))


def _with_both(pairs: DataFrame, contexts: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs with a word that is not among the most frequent, with its row of contexts or words; what is frequent is not shuffled by."""
    rare_u, rare_w = F.col("u") < 0, F.col("w") < 0
    return (
        pairs.where(rare_u & ~rare_w).join(contexts, "u")
        .unionByName(pairs.where(~rare_u & rare_w).join(words, "w"), allowMissingColumns=True)
        .unionByName(pairs.where(rare_u & rare_w).join(words, "w").join(contexts, "u"), allowMissingColumns=True)
    )


def _gains(m: PitmanYorModel, u: np.ndarray, w: np.ndarray, c: np.ndarray) -> np.ndarray:
    """log10 of what pairs of frequent words, of c customers, have over pairs of none (first row) and over pairs of one (second)."""
    hashes = m.context_hashes()
    parent, out = m.parent(m.n), np.empty((2, len(u)), np.float32)
    for k in range(0, len(u), 100_000):
        at = slice(k, k + 100_000)
        a, b = u[at], w[at]
        room = (m.customers[a], m.t[:, a], parent[:, b])
        seats = m.seats(c[at], mixed(hashes[a], hashes[b]), m.x[:, a], m.mass[:, b])
        own = np.log10(m.probability(c[at], seats, *room))
        out[0, at], out[1, at] = own - np.log10(m.probability(0, 0, *room)), own - np.log10(m.probability(1, 1, *room))
    return out


def _shared(model: PitmanYorModel, *without: str):
    """The model's arrays but those of some names, for all tasks; a few tens of MB at any size of the corpus."""
    light = {k: None if k in (*without, "pairs", "contexts", "words") else v for k, v in model.__dict__.items()}
    return model.pairs.sparkSession.sparkContext.broadcast(pickle.dumps(light))


def _loaded(shared) -> PitmanYorModel:
    return PitmanYorModel(**pickle.loads(shared.value))


def _rare(b: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([b.column(b.schema.get_field_index(x)).to_numpy(zero_copy_only=False).astype(np.float64) for x in names])


def _priced(model: PitmanYorModel, shared) -> DataFrame:
    """(k, gain0, gain1, cw): what pairs add to the score of unseen and of seen texts, by key; cw: the count of a word that is not frequent.

    Those are: pairs of frequent words that occur again but are not among the most frequent, with their gains (see
    _gains), and all rare pairs, with the logarithm of their probability.
    """
    schema = pa.schema([("k", pa.int64()), ("gain0", pa.float32()), ("gain1", pa.float32()), ("cw", pa.int64())])

    def frequent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _loaded(shared)
        for b in batches:
            u, w, c = (b.column(k).to_numpy() for k in range(3))
            if len(u):
                gain = _gains(m, u, w, c)
                yield pa.RecordBatch.from_arrays([pa.array((u << SHIFT) | w), pa.array(gain[0]), pa.array(gain[1]), pa.nulls(len(u), pa.int64())], schema=schema)

    def others(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _loaded(shared)
        hashes, parent = m.context_hashes(), m.parent(m.n)
        for b in batches:
            if not b.num_rows:
                continue
            u, w, c = (b.column(b.schema.get_field_index(x)).to_numpy() for x in ("u", "w", "c"))
            fu, fw = np.maximum(u, 0), np.maximum(w, 0)
            with np.errstate(invalid="ignore"):
                customers = np.where(u < 0, _rare(b, ["customers"])[0], m.customers[fu])
                t = np.where(u < 0, _rare(b, _named("t")), m.t[:, fu])
                x = np.where(u < 0, _rare(b, _named("x")), m.x[:, fu])
                n, mass = _rare(b, _named("n")), np.where(w < 0, _rare(b, _named("mass")), m.mass[:, fw])
                of_w = np.where(w < 0, m.parent(n), parent[:, fw])
            keys = mixed(np.where(u < 0, u, hashes[fu]), np.where(w < 0, w, hashes[fw]))
            seats = m.seats(c, keys, np.where(c > 1, x, 1.0), np.where(c > 1, mass, 1.0))
            gain = np.log10(m.probability(c, seats, customers, t, of_w)).astype(np.float32)
            cw = b.column(b.schema.get_field_index("cw"))
            yield pa.RecordBatch.from_arrays([pa.array(mixed(u, w) | np.int64(-1 << 63)), pa.array(gain), pa.array(gain), cw], schema=schema)

    ddl = "k long, gain0 float, gain1 float, cw long"
    first = model.of(AGAIN).where(F.col("c") < model.least_top).select("u", "w", "c").mapInArrow(frequent, ddl)
    rest = _with_both(model.pairs.where(F.col("kind") >= RARE_ONCE), model.contexts, model.words)
    columns = ["u", "w", "c", "customers", *_named("t"), *_named("x"), "cw", *_named("n"), *_named("mass")]
    return first.unionAll(rest.select(*columns).mapInArrow(others, ddl))


def score_lm(documents: DataFrame, model: PitmanYorModel, seen: Column | None = None) -> DataFrame:
    """doc_id with n_tokens, n_known, train_tokens, base_score and score of every row.

    seen: a condition that holds only for rows that the model learnt from; as their pairs all occur in training, those
    that occur once need not be looked up. Scores are the same without it.
    Repeated rows are kept and score alike; a null doc_id stays null; a null text is the end token
    alone; an empty table gives an empty table; other columns are not read. Perplexity is 10 ** (-score / n_tokens).
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "lm-score")
    shared = _shared(model, "x", "mass")
    # A row for each text (ids: doc_id, tokens and known ones; sums: base and score), and one for each different pair of it that is not
    # among the most frequent (ids: its words, if it may be open; m: how often it stands, twice, and one more in seen texts). Until pairs are
    # looked up, a pair of frequent words counts as one that training has once (in seen texts) or lacks (in others), and a rare one not at all.
    # All pairs travel, so the rows are kept narrow.
    schema = pa.schema([("row", pa.int64()), ("k", pa.int64()), ("m", pa.int32()), ("ids", pa.list_(pa.int64())), ("sums", pa.list_(pa.float64()))])

    def listed(*columns: pa.Array) -> pa.Array:
        """Lists of the columns' values, row by row."""
        n = len(columns[0])
        order = np.arange(n * len(columns)).reshape(len(columns), n).T.reshape(-1)
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(columns)), pa.concat_arrays(columns).take(pa.array(order)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _loaded(shared)
        values, base = _Values(m.top), np.concatenate([[0.0], m.base_log(m.top_c)])
        room, parent = (STRENGTH + m.discount * m.t) / (STRENGTH + m.customers), m.parent(m.n)
        single = (1 - m.discount) / (STRENGTH + m.customers)
        row = None
        for part in slices(batches):
            if row is None:
                row = (TaskContext.get().partitionId() * PARTS + part.column(3)[0].as_py()) << 36
            u, w, sizes = values.pairs(part.column(1).to_pylist())
            trained = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            both = (u >= 0) & (w >= 0)
            place, times = np.unique((doc[both] << 2 * SHIFT) | (u[both] << SHIFT) | w[both], return_counts=True)  # a slice has few texts
            own, keys = place >> 2 * SHIFT, place & ((1 << 2 * SHIFT) - 1)
            fu, fw = keys >> SHIFT, keys & ((1 << SHIFT) - 1)
            chance = (room[:, fu] * parent[:, fw]).mean(axis=0) + np.where(trained[own], single[fu], 0.0)
            score = np.bincount(own, times * np.log10(chance), len(sizes)).astype(float)
            there = np.zeros(len(keys), bool)
            if len(m.pair_keys):
                at = np.minimum(np.searchsorted(m.pair_keys, keys), len(m.pair_keys) - 1)
                there = m.pair_keys[at] == keys
                score += np.bincount(own[there], times[there] * m.pair_gains[trained[own[there]].astype(int), at[there]], len(sizes))
            known = w > 0
            rows = row + np.arange(len(sizes))
            ids = listed(part.column(0), pa.array(sizes), pa.array(np.bincount(doc[known], minlength=len(sizes))))
            sums = listed(pa.array(np.bincount(doc[known], base[w[known]], len(sizes)).astype(float)), pa.array(score))
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(rows), pa.array(trained.astype(np.int32)), ids, sums], schema=schema)
            k = mixed(u[~both], w[~both]) | np.int64(-1 << 63)
            first, often = _alike(k, doc[~both])
            asks = [(own[~there], keys[~there], times[~there], fu[~there], fw[~there], trained[own[~there]]),
                    (doc[~both][first], k[first], often, u[~both][first], w[~both][first], np.zeros(len(first), bool))]
            of, k, m2, u, w, settled = (np.concatenate(x) for x in zip(*asks, strict=True))
            m2 = (m2 * 2 + trained[of]).astype(np.int32)
            for s in range(0, len(of), 50_000):
                x = slice(s, s + 50_000)
                open_ = ~settled[x]
                ends = np.append(0, np.cumsum(2 * open_)).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.stack([u[x][open_], w[x][open_]], axis=1).reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[of[x]]), pa.array(k[x]), pa.array(m2[x]), ids, pa.nulls(len(open_), schema.field(4).type)], schema=schema
                )
            row += len(sizes)

    known = F.lit(False) if seen is None else F.coalesce(seen, F.lit(False))
    part_of = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int")
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", known.alias("seen"), part_of.alias("part"))
    draws = _shared(model, "pair_keys", "pair_gains")
    prices = scratch.save(_priced(model, draws), None, "zstd")
    draws.destroy()
    scratch.release()
    gain = F.when(F.col("m") % 2 == 1, F.col("gain1")).otherwise(F.col("gain0"))
    m, smooth = F.col("m"), model.tokens + 0.1 * (model.vocabulary + 1)
    text, lacks, zero = F.col("sums").isNotNull(), F.col("gain").isNull() & F.col("sums").isNull(), F.lit(0.0)
    of_text = lambda at: F.when(text, F.get("ids", F.lit(at)))
    sums = [F.sum(x).alias(x) for x in ("m", "n_known", "base", "score")]
    parts = []
    for part in range(PARTS):
        asked = source.where(F.col("part") == part).mapInArrow(run, "row long, k long, m int, ids array<long>, sums array<double>")
        met = asked.join(prices, "k", "left").withColumn("gain", gain).withColumn("m", F.floor(F.col("m") / 2).cast("long"))
        found = met.select(
            "row", *[F.when(lacks, F.get("ids", F.lit(k))).alias(x) for k, x in enumerate("uw")], "m", of_text(0).alias("doc_id"), of_text(1).alias("n_tokens"),
            F.coalesce(of_text(2), F.when(F.col("cw").isNotNull(), m), F.lit(0)).alias("n_known"),
            F.coalesce(F.get("sums", F.lit(0)), m * F.log10((F.col("cw") + 0.1) / F.lit(smooth)), zero).alias("base"),
            F.coalesce(F.get("sums", F.lit(1)), m * F.col("gain"), zero).alias("score"),
        )
        whole = found.groupBy("row", "u", "w").agg(F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), *sums)
        parts.append(scratch.save(whole, None, "zstd"))
        del asked, met, found, whole
        scratch.release()  # the part's pairs
    scratch.drop(prices)
    whole = reduce(DataFrame.unionAll, parts)

    # Pairs of unseen texts that are neither priced nor among the most frequent: training has them once, or lacks them.
    lacking = whole.where("u is not null").select("row", "u", "w", "m")
    once = lacking.where("u >= 0 and w >= 0").join(model.of(ONCE).select("u", "w"), ["u", "w"])
    # Rare ones it lacks; keys that cannot match are spread by row.
    spread = lambda x: F.when(F.col(x) < 0, F.col(x)).otherwise(F.col("row"))
    rare = lacking.where("u < 0 or w < 0").withColumn("ku", spread("u")).withColumn("kw", spread("w"))
    rare = rare.join(model.contexts.withColumnRenamed("u", "ku"), "ku", "left").join(model.words.withColumnRenamed("w", "kw"), "kw", "left")
    out = pa.schema([("row", pa.int64()), ("k2", pa.int64()), ("b2", pa.float64()), ("s2", pa.float64())])

    def price_once(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _loaded(shared)
        parent = m.parent(m.n)
        for b in batches:
            row, u, w, times = (b.column(k).to_numpy() for k in range(4))
            if len(row):
                room = (m.customers[u], m.t[:, u], parent[:, w])
                gain = times * (np.log10(m.probability(1, 1, *room)) - np.log10(m.probability(0, 0, *room)))
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(np.zeros(len(row), np.int64)), pa.array(np.zeros(len(row))), pa.array(gain)], schema=out)

    def price_rare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _loaded(shared)
        parent = m.parent(m.n)
        for b in batches:
            if not b.num_rows:
                continue
            row, u, w, times = (b.column(k).to_numpy() for k in range(4))
            fu, fw = np.maximum(u, 0), np.maximum(w, 0)
            customers, cw, t, n = _rare(b, ["customers"])[0], _rare(b, ["cw"])[0], _rare(b, _named("t")), _rare(b, _named("n"))
            customers = np.where(u < 0, np.nan_to_num(customers), m.customers[fu])
            t = np.where(u < 0, np.nan_to_num(t), m.t[:, fu])
            of_w = np.where(w < 0, m.parent(np.nan_to_num(n)), parent[:, fw])
            score = np.where(customers > 0, np.log10(m.probability(0, 0, customers, t, of_w)), np.log10(of_w.mean(axis=0)))
            has = (w < 0) & ~np.isnan(cw)
            base = np.where(w < 0, m.base_log(np.nan_to_num(cw)), 0.0)
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(np.where(has, times, 0).astype(np.int64)), pa.array(times * base), pa.array(times * score)], schema=out)

    ddl = "row long, k2 long, b2 double, s2 double"
    priced = once.select("row", "u", "w", "m").mapInArrow(price_once, ddl).unionAll(
        rare.select("row", "u", "w", "m", "customers", *_named("t"), "cw", *_named("n")).mapInArrow(price_rare, ddl)
    )
    added = priced.groupBy("row").agg(*[F.sum(x).alias(x) for x in ("k2", "b2", "s2")])
    both = whole.where("u is null").join(added, "row", "left")
    return both.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("k2", F.lit(0))).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b2", zero)).alias("base_score"), (F.col("score") + F.coalesce("s2", zero)).alias("score"),
    )
