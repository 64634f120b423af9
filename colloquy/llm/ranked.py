"""Ranked lexical search by presence masks.

``index_postings`` cuts the documents into shards of bounded size where they lie and writes, for each shard, one row a term
with the documents that hold it. ``rank_documents`` brings a shard's postings together with a block of items. For an
item, bits are set in a mask of each document for the terms that it holds; documents with equal masks form a group,
whose score is at most the sum of the masked terms' highest contributions in the shard. Groups are scored from the highest
bound down, until the bound of the next is below the item's k-th score; a task keeps those scores from shard to shard. Tasks' best
are merged exactly, since weights and lengths are relative to all documents. All arithmetic but the weights' logarithm is in whole numbers.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.llm.common import slices
from colloquy.session import Scratch

#: A shard's documents and terms; a longer document is a shard of its own.
SHARD_DOCS = 2048
SHARD_TERMS = 2_000_000
#: Terms of items that a block of items has, about.
BLOCK_TERMS = 50_000
#: Bits of the table of asked terms' hashes that tasks get: 128 KB for any number of items.
BUCKETS = 1 << 20
_REMEMBERED = 300_000

#: Letters, digits and all that is not ASCII stay, A-Z lower-cased; the rest parts terms.
_TERMS = bytes(ord(chr(c).lower()) if c < 128 and chr(c).isalnum() else c if c >= 128 else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8."""
    return (text or b"").translate(_TERMS).split()


@dataclass
class Postings:
    """rows: (shard, term, df, docs, tfs, ids, lengths, n_docs, n_terms); a row with a null term tells of the shard itself.

    docs are places in the shard, in order of ids; n is the number of documents with a term, length all their terms.
    """

    rows: DataFrame
    n: int
    length: int


_ROWS = pa.schema([
    ("shard", pa.int64()), ("term", pa.binary()), ("df", pa.int64()), ("docs", pa.binary()), ("tfs", pa.binary()), ("ids", pa.list_(pa.int64())), ("lengths", pa.binary()),
    ("n_docs", pa.int64()), ("n_terms", pa.int64()),
])
_ROWS_DDL = "shard long, term binary, df long, docs binary, tfs binary, ids array<long>, lengths binary, n_docs long, n_terms long"


def _shard_rows(shard: int, ids: list[int | None], counts: list[tuple[int, dict[bytes, int]]]) -> Iterator[pa.RecordBatch]:
    order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0))
    lengths = np.array([counts[k][0] for k in order], np.int64)
    docs: dict[bytes, list[int]] = {}
    tfs: dict[bytes, list[int]] = {}
    for place, k in enumerate(order):
        for term, tf in counts[k][1].items():
            docs.setdefault(term, []).append(place)
            tfs.setdefault(term, []).append(tf)
    rows = [(shard, None, None, None, None, [ids[k] for k in order], lengths.tobytes(), int((lengths > 0).sum()), int(lengths.sum()))]
    for term, places in docs.items():
        rows.append((shard, term, len(places), np.array(places, np.uint16).tobytes(), np.array(tfs[term], np.uint32).tobytes(), None, None, None, None))
    for a in range(0, len(rows), 5000):
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows[a : a + 5000], strict=True), _ROWS, strict=True)], schema=_ROWS)


def asked_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times): the terms of items (item_id, text) with their repeats; rows of one id are one item, null is an id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            for item, text in zip(part.column(0), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if found := Counter(terms(text)):
                    yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(found), part.column(0).type), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["item_id", "term", "n"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, term binary, n long").groupBy("item_id", "term").agg(F.sum("n").alias("times"))


def index_postings(documents: DataFrame, asked: DataFrame | None = None, shard_docs: int = SHARD_DOCS, shard_terms: int = SHARD_TERMS) -> Postings:
    """Postings of documents (doc_id, text); every row is a document, also one whose id is null or repeated.

    asked (a term column) limits the index to terms whose hash some asked term has: what tasks are sent is a bit table
    of fixed size, and terms that are in it by chance are never met by an item. Shards are cut from the partitions as they are read;
    no text is shuffled. Null and wordless texts have no terms and do not count.
    """
    wanted = None
    if asked is not None:
        bits = np.zeros(BUCKETS, bool)
        bits[[r[0] for r in asked.select((F.crc32("term") % BUCKETS).alias("b")).distinct().collect()]] = True  # at most BUCKETS small numbers
        wanted = documents.sparkSession.sparkContext.broadcast(np.packbits(bits).tobytes())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(np.frombuffer(wanted.value, np.uint8)).tobytes() if wanted else None
        known: dict[bytes, int] = {}
        shard, held = TaskContext.get().partitionId() << 32, 0
        ids: list[int | None] = []
        counts: list[tuple[int, dict[bytes, int]]] = []
        for part in slices(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = terms(text)
                if ids and (len(ids) == shard_docs or held + len(words) > shard_terms):
                    yield from _shard_rows(shard, ids, counts)
                    shard, held, ids, counts = shard + 1, 0, [], []
                found = Counter(words)
                if table:
                    kept = {}
                    for term, tf in found.items():
                        is_known = known.get(term)
                        if is_known is None:
                            if len(known) >= _REMEMBERED:
                                known.clear()
                            is_known = known[term] = table[zlib.crc32(term) % BUCKETS]
                        if is_known:
                            kept[term] = tf
                    found = kept
                ids.append(doc_id)
                counts.append((len(words), found))
                held += len(words)
        if ids:
            yield from _shard_rows(shard, ids, counts)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ROWS_DDL)
    rows = Scratch(documents.sparkSession, "postings").save(rows)
    n, length = rows.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    return Postings(rows, n or 0, length or 0)


class _Shard:
    """The postings of a shard that a block of items asks for."""

    def __init__(self, ids: list[int | None], lengths: bytes, n: int, length: int):
        self.ids, self.m = ids, 25 + 75 * np.frombuffer(lengths, np.int64) * n // max(length, 1)
        self.docs: list[np.ndarray] = []
        self.parts: list[np.ndarray] = []
        self.tops: list[int] = []
        self.items: dict[str | None, list[tuple[int, int]]] = {}

    def add(self, weight: int, docs: bytes, tfs: bytes, items: list[dict]) -> None:
        places, tf = np.frombuffer(docs, np.uint16).astype(np.int64), np.frombuffer(tfs, np.uint32).astype(np.int64)
        part = weight * (1_000_000_000 * tf // (1000 * tf + 8 * self.m[places]))
        for x in items:
            self.items.setdefault(x["item_id"], []).append((len(self.docs), x["times"]))
        self.docs.append(places)
        self.parts.append(part)
        self.tops.append(int(part.max()))

    def search(self, item: str | None, best: list[tuple], k: int) -> list[tuple]:
        """The k best of best and this shard's documents: (-score, id is null, id), in order."""
        asked = self.items[item]
        tops = [times * self.tops[t] for t, times in asked]
        if len(best) == k and sum(tops) < -best[-1][0]:
            return best
        words = np.zeros((len(self.ids), -(-len(asked) // 64)), np.uint64)
        for j, (t, _) in enumerate(asked):
            words[self.docs[t], j // 64] |= np.uint64(1 << j % 64)
        held = np.flatnonzero(words.any(axis=1))
        masks, group = np.unique(words[held], axis=0, return_inverse=True) if words.shape[1] > 1 else np.unique(words[held, 0], return_inverse=True)
        masks = masks.reshape(len(masks), -1)
        bounds = np.zeros(len(masks), np.int64)
        for j, top in enumerate(tops):
            bounds += ((masks[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64) * top
        first = np.argsort(-bounds, kind="stable")
        place = np.empty(len(first), np.int64)
        place[first] = np.arange(len(first))  # a mask's turn
        turn = place[group.reshape(-1)]
        by_turn = np.argsort(turn, kind="stable")
        ends = np.searchsorted(turn[by_turn], np.arange(len(first)), side="right")
        done, size = 0, k
        while done < len(first):
            least = -best[-1][0] if len(best) == k else 1
            if bounds[first[done]] < least:
                break
            # The next masks, as many as hold about size documents and may still reach the k-th score.
            a = ends[done - 1] if done else 0
            stop = max(done + 1, int(np.searchsorted(ends, a + size, side="right")))
            stop = done + int(np.searchsorted(-bounds[first[done:stop]], -least, side="right"))
            docs = held[by_turn[a : ends[stop - 1]]]
            best = self._scored(asked, docs, best, k)
            done, size = stop, size * 4
        return best

    def _scored(self, asked: list[tuple[int, int]], docs: np.ndarray, best: list[tuple], k: int) -> list[tuple]:
        scores = np.full(len(self.ids), -1, np.int64)
        scores[docs] = 0
        for t, times in asked:
            places = self.docs[t]
            chosen = scores[places] >= 0
            scores[places[chosen]] += times * self.parts[t][chosen]
        docs = np.sort(docs)
        docs = docs[np.argsort(-scores[docs], kind="stable")[:k]]  # places are in order of ids
        new = [(-int(scores[d]), self.ids[d] is None, self.ids[d] or 0) for d in docs if scores[d] > 0]
        return sorted(best + new)[:k]


def rank_documents(postings: Postings, asked: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item of asked (item_id, term, times), all if fewer.

    A term's weight is floor(1000 ln((2 n + 2) / (2 df + 1))); a document's score sums, over the item's terms with repeats, weight times
    (10**9 tf) div (1000 tf + 8 m), where m is 25 + (75 length n) div (all terms). Only scores above 0 rank; equal ones
    by ascending doc_id, null last. An item without terms or without documents has no rows.
    """
    spark = asked.sparkSession
    n, length = postings.n, postings.length
    kind = asked.schema["item_id"].dataType
    found = postings.rows.where(F.col("term").isNotNull())
    df = found.groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n) + 2).cast("double") / (2 * F.col("df") + 1)))
    blocks = -(-asked.count() // BLOCK_TERMS) or 1
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")
    wanted = (
        asked.groupBy(block.alias("block"), "term")
        .agg(F.collect_list(F.struct(F.col("item_id").cast("string").alias("item_id"), "times")).alias("items"))  # items of one block
        .join(df, "term").select("block", "term", weight.cast("long").alias("weight"), "items")
    )
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("ids", "array<long>"), ("lengths", "binary"))]
    lists = found.join(wanted, "term").select("block", "shard", F.lit(1).alias("kind"), "weight", "docs", "tfs", "items", *empty)
    none = {"weight": "long", "docs": "binary", "tfs": "binary", "items": lists.schema["items"].dataType.simpleString()}
    heads = postings.rows.where(F.col("term").isNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "shard", F.lit(0).alias("kind"), *(F.lit(None).cast(t).alias(c) for c, t in none.items()), "ids", "lengths"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        shard: _Shard | None = None
        best: dict[str | None, list[tuple]] = {}

        def rows() -> pa.RecordBatch:
            flat = [(item, None if null else doc, -score) for item, found in best.items() for score, null, doc in found]
            columns = zip(*flat, strict=True) if flat else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["item_id", "doc_id", "score"])

        def search() -> None:
            if shard:
                for item in shard.items:
                    best[item] = shard.search(item, best.get(item, []), k)

        for batch in slices(batches, 512):
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    search()
                    if at and at[0] != r["block"]:
                        yield rows()
                        best.clear()
                    at, shard = (r["block"], r["shard"]), _Shard(r["ids"], r["lengths"], n, length)
                else:
                    assert at == (r["block"], r["shard"]), "a shard's postings follow its head"
                    shard.add(r["weight"], r["docs"], r["tfs"], r["items"])
        search()
        yield rows()

    dealt = heads.unionByName(lists).repartition("shard").sortWithinPartitions("block", "shard", "kind")
    scored = dealt.mapInArrow(run, "item_id string, doc_id long, score long")
    rank = F.row_number().over(W.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return scored.select(F.col("item_id").cast(kind).alias("item_id"), rank.alias("rank"), "doc_id", "score").where(F.col("rank") <= k)


def search_documents(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """rank_documents over an index of the terms that the items ask for."""
    asked = Scratch(items.sparkSession, "asked").save(asked_terms(items))
    return rank_documents(index_postings(documents, asked), asked, k)
