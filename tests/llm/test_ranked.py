import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
A_Z = {c: c + 32 for c in range(65, 91)}


def words(text):
    return TERM.findall((text or "").translate(A_Z))


def brute(documents, items, k):
    docs = [(doc_id, Counter(w), len(w)) for doc_id, text in documents if (w := words(text))]
    n, length = len(docs), sum(x[2] for x in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(words(text))
    out = {}
    for item, terms in asked.items():
        rows = []
        for doc_id, tfs, size in docs:
            m = 25 + 75 * size * n // length
            score = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tfs[t] // (1000 * tfs[t] + 8 * m))
                for t, times in terms.items() if t in tfs
            )
            if score > 0:
                rows.append((-score, doc_id is None, doc_id or 0))
        out[item] = [(rank, None if null else doc, -score) for rank, (score, null, doc) in enumerate(sorted(rows)[:k], 1)]
    return {item: rows for item, rows in out.items() if rows}


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return out


def tables(spark, seed=0):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(150)] + ["été", "Übung", "日本語", "é", "A1", "a1"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(vocabulary[min(int(rng.expovariate(0.03)), 155)] for _ in range(n))
    documents = [(k, text(rng.randrange(1, 60))) for k in range(300)]
    documents += [(k, documents[5][1]) for k in range(300, 340)]  # ties
    documents += [(7, "w1 w2"), (7, "w1 w2"), (None, documents[5][1]), (None, "w3"), (400, None), (401, ""), (402, " ,;[]\x7f"), (403, "w1 " * 80_000), (404, "x" * 300_000)]
    items = [(k, text(rng.randrange(1, 20))) for k in range(12)] + [(50, " ".join(vocabulary)), (50, "w1"), (51, None), (52, ""), (53, "absent words"), (54, documents[5][1]), (None, "w2 W2")]
    rng.shuffle(documents)
    clash = lambda df: df.select("*", F.lit(1).alias("term"), F.lit(2).alias("shard"), F.lit(3).alias("n"), F.lit(4).alias("block"))
    return documents, items, clash(spark.createDataFrame(documents, "doc_id long, text string").repartition(3)), clash(spark.createDataFrame(items, "item_id long, text string"))


@pytest.mark.parametrize(("k", "shard", "blocks"), [(10, 2048, 50_000), (3, 16, 60), (1000, 50, 50_000)])
def test_equals_brute_force(spark, monkeypatch, k, shard, blocks):
    documents, items, d, i = tables(spark)
    monkeypatch.setattr(ranked, "BLOCK_TERMS", blocks)
    asked = ranked.asked_terms(i)
    postings = ranked.index_postings(d, asked, shard_docs=shard)
    assert found(ranked.rank_documents(postings, asked, k)) == brute(documents, items, k)
    whole = ranked.index_postings(d, shard_docs=shard)
    assert found(ranked.rank_documents(whole, asked, k)) == brute(documents, items, k)


def test_empty_tables(spark):
    _, _, d, i = tables(spark)
    assert ranked.search_documents(d.limit(0), i).count() == 0
    assert ranked.search_documents(d, i.limit(0)).count() == 0
    assert ranked.search_documents(d.where("doc_id in (400, 401)"), i).count() == 0


def test_masks_that_cannot_reach_are_not_scored(monkeypatch):
    rng = np.random.default_rng(2)
    lengths = np.full(500, 30, np.int64)
    shard = ranked._Shard(list(range(500)), lengths.tobytes(), 500, 15_000)
    for weight, share in ((6000, 0.03), (4000, 0.1), (300, 0.5), (100, 0.9)):
        docs = np.flatnonzero(rng.random(500) < share).astype(np.uint16)
        shard.add(weight, docs.tobytes(), np.ones(len(docs), np.uint32).tobytes(), [{"item_id": "a", "times": 1}])
    seen = []
    plain = ranked._Shard._scored
    monkeypatch.setattr(ranked._Shard, "_scored", lambda self, asked, docs, best, k: seen.append(len(docs)) or plain(self, asked, docs, best, k))
    best = shard.search("a", [], 5)
    scores = np.zeros(500, np.int64)
    for docs, parts in zip(shard.docs, shard.parts):
        scores[docs] += parts
    assert best == [(-int(scores[d]), False, int(d)) for d in np.argsort(-scores, kind="stable")[:5]]
    assert sum(seen) < 100
    seen.clear()
    assert shard.search("a", [(-(10**12), False, 1)] * 5, 5) == [(-(10**12), False, 1)] * 5 and not seen
