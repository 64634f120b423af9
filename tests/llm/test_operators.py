import collections
import hashlib
import html
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.llm import archive, decontaminate, html_text, language, lm, neardup, packing, quality, search, toxicity
from colloquy.llm.common import id_remainder
from colloquy.llm.seating import gammas, log_stirling, mixed, tables, uniforms

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, **more):
    return spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in texts], DOCUMENTS)


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank and letterless texts, a repeated row, a null id, a very long text, and columns with clashing names."""
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, "!!! ***"), (5, "the same text"), (5, "the same text"), (None, "no id here"), (7, "word and " * 30_000), (8, None)]
    return documents(spark, texts).select("*", F.lit(1).alias("row"), F.lit("x").alias("c"), F.lit(0).alias("kept"), F.lit(2).alias("component"))


@pytest.fixture(scope="module")
def words():
    rng = random.Random(3)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(400)]


# Packing


def test_ids_are_those_of_tokenizers():
    bpe = packing.tokenizer("byte_bpe_50k")
    for text in ["", "Hello, world", "Été 123\n\n  x", "a<|endoftext|>b", "日本語 text", "​﻿ x", "don't WON'T"]:
        assert bpe.ids(text).tolist() == bpe.exact.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 1_000_000, " \n" * 600_000, "x" + "\t" * 20_000 + "y", "a" * 300_000])
def test_long_runs_do_not_stop_the_tokenizer(text):
    bpe = packing.tokenizer("byte_bpe_50k")
    assert bpe.ids(text).tolist() == bpe.exact.encode(text, add_special_tokens=False).ids


def test_packing_is_gapless_and_tight(spark, odd):
    rows = packing.pack_documents(odd).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    bpe = packing.tokenizer("byte_bpe_50k")
    want = collections.Counter()
    for r in odd.collect():
        ids = np.append(bpe.ids(r["text"] or ""), 0).astype("<u4")
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids), 2048), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(r["doc_id"], k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert want == collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert packing.pack_documents(odd.limit(0)).count() == 0


def test_fullest_bin_closes_first():
    bins = packing.BestFit(10, 2)
    assert [bins.place(n)[0] for n in (9, 5, 8, 1, 5)] == [0, 1, 2, 2, 1]


# Near duplicates


def brute(rows, size):
    sets = {k: set(map(int, neardup.shingle_hashes(t, size))) for k, t in rows}
    low = {k: k for k in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                low[max(p, q)] = min(p, q)
    return {k: (len(sets[k]), find(k)) for k in ids}


def test_near_copies_against_all_pairs(spark, words):
    rng = random.Random(4)
    base = [rng.choice(words) for _ in range(150)]
    rows = []
    for k in range(160):  # one group whose members are often less than 0.8 alike, and several components
        text = list(base)
        for _ in range(rng.randrange(0, 22)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((k, " ".join(text)))
    rows += [(200 + k, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40)))) for k in range(60)]
    rows += [(300, rows[3][1].upper()), (301, rows[3][1]), (302, ""), (303, None), (304, "one"), (305, "ONE")]
    neardup_block, neardup.BLOCK = neardup.BLOCK, 32
    try:
        got = neardup.near_duplicates(documents(spark, rows), 2).collect()
    finally:
        neardup.BLOCK = neardup_block
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, 2)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_of_odd_rows(spark, odd):
    got = collections.Counter(map(tuple, neardup.near_duplicates(odd).collect()))
    assert got[(5, 1, 5, True)] == 2 and got[(None, 1, None, True)] == 1 and got[(1, 0, 1, True)] == 1 and sum(got.values()) == 9
    assert neardup.near_duplicates(odd.limit(0)).count() == 0
    assert neardup.drop_near_duplicates(odd).columns == odd.columns


def test_one_row_remains_of_a_repeated_id(spark, odd):
    left = neardup.drop_near_duplicates(odd)
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 7, 8] and left.columns == odd.columns


# Language, quality, toxicity


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    profiles = language.language_profiles(docs, id_remainder("doc_id", 5) != 0)
    got = language.identify_languages(docs, profiles).where(id_remainder("doc_id", 5) == 0)
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count()


def test_language_of_odd_rows(spark, odd):
    got = [(r["doc_id"], r["lang_pred"], r["lang_score"]) for r in language.identify_languages(odd, {"en": language.ranked(language.ngrams("the same text"))}).collect()]
    assert sorted(r[0] or 0 for r in got if r[1] == "und") == [1, 2, 3, 4, 8] and len(got) == 9
    assert all(0 <= r[2] <= 1 for r in got)
    assert language.identify_languages(odd, {}).where("lang_pred <> 'und'").count() == 0
    assert language.language_profiles(odd.limit(0), F.lit(True)) == {}


@pytest.mark.parametrize("name", ["quality", "toxic"])
def test_classifiers_on_held_out_rows(spark, name):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")
    held = id_remainder("doc_id", 4) == 2 if name == "quality" else id_remainder("doc_id", 3) == 1
    known = docs.join(labels, "doc_id")
    if name == "quality":
        scored = quality.score_quality(known, quality.train_quality(docs, labels, ~held)).withColumnRenamed("quality_pred", "pred")
    else:
        scored = toxicity.score_toxicity(known, toxicity.train_toxicity(docs, labels, ~held)).withColumnRenamed("toxic_pred", "pred")
    scored = scored.where(held)
    assert scored.where(f"pred = {name}").count() >= 0.95 * scored.count()


def test_classifiers_without_labels_and_on_odd_rows(spark, odd):
    none = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    q = quality.score_quality(odd, quality.train_quality(odd, none, F.lit(True)))
    t = toxicity.score_toxicity(odd, toxicity.train_toxicity(odd, none, F.lit(True)))
    assert {r["quality_score"] for r in q.collect()} == {r["toxic_score"] for r in t.collect()} == {0.5}
    some = spark.createDataFrame([(5, 1, 0), (7, 0, 1), (5, 1, 0), (3, 1, None)], "doc_id long, quality int, toxic int")
    for rows, score in ((quality.score_quality(odd, quality.train_quality(odd, some, F.lit(True))), "quality_score"), (toxicity.score_toxicity(odd, toxicity.train_toxicity(odd, some, F.lit(True))), "toxic_score")):
        assert rows.count() == 9 and rows.where(f"{score} between 0 and 1").count() == 9


def test_language_against_plain_distances(spark):
    """Out-of-place distances of ranked n-grams, counted by hand."""
    texts = {"xx": "abba abb cab", "yy": "dada bad cad", "zz": "abba"}

    def grams(text):
        counts = collections.Counter()
        for word in text.split():
            for padded, n in ((word, 1), (f" {word} ", 2), (f" {word} ", 3)):
                counts.update(padded[k : k + n] for k in range(len(padded) - n + 1))
        return counts

    def ranks(counts, size):
        code = lambda g: (sum((ord(c) if c != " " else 0) << 21 * (len(g) - 1 - k) for k, c in enumerate(g))) | (len(g) == 2) << 62
        return sorted(counts, key=lambda g: (-counts[g], code(g)))[:size]

    size = 12
    docs = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(texts.items())], "doc_id long, text string, lang string")
    profiles = language.language_profiles(docs, F.lit(True), size)
    asked = ["abba", "dad cab", "bad bad abb"]
    got = {r["text"]: r for r in language.identify_languages(spark.createDataFrame([(t,) for t in asked], "text string"), profiles, size).collect()}
    for text in asked:
        own, far = ranks(grams(text), size), {}
        for lang, t in texts.items():
            there = ranks(grams(t), size)
            far[lang] = sum(abs(there.index(g) - k) if g in there else size for k, g in enumerate(own)) / (size * len(own))
        best = min(sorted(far), key=far.get)
        assert got[text]["lang_pred"] == best and abs(got[text]["lang_score"] - (1 - far[best])) < 1e-9


def test_quality_votes_against_all_cosines():
    """Votes of the nearest, ties with the last included, from a full sort of cosines."""
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(40, 6)).astype(np.float32)
    vectors[7] = vectors[3] = vectors[21]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    model = quality.QualityModel(np.eye(6, dtype=np.float32), vectors, rng.integers(0, 2, 40).astype(float), rng.random(40) + 0.1, 0.5)
    asked = np.concatenate([rng.normal(size=(9, 6)), vectors[3:4]]).astype(np.float32)
    got = model.scores(asked, neighbours=2, block=16)
    for x, score in zip(asked, got):
        cos = vectors @ (x / np.linalg.norm(x))
        near = np.flatnonzero(cos >= np.sort(cos)[-2] - 1e-6)
        vote = np.maximum(cos[near], 1e-3) ** 4 * model.weights[near]
        assert abs(score - (vote * model.labels[near]).sum() / vote.sum()) < 1e-5
    assert len(np.flatnonzero(vectors @ asked[-1] > 1 - 1e-6)) == 3


def test_very_long_words_are_read_whole():
    terms = quality._Terms()
    assert terms[b"a" * 300 + b"9"] != terms[b"a" * 301] and not len(terms)


def test_toxicity_against_noisy_or_by_hand(spark):
    model = toxicity.ToxicityModel(np.zeros(toxicity.BUCKETS, np.float32), -3.0, 1.5, -0.5)
    for word, w in (("vile", 4.0), ("bad", 2.0)):
        model.weights[toxicity.word_features(word)[0]] = w
    texts = ["You VILE thing!", "You VILE thing! İstanbul.", "Fine. Bad, bad day! vile", "", None]
    got = {r["text"]: r for r in toxicity.score_toxicity(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()}
    logistic = lambda x: 1 / (1 + np.exp(-x))
    sentences = {texts[0]: [4.0], texts[1]: [4.0, 0.0], texts[2]: [0.0, 4.0, 4.0], "": [], None: []}
    for text, logits in sentences.items():
        none = np.prod([1 - logistic(x - 3.0) for x in logits])
        want = logistic(1.5 * (np.log(max(1 - none, 1e-12)) - np.log(none)) - 0.5)
        assert abs(got[text]["toxic_score"] - want) < 1e-6
    assert [(texts[1][r["start"] : r["end"]]) for r in got[texts[1]]["offending"]] == ["You VILE thing!"]


def test_offending_sentences_are_located():
    rows = [{"doc_id": k, "y": k % 2, "class_rows": 50, "words": (["fine", f"w{k}", "you", "vile" if k % 2 else "nice"]), "sentence": [0, 0, 1, 1]} for k in range(100)]
    model = toxicity.fit_bags(rows)
    spans, chances = model.sentences("All fine here. You vile thing!", toxicity._Weights(model.weights))
    assert len(spans) == 2 and chances[1] > 0.5 > chances[0]


# Language model


def test_seating_law():
    s = log_stirling(0.5, 8)
    assert abs(np.exp(s[3, 2]) - (1 - 0.5 + 2 - 2 * 0.5)) < 1e-9  # S(3, 2) = (1 - d) + (2 - 2d)
    u = uniforms(np.arange(20_000, dtype=np.int64), 1)
    assert abs(u.mean() - 0.5) < 0.01
    got = np.bincount(tables(np.full(20_000, 3), np.full(20_000, 0.7), u, 0.5).astype(int), minlength=4)[1:]
    law = np.exp([s[3, t] + t * np.log(0.7) for t in (1, 2, 3)])
    assert np.abs(got / got.sum() - law / law.sum()).max() < 0.02
    for shape in (0.2, 3.5, 900.0):
        g = gammas(np.full(20_000, shape), np.arange(20_000, dtype=np.int64), 2)
        assert abs(g.mean() / shape - 1) < 0.05 and abs(g.var() / shape - 1) < 0.1


@pytest.mark.parametrize("d", [0.1, 0.5, 0.9])
def test_tables_of_many_customers_follow_the_recursion(d):
    t = np.arange(1501)
    log_s = np.where(t == 1, 0.0, -np.inf)
    for c in range(1, 5_000):  # log S(c, t) - log c!, up to what does not depend on t
        stay = log_s + np.log(np.maximum(c - t * d, 1e-300) / c)
        log_s = np.concatenate([[-np.inf], np.logaddexp(stay[1:], log_s[:-1] - np.log(c))])
        if c + 1 in (1_100, 5_000):
            for a in (0.01, 1.0, 10.0, 50.0, 300.0):
                law = np.exp(log_s + t * np.log(a) - (log_s + t * np.log(a)).max())
                got = tables(np.full(2000, c + 1), np.full(2000, a), (np.arange(2000) + 0.5) / 2000, d)
                share = np.bincount(got.astype(int), minlength=len(t)) / len(got)
                assert np.abs(share.cumsum() - law.cumsum() / law.sum()).max() < 0.045  # 2000 draws of the Poisson part


def test_blocked_gibbs_samples_the_restaurants_joint_law():
    """Two dishes of one restaurant under fixed masses: the sweeps' tables against the enumerated joint."""
    c, mass, d, strength = np.array([3, 4]), np.array([0.3, 0.1]), 0.5, 1.0
    s = log_stirling(d, 8)
    joint = {}
    for i in range(1, 4):
        for j in range(1, 5):
            rising = np.prod([strength + d * k for k in range(i + j)])
            joint[i, j] = np.exp(s[3, i] + s[4, j]) * rising * mass[0] ** i * mass[1] ** j
    n, total = 40_000, sum(joint.values())
    keys, t = np.arange(n, dtype=np.int64), np.full((2, n), 1.0)
    for sweep in range(12):  # n chains side by side
        x = gammas(strength / d + t.sum(axis=0), keys, 3 * sweep)
        t = np.stack([tables(np.full(n, c[k]), d * x * mass[k], uniforms(mixed(keys, np.full(n, k)), sweep), d) for k in (0, 1)])
    for (i, j), p in joint.items():
        assert abs(((t[0] == i) & (t[1] == j)).mean() - p / total) < 0.01


def plain_lm(train, scored):
    """The model in dictionaries, with the same keyed draws: {text: (n_tokens, n_known, base, score)}, and the sum of each context's chances."""
    cells = collections.Counter()
    for text in train:
        last = None
        for w in lm.tokens(text):
            cells[last, w] += 1
            last = w
    count, customers, kinds = collections.Counter(), collections.Counter(), collections.Counter()
    for (u, w), c in cells.items():
        count[w] += c
        customers[u] += c
        kinds[w] += 1
    total, v = sum(count.values()), len(count)
    d = lm._discount(sum(c == 1 for c in cells.values()), sum(c == 2 for c in cells.values()))
    d0 = lm._discount(sum(c == 1 for c in kinds.values()), sum(c == 2 for c in kinds.values()))
    h = lambda w: lm.START_HASH if w is None else lm.word_hash(w)
    one = lambda *a: np.array(a, np.int64)
    again_w, again_u = {w for (_, w), c in cells.items() if c > 1}, {u for (u, _), c in cells.items() if c > 1}
    t = dict.fromkeys(cells, 1.0)
    kept = []
    for sweep in range(lm.BURN_IN + lm.SAMPLES):
        of_u, of_w = collections.Counter(), collections.Counter()
        for (u, w), k in t.items():
            of_u[u] += k
            of_w[w] += k
        x = {u: gammas(np.array([lm.STRENGTH / d + of_u[u]]), one(h(u)), 3 * sweep)[0] for u in again_u}
        mass = {w: gammas(np.array([of_w[w] - d0]), one(h(w)), 3 * sweep + 1)[0] for w in again_w}
        rest = sum(kinds[w] - d0 for w in kinds if w not in again_w)
        lump = gammas(np.array([max(rest, 1e-9), lm.STRENGTH + d0 * v]), one(1, 2), 3 * sweep + 2)
        everything = sum(mass.values()) + (lump[0] if rest > 0 else 0) + lump[1]
        for (u, w), c in cells.items():
            if c > 1:
                t[u, w] = tables(one(c), np.array([d * x[u] * mass[w] / everything]), uniforms(mixed(one(h(u)), one(h(w))), sweep), d)[0]
        if sweep >= lm.BURN_IN:
            kept.append(dict(t))

    def chances(u, w):
        out = []
        for seats in kept:
            of_u, of_w = sum(k for (a, _), k in seats.items() if a == u), sum(k for (_, b), k in seats.items() if b == w)
            fresh = lm.STRENGTH + d0 * v
            p = (of_w - d0 if of_w else fresh) / (lm.STRENGTH + sum(seats.values()))
            c = cells.get((u, w), 0)
            out.append((max(0, c - d * seats.get((u, w), 0)) + (lm.STRENGTH + d * of_u) * p) / (lm.STRENGTH + customers[u]))
        return sum(out) / len(out)

    for u in [None, *list(customers)[:4]]:
        assert abs(sum(chances(u, w) for w in [*count, b"never seen"]) - 1) < 1e-9
    out = {}
    for text in scored:
        words = lm.tokens(text)
        base = sum(np.log10((count[w] + 0.1) / (total + 0.1 * (v + 1))) for w in words)
        score = sum(np.log10(chances(u, w)) for u, w in zip([None, *words[:-1]], words))
        out[text] = (len(words), sum(count[w] > 0 for w in words), base, score)
    return out, total


@pytest.mark.parametrize("top, seen", [((1000, 9), True), ((12, 9), False), ((0, 0), False)])
def test_lm_against_a_plain_sampler(spark, words, top, seen):
    rng = random.Random(6)
    train = [" ".join(rng.choice(words[:25] if rng.random() < 0.8 else words) for _ in range(30)) for _ in range(40)] + ["A a A a", None, ""]
    held = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(6)] + ["Unseen x", "Unseen unseen " + words[0], None]
    want, total = plain_lm(train, [*train, *held])
    rows = [(k, x) for k, x in enumerate(train)] + [(100 + k, x) for k, x in enumerate(held)] + [(106, "Unseen x")]
    docs = documents(spark, rows)
    model = lm.train_lm(docs, F.col("doc_id") < 100, *top)
    got = lm.score_lm(docs, model, F.col("doc_id") < 100 if seen else None).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(k for k, _ in rows)
    for r in got:
        n, known, base, score = want[dict(rows)[r["doc_id"]]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert abs(r["base_score"] - base) < 1e-6 and abs(r["score"] - score) < 1e-4


def test_lm_of_odd_rows(spark, odd):
    assert lm.score_lm(odd, lm.train_lm(odd, F.lit(True))).count() == 9
    assert {r["score"] for r in lm.score_lm(odd.where("doc_id < 4"), lm.train_lm(odd.limit(0), F.lit(True))).collect()} == {0.0}
    assert lm.score_lm(odd.limit(0), lm.train_lm(odd, F.lit(True))).count() == 0


# Search


def test_search_against_all_scores(spark, words):
    rng = random.Random(7)
    rows = [(k, " ".join(rng.choices(words, [1 / (j + 1) for j in range(len(words))], k=rng.randrange(0, 60)))) for k in range(300)] + [(300, None)]
    asked = [(k, " ".join(rng.choices(words[:80], k=6))) for k in range(8)] + [(8, None), (9, "nothing_of_it zzz")]
    index = search.build_index(documents(spark, rows), shard_postings=900)
    got = search.search(index, spark.createDataFrame(asked, "query_id long, text string"), k=5).collect()
    docs = {k: collections.Counter(search.terms(t)) for k, t in rows}
    mean = sum(sum(d.values()) for d in docs.values()) / len(docs)
    df = collections.Counter(t for d in docs.values() for t in d)
    for q, text in asked:
        scores = {}
        for k, d in docs.items():
            n = sum(d.values())
            parts = [np.log1p((len(docs) - df[t] + 0.5) / (df[t] + 0.5)) * d[t] * 2.2 / (d[t] + 1.2 * (0.25 + 0.75 * n / mean)) for t in search.terms(text) if d[t]]
            if parts:
                scores[k] = sum(parts)
        want = sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0]))[:5]
        mine = sorted((r["rank"], r["doc_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[1] for m in mine] == [w[0] for w in want]
        assert np.allclose([m[2] for m in mine], [w[1] for w in want])


def test_search_takes_any_number_of_words_and_of_queries(spark, words, monkeypatch):
    rng = random.Random(9)
    rows = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 40)))) for k in range(120)]
    docs = documents(spark, rows)
    asked = docs.where("doc_id % 2 = 0").select(F.col("doc_id").alias("query_id"), "text")
    index = search.build_index(docs, shard_postings=400)
    run = lambda queries: {(r["query_id"], r["rank"]): (r["doc_id"], round(r["score"], 9)) for r in search.search(index, queries, k=3).collect()}
    whole = run(asked)
    assert len({q for q, _ in whole}) == 60
    monkeypatch.setattr(search, "BLOCK_TERMS", 100)  # many blocks
    assert run(asked) == whole
    monkeypatch.undo()
    strange = spark.createDataFrame([(1000, rows[5][1] + " " + " ".join(f"zz{j}" for j in range(200_500)))], "query_id long, text string")
    one = spark.createDataFrame([(1000, rows[5][1])], "query_id long, text string")
    assert run(strange) == run(one) != {}


# Decontamination


def test_contamination_against_all_windows(spark, words, odd):
    rng = random.Random(8)
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 2, 5, 10, 14, 25])))) for k in range(25)] + [(50, None), (51, "--"), (52, "")]
    rows = [(k, " ".join(rng.choices(words, k=80))) for k in range(40)]
    for k in range(40, 60):
        text = rng.choices(words, k=30) + items[rng.randrange(25)][1].upper().split() + rng.choices(words, k=5)
        rows.append((k, ", ".join(text)))
    split = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    want = {}
    for k, t in rows:
        w, hit, got = split(t), set(), set()
        for item, text in items:
            v = split(text)
            n = min(10, len(v))
            for a in range(len(v) - n + 1 if v else 0):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == v[a : a + n]:
                        hit.update(range(at, at + n))
                        got.add(str(item))
        want[k] = (len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest(), bool(hit))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(documents(spark, rows), benchmark).collect()
    assert {r["doc_id"]: tuple(r)[1:6] for r in got} == want
    assert decontaminate.find_contamination(odd, benchmark).count() == 9
    assert decontaminate.find_contamination(odd, benchmark.limit(0)).where("contaminated").count() == 0
    assert decontaminate.drop_contaminated(odd, benchmark.limit(0)).columns == odd.columns


def test_a_long_text_that_repeats_a_window(spark):
    docs = documents(spark, [(1, "the " * 100_000), (2, "the " * 9), (3, "a b c the the the")])
    items = spark.createDataFrame([(k, "the " * 10) for k in range(50)] + [(90, "b c"), (91, "the the")], "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in decontaminate.find_contamination(docs, items).collect()}
    assert got == {1: (100_000, 51), 2: (9, 1), 3: (5, 2)}


# Pages


@pytest.mark.parametrize(
    "part, stays",
    [("<p class='notice-board'>The notice board, long, of things.</p>", True), ("<p class=share-price>The share price rose, they say.</p>", True),
     ("<div class='search-method'><p>We searched, and found.</p></div>", True), ("<section id='related-work'><p>Others did this work.</p></section>", True),
     ("<h2 id='comments-on-method'>Comments on method</h2>", True), ("<p id=tags>Tags are words, and more.</p>", True), ("<p><a href=http://x/>A link</a> stays, here.</p>", True),
     ("<div class='comment-list'><p>Great, post, thanks.</p></div>", False), ("<p class='ad'>Buy, now, this.</p>", False), ("<div class='cookie-notice'><p>We use, cookies.</p></div>", False),
     ("<ul class='share-buttons'><li>Post it</li></ul>", False), ("<form><p>Name, please</p></form>", False)],
)
def test_whole_names_mark_what_is_foreign(part, stays):
    page = f"<body><nav><a href=x>Home</a></nav><main><article><h1>T</h1><p>A first paragraph, of the text, long enough, to count.</p>{part}</article></main></body>"
    assert (len(html_text.main_text(page).split("\n")) == 3) == stays


@pytest.mark.parametrize(
    "page",
    ["".join("<div>" + "x, y " * 20 for _ in range(10_000)), "<span>" * 40_000 + "</b>" * 40_000, "<ul>" + "<div>" * 20_000 + "<li>a" * 20_000, "<a " * 300_000,
     "<div>" + "<span>" * 30_000 + "<hr>" * 30_000, "<p>" * 50_000 + "a"],
)
def test_hostile_pages_take_time_in_proportion(page):
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 4


def test_pages_against_their_articles(spark):
    """All pages of the table, whose text is what stands between the article's tags."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in html_text.extract_main_text(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1].replace("<br>", " ")
        blocks = re.split(r"</?(?:p|h1|div|li|ul)>", inner)
        lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
        assert r["text"] == "\n".join(x for x in lines if x) and r["n_chars"] == len(r["text"])


def test_extraction_of_odd_rows(spark):
    rows = [(1, "u", "<p>One, two.</p>"), (1, "u", "<p>One, two.</p>"), (None, None, None), (3, "v", "")]
    pages = spark.createDataFrame([(*r, "x", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = collections.Counter(tuple(r) for r in html_text.extract_main_text(pages).collect())
    assert got == {(1, "u", "One, two.", 9): 2, (None, None, "", 0): 1, (3, "v", "", 0): 1}
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


PROSE = "<p>{}, a long paragraph of an article, with commas, and more than eighty characters of prose in all, surely.</p>"


@pytest.mark.parametrize(
    "part, stays",
    [
        ('<section id="search">{}</section>', True), ('<section id="form">{}</section>', True), ('<section class="related">{}</section>', True), ('<div class="text-block global-tags">{}</div>', True),
        ('<section class="comments">{}</section>', False), ('<div class="notice">{}</div>', False), ('<div class="advert">{}</div>', False), ('<div class="related"><ul><li><a href=x>{}</a></ul></div>', False),
        ('<div class="tags">{}</div>'.format("<div class='share'><a href=x>Third</a></div>" * 3), False),
    ],
)
def test_doubtful_parts_of_an_article(part, stays):
    page = "<body><article>" + PROSE.format("First") + PROSE.format("Second") + part.format(PROSE.format("Third")) + "</article>"
    got = html_text.main_text(page).split("\n")
    assert [g.split(",")[0] for g in got] == ["First", "Second", "Third"][: 3 if stays else 2]


def test_bare_text_between_containers_and_titles_above():
    block = '<div class="content">{}</div>'
    page = "<body>" + block.format(PROSE.format("One")) + "Bare text of the <b>article</b><br>goes on" + block.format(PROSE.format("Two"))
    assert [g.split(",")[0] for g in html_text.main_text(page).split("\n")] == ["One", "Bare text of the article goes on", "Two"]
    linked = page.replace("Bare text of the <b>article</b><br>goes on", "<a href=x>only a link</a>")
    assert [g.split(",")[0] for g in html_text.main_text(linked).split("\n")] == ["One", "Two"]
    deep = "<div>{}<div>{}</div></div>"
    assert html_text.main_text(deep.format("<h1>Title</h1>", block.format(PROSE.format("A")))).split("\n")[0] == "Title"
    assert html_text.main_text(deep.format("<h1>Site</h1>", block.format("<h1>Title</h1>" + PROSE.format("A")))).split("\n")[0] == "Title"
    many = html_text.main_text("<div class=related><div class=tags>" * 5000 + "<article>" + "<section class=search>" * 5000 + PROSE.format("A"))
    assert many == "" or many.startswith("A,")


def test_many_long_blanks_are_found_in_linear_time():
    text = ("x" + " " * 9_999) * 50
    started = time.perf_counter()
    assert not packing._LONG_BLANK.search(text) and packing._LONG_BLANK.search("x" + " " * 10_000)
    assert time.perf_counter() - started < 1


def test_main_text():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><p>Site name, and, more, words</p></header><nav><ul><li><a href=x>Home</a></ul></nav>
    <div class="cookie-notice"><p>We use cookies, really, many of them.</p></div><main><article><h1>A  Title</h1><p>First &amp; foremost,\n a paragraph<br>with a break, long enough to count.
    <p>Second <b>bold<i>ly</b> one.<script>var t="</p>";</script></p><div class="ad">Buy</div><ul><li>One<li>Two</ul><blockquote>Quote</blockquote></article></main>
    <aside>Side</aside><section id="comments"><p>Great post, thanks, really, good, stuff here indeed.</p></section><footer>&copy; x</footer>"""
    assert html_text.main_text(page).split("\n") == ["A Title", "First & foremost, a paragraph with a break, long enough to count.", "Second boldly one.", "One", "Two", "Quote"]


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "plain text", "<div>" * 5000 + "deep" + "</div>" * 10, "<a href='x>y</a>", "<!-- open", "<script>x"])
def test_odd_pages(page):
    got = html_text.main_text(page)
    assert got in ("", "<", "<p", "plain text", "deep", "y") or "href" in got or got == "<!-- open"


def test_archive_round_trip(spark):
    long = "é" * 600
    rows = [(1, "http://a", long), (2, "http://b\r\nX: y", long), (3, None, "short"), (4, "http://c", "short"), (5, "http://d", None), (None, "http://e", long), (2, "http://b", "z" * 999), (9, "u", "")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, strong int")
    path = archive.write_archive(spark, pages)
    records = archive.read_archive(spark, path)
    assert records.where("verified").count() == len(rows)
    got = collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in archive.archive_index(records).collect())
    want = collections.Counter()
    for page, _, html in rows:
        raw = (html or "").encode()
        again = len(raw) >= 1000 and page != 2
        want[(page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", 2 if again else None)] += 1
    assert got == want
    texts = [bytes(r[0]) for r in archive.original_records(records).collect()]
    assert all(t.startswith(b"WARC/1.1\r\n") and t.endswith(b"\r\n\r\n") for t in texts) and sum(long.encode() in t for t in texts) == 1
    assert spark.read.parquet(f"{path}/payloads").count() == len({(r[2] or "") for r in rows})
    assert archive.archive_index(archive.read_archive(spark, archive.write_archive(spark, pages.limit(0)))).count() == 0
