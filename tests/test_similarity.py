"""Containment, shared runs and set similarity against plain loops, with copies and repeated words."""

import random

import pytest

from colloquy.operators import dedup, joins, similarity
from colloquy.session import Scratch


def random_lists(seed, n, longest=9, words="abcd"):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        out.append([rng.choice(words) for _ in range(rng.randint(1, longest))])
        if rng.random() < 0.3:
            out.append(list(rng.choice(out)))
        if rng.random() < 0.3:
            base = rng.choice(out)
            out.append([rng.choice(words), *base, rng.choice(words)])
    return out


def within(a, b):
    return any(b[k : k + len(a)] == a for k in range(len(b) - len(a) + 1))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_contained_runs(spark, n):
    rows, seen = [], set()
    for k, t in enumerate(random_lists(n, 60)):
        g = "xy"[k % 2] if k % 7 else None
        if len(t) >= n and (g, *t) not in seen and g:
            seen.add((g, *t))
            rows.append((g, k // 2, t))  # ids are unique within a group only
    frame = spark.createDataFrame(rows, "grp string, id long, t array<string>")
    got = sorted((r.grp, r.short_id, r.long_id) for r in dedup.contained_runs(frame, ["grp"], n).collect())
    want = sorted((g, i, j) for g, i, a in rows for h, j, b in rows if g == h and len(a) < len(b) and within(a, b))
    assert got == want and len(want) > 20
    assert dedup.contained_runs(frame.limit(0), ["grp"], n).count() == 0


def test_shared_runs_with_copies_nulls_and_short_rows(spark):
    left = [(k, t) for k, t in enumerate(random_lists(5, 50))] + [(900, None), (901, []), (902, ["a"]), (None, ["a", "b", "a", "b"])]
    right = [(f"i{k}", t) for k, t in enumerate(random_lists(6, 10))] + [("null", None)]
    a, b = spark.createDataFrame(left, "id long, tokens array<string>"), spark.createDataFrame(right, "item string, tokens array<string>")
    cut = lambda t: {tuple(t[k : k + 3]) for k in range(len(t or []) - 2)}
    want = sorted((str(i), j, len(cut(s) & cut(t))) for i, s in left for j, t in right if cut(s) & cut(t))
    assert sorted((str(r.id), r.item, r.shared) for r in joins.shingle_join(a, b, "id", "item", 3).collect()) == want


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_jaccard_over_classes_of_equal_sets(spark, threshold):
    rows = [(k, sorted(set(t))) for k, t in enumerate(random_lists(9, 80, 7, "abcdefgh"))] + [(900, []), (901, None)]
    frame = spark.createDataFrame(rows, "id long, tokens array<string>")
    full = [(i, set(t)) for i, t in rows if t]
    want = {(i, j): len(s & t) / len(s | t) for i, s in full for j, t in full if i < j and len(s & t) >= threshold * len(s | t)}
    assert {(r.a, r.b): r.jaccard for r in similarity.jaccard_join(frame, "id", "tokens", threshold).collect()} == pytest.approx(want)
    classes = {r.id: r.class_id for r in similarity.jaccard_classes(frame, "id", "tokens").collect()}
    assert classes == {i: min(j for j, t in full if t == s) for i, s in full}
    links = {(r.a, r.b) for r in similarity.jaccard_links(frame, "id", "tokens", threshold).collect()}
    assert links == {(classes[i], classes[j]) for i, j in want if classes[i] != classes[j] and classes[i] < classes[j]} | {(classes[j], classes[i]) for i, j in want if classes[j] < classes[i]}


@pytest.mark.parametrize("copies", [1, 3])
def test_long_runs_meet_in_what_they_have_least_in_common(spark, copies):
    """Runs of all lengths about the window, with copies, cut out of, or edited in, one another."""
    rng = random.Random(copies)
    frame, full = [], []
    for k in range(160):
        t = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 40))]
        if full and rng.random() < 0.6:
            base = rng.choice(full)
            i, j = sorted(rng.sample(range(len(base) + 1), 2))
            t = base[i:j] if rng.random() < 0.5 else [*t[:3], *base, *t[:2]]
            if rng.random() < 0.3:
                t[rng.randrange(len(t))] = "x"
        full.append(t)
        frame += [("gh"[k % 2] if k % 9 else None, 1000 * c + k, t) for c in range(copies)]
    want = {}
    for g, j, b in frame:
        own = [i for h, i, a in frame if h == g and g and a and b and i < j and (within(a, b) or within(b, a))]
        want |= {j: min(own)} if own else {}
    df = spark.createDataFrame(frame, "g string, id long, t array<string>")
    assert {r.removed_id: r.kept_id for r in dedup.contained_rows(df, ["g"], "id", "t").collect()} == want and len(want) > 50


def test_few_keys_of_a_text_travel(spark):
    from colloquy.operators import grams

    rng = random.Random(1)
    frame = [(0, k, [f"w{rng.randrange(5000)}" for _ in range(600)]) for k in range(20)]
    keyed = grams.keyed_runs(spark.createDataFrame(frame, "group long, name long, t array<string>"), 1)
    assert 0 < keyed.count() < 20 * 600 * 0.4  # a minimizer for about three tokens, where each token had a row


@pytest.mark.parametrize("threshold", [0.7, 0.8])
def test_jaccard_of_long_sets_of_common_words(spark, threshold):
    """Families of edited copies, cuts and a few words that all have, beyond what bits of parity can tell apart."""
    rng = random.Random(int(threshold * 10))
    words = [f"w{k}" for k in range(1500)]
    full = []
    for k in range(12):
        base = rng.sample(words, rng.choice([3, 10, 60, 300, 900]))
        for c in range(8):
            full.append((k * 8 + c, sorted({"the", "of", *rng.sample(base, rng.randint(int(0.8 * len(base)), len(base))), *rng.sample(words, rng.randint(0, len(base) // 20))})))
    want = {(i, j): len(set(s) & set(t)) / len(set(s) | set(t)) for i, s in full for j, t in full if i < j}
    want = {k: v for k, v in want.items() if v >= threshold}
    got = {(r.a, r.b): r.jaccard for r in similarity.jaccard_join(spark.createDataFrame(full, "id long, tokens array<string>"), "id", "tokens", threshold).collect()}
    assert got == pytest.approx(want) and len(want) > 50


def test_jaccard_reads_its_rows_once(spark):
    """Tokens may be dear to make, so they are made once for classes, links and members."""
    calls = spark.sparkContext.accumulator(0)

    def seen(t):
        calls.add(1)
        return t

    from pyspark.sql import functions as F

    full = [(k, [f"w{j}" for j in range(60) if j != k % 60]) for k in range(40)]
    frame = spark.createDataFrame(full, "id long, tokens array<string>").withColumn("tokens", F.udf(seen, "array<string>").asNondeterministic()("tokens"))
    assert similarity.jaccard_join(frame, "id", "tokens", 0.8).count() == 40 * 39 // 2
    assert calls.value == 40


def test_rows_of_pairs_travel_once_for_each_block(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 400) if (a + b) % 3 or a == 0] + [(900, 901), (901, 902)]
    ids = sorted({x for p in pairs for x in p})
    left = spark.createDataFrame([(x, f"l{x}") for x in ids], "a long, va string")
    right = spark.createDataFrame([(x, f"r{x}") for x in ids], "b long, vb string")
    out = similarity.side_by_side(spark.createDataFrame(pairs, "a long, b long"), left, right, Scratch(spark, "test"))
    assert sorted((r.a, r.b, r.va, r.vb) for r in out.collect()) == sorted((a, b, f"l{a}", f"r{b}") for a, b in pairs)
    sent = out.select("home", "block", "a").distinct().count() + out.select("home", "block", "b").distinct().count()
    assert sent < len(pairs) / 10


def test_sets_travel_for_near_pairs_only(spark, monkeypatch):
    """Long sets that meet in rare tokens and differ in many more than a bit a class can tell are known by their counts, without being fetched."""
    rng = random.Random(4)
    common = [f"w{k}" for k in range(6000)]
    full = []
    for f in range(6):
        rare = [f"r{f} {k}" for k in range(150)]
        for c in range(12):
            full.append((len(full), sorted({*rare, *rng.sample(common, 900)})))
        full.append((len(full), full[-1][1][:-9]))
    asked, whole = [], similarity.side_by_side
    monkeypatch.setattr(similarity, "side_by_side", lambda pairs, *rest: asked.append(pairs.count()) or whole(pairs, *rest))
    for names in (int, str):
        frame = spark.createDataFrame([(names(k + 10), t) for k, t in full], f"id {'long' if names is int else 'string'}, tokens array<string>")
        got = {(r.a, r.b) for r in similarity.jaccard_join(frame, "id", "tokens", 0.8).collect()}
        assert got == {(names(f * 13 + 21), names(f * 13 + 22)) for f in range(6)}
    assert max(asked) < 20  # every pair of a family, 468, was fetched


def test_pairs_that_share_many_rare_tokens_meet_about_once(spark):
    import numpy as np

    base = [f"w{k}" for k in range(200)]
    frame = spark.createDataFrame([(k, [w for j, w in enumerate(base) if j != k]) for k in range(30)], "id long, tokens array<string>")
    named = similarity._named(frame, "id", "tokens", Scratch(spark, "test"))
    prefix = similarity._prefixes(named.select("id", "h"), np.zeros(1 << 20, np.int64), 0.8)
    met = similarity._meeting(prefix, 0.8)
    assert met.distinct().count() == 30 * 29 // 2 and prefix.where("p <= head").groupBy("id").count().where("count > 10").count() == 30
    assert met.count() <= 4 * 30 * 29 // 2  # a row for each token of two prefixes before


def test_documents_of_two_sources_never_meet(spark, monkeypatch, tmp_path):
    from colloquy.plans import validators

    words = " ".join(f"w{k}" for k in range(60))
    rows = [(k, words if k % 2 else words + " more", (None, "", "a", "b", "a b")[k // 4]) for k in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    met, whole = [], validators.jaccard_join
    monkeypatch.setattr(validators, "jaccard_join", lambda *a: met.append(whole(*a)) or met[-1])
    got = {(r.kept_id, r.removed_id): r.reason for r in validators.adjudicated_pairs(spark, str(tmp_path)).collect()}
    assert got == {(i, j): "MIRROR" if (i - j) % 2 == 0 else "CONTAINED" for i in range(20) for j in range(i + 1, 20) if i // 4 == j // 4}
    assert met[0].count() == len(got) == 30
