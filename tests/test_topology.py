import collections
import difflib
import random

import pytest
from pyspark.sql import functions as F

from colloquy.operators import recovery, topology

TOKEN = "recording string, token_id string, start double, end double, text string, clusters map<string,string>, overlap boolean"


def related(a, b):
    shared = set(a) & set(b)
    return "unknown" if not shared else "same" if all(a[k] == b[k] for k in shared) else "different"


def keys(tokens, ties):
    votes = {}
    for t in tokens:
        for window, cluster in (t["clusters"] or {}).items():
            votes.setdefault(window, collections.Counter())[cluster] += 1
    out = []
    for window, counts in votes.items():
        top = counts.most_common(2)
        if ties or len(top) == 1 or top[0][1] > top[1][1]:
            out.append(f"{window}::{top[0][0]}")
    return sorted(out)


def text_of(tokens):
    return " ".join((t["text"] or "").strip() for t in tokens).strip()


def plain_spans(tokens, gap=1.25):
    out = []
    for rec in sorted({t["recording"] for t in tokens}):
        groups = []
        for t in sorted((t for t in tokens if t["recording"] == rec), key=lambda t: (t["start"], t["end"], t["token_id"])):
            last = groups[-1][-1] if groups else None
            if last is None or t["start"] - last["end"] > gap or t["overlap"] or last["overlap"] or related(last["clusters"] or {}, t["clusters"] or {}) == "different":
                groups.append([])
            groups[-1].append(t)
        for k, g in enumerate(groups):
            if text_of(g):
                out.append((rec, k, g[0]["start"], g[-1]["end"], text_of(g), len(g), any(t["overlap"] for t in g), tuple(keys(g, False))))
    return sorted(out)


def resolve(names, anchors):
    states = [anchors.get(k, "?") for k in names]
    return states[0] if names and len(set(states)) == 1 and states[0] in (recovery.TARGET, recovery.OTHER) else None


def plain_splits(tokens, anchors):
    out = []
    turns = sorted({(t["recording"], t["turn_id"]) for t in tokens})
    for turn in turns:
        own = sorted((t for t in tokens if (t["recording"], t["turn_id"]) == turn and t["clusters"]), key=lambda t: (t["start"], t["end"], t["token_id"]))
        groups = []
        for t in own:
            if not groups or related(groups[-1][-1]["clusters"], t["clusters"]) == "different":
                groups.append([])
            groups[-1].append(t)
        states = [resolve([f"{turn[0]}|{k}" for k in keys(g, True)], anchors) for g in groups]
        frozen = any(t["frozen"] for t in tokens if (t["recording"], t["turn_id"]) == turn)
        texts = [text_of(g) for g in groups]
        bad = any(len(g) < 2 for g in groups) or None in states or len(set(states)) < 2 or any(not x or x.lower() in ("filtered", "audio filtered") for x in texts)
        if len(groups) > 1 and not frozen and not bad:
            out += [(*turn, k, g[0]["start"], g[-1]["end"], x, s) for k, (g, x, s) in enumerate(zip(groups, texts, states))]
    return sorted(out)


def make(rng, recordings=6, n=60):
    tokens = []
    for rec in range(recordings):
        at = 0.0
        for k in range(n):
            at = round(at + rng.choice([0.0, 0.3, 1.25, 1.5]) * (rng.random() < 0.5), 3)
            who = "a" if (k // rng.choice([4, 5])) % 2 else "b"
            clusters = {f"w{k // 20}": who} | ({f"v{k // 30}": who if rng.random() < 0.95 else "c"} if rng.random() < 0.5 else {})
            tokens.append({
                "recording": f"r{rec}", "token_id": f"{k:03d}", "start": at, "end": round(at + 0.5, 3), "text": rng.choice(["one", "two ", " ", None, "filtered"]),
                "clusters": rng.choice([None, {}, clusters, clusters, clusters, clusters]), "overlap": rng.choice([None, False, False, False, True]) if rng.random() < 0.2 else False,
                "turn_id": f"t{k // 7}", "frozen": k // 7 == 3,
            })
            at = round(at + 0.5, 3)
    return tokens


@pytest.mark.parametrize("seed", range(1))
def test_spans_and_splits_against_plain_loops(spark, seed):
    tokens = make(random.Random(seed))
    df = spark.createDataFrame(tokens, f"{TOKEN}, turn_id string, frozen boolean").repartition(4).withColumn("place", F.lit(9)).withColumn("window", F.lit("x"))
    got = sorted((r["recording"], r["span"], r["start"], r["end"], r["text"], r["n_tokens"], r["overlap"], tuple(r["cluster_keys"])) for r in topology.candidate_spans(df.drop("place", "window")).collect())
    assert got == plain_spans(tokens)
    anchors = {f"r{r}|{w}{k}::{c}": {"a": recovery.TARGET, "b": recovery.OTHER, "c": recovery.TARGET}[c] for r in range(6) for w in "wv" for k in range(4) for c in "abc" if (r, k) != (2, 1)}
    table = spark.createDataFrame([(k, s, "ANCHOR") for k, s in anchors.items()] * 2, "key string, speaker_state string, basis string")
    rows = topology.split_turns(df.drop("place", "window"), table).collect()
    want = plain_splits(tokens, anchors)
    assert sorted((r["recording"], r["turn_id"], r["part"], r["start"], r["end"], r["text"], r["speaker_state"]) for r in rows) == want and len(want) > 4
    assert {r["role"] for r in rows} == {"assistant", "user"}


def test_merges_by_the_sequence_ratio(spark):
    spans = [("r", 0, 0, 4000, "go to the park today", False, ["w0::a"]), ("r", 1, 5000, 9000, "nothing alike here", False, ["w0::a"]), ("r", 2, 10_000, 14_000, "same words", True, ["w0::a"]),
             ("r", 3, 15_000, 19_000, "same words", False, ["w0::z"]), ("r", 4, 20_000, 24_000, "same words", False, ["w0::a"]), ("s", 0, 0, 4000, "same words", False, ["w0::a"])]
    turns = [("r", f"t{a}", a, b, x, f) for a, b, x, f in [
        (0, 2000, "go to the", False), (2000, 4500, "park, today", False), (5000, 7000, "quite", False), (7000, 9000, "other", False), (10_000, 12_000, "same", False), (12_000, 14_000, "words", False),
        (15_000, 17_000, "same", False), (17_000, 19_000, "words", False), (20_000, 22_000, "same", True), (22_000, 24_000, "words", False)]] + [("s", "t", 0, 4000, "same words", False)]
    spans = spark.createDataFrame(spans, "recording string, span long, start long, end long, text string, overlap boolean, cluster_keys array<string>")
    turns = spark.createDataFrame(turns, "recording string, turn_id string, start long, end long, text string, frozen boolean")
    anchors = spark.createDataFrame([("r|w0::a", recovery.TARGET, "ANCHOR"), ("s|w0::a", recovery.OTHER, "ANCHOR")], "key string, speaker_state string, basis string")
    (one,) = topology.merge_turns(spans, turns, anchors, 3000).collect()
    assert (one["span"], one["turn_ids"], one["start"], one["end"], one["text"], one["role"]) == (0, ["t0", "t2000"], 0, 4500, "go to the park, today", "assistant")
    assert difflib.SequenceMatcher(None, "go to the park today".split(), "go to the park today".split()).ratio() >= 0.6
    none = turns.limit(0)
    assert topology.merge_turns(spans, none, anchors, 3000).count() == 0


def test_anchors_with_a_null_state_settle_nothing_and_repeats_count_once(spark):
    rows = spark.createDataFrame([(1, ["a"]), (2, ["n"]), (3, ["n", "n"]), (4, ["a", "n"]), (5, ["a", "gone"]), (6, []), (7, None), (8, ["a", "b"])], "id long, keys array<string>")
    anchors = spark.createDataFrame([("a", recovery.TARGET, "X"), ("a", recovery.TARGET, "X"), ("n", None, "Y"), ("b", recovery.OTHER, "Z")], "key string, speaker_state string, basis string")
    got = {r["id"]: (r["speaker_state"], r["role"], r["basis"]) for r in recovery.anchored_speakers(rows, anchors).collect()}
    none, conflict, open_ = "INSUFFICIENT_IDENTITY_EVIDENCE", "CONFLICTING_WINDOW_LOCAL_CLUSTER_ANCHORS", "INSUFFICIENT_WINDOW_LOCAL_CLUSTER_ANCHORS"
    unsettled = recovery.AMBIGUOUS
    assert got == {
        1: (recovery.TARGET, "assistant", "X"), 2: (unsettled, None, open_), 3: (unsettled, None, open_), 4: (unsettled, None, conflict),
        5: (unsettled, None, conflict), 6: (unsettled, None, none), 7: (unsettled, None, none), 8: (unsettled, None, conflict),
    }


def test_sentinels_are_not_artefacts(spark):
    texts = ["redacted", "Audio  filtered.", "heart", "[music]", "filtered words", ""]
    state = recovery.resolve_target(F.col("t"), F.col("t"), F.lit(1.0), F.lit(True), F.lit(True), F.lit(False), F.lit(9))
    got = [r["s"]["state"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(state.alias("s")).collect()]
    assert got == ["UNRESOLVED", "UNRESOLVED", "AUDIO_CONFIRMED", "AUDIO_CONFIRMED", "AUDIO_CONFIRMED", "UNRESOLVED"]


def test_turns_of_one_part_leave_early_and_held_spans_are_judged_once(spark):
    tokens = make(random.Random(1))
    df = spark.createDataFrame(tokens, f"{TOKEN}, turn_id string, frozen boolean")
    anchors = spark.createDataFrame([("r0|w0::a", recovery.TARGET, "ANCHOR")], "key string, speaker_state string, basis string")
    plan = lambda frame: frame._jdf.queryExecution().optimizedPlan().toString()
    assert "frozen" not in plan(topology.split_turns(df, anchors))  # what comes after the cut reads parts, not all tokens again
    turns = spark.createDataFrame([("r0", "t0", 0.0, 2.0, "a b", False), ("r0", "t1", 2.0, 4.0, "c d", False)], "recording string, turn_id string, start double, end double, text string, frozen boolean")
    merged = topology.merge_turns(topology.candidate_spans(df), turns, anchors, 3)
    assert "token_id" not in plan(merged)  # the spans' tokens are read once, for the spans that are held
