import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from colloquy.operators import evidence, fold, review, splits, states, turns
from colloquy.operators.similarity import longest_run
from colloquy.plans import turns as plans
from colloquy.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TURN = "source_id string, idx long, turn_id string, start_ms long, end_ms long, speaker string, speaker_confidence double, text string"


def usable(text):
    bare = re.sub("[^a-z0-9 ]", "", text.lower())
    bad = re.search(r"\[\s*(music|applause|laughter)\s*\]|<[^>]+>|seekiframe|javascript:", text, re.I)
    return not bad and len(re.findall("[A-Za-z0-9']+", text)) >= 2 and not (len(bare) >= 20 and len(set(bare.split())) <= 3)


def stretches(rows, confidence, shortest):
    out = []
    for source in sorted({r["source_id"] for r in rows}):
        own = sorted((r for r in rows if r["source_id"] == source and r["speaker_confidence"] >= confidence and usable(r["text"])), key=lambda r: (r["start_ms"], r["idx"]))
        for k, first in enumerate(own):
            taken = [first]
            for r in own[k + 1 :]:
                if r["speaker"] != first["speaker"] or r["start_ms"] - taken[-1]["end_ms"] > 2500 or r["end_ms"] - first["start_ms"] > 45_000:
                    break
                taken.append(r)
            if len(taken) >= 2 and shortest <= taken[-1]["end_ms"] - first["start_ms"] <= 60_000:
                out.append((source, first["turn_id"], first["start_ms"], taken[-1]["end_ms"], len(taken), round(sum(r["speaker_confidence"] for r in taken) / len(taken), 4)))
    return sorted(out)


def random_turns(rng):
    rows = []
    for s in range(8):
        at = 0
        for k in range(40):
            at += rng.choice([0, 500, 2500, 2501])
            end = at + rng.choice([1000, 6000, 12_000, 30_000])
            text = rng.choice(["Some words that are usable here", "Two words", "More usable words", "Yet more of them", "one", "[ Music ] la la", "no no no no no no no no no", "a <b> tag here"])
            rows.append({"source_id": f"s{s}", "idx": k, "turn_id": f"s{s}:{k}", "start_ms": at, "end_ms": end, "speaker": rng.choice("AAAAB"), "speaker_confidence": rng.choice([0.71, 0.75, 0.8, 0.85, 0.9]), "text": text})
            at = end - rng.choice([0, 0, 3000])
    return rows


@pytest.mark.parametrize(("confidence", "shortest"), [(0.78, 15_000), (0.72, 12_000)])
def test_growing_windows_against_a_loop(spark, confidence, shortest):
    rows = random_turns(random.Random(shortest))
    got = turns.growing_windows(spark.createDataFrame(rows, TURN), least_confidence=confidence, shortest_ms=shortest)
    want = stretches(rows, confidence, shortest)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 10


def greedy(rows, most):
    """The sure rows first, then the longest, then by id."""
    out = []
    for grp in sorted({r[0] for r in rows}):
        taken = []
        for _, ident, start, end, _ in sorted((r for r in rows if r[0] == grp), key=lambda r: (-r[4], r[2] - r[3], r[1])):
            if len(taken) < most and not any(start < b and a < end for _, a, b in taken):
                taken.append((ident, start, end))
        out += [(grp, ident, k) for k, (ident, _, _) in enumerate(taken, 1)]
    return sorted(out)


def test_clips_and_intervals_against_a_loop(spark):
    timeline = [r.asDict() | {"speaker": r["idx"] // 4} for r in plans._turns(spark, SF).collect()]
    clips = [(s, int(t.rsplit(":", 1)[1]), a, b, c) for s, t, a, b, _, c in stretches(timeline, 0.72, 12_000)]
    assert sorted(tuple(r) for r in QUERIES["review_clips"](spark, SF).collect()) == greedy(clips, 4)
    rng = random.Random(1)
    rows = [(f"g{k % 3}", k, a := rng.randrange(100), a + rng.randrange(1, 30), float(rng.randrange(4))) for k in range(90)]
    frame = spark.createDataFrame(rows, "grp string, id long, start long, end long, weight double")
    assert sorted(tuple(r) for r in fold.greedy_non_overlap(frame, 5).collect()) == greedy(rows, 5)


def test_units_are_cut_at_pauses_and_lengths(spark):
    rows = [("a", 1, 0, 10), ("a", 2, 12, 20), ("a", 3, 25, 30), ("a", 4, 31, 60), ("a", 5, 61, 62), ("b", 6, 0, 1)]
    got = fold.span_units(spark.createDataFrame(rows, "grp string, id long, start long, end long"), gap=5, longest=30, least=3).collect()
    assert sorted(tuple(r) for r in got) == [("a", 0, 0, 20, 2), ("a", 1, 25, 30, 1), ("a", 2, 31, 60, 1)]


def test_overlapping_segments_keep_the_longer_text(spark):
    rows = [("a", 1, 0.0, 5.0, "go on"), ("a", 2, 1.0, 6.0, "please go on now"), ("a", 3, 1.5, 6.0, "go on"), ("a", 4, 5.9, 9.0, "else"), ("b", 5, 0.0, 1.0, "x")]
    got = fold.repeated_segments(spark.createDataFrame(rows, "grp string, id long, start double, end double, text string"), overlap=1.0, drift=2.0).collect()
    assert {r["id"]: r["kept_id"] for r in got} == {1: 2, 2: None, 3: 2, 4: None, 5: None}


def test_longest_run_against_difflib(spark):
    rng = random.Random(6)
    rows = [([rng.choice("abc") for _ in range(rng.randrange(9))], [rng.choice("abc") for _ in range(rng.randrange(9))]) for _ in range(40)]
    got = spark.createDataFrame(rows, "a array<string>, b array<string>").select("a", "b", longest_run(F.col("a"), F.col("b")).alias("n")).collect()
    for r in got:
        best = max((n for n in range(1, 9) for i in range(len(r["a"]) - n + 1) if any(r["b"][j : j + n] == r["a"][i : i + n] for j in range(len(r["b"]) - n + 1))), default=0)
        assert r["n"] == best == difflib.SequenceMatcher(None, r["a"], r["b"], autojunk=False).find_longest_match().size


def filled(counts, share=0.12):
    ranked = sorted(counts, key=lambda f: (-counts[f], f))
    out = dict.fromkeys(counts, "train")
    if len(ranked) < 6:
        return out
    target, slots = max(1, sum(counts.values()) * share), max(2, min(3, len(ranked) // 8))
    for split in ("validation", "sealed"):
        total, mine = 0, 0
        for f in ranked[1:]:
            if out[f] != "train" or mine == slots:
                continue
            if not mine or abs(target - total - counts[f]) <= abs(target - total) or total < 0.55 * target:
                out[f], total, mine = split, total + counts[f], mine + 1
    return out


@pytest.mark.parametrize("seed", range(4))
def test_target_filling_against_a_loop(spark, seed):
    rng = random.Random(seed)
    counts = {f"f{k:02d}": rng.choice([1, 3, 8, 8, 20]) for k in range((5, 7, 20, 40)[seed])}
    frame = spark.createDataFrame(list(counts.items()), "family string, n long")
    got = {r["family"]: r["split"] for r in splits.target_filled_splits(frame, "family").collect()}
    assert got == filled(counts) and (seed == 0 or set(got.values()) == {"train", "validation", "sealed"})


def test_target_splits_of_a_table(spark):
    rows = QUERIES["target_splits"](spark, SF).collect()
    assert {r["family"]: r["split"] for r in rows} == filled({r["family"]: r["n"] for r in rows})


def test_texts_that_stand(spark):
    rows = [("a", None, None), ("a", "b", "MATCH"), (None, "b", "MATCH"), ("a", "b", "BOUNDARY_CHANGE"), (" a ", "", "MISSING_NEW_SPEECH"), ("a", "b", None)]
    frame = spark.createDataFrame(rows, "a string, b string, d string")
    plain, frozen, unheard = (
        [(r["x"]["state"], r["x"]["text"]) for r in frame.select(c.alias("x")).collect()]
        for c in (evidence.resolve_text(F.col("a"), F.col("b"), F.col("d")), evidence.resolve_frozen_text(F.col("a"), F.col("b"), F.col("d"), F.lit(None)), evidence.resolve_frozen_text(F.col("a"), F.lit(None), F.col("d"), F.lit(True)))
    )
    no = ("UNRESOLVED", None)
    assert plain == [("RESOLVED", "a"), ("RESOLVED", "b"), no, no, no, no]
    assert frozen == [("RESOLVED", "a"), ("RESOLVED", "b"), no, no, ("RESOLVED", "a"), no]
    assert unheard == [("RESOLVED", "a"), ("RESOLVED", "a"), no, ("RESOLVED", "a"), ("RESOLVED", "a"), ("RESOLVED", "a")]
    roles = spark.createDataFrame([("user", "T"), (None, "T"), ("system", "T"), ("", "X"), (None, None)], "r string, i string")
    assert [r["x"] for r in roles.select(evidence.role_of_turn(F.col("r"), F.col("i"), ["T"]).alias("x")).collect()] == ["user", "assistant", "assistant", "user", "user"]


def test_runs_side_by_side_keep_the_keys_of_both(spark):
    old = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), ("gone", 1.0)], "k string, v double")
    new = spark.createDataFrame([("a", 4.0), (None, None), ("new", 2.0)], "k string, v double")
    got = {r["k"]: tuple(r)[1:] for r in review.compare_runs(old, new, "k", "v").collect()}
    assert got == {"a": (2, 1, -1, 2.0), None: (1, 1, 0, None), "gone": (1, 0, -1, None), "new": (0, 1, 1, None)}


def test_required_fields(spark):
    rows = spark.createDataFrame([("x", [1], 1), ("", [], 1), (None, None, None)], "a string, b array<int>, c int")
    assert [r[0] for r in rows.select(states.missing_fields(rows, ["a", "b", "c"])).collect()] == [[], ["a", "b"], ["a", "b", "c"]]
    assert states.require_fields(rows.limit(1), ["a", "b", "c"]).count() == 1
    with pytest.raises(Exception, match="missing required fields: a, b"):
        states.require_fields(rows, ["a", "b"]).collect()
