import itertools
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from colloquy.functions import stats as S
from colloquy.functions import text as T
from colloquy.operators import dedup, fold, joins, splits, turns, windows
from colloquy.operators.families import capped_merge
from colloquy.operators.graph import connected_components
from colloquy.plans import registry
from colloquy.sources import artifacts


def turn(idx, identity, start, end, text, **more):
    row = {"source_id": "s", "idx": idx, "turn_id": f"t{idx}", "speaker": identity, "identity": identity, "start_ms": start, "end_ms": end, "text": text,
           "speaker_confidence": 0.9, "suspicious_transcription": False, "event_boundary": False, "asr_quality": "PASS"}
    return row | more


def test_seed_is_one_target_with_its_context(spark):
    rows = [turn(0, "NON_TARGET", 0, 2000, "What comes next?"), turn(1, "TARGET_HIGH", 2500, 4000, "A walk."), turn(2, "TARGET_HIGH", 5000, 6500, "The park."), turn(3, "TARGET_HIGH", 7500, 9000, "I am ready.")]
    got = turns.seeds(spark.createDataFrame(rows)).collect()
    assert [(r["context_turn_ids"], r["target_turn_id"]) for r in got] == [("t0", "t1")]


def test_suspicious_context_breaks_the_episode(spark):
    rows = [turn(0, "NON_TARGET", 0, 2000, "What comes next?", suspicious_transcription=True), turn(1, "TARGET_HIGH", 2500, 4000, "A walk.")]
    assert turns.seeds(spark.createDataFrame(rows)).count() == 0


def test_natural_turns_stop_at_45_seconds(spark):
    rows = [turn(k, "A", k * 1000, k * 1000 + 900, "word") for k in range(3)] + [turn(3, "A", 4000, 90_000, "long one")]
    got = turns.natural_turns(spark.createDataFrame(rows)).orderBy("turn").collect()
    assert [r["segments"] for r in got] == [3, 1] and got[1]["turn_boundary"] == "length_limit"


def test_components_against_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    got = connected_components(spark.createDataFrame(edges, "src long, dst long"))
    assert {r["node"]: r["component"] for r in got.collect()} == want


def test_components_of_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_overlap_join_against_all_pairs(spark):
    rng = random.Random(1)
    spans = [(k, a := rng.randrange(1000), a + rng.randrange(1, 90)) for k in range(80)]
    left = spark.createDataFrame([("k", *s) for s in spans], "g string, id long, start long, end long")
    right = left.select("g", F.col("id").alias("other"), F.col("start").alias("start_r"), F.col("end").alias("end_r"))
    got = {(r["id"], r["other"]) for r in joins.overlap_join(left, right, ["g"], 50).collect()}
    assert got == {(a[0], b[0]) for a, b in itertools.product(spans, spans) if a[1] < b[2] and b[1] < a[2]}


def test_sliding_windows_stop_when_one_reaches_the_end(spark):
    rows = spark.createDataFrame([("s", k) for k in range(36)], "g string, k long")
    starts = lambda past: sorted(r[0] for r in windows.sliding_windows(rows, ["g"], ["k"], 20, 16, 4, past).select("start").distinct().collect())
    assert starts(False) == [0, 16] and starts(True) == [0, 16, 32]


@pytest.mark.parametrize("k, n, low, high", [(0, 10, 0.0, 0.2775), (10, 10, 0.7225, 1.0)])
def test_wilson(spark, k, n, low, high):
    a, b = S.wilson(F.lit(k), F.lit(n))
    got = spark.range(1).select(a, b).first()
    assert abs(got[0] - low) < 1e-3 and abs(got[1] - high) < 1e-3


def test_ranked_value_rounds_half_to_even(spark):
    rows = spark.createDataFrame([("a", float(v)) for v in range(6)] + [("a", None), ("a", float("nan"))], "g string, v double")
    assert S.ranked_value(rows, ["g"], "v", 0.5).first()["v"] == 2.0
    assert S.ranked_value(rows, ["g"], "v", 0.5, "floor").first()["v"] == 2.0


def test_containment_keeps_the_earlier(spark):
    rows = spark.createDataFrame([("g", 1, "a b c".split()), ("g", 2, "x a b c y".split()), ("g", 3, "c b".split())], "g string, id long, t array<string>")
    assert [tuple(r) for r in dedup.contained_rows(rows, ["g"], "id", "t").collect()] == [(2, 1)]


def test_containment_against_all_pairs_and_meets_on_rare_tokens(spark, monkeypatch):
    rng = random.Random(3)
    frame = [(rng.choice("gh"), k, [rng.choice("abc") for _ in range(rng.randrange(0, 9))]) for k in range(120)]
    pad = lambda t: f" {' '.join(t)} "
    want = {}
    for (g, x, a), (h, y, b) in itertools.combinations(frame, 2):
        if g == h and a and b and (pad(a) in pad(b) or pad(b) in pad(a)):
            want[y] = min(x, want.get(y, x))
    schema = "g string, id long, t array<string>"
    assert {r["removed_id"]: r["kept_id"] for r in dedup.contained_rows(spark.createDataFrame(frame, schema), ["g"], "id", "t").collect()} == want
    compared = spark.sparkContext.accumulator(0)

    def hold(long, short):
        @F.udf("boolean")
        def f(a, b):
            compared.add(1)
            return pad(b) in pad(a)

        return f(long, short)

    monkeypatch.setattr(dedup.T, "contains_run", hold)
    same_start = spark.createDataFrame([("g", k, ["the", f"w{k}", *["x"] * (k % 7)]) for k in range(60)], schema)
    assert dedup.contained_rows(same_start, ["g"], "id", "t").count() == 0 and compared.value == 0


@pytest.mark.parametrize("long", ["", "a common beginning "])
def test_prefix_pairs_past_a_sibling(spark, long):
    rows = [("g", 1, long + "A"), ("g", 2, long + "A b"), ("g", 3, long + "A c"), ("g", 4, long + "A c d"), ("g", 5, long + "A"), ("h", 6, long + "A b c"), (None, 7, long + "A"), (None, 8, long + "A c"), ("g", 9, "")]
    got = dedup.prefix_pairs(spark.createDataFrame(rows, "g string, id long, v string"), ["g"], "id", "v").collect()
    assert sorted(map(tuple, got)) == [(1, 5), (3, 4), (5, 2), (5, 3), (7, 8)]


def test_containment_fold_is_idempotent_and_ignores_order(spark):
    texts = ["one two three four five", "zero one two three four five six", "a b c d e f", "b c d e f", "short"]
    frame = [("g", k, t.split()) for k, t in enumerate(texts)]
    run = lambda x: {r["id"]: r["kept_id"] for r in fold.containment_fold(spark.createDataFrame(x, "grp string, id long, tokens array<string>")).collect()}
    got = run(frame)
    assert got == run(frame[::-1]) == {0: None, 1: 0, 2: 3, 3: None, 4: None}
    assert set(run([f for f in frame if got[f[1]] is None]).values()) == {None}


def test_containment_fold_against_the_fold_in_order(spark):
    rng = random.Random(2)
    frame = [(rng.choice("gh"), k, [rng.choice("ab") for _ in range(rng.randrange(2, 14))]) for k in range(150)]
    want, kept = {}, []
    for grp, ident, tokens in sorted(frame, key=lambda r: (len(r[2]), r[1])):
        holds = [(next(i for i in range(len(tokens)) if tokens[i : i + 3] == t[:3]), len(t), k) for g, k, t in kept if g == grp and f" {' '.join(t)} " in f" {' '.join(tokens)} "]
        want[ident] = min(holds)[2] if holds and len(tokens) >= 5 else None
        if len(tokens) >= 5 and not holds:
            kept.append((grp, ident, tokens))
    got = fold.containment_fold(spark.createDataFrame(frame, "grp string, id long, tokens array<string>")).collect()
    assert {r["id"]: r["kept_id"] for r in got} == want and len(got) == 150


def test_ordered_fold_dedup_compares_all_of_a_source_and_language(spark, tmp_path):
    texts = [(1, "one two three four five", "en"), (2, "a text that opens otherwise: one two three four five", "en"), (3, "other words: one two three four five", "fr")]
    rows = spark.createDataFrame([(k, t, lang, "s", len(t)) for k, t, lang in texts], "doc_id long, text string, lang string, source string, n_chars long")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["id"]: r["kept_id"] for r in registry.QUERIES["ordered_fold_dedup"](spark, str(tmp_path)).collect()} == {1: None, 2: 1, 3: None}


def test_capped_merge_leaves_a_bridge(spark):
    edges = spark.createDataFrame([(1, 2, 5, 90.0), (2, 3, 4, 90.0), (8, 9, 1, 10.0)], "a long, b long, pairs long, overlap double")
    assert {(r["a"], r["b"]): r["state"] for r in capped_merge(edges, 2).collect()} == {(1, 2): "MERGED", (2, 3): "BRIDGE", (8, 9): "MERGED"}


def test_sealed_lineage_is_inherited_and_conflicts_show(spark):
    members = spark.createDataFrame([("f1", "A"), ("f1", "B"), ("f1", "C"), ("f2", "D"), ("f2", "E"), ("f3", "X")], "root string, member string")
    authority = spark.createDataFrame([("A", "sealed"), ("B", "sealed"), ("D", "train"), ("E", "sealed")], "member string, split string")
    got = {r["root"]: (r["split"], r["conflict"]) for r in splits.inherit_splits(members, authority).collect()}
    assert got == {"f1": ("sealed", False), "f2": ("sealed", True), "f3": (None, False)}


@pytest.mark.parametrize("old, new, want", [("a b", "a b", "MATCH"), ("a b c d", "a b c", "MINOR"), ("", "a", "MISSING_OLD"), ("a", "", "MISSING_NEW"), ("a b", "c d", "MAJOR"), ("", "", "MATCH")])
def test_disagreement(spark, old, new, want):
    assert spark.range(1).select(T.disagreement(F.lit(old), F.lit(new))).first()[0] == want


def test_status_merge_only_rises(spark):
    schema = "id long, status string, notes array<string>"
    old = spark.createDataFrame([(1, "complete", ["a"]), (2, "queued", [])], schema)
    new = spark.createDataFrame([(1, "queued", ["b"]), (2, "running", None), (3, "queued", ["c"])], schema)
    got = {r["id"]: (r["status"], r["notes"]) for r in joins.status_merge(old, new, "id", {"status": ["queued", "running", "complete"]}, ["notes"]).collect()}
    assert got == {1: ("complete", ["a", "b"]), 2: ("running", []), 3: ("queued", ["c"])}


def test_redact_drops_fields_at_any_depth(spark):
    rows = spark.createDataFrame([(1, ("x", "secret"), [("y", "secret")])], "id int, a struct<k:string,text:string>, b array<struct<k:string,text:string>>")
    assert artifacts.redact(rows, {"text"}).schema.simpleString() == "struct<id:int,a:struct<k:string>,b:array<struct<k:string>>>"


def test_merge_fragments(spark):
    rows = pd.DataFrame({"grp": ["g"] * 3, "id": [1, 2, 3], "start": [0.0, 1.1, 9.0], "end": [0.8, 1.8, 9.5], "cluster": ["c"] * 3, "text": ["and then", "we left.", "Later"]})
    got = fold.merge_fragments(spark.createDataFrame(rows)).collect()
    assert [(r["first_id"], r["text"], r["n"]) for r in got] == [(1, "and then we left.", 2), (3, "Later", 1)]


def test_metadata_key_rounds_halves_to_even(spark, tmp_path):
    rows = [(k, "Same Text", "en", "s", n) for k, n in enumerate([45, 60, 75, 15, 0])]  # 1.5, 2 and 2.5 are 2, 0.5 and 0 are 0
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["size"], r["n"]) for r in registry.QUERIES["metadata_key"](spark, str(tmp_path)).collect()}
    assert got == {(2, 3), (0, 2)}


def test_prefix_pairs_against_plain_loops_and_send_no_text_for_each_length(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 12))) for _ in range(150)]
    texts += [t + rng.choice(["", " more", " \U0001f600", "x" * 40]) for t in texts[:80]]
    frame = [(rng.choice(["g", "h", None]), k, t) for k, t in enumerate(texts)]
    want = set()
    for g, k, t in frame:
        own = [(len(s), j) for h, j, s in frame if h == g and t.startswith(s) and (len(s) < len(t) or j < k)]
        want |= {(max(own)[1], k)} if own else set()
    df = spark.createDataFrame(frame, "g string, id long, v string")
    got = dedup.prefix_pairs(df, ["g"], "id", "v")
    assert {tuple(r) for r in got.collect()} == want and len(want) > 100
    assert "startswith" not in got._jdf.queryExecution().executedPlan().toString().lower()  # no text is carried along for each length to be compared


def test_containment_fold_groups_no_texts(spark):
    frame = [("g", 1, "a b c d e".split()), ("g", 2, "z a b c d e".split()), ("g", 3, "a b c d e".split()), (None, 4, "a b c d e".split())]
    got = fold.containment_fold(spark.createDataFrame(frame, "grp string, id long, tokens array<string>"))
    assert {r["id"]: r["kept_id"] for r in got.collect()} == {1: None, 2: 1, 3: 1, 4: None}
    assert "hashpartitioning(grp" not in got._jdf.queryExecution().executedPlan().toString()  # copies meet by name, not by their tokens
