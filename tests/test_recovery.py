import collections
import difflib
import hashlib
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import recovery, review
from colloquy.operators.similarity import sequence_ratio
from colloquy.plans import recovery as plans
from colloquy.plans.base import QUERIES
from colloquy.sources import artifacts
from tests.oracle import connect

SF = "/root/testdata/sf0.001"


def holds(a, b):
    return bool(b) and any(a[k : k + len(b)] == b for k in range(len(a) - len(b) + 1))


def plain_dedup(rows):
    """The decisions of recovery_dedup() one row after the other."""
    kept, out = [], {}
    for r in sorted(rows, key=lambda r: (not r["baseline"], r["id"])):
        target = next((k for k in kept if k["target"] == r["target"]), None)
        same = next((k for k in kept if r["interaction"] is not None and k["interaction"] == r["interaction"]), None)
        ladder = next((k for k in kept if k["grp"] == r["grp"] and k["tokens"] != r["tokens"] and (holds(k["tokens"], r["tokens"]) or holds(r["tokens"], k["tokens"]))), None)
        for reason, by in (("TARGET_REUSE", target), ("SAME_INTERACTION_DUPLICATE", same), ("PREFIX_LADDER", ladder)):
            if by is not None:
                out[r["id"]] = (reason, by["id"])
                break
        else:
            kept.append(r)
            out[r["id"]] = (None, None)
    return out


def test_recovery_dedup_against_a_plain_fold(spark):
    rng = random.Random(11)
    rows = [
        {"id": f"s{k:03d}", "baseline": rng.random() < 0.3, "target": f"t{rng.randrange(60)}", "interaction": rng.choice([None, *(f"i{j}" for j in range(40))]),
         "grp": f"g{rng.randrange(4)}", "tokens": [rng.choice("abc") for _ in range(rng.randrange(0, 6))]}
        for k in range(120)
    ]
    frame = spark.createDataFrame(rows, "id string, baseline boolean, target string, interaction string, grp string, tokens array<string>")
    got = {r["id"]: (r["reason"], r["kept_id"]) for r in recovery.recovery_dedup(frame).collect()}
    assert got == plain_dedup(rows) and {r for r, _ in got.values()} == {None, "TARGET_REUSE", "SAME_INTERACTION_DUPLICATE", "PREFIX_LADDER"}
    assert recovery.recovery_dedup(frame.limit(0)).count() == 0
    table = [r.asDict() for r in plans.recovery_rows(spark, SF).collect()]
    assert {r["id"]: (r["reason"], r["kept_id"]) for r in QUERIES["recovery_dedup"](spark, SF).collect()} == plain_dedup(table)


def test_text_similarity_against_difflib(spark):
    pairs = [("", ""), ("a b c", ""), ("a b c d", "a b d"), ("x y", "y x"), ("one two three", "four five")]
    rows = spark.createDataFrame(pairs, "a string, b string")
    ratio = sequence_ratio(T.tokens(F.col("a")), T.tokens(F.col("b")))
    for r in rows.select("a", "b", recovery.text_similarity(F.col("a"), F.col("b"), ratio).alias("s")).collect():
        a, b = r["a"].split(), r["b"].split()
        union = set(a) | set(b)
        sets = len(set(a) & set(b)) / len(union) if union else 1.0
        want = 1.0 if not union else 0.0 if not a or not b else max(difflib.SequenceMatcher(a=a, b=b, autojunk=False).ratio(), sets)
        assert abs(r["s"] - want) < 1e-9


def test_filled_splits_against_a_plain_fold(spark):
    rng = random.Random(5)
    counts = {f"f{k}": rng.randrange(1, 40) for k in range(40)}
    rows = spark.createDataFrame(list(counts.items()), "family string, n long")
    got = {r["family"]: r["split"] for r in review.filled_splits(rows, "family").collect()}
    ranked = sorted(counts, key=lambda f: (-counts[f], f))
    total, filled, want = sum(counts.values()), {"sealed": 0, "validation": 0}, dict.fromkeys(counts, "train")
    for f in sorted(ranked[2:], key=lambda f: hashlib.sha256(f"split-v1|{f}".encode()).hexdigest()):
        free = [s for s in filled if filled[s] < 0.08 * total]
        if not free:
            break
        s = min(free, key=lambda s: (filled[s], s))
        want[f] = s
        filled[s] += counts[f]
    assert got == want and set(got.values()) == {"train", "validation", "sealed"}
    assert {r["split"] for r in review.filled_splits(rows.limit(5), "family").collect()} == {"train"}
    assert review.filled_splits(rows.limit(0), "family").count() == 0


def test_unicode_norm_against_unicodedata(spark):
    texts = ["Ｆｕｌｌ　Width", "Straße ﬁne", "½ a_b-c.d!", None, "  "]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.norm_unicode(F.col("t")).alias("n")).collect()
    for r in rows:
        assert r["n"] == " ".join(re.sub(r"[^\w\s.-]", " ", unicodedata.normalize("NFKC", r["t"] or "").casefold()).split())


def test_a_bad_line_stops_the_strict_reader(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n{"a": 2\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        artifacts.read_jsonl(spark, str(tmp_path), "a long").collect()
    assert artifacts.read_jsonl(spark, str(tmp_path), "a long", strict=False).count() == 1


def test_every_query_finds_rows(spark):
    """A query that finds nothing compares nothing."""
    con = connect("/root/testdata/sf0.01")
    from colloquy.plans.base import ORACLES

    names = ["recovery_dedup", "context_sufficiency", "anchored_speakers", "span_reconciliation", "target_resolution", "turn_reconciliation"]
    for name in names[1:]:
        column = "speaker_state" if name == "anchored_speakers" else "state"
        kinds = collections.Counter(x for (x,) in con.execute(f"SELECT {column} FROM ({ORACLES[name]})").fetchall())
        assert len(kinds) > 1, name


def test_bootstrap_against_plain_draws(spark):
    from colloquy.operators.resampling import poisson_bootstrap, poisson_times

    rng = random.Random(4)
    data = [(k, rng.choice(["a", "b", None]), rng.random() if k % 9 else None) for k in range(300)]
    rows = spark.createDataFrame(data, "id long, g string, v double")
    keys = {r["id"]: r["k"] for r in rows.select("id", F.xxhash64("id").alias("k")).collect()}
    for r in poisson_bootstrap(rows, "g", "id", "v", draws=100).collect():
        own = [(keys[k], v) for k, g, v in data if g == r["g"] and v is not None]
        times = poisson_times(np.array([k for k, _ in own], np.int64), 100)
        means = (times * np.array([v for _, v in own])[:, None]).sum(axis=0) / times.sum(axis=0)
        low, high = np.quantile(means, [0.025, 0.975])
        assert abs(r["low"] - low) < 1e-5 and abs(r["high"] - high) < 1e-5 and r["low"] < r["mean"] < r["high"]


def test_components_with_hubs_apart(spark, monkeypatch):
    """A star of 400 edges, a chain and a second star: hubs' edges take the broadcast way."""
    from colloquy.operators import graph

    monkeypatch.setattr(graph, "HUBS_FROM", 0)
    edges = [(5000, k) for k in range(1, 401)] + [(k, k + 1) for k in range(6000, 6020)] + [(7000, 7000 + k) for k in range(1, 301)] + [(7100, 6010)]
    got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    want = {5000: 1, **dict.fromkeys(range(1, 401), 1), **dict.fromkeys([*range(6000, 6021), *range(7000, 7301)], 6000)}
    assert got == want


def test_noise_in_a_gap_of_just_the_limit_makes_it_no_longer(spark):
    """12.3 - 10.3 is a little more than 2 in doubles."""
    schema = "context array<struct<id:string,role:string,state:string,text:string,end:double>>, text string, start double"
    rows = [([("u", "user", "SETTLED", "what is it", end)], "it is so", start) for end, start in [(10.3, 12.3), (10.3, 12.301)]]
    judged = recovery.context_sufficiency(F.col("context"), F.col("text"), F.col("start"), 2.0)
    got = [r["reason"] for r in spark.createDataFrame(rows, schema).coalesce(1).select(judged.alias("j")).select("j.reason").collect()]
    assert got == ["VISIBLE_IMMEDIATE_USER_TRIGGER", "LARGE_PRE_TARGET_GAP"]
