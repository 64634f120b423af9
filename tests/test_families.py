import collections
import hashlib
import random

import pytest

from colloquy.operators import families
from colloquy.plans import graphs
from colloquy.plans.registry import QUERIES

EDGES = "a long, b long, pairs long, overlap double"


def fold(edges, most):
    """The states edge by edge, and each node's family."""
    family = {}
    states = {}
    for a, b, pairs, overlap in sorted(edges, key=lambda e: (-e[2], -e[3], e[0], e[1])):
        x, y = family.setdefault(a, {a}), family.setdefault(b, {b})
        if x is y:
            states[a, b] = "SAME"
        elif len(x) + len(y) > most:
            states[a, b] = "BRIDGE"
        else:
            x |= y
            family.update(dict.fromkeys(y, x))
            states[a, b] = "MERGED"
    return states, {n: "rf_" + hashlib.sha256("|".join(map(str, sorted(f))).encode()).hexdigest()[:16] for n, f in family.items()}


def graph(seed):
    rng = random.Random(seed)
    pairs = {tuple(sorted(rng.sample(range(150), 2))) for _ in range(260)}  # one giant component
    pairs |= {(0, k) for k in range(1, 60)} | {(k, k + 1) for k in range(1000, 1050)} | {(2000, 2001)}  # a hub, a path whose edges rank in order, a pair
    return [(a, b, 1 if a >= 1000 else rng.randrange(1, 6), 5.0 if a >= 1000 else float(rng.randrange(3))) for a, b in pairs]


@pytest.mark.parametrize(("seed", "rounds"), [(1, 16), (3, 1)])
def test_capped_merge_equals_the_fold(spark, seed, rounds):
    edges = graph(seed)
    states, named = fold(edges, 8)
    out = families.capped_merge(spark.createDataFrame(edges, EDGES), 8, rounds).collect()
    assert {(r["a"], r["b"]): r["state"] for r in out} == states and len(out) == len(edges)
    assert collections.Counter(states.values()).keys() == {"MERGED", "SAME", "BRIDGE"}


def test_families_and_exclusions(spark):
    edges = graph(5)
    states, named = fold(edges, 8)
    frame = spark.createDataFrame([(*k, s) for k, s in states.items()], "a long, b long, state string")
    assert {r["node"]: r["family_id"] for r in families.merged_families(frame).collect()} == named
    want = {(a, b, named[a], named[b]) for (a, b), s in states.items() if s == "BRIDGE"}
    assert {tuple(r) for r in families.split_exclusions(frame).collect()} == want
    assert families.capped_merge(spark.createDataFrame([], EDGES), 8).count() == 0


def test_capped_families_of_a_table(spark):
    sf = "/root/testdata/sf0.001"
    edges = [tuple(r) for r in graphs.family_strength(spark, sf).where("aggregate or ultra").select("a", "b", "pairs", "overlap").collect()]
    states, named = fold(edges, 8)
    assert {(r["a"], r["b"]): r["state"] for r in QUERIES["capped_families"](spark, sf).collect()} == states
    assert {(r["a"], r["b"], r["family_a"]) for r in QUERIES["split_exclusions"](spark, sf).collect()} == {(a, b, named[a]) for (a, b), s in states.items() if s == "BRIDGE"}
