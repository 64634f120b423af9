"""The ledger of near pairs against a loop over all pairs."""

import difflib
import itertools
import random

import pytest

from colloquy.operators.redundancy import near_duplicate_ledger

SCHEMA = "id long, family string, source string, start_ms long, end_ms long, context array<string>, target array<string>, target_ids array<string>, original boolean, context_size int, tokens int"


def random_rows(seed, n=70):
    rng = random.Random(seed)
    words = "amber basket candle dune ember forest garden harbour island".split()
    out = []
    for k in range(n):
        context, target = [rng.choice(words) for _ in range(rng.randint(1, 6))], [rng.choice(words) for _ in range(rng.randint(1, 5))]
        if out and rng.random() < 0.6:
            context, target = list(rng.choice(out)[5] or []), list(rng.choice(out)[6] or [])
            context, target = (lambda r: (list(r[5] or []), list(r[6] or [])))(rng.choice(out))
            if rng.random() < 0.7:
                part = rng.choice([context, target])
                part.insert(rng.randint(0, len(part)), rng.choice(words))
        at = rng.choice([None, *range(0, 5000, 100)])
        out.append((k, rng.choice(["f", "g", None]), rng.choice(["s", "t", None]), at, None if at is None else at + 150, context, target, rng.choice([None, [], [f"t{rng.randint(0, 30)}"]]), rng.random() < 0.3, rng.randint(0, 3), 1))
    return [*out, (900, "f", "s", 0, 9, None, None, None, None, None, 1), (901, "f", "s", 0, 9, [], [], [], None, None, 1)]


def ratio(a, b):
    a, b = " ".join(a), " ".join(b)
    return difflib.SequenceMatcher(None, a, b).ratio() if a and b else 0.0


def plain(rows, most):
    rank = lambda r: (0 if r[8] else 1, r[9] or 0, r[0])
    rows = [r for r in rows if r[1] and (r[5] or []) + (r[6] or [])]
    tokens = {r[0]: (r[5] or []) + (r[6] or []) for r in rows}
    best, found = {}, {}
    for r in sorted(rows, key=rank):
        first = best.setdefault((r[1], *tokens[r[0]]), r)
        if first is not r:
            found[r[0]] = (first[0], "COPY")
    left = [r for r in rows if r[0] not in found]
    cut = lambda t: {tuple(t[k : k + 3]) for k in range(max(1, len(t) - 2))}
    keys = {r[0]: cut(tokens[r[0]]) | ({("target", *r[6])} if r[6] else set()) for r in left}
    many = {(f, k): sum(k in keys[r[0]] for r in left if r[1] == f) for f in "fg" for k in set().union(*keys.values())}
    loses = {}
    for p, q in itertools.combinations(sorted(left, key=rank), 2):
        a, b = tokens[p[0]], tokens[q[0]]
        if p[1] != q[1]:
            continue
        s, t = sorted([a, b], key=len)
        held = len(s) / len(t) if any(t[k : k + len(s)] == s for k in range(len(t) - len(s) + 1)) else 0
        alike = len(set(a) & set(b)) / len(set(a) | set(b))
        met = any(many[p[1], k] <= most for k in keys[p[0]] & keys[q[0]])
        if not (met or held or alike >= 0.7) or max(held, alike) < 0.7 and max(ratio(*x) for x in ((a, b), (b, a))[: 1 if p[0] < q[0] else 2][-1:]) < 0.7:
            continue
        over = None not in (p[3], q[3]) and min(p[4], q[4]) > max(p[3], q[3])
        x, y = sorted([p, q])
        ts, cs = ratio(x[6], y[6]), ratio(x[5], y[5])
        reason = "SAME_RECORDING" if held >= 0.9 or set(p[7] or []) & set(q[7] or []) or over else "MIRROR" if p[2] != q[2] and (ts >= 0.9 and cs >= 0.55 or ts >= 0.7 and cs >= 0.8) else None
        if reason and q[0] not in loses:
            loses[q[0]] = (p[0], reason)
    return found | loses


@pytest.mark.parametrize("seed, most", [(1, 500), (2, 500), (3, 3)])
def test_near_duplicate_ledger(spark, seed, most):
    rows = random_rows(seed)
    want = plain(rows, most)
    got = {r.removed_id: (r.kept_id, r.reason) for r in near_duplicate_ledger(spark.createDataFrame(rows, SCHEMA), most).collect()}
    assert got == want
    assert {r for _, r in want.values()} == {"COPY", "SAME_RECORDING", "MIRROR"}


def test_nothing_is_redundant_in_an_empty_table(spark):
    assert near_duplicate_ledger(spark.createDataFrame([], SCHEMA)).count() == 0
