import random

import pytest
from pyspark.sql import functions as F

from colloquy.operators import settle
from colloquy.plans import dedup as plans
from colloquy.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
ROWS = "id string, family string, source string, context array<string>, targets array<string>, anchor string, text string, tokens array<string>"


def holds(long, short):
    return any(long[k : k + len(short)] == short for k in range(len(long) - len(short) + 1))


def plain_provenance(rows, least=8):
    """The decisions one row after the other."""
    out, kept = {}, []
    for r in sorted(rows, key=lambda r: r["id"]):
        source = r["source"] or ""
        whole = [k for k in kept if (k["source"] or "", k["context"] or [], k["targets"] or []) == (source, r["context"] or [], r["targets"] or [])]
        text = [k for k in kept if (k["family"] or "", k["text"] or "") == (r["family"] or "", r["text"] or "") and (k["source"] or "") != source]
        anchor = [k for k in kept if (k["source"] or "", k["anchor"] or "") == (source, r["anchor"] or "")]
        target = [k for k in kept if (k["source"] or "") == source and set(k["targets"] or []) & set(r["targets"] or [])]
        for reason, by in ((settle.PROVENANCE, whole), (settle.SAME_TEXT, text), (settle.ANCHOR, anchor), (settle.TARGET, target)):
            if by:
                out[r["id"]] = (reason, by[-1]["id"])
                break
        else:
            kept.append(r)
            out[r["id"]] = (None, None)
    final = []
    for r in sorted(kept, key=lambda r: (len(r["tokens"] or []), r["id"])):
        tokens = r["tokens"] or []
        by = [k for k in final if (k["family"] or "") == (r["family"] or "") and len(k["tokens"] or []) >= least and (k["source"] or "") != (r["source"] or "") and holds(tokens, k["tokens"])]
        if by:
            out[r["id"]] = (settle.CONTAINMENT, by[0]["id"])
        else:
            final.append(r)
    return out


def plain_global(rows, least=8):
    out, kept = {}, []
    for r in sorted(rows, key=lambda r: r["id"]):
        exact = [k for k in kept if (k["text"] or "") == (r["text"] or "")]
        anchor = [k for k in kept if (k["family"] or "", k["anchor"] or "") == (r["family"] or "", r["anchor"] or "")]
        target = [k for k in kept if set(k["targets"] or []) & set(r["targets"] or [])]
        for reason, by in (("EXACT", exact), ("ANCHOR", anchor), ("TARGET", target)):
            if by:
                out[r["id"]] = (reason, by[-1]["id"])
                break
        else:
            kept.append(r)
            out[r["id"]] = (None, None)
    final = []
    for r in sorted(kept, key=lambda r: (r["family"] or "", len(r["tokens"] or []), r["id"])):
        tokens = r["tokens"] or []
        by = [k for k in final if len(k["tokens"] or []) >= least and holds(tokens, k["tokens"])]
        if by:
            out[r["id"]] = ("CONTAINMENT", by[0]["id"])
        else:
            final.append(r)
    return out


def make(rng, n=160):
    rows = []
    for k in range(n):
        tokens = [rng.choice("ab") for _ in range(rng.randrange(0, 9))]
        rows.append({
            "id": f"i{rng.randrange(10**6):06d}-{k}", "family": rng.choice(["f", "g", "h", None]), "source": rng.choice(["s", "t", "u", None]), "context": rng.choice([None, [], ["x"]]),
            "targets": rng.choice([None, [], [f"t{rng.randrange(70)}"], [f"t{rng.randrange(70)}", f"t{rng.randrange(70)}"]]), "anchor": rng.choice([None, *(f"a{j}" for j in range(60))]),
            "text": " ".join(tokens), "tokens": rng.choice([None, tokens, tokens, tokens]),
        })
    return rows


def got(df):
    return {r["id"]: (r["reason"], r["kept_id"]) for r in df.collect()}


@pytest.mark.parametrize("seed", range(1))
def test_folds_against_plain_ones(spark, seed):
    rows = make(random.Random(seed))
    df = spark.createDataFrame(rows, ROWS).repartition(3).select("*", F.lit(1).alias("rank"), F.lit(2).alias("kind"), F.lit(3).alias("kept"), F.lit(4).alias("order"))
    want, everywhere = plain_provenance(rows, 3), plain_global(rows, 3)
    assert {r for r, _ in want.values()} >= {None, settle.PROVENANCE, settle.ANCHOR, settle.TARGET} and {r for r, _ in everywhere.values()} == {None, "EXACT", "ANCHOR", "TARGET", "CONTAINMENT"}
    assert got(settle.provenance_dedup(df, 3)) == want
    assert got(settle.global_dedup(df, 3)) == everywhere


def test_all_five_reasons_over_a_whole_table(spark):
    rows = [r.asDict() for r in plans.interactions(spark, SF).collect()]
    want = plain_provenance(rows)
    assert {r for r, _ in want.values()} == {None, settle.PROVENANCE, settle.SAME_TEXT, settle.ANCHOR, settle.TARGET, settle.CONTAINMENT}
    assert got(QUERIES["provenance_dedup"](spark, SF)) == want
    everywhere = plain_global(rows)
    assert {r for r, _ in everywhere.values()} == {None, "EXACT", "ANCHOR", "TARGET", "CONTAINMENT"}
    assert got(QUERIES["global_dedup"](spark, SF)) == everywhere


def plain_first_come(lines):
    ranks, taken, kept = sorted({r for r, *_ in lines}), {}, set()
    for rank in ranks:
        own = [((kind, key), part) for r, kind, key, part in lines if r == rank]
        if not any(k in taken and (part is None or taken[k] is None or taken[k] != part) for k, part in own):
            taken.update(own)
            kept.add(rank)
    return kept


@pytest.mark.parametrize("rounds", [1, 50])
def test_long_chains_and_hot_keys(spark, rounds):
    """A chain in which each row conflicts with the next, a key that a third of the rows have, and parts."""
    lines = [(k, 0, str(k), None) for k in range(60)] + [(k, 0, str(k - 1), None) for k in range(1, 60)]
    lines += [(k, 1, "hot", None) for k in range(100, 150)] + [(k, 2, "text", "ab"[k % 2]) for k in range(200, 230)] + [(k, 3, str(k // 3), None) for k in range(195, 240)]
    frame = spark.createDataFrame(lines, "rank long, kind int, key string, part string")
    found = {r["rank"]: (r["kind"], r["kept"]) for r in settle.first_come(frame, max_rounds=rounds).collect()}
    assert {r for r, (kind, _) in found.items() if kind is None} == plain_first_come(lines)
    assert found[59] == (0, 58) and found[149] == (1, 100)
    assert settle.first_come(frame.limit(0)).count() == 0


def test_edges_settle_in_order(spark):
    nodes = spark.createDataFrame([(k,) for k in range(8)], "node long")
    edges = spark.createDataFrame([(0, 1, 0), (1, 2, 1), (0, 3, 0), (2, 3, 2), (3, 4, 3), (5, 6, 5)], "src long, dst long, order long")
    assert {r["node"]: r["kept_by"] for r in settle.settle_edges(nodes, edges).collect()} == {0: None, 1: 0, 2: None, 3: 0, 4: None, 5: None, 6: 5, 7: None}
    assert settle.settle_edges(nodes, edges.limit(0)).where("kept_by is null").count() == 8
