import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from colloquy.llm import repair

TURNS = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")


def brute(rows):
    """Cost, audit and text of the cheapest repair of [(role, text, fault)], by trying all edits."""
    best = []

    def go(i, cost, audit, said):
        if cost > 4 * len(rows) + 6 or len(audit) > 2 * len(rows) + 3:
            return
        firsts = "".join(r[:1] for r, _ in said)
        if i == len(rows) and LEGAL.fullmatch(firsts):
            best.append((cost, audit, "\n".join(f"{r}:{t}" for r, t in said)))
        if not any(LEGAL.fullmatch(firsts + more) for more in ("", "a", "ua")):
            return
        for new in ("user", "assistant"):
            go(i, cost + 3, audit + "I", [*said, (new, "")])
        if i < len(rows):
            role, text, fault = rows[i]
            go(i + 1, cost + 4, audit + "D", said)
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1]:
                    go(i + 1, cost + more, audit + "K", [*said, (role, text)])
                for new in ("user", "assistant"):
                    go(i + 1, cost + 3 + more, audit + "R", [*said, (new, text)])

    go(0, 0, "", [])
    return min(best)


@pytest.mark.parametrize("n", range(5))
def test_cheapest_repair(n):
    rng = random.Random(n)
    kinds = list(itertools.product(("user", "assistant", "system", "tool", ""), ("", "blank", "duplicate", "truncated")))
    cases = itertools.product(kinds, repeat=n) if n < 2 else ([rng.choice(kinds) for _ in range(n)] for _ in range(60))
    for case in cases:
        rows = [(role, f"t{k}", fault) for k, (role, fault) in enumerate(case)]
        one = repair.Repair(held=4)
        for row in rows:
            one.add(*row)
        cost, audit, said = brute(rows)
        assert one.end() == (cost, audit, hashlib.sha256(said.encode()).hexdigest())


def plain(rows):
    """The whole contract over [(conv_id, turn, role, text)], conversation by conversation."""
    convs = {}
    for conv, turn, role, text in rows:
        shown = [" " if x is None else x for x in (conv, turn, role, text)]
        kept = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", shown[3]) if kind == 2 else shown[3]
        kept += [(turn, "user" if kind == 4 else shown[2], text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, counts, one = set(), dict.fromkeys(repair.FAULTS, 0), repair.Repair()
        for _, role, text in kept:
            bare = text.strip(" \t\n\v\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            counts[fault] += 1
            one.add(role, text, fault)
        turns = {r[0] for r in kept} - {None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(counts[f] for f in repair.FAULTS[1:]), illegal, *one.end())
    return out


def found(df):
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in df.collect()}


def marked(df):
    return repair.find_faults(repair.damage_conversations(df))


def test_odd_rows_ties_and_batches(spark):
    rng = random.Random(1)
    texts = ["Yes.", "No", "", None, " \n", "Why?  ", "a" * 50_000 + ".", "b" + " " * 200_000 + "c", "Ça va!"]
    rows = [
        (rng.choice([1, 2, 3, None, 2**60 + 1]), rng.choice([None, 0, 1, 2, 5, 9]), rng.choice(["user", "assistant", "system", None, "", "tool"]), rng.choice(texts))
        for _ in range(150)
    ]
    rows += [(77, t, "user", "Gone.") for t in range(2000) if zlib.crc32(f"77:{t}".encode()) % 20 == 0][:3]
    df = spark.createDataFrame(rows, TURNS).repartition(5).select("*", F.lit(3).alias("cost"), F.lit("x").alias("fault"), F.lit(True).alias("gone"), F.lit(0).alias("copy"))
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = found(repair.repair_conversations(marked(df), held=8))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert got == plain(rows)
    assert got[77] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found(repair.repair_conversations(marked(df.limit(0)))) == {}


def test_giant_conversation(spark):
    turns = spark.range(60_000).select(
        F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("Turn "), F.col("id") % 50_000, F.lit(".")).alias("text"),
    )
    rows = [tuple(r) for r in turns.collect()]
    assert found(repair.repair_conversations(marked(turns), held=4096)) == plain(rows)


def test_repaired_turns_have_the_digest(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Yes.", "No", "Why?", "", f"{t}!"])) for c in range(30) for t in range(rng.randrange(1, 12))]
    turns = marked(spark.createDataFrame(rows, TURNS)).cache()
    repairs = repair.repair_conversations(turns)
    said = {}
    for r in sorted(repair.repaired_turns(turns, repairs).collect(), key=lambda r: (r["conv_id"], r["place"])):
        said.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
        assert (r["turn"] is None) == (r["edit"] == "I")
    for r in repairs.collect():
        lines = said.get(r["conv_id"], [])
        assert LEGAL.fullmatch("".join(x[0] for x, _ in lines))
        assert r["repaired_sha256"] == hashlib.sha256("\n".join(f"{x}:{t}" for x, t in lines).encode()).hexdigest()
