"""Near pairs of one family, and which row of a pair is redundant."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators.dedup import contained_runs
from colloquy.operators.similarity import jaccard_join, side_by_side
from colloquy.session import Scratch

NEAR = 0.7


def text_ratio(a: Column, b: Column, least: float = 0.0) -> Column:
    """Ratcliff-Obershelp ratio of two strings, characters that are common in a long one being no anchors; 0 if either is empty or null, or if the ratio is below least."""

    def one(x: str | None, y: str | None) -> float:
        if not x or not y or 2 * min(len(x), len(y)) < least * (len(x) + len(y)):
            return 0.0
        found = difflib.SequenceMatcher(None, x, y)
        ratio = found.ratio() if not least or found.quick_ratio() >= least else 0.0
        return ratio if ratio >= least else 0.0

    return F.pandas_udf(lambda v, w: pd.Series(list(map(one, v, w)), dtype="float64"), "double")(a, b)


def near_candidates(rows: DataFrame, size: int = 3, most: int = 500) -> DataFrame:
    """(family, a, b), a < b: rows (family, id, tokens, target) of a family that share a run of size tokens or all of a target.

    A run or target that more than most rows of its family have makes no pairs by itself, so that pairs grow at most with most times the rows. Pairs of which one stands in the
    other, or whose sets of tokens overlap by NEAR, are found in an exact way however common their runs are. Fewer than size tokens are one run; rows without tokens meet nothing.
    """
    rows = rows.where(F.size("tokens") > 0)
    count = F.greatest(F.size("tokens") - size + 1, F.lit(1))
    runs = F.transform(F.sequence(F.lit(1), count), lambda k: F.xxhash64(F.slice("tokens", k, size)))
    keys = F.array_distinct(F.concat(runs, F.when(F.size("target") > 0, F.array(F.xxhash64(F.lit("target"), F.col("target")))).otherwise(F.array().cast("array<bigint>"))))
    each = rows.select("family", "id", F.explode(keys).alias("_key"))
    shared = each.groupBy("family", "_key").agg(F.count("*").alias("_n")).where(F.col("_n").between(2, most))
    kept = each.join(shared.drop("_n"), ["family", "_key"])
    # Rows that go on alike share run after run, so runs of the same rows are one before there are pairs; no run has more than most rows.
    sets = kept.groupBy("family", "_key").agg(F.array_sort(F.collect_list("id")).alias("ids")).select("family", "ids").distinct()
    met = sets.select("family", "ids", F.explode("ids").alias("a")).select("family", "a", F.explode(F.filter("ids", lambda b: b > F.col("a"))).alias("b")).distinct()
    held = contained_runs(rows.select("family", "id", F.col("tokens").alias("t")), ["family"], 1)
    held = held.select("family", F.least("short_id", "long_id").alias("a"), F.greatest("short_id", "long_id").alias("b"))
    homes = rows.select("family", "id")
    alike = jaccard_join(rows.select("id", F.transform(F.array_distinct("tokens"), lambda t: F.concat("family", F.lit(" "), t)).alias("tokens")), "id", "tokens", NEAR)
    alike = alike.select("a", "b").join(homes.withColumnRenamed("id", "a"), "a").select("family", "a", "b")
    return met.unionByName(held).unionByName(alike).distinct()


def near_duplicate_ledger(rows: DataFrame, most: int = 500) -> DataFrame:
    """(removed_id, kept_id, reason) of rows (id, family, source, start_ms, end_ms, context, target, target_ids, original, context_size).

    Rows of a family with the same tokens are COPY of the best of them: an original first, then the least context_size, then the least id. Of what is left, two
    near_candidates() are near if the largest of text ratio, set overlap and containment is NEAR or more; of near rows the worse goes as SAME_RECORDING if one holds nine tenths of
    the other, they share a target id or overlap in time; or else as MIRROR if their sources differ and targets and contexts are alike (0.9 and 0.55, or 0.7 and 0.8). Near rows that are neither
    both stay, and so do those of different families. kept_id is the best row that a removed one gives way to, which may itself give way to another. ids are unique;
    lists that are null are empty, rows without tokens stay, null times overlap nothing, rows of a null family stay. Extra columns are not read.
    """
    words = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    rank = F.struct(F.when(F.col("original"), 0).otherwise(1).alias("o"), F.coalesce("context_size", F.lit(0)).alias("c"), "id").alias("rank")
    full = rows.where("family is not null").select(
        "id", "family", "source", "start_ms", "end_ms", words(F.col("context")).alias("context"), words(F.col("target")).alias("target"), words(F.col("target_ids")).alias("target_ids"), rank
    )
    full = full.withColumn("tokens", F.concat("context", "target")).where(F.size("tokens") > 0).withColumn("_text", F.sha2(F.to_json(F.array("tokens")), 256))
    best = full.groupBy("family", "_text").agg(F.min("rank").alias("best"))
    scratch = Scratch(rows.sparkSession, "near-duplicates")
    ranked = scratch.save(full.join(best, ["family", "_text"]).drop("_text", "tokens"))
    copies = ranked.where(F.col("id") != F.col("best.id")).select(F.col("id").alias("removed_id"), F.col("best.id").alias("kept_id"), F.lit("COPY").alias("reason"))
    firsts = ranked.where(F.col("id") == F.col("best.id")).drop("best").withColumn("tokens", F.concat("context", "target"))

    def side(name: str) -> DataFrame:
        return firsts.select(F.col("id").alias(name), F.struct("source", "start_ms", "end_ms", "context", "target", "target_ids", "rank").alias(name + name))

    pairs = scratch.save(near_candidates(firsts, most=most).select("a", "b"))
    pairs = side_by_side(pairs, side("a"), side("b"), scratch)
    whole = lambda c: c.withField("tokens", F.concat(c["context"], c["target"]))
    pairs = pairs.select(whole(F.col("aa")).alias("aa"), whole(F.col("bb")).alias("bb"))
    x, y = F.col("aa"), F.col("bb")
    shorter, longer = F.least(F.size(x["tokens"]), F.size(y["tokens"])), F.greatest(F.size(x["tokens"]), F.size(y["tokens"]))
    stands = T.contains_run(x["tokens"], y["tokens"]) | T.contains_run(y["tokens"], x["tokens"])
    both = F.size(F.array_intersect(x["tokens"], y["tokens"]))
    pairs = pairs.withColumn("held", F.when(stands, shorter / longer).otherwise(0.0)).withColumn("jaccard", both / F.size(F.array_union(x["tokens"], y["tokens"])))
    spelt = lambda part: [F.array_join(side[part], " ") for side in (x, y)]
    known = F.greatest("held", "jaccard") >= NEAR
    timed = (x["end_ms"] + y["end_ms"] + x["start_ms"] + y["start_ms"]).isNotNull()
    overlap = timed & (F.least(x["end_ms"], y["end_ms"]) > F.greatest(x["start_ms"], y["start_ms"]))
    same = (F.col("held") >= 0.9) | F.arrays_overlap(x["target_ids"], y["target_ids"]) | overlap
    asked = pairs.withColumn("same", F.coalesce(same, F.lit(False))).withColumn("open", ~F.col("same") & ~x["source"].eqNullSafe(y["source"]))
    # The ratio of whole texts costs most, so it is asked only of pairs that would be redundant if they are near.
    asked = asked.withColumn("ts", text_ratio(*[F.when(F.col("open"), t) for t in spelt("target")], NEAR))
    asked = asked.withColumn("cs", text_ratio(*[F.when(F.col("ts") >= NEAR, t) for t in spelt("context")], 0.55))
    mirror = F.col("open") & ((F.col("ts") >= 0.9) & (F.col("cs") >= 0.55) | (F.col("ts") >= 0.7) & (F.col("cs") >= 0.8))
    asked = asked.withColumn("mirror", mirror)
    asked = asked.withColumn("seq", text_ratio(*[F.when(~known & (F.col("same") | F.col("mirror")), t) for t in spelt("tokens")], NEAR)).where(known | (F.col("seq") >= NEAR))
    mirror = F.col("mirror")
    reason = F.when(F.col("same"), "SAME_RECORDING").when(mirror, "MIRROR")
    loses = asked.select(F.greatest(x["rank"], y["rank"])["id"].alias("removed_id"), F.struct(F.least(x["rank"], y["rank"]).alias("rank"), reason.alias("reason")).alias("to")).where("to.reason is not null")
    lost = loses.groupBy("removed_id").agg(F.min("to").alias("to")).select("removed_id", F.col("to.rank.id").alias("kept_id"), F.col("to.reason").alias("reason"))
    return copies.unionByName(lost)
