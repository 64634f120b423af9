"""Exact, containment and prefix deduplication, change detection and removal ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import grams
from colloquy.operators.windows import first_by
from colloquy.session import Scratch


def exact_dedup(rows: DataFrame, key: list[Column], order: str) -> DataFrame:
    """rows with kept_id: the smallest order value of rows that share the key."""
    keys = [k.alias(f"_k{i}") for i, k in enumerate(key)]
    names = [f"_k{i}" for i in range(len(key))]
    keyed = rows.select("*", *keys)
    first = keyed.groupBy(*names).agg(F.min(order).alias("kept_id"))
    meets = None
    left, right = keyed.alias("l"), first.alias("r")
    for name in names:
        same = F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
        meets = same if meets is None else meets & same
    return left.join(right, meets).select("l.*", "kept_id").drop(*names)


def duplicate_groups(rows: DataFrame, key: Column, ident: str) -> DataFrame:
    """(key, n, first_id, last_id) of keys that more than one row has."""
    out = rows.groupBy(key.alias("key")).agg(F.count("*").alias("n"), F.min(ident).alias("first_id"), F.max(ident).alias("last_id"))
    return out.where("n > 1")


def named_runs(rows: DataFrame, group: list[str], tokens: str) -> DataFrame:
    """rows with _group and _name, the hashes of the group and of the group with its tokens, by which copies are one text."""
    own = F.xxhash64(F.lit("group"), *group)  # unlike the hash of any token
    return rows.withColumns({"_group": own, "_name": F.xxhash64(F.lit("run"), *group, tokens)})


def contained_names(rows: DataFrame, tokens: str, least: int, scratch: Scratch) -> DataFrame:
    """(short, long): names of named_runs() of which short stands in long within a group; copies count as one. Rows have at least least tokens.

    A run stands in another only if all its keys (grams.keyed_runs) are there. So each text meets those that have its rarest key, and is out if one of its keys is its own
    alone; nothing else of it travels. Runs of fewer than grams.WINDOW tokens are their own key and settled by two hashes; of longer ones, which meet rarely, the texts are compared.
    """
    keyed = grams.keyed_runs(rows.select(F.col("_group").alias("group"), F.col("_name").alias("name"), F.col(tokens).alias("t")), least)
    each = W.partitionBy("key")
    several = keyed.select("*", F.min("name").over(each).alias("_a"), F.max("name").over(each).alias("_z"), F.count("*").over(each).alias("rows")).where("_a <> _z")
    shared = scratch.save(several.drop("_a", "_z").distinct())
    rarest = F.min(F.struct("rows", "key", "proof", "kind")).alias("x")
    shorts = shared.where(F.col("kind") != grams.INNER).groupBy("name", "size", "of").agg(F.count("*").alias("met"), rarest).where("met = of")
    shorts = shorts.select(F.col("name").alias("short"), F.col("size").alias("short_size"), "x.key", "x.proof", F.col("x.kind").alias("by"))
    longs = shared.where(F.col("kind") != grams.WHOLE).select("key", "proof", F.col("name").alias("long"), "size", "kind")
    fits = (F.col("short_size") < F.col("size")) & ((F.col("by") == grams.MINIMIZER) == (F.col("kind") == grams.MINIMIZER))
    met = scratch.save(shorts.join(longs, ["key", "proof"]).where(fits).select("short", "long", "by"))
    doubt = met.where(F.col("by") == grams.MINIMIZER).select("short", "long")
    asked = doubt.select(F.col("short").alias("_name")).union(doubt.select("long")).distinct()
    edge = F.lit("\x1f")
    spelt = rows.join(asked, "_name", "left_semi").select("_name", F.concat(edge, F.array_join(tokens, "\x1f"), edge).alias("v")).dropDuplicates(["_name"])
    sides = [spelt.select(F.col("_name").alias(side), F.col("v").alias(side[0])) for side in ("short", "long")]
    held = doubt.join(sides[0], "short").join(sides[1], "long").where(F.contains("l", "s")).select("short", "long")
    return met.where(F.col("by") == grams.WHOLE).select("short", "long").unionByName(held)


def contained_runs(texts: DataFrame, group: list[str], n: int) -> DataFrame:
    """(*group, short_id, short, long_id, long) of rows (*group, id, t), t being different tokens within a group: short stands in long.

    Found by contained_names(). Rows have at least n tokens; those of a null group are left out.
    """
    known = texts.where(F.lit(True) if not group else ~F.exists(F.array(*[F.col(c).isNull() for c in group]), lambda x: x))
    named = named_runs(known, group, "t")
    held = contained_names(named, "t", n, Scratch(texts.sparkSession, "runs"))
    held = held.join(named.select(F.col("_name").alias("short"), *group, F.col("id").alias("short_id"), F.col("t").alias("_s")), "short")
    held = held.join(named.select(F.col("_name").alias("long"), F.col("id").alias("long_id"), F.col("t").alias("_l")), "long")
    return held.select(*group, "short_id", F.col("_s").alias("short"), "long_id", F.col("_l").alias("long"))


def contained_rows(rows: DataFrame, group: list[str], ident: str, tokens: str) -> DataFrame:
    """(removed_id, kept_id): rows whose tokens hold, or stand in, those of an earlier row of the group, kept or not.

    Rows of equal tokens are one text in the comparison, and a text meets only those that hold its rarest key.
    """
    scratch = Scratch(rows.sparkSession, "contained")
    known = rows.where(F.size(tokens) > 0)
    for c in group:
        known = known.where(F.col(c).isNotNull())
    named = named_runs(known.select(*group, F.col(ident).alias("id"), F.col(tokens).alias("t")), group, "t")
    ids = scratch.save(named.select(F.col("_name").alias("name"), "id"))
    firsts = ids.groupBy("name").agg(F.min("id").alias("first"))
    held = scratch.save(contained_names(named, "t", 1, scratch))
    near = held.select(F.col("short").alias("name"), F.col("long").alias("other")).unionByName(held.select(F.col("long").alias("name"), F.col("short").alias("other")))
    near = near.join(firsts.select(F.col("name").alias("other"), "first"), "other").groupBy("name").agg(F.min("first").alias("near"))
    earliest = firsts.join(near, "name", "left").select("name", F.least("first", "near").alias("kept_id"))
    both = ids.join(earliest, "name").where(F.col("kept_id") < F.col("id"))
    return both.groupBy(F.col("id").alias("removed_id")).agg(F.min("kept_id").alias("kept_id"))


def prefix_pairs(rows: DataFrame, group: list[str], ident: str, text: str) -> DataFrame:
    """(shorter_id, longer_id): within a group, each text with the longest other that it begins with.

    Equal texts form a chain by id; the first of them follows the last of the shorter text. A text of n characters waits under its first 2^k, the largest
    power of two up to n; a longer text looks under its own first 1, 2, 4, ... characters, and only the lengths that wait there are asked. Texts and
    beginnings meet by SHA-256, so texts travel once, and only those that have lengths to ask.
    """
    named = F.concat(F.to_json(F.struct(*group)), F.lit("\n"))
    seen = rows.where(F.length(text) > 0).select(F.col(ident).alias("id"), named.alias("_g"), F.col(text).alias("v")).withColumn("n", F.length("v"))

    def start(k: Column) -> Column:
        return F.substring("v", F.lit(1), k)

    whole = F.unhex(F.sha2(F.concat("_g", "v"), 256)).alias("h")
    powers = F.transform(F.sequence(F.lit(0), F.floor(F.log2("n") + 1e-9).cast("int")), lambda k: F.call_function("shiftleft", F.lit(1), k))
    under = F.transform(powers, lambda k: F.xxhash64("_g", k, start(k))).alias("under")
    scratch = Scratch(rows.sparkSession, "prefixes")
    texts = scratch.save(seen.select("id", "n", whole, under))
    classes = texts.groupBy("h").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    waiting = texts.groupBy(F.element_at("under", -1).alias("at")).agg(F.collect_set("n").alias("sizes"))
    looks = texts.join(classes.select("h", F.col("first").alias("id")), ["h", "id"], "left_semi").select("id", "h", "n", F.explode("under").alias("at"))
    shorter = F.filter("sizes", lambda k: k < F.col("n"))
    asked = looks.join(waiting, "at").select("id", "h", shorter.alias("sizes")).where(F.size("sizes") > 0)
    asked = scratch.save(asked.groupBy("id", "h").agg(F.flatten(F.collect_list("sizes")).alias("sizes")))
    begun = seen.withColumn("h", whole).join(asked, ["id", "h"]).select(F.col("h").alias("of"), F.explode("sizes").alias("n"), "_g", "v")
    begun = begun.select("of", "n", F.unhex(F.sha2(F.concat("_g", start(F.col("n"))), 256)).alias("h"))
    nearest = begun.join(classes, "h").groupBy("of").agg(F.max(F.struct("n", "last")).alias("x"))
    pairs = nearest.join(classes.select(F.col("h").alias("of"), "first"), "of").select(F.col("x.last").alias("shorter_id"), F.col("first").alias("longer_id"))
    copies = texts.select("id", F.lag("id").over(W.partitionBy("h").orderBy("id")).alias("shorter_id")).where("shorter_id is not null")
    return pairs.unionByName(copies.select("shorter_id", F.col("id").alias("longer_id")))


def snapshot_changes(old: DataFrame, new: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """key and state: NEW, REMOVED, UPDATED or UNCHANGED."""
    a = old.select(*key, F.struct(*values).alias("_o"), F.lit(True).alias("_in_old"))
    b = new.select(*key, F.struct(*values).alias("_n"), F.lit(True).alias("_in_new"))
    state = (
        F.when(F.col("_in_old").isNull(), "NEW").when(F.col("_in_new").isNull(), "REMOVED")
        .when(~F.col("_o").eqNullSafe(F.col("_n")), "UPDATED").otherwise("UNCHANGED")
    )
    return a.join(b, key, "full_outer").select(*key, state.alias("state"))


def behaviour_repeats(rows: DataFrame, family: str, text: Column, ident: str) -> DataFrame:
    """rows with behaviour_id where independent families share a text; such repetition is kept and only marked."""
    keyed = rows.withColumn("_t", text)
    shared = keyed.where(F.col("_t") != "").groupBy("_t").agg(F.count_distinct(family).alias("families")).where("families >= 2")
    marked = keyed.join(shared, "_t", "left")
    name = F.when(F.col("families").isNotNull(), F.concat(F.lit("br_"), F.substring(F.sha2("_t", 256), 1, 16)))
    return marked.withColumn("behaviour_id", name).drop("_t", "families")


def ledger(*removals: tuple[str, DataFrame]) -> DataFrame:
    """One removal a row: (removed_id, kept_id, reason), the first reason given if several remove it."""
    out = None
    for rank, (reason, rows) in enumerate(removals):
        part = rows.select("removed_id", "kept_id", F.lit(reason).alias("reason"), F.lit(rank).alias("_rank"))
        out = part if out is None else out.unionByName(part)
    return first_by(out, ["removed_id"], [F.col("_rank"), F.col("kept_id")]).drop("_rank")
