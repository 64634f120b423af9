"""Folds in which an earlier kept row removes later ones, settled in rounds of joins.

Rows are taken in an order; a row is kept if no kept row before it conflicts with it. Nothing has to be done one row after the other: a row
that no undecided row before it conflicts with is kept, what conflicts with a kept row is removed, and both leave. Each round is
partially aggregated minima and joins over the rows still open; settled rows are written to the shared folder. Long chains of decisions (each row in conflict
with the next) would take many rounds, so after max_rounds what is left is folded over a sorted stream, which remembers only the keys of kept rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.operators.dedup import contained_runs
from colloquy.operators.graph import connected_components
from colloquy.session import Scratch

_KEY = ["kind", "key"]


def _lowest(keys: DataFrame) -> DataFrame:
    """Of each key the first open row, and the first one whose part is another than that row's."""
    parts = keys.groupBy(*_KEY, "part").agg(F.min("rank").alias("rank"))  # a row for each part of a key
    low = parts.groupBy(*_KEY).agg(F.min(F.struct("rank", "part")).alias("low"))
    other = parts.join(low, _KEY).where("part <> low.part").groupBy(*_KEY).agg(F.min("rank").alias("other"))
    return low.join(other, _KEY, "left").select(*_KEY, F.col("low.rank").alias("low"), F.col("low.part").alias("low_part"), "other")


def _blocked() -> Column:
    """Whether a row before it conflicts with a row at a key: any row if parts are null, else one of another part."""
    before = F.when(F.col("part").isNull() | (F.col("part") != F.col("low_part")), F.col("low")).otherwise(F.col("other"))
    return F.coalesce(before < F.col("rank"), F.lit(False))


def first_come(keys: DataFrame, max_rounds: int = 8) -> DataFrame:
    """(rank, kind, kept): for each row of keys (rank, kind, key, part) whether it is kept, else the least kind of conflict and the kept row in conflict.

    rank: a row's place in the order, unique to the row (any type that sorts); a row has one line a key. Two rows conflict if they have a line of equal kind and key, unless
    both lines have the same part; a null part conflicts with all. kind and kept are null for kept rows; of several kept rows in conflict by the least kind the last
    before the row is given.
    """
    spark = keys.sparkSession
    scratch = Scratch(spark, "settle")
    keys = scratch.save(keys.select("rank", "kind", F.coalesce("key", F.lit("")).alias("key"), "part"))
    open_, kept = keys, []
    for _ in range(max_rounds):
        low = scratch.save(_lowest(open_))
        marked = open_.join(low, _KEY).withColumn("blocked", _blocked())
        free = scratch.save(marked.groupBy("rank").agg(F.max(F.col("blocked").cast("int")).alias("b")).where("b = 0").select("rank"))
        kept.append(free)
        won = open_.join(free, "rank")
        # Of a key only one row is free, or several of one part.
        taken = won.groupBy(*_KEY).agg(F.min("rank").alias("low"), F.first("part").alias("low_part")).withColumn("other", F.lit(None).cast(low.schema["other"].dataType))
        lost = open_.join(taken, _KEY).where(_blocked()).select("rank").distinct()
        rest = scratch.save(open_.join(free, "rank", "left_anti").join(lost, "rank", "left_anti"))
        scratch.drop(low)
        if open_ is not keys:
            scratch.drop(open_)
        open_ = rest
        if open_.isEmpty():
            break
    else:
        kept.append(scratch.save(_streamed(open_)))
    winners = kept[0]
    for more in kept[1:]:
        winners = winners.unionByName(more)
    lines = keys.join(winners.withColumn("won", F.lit(True)), "rank", "left")
    last = F.last(F.when(F.col("won"), F.struct("rank", "part")), ignorenulls=True).over(W.partitionBy(*_KEY).orderBy("rank").rowsBetween(W.unboundedPreceding, -1))
    seen = lines.withColumn("by", last)
    met = F.col("by").isNotNull() & (F.col("part").isNull() | F.col("by.part").isNull() | (F.col("part") != F.col("by.part")))
    found = seen.groupBy("rank").agg(F.max(F.coalesce("won", F.lit(False))).alias("won"), F.max(F.when(met & F.col("won").isNull(), F.struct((-F.col("kind")).alias("kind"), F.col("by.rank").alias("kept")))).alias("why"))
    return found.select("rank", F.when(~F.col("won"), -F.col("why.kind")).alias("kind"), F.when(~F.col("won"), F.col("why.kept")).alias("kept"))


def _streamed(keys: DataFrame) -> DataFrame:
    """The kept of rows whose conflicts hang together in long chains: components are dealt out and read in order."""
    kind = keys.schema["rank"].dataType
    named = keys.select(F.xxhash64("rank").alias("r"), F.xxhash64(*_KEY).alias("k"))
    found = connected_components(named.select(F.col("r").alias("src"), F.col("k").alias("dst")))
    lines = keys.groupBy("rank").agg(F.collect_list(F.struct("kind", "key", "part")).alias("lines"))
    placed = lines.join(found.select(F.col("node").alias("r"), "component"), F.xxhash64("rank") == F.col("r"))
    dealt = placed.repartition("component").sortWithinPartitions("component", "rank").select("component", F.to_json(F.struct("rank")).alias("rank"), "lines")

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, taken = None, {}
        for frame in frames:
            out = []
            for component, rank, own in zip(frame["component"], frame["rank"], frame["lines"], strict=True):
                if component != at:
                    at, taken = component, {}
                own = [((x["kind"], x["key"]), x["part"]) for x in own]
                if not any(k in taken and (part is None or taken[k] is None or taken[k] != part) for k, part in own):
                    taken.update(own)
                    out.append(rank)
            if out:
                yield pd.DataFrame({"rank": out})

    typed = F.from_json("rank", f"rank {kind.simpleString()}")["rank"]
    return dealt.mapInPandas(run, "rank string").select(typed.alias("rank"))


def settle_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, kept_by): each node of nodes (node), null if it is kept, else the least kept node with an edge to it.

    edges (src, dst, order): src removes dst if src itself is kept; edges lead forwards in an order of the nodes, so that they have no cycle. Rounds are as
    many as the longest chain of nodes that depend on one another; a node leaves with its edges once it is settled.
    """
    scratch = Scratch(nodes.sparkSession, "edges")
    edges = scratch.save(edges.select("src", "dst", "order").distinct())
    open_, gone = edges, []
    while not open_.isEmpty():
        waits = open_.select(F.col("dst").alias("src")).distinct()
        sure = open_.join(waits, "src", "left_anti")  # from nodes that nothing open can remove
        lost = scratch.save(sure.groupBy(F.col("dst").alias("node")).agg(F.min(F.struct("order", "src")).alias("by")))
        gone.append(lost)
        names = lost.select("node")
        left = open_.join(names, open_["src"] == names["node"], "left_anti").join(names, open_["dst"] == names["node"], "left_anti")
        following = scratch.save(left)
        if open_ is not edges:
            scratch.drop(open_)
        open_ = following
    if not gone:
        return nodes.select("node", F.lit(None).cast(edges.schema["src"].dataType).alias("kept_by"))
    removed = gone[0]
    for more in gone[1:]:
        removed = removed.unionByName(more)
    # A kept node that was found later may come first: the least of all kept ones counts.
    kept = edges.join(removed.select(F.col("node").alias("src")), "src", "left_anti")
    by = kept.groupBy(F.col("dst").alias("node")).agg(F.min(F.struct("order", "src")).alias("by"))
    return nodes.join(by, "node", "left").select("node", F.col("by.src").alias("kept_by"))


PROVENANCE, SAME_TEXT, ANCHOR, TARGET, CONTAINMENT = (
    "EXACT_INTERACTION_PROVENANCE", "SAME_RECORDING_EXACT_MESSAGES", "SAME_RECORDING_DUPLICATE_ANCHOR", "SAME_RECORDING_TARGET_REUSE", "SAME_RECORDING_INTERACTION_CONTAINMENT",
)


def _lines(rows: DataFrame, *rules: tuple[int, Column, Column]) -> DataFrame:
    """One line a key of each row: rules are (kind, key, part), a key that is an array of strings giving a line for each."""

    def line(n: int, part: Column) -> Callable[[Column], Column]:
        return lambda k: F.struct(F.lit(n).alias("kind"), k.alias("key"), part.cast("string").alias("part"))

    made = [F.transform(key, line(n, part)) for n, key, part in rules]
    return rows.select(F.col("id").alias("rank"), F.explode(F.concat(*made)).alias("x")).select("rank", "x.*").distinct()


def _one(*parts: str) -> Column:
    return F.array(F.to_json(F.array(*[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])))


def _held(kept: DataFrame, least: int) -> DataFrame:
    """(src, dst, order): pairs of rows of one family and two sources in which src's tokens stand in dst's, or equal them, and src comes first by number of tokens and id."""
    whole = kept.where(F.size("tokens") >= least).select("family", F.col("tokens").alias("t"), "id", F.coalesce("source", F.lit("")).alias("source"), F.struct(F.size("tokens").alias("n"), F.col("id").alias("i")).alias("order"))
    texts = whole.groupBy("family", "t").agg(F.min("id").alias("id"))
    runs = contained_runs(texts, ["family"], least).select("family", "short", "long")
    runs = runs.unionByName(texts.select("family", F.col("t").alias("short"), F.col("t").alias("long")))
    shorter = whole.select("family", F.col("t").alias("short"), F.col("id").alias("src"), F.col("source").alias("s1"), "order")
    longer = whole.select("family", F.col("t").alias("long"), F.col("id").alias("dst"), F.col("source").alias("s2"), F.col("order").alias("order2"))
    pairs = runs.join(shorter, ["family", "short"]).join(longer, ["family", "long"])
    return pairs.where((F.col("s1") != F.col("s2")) & (F.col("order") < F.col("order2"))).select("src", "dst", "order")


def provenance_dedup(rows: DataFrame, least: int = 8) -> DataFrame:
    """(family, id, reason, kept_id) of rows (id, family, source, context, targets, anchor, text, tokens); reason and kept_id are null for kept rows.

    By id, a row goes if a kept row before it has its source, context and targets (PROVENANCE), its family and text from another source (SAME_TEXT), its source and anchor
    (ANCHOR), or its source and one of its targets (TARGET); the first of these that holds is the reason. Of the rows kept so far in a family, by number of tokens and id, one of at least
    least tokens then removes all longer ones from another source that hold its tokens (CONTAINMENT), unless it was removed itself; within a source no two kept rows
    have one anchor, so none is left to be compared. ids are unique strings; nulls count as empty. No family is held in one task.
    """
    scratch = Scratch(rows.sparkSession, "provenance")
    targets = F.coalesce("targets", F.array().cast("array<string>"))
    base = rows.select(
        "id", F.coalesce("family", F.lit("")).alias("family"), "source", "anchor", "text", F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"), targets.alias("targets"), F.coalesce("context", F.array().cast("array<string>")).alias("context")
    )
    none = F.lit(None)
    reused = F.transform("targets", lambda t: F.to_json(F.array(F.coalesce("source", F.lit("")), F.coalesce(t, F.lit("")))))
    whole = F.array(F.to_json(F.struct(F.coalesce("source", F.lit("")).alias("s"), "context", "targets")))
    keys = _lines(base, (0, whole, none), (1, _one("family", "text"), F.coalesce("source", F.lit(""))), (2, _one("source", "anchor"), none), (3, reused, none))
    first = scratch.save(first_come(keys))
    names = F.array(*map(F.lit, (PROVENANCE, SAME_TEXT, ANCHOR, TARGET)))
    marked = base.select("id", "family").join(first.withColumnRenamed("rank", "id"), "id")
    kept = base.join(first.where("kind is null").select(F.col("rank").alias("id")), "id")
    held = settle_edges(kept.select(F.col("id").alias("node")), _held(kept, least))
    out = marked.join(held.select(F.col("node").alias("id"), "kept_by"), "id", "left")
    reason = F.when(F.col("kind").isNotNull(), F.get(names, "kind")).when(F.col("kept_by").isNotNull(), CONTAINMENT)
    return out.select("family", "id", reason.alias("reason"), F.coalesce("kept", "kept_by").alias("kept_id"))


def global_dedup(rows: DataFrame, least: int = 8) -> DataFrame:
    """(id, reason, kept_id) of rows (id, family, anchor, targets, text, tokens), tokens being those of the response; null for kept rows.

    By id, a row goes if a kept row before it has its text (EXACT), its family and anchor (ANCHOR) or one of its targets (TARGET). Of the rest, by family, number of tokens
    and id, a row of at least least tokens goes if a kept one before it of so many stands in it (CONTAINMENT), whatever their families. ids are unique strings; nulls count as empty.
    """
    scratch = Scratch(rows.sparkSession, "global")
    base = rows.select("id", "family", "anchor", "text", F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"), F.coalesce("targets", F.array().cast("array<string>")).alias("targets"))
    none = F.lit(None)
    reused = F.transform("targets", lambda t: F.coalesce(t, F.lit("")))
    first = scratch.save(first_come(_lines(base, (0, _one("text"), none), (1, _one("family", "anchor"), none), (2, reused, none))))
    names = F.array(*map(F.lit, ("EXACT", "ANCHOR", "TARGET")))
    marked = base.select("id").join(first.withColumnRenamed("rank", "id"), "id")
    kept = base.join(first.where("kind is null").select(F.col("rank").alias("id")), "id").where(F.size("tokens") >= least)
    order = F.struct(F.coalesce("family", F.lit("")).alias("f"), F.size("tokens").alias("n"), F.col("id").alias("i"))
    # Rows of equal tokens hang on the first of them: what removes it comes before the others too.
    texts = scratch.save(kept.groupBy(F.col("tokens").alias("t")).agg(F.min(order).alias("order")).withColumn("id", F.col("order.i")))
    place = texts.select("id", "order")
    runs = contained_runs(texts.select("id", "t"), [], least).select("short_id", "long_id")
    pairs = runs.join(place.select(F.col("id").alias("short_id"), "order"), "short_id").join(place.select(F.col("id").alias("long_id"), F.col("order").alias("order2")), "long_id")
    edges = pairs.where(F.col("order") < F.col("order2")).select(F.col("short_id").alias("src"), F.col("long_id").alias("dst"), "order")
    held = settle_edges(texts.select(F.col("id").alias("node")), edges).join(texts.select(F.col("id").alias("node"), "t"), "node")
    each = kept.select("id", F.col("tokens").alias("t")).join(held, "t")
    each = each.select("id", F.coalesce("kept_by", F.when(F.col("id") != F.col("node"), F.col("node"))).alias("kept_by"))
    out = marked.join(each, "id", "left")
    reason = F.when(F.col("kind").isNotNull(), F.get(names, "kind")).when(F.col("kept_by").isNotNull(), "CONTAINMENT")
    return out.select("id", reason.alias("reason"), F.coalesce("kept", "kept_by").alias("kept_id"))
