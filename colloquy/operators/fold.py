"""Order-dependent folds over groups of bounded size.

Each operator states its order and sorts by it within the group, so that results do not depend on
how rows arrive. Groups are recordings, conversations or clusters: what is folded is small
by nature, and a group that is not should be split by a finer key first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.operators.dedup import contained_names, named_runs
from colloquy.session import Scratch


def ordered_fold(rows: DataFrame, group: list[str], order: list[str], step: Callable[[pd.DataFrame], Iterable[tuple]], schema: str) -> DataFrame:
    """Give each group, sorted by order, to step; its tuples are the rows of the result."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(step(part.sort_values(order, kind="stable", ignore_index=True))), columns=names)

    return rows.groupBy(*group).applyInPandas(run, schema)


def containment_fold(rows: DataFrame, least: int = 5) -> DataFrame:
    """(grp, id, kept_id): rows (grp, id, tokens) taken short first, then by id; kept_id is the kept row that stands in a removed one, null if kept.

    Rows of fewer than least tokens (three at least) are kept and remove nothing. Of several kept rows that stand in a removed one, that counts
    whose first three tokens come first in it, then the shorter, then the smaller id.

    The fold needs no order of work: what stands in a removed row holds, or is, a kept one that stands in it too. So a row
    is removed if any other stands in it, and of equal rows all but the one with the smallest id.
    """
    if least < 3:
        raise ValueError("least must be 3 or more")
    scratch = Scratch(rows.sparkSession, "fold")
    used = named_runs(rows.where(F.size("tokens") >= least).select("grp", "id", F.col("tokens").alias("t")), ["grp"], "t")
    ids = scratch.save(used.select("grp", "id", F.col("_name").alias("name")))
    firsts = ids.groupBy("name").agg(F.min("id").alias("first"))
    held = scratch.save(contained_names(used, "t", least, scratch))
    bare = held.join(held.select(F.col("long").alias("short")).distinct(), "short", "left_anti")
    asked = bare.select(F.col("short").alias("_name")).union(bare.select("long")).distinct()
    texts = used.join(asked, "_name", "left_semi").select("_name", "t").dropDuplicates(["_name"])
    short = texts.select(F.col("_name").alias("short"), F.slice("t", 1, 3).alias("opening"), F.size("t").alias("n"))
    starts = F.transform(F.sequence(F.lit(1), F.size("t") - 2), lambda i: F.slice("t", i, 3))
    met = bare.join(short, "short").join(texts.withColumnRenamed("_name", "long"), "long").select("short", "long", "n", F.array_position(starts, F.col("opening")).alias("place"))
    met = met.join(firsts.withColumnRenamed("name", "short"), "short")
    best = met.groupBy(F.col("long").alias("name")).agg(F.min(F.struct("place", "n", F.col("first").alias("id"))).alias("best"))
    classes = firsts.join(best, "name", "left").select("name", "first", F.col("best.id").alias("by"))
    found = ids.join(classes, "name").select("grp", "id", F.coalesce("by", F.when(F.col("id") != F.col("first"), F.col("first"))).alias("kept_id"))
    rest = rows.where(F.coalesce(F.size("tokens"), F.lit(0)) < least).select("grp", "id", F.lit(None).cast("long").alias("kept_id"))
    return found.unionByName(rest)


def greedy_non_overlap(rows: DataFrame, most: int) -> DataFrame:
    """(grp, id, place): rows (grp, id, start, end, weight) taken heaviest first, then longest, then by id, if they overlap none taken; at most most."""

    def step(part: pd.DataFrame) -> Iterable[tuple]:
        part = part.assign(span=part["end"] - part["start"]).sort_values(["weight", "span", "id"], ascending=[False, False, True], kind="stable")
        taken: list[tuple] = []
        for grp, ident, start, end in zip(part["grp"], part["id"], part["start"], part["end"], strict=True):
            if len(taken) >= most:
                break
            if all(end <= a or start >= b for a, b in taken):
                taken.append((start, end))
                yield grp, ident, len(taken)

    return ordered_fold(rows, ["grp"], ["id"], step, "grp string, id long, place long")


def span_units(rows: DataFrame, gap: int, longest: int, least: int) -> DataFrame:
    """(grp, unit, start, end, n): rows (grp, id, start, end) by start cut at a pause of gap or a span of longest; units shorter than least are left out."""

    def step(part: pd.DataFrame) -> Iterable[tuple]:
        unit: list | None = None
        done: list[list] = []
        for start, end in zip(part["start"], part["end"], strict=True):
            if unit and (start - unit[1] >= gap or end - unit[0] >= longest):
                done.append(unit)
                unit = None
            if unit:
                unit[1], unit[2] = max(unit[1], end), unit[2] + 1
            else:
                unit = [start, end, 1]
        if unit:
            done.append(unit)
        for k, (start, end, n) in enumerate(u for u in done if u[1] - u[0] >= least):
            yield part["grp"].iloc[0], k, start, end, n

    return ordered_fold(rows, ["grp"], ["start", "id"], step, "grp string, unit long, start long, end long, n long")


def repeated_segments(rows: DataFrame, overlap: float, drift: float) -> DataFrame:
    """(grp, id, kept_id) of rows (grp, id, start, end, text) by start: a row repeats the last kept one if it begins no later than overlap
    before that one's end, within drift of its start, and their texts are equal or one holds the other; the longer text stays. Groups are read as a sorted stream that holds one row, so many small ones cost no more than one large one."""

    dealt = rows.select("grp", "id", "start", "end", "text").repartition("grp").sortWithinPartitions("grp", "start", "id")

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at: object = None
        last: list | None = None  # the last kept row, whose own line waits for what becomes of it
        for frame in frames:
            out: list[tuple] = []
            for grp, ident, start, end, text in zip(*(frame[c].tolist() for c in ("grp", "id", "start", "end", "text")), strict=True):
                if last is None or grp != at or not (last[2] - start >= overlap and abs(start - last[1]) <= drift and (text in last[3] or last[3] in text)):
                    if last:
                        out.append((at, last[0], None))
                    at, last = grp, [ident, start, end, text]
                elif len(text) > len(last[3]):
                    out.append((grp, last[0], ident))
                    last = [ident, start, end, text]
                else:
                    out.append((grp, ident, last[0]))
            yield framed(out)
        if last:
            yield framed([(at, last[0], None)])

    def framed(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({"grp": [x[0] for x in out], "id": [x[1] for x in out], "kept_id": pd.array([x[2] for x in out], dtype="Int64")})

    return dealt.mapInPandas(run, "grp string, id long, kept_id long")


def merge_fragments(rows: DataFrame, gap: float = 1.5) -> DataFrame:
    """(grp, first_id, start, end, text, n) of rows (grp, id, start, end, cluster, text): a row joins the one before if it follows within gap,
    has its cluster, and the text so far is unfinished, the row begins in lower case or has at most two words."""

    def step(part: pd.DataFrame) -> Iterable[tuple]:
        held: list | None = None
        for grp, ident, start, end, cluster, text in zip(*(part[c] for c in ("grp", "id", "start", "end", "cluster", "text")), strict=True):
            joins = held and start - held[3] <= gap and cluster == held[6] and (held[4].rstrip()[-1:] not in ".!?" or text[:1].islower() or len(text.split()) <= 2)
            if joins:
                held[3], held[4], held[5] = max(held[3], end), f"{held[4]} {text}", held[5] + 1
            else:
                if held:
                    yield tuple(held[:6])
                held = [grp, ident, start, end, text, 1, cluster]
        if held:
            yield tuple(held[:6])

    return ordered_fold(rows, ["grp"], ["start", "id"], step, "grp string, first_id long, start double, end double, text string, n long")
