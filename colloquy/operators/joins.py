"""Interval, point, as-of and shingle joins.

Range conditions alone would compare all pairs of a group. overlap_join() gives every interval the bins
that it covers, so that the join is one by group and bin; each pair is kept in its first common
bin only. Bins spread a hot group over tasks; their width should be near the longest interval's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def overlap_join(left: DataFrame, right: DataFrame, on: list[str], width: int, closed: bool = False, how: str = "inner") -> DataFrame:
    """Pairs of rows with equal keys on whose [start, end) overlap; closed also takes intervals that touch.

    left has columns start and end, right has start_r and end_r, all whole numbers. how may be inner
    or left; then every left row that overlaps nothing comes once with nulls.
    """
    bins = lambda a, b: F.sequence(F.floor(F.col(a) / width), F.floor(F.greatest(F.col(a), F.col(b)) / width))
    rest = [c for c in left.columns if c not in on]
    a = left.withColumn("_bin", F.explode(bins("start", "end")))
    b = right.withColumn("_bin", F.explode(bins("start_r", "end_r")))
    first = F.col("_bin") == F.floor(F.greatest("start", "start_r") / width)
    meets = (F.col("start") <= F.col("end_r")) & (F.col("start_r") <= F.col("end")) if closed else (F.col("start") < F.col("end_r")) & (F.col("start_r") < F.col("end"))
    pairs = a.join(b, [*on, "_bin"]).where(meets & first).drop("_bin")
    if how == "inner":
        return pairs
    matched = pairs.select(*on, *rest).distinct()
    alone = left.join(matched, [*on, *rest], "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True)


def point_join(points: DataFrame, intervals: DataFrame, on: list[str], point: str, width: int) -> DataFrame:
    """Pairs of a point and an interval [start_r, end_r] that holds it."""
    a = points.withColumn("_bin", F.floor(F.col(point) / width))
    b = intervals.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start_r") / width), F.floor(F.col("end_r") / width))))
    return a.join(b, [*on, "_bin"]).where((F.col(point) >= F.col("start_r")) & (F.col(point) <= F.col("end_r"))).drop("_bin")


def overlap_length(start: Column, end: Column, start_r: Column, end_r: Column) -> Column:
    return F.greatest(F.lit(0), F.least(end, end_r) - F.greatest(start, start_r))


def best_overlap(pairs: DataFrame, key: list[str], tie: str, doubt: float = 0.9) -> DataFrame:
    """For each key the pair of the longest overlap; of equals the nearest centre, then tie.

    ambiguous: the second longest is at least doubt of the longest. pairs has start, end, start_r, end_r.
    """
    overlap = overlap_length(F.col("start"), F.col("end"), F.col("start_r"), F.col("end_r"))
    centre = F.abs((F.col("start") + F.col("end")) - (F.col("start_r") + F.col("end_r")))
    w = W.partitionBy(*key).orderBy(F.desc("overlap"), "_centre", tie)
    ranked = pairs.withColumn("overlap", overlap).withColumn("_centre", centre)
    ranked = ranked.withColumn("_rn", F.row_number().over(w)).withColumn("_second", F.lead("overlap").over(w))
    doubtful = F.coalesce(F.col("_second") >= doubt * F.col("overlap"), F.lit(False))
    return ranked.where("_rn = 1").withColumn("ambiguous", doubtful).drop("_rn", "_second", "_centre")


def asof_backward(rows: DataFrame, group: list[str], order: list[str], take: Column, usable: Column, name: str) -> DataFrame:
    """rows with name: take of the last usable row before each row, null if there is none."""
    w = W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn(name, F.last(F.when(usable, take), ignorenulls=True).over(w))


def asof_join(left: DataFrame, right: DataFrame, on: list[str], at: str, at_r: str, columns: list[str]) -> DataFrame:
    """left with columns of the last right row of the same keys at or before at.

    One union sorted by key and time; no range join. Of right rows at one time the last by columns is taken.
    """
    a = left.select(*on, F.col(at).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(right.select(F.struct(at_r, *columns)).schema[0].dataType).alias("_found"))
    b = right.select(*on, F.col(at_r).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("_row"), F.struct(at_r, *columns).alias("_found"))
    w = W.partitionBy(*on).orderBy("_t", "_side", "_found").rowsBetween(W.unboundedPreceding, 0)
    merged = a.unionByName(b).withColumn("_found", F.last("_found", ignorenulls=True).over(w)).where("_side = 1")
    return merged.select("_row.*", *[F.col(f"_found.{c}").alias(c) for c in columns], F.col(f"_found.{at_r}").alias(at_r))


def nearest_join(left: DataFrame, right: DataFrame, on: list[str], at: str, at_r: str, column: str) -> DataFrame:
    """left with the column and time of the right row nearest in time, the earlier of two as near.

    Looks once backward and once forward in one sorted union.
    """
    found = F.struct(F.col(at_r).alias("t"), F.col(column).alias("v"))
    kind = right.select(found).schema[0].dataType
    a = left.select(*on, F.col(at).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(kind).alias("_f"))
    b = right.select(*on, F.col(at_r).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("_row"), found.alias("_f"))
    both = a.unionByName(b)
    back = W.partitionBy(*on).orderBy("_t", "_side", "_f").rowsBetween(W.unboundedPreceding, 0)
    ahead = W.partitionBy(*on).orderBy("_t", "_side", "_f").rowsBetween(1, W.unboundedFollowing)
    seen = both.withColumn("_b", F.last("_f", ignorenulls=True).over(back)).withColumn("_a", F.first("_f", ignorenulls=True).over(ahead)).where("_side = 1")
    near = F.when(F.col("_a").isNull() | (F.col("_t") - F.col("_b.t") <= F.col("_a.t") - F.col("_t")), F.col("_b")).otherwise(F.col("_a"))
    return seen.withColumn("_n", near).select("_row.*", F.col("_n.t").alias(at_r), F.col("_n.v").alias(column))


def shingles(tokens: Column, size: int) -> Column:
    """All runs of size tokens, joined by spaces; none if there are fewer tokens."""
    last = F.size(tokens) - size
    at = F.when(last >= 0, F.sequence(F.lit(1), last + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda k: F.array_join(F.slice(tokens, k, size), " "))


def shingle_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, size: int) -> DataFrame:
    """(left_id, right_id, shared): how many distinct runs of size tokens two rows share; both have tokens.

    Equal token lists of left are one text until the end, so that a text repeated a million times meets right once. Runs meet
    as two 64-bit hashes; no run is spelt out. Rows with fewer tokens, none or null share nothing.
    """

    def runs(rows: DataFrame, ident: str) -> DataFrame:
        cut = F.transform(F.sequence(F.lit(1), F.size("tokens") - size + 1), lambda k: F.slice("tokens", k, size))
        return rows.select(ident, F.explode(cut).alias("_run")).select(ident, F.xxhash64("_run").alias("h"), F.xxhash64(F.lit(size), F.reverse("_run")).alias("g"))

    enough = F.size("tokens") >= size
    named = left.where(enough).select(left_id, F.sha2(F.array_join("tokens", " "), 256).alias("_text"), "tokens")
    first = named.groupBy("_text").agg(F.first("tokens").alias("tokens"))
    met = runs(first, "_text").join(runs(right.where(enough), right_id).distinct(), ["h", "g"])
    shared = met.distinct().groupBy("_text", right_id).agg(F.count("*").alias("shared"))
    return named.select(left_id, "_text").join(shared, "_text").select(left_id, right_id, "shared")


def status_merge(old: DataFrame, new: DataFrame, key: str, ranks: dict[str, list[str]], unions: list[str]) -> DataFrame:
    """Two versions of a manifest as one: statuses only rise in rank, lists unite, other columns take the new value unless null."""
    both = old.alias("o").join(new.alias("n"), key, "full_outer")
    out = [F.col(key)]
    for c in old.columns:
        if c == key:
            continue
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c in ranks:
            rank = lambda x, order=ranks[c]: F.coalesce(F.array_position(F.array(*map(F.lit, order)), x), F.lit(0))
            out.append(F.when(rank(n) > rank(o), n).otherwise(o).alias(c))
        elif c in unions:
            empty = F.array().cast("array<string>")
            out.append(F.array_sort(F.array_union(F.coalesce(o, empty), F.coalesce(n, empty))).alias(c))
        else:
            out.append(F.coalesce(n, o).alias(c))
    return both.select(*out)
