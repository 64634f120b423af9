"""Sampling views and leakage-safe splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.functions.hashing import hash_order
from colloquy.operators.graph import connected_components
from colloquy.operators.windows import top_by


def hash_sample(rows: DataFrame, salt: str, key: Column, n: int) -> DataFrame:
    """The n rows whose salted hashes come first: a sample that is the same in every run."""
    return rows.withColumn("_h", hash_order(salt, key)).orderBy("_h").limit(n).drop("_h")


def group_sample(rows: DataFrame, group: list[str], salt: str, key: Column, n: int) -> DataFrame:
    return top_by(rows.withColumn("_h", hash_order(salt, key)), group, [F.col("_h")], n).drop("_h")


def size_slots(rows: DataFrame, family: str) -> DataFrame:
    """(family, n, split) by size: places 2 and 5 of the largest-first order validate, 3 and 4 are sealed, others train.

    The order is over families, a table of counts.
    """
    counts = rows.groupBy(family).agg(F.count("*").alias("n"))
    place = F.row_number().over(W.orderBy(F.desc("n"), family))
    split = F.when(place.isin(2, 5), "validation").when(place.isin(3, 4), "sealed").otherwise("train")
    return counts.select(family, "n", split.alias("split"))


def must_share(families: DataFrame, relations: DataFrame, family: str) -> DataFrame:
    """(family, root): families that relations (src, dst) tie together share a root, their smallest."""
    roots = connected_components(relations)
    joined = families.select(family).distinct().join(roots.withColumnRenamed("node", family), family, "left")
    return joined.select(family, F.coalesce("component", F.col(family)).alias("root"))


def inherit_splits(members: DataFrame, authority: DataFrame) -> DataFrame:
    """(root, split, conflict): the split that earlier assignments (member, split) force on each root (root, member).

    The strongest of sealed, validation and train holds; a root with both sealed and other members conflicts
    and should be quarantined; a root without an earlier member has no split yet.
    """
    rank = F.when(F.col("split") == "sealed", 3).when(F.col("split") == "validation", 2).when(F.col("split") == "train", 1)
    known = members.join(authority, "member", "left").groupBy("root").agg(F.max(rank).alias("r"), F.count_distinct("split").alias("k"))
    split = F.when(F.col("r") == 3, "sealed").when(F.col("r") == 2, "validation").when(F.col("r") == 1, "train")
    return known.select("root", split.alias("split"), (F.col("k") > 1).alias("conflict"))


def hash_filled_splits(counts: DataFrame, family: str, validation: float = 0.08, sealed: float = 0.08) -> DataFrame:
    """(family, n, split): families in salted hash order fill sealed, then validation up to their shares of all rows; the two largest always train.

    A running sum over the table of family counts decides, so that nothing is folded on the driver.
    """
    place = F.row_number().over(W.orderBy(F.desc("n"), family))
    ranked = counts.withColumn("_top", place <= 2).withColumn("_h", hash_order("split-v1", F.col(family)))
    total = F.sum("n").over(W.partitionBy())
    before = F.coalesce(F.sum(F.when(~F.col("_top"), F.col("n")).otherwise(0)).over(W.orderBy("_h", family).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    share = ranked.withColumn("_b", before / total)
    split = F.when(F.col("_top"), "train").when(F.col("_b") < sealed, "sealed").when(F.col("_b") < sealed + validation, "validation").otherwise("train")
    return share.select(family, "n", split.alias("split"))


def concentration_cap(rows: DataFrame, group: str, order: list[Column], share: float = 0.4) -> DataFrame:
    """rows with the largest group cut, by order, to share of what is left; no group is cut if none exceeds it."""
    counts = rows.groupBy(group).agg(F.count("*").alias("_n"))
    total = F.sum("_n").over(W.partitionBy())
    other = total - F.col("_n")
    limit = F.when(F.col("_n") > share * total, F.floor(other * share / (1 - share))).otherwise(F.col("_n"))
    capped = rows.join(counts.select(group, limit.alias("_limit")), group)
    rank = F.row_number().over(W.partitionBy(group).orderBy(*order))
    return capped.withColumn("_rn", rank).where(F.col("_rn") <= F.col("_limit")).drop("_rn", "_limit")


def target_filled_splits(counts: DataFrame, family: str, share: float = 0.12, least: float = 0.55) -> DataFrame:
    """(family, n, split) of counts (family, n): few whole families fill validation, then sealed, each up to about share of all rows; the others train.

    Families come by size and name, the largest always trains. A split takes the next family while it has none, while that brings it nearer to its share, or while it holds less than least of it; it has an
    eighth of the families at most, two or three. Fewer than six families all train. Each choice is one minimum over the family counts, so that no list of families is held anywhere.
    """
    total, families = counts.agg(F.sum("n"), F.count("*")).first()
    if families < 6:
        return counts.select(family, "n", F.lit("train").alias("split"))
    slots, target = max(2, min(3, families // 8)), max(1.0, total * share)
    place = F.struct((-F.col("n")).alias("size"), F.col(family).alias("name"))
    ranked = counts.withColumn("_at", place)
    largest = ranked.agg(F.min("_at")).first()[0]
    chosen: dict[str, str] = {}
    for split in ("validation", "sealed"):
        held, after, picked = 0, largest, 0
        while picked < slots:
            open_ = ranked.where((F.col("_at") > F.struct(F.lit(after["size"]).alias("size"), F.lit(after["name"]).alias("name"))) & ~F.col(family).isin(list(chosen)))
            if picked and held >= least * target:
                open_ = open_.where(F.abs(F.lit(target) - held - F.col("n")) <= abs(target - held))
            after = open_.agg(F.min("_at")).first()[0]
            if after is None:
                break
            chosen[after["name"]] = split
            held, picked = held - after["size"], picked + 1
    split = F.lit("train")
    for name, given in chosen.items():
        split = F.when(F.col(family) == name, given).otherwise(split)
    return counts.select(family, "n", split.alias("split"))
