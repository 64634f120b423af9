"""Graph operators: connected components over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.session import Scratch


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


#: Nodes with more edges than a share of all are hubs: at most twice so many, so that their minima can be broadcast.
HUBS = 1000
#: Below so many edges a hub's are few enough for one task, and the plan stays small.
HUBS_FROM = 1_000_000


def _with_low(edges: DataFrame, low: DataFrame, n: int) -> DataFrame:
    """edges (src, dst) with the smallest neighbour of src; a hub's edges stay where they are instead of meeting in one task.

    Joins are by sorting, which spills and takes nothing through the driver.
    """
    if n < HUBS_FROM:
        return edges.join(low.select("src", "low").hint("merge"), "src")
    most = max(200, n // HUBS)
    hubs = low.where(F.col("degree") > most).select("src", F.col("low").alias("hub_low"))
    marked = edges.join(F.broadcast(hubs), "src", "left")
    rest = marked.where("hub_low is null").select("src", "dst").join(low.where(F.col("degree") <= most).hint("merge"), "src")
    return marked.where("hub_low is not null").select("src", "dst", F.col("hub_low").alias("low")).unionByName(rest.select("src", "dst", "low"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(src, dst) edges -> (node, component), the component being its smallest node.

    Alternates the large-star and small-star steps of Kiveris et al. (2014): every step is a
    partially aggregated minimum per node joined back to the edges, so no neighbourhood is
    ever collected and a hub's edges are split over tasks. Rounds grow with the logarithm
    of the longest path. Self loops and null ends are ignored; an isolated node does not
    appear; repeated edges count once.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, "components")
    clean = edges.select("src", "dst").where("src is not null and dst is not null and src <> dst")
    current = scratch.save(
        clean.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    )
    before = _signature(current)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = current.unionAll(current.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("low"), F.count("*").alias("degree"))
        large = _with_low(both.where("dst > src"), low, before[0]).select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        large = large.where("src <> dst").distinct()
        low = large.groupBy("src").agg(F.min("dst").alias("low"), F.count("*").alias("degree"))
        joined = _with_low(large, low, before[0])
        small = (
            joined.select(F.col("dst").alias("src"), F.col("low").alias("dst"))
            .unionAll(joined.select("src", F.col("low").alias("dst")))
            .where("src <> dst")
            .distinct()
        )
        following = scratch.save(small)
        after = _signature(following)
        scratch.drop(current)
        current = following
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("dst").alias("node")).distinct()
    return current.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component"))
    )
