"""Clustering of a group's vectors by cosine, and how well clusters hold together.

With vectors of unit length the mean cosine between two clusters is the product of their sums over the product of their sizes, so
silhouettes, centroids and average linkage need sums of clusters only, never all pairs of vectors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.operators.graph import connected_components
from colloquy.operators.vectors import dot, unit
from colloquy.session import Scratch

#: Clusters that a block has on average; two blocks are compared at a time.
BLOCK = 128


def _cluster_sums(rows: DataFrame) -> DataFrame:
    """(grp, clusters): for each group its clusters' sizes and summed vectors, which are few a group."""
    each = rows.select("grp", "cluster", F.posexplode("u").alias("i", "x")).groupBy("grp", "cluster", "i").agg(F.sum("x").alias("x"), F.count("*").alias("n"))
    whole = each.groupBy("grp", "cluster").agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("sum"))
    return whole.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("cluster", "n", "sum"))).alias("clusters"))


def silhouette(rows: DataFrame) -> DataFrame:
    """(grp, id, cluster, silhouette) of rows (grp, id, cluster, vector): exact silhouettes by cosine distance within each group.

    A row's mean distance to a cluster is one less the product of its unit vector with the cluster's sum over its size, its own cluster without the row itself. A row alone in its
    cluster, or in a group of one cluster, has 0. A vector of zeros is at distance 1 from all. Groups have few clusters of many rows.
    """
    own = rows.select("grp", "id", "cluster", unit(F.col("vector")).alias("u"))
    met = own.join(_cluster_sums(own), "grp")
    told = F.transform("clusters", lambda c: F.struct((c["cluster"] == F.col("cluster")).alias("own"), c["n"].alias("n"), dot(F.col("u"), c["sum"]).alias("s")))
    met = met.withColumn("told", told)
    mine = F.filter("told", lambda c: c["own"])[0]
    itself = dot(F.col("u"), F.col("u"))
    a = ((mine["n"] - mine["s"]) - (1 - itself)) / (mine["n"] - 1)
    b = F.array_min(F.transform(F.filter("told", lambda c: ~c["own"]), lambda c: 1 - c["s"] / c["n"]))
    value = F.when((mine["n"] > 1) & b.isNotNull(), F.try_divide(b - a, F.greatest(a, b)))
    return met.select("grp", "id", "cluster", F.coalesce(value, F.lit(0.0)).alias("silhouette"))


def centroid_confidence(rows: DataFrame) -> DataFrame:
    """(grp, id, cluster, confidence) of rows (grp, id, cluster, vector): half of one more than by how much the nearest centroid's cosine leads the second, 0 to 1; 1 with one cluster."""
    own = rows.select("grp", "id", "cluster", unit(F.col("vector")).alias("u"))
    met = own.join(_cluster_sums(own), "grp")
    near = F.sort_array(F.transform("clusters", lambda c: dot(F.col("u"), unit(c["sum"]))), asc=False)
    lead = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.get(near, F.lit(0)) - F.get(near, F.lit(1)) + 1) / 2))
    return met.select("grp", "id", "cluster", F.when(F.size("clusters") > 1, lead).otherwise(1.0).alias("confidence"))


def two_means(rows: DataFrame, rounds: int = 8, high: float = 0.48, second: float = 0.43, lead: float = 0.08) -> DataFrame:
    """(grp, id, cluster, overlap) of rows (grp, id, place, vector): two clusters a group from its first and last vector, by place and id.

    Each round gives rows to the nearer centroid (the first of equals) and takes the means' directions anew; a cluster that gets no rows keeps its centroid. overlap: the nearer centroid's cosine is at least
    high, the other's at least second, and they differ by less than lead. A group of one row is one cluster.
    """
    scratch = Scratch(rows.sparkSession, "twomeans")
    own = scratch.save(rows.select("grp", "id", "place", unit(F.col("vector")).alias("u")))
    order = F.struct("place", "id")
    centres = own.groupBy("grp").agg(F.min_by("u", order).alias("c0"), F.max_by("u", order).alias("c1"), F.count("*").alias("n"))
    a, b = dot(F.col("u"), F.col("c0")), dot(F.col("u"), F.col("c1"))
    for _ in range(rounds):
        given = own.join(centres, "grp").withColumn("cluster", (b > a).cast("int"))
        sums = given.select("grp", "cluster", F.posexplode("u").alias("i", "x")).groupBy("grp", "cluster", "i").agg(F.sum("x").alias("x"))
        means = sums.groupBy("grp", "cluster").agg(unit(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"])).alias("c"))
        wide = means.groupBy("grp").agg(F.max(F.when(F.col("cluster") == 0, F.col("c"))).alias("d0"), F.max(F.when(F.col("cluster") == 1, F.col("c"))).alias("d1"))
        last, centres = centres, scratch.save(centres.join(wide, "grp").select("grp", F.coalesce("d0", "c0").alias("c0"), F.coalesce("d1", "c1").alias("c1"), "n"))
    given = own.join(last, "grp").select("grp", "id", "u", (b > a).cast("int").alias("cluster"))  # of the last round
    met = given.join(centres, "grp")
    both = (F.greatest(a, b) >= high) & (F.least(a, b) >= second) & (F.abs(a - b) < lead) & (F.col("n") > 1)
    return met.select("grp", "id", "cluster", both.alias("overlap"))


def _nearest(clusters: DataFrame) -> DataFrame:
    """(grp, cid, near): for each cluster the nearest of its group, in blocks; equal distances by the smaller ids of the pair."""
    sizes = clusters.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = clusters.join(sizes, "grp").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    packed = dealt.groupBy("grp", "block").agg(F.collect_list(F.struct("cid", "n", "sum")).alias("rows"))
    left, right = packed.select("grp", F.col("rows").alias("x")), packed.select("grp", F.col("rows").alias("y"))
    kind = clusters.schema["grp"].dataType.simpleString()

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for grp, x, y in zip(frame["grp"], frame["x"], frame["y"], strict=True):
                ids, others = np.array([r["cid"] for r in x]), np.array([r["cid"] for r in y])
                n, m = np.array([r["n"] for r in x], float), np.array([r["n"] for r in y], float)
                a, b = np.array([r["sum"] for r in x]), np.array([r["sum"] for r in y])
                out = []
                for i in range(len(ids)):
                    d = 1 - (a[i] * b).sum(axis=1) / (n[i] * m)  # the same sum whichever of the two comes first
                    d[others == ids[i]] = np.inf
                    j = np.lexsort((np.maximum(ids[i], others), np.minimum(ids[i], others), d))[0]
                    if np.isfinite(d[j]):
                        out.append((grp, ids[i], d[j], others[j]))
                yield pd.DataFrame(out, columns=["grp", "cid", "d", "other"])

    found = left.join(right, "grp").mapInPandas(run, f"grp {kind}, cid long, d double, other long")
    pair = F.struct("d", F.least("cid", "other").alias("lo"), F.greatest("cid", "other").alias("hi"))
    return found.groupBy("grp", "cid").agg(F.min(pair).alias("near"))


def linkage(rows: DataFrame) -> DataFrame:
    """(grp, round, lo, hi, height): all merges of average linkage by cosine distance of rows (grp, id, vector), ids being whole numbers and unique.

    lo and hi are the smallest ids of the clusters that merge. Average linkage never brings a merged cluster nearer to another than both parts were, so
    all pairs that are nearest to each other merge in one round, and the merges are those of taking one pair at a time. A cluster is its size and its sum.
    """
    scratch = Scratch(rows.sparkSession, "linkage")
    clusters = scratch.save(rows.select("grp", F.col("id").cast("long").alias("cid"), F.lit(1).cast("long").alias("n"), unit(F.col("vector")).alias("sum")))
    merges, k = [], 0
    while True:
        near = _nearest(clusters)
        mutual = near.groupBy("grp", "near").agg(F.count("*").alias("times")).where("times = 2")
        now = scratch.save(mutual.select("grp", F.lit(k).alias("round"), F.col("near.lo").alias("lo"), F.col("near.hi").alias("hi"), F.col("near.d").alias("height")))
        merges.append(now)
        if now.isEmpty():
            break
        gone = now.select("grp", F.col("hi").alias("cid"), F.col("lo").alias("into"))
        moved = clusters.join(gone, ["grp", "cid"], "left").withColumn("to", F.coalesce("into", "cid"))
        parts = moved.groupBy("grp", F.col("to").alias("cid")).agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct(F.col("into").isNotNull().alias("second"), "sum"))).alias("p"))
        total = F.when(F.size("p") == 2, F.zip_with(F.col("p")[0]["sum"], F.try_element_at("p", F.lit(2))["sum"], lambda x, y: x + y)).otherwise(F.col("p")[0]["sum"])
        following = scratch.save(parts.select("grp", "cid", "n", total.alias("sum")))
        scratch.drop(clusters)
        clusters, k = following, k + 1
    out = merges[0]
    for more in merges[1:]:
        out = out.unionByName(more)
    return out


def average_linkage(rows: DataFrame, clusters: int | Column) -> DataFrame:
    """(grp, id, cluster): rows (grp, id, vector) of each group in so many clusters, two at least if it has two rows, by average linkage; clusters are numbered from 0 by their smallest ids."""
    sizes = rows.groupBy("grp").agg(F.count("*").alias("rows"))
    asked = clusters if isinstance(clusters, Column) else F.lit(clusters)
    keep = sizes.select("grp", (F.col("rows") - F.greatest(F.lit(2), F.least(asked, F.col("rows")))).alias("keep"))
    order = W.partitionBy("grp").orderBy("height", "round", "lo", "hi")
    kept = linkage(rows).withColumn("k", F.row_number().over(order)).join(keep, "grp").where(F.col("k") <= F.col("keep"))
    found = connected_components(kept.select(F.col("lo").alias("src"), F.col("hi").alias("dst")))
    placed = rows.select("grp", F.col("id").cast("long").alias("id")).join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("first", F.coalesce("component", "id"))
    number = F.dense_rank().over(W.partitionBy("grp").orderBy("first")) - 1
    return placed.select("grp", "id", number.alias("cluster"))
