"""Recording families: stable cluster ids and size-capped merging."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.operators.graph import connected_components
from colloquy.session import Scratch


def cluster_ids(components: DataFrame, prefix: str = "rc_", bits: int = 160) -> DataFrame:
    """(component, cluster_id, members): an id from the sorted members, which are few in a cluster; bits: 160 for SHA-1, 256 for SHA-256."""
    joined = F.array_join(F.array_sort(F.collect_list("node")), "|").cast("binary")
    digest = F.sha1(joined) if bits == 160 else F.sha2(joined, bits)
    return components.groupBy("component").agg(F.concat(F.lit(prefix), F.substring(digest, 1, 16)).alias("cluster_id"), F.count("*").alias("members"))


def capped_merge(edges: DataFrame, most: int, max_rounds: int = 16) -> DataFrame:
    """(a, b, state) of cluster pairs (a, b, pairs, overlap), a row a pair: MERGED, SAME (already together) or BRIDGE (would exceed most).

    The result is that of taking the edges one by one, by most pairs, longest overlap, a and b. No order of work is needed for it: an
    edge that comes first among the open ones of both its clusters meets them as they are now, so all such edges merge in one round; an edge
    whose clusters are too large together stays so, as clusters only grow; an edge within a cluster is the same. A round is minima by cluster
    and joins over the open edges. Where edges rank in order along long paths a round settles few of them, so after max_rounds the rest is folded over
    a sorted stream, a component after the other, which remembers the open clusters alone.
    """
    scratch = Scratch(edges.sparkSession, "capped")
    one = F.lit(1).cast("long")
    rank = F.struct((-F.col("pairs")).alias("p"), (-F.col("overlap")).alias("o"), F.col("a").alias("x"), F.col("b").alias("y"))
    open_ = scratch.save(edges.select("a", "b", rank.alias("rank"), F.col("a").alias("ra"), F.col("b").alias("rb"), one.alias("sa"), one.alias("sb")))
    done = []
    for _ in range(max_rounds):
        state = F.when(F.col("ra") == F.col("rb"), "SAME").when(F.col("sa") + F.col("sb") > most, "BRIDGE")
        told = open_.withColumn("state", state)
        done.append(scratch.save(told.where("state is not null").select("a", "b", "state")))
        rest = told.where("state is null").drop("state")
        ends = rest.select(F.col("ra").alias("r"), "rank").unionAll(rest.select(F.col("rb").alias("r"), "rank"))
        first = ends.groupBy("r").agg(F.min("rank").alias("first"))
        at_a, at_b = first.select(F.col("r").alias("ra"), F.col("first").alias("fa")), first.select(F.col("r").alias("rb"), F.col("first").alias("fb"))
        both = scratch.save(rest.join(at_a, "ra").join(at_b, "rb").withColumn("now", (F.col("rank") == F.col("fa")) & (F.col("rank") == F.col("fb"))).drop("fa", "fb"))
        now = both.where("now")
        done.append(now.select("a", "b", F.lit("MERGED").alias("state")))
        if now.isEmpty():
            scratch.drop(open_)
            break
        joined = now.select(F.explode(F.array("ra", "rb")).alias("r"), F.least("ra", "rb").alias("new"), (F.col("sa") + F.col("sb")).alias("size"))
        left, right = joined.toDF("ra", "na", "za"), joined.toDF("rb", "nb", "zb")
        moved = both.where("not now").join(left, "ra", "left").join(right, "rb", "left")
        following = scratch.save(
            moved.select("a", "b", "rank", F.coalesce("na", "ra").alias("ra"), F.coalesce("nb", "rb").alias("rb"), F.coalesce("za", "sa").alias("sa"), F.coalesce("zb", "sb").alias("sb"))
        )
        scratch.drop(open_)
        open_ = following
    else:
        done.append(_streamed_merge(open_, most))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _streamed_merge(edges: DataFrame, most: int) -> DataFrame:
    """The states of edges (a, b, rank, ra, rb, sa, sb) of components that are read in order of rank."""
    placed = connected_components(edges.select(F.col("ra").alias("src"), F.col("rb").alias("dst"))).select(F.col("node").alias("ra"), "component")
    dealt = edges.join(placed, "ra", "left").repartition("component").sortWithinPartitions("component", "rank")
    kind = f"a {edges.schema['a'].dataType.simpleString()}, b {edges.schema['b'].dataType.simpleString()}, state string"

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, root, size = None, {}, {}

        def find(x):
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        for frame in frames:
            states = []
            for component, x, y, sx, sy in zip(*(frame[c].tolist() for c in ("component", "ra", "rb", "sa", "sb")), strict=True):
                if component != at:
                    at, root, size = component, {}, {}
                p, q = find(x), find(y)
                if p == q:
                    states.append("SAME")
                elif size.get(p, sx) + size.get(q, sy) > most:
                    size.setdefault(p, sx), size.setdefault(q, sy)
                    states.append("BRIDGE")
                else:
                    root[q], size[p] = p, size.get(p, sx) + size.get(q, sy)
                    states.append("MERGED")
            yield frame[["a", "b"]].assign(state=states)

    return dealt.select("component", "a", "b", "ra", "rb", "sa", "sb").mapInPandas(run, kind)


def merged_families(states: DataFrame) -> DataFrame:
    """(node, family_id, members) of the clusters that capped_merge() names: an id from the sorted members; a cluster that nothing joined is a family of its own."""
    nodes = states.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    found = connected_components(states.where("state = 'MERGED'").select(F.col("a").alias("src"), F.col("b").alias("dst")))
    placed = nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    return placed.join(cluster_ids(placed, "rf_", 256), "component").select("node", F.col("cluster_id").alias("family_id"), "members")


def split_exclusions(states: DataFrame) -> DataFrame:
    """(a, b, family_a, family_b): edges that were refused for size alone and lie between two families, which must then share a split."""
    named = merged_families(states)
    left, right = named.select(F.col("node").alias("a"), F.col("family_id").alias("family_a")), named.select(F.col("node").alias("b"), F.col("family_id").alias("family_b"))
    return states.where("state = 'BRIDGE'").select("a", "b").join(left, "a").join(right, "b").where("family_a <> family_b").select("a", "b", "family_a", "family_b")
