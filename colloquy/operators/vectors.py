"""Embedding operators: normalisation, prototypes, margins and threshold sweeps.

Vectors are arrays; sums are taken a dimension at a time in double, so a class mean is one partially
aggregated group-by and never a gathered group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.operators.windows import first_by


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """a divided by its length; a vector of length 0 stays."""
    n = norm(a)
    return F.transform(a, lambda x: x.cast("double") / F.when(n == 0, 1.0).otherwise(n))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def _sums(rows: DataFrame, by: list[str], vector: str) -> DataFrame:
    each = rows.select(*by, F.posexplode(vector).alias("i", "x"))
    return each.groupBy(*by, "i").agg(F.sum(F.col("x").cast("double")).alias("s"), F.count("*").alias("n"))


def _gather(sums: DataFrame, by: list[str], mean: Column, name: str) -> DataFrame:
    """One array a key from its dimensions, which are few."""
    ordered = F.array_sort(F.collect_list(F.struct("i", mean.alias("m"))))
    return sums.groupBy(*by).agg(F.transform(ordered, lambda x: x["m"]).alias(name))


def prototypes(rows: DataFrame, label: str, vector: str, group: str | None = None, least_groups: int = 1) -> DataFrame:
    """(label, prototype): the mean vector of each label, of unit length; labels from fewer than least_groups groups have none."""
    out = _gather(_sums(rows, [label], vector), [label], F.col("s") / F.col("n"), "_m").select(label, unit(F.col("_m")).alias("prototype"))
    if group:
        wide = rows.groupBy(label).agg(F.count_distinct(group).alias("_g")).where(F.col("_g") >= least_groups)
        out = out.join(wide.select(label), label, "left_semi")
    return out


def held_out_prototypes(rows: DataFrame, label: str, vector: str, group: str, least: int = 10) -> DataFrame:
    """(group, label, prototype): each label's mean without the group's own rows; with all rows if fewer than least would be left."""
    whole = _sums(rows, [label], vector)
    own = _sums(rows, [label, group], vector).withColumnRenamed("s", "s_own").withColumnRenamed("n", "n_own")
    groups = rows.select(group).distinct()
    spread = whole.crossJoin(groups)  # as many rows as the result has numbers: every label's vector for every group
    met = spread.join(own, [label, group, "i"], "left")
    left = F.col("n") - F.coalesce("n_own", F.lit(0))
    mean = F.when(left < least, F.col("s") / F.col("n")).otherwise((F.col("s") - F.coalesce("s_own", F.lit(0.0))) / left)
    out = _gather(met, [group, label], mean, "_m")
    return out.select(group, label, unit(F.col("_m")).alias("prototype"))


def scores(rows: DataFrame, protos: DataFrame, on: list[str], ident: str, vector: str, label: str) -> DataFrame:
    """(ident, own label, candidate, score): cosine of every row with every prototype of its on keys, or with all."""
    p = protos.withColumnRenamed(label, "candidate")
    joined = rows.join(p, on) if on else rows.crossJoin(F.broadcast(p))  # without keys there is one prototype a label
    return joined.select(ident, label, *on, "candidate", cosine(F.col(vector), F.col("prototype")).alias("score"))


def margins(scored: DataFrame, ident: str, target: Column) -> DataFrame:
    """(ident, target_score, other_score, margin): the target prototype against the best of the others."""
    out = scored.groupBy(ident).agg(F.max(F.when(target, F.col("score"))).alias("target_score"), F.max(F.when(~target, F.col("score"))).alias("other_score"))
    return out.withColumn("margin", F.col("target_score") - F.col("other_score"))


def classify(scored: DataFrame, ident: str, label: str) -> DataFrame:
    """(ident, label, predicted, margin): the nearest prototype, and its lead over the second."""
    top = F.slice(F.sort_array(F.collect_list(F.struct("score", "candidate")), asc=False), 1, 2)
    best = scored.groupBy(ident, label).agg(top.alias("t"))  # one entry a label
    return best.select(ident, label, F.get("t", F.lit(0))["candidate"].alias("predicted"), (F.get("t", F.lit(0))["score"] - F.get("t", F.lit(1))["score"]).alias("margin"))


def threshold_sweep(scored: DataFrame, score: str, positive: Column, low: float, high: float, steps: int) -> DataFrame:
    """(threshold, tp, fp, recall, false_positive_rate) on a fixed grid.

    Rows are counted by the last threshold that they reach; running sums over the grid's steps + 2 rows do the rest.
    """
    step = (high - low) / steps
    at = lambda k: F.round(F.lit(low) + k * F.lit(step), 6)
    near = F.greatest(F.lit(-1), F.least(F.lit(steps), F.floor((F.col("s") - low) / step).cast("int")))
    last = F.when((near < steps) & (F.col("s") >= at(near + 1)), near + 1).when(F.col("s") >= at(near), near).otherwise(near - 1)
    counts = scored.select(F.col(score).alias("s"), positive.alias("p")).groupBy(F.greatest(F.lit(-1), F.coalesce(last, F.lit(-1))).alias("k"), "p").agg(F.count("*").alias("n"))
    counts = counts.groupBy("k").agg(F.sum(F.when(F.col("p"), F.col("n"))).alias("p"), F.sum(F.when(~F.col("p"), F.col("n"))).alias("q"))
    grid = scored.sparkSession.range(-1, steps + 1).select(F.col("id").cast("int").alias("k")).join(counts, "k", "left")
    above, whole = W.orderBy(F.desc("k")).rowsBetween(W.unboundedPreceding, 0), W.partitionBy()
    running = lambda c, w: F.sum(F.coalesce(c, F.lit(0))).over(w)
    out = grid.select("k", running("p", above).alias("tp"), running("q", above).alias("fp"), running("p", whole).alias("np"), running("q", whole).alias("nn")).where("k >= 0")
    rate = lambda n, d: F.round(F.col(n) / F.col(d), 6)
    return out.select(at(F.col("k")).alias("threshold"), "tp", "fp", rate("tp", "np").alias("recall"), rate("fp", "nn").alias("false_positive_rate"))


def choose_threshold(sweep: DataFrame, least_recall: float = 0.9) -> DataFrame:
    """One row: without false positives and with enough recall the best recall, then the highest threshold; else the fewest false positives."""
    good = (F.col("fp") == 0) & (F.col("recall") >= least_recall)
    order = [F.desc(good.cast("int")), F.when(good, -F.col("recall")).otherwise(F.col("false_positive_rate")), F.desc("threshold")]
    return first_by(sweep.withColumn("_all", F.lit(1)), ["_all"], order).drop("_all")


def median_bits(vector: Column) -> Column:
    """One bit a dimension as text: whether it is at least the vector's median."""
    ordered = F.array_sort(vector)
    n = F.size(vector)
    middle = (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / 2
    return F.array_join(F.transform(vector, lambda x: F.when(x >= middle, "1").otherwise("0")), "")
