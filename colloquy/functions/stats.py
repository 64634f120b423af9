"""Statistics whose definitions the built-in aggregates do not have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ranked_value(rows: DataFrame, group: list[str], value: str, q: float, rule: str = "nearest") -> DataFrame:
    """group columns and the value at place round((n - 1) * q), halves to even, or floor((n - 1) * q).

    Nulls and NaN do not count. Equal values are counted first, in partial aggregates, so a large
    group meets one task as its distinct values only, in a sort that can spill.
    """
    counts = rows.where(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*group, value).agg(F.count("*").alias("_n"))
    within = W.partitionBy(*group)
    upto = F.sum("_n").over(within.orderBy(value))
    placed = counts.withColumn("_upto", upto).withColumn("_all", F.sum("_n").over(within))
    at = (F.col("_all") - 1) * F.lit(q)
    place = F.bround(at, 0) if rule == "nearest" else F.floor(at)
    hit = (F.col("_upto") > place) & (F.col("_upto") - F.col("_n") <= place)
    return placed.where(hit).select(*group, value)


def trimmed_mean(value: Column) -> Column:
    """Mean without the smallest and the largest, if there are more than two."""
    n = F.count(value)
    trimmed = (F.sum(value) - F.min(value) - F.max(value)) / F.nullif(n - 2, F.lit(0))
    return F.when(n > 2, trimmed).otherwise(F.avg(value))


def wilson(hits: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """Lower and upper end of the Wilson interval; null without trials."""
    p = hits / F.nullif(n, F.lit(0))
    centre, width = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    scale = 1 + z * z / n
    return F.greatest(F.lit(0.0), (centre - width) / scale), F.least(F.lit(1.0), (centre + width) / scale)


def explicit_true(flag: Column) -> Column:
    """A count of rows whose flag is true; unknown is not."""
    return F.count_if(F.coalesce(flag, F.lit(False)))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))
