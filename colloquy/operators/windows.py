"""Windows over ordered rows: counts, sessions, interval unions and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def place(group: list[str], order: list[str]) -> Column:
    """0-based place within a group."""
    return (F.row_number().over(W.partitionBy(*group).orderBy(*order)) - 1).cast("long")


def count_windows(rows: DataFrame, group: list[str], order: list[str], size: int, least: int) -> DataFrame:
    """rows with window (0-based), for tumbling windows of size rows; windows of fewer than least rows are left out."""
    numbered = rows.withColumn("window", F.floor(place(group, order) / size))
    n = F.count("*").over(W.partitionBy(*group, "window"))
    return numbered.withColumn("_n", n).where(F.col("_n") >= least).drop("_n")


def sliding_windows(rows: DataFrame, group: list[str], order: list[str], size: int, step: int, least: int, past_end: bool = False) -> DataFrame:
    """rows, once for each window that covers them, with start (its first place).

    Windows start every step places; after the first that reaches the last row no further one starts,
    unless past_end. Windows of fewer than least rows are left out. A row lies in at most
    ceil(size / step) windows.
    """
    numbered = rows.withColumn("_p", place(group, order)).withColumn("_all", F.count("*").over(W.partitionBy(*group)))
    low = F.greatest(F.lit(0), F.ceil((F.col("_p") - size + 1) / step)).cast("long")
    high = F.floor(F.col("_p") / step).cast("long")
    spread = numbered.withColumn("start", F.explode(F.transform(F.sequence(low, high), lambda k: k * step)))
    if not past_end:
        spread = spread.where((F.col("start") == 0) | (F.col("start") - step + size < F.col("_all")))
    return spread.where(F.least(F.lit(size), F.col("_all") - F.col("start")) >= least).drop("_p", "_all")


def sessions(rows: DataFrame, group: list[str], start: str, end: str, gap: float, tie: str) -> DataFrame:
    """rows with session (0-based): a new one where a row starts more than gap after the end of the row before it."""
    w = W.partitionBy(*group).orderBy(start, tie)
    new = F.coalesce(F.col(start) - F.lag(end).over(w) > gap, F.lit(False))
    return rows.withColumn("session", F.sum(new.cast("long")).over(w))


def merge_intervals(rows: DataFrame, group: list[str], start: str, end: str, gap: float = 0, tie: str | None = None) -> DataFrame:
    """rows with island (0-based): intervals that overlap, or lie at most gap apart, share one."""
    w = W.partitionBy(*group).orderBy(start, end, *([tie] if tie else []))
    reach = F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1))
    return rows.withColumn("island", F.sum(F.coalesce(F.col(start) > reach + gap, F.lit(False)).cast("long")).over(w))


def chunk_intervals(intervals: DataFrame, start: str, end: str, longest: int) -> DataFrame:
    """intervals cut into pieces of at most longest, with chunk, chunk_start and chunk_end."""
    n = F.greatest(F.lit(1), F.ceil((F.col(end) - F.col(start)) / longest)).cast("long")
    cut = intervals.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    return cut.withColumn("chunk_start", F.col(start) + F.col("chunk") * longest).withColumn("chunk_end", F.least(F.col(end), F.col("chunk_start") + longest))


def first_by(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key."""
    return top_by(rows, key, order, 1)


def top_by(rows: DataFrame, key: list[str], order: list[Column], n: int | Column) -> DataFrame:
    """The first n rows of every key."""
    return rows.withColumn("_rn", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def runs(rows: DataFrame, group: list[str], order: list[str], flag: str) -> DataFrame:
    """Rows whose flag is true, with run (numbered by the false rows before it)."""
    w = W.partitionBy(*group).orderBy(*order)
    numbered = rows.withColumn("run", F.sum((~F.coalesce(F.col(flag), F.lit(False))).cast("long")).over(w))
    return numbered.where(F.col(flag))


def latest(rows: DataFrame, key: list[str], sequence: Column) -> DataFrame:
    """The last row of every key by sequence: an append-only log's present state. One partial aggregate, no sort."""
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), sequence).alias("_last"))
    return best.select(*key, "_last.*")
