"""Structured Streaming forms: sessions, trailing windows, duplicates and append-only logs.

Late rows are those behind the watermark; aggregations drop them, and late_rows() keeps them in a sink of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """New files of a folder as a stream of rows with a timestamp ts."""
    return spark.readStream.schema(schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def gap_sessions(events: DataFrame, key: str, gap: str = "45 seconds", late: str = "1 hour") -> DataFrame:
    """(key, start, end, n) of sessions that a pause of gap ends."""
    out = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def trailing_counts(events: DataFrame, key: str, length: str = "12 hours", step: str = "1 hour", late: str = "1 hour") -> DataFrame:
    out = events.withWatermark("ts", late).groupBy(F.window("ts", length, step).alias("w"), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def spread_steps(counts: DataFrame, key: str, steps: int, step: str = "1 hour") -> DataFrame:
    """(key, start, n) of the windows of so many steps, one beginning at each step, from final counts (key, start, n) of single steps: what trailing_counts() gives, with one state a step instead of one a window."""
    begins = F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda k: F.col("start") - k * F.expr(f"interval {step}"))
    return counts.select(key, F.explode(begins).alias("start"), "n").groupBy(key, "start").agg(F.sum("n").alias("n"))


def drop_repeats(events: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """The first row of every key within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Give everything that is there to sink in micro-batches, then stop; a later run goes on from checkpoint."""
    query = stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def upsert(path_of: Callable[[int], str], key: list[str], order: list[str]) -> Callable[[DataFrame, int], None]:
    """A sink that writes the latest row of every key of a batch; latest() over all batches is the present state."""
    from colloquy.operators.windows import latest

    def write(batch: DataFrame, number: int) -> None:
        latest(batch, key, F.struct(*order)).write.mode("overwrite").parquet(path_of(number))

    return write


def late_rows(spark: SparkSession, marks: str, path: str, ts: str, late: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes the rows of a batch that lie more than late behind the newest row of all batches before.

    The newest row's time of each batch is kept below marks, so that a batch that is run again finds the same bound.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.agg(F.max(ts).alias("newest")).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{marks}/b={number}")
        before = spark.read.schema("newest timestamp, batch int").parquet(f"{marks}/*").where(F.col("batch") < number).agg(F.max("newest")).first()[0]
        behind = F.lit(False) if before is None else F.col(ts) < F.lit(before) - F.expr(f"interval {late}")
        batch.where(behind).write.mode("overwrite").parquet(f"{path}/b={number}")

    return write
