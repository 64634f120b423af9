"""Queries that run as streams over the events and give what the same batch would."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators.windows import latest
from colloquy.plans.base import query
from colloquy.plans.texts import TOKENS
from colloquy.plans.turns import NATURAL_TURNS, event_segments
from colloquy.session import Scratch
from colloquy.streaming import incremental as S
from colloquy.streaming import stateful

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _streamed(spark: SparkSession, sf_dir: str, shape, mode: str) -> DataFrame:
    """The rows that a stream over the events table gives, from all its micro-batches."""
    base = Scratch(spark, "stream").base
    events = spark.readStream.schema(EVENTS).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    out = shape(events)
    S.run_available(out, lambda batch, k: batch.withColumn("batch", F.lit(k)).write.mode("overwrite").parquet(f"{base}/out/b={k}"), f"{base}/checkpoint", mode)
    return spark.read.schema(f"{out.schema.toDDL()}, batch int").parquet(f"{base}/out/*")


@query("""WITH g AS (SELECT user_id, ts, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 30 MINUTE, false)::INT AS new, event_id FROM events),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM g) SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 1800000000 AS end_us, count(*) AS n FROM i GROUP BY user_id, s""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of thirty minutes, in complete mode: the last batch holds them all."""
    rows = _streamed(spark, sf_dir, lambda e: S.gap_sessions(e, "user_id", "30 minutes"), "complete")
    last = latest(rows.select("user_id", "start", "end", "n", "batch"), ["user_id", "start"], F.col("batch"))
    return last.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


@query("SELECT user_id, event_type, count(*) AS n, max(event_id) AS newest FROM events GROUP BY 1, 2")
def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts of a stream in update mode, whose latest values are the table's."""
    shape = lambda e: e.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("newest"))
    rows = _streamed(spark, sf_dir, shape, "update")
    return latest(rows, ["user_id", "event_type"], F.col("batch")).select("user_id", "event_type", "n", "newest")


@query("SELECT user_id, event_type, value FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without repeated ids, as a stream that remembers ids for the watermark's time."""
    rows = _streamed(spark, sf_dir, lambda e: S.drop_repeats(e, ["event_id"]), "append")
    return rows.select("user_id", "event_type", "value")


@query(NATURAL_TURNS)
def stream_natural_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of natural_turns, merged by keyed state as events arrive; a last row moves the clock past all of them."""
    stateful.use_rocksdb(spark)
    scratch = Scratch(spark, "clock")
    schema = spark.createDataFrame([], EVENTS).schema
    clock = spark.sql("SELECT -1L AS event_id, timestamp_ntz'2100-01-01' AS ts, -1L AS user_id, '' AS event_type, 0D AS value, '' AS props")
    folder = scratch.save(clock)._scratch_path

    def shape(events: DataFrame) -> DataFrame:
        both = events.unionByName(spark.readStream.schema(schema).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp")))
        rows = event_segments(both).withColumnRenamed("event_id", "segment_id")
        return stateful.natural_turns(rows, max_ms=45_000_000, tight_ms=800_000, pause_ms=2_500_000, idle_ms=10**13)

    rows = _streamed(spark, sf_dir, shape, "append")
    return rows.where("source_id <> '-1'").drop("batch")


@query(f"SELECT doc_id AS request_id, len({TOKENS})::BIGINT AS n_tokens FROM documents")
def stream_single_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each text, computed once for each different text while documents come in as a stream."""
    stateful.use_rocksdb(spark)
    base = Scratch(spark, "flight").base
    docs = spark.readStream.schema("doc_id long, text string").option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/documents.parquet*")
    text = F.coalesce("text", F.lit(""))
    words = F.array_join(T.tokens(text), " ")
    requests = docs.select(F.col("doc_id").alias("request_id"), F.sha2(text.cast("binary"), 256).alias("key"), words.alias("payload"))
    out = stateful.single_flight(requests, lambda words: str(len(words.split())))
    S.run_available(out, lambda batch, k: batch.write.mode("overwrite").parquet(f"{base}/out/b={k}"), f"{base}/checkpoint")
    return spark.read.schema(out.schema).parquet(f"{base}/out/*").select("request_id", F.col("value").cast("long").alias("n_tokens"))
