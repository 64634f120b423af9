"""Queries that write and read JSON lines and transcripts again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.plans.base import query
from colloquy.session import Scratch
from colloquy.sources import artifacts as S
from colloquy.tables import table


@query("SELECT event_id, user_id, event_type, value FROM events")
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as JSON lines and read strictly."""
    path = f"{Scratch(spark, 'jsonl').base}/events"
    S.write_jsonl(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"), path)
    return S.read_jsonl(spark, path, "event_id long, user_id long, event_type string, value double")


@query("SELECT event_id, (props->>'k')::BIGINT AS k FROM events WHERE event_id % 3 <> 0")
def lenient_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which a third are cut off; the lenient reader drops those."""
    line = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "props": '), "props", F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.lit("}")))
    path = f"{Scratch(spark, 'lenient').base}/events"
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    rows = S.read_jsonl(spark, path, "event_id long, props struct<k: long>", strict=False)
    return rows.select("event_id", F.col("props.k").alias("k"))


@query("""SELECT conv_id, turn, (turn * 60)::DOUBLE AS start, (turn * 60 + 59.5)::DOUBLE AS "end", trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM conversations WHERE NOT contains(text, '<') AND trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''""")
def cue_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns written as WebVTT cues and parsed again."""
    rows = table(spark, sf_dir, "conversations").where(~F.col("text").contains("<"))
    cue = F.format_string("%02d:%02d:00.000 --> %02d:%02d:59.500\n%s\n\n", F.expr("turn div 60"), F.expr("turn % 60"), F.expr("turn div 60"), F.expr("turn % 60"), T.collapse(F.col("text")))
    parsed = rows.select("conv_id", "turn", F.inline(S.parse_cues(F.concat(F.lit("WEBVTT\n\n"), cue))))
    return parsed.select("conv_id", "turn", "start", "end", "text")


@query("""SELECT conv_id, turn, (turn * 61)::DOUBLE AS start, coalesce(lead(turn * 61) OVER (PARTITION BY conv_id ORDER BY turn), turn * 61)::DOUBLE AS "end" FROM conversations""")
def bracket_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with bracketed times, whose ends are the next line's start."""
    seconds = F.col("turn") * 61
    line = F.format_string("[%02d:%02d] %s", F.expr("turn * 61 div 60"), seconds % 60, T.collapse(F.col("text")))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.inline(S.bracket_lines(line)))
    from colloquy.operators.windows import W

    w = W.partitionBy("conv_id").orderBy("turn")
    return rows.select("conv_id", "turn", "start", F.coalesce(F.lead("start").over(w), "start").alias("end"))


@query("SELECT split, count(*) AS n FROM (SELECT CASE WHEN event_id % 5 = 0 THEN 'validation' ELSE 'train' END AS split FROM events) GROUP BY 1")
def split_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view written by split and counted from its folders."""
    path = f"{Scratch(spark, 'split').base}/view"
    S.write_run(table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 5 == 0, "validation").otherwise("train").alias("split")), path, ["split"])
    return spark.read.parquet(path).groupBy("split").agg(F.count("*").alias("n"))
