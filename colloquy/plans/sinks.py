"""Queries over sinks, caches and document sources, and streams over several files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators import splits
from colloquy.operators.windows import latest
from colloquy.plans.base import query
from colloquy.plans.streams import EVENTS
from colloquy.session import Scratch
from colloquy.sources import artifacts as A
from colloquy.streaming import incremental as S
from colloquy.tables import table


@query("SELECT user_id, count(*) AS n, sum(event_id)::BIGINT AS ids, true AS named FROM events GROUP BY 1")
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON document a user, each in a file of its own, read back with the file's name."""
    path = f"{Scratch(spark, 'documents').base}/users"
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_list("event_id")).alias("events"))
    A.write_json_documents(rows.withColumn("folder", F.col("user_id")), path, "folder")
    read = A.read_json_documents(spark, path, "user_id long, events array<long>")
    total = F.aggregate("events", F.lit(0).cast("long"), lambda a, x: a + x)
    named = F.col("file").contains(F.concat(F.lit("folder="), F.col("user_id").cast("string"), F.lit("/")))
    return read.select("user_id", F.size("events").cast("long").alias("n"), total.alias("ids"), named.alias("named"))


@query("SELECT md5(coalesce(text, '')) AS key, count(*) AS n, CASE WHEN bool_or(doc_id % 2 = 0) THEN 'first' ELSE 'second' END AS run FROM documents GROUP BY 1")
def cached_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache by the text's digest, filled in two runs, of which the second adds only what the first lacks."""
    path = f"{Scratch(spark, 'cache').base}/cache"
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key"))
    docs.where("doc_id % 2 = 0").dropDuplicates(["key"]).select("key", F.lit("first").alias("run")).write.parquet(path)
    cache = lambda: spark.read.schema("key string, run string").parquet(path)
    A.put_missing(cache(), docs.select("key", F.lit("second").alias("run")), "key", path)
    return docs.groupBy("key").agg(F.count("*").alias("n")).join(cache(), "key")


@query("""SELECT doc_id, '{"id":' || doc_id || ',"parts":[{"n":' || length(coalesce(text, '')) || '},{"n":7}]}' AS body FROM documents""")
def nested_redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as nested records with whole texts, without any text field at any depth."""
    text = F.coalesce("text", F.lit(""))
    part = lambda value, n: F.struct(value.alias("text"), F.struct(value.alias("raw")).alias("secret"), n.alias("n"))
    record = F.struct(F.col("doc_id").alias("id"), text.alias("text"), F.array(part(text, F.length(text)), part(F.lit("x"), F.lit(7))).alias("parts"))
    rows = A.redact(table(spark, sf_dir, "documents").select("doc_id", "text", record.alias("record")), {"text", "secret"})
    return rows.select("doc_id", F.to_json("record").alias("body"))


@query("""WITH RECURSIVE f AS (SELECT DISTINCT user_id AS v FROM events), e AS (SELECT a.v AS x, b.v AS y FROM f a JOIN f b ON b.v = a.v + 1 WHERE a.v % 10 < 3),
r AS (SELECT v, v AS seen FROM f UNION SELECT r.v, CASE WHEN e.x = r.seen THEN e.y ELSE e.x END FROM r JOIN e ON e.x = r.seen OR e.y = r.seen)
SELECT v AS user_id, min(seen) AS root FROM r GROUP BY 1""")
def shared_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families that must share a split, by the components of their relations."""
    families = table(spark, sf_dir, "events").select("user_id").distinct()
    following = families.select(F.col("user_id").alias("dst"))
    relations = families.where("user_id % 10 < 3").select(F.col("user_id").alias("src"), (F.col("user_id") + 1).alias("dst")).join(following, "dst", "left_semi")
    return splits.must_share(families, relations.select("src", "dst"), "user_id")


@query("""SELECT event_id, CASE WHEN event_type = 'error' THEN 'quarantine' WHEN value >= 20 THEN 'verified' WHEN value >= 10 THEN 'conflict' ELSE 'ambiguous' END AS state FROM events""")
def routed_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tagged table written by state, a folder each."""
    path = f"{Scratch(spark, 'routed').base}/states"
    state = F.when(F.col("event_type") == "error", "quarantine").when(F.col("value") >= 20, "verified").when(F.col("value") >= 10, "conflict").otherwise("ambiguous")
    A.write_run(table(spark, sf_dir, "events").select("event_id", state.alias("state")), path, ["state"])
    return spark.read.schema("event_id long, state string").parquet(path)


def _quarters(spark: SparkSession, sf_dir: str, path: str, numbers: tuple[int, ...], overlap: int = 0) -> None:
    """Files of the events' quarters by id, each with overlap events of the one before."""
    events = table(spark, sf_dir, "events")
    size = events.count() // 4 + 1
    for k in numbers:
        events.where((F.col("event_id") >= k * size - overlap) & (F.col("event_id") < (k + 1) * size)).coalesce(1).write.mode("append").parquet(path)


def _stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event of each user, by batches of one file; the stream stops after two files and goes on from its checkpoint."""
    base = Scratch(spark, "upsert").base
    sink = S.upsert(lambda k: f"{base}/out/b={k}", ["user_id"], ["event_id"])
    for quarters in ((0, 1), (2, 3)):
        _quarters(spark, sf_dir, f"{base}/in", quarters)
        S.run_available(_stream(spark, f"{base}/in").select("user_id", "event_id", "event_type"), sink, f"{base}/checkpoint")
    state = spark.read.schema("user_id long, event_id long, event_type string").parquet(f"{base}/out/*")
    return latest(state, ["user_id"], F.col("event_id"))


@query("SELECT event_id, user_id, event_type FROM events")
def stream_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of files that overlap, each event once: the state that knows them lasts from batch to batch and over a restart."""
    base = Scratch(spark, "replayed").base
    for quarters in ((0, 1), (2, 3)):
        _quarters(spark, sf_dir, f"{base}/in", quarters, overlap=50)
        out = S.drop_repeats(_stream(spark, f"{base}/in"), ["event_id"], "400 days").select("event_id", "user_id", "event_type")
        S.run_available(out, lambda batch, k: batch.write.mode("overwrite").parquet(f"{base}/out/b={k}"), f"{base}/checkpoint")
    return spark.read.schema("event_id long, user_id long, event_type string").parquet(f"{base}/out/*")


@query("""WITH b AS (SELECT user_id, epoch_us(ts) // 3600000000 AS h FROM events), w AS (SELECT user_id, h - k AS h0 FROM b, generate_series(0, 11) AS g(k))
SELECT user_id, h0 * 3600000000 AS start_us, count(*) AS n FROM w GROUP BY 1, 2""")
def stream_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of twelve hours, every hour: the stream counts hours in update mode, of which the last values make up the windows."""
    base = Scratch(spark, "trailing").base
    _quarters(spark, sf_dir, f"{base}/in", (0, 1, 2, 3))
    out = S.trailing_counts(_stream(spark, f"{base}/in"), "user_id", "1 hour", "1 hour", late="400 days")
    S.run_available(out, lambda batch, k: batch.withColumn("batch", F.lit(k)).write.mode("overwrite").parquet(f"{base}/out/b={k}"), f"{base}/checkpoint", "update")
    rows = spark.read.schema(f"{out.schema.toDDL()}, batch int").parquet(f"{base}/out/*")
    hours = latest(rows, ["user_id", "start"], F.col("batch"))
    return S.spread_steps(hours, "user_id", 12).select("user_id", F.unix_micros("start").alias("start_us"), "n")


@query("""WITH d AS (SELECT user_id, event_id, epoch_us(ts) AS t FROM events), q AS (SELECT *, event_id // (SELECT count(*) // 4 + 1 FROM events) AS k FROM d),
m AS (SELECT k, max(t) AS t FROM q GROUP BY 1) SELECT event_id FROM q WHERE k > 0 AND event_id % 7 = 0""")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that come after the watermark has passed them: every seventh event is dated back by a year, and those of the first batch are in time."""
    base = Scratch(spark, "late").base
    _quarters(spark, sf_dir, f"{base}/in", (0, 1, 2, 3))
    rows = _stream(spark, f"{base}/in")
    rows = rows.withColumn("ts", F.when(F.col("event_id") % 7 == 0, F.col("ts") - F.expr("interval 365 days")).otherwise(F.col("ts")))
    S.run_available(rows.select("event_id", "ts"), S.late_rows(spark, f"{base}/marks", f"{base}/late", "ts", "1 day"), f"{base}/checkpoint")
    return spark.read.schema("event_id long, ts timestamp").parquet(f"{base}/late/*").select("event_id")
