"""Queries over samples, shards and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.hashing import hash_bucket, hash_order
from colloquy.operators import splits as O
from colloquy.operators import windows as W
from colloquy.plans.base import query
from colloquy.tables import table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")


@query("SELECT doc_id, source FROM documents ORDER BY sha256('v1|' || doc_id) LIMIT 100")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampling operator: the hundred documents that come first in hash order."""
    return O.hash_sample(_documents(spark, sf_dir).select("doc_id", "source"), "v1", F.col("doc_id"), 100)


@query("WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('spot|' || doc_id)) AS rn FROM documents) SELECT doc_id, lang FROM r WHERE rn <= 20")
def stratum_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.group_sample(_documents(spark, sf_dir).select("doc_id", "lang"), ["lang"], "spot", F.col("doc_id"), 20)


@query("SELECT CASE CAST(concat('0x', substr(sha1(doc_id::VARCHAR), 1, 8)) AS BIGINT) % 5 WHEN 0 THEN 'validation' ELSE 'train' END AS split, count(*) AS n FROM documents GROUP BY 1")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = F.when(hash_bucket(F.col("doc_id"), 5) == 0, "validation").otherwise("train")
    return _documents(spark, sf_dir).groupBy(split.alias("split")).agg(F.count("*").alias("n"))


@query("WITH r AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS p FROM events) SELECT user_id, (p % 4)::BIGINT AS shard, count(*) AS n FROM r GROUP BY 1, 2")
def round_robin_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", (W.place(["user_id"], ["event_id"]) % 4).alias("shard"))
    return rows.groupBy("user_id", "shard").agg(F.count("*").alias("n"))


@query("WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, source) AS rn FROM c) SELECT source, n, CASE WHEN rn IN (2, 5) THEN 'validation' WHEN rn IN (3, 4) THEN 'sealed' ELSE 'train' END AS split FROM r")
def split_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.size_slots(_documents(spark, sf_dir), "source")


@query("""WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, source) <= 2 AS top, sha256('split-v1|' || source) AS h, sum(n) OVER () AS total FROM c),
b AS (SELECT *, coalesce(sum(CASE WHEN top THEN 0 ELSE n END) OVER (ORDER BY h, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / total::DOUBLE AS b FROM r)
SELECT source, n, CASE WHEN top THEN 'train' WHEN b < 0.08 THEN 'sealed' WHEN b < 0.16 THEN 'validation' ELSE 'train' END AS split FROM b""")
def split_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _documents(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"))
    return O.hash_filled_splits(counts, "source")


@query("""WITH m AS (SELECT doc_id, source AS root, CASE WHEN doc_id % 10 = 0 THEN CASE WHEN source[4:4] IN ('1', '2') THEN 'sealed' WHEN source[4:4] = '3' AND doc_id % 20 = 0 THEN 'validation' ELSE 'train' END END AS split FROM documents),
g AS (SELECT root, max(CASE split WHEN 'sealed' THEN 3 WHEN 'validation' THEN 2 WHEN 'train' THEN 1 END) AS r, count(DISTINCT split) AS k FROM m GROUP BY 1)
SELECT root, CASE r WHEN 3 THEN 'sealed' WHEN 2 THEN 'validation' WHEN 1 THEN 'train' END AS split, k > 1 AS conflict FROM g""")
def inherited_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits that earlier assignments force on whole sources; mixed lineage is a conflict."""
    rows = _documents(spark, sf_dir)
    kind = F.substring("source", 4, 1)
    split = F.when(kind.isin("1", "2"), "sealed").when((kind == "3") & (F.col("doc_id") % 20 == 0), "validation").otherwise("train")
    authority = rows.where("doc_id % 10 = 0").select(F.col("doc_id").alias("member"), split.alias("split"))
    return O.inherit_splits(rows.select(F.col("source").alias("root"), F.col("doc_id").alias("member")), authority)


@query("""WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1), l AS (SELECT lang, CASE WHEN n > 0.4 * sum(n) OVER () THEN floor((sum(n) OVER () - n) * 0.4 / 0.6) ELSE n END AS lim FROM c),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('cap|' || doc_id)) AS rn FROM documents) SELECT lang, count(*) AS n, min(doc_id) AS first_id FROM r JOIN l USING (lang) WHERE rn <= lim GROUP BY 1""")
def concentration_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampling operator: the commonest language cut to two fifths of what is left."""
    kept = O.concentration_cap(_documents(spark, sf_dir), "lang", [hash_order("cap", F.col("doc_id"))], 0.4)
    return kept.groupBy("lang").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@query("WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS p FROM events) SELECT user_id, event_id FROM r WHERE p % 10 = 0")
def stride_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", W.place(["user_id"], ["event_id"]).alias("p"))
    return rows.where("p % 10 = 0").select("user_id", "event_id")


@query("""WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS p, count(*) OVER (PARTITION BY user_id) AS n FROM events), k AS (SELECT i FROM generate_series(0, 4) AS g(i))
SELECT DISTINCT user_id, event_id FROM r, k WHERE p = round_even(i * (n - 1) / 4.0, 0)::BIGINT""")
def even_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five rows of each user, evenly spread from the first to the last."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", W.place(["user_id"], ["event_id"]).alias("p"), F.count("*").over(W.W.partitionBy("user_id")).alias("n"))
    places = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.bround(i * (F.col("n") - 1) / F.lit(4.0), 0).cast("long"))
    return rows.where(F.array_contains(places, F.col("p"))).select("user_id", "event_id")


@query("""WITH q AS (SELECT d.doc_id, source, quality, toxic, n_chars FROM documents d JOIN labels USING (doc_id)) SELECT view, count(*) AS n, min(doc_id) AS first_id FROM (SELECT 'natural' AS view, doc_id FROM q UNION ALL SELECT 'high_precision', doc_id FROM q WHERE quality = 1 AND toxic = 0
UNION ALL SELECT 'balanced', doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY sha256('bal|' || doc_id)) AS rn FROM q) WHERE rn <= 5) GROUP BY 1""")
def sampling_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural, balanced and high-precision views of the labelled documents."""
    rows = _documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    parts = {"natural": rows, "high_precision": rows.where("quality = 1 and toxic = 0"), "balanced": O.group_sample(rows, ["source"], "bal", F.col("doc_id"), 5)}
    tagged = [p.select(F.lit(name).alias("view"), "doc_id") for name, p in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).groupBy("view").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))
