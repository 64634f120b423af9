"""Queries over graphs of shared keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import families
from colloquy.operators.graph import connected_components
from colloquy.plans.base import query
from colloquy.plans.texts import NORM
from colloquy.tables import table

STARS = f"""k AS (SELECT doc_id, source || '|' || {NORM}[1:30] AS a, lang || '|' || sha256({NORM}) AS b FROM documents),
e AS (SELECT doc_id AS x, min(doc_id) OVER (PARTITION BY a) AS y FROM k UNION SELECT doc_id, min(doc_id) OVER (PARTITION BY b) FROM k)"""


def _stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges from each document to the first that shares its start within a source, or its whole text."""
    v = T.norm(F.col("text"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("|", "source", F.substring(v, 1, 30)).alias("a"), F.concat_ws("|", "lang", F.sha2(v, 256)).alias("b"))
    part = lambda key: rows.join(rows.groupBy(key).agg(F.min("doc_id").alias("dst")), key).select(F.col("doc_id").alias("src"), "dst")
    return part("a").unionAll(part("b")).where("src <> dst").distinct()


@query(f"""WITH RECURSIVE {STARS}, r AS (SELECT doc_id, doc_id AS seen FROM documents UNION SELECT r.doc_id, CASE WHEN e.x = r.seen THEN e.y ELSE e.x END FROM r JOIN e ON e.x = r.seen OR e.y = r.seen)
SELECT doc_id AS node, min(seen) AS component FROM r GROUP BY 1 HAVING count(*) > 1""")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connected_components(_stars(spark, sf_dir))


@query(f"""WITH RECURSIVE {STARS}, r AS (SELECT doc_id, doc_id AS seen FROM documents UNION SELECT r.doc_id, CASE WHEN e.x = r.seen THEN e.y ELSE e.x END FROM r JOIN e ON e.x = r.seen OR e.y = r.seen),
c AS (SELECT doc_id AS node, min(seen) AS component FROM r GROUP BY 1 HAVING count(*) > 1)
SELECT component, 'rc_' || substr(sha1(string_agg(node::VARCHAR, '|' ORDER BY node)), 1, 16) AS cluster_id, count(*) AS members FROM c GROUP BY 1""")
def component_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable cluster ids from the sorted members."""
    return families.cluster_ids(connected_components(_stars(spark, sf_dir)))


@query("""WITH p AS (SELECT least(l.l_suppkey, m.l_suppkey) AS a, greatest(l.l_suppkey, m.l_suppkey) AS b, l.l_orderkey, least(l.l_quantity, m.l_quantity) AS overlap FROM lineitem l JOIN lineitem m ON l.l_orderkey = m.l_orderkey AND l.l_linenumber < m.l_linenumber AND l.l_suppkey <> m.l_suppkey)
SELECT a, b, count(*) AS pairs, max(overlap) AS overlap, count(*) >= 2 AND max(overlap) >= 30 AS aggregate, max(overlap) >= 48 AS ultra FROM p GROUP BY 1, 2""")
def family_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence between suppliers that share orders, and whether it is strong enough to join them."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    other = lines.select("l_orderkey", F.col("l_linenumber").alias("n2"), F.col("l_suppkey").alias("s2"), F.col("l_quantity").alias("q2"))
    pairs = lines.join(other, "l_orderkey").where("l_linenumber < n2 and l_suppkey <> s2")
    out = pairs.groupBy(F.least("l_suppkey", "s2").alias("a"), F.greatest("l_suppkey", "s2").alias("b")).agg(F.count("*").alias("pairs"), F.max(F.least("l_quantity", "q2")).alias("overlap"))
    return out.select("a", "b", "pairs", "overlap", ((F.col("pairs") >= 2) & (F.col("overlap") >= 30)).alias("aggregate"), (F.col("overlap") >= 48).alias("ultra"))


@query()
def capped_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers joined strongest first to families of at most eight; edges that would exceed it are bridges."""
    edges = family_strength(spark, sf_dir).where("aggregate or ultra").select("a", "b", "pairs", "overlap")
    return families.capped_merge(edges, 8)


@query()
def split_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families that strong edges between suppliers would join but for their size; a test compares it with a plain fold."""
    return families.split_exclusions(capped_families(spark, sf_dir))
