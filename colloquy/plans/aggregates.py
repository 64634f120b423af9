"""Queries over aggregates and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import stats as S
from colloquy.operators import windows as W
from colloquy.plans.base import query
from colloquy.plans.windows import SPANS, spans
from colloquy.tables import table


@query("""WITH a AS (SELECT event_type, list_sort(list(value)) AS v FROM events GROUP BY 1)
SELECT event_type, v[round_even((len(v) - 1) * 0.95, 0)::INT + 1] AS p95, v[floor((len(v) - 1) * 0.95)::INT + 1] AS p95_floor, v[round_even((len(v) - 1) * 0.5, 0)::INT + 1] AS p50 FROM a""")
def nearest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_type", "value")
    part = lambda q, name, rule="nearest": S.ranked_value(rows, ["event_type"], "value", q, rule).withColumnRenamed("value", name)
    return part(0.95, "p95").join(part(0.95, "p95_floor", "floor"), "event_type").join(part(0.5, "p50"), "event_type")


@query("""SELECT user_id, round(CASE WHEN count(value) > 2 THEN (sum(value) - min(value) - max(value)) / (count(value) - 2) ELSE avg(value) END, 6) AS trimmed, round(median(value), 6) AS middle, round(quantile_cont(value, 0.05), 6) AS p05,
round(avg((value >= 40)::INT), 6) AS vote FROM events GROUP BY 1""")
def robust_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.round(S.trimmed_mean(v), 6).alias("trimmed"), F.round(F.median(v), 6).alias("middle"), F.round(F.percentile(v, 0.05), 6).alias("p05"), F.round(F.avg((v >= 40).cast("int")), 6).alias("vote")
    )


@query("""WITH g AS (SELECT d.source, count(*) AS n, sum(quality) AS k FROM labels l JOIN documents d USING (doc_id) GROUP BY 1), z AS (SELECT *, 1.959963984540054 AS z, k::DOUBLE / n AS p FROM g)
SELECT source, n, k::BIGINT AS hits, round(greatest(0.0, (p + z * z / (2 * n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)), 6) AS low, round(least(1.0, (p + z * z / (2 * n) + z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)), 6) AS high FROM z""")
def wilson_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of good documents a source with its Wilson interval."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    counts = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("quality").alias("hits"))
    low, high = S.wilson(F.col("hits"), F.col("n"))
    return counts.select("source", "n", "hits", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query("""WITH r AS (SELECT source, lang, quality FROM labels JOIN documents USING (doc_id)), s AS (SELECT source, lang, avg(quality) AS a FROM r GROUP BY 1, 2), t AS (SELECT source, avg(a) AS a FROM s GROUP BY 1)
SELECT round((SELECT avg(quality) FROM r), 6) AS by_row, round((SELECT avg(a) FROM s), 6) AS by_cell, round((SELECT avg(a) FROM t), 6) AS by_source""")
def balanced_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rate with rows, cells and sources as the unit of weight."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), "doc_id")
    cells = rows.groupBy("source", "lang").agg(F.avg("quality").alias("a"), F.sum("quality").alias("k"), F.count("*").alias("n"))
    sources = cells.groupBy("source").agg(F.avg("a").alias("a"), F.sum("k").alias("k"), F.sum("n").alias("n"), F.sum("a").alias("cells"), F.count("*").alias("m"))
    return sources.agg(
        F.round(F.sum("k") / F.sum("n"), 6).alias("by_row"), F.round(F.sum("cells") / F.sum("m"), 6).alias("by_cell"), F.round(F.avg("a"), 6).alias("by_source")
    )


@query("""SELECT CASE WHEN grouping(source) = 1 THEN '*' ELSE source END AS source, CASE WHEN grouping(lang) = 1 THEN '*' ELSE lang END AS lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY ROLLUP (source, lang)""")
def rollup_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").rollup("source", "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.grouping("source").alias("gs"), F.grouping("lang").alias("gl"))
    return rows.select(F.when(F.col("gs") == 1, "*").otherwise(F.col("source")).alias("source"), F.when(F.col("gl") == 1, "*").otherwise(F.col("lang")).alias("lang"), "n", "chars")


@query("""SELECT CASE WHEN grouping(o_orderstatus) = 1 THEN '*' ELSE o_orderstatus END AS status, CASE WHEN grouping(o_orderpriority) = 1 THEN '*' ELSE o_orderpriority END AS priority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def cube_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.grouping("o_orderstatus").alias("gs"), F.grouping("o_orderpriority").alias("gp"))
    return rows.select(F.when(F.col("gs") == 1, "*").otherwise(F.col("o_orderstatus")).alias("status"), F.when(F.col("gp") == 1, "*").otherwise(F.col("o_orderpriority")).alias("priority"), "n")


@query("""SELECT o_orderpriority AS priority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1""")
def nested_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority")).pivot("o_orderstatus", ["F", "O", "P"]).count()


@query("""SELECT source, count(*) AS n, count(DISTINCT lang) AS langs, count(DISTINCT text) AS texts, max(n_chars) AS longest, array_to_string(list_sort(list_distinct(list(lang))), ',') AS names FROM documents GROUP BY 1""")
def group_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count("*").alias("n"), F.count_distinct("lang").alias("langs"), F.count_distinct("text").alias("texts"), F.max("n_chars").alias("longest"), F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("names")
    )


@query("""WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS rn, sum(n) OVER (PARTITION BY source) AS total FROM c)
SELECT source, max(CASE WHEN rn = 1 THEN lang END) AS mode, round(max(CASE WHEN rn = 1 THEN n END) / max(total)::DOUBLE, 6) AS share, coalesce(max(CASE WHEN rn = 2 THEN n END) >= 0.8 * max(CASE WHEN rn = 1 THEN n END), false) AS doubtful FROM r GROUP BY 1""")
def dominant_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commonest language of a source, its share, and whether the second comes within four fifths."""
    counts = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    top = W.top_by(counts, ["source"], [F.desc("n"), F.col("lang")], 2)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "lang")))
    out = counts.groupBy("source").agg(F.sum("n").alias("total")).join(top.groupBy("source").agg(ordered.alias("o")), "source")
    first, second = F.get("o", F.lit(0)), F.get("o", F.lit(1))
    doubtful = F.coalesce(-second["k"] >= 0.8 * -first["k"], F.lit(False))
    return out.select("source", first["lang"].alias("mode"), F.round(-first["k"] / F.col("total"), 6).alias("share"), doubtful.alias("doubtful"))


@query("""WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, source) AS rn FROM c)
SELECT round(max(n) / sum(n)::DOUBLE, 6) AS largest_share, round(sum(n) FILTER (rn <= 3) / sum(n)::DOUBLE, 6) AS top3_share, median(n) AS median_rows, count(*) AS sources FROM r""")
def concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    top3 = counts.orderBy(F.desc("n"), "source").limit(3).agg(F.sum("n").alias("top3"))
    out = counts.agg(F.max("n").alias("most"), F.sum("n").alias("total"), F.median("n").alias("median_rows"), F.count("*").alias("sources"))
    joined = out.crossJoin(F.broadcast(top3))  # one row each
    return joined.select(
        F.round(F.col("most") / F.col("total"), 6).alias("largest_share"), F.round(F.col("top3") / F.col("total"), 6).alias("top3_share"), "median_rows", "sources"
    )


@query("""SELECT d.source, count(*) AS labelled, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic, CASE WHEN count(*) FILTER (toxic = 1) = 0 THEN 'PASS' WHEN count(*) FILTER (toxic = 1) < 0.05 * count(*) THEN 'PARTIAL' ELSE 'FAIL' END AS gate
FROM labels l JOIN documents d USING (doc_id) GROUP BY 1""")
def gate_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only explicit labels count; each source passes, passes in part or fails."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    out = rows.groupBy("source").agg(F.count("*").alias("labelled"), S.explicit_true(F.col("quality") == 1).alias("good"), S.explicit_true(F.col("toxic") == 1).alias("toxic"))
    gate = F.when(F.col("toxic") == 0, "PASS").when(F.col("toxic") < 0.05 * F.col("labelled"), "PARTIAL").otherwise("FAIL")
    return out.withColumn("gate", gate)


@query("""WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) SELECT source, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS examples FROM r WHERE rn <= 3 GROUP BY 1""")
def capped_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = W.top_by(table(spark, sf_dir, "documents").select("source", "doc_id"), ["source"], [F.col("doc_id")], 3)
    return rows.groupBy("source").agg(F.array_join(F.array_sort(F.collect_list("doc_id")), ",").alias("examples"))


@query("""SELECT stage, n FROM (SELECT 1 AS o, 'all' AS stage, count(*) AS n FROM documents UNION ALL SELECT 2, 'long', count(*) FROM documents WHERE n_chars >= 500 UNION ALL SELECT 3, 'english', count(*) FROM documents WHERE n_chars >= 500 AND lang = 'en'
UNION ALL SELECT 4, 'distinct', count(DISTINCT text) FROM documents WHERE n_chars >= 500 AND lang = 'en')""")
def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each filter leaves, counted in one pass."""
    long, english = F.col("n_chars") >= 500, F.col("lang") == "en"
    counts = table(spark, sf_dir, "documents").agg(
        F.count("*").alias("all"), F.count_if(long).alias("long"), F.count_if(long & english).alias("english"), F.count_distinct(F.when(long & english, F.col("text"))).alias("distinct")
    )
    return counts.unpivot([], ["all", "long", "english", "distinct"], "stage", "n")


@query(f"""WITH {SPANS}, m AS (SELECT * FROM spans), p AS (SELECT a.event_id, b.event_type, sum(least(a.e, b.e) - greatest(a.s, b.s)) AS ov FROM m a JOIN m b ON a.user_id = b.user_id AND a.event_id <> b.event_id AND a.event_type = 'purchase' AND a.s < b.e AND b.s < a.e GROUP BY 1, 2),
t AS (SELECT event_id, sum(ov) AS total, max(ov) AS most, arg_max(event_type, (ov, event_type)) AS winner FROM p GROUP BY 1)
SELECT event_id, winner, total::BIGINT AS total FROM t WHERE total >= 60000 AND most >= 0.9 * total""")
def dominance_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type that covers at least nine tenths of what overlaps a purchase, if that is a minute or more."""
    from colloquy.operators.joins import overlap_join, overlap_length
    from colloquy.plans.joins import HOUR, _left, _right

    pairs = overlap_join(_left(spark, sf_dir).where("event_type = 'purchase'"), _right(spark, sf_dir), ["user_id"], 2 * HOUR).where("event_id <> other")
    ov = overlap_length(F.col("start"), F.col("end"), F.col("start_r"), F.col("end_r"))
    by_type = pairs.groupBy("event_id", "type_r").agg(F.sum(ov).alias("ov"))
    out = by_type.groupBy("event_id").agg(F.sum("ov").alias("total"), F.max(F.struct("ov", "type_r")).alias("top"))
    return out.where((F.col("total") >= 60_000) & (F.col("top.ov") >= 0.9 * F.col("total"))).select("event_id", F.col("top.type_r").alias("winner"), "total")


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.to_timestamp(F.lit("1998-09-02")).cast("timestamp_ntz"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n")
    )


@query()
def bootstrap_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 95 percent interval of the mean quality a source, from Poisson bootstrap weights drawn by hash."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    from colloquy.operators.resampling import poisson_bootstrap

    return poisson_bootstrap(rows, "source", "doc_id", "quality", draws=200)
