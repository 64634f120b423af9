"""Queries over embeddings. Label 0 is the target; vec_id modulo 10 stands for the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators import clustering
from colloquy.operators import vectors as O
from colloquy.operators import windows as W
from colloquy.plans.base import query
from colloquy.tables import table

DIMS = """v AS (SELECT vec_id, label, vec_id % 10 AS source, embedding FROM embeddings), x AS (SELECT vec_id, label, source, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM v)"""
LOO = f"""{DIMS}, a AS (SELECT label, i, sum(x) AS s, count(*) AS n FROM x GROUP BY 1, 2), o AS (SELECT label, source, i, sum(x) AS s, count(*) AS n FROM x GROUP BY 1, 2, 3), g AS (SELECT DISTINCT source FROM v),
p AS (SELECT g.source, a.label, a.i, CASE WHEN a.n - coalesce(o.n, 0) < 10 THEN a.s / a.n ELSE (a.s - coalesce(o.s, 0)) / (a.n - coalesce(o.n, 0)) END AS m FROM a CROSS JOIN g LEFT JOIN o ON o.label = a.label AND o.source = g.source AND o.i = a.i),
sc AS (SELECT x.vec_id, any_value(x.label) AS label, any_value(x.source) AS source, p.label AS candidate, sum(x.x * p.m) / (sqrt(sum(x.x * x.x)) * sqrt(sum(p.m * p.m))) AS score FROM x JOIN p ON p.source = x.source AND p.i = x.i GROUP BY x.vec_id, p.label)"""
MARGIN = f"""{LOO}, mg AS (SELECT vec_id, any_value(label) AS label, any_value(source) AS source, max(score) FILTER (candidate = 0) AS t, max(score) FILTER (candidate <> 0) AS o FROM sc GROUP BY 1)"""


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", (F.col("vec_id") % 10).alias("source"), "embedding")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir)
    protos = O.held_out_prototypes(rows, "label", "embedding", "source")
    return O.scores(rows, protos, ["source"], "vec_id", "embedding", "label")


def _margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = O.margins(_scored(spark, sf_dir), "vec_id", F.col("candidate") == 0)
    return out.join(_vectors(spark, sf_dir).select("vec_id", "label", "source"), "vec_id")


@query(f"""WITH {DIMS}, n AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM x GROUP BY 1) SELECT vec_id, round(n, 4) AS length, round((embedding[1]::DOUBLE / n), 4) AS first FROM n JOIN v USING (vec_id)""")
def l2_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir)
    return rows.select("vec_id", F.round(O.norm(F.col("embedding")), 4).alias("length"), F.round(F.get(O.unit(F.col("embedding")), F.lit(0)), 4).alias("first"))


@query(f"""WITH {DIMS}, m AS (SELECT label, i, avg(x) AS m FROM x GROUP BY 1, 2), l AS (SELECT label, sqrt(sum(m * m)) AS n FROM m GROUP BY 1) SELECT label, (i - 1)::INT AS i, round(m / n, 4) AS m FROM m JOIN l USING (label)""")
def class_prototypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    protos = O.prototypes(_vectors(spark, sf_dir), "label", "embedding", "source", 2)
    return protos.select("label", F.posexplode("prototype").alias("i", "m")).withColumn("m", F.round("m", 4))


@query(f"WITH {LOO} SELECT vec_id, candidate, round(score, 4) AS score FROM sc")
def proto_loo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("vec_id", "candidate", F.round("score", 4).alias("score"))


@query(f"WITH {MARGIN} SELECT vec_id, round(t, 4) AS target_score, round(o, 4) AS other_score, round(t - o, 4) AS margin FROM mg")
def margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _margins(spark, sf_dir).select("vec_id", *[F.round(c, 4).alias(c) for c in ("target_score", "other_score", "margin")])


@query(f"WITH {MARGIN} SELECT source, label, count(*) AS n, round(median(t - o), 4) AS middle FROM mg GROUP BY 1, 2")
def margin_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _margins(spark, sf_dir).groupBy("source", "label").agg(F.count("*").alias("n"), F.round(F.median("margin"), 4).alias("middle"))


@query(f"""WITH {LOO}, r AS (SELECT *, row_number() OVER w AS rn, lead(score) OVER w AS second FROM sc WINDOW w AS (PARTITION BY vec_id ORDER BY score DESC, candidate DESC)) SELECT label, candidate AS predicted, count(*) AS n, round(avg(score - second), 4) AS lead FROM r WHERE rn = 1 GROUP BY 1, 2""")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest held-out prototype against the label."""
    out = O.classify(_scored(spark, sf_dir), "vec_id", "label")
    return out.groupBy("label", "predicted").agg(F.count("*").alias("n"), F.round(F.avg("margin"), 4).alias("lead"))


SWEEP = f"""{MARGIN}, q AS (SELECT round(t - o, 4) AS s, label = 0 AS p FROM mg), grid AS (SELECT round(k * 0.005, 6) AS threshold FROM generate_series(0, 100) AS z(k)),
sw AS (SELECT threshold, count(*) FILTER (s >= threshold AND p) AS tp, count(*) FILTER (s >= threshold AND NOT p) AS fp, round(count(*) FILTER (s >= threshold AND p) / count(*) FILTER (p)::DOUBLE, 6) AS recall,
       round(count(*) FILTER (s >= threshold AND NOT p) / count(*) FILTER (NOT p)::DOUBLE, 6) AS false_positive_rate FROM q, grid GROUP BY 1)"""


def _sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _margins(spark, sf_dir).select(F.round("margin", 4).alias("s"), "label")
    return O.threshold_sweep(rows, "s", F.col("label") == 0, 0.0, 0.5, 100)


@query(f"WITH {SWEEP} SELECT threshold::DOUBLE AS threshold, tp, fp, recall, false_positive_rate FROM sw")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sweep(spark, sf_dir)


@query(f"""WITH {SWEEP}, c AS (SELECT *, row_number() OVER (ORDER BY (fp = 0 AND recall >= 0.9)::INT DESC, CASE WHEN fp = 0 AND recall >= 0.9 THEN -recall ELSE false_positive_rate END, threshold DESC) AS rn FROM sw) SELECT threshold::DOUBLE AS threshold, tp, fp, recall, false_positive_rate FROM c WHERE rn = 1""")
def threshold_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.choose_threshold(_sweep(spark, sf_dir))


@query(f"""WITH {MARGIN}, q AS (SELECT round(t - o, 4) AS s, label = 0 AS p FROM mg), b AS (SELECT max(s) + 0.0001 AS bound FROM q WHERE NOT p) SELECT round(any_value(bound), 4) AS bound, count(*) FILTER (p AND s >= bound) AS kept, count(*) FILTER (NOT p AND s >= bound) AS false_accepts FROM q, b""")
def zero_fp_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least bound above every non-target's margin, and what it keeps."""
    rows = _margins(spark, sf_dir).select(F.round("margin", 4).alias("s"), (F.col("label") == 0).alias("p"))
    bound = rows.agg((F.max(F.when(~F.col("p"), F.col("s"))) + 0.0001).alias("bound"))
    above = F.col("s") >= F.col("bound")
    return rows.crossJoin(F.broadcast(bound)).agg(  # one row on the right
        F.round(F.first("bound"), 4).alias("bound"), F.count_if(F.col("p") & above).alias("kept"), F.count_if(~F.col("p") & above).alias("false_accepts")
    )


@query(f"""WITH {MARGIN}, d AS (SELECT vec_id, list_sort(list_transform(embedding[1:32], lambda z: z::DOUBLE)) AS e, embedding AS f FROM embeddings)
SELECT mg.vec_id, CASE WHEN round(t - o, 4) >= 0.02 AND f[1] >= 0 THEN 'ACCEPT' WHEN round(t - o, 4) < 0 AND f[1] < 0 THEN 'REJECT' ELSE 'DISAGREE' END AS decision FROM mg JOIN d USING (vec_id)""")
def ensemble_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models must agree: the prototype margin, and the first dimension as a second one."""
    second = _vectors(spark, sf_dir).select("vec_id", F.get("embedding", F.lit(0)).alias("m2"))
    m1 = F.round("margin", 4)
    decision = F.when((m1 >= 0.02) & (F.col("m2") >= 0), "ACCEPT").when((m1 < 0) & (F.col("m2") < 0), "REJECT").otherwise("DISAGREE")
    return _margins(spark, sf_dir).join(second, "vec_id").select("vec_id", decision.alias("decision"))


@query("""WITH s AS (SELECT vec_id, embedding AS e, list_sort(embedding) AS o FROM embeddings), m AS (SELECT *, (o[32] + o[33]) / 2 AS mid FROM s) SELECT vec_id, array_to_string(list_transform(e, lambda x: CASE WHEN x >= mid THEN '1' ELSE '0' END), '') AS bits FROM m""")
def vector_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir).select("vec_id", O.median_bits(F.col("embedding")).alias("bits"))


@query(f"""WITH {MARGIN}, ag AS (SELECT source, avg((t >= o)::INT) AS agree, avg(t - o) AS m FROM mg GROUP BY 1) SELECT mg.vec_id FROM mg JOIN ag USING (source) WHERE ag.agree >= 0.08 AND ag.m >= -0.2 AND t >= o""")
def consistent_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right rows of sources that agree often enough and by enough."""
    rows = _margins(spark, sf_dir).withColumn("right", F.col("target_score") >= F.col("other_score"))
    w = W.W.partitionBy("source")
    kept = rows.withColumn("agree", F.avg(F.col("right").cast("int")).over(w)).withColumn("m", F.avg("margin").over(w))
    return kept.where("agree >= 0.08 and m >= -0.2 and right").select("vec_id")


#: Vectors of unit length; fifty vectors that follow one another are a recording.
UNITS = "u AS (SELECT vec_id, vec_id // 50 AS grp, label, embedding::DOUBLE[] AS v FROM embeddings)"


def _recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return rows.select(F.floor(F.col("vec_id") / 50).alias("grp"), F.col("vec_id").alias("id"), F.col("label").alias("cluster"), F.col("embedding").alias("vector"))


@query(f"""WITH {UNITS}, d AS (SELECT a.vec_id, a.label, b.label AS other, 1 - list_cosine_similarity(a.v, b.v) AS d FROM u a JOIN u b ON a.vec_id <> b.vec_id),
m AS (SELECT vec_id, label, other, avg(d) AS d FROM d GROUP BY 1, 2, 3),
s AS (SELECT vec_id, label, any_value(d) FILTER (label = other) AS a, min(d) FILTER (label <> other) AS b FROM m GROUP BY 1, 2)
SELECT vec_id, label, round(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END, 6) AS silhouette FROM s""")
def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well each vector lies in its label, over the whole table."""
    rows = clustering.silhouette(_recordings(spark, sf_dir).withColumn("grp", F.lit(0)))
    return rows.select(F.col("id").alias("vec_id"), F.col("cluster").alias("label"), F.round("silhouette", 6).alias("silhouette"))


@query()
def average_linkage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each recording's vectors in three clusters, with the confidence of each; a test compares it with merging one pair at a time."""
    rows = _recordings(spark, sf_dir).drop("cluster")
    told = rows.join(clustering.average_linkage(rows, 3), ["grp", "id"])
    return clustering.centroid_confidence(told).withColumn("confidence", F.round("confidence", 6))


@query(f"""WITH RECURSIVE {UNITS}, n AS (SELECT grp, vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM u),
r AS (SELECT grp, 0 AS k, arg_min(v, vec_id) AS c0, arg_max(v, vec_id) AS c1, arg_min(v, vec_id) AS p0, arg_max(v, vec_id) AS p1 FROM n GROUP BY 1
    UNION ALL
    SELECT grp, k + 1, coalesce(list_transform(m0, lambda x: x / sqrt(list_dot_product(m0, m0))), c0), coalesce(list_transform(m1, lambda x: x / sqrt(list_dot_product(m1, m1))), c1), c0, c1
    FROM (SELECT grp, k, c0, c1, list(s ORDER BY i) FILTER (c = 0) AS m0, list(s ORDER BY i) FILTER (c = 1) AS m1
          FROM (SELECT r.grp, k, c0, c1, (list_dot_product(v, c1) > list_dot_product(v, c0))::INT AS c, i, sum(v[i]) AS s
                FROM r JOIN n ON n.grp = r.grp, generate_series(1, 64) AS g(i) WHERE k < 8 GROUP BY ALL) GROUP BY 1, 2, 3, 4)),
e AS (SELECT n.vec_id, list_dot_product(v, p1) > list_dot_product(v, p0) AS second, list_dot_product(v, c0) AS x, list_dot_product(v, c1) AS y, count(*) OVER (PARTITION BY n.grp) AS n FROM n JOIN r ON r.grp = n.grp WHERE k = 8)
SELECT vec_id, second::INT AS cluster, greatest(x, y) >= 0.3 AND least(x, y) >= 0.2 AND abs(x - y) < 0.08 AND n > 1 AS overlap FROM e""")
def two_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each recording's vectors in two clusters; bounds of overlap are lower, as these vectors lie far apart."""
    rows = _recordings(spark, sf_dir).drop("cluster").withColumn("place", F.col("id"))
    return clustering.two_means(rows, high=0.3, second=0.2).select(F.col("id").alias("vec_id"), "cluster", "overlap")
