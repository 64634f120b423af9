"""Queries over interval, as-of, shingle, semi and outer joins, and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import joins as O
from colloquy.operators import turns as turn_ops
from colloquy.operators import windows as W
from colloquy.plans.base import query
from colloquy.plans.turns import QA, TURNS, _turns
from colloquy.plans.windows import ISLANDS, SPANS, merged, spans
from colloquy.tables import table

HOUR = 3_600_000


def _left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(spark, sf_dir).select("user_id", "event_id", "event_type", F.col("s").alias("start"), F.col("e").alias("end"))


def _right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _left(spark, sf_dir).select("user_id", F.col("event_id").alias("other"), F.col("event_type").alias("type_r"), F.col("start").alias("start_r"), F.col("end").alias("end_r"))


@query(f"""WITH {SPANS} SELECT a.event_id, b.event_id AS other, least(a.e, b.e) - greatest(a.s, b.s) AS overlap_ms
FROM spans a JOIN spans b ON a.user_id = b.user_id AND a.s < b.e AND b.s < a.e AND a.event_id < b.event_id""")
def overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = O.overlap_join(_left(spark, sf_dir), _right(spark, sf_dir), ["user_id"], 2 * HOUR).where("event_id < other")
    return pairs.select("event_id", "other", O.overlap_length(F.col("start"), F.col("end"), F.col("start_r"), F.col("end_r")).alias("overlap_ms"))


@query(f"""WITH {SPANS} SELECT a.event_id, count(b.event_id) AS others FROM spans a LEFT JOIN spans b ON a.user_id = b.user_id AND a.s < b.e AND b.s < a.e AND a.event_type = 'click' AND b.event_type = 'view'
GROUP BY 1""")
def overlap_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = _left(spark, sf_dir)
    views = _right(spark, sf_dir).where("type_r = 'view'").drop("type_r")
    clicks = O.overlap_join(left.where("event_type = 'click'"), views, ["user_id"], 2 * HOUR, how="left")
    rest = left.where("event_type <> 'click'").select("event_id", F.lit(0).cast("long").alias("others"))
    return clicks.groupBy("event_id").agg(F.count("other").alias("others")).unionByName(rest)


@query(f"""WITH {ISLANDS} SELECT m.user_id, m.island, count(*) AS inside FROM merged m JOIN spans a ON a.user_id = m.user_id AND a.s >= m.s - 1 AND a.e <= m.e + 1 GROUP BY 1, 2""")
def containment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that lie inside merged intervals."""
    islands = merged(spark, sf_dir).select("user_id", "island", F.col("s").alias("start_r"), F.col("e").alias("end_r"))
    pairs = O.overlap_join(_left(spark, sf_dir), islands, ["user_id"], 2 * HOUR, closed=True)
    inside = (F.col("start") >= F.col("start_r") - 1) & (F.col("end") <= F.col("end_r") + 1)
    return pairs.where(inside).groupBy("user_id", "island").agg(F.count("*").alias("inside"))


@query(f"""WITH {ISLANDS}, p AS (SELECT *, s + (e - s) // 2 AS mid FROM spans) SELECT p.event_id, m.island FROM p JOIN merged m ON m.user_id = p.user_id AND p.mid BETWEEN m.s AND m.e""")
def midpoint_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = spans(spark, sf_dir).select("user_id", "event_id", F.expr("s + (e - s) div 2").alias("mid"))
    islands = merged(spark, sf_dir).select("user_id", "island", F.col("s").alias("start_r"), F.col("e").alias("end_r"))
    return O.point_join(points, islands, ["user_id"], "mid", 2 * HOUR).select("event_id", "island")


@query(f"""WITH {SPANS}, p AS (SELECT a.event_id, b.event_id AS other, least(a.e, b.e) - greatest(a.s, b.s) AS overlap, abs((a.s + a.e) - (b.s + b.e)) AS c
      FROM spans a JOIN spans b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'view' AND a.s < b.e AND b.s < a.e),
r AS (SELECT *, row_number() OVER w AS rn, lead(overlap) OVER w AS second FROM p WINDOW w AS (PARTITION BY event_id ORDER BY overlap DESC, c, other))
SELECT event_id, other, overlap, coalesce(second >= 0.9 * overlap, false) AS ambiguous FROM r WHERE rn = 1""")
def best_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view that overlaps each click longest, and whether a second one comes near."""
    pairs = O.overlap_join(_left(spark, sf_dir).where("event_type = 'click'"), _right(spark, sf_dir).where("type_r = 'view'"), ["user_id"], 2 * HOUR)
    return O.best_overlap(pairs, ["event_id"], "other").select("event_id", "other", "overlap", "ambiguous")


@query(f"""WITH {TURNS}, {QA}, p AS (SELECT *, max(CASE WHEN identity = 'NON_TARGET' AND text_qa = 'PASS' AND NOT bad THEN idx END) OVER (PARTITION BY source_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS c FROM annotated)
SELECT p.turn_id, q.turn_id AS context_turn_id, CASE WHEN p.start_ms - q.end_ms <= 10000 THEN 10 WHEN p.start_ms - q.end_ms <= 30000 THEN 30 WHEN p.start_ms - q.end_ms <= 60000 THEN 60 WHEN p.start_ms - q.end_ms <= 120000 THEN 120 END::BIGINT AS horizon
FROM p JOIN annotated q ON q.source_id = p.source_id AND q.idx = p.c WHERE p.identity = 'TARGET_HIGH'""")
def asof_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest clean turn of another speaker before each target, with the least horizon that reaches it."""
    noted = turn_ops.annotate(_turns(spark, sf_dir))
    usable = (F.col("identity") == "NON_TARGET") & (F.col("text_qa") == "PASS") & ~F.col("bad")
    rows = O.asof_backward(noted, ["source_id"], ["idx"], F.struct("turn_id", "end_ms"), usable, "found").where("identity = 'TARGET_HIGH' and found is not null")
    ago = F.col("start_ms") - F.col("found.end_ms")
    horizon = F.when(ago <= 10_000, 10).when(ago <= 30_000, 30).when(ago <= 60_000, 60).when(ago <= 120_000, 120)
    return rows.select("turn_id", F.col("found.turn_id").alias("context_turn_id"), horizon.cast("long").alias("horizon"))


@query(f"""WITH {SPANS}, p AS (SELECT * FROM spans WHERE event_type = 'purchase'), v AS (SELECT user_id, s AS seen_ms, max(event_id) AS seen FROM spans WHERE event_type = 'view' GROUP BY 1, 2)
SELECT p.event_id, v.seen, v.seen_ms FROM p ASOF JOIN v ON p.user_id = v.user_id AND p.s >= v.seen_ms""")
def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last view before each purchase that has one."""
    rows = spans(spark, sf_dir)
    bought = rows.where("event_type = 'purchase'").select("user_id", "event_id", "s")
    seen = rows.where("event_type = 'view'").select("user_id", F.col("s").alias("seen_ms"), F.col("event_id").alias("seen"))
    return O.asof_join(bought, seen, ["user_id"], "s", "seen_ms", ["seen"]).where("seen is not null").select("event_id", "seen", "seen_ms")


@query(f"""WITH {SPANS}, e AS (SELECT * FROM spans WHERE event_type = 'error'), r AS (SELECT e.event_id, v.event_id AS nearest, v.s AS nearest_ms, row_number() OVER (PARTITION BY e.event_id ORDER BY abs(e.s - v.s), v.s) AS rn
      FROM e JOIN spans v ON v.user_id = e.user_id AND v.event_type = 'signup')
SELECT e.event_id, r.nearest, r.nearest_ms FROM e LEFT JOIN r ON r.event_id = e.event_id AND rn = 1""")
def nearest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The signup nearest in time to each error of a user."""
    rows = spans(spark, sf_dir)
    errors = rows.where("event_type = 'error'").select("user_id", "event_id", "s")
    signups = rows.where("event_type = 'signup'").select("user_id", F.col("s").alias("nearest_ms"), F.col("event_id").alias("nearest"))
    return O.nearest_join(errors, signups, ["user_id"], "s", "nearest_ms", "nearest").select("event_id", "nearest", "nearest_ms")


@query(f"""WITH {SPANS} SELECT a.event_id, sum((b.s < a.s)::INT)::BIGINT AS before, sum((b.s > a.s)::INT)::BIGINT AS after FROM spans a LEFT JOIN spans b ON a.user_id = b.user_id AND b.s BETWEEN a.s - 7200000 AND a.s + 7200000
GROUP BY 1""")
def around_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many events of a user lie within two hours before and after each."""
    w = W.W.partitionBy("user_id").orderBy("s")
    rows = spans(spark, sf_dir)
    before = F.count("*").over(w.rangeBetween(-2 * HOUR, -1))
    after = F.count("*").over(w.rangeBetween(1, 2 * HOUR))
    return rows.select("event_id", before.alias("before"), after.alias("after"))


@query(r"""WITH t AS (SELECT doc_id, regexp_extract_all(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), '[a-z0-9'']+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), '[a-z0-9'']+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 7], ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM t WHERE len(w) >= 8)),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i : i + 7], ' ') AS s FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM b WHERE len(w) >= 8))
SELECT doc_id, item_id, count(*) AS shared FROM ds JOIN bs USING (s) GROUP BY 1, 2""")
def shingle_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and benchmark items that share runs of eight tokens."""
    documents = table(spark, sf_dir, "documents").select("doc_id", T.tokens(F.col("text")).alias("tokens"))
    items = table(spark, sf_dir, "benchmark").select("item_id", T.tokens(F.col("text")).alias("tokens"))
    return O.shingle_join(documents, items, "doc_id", "item_id", 8)


@query(f"""WITH {TURNS}, m AS (SELECT * FROM (VALUES ('assistant', 'TARGET_HIGH'), ('user', 'NON_TARGET')) AS t(cluster, id))
SELECT turns.turn_id, coalesce(m.id, 'UNKNOWN') AS identity FROM turns LEFT JOIN m ON turns.speaker = m.cluster AND turns.source_id::BIGINT % 3 <> 0""")
def identity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with the identity of their speaker's cluster, UNKNOWN where the mapping has none."""
    turns = _turns(spark, sf_dir)
    named = turns.where("cast(source_id as long) % 3 <> 0").select("source_id", F.col("speaker").alias("cluster")).distinct()
    identity = F.when(F.col("cluster") == "assistant", "TARGET_HIGH").when(F.col("cluster") == "user", "NON_TARGET")
    mapping = named.withColumn("identity", identity).where("identity is not null")
    return turn_ops.with_identity(turns, mapping).select("turn_id", "identity")


@query("""SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_custkey IS NOT NULL)""")
def strict_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an urgent order and none in process: a semi join, then an anti join."""
    orders = table(spark, sf_dir, "orders")
    urgent = orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    pending = orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return customers.join(urgent, "c_custkey", "left_semi").join(pending, "c_custkey", "left_anti")


@query("""SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'N'""")
def coverage_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return orders.subtract(table(spark, sf_dir, "lineitem").where("l_returnflag <> 'N'").select(F.col("l_orderkey").alias("o_orderkey")))


@query("""SELECT c_nationkey AS nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal < 0""")
def split_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"))
    return customers.intersect(table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(F.col("s_nationkey").alias("nationkey")))


@query("""SELECT 'customer' AS origin, c_nationkey AS nationkey, count(*) AS n FROM customer GROUP BY ALL UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY ALL""")
def tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.lit("customer").alias("origin"), F.col("c_nationkey").alias("nationkey"))
    b = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("origin"), F.col("s_nationkey").alias("nationkey"))
    return a.unionByName(b).groupBy("origin", "nationkey").agg(F.count("*").alias("n"))


@query("""WITH o AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderkey % 10 <> 0), n AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS v FROM orders WHERE o_orderkey % 11 <> 0)
SELECT state, count(*) AS n FROM (SELECT CASE WHEN o.k IS NULL THEN 'NEW' WHEN n.k IS NULL THEN 'REMOVED' WHEN o.v IS DISTINCT FROM n.v THEN 'UPDATED' ELSE 'UNCHANGED' END AS state FROM o FULL JOIN n USING (k)) GROUP BY 1""")
def change_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between two snapshots of the orders."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    now = orders.withColumn("v", F.when(F.col("k") % 7 == 0, F.col("v") + 1).otherwise(F.col("v"))).where("k % 11 <> 0")
    from colloquy.operators.dedup import snapshot_changes

    return snapshot_changes(orders.where("k % 10 <> 0"), now, ["k"], ["v"]).groupBy("state").agg(F.count("*").alias("n"))


@query("""WITH o AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'queued' WHEN 'P' THEN 'running' ELSE 'complete' END AS status, o_orderpriority AS note FROM orders WHERE o_orderkey % 3 <> 0),
n AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'P' THEN 'queued' ELSE 'complete' END AS status, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS note FROM orders WHERE o_orderkey % 5 <> 0),
r AS (SELECT * FROM (VALUES ('queued', 1), ('running', 2), ('complete', 3)) AS t(status, rank))
SELECT coalesce(o.id, n.id) AS id, CASE WHEN coalesce(rn.rank, 0) > coalesce(ro.rank, 0) THEN n.status ELSE o.status END AS status, coalesce(n.note, o.note) AS note,
       array_to_string(list_sort(list_distinct(list_filter([o.note, n.note], lambda x: x IS NOT NULL))), ',') AS notes
FROM o FULL JOIN n ON o.id = n.id LEFT JOIN r ro ON ro.status = o.status LEFT JOIN r rn ON rn.status = n.status""")
def status_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a manifest: statuses only rise, notes unite."""
    orders = table(spark, sf_dir, "orders")
    state = lambda a, b: F.when(F.col("o_orderstatus") == "O", a).when(F.col("o_orderstatus") == "P", b).otherwise("complete")
    note = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus"))
    list_of = lambda c: F.array_compact(F.array(c))
    old = orders.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("id"), state("queued", "running").alias("status"), F.col("o_orderpriority").alias("note"), list_of(F.col("o_orderpriority")).alias("notes"))
    new = orders.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("id"), state("running", "queued").alias("status"), note.alias("note"), list_of(note).alias("notes"))
    out = O.status_merge(old, new, "id", {"status": ["queued", "running", "complete"]}, ["notes"])
    return out.withColumn("notes", F.array_join("notes", ","))


@query(r"""WITH t AS (SELECT conv_id, turn, regexp_extract_all(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), '[a-z0-9'']+') AS w FROM conversations),
p AS (SELECT *, lag(w) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM t)
SELECT conv_id, turn, round(CASE WHEN len(list_distinct(list_concat(w, b))) = 0 THEN 1.0 ELSE len(list_intersect(list_distinct(w), list_distinct(b)))::DOUBLE / len(list_distinct(list_concat(w, b))) END, 6) AS similarity,
       CASE WHEN len(b) = 0 AND len(w) > 0 THEN 'MISSING_OLD' WHEN len(b) > 0 AND len(w) = 0 THEN 'MISSING_NEW' WHEN w = b THEN 'MATCH'
            WHEN len(list_intersect(list_distinct(w), list_distinct(b)))::DOUBLE / len(list_distinct(list_concat(w, b))) >= 0.7 THEN 'MINOR' ELSE 'MAJOR' END AS class
FROM p WHERE b IS NOT NULL""")
def disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each turn's words differ from the turn before."""
    turns = _turns(spark, sf_dir).withColumn("old", F.lag("text").over(turn_ops.by_turn())).where("old is not null")
    sets = T.jaccard(F.array_distinct(T.tokens(F.col("text"))), F.array_distinct(T.tokens(F.col("old"))))
    return turns.select(
        F.col("source_id").cast("long").alias("conv_id"), F.col("idx").alias("turn"), F.round(sets, 6).alias("similarity"), T.disagreement(F.col("old"), F.col("text")).alias("class")
    )


@query("""SELECT s_nationkey AS nationkey, string_agg(s_name, ',' ORDER BY s_suppkey DESC) AS names FROM supplier GROUP BY 1""")
def resolve_id_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of ids replaced by the names they stand for, in their order."""
    suppliers = table(spark, sf_dir, "supplier")
    lists = suppliers.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.sort_array(F.collect_list("s_suppkey"), asc=False).alias("ids"))
    placed = lists.select("nationkey", F.posexplode("ids").alias("pos", "s_suppkey")).join(suppliers.select("s_suppkey", "s_name"), "s_suppkey")
    names = F.transform(F.array_sort(F.collect_list(F.struct("pos", "s_name"))), lambda x: x["s_name"])
    return placed.groupBy("nationkey").agg(F.array_join(names, ",").alias("names"))


@query(f"""WITH {SPANS}, t AS (SELECT DISTINCT user_id, s // {HOUR} AS b FROM spans WHERE event_type = 'click'), h AS (SELECT DISTINCT user_id, s // {HOUR} AS b FROM spans WHERE event_type = 'view')
SELECT t.user_id, count(*) AS buckets, count(h.b) AS met, round(count(h.b) / count(*)::DOUBLE, 6) AS recall FROM t LEFT JOIN h USING (user_id, b) GROUP BY 1""")
def bucket_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of a user's hours with a click that also have a view."""
    rows = spans(spark, sf_dir).withColumn("b", F.floor(F.col("s") / HOUR))
    wanted = rows.where("event_type = 'click'").select("user_id", "b").distinct()
    met = rows.where("event_type = 'view'").select("user_id", "b", F.lit(1).alias("hit")).distinct()
    out = wanted.join(met, ["user_id", "b"], "left").groupBy("user_id").agg(F.count("*").alias("buckets"), F.count("hit").alias("met"))
    return out.withColumn("recall", F.round(F.col("met") / F.col("buckets"), 6))


@query("""WITH f AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'), c AS (SELECT f.o_orderkey, p.o_orderkey AS match FROM f JOIN orders p ON p.o_custkey = f.o_custkey AND p.o_orderstatus = 'O' AND abs(p.o_totalprice - f.o_totalprice) <= 5000)
SELECT o_orderkey, min(match) AS match FROM c GROUP BY 1 HAVING count(*) = 1""")
def unique_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders with exactly one open order of the same customer near in price; others are rejected."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    done = orders.where("o_orderstatus = 'F'").drop("o_orderstatus")
    opened = orders.where("o_orderstatus = 'O'").select("o_custkey", F.col("o_orderkey").alias("match"), F.col("o_totalprice").alias("price"))
    near = done.join(opened, "o_custkey").where(F.abs(F.col("price") - F.col("o_totalprice")) <= 5000)
    return near.groupBy("o_orderkey").agg(F.count("*").alias("n"), F.min("match").alias("match")).where("n = 1").select("o_orderkey", "match")


@query("""SELECT o_orderkey, c_mktsegment, n_name, r_name, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""")
def evidence_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain of left joins from each order to its evidence, and the sum of its lines."""
    get = lambda name: table(spark, sf_dir, name)
    lines = get("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue"))
    out = get("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(get("customer"), "c_custkey", "left")
    out = out.join(get("nation"), out["c_nationkey"] == F.col("n_nationkey"), "left").join(get("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return out.join(lines, "o_orderkey", "left").select("o_orderkey", "c_mktsegment", "n_name", "r_name", "revenue")
