"""Queries over windows, sessions and intervals of events and turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.stats import clamp, ranked_value
from colloquy.operators import windows as O
from colloquy.plans.base import query
from colloquy.plans.turns import TURNS, _turns
from colloquy.tables import table

#: Events as intervals of value minutes, in SQL.
SPANS = """spans AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS s, epoch_us(ts) // 1000 + (value * 60000)::BIGINT AS e FROM events)"""


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", start.alias("s"), (start + F.round(F.col("value") * 60000).cast("long")).alias("e")
    )


def _count_sql(size: int, least: int) -> str:
    return f"""WITH {TURNS}, p AS (SELECT *, (row_number() OVER (PARTITION BY source_id ORDER BY idx) - 1) // {size} AS win FROM turns)
        SELECT source_id, win::BIGINT AS win, count(*) AS n, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM p GROUP BY 1, 2 HAVING count(*) >= {least}"""


def _count_windows(spark: SparkSession, sf_dir: str, size: int, least: int) -> DataFrame:
    kept = O.count_windows(_turns(spark, sf_dir), ["source_id"], ["idx"], size, least)
    return kept.groupBy("source_id", F.col("window").alias("win")).agg(F.count("*").alias("n"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"))


@query(_count_sql(8, 4))
def count_windows_8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count_windows(spark, sf_dir, 8, 4)


@query(_count_sql(16, 8))
def count_windows_16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count_windows(spark, sf_dir, 16, 8)


@query(f"""WITH {SPANS}, p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) - 1 AS p, count(*) OVER (PARTITION BY user_id) AS n FROM spans),
w AS (SELECT p.*, st FROM p, generate_series(0, 100000, 16) AS g(st) WHERE st <= p AND p < st + 20 AND (st = 0 OR st - 16 + 20 < n) AND least(20, n - st) >= 4)
SELECT user_id, st AS start, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM w GROUP BY 1, 2""")
def sliding_20_16(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = O.sliding_windows(spans(spark, sf_dir), ["user_id"], ["s", "event_id"], 20, 16, 4)
    return rows.groupBy("user_id", "start").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query(f"""WITH {SPANS}, p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) - 1 AS p, count(*) OVER (PARTITION BY user_id) AS n FROM spans),
w AS (SELECT p.*, st FROM p, generate_series(0, 100000, 16) AS g(st) WHERE st <= p AND p < st + 20 AND least(20, n - st) >= 4)
SELECT user_id, st AS start, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY 1, 2""")
def sliding_past_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = O.sliding_windows(spans(spark, sf_dir), ["user_id"], ["s", "event_id"], 20, 16, 4, past_end=True)
    return rows.groupBy("user_id", "start").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(f"""WITH {SPANS}, g AS (SELECT *, coalesce(s - lag(s) OVER w > 1800000, false)::INT AS new FROM spans WINDOW w AS (PARTITION BY user_id ORDER BY s, event_id)),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY s, event_id) AS session FROM g)
SELECT user_id, session::BIGINT AS session, count(*) AS n, min(s) AS first_ms, max(s) AS last_ms FROM i GROUP BY 1, 2""")
def gap_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = O.sessions(spans(spark, sf_dir), ["user_id"], "s", "s", 1_800_000, "event_id")
    return rows.groupBy("user_id", "session").agg(F.count("*").alias("n"), F.min("s").alias("first_ms"), F.max("s").alias("last_ms"))


@query(f"""WITH {SPANS}, g AS (SELECT *, coalesce(s - lag(s) OVER w > 21600000, false)::INT AS new FROM spans WINDOW w AS (PARTITION BY user_id ORDER BY s, event_id)),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY s, event_id) AS session FROM g),
p AS (SELECT *, row_number() OVER (PARTITION BY user_id, session ORDER BY s, event_id) - 1 AS p, count(*) OVER (PARTITION BY user_id, session) AS n FROM i),
w AS (SELECT p.*, st FROM p, generate_series(0, 100000, 4) AS g(st) WHERE st <= p AND p < st + 6 AND (st = 0 OR st - 4 + 6 < n) AND least(6, n - st) >= 2)
SELECT user_id, session::BIGINT AS session, st AS start, count(*) AS n FROM w GROUP BY 1, 2, 3""")
def session_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding count windows inside gap sessions."""
    rows = O.sessions(spans(spark, sf_dir), ["user_id"], "s", "s", 21_600_000, "event_id")
    rows = O.sliding_windows(rows, ["user_id", "session"], ["s", "event_id"], 6, 4, 2)
    return rows.groupBy("user_id", "session", "start").agg(F.count("*").alias("n"))


ISLANDS = f"""{SPANS}, r AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
i AS (SELECT *, sum(coalesce(s > reach + 60000, false)::INT) OVER (PARTITION BY user_id ORDER BY s, e, event_id) AS island FROM r),
merged AS (SELECT user_id, island::BIGINT AS island, count(*) AS n, min(s) AS s, max(e) AS e FROM i GROUP BY 1, 2)"""


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = O.merge_intervals(spans(spark, sf_dir), ["user_id"], "s", "e", 60_000, "event_id")
    return rows.groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("s").alias("s"), F.max("e").alias("e"))


@query(f"WITH {ISLANDS} SELECT * FROM merged")
def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged(spark, sf_dir)


@query(f"""WITH {ISLANDS}, c AS (SELECT *, greatest(1, ceil((e - s) / 7200000)::BIGINT) AS k FROM merged)
SELECT user_id, island, g.chunk::BIGINT AS chunk, s + g.chunk * 7200000 AS chunk_start, least(e, s + (g.chunk + 1) * 7200000) AS chunk_end
FROM c, generate_series(0, 1000) AS g(chunk) WHERE g.chunk < k""")
def window_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.chunk_intervals(merged(spark, sf_dir), "s", "e", 7_200_000).select("user_id", "island", "chunk", "chunk_start", "chunk_end")


@query(f"""WITH {SPANS}, f AS (SELECT *, value >= 40 AS active FROM spans),
r AS (SELECT *, sum((NOT active)::INT) OVER (PARTITION BY user_id ORDER BY s, event_id) AS run FROM f)
SELECT user_id, run::BIGINT AS run, count(*) AS frames, min(s) AS s, max(e) AS e FROM r WHERE active GROUP BY 1, 2""")
def active_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of events whose value passes a threshold, as active frames make segments."""
    rows = O.runs(spans(spark, sf_dir).withColumn("active", F.col("value") >= 40), ["user_id"], ["s", "event_id"], "active")
    return rows.groupBy("user_id", "run").agg(F.count("*").alias("frames"), F.min("s").alias("s"), F.max("e").alias("e"))


@query(f"""WITH {SPANS}, p AS (SELECT *, lag(event_type) OVER w AS before, lead(event_type) OVER w AS after, row_number() OVER w - 1 AS place FROM spans WINDOW w AS (PARTITION BY user_id ORDER BY s, event_id))
SELECT event_id, place::BIGINT AS place, before, after, coalesce(before = event_type, false) AS repeats FROM p""")
def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, previous and next type of every event, and whether it repeats the one before."""
    w = O.W.partitionBy("user_id").orderBy("s", "event_id")
    rows = spans(spark, sf_dir).withColumn("before", F.lag("event_type").over(w)).withColumn("after", F.lead("event_type").over(w))
    repeats = F.coalesce(F.col("before") == F.col("event_type"), F.lit(False))
    return rows.select("event_id", O.place(["user_id"], ["s", "event_id"]).alias("place"), "before", "after", repeats.alias("repeats"))


@query(f"""WITH {TURNS}, t AS (SELECT *, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS v FROM turns), l AS (SELECT *, lag(v) OVER (PARTITION BY source_id ORDER BY idx) AS pv FROM t)
SELECT source_id, count(*) AS turns, sum((v = pv AND length(v) >= 12)::INT)::BIGINT AS repeats FROM l GROUP BY 1""")
def consecutive_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from colloquy.functions.text import norm
    from colloquy.operators.turns import by_turn

    rows = _turns(spark, sf_dir).withColumn("v", norm(F.col("text"))).withColumn("pv", F.lag("v").over(by_turn()))
    repeats = F.coalesce((F.col("v") == F.col("pv")) & (F.length("v") >= 12), F.lit(False))
    return rows.groupBy("source_id").agg(F.count("*").alias("turns"), F.sum(repeats.cast("long")).alias("repeats"))


@query(f"""WITH {SPANS}, v AS (SELECT event_id, user_id, value, s, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) AS rn FROM spans)
SELECT a.event_id, round(median(b.value), 6) AS trailing_median FROM v a JOIN v b ON a.user_id = b.user_id AND b.rn BETWEEN a.rn - 19 AND a.rn GROUP BY 1""")
def trailing_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median of the last 20 values of each user at every event."""
    w = O.W.partitionBy("user_id").orderBy("s", "event_id").rowsBetween(-19, 0)
    return spans(spark, sf_dir).select("event_id", F.round(F.percentile("value", 0.5).over(w), 6).alias("trailing_median"))


@query(f"""WITH {SPANS}, m AS (SELECT max(s) AS now FROM spans)
SELECT event_type, sum((now - s <= 3600000)::INT)::BIGINT AS h1, sum((now - s <= 3 * 3600000)::INT)::BIGINT AS h3, sum((now - s <= 6 * 3600000)::INT)::BIGINT AS h6,
       sum((now - s <= 12 * 3600000)::INT)::BIGINT AS h12, round(sum((now - s <= 12 * 3600000)::INT) / 12.0, 6) AS rate12
FROM spans, m GROUP BY 1""")
def trailing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts in the last 1, 3, 6 and 12 hours before the newest event."""
    rows = spans(spark, sf_dir)
    now = rows.agg(F.max("s").alias("now"))
    ago = F.col("now") - F.col("s")
    within = lambda h: F.sum((ago <= h * 3_600_000).cast("long"))
    return rows.crossJoin(F.broadcast(now)).groupBy("event_type").agg(  # one row on the right
        within(1).alias("h1"), within(3).alias("h3"), within(6).alias("h6"), within(12).alias("h12"), F.round(within(12) / 12.0, 6).alias("rate12")
    )


@query(f"""WITH {SPANS}, g AS (SELECT event_type, (s - lag(e) OVER (PARTITION BY user_id ORDER BY s, event_id)) / 60000.0 AS gap FROM spans),
a AS (SELECT event_type, list_sort(list(greatest(gap, 0.0))) AS v FROM g WHERE gap IS NOT NULL GROUP BY 1)
SELECT event_type, round(least(720.0, greatest(60.0, v[round_even((len(v) - 1) * 0.95, 0)::INT + 1])), 6) AS context_gap,
       round(least(120.0, greatest(5.0, v[round_even((len(v) - 1) * 0.9, 0)::INT + 1])), 6) AS response_gap FROM a""")
def gap_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap limits a type: clipped nearest-rank percentiles of the gaps before its events."""
    w = O.W.partitionBy("user_id").orderBy("s", "event_id")
    gaps = spans(spark, sf_dir).withColumn("raw", (F.col("s") - F.lag("e").over(w)) / 60000.0).where("raw is not null").withColumn("gap", F.greatest("raw", F.lit(0.0)))
    p95 = ranked_value(gaps, ["event_type"], "gap", 0.95).withColumnRenamed("gap", "p95")
    p90 = ranked_value(gaps, ["event_type"], "gap", 0.9).withColumnRenamed("gap", "p90")
    return p95.join(p90, "event_type").select(
        "event_type", F.round(clamp(F.col("p95"), 60.0, 720.0), 6).alias("context_gap"), F.round(clamp(F.col("p90"), 5.0, 120.0), 6).alias("response_gap")
    )


@query("""WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
SELECT o_custkey, o_orderkey, rn AS place FROM r WHERE rn <= 3""")
def group_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three dearest orders of each customer."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    order = [F.desc("o_totalprice"), F.col("o_orderkey")]
    ranked = orders.withColumn("place", F.row_number().over(O.W.partitionBy("o_custkey").orderBy(*order)).cast("long"))
    return ranked.where("place <= 3").select("o_custkey", "o_orderkey", "place")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT user_id, event_id, event_type, value FROM r WHERE rn = 1""")
def latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return O.latest(rows, ["user_id"], F.struct("ts", "event_id")).select("user_id", "event_id", "event_type", "value")


@query(f"""WITH {SPANS}, w AS (SELECT u.user_id, u.event_id AS anchor, k FROM (SELECT * FROM spans WHERE event_type = 'purchase') u, (VALUES (2), (4), (8), (12)) AS t(k)),
p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) AS rn FROM spans),
x AS (SELECT w.anchor, w.k, sum((b.event_type = 'signup')::INT) AS signups, count(*) AS n FROM w JOIN p a ON a.event_id = w.anchor JOIN p b ON b.user_id = a.user_id AND b.rn BETWEEN a.rn - w.k AND a.rn - 1 GROUP BY 1, 2)
SELECT anchor, min(k)::BIGINT AS shortest FROM x WHERE signups > 0 AND n = k GROUP BY 1""")
def shortest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shortest of the windows of 2, 4, 8 and 12 events before a purchase that holds a signup."""
    w = O.W.partitionBy("user_id").orderBy("s", "event_id")
    rows = spans(spark, sf_dir)
    found = F.lit(None).cast("long")
    for k in (12, 8, 4, 2):
        frame = w.rowsBetween(-k, -1)
        legal = (F.count("*").over(frame) == k) & (F.sum((F.col("event_type") == "signup").cast("int")).over(frame) > 0)
        found = F.when(legal, F.lit(k).cast("long")).otherwise(found)
    return rows.withColumn("shortest", found).where("event_type = 'purchase' and shortest is not null").select(F.col("event_id").alias("anchor"), "shortest")
