"""Queries over two segmentations of conversations: spans of timed tokens, and the old turns that they split or merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import topology as O
from colloquy.operators.joins import point_join
from colloquy.operators.recovery import OTHER, TARGET
from colloquy.plans.base import query
from colloquy.plans.recovery import _overlap, _tok
from colloquy.plans.turns import TURNS, _turns
from colloquy.session import Scratch

BIN_MS = 20_000

#: Tokens share their turn's time; windows w cover four turns and v three; where the length is a multiple of 6 another speaker takes over half-way.
#: A turn whose length leaves 1 by 4 stands as two old turns.
TOKENS = f"""{TURNS},
word AS (SELECT *, list_filter(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' '), lambda x: x <> '') AS ws FROM turns),
timed AS (SELECT *, len(ws)::BIGINT AS m, greatest(1, (end_ms - start_ms) // len(ws)) AS d FROM word WHERE len(ws) > 0),
tok0 AS (SELECT *, unnest(generate_series(0, m - 1)) AS i FROM timed),
tok1 AS (SELECT source_id, turn_id, i, ws[i + 1] AS word, start_ms + i * d AS s, start_ms + (i + 1) * d AS e, n % 31 = 0 AND i = 0 AS overlap, format('{{}}:{{:05d}}', turn_id, i) AS token_id,
    CASE WHEN n % 13 = 0 AND i % 3 = 0 THEN NULL ELSE 'w' || (idx // 4) END AS w, CASE WHEN n % 13 = 0 AND i % 3 = 0 OR i % 2 = 1 THEN NULL ELSE 'v' || (idx // 3) END AS v,
    CASE WHEN n % 6 = 0 AND i >= m // 2 THEN 'x' ELSE speaker END AS c FROM tok0),
tok AS (SELECT *, CASE WHEN w IS NULL THEN MAP {{}}::MAP(VARCHAR, VARCHAR) WHEN v IS NULL THEN MAP {{w: c}} ELSE MAP {{w: c, v: c}} END AS cl FROM tok1),
old AS (SELECT source_id, turn_id || '#' || p AS turn_id, start_ms + a * d AS s, start_ms + b * d AS e, array_to_string(ws[a + 1 : b], ' ') AS text, frozen
    FROM (SELECT *, CASE p WHEN 0 THEN 0 ELSE m // 2 END AS a, CASE WHEN p = 0 AND two THEN m // 2 ELSE m END AS b
          FROM (SELECT *, n % 4 = 1 AND m > 1 AS two, speaker = 'assistant' AND n % 10 = 0 AS frozen FROM timed), generate_series(0, 1) AS g(p) WHERE p = 0 OR two)),
anchor AS (SELECT DISTINCT source_id || '|' || k.key || '::' || k.value AS key, CASE WHEN k.value IN ('assistant', 'x') THEN 'CONFIRMED_TARGET' ELSE 'CONFIRMED_NON_TARGET' END AS st
    FROM (SELECT source_id, unnest(map_entries(cl)) AS k FROM tok) WHERE substr(k.key, 2)::BIGINT % 5 <> 4)"""

_RELATES = "len(list_intersect(map_keys(p), map_keys(cl))) > 0 AND len(list_filter(list_intersect(map_keys(p), map_keys(cl)), lambda k: p[k] <> cl[k])) > 0"

SPANS = f"""{TOKENS},
lagged AS (SELECT *, lag(cl) OVER o AS p, lag(e) OVER o AS pe, lag(overlap) OVER o AS po FROM tok WINDOW o AS (PARTITION BY source_id ORDER BY s, e, token_id)),
cut AS (SELECT *, sum((coalesce(s - pe > 1250 OR overlap OR po OR ({_RELATES}), false))::INT) OVER o AS span, row_number() OVER o AS place FROM lagged WINDOW o AS (PARTITION BY source_id ORDER BY s, e, token_id)),
votes AS (SELECT source_id, span, k.key AS win, k.value AS c, count(*) AS votes FROM (SELECT source_id, span, unnest(map_entries(cl)) AS k FROM cut) GROUP BY ALL),
won AS (SELECT source_id, span, win || '::' || c AS key FROM votes v WHERE NOT EXISTS (SELECT 1 FROM votes o WHERE o.source_id = v.source_id AND o.span = v.span AND o.win = v.win AND o.c <> v.c AND o.votes >= v.votes)),
keyed AS (SELECT source_id, span, list(key ORDER BY key) AS ks FROM won GROUP BY ALL),
spans AS (SELECT c.source_id, c.span::BIGINT AS span, arg_min(s, place) AS s, arg_max(e, place) AS e, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n_tokens, bool_or(overlap) AS overlap, coalesce(any_value(ks), []::VARCHAR[]) AS ks
    FROM cut c LEFT JOIN keyed k ON k.source_id = c.source_id AND k.span = c.span GROUP BY 1, 2)"""

SPLITS = f"""{TOKENS},
own AS (SELECT t.source_id, o.turn_id, t.token_id, t.s, t.e, t.word, t.cl FROM tok t JOIN old o ON o.source_id = t.source_id AND (t.s + t.e) // 2 BETWEEN o.s AND o.e WHERE NOT o.frozen AND cardinality(t.cl) > 0),
ol AS (SELECT *, lag(cl) OVER w AS p FROM own WINDOW w AS (PARTITION BY source_id, turn_id ORDER BY s, e, token_id)),
oc AS (SELECT *, sum(coalesce({_RELATES}, false)::INT) OVER w AS part, row_number() OVER w AS place FROM ol WINDOW w AS (PARTITION BY source_id, turn_id ORDER BY s, e, token_id)),
ov AS (SELECT turn_id, source_id, part, k.key AS win, k.value AS c, count(*) AS votes, min(place) AS first FROM (SELECT source_id, turn_id, part, place, unnest(map_entries(cl)) AS k FROM oc) GROUP BY ALL),
ow AS (SELECT turn_id, source_id, part, win || '::' || arg_min(c, struct_pack(a := -votes, b := first)) AS key FROM ov GROUP BY turn_id, source_id, part, win),
ok AS (SELECT turn_id, part, list(ow.key ORDER BY ow.key) AS ks, count(*) AS keys, count(st) AS met, count(DISTINCT st) AS states, min(st) AS st FROM ow LEFT JOIN anchor a ON a.key = source_id || '|' || ow.key GROUP BY ALL),
op AS (SELECT c.source_id, c.turn_id, c.part::BIGINT AS part, arg_min(s, place) AS s, arg_max(e, place) AS e, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n_tokens,
    any_value(CASE WHEN met = keys AND states = 1 THEN st END) AS st, any_value(ks) AS ks FROM oc c JOIN ok ON ok.turn_id = c.turn_id AND ok.part = c.part GROUP BY 1, 2, 3),
splits AS (SELECT op.* FROM op JOIN (SELECT turn_id FROM op GROUP BY 1 HAVING count(*) > 1 AND min(n_tokens) >= 2 AND bool_and(st IS NOT NULL) AND count(DISTINCT st) > 1) USING (turn_id))"""

MERGES = f"""{SPANS},
met AS (SELECT p.source_id, p.span, any_value(p.text) AS fresh, any_value(p.ks) AS ks, list(o.turn_id ORDER BY o.s, o.turn_id) AS ids, string_agg(o.text, ' ' ORDER BY o.s, o.turn_id) AS text, min(o.s) AS s, arg_max(o.e, o.s) AS e, bool_or(o.frozen) AS frozen
    FROM spans p JOIN old o ON o.source_id = p.source_id AND p.s < o.e AND o.s < p.e WHERE NOT p.overlap GROUP BY 1, 2 HAVING count(*) > 1),
alike AS (SELECT *, {_tok('text')} AS a, {_tok('fresh')} AS b FROM met WHERE NOT frozen),
said AS (SELECT a.source_id, a.span, count(*) AS keys, count(st) AS met, count(DISTINCT st) AS states, min(st) AS st FROM (SELECT source_id, span, unnest(ks) AS key FROM alike) a LEFT JOIN anchor n ON n.key = a.source_id || '|' || a.key GROUP BY 1, 2),
merges AS (SELECT a.*, st FROM alike a JOIN said USING (source_id, span) WHERE met = keys AND states = 1 AND {_overlap('a', 'b')} >= 0.6)"""

_ROLE = "CASE st WHEN 'CONFIRMED_TARGET' THEN 'assistant' ELSE 'user' END AS role"


def timed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, m = F.length("text"), F.size("ws")
    words = F.filter(F.split(T.collapse(F.col("text")), " "), lambda x: x != "")
    window = lambda name, turns: F.concat(F.lit(name), F.floor(F.col("idx") / turns).cast("string"))
    rows = _turns(spark, sf_dir).withColumn("ws", words).where(m > 0)
    # What tokens need of their turn is made before they come apart, so that no token carries its turn's text and words.
    rows = rows.select(
        "source_id", "turn_id", "speaker", F.col("start_ms"), F.greatest(F.lit(1), F.floor((F.col("end_ms") - F.col("start_ms")) / m)).alias("d"), window("w", 4).alias("w"), window("v", 3).alias("v"),
        F.when(n % 6 == 0, F.floor(m / 2)).alias("half"), (n % 13 == 0).alias("gaps"), (n % 31 == 0).alias("overlap"), "ws",
    ).select("source_id", "turn_id", "speaker", "start_ms", "d", "w", "v", "half", "gaps", "overlap", F.posexplode("ws").alias("i", "word"))
    label = F.when(F.col("i") >= F.col("half"), "x").otherwise(F.col("speaker"))
    clusters = F.when(F.col("gaps") & (F.col("i") % 3 == 0), F.lit(None)).when(F.col("i") % 2 == 1, F.create_map("w", label)).otherwise(F.create_map("w", label, "v", label))
    return rows.select(
        F.col("source_id").alias("recording"), F.format_string("%s:%05d", "turn_id", "i").alias("token_id"), (F.col("start_ms") + F.col("i") * F.col("d")).alias("start"),
        (F.col("start_ms") + (F.col("i") + 1) * F.col("d")).alias("end"), F.col("word").alias("text"), clusters.alias("clusters"), (F.col("overlap") & (F.col("i") == 0)).alias("overlap"),
    )


def old_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("text")
    words = F.filter(F.split(T.collapse(F.col("text")), " "), lambda x: x != "")
    rows = _turns(spark, sf_dir).withColumn("ws", words).where(F.size("ws") > 0).withColumn("m", F.size("ws"))
    two = (n % 4 == 1) & (F.col("m") > 1)
    rows = rows.withColumn("d", F.greatest(F.lit(1), F.floor((F.col("end_ms") - F.col("start_ms")) / F.col("m")))).withColumn("two", two)
    half = F.floor(F.col("m") / 2).cast("int")
    rows = rows.withColumn("p", F.explode(F.when(F.col("two"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    rows = rows.withColumn("a", F.when(F.col("p") == 0, 0).otherwise(half)).withColumn("b", F.when((F.col("p") == 0) & F.col("two"), half).otherwise(F.col("m")))
    return rows.select(
        F.col("source_id").alias("recording"), F.concat_ws("#", "turn_id", F.col("p").cast("string")).alias("turn_id"), (F.col("start_ms") + F.col("a") * F.col("d")).alias("start"),
        (F.col("start_ms") + F.col("b") * F.col("d")).alias("end"), F.array_join(F.slice("ws", F.col("a") + 1, F.col("b") - F.col("a")), " ").alias("text"),
        ((F.col("speaker") == "assistant") & (n % 10 == 0)).alias("frozen"),
    )


def cluster_anchors(tokens: DataFrame) -> DataFrame:
    """A state for each cluster of a window, but for each fifth window."""
    keys = tokens.select("recording", F.explode("clusters").alias("window", "cluster")).distinct().where(F.substring("window", 2, 20).cast("long") % 5 != 4)
    state = F.when(F.col("cluster").isin("assistant", "x"), TARGET).otherwise(OTHER)
    return keys.select(F.concat_ws("|", "recording", F.concat_ws("::", "window", "cluster")).alias("key"), state.alias("speaker_state"), F.lit("ANCHOR").alias("basis"))


def _observed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Timed tokens and their anchors, each made once for all that reads them."""
    scratch = Scratch(spark, "topology")
    tokens = scratch.save(timed_tokens(spark, sf_dir))
    return tokens, scratch.save(cluster_anchors(tokens))


def _splits(spark: SparkSession, sf_dir: str, tokens: DataFrame, anchors: DataFrame) -> DataFrame:
    old = old_turns(spark, sf_dir).select("recording", "turn_id", "frozen", F.col("start").alias("start_r"), F.col("end").alias("end_r"))
    assigned = point_join(tokens.withColumn("mid", F.floor((F.col("start") + F.col("end")) / 2)), old, ["recording"], "mid", BIN_MS)
    return O.split_turns(assigned, anchors)


def _merges(spark: SparkSession, sf_dir: str, tokens: DataFrame, anchors: DataFrame) -> DataFrame:
    alike = lambda a, b: T.jaccard(F.array_distinct(T.tokens(a)), F.array_distinct(T.tokens(b)))
    return O.merge_turns(O.candidate_spans(tokens, 1250), old_turns(spark, sf_dir), anchors, BIN_MS, similarity=alike)


@query(f"WITH {SPANS} SELECT source_id AS recording, span, s AS start, e AS \"end\", text, n_tokens, overlap, array_to_string(ks, ',') AS cluster_keys, CASE WHEN len(ks) = 1 THEN ks[1] END AS speaker_cluster FROM spans")
def token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of tokens that pauses, overlapped speech and changes of speaker within a window end."""
    return O.candidate_spans(timed_tokens(spark, sf_dir), 1250).withColumn("cluster_keys", F.array_join("cluster_keys", ","))


@query(f"WITH {SPLITS} SELECT turn_id, part, s AS start, e AS \"end\", text, n_tokens, st AS speaker_state, {_ROLE}, array_to_string(ks, ',') AS cluster_keys FROM splits")
def turn_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children of old turns in which timed tokens show two speakers."""
    return _splits(spark, sf_dir, *_observed(spark, sf_dir)).drop("recording").withColumn("cluster_keys", F.array_join("cluster_keys", ","))


@query(f"WITH {MERGES} SELECT source_id AS recording, span, array_to_string(ids, ',') AS turn_ids, s AS start, e AS \"end\", text, st AS speaker_state, {_ROLE} FROM merges")
def turn_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old turns that one span of one speaker shows to be one."""
    return _merges(spark, sf_dir, *_observed(spark, sf_dir)).withColumn("turn_ids", F.array_join("turn_ids", ","))


@query(f"""WITH {SPLITS}, {MERGES.removeprefix(TOKENS + ",")},
s AS (SELECT turn_id, count(*) AS n FROM splits GROUP BY 1), g AS (SELECT turn_id, count(*) AS n FROM (SELECT unnest(ids) AS turn_id FROM merges) GROUP BY 1)
SELECT old.turn_id, CASE WHEN s.n IS NOT NULL THEN 'SPLIT_EXISTING' WHEN g.n IS NOT NULL THEN 'MERGE_EXISTING' ELSE 'MATCH_EXISTING' END AS state, coalesce(s.n, g.n, 1) AS nodes
FROM old LEFT JOIN s USING (turn_id) LEFT JOIN g USING (turn_id)""")
def turn_topology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the new segmentation makes of every old turn."""
    observed = _observed(spark, sf_dir)
    return O.turn_topology(old_turns(spark, sf_dir), _splits(spark, sf_dir, *observed), _merges(spark, sf_dir, *observed)).drop("recording")
