"""Queries over judgement, routing and identity states, and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators import states as O
from colloquy.operators import turns as turn_ops
from colloquy.plans.base import query
from colloquy.plans.turns import TURNS, _turns
from colloquy.plans.windows import SPANS, spans
from colloquy.tables import table

#: Judgements of two or three passes over events, as rules give them from the event's own numbers.
JUDGED = """j AS (SELECT event_id, CASE (event_id % 7)::INT WHEN 0 THEN 'DIRECT_RESPONSE' WHEN 1 THEN 'CONTEXTUAL_RESPONSE' WHEN 2 THEN 'WRONG_CONTEXT' WHEN 3 THEN 'UNCLEAR' WHEN 4 THEN 'HIDDEN_TRIGGER_SUSPECTED' WHEN 5 THEN 'NO_SUCH' ELSE 'DIRECT_RESPONSE' END AS r1,
    CASE (event_id % 5)::INT WHEN 0 THEN 'DIRECT_RESPONSE' WHEN 1 THEN 'CONTEXTUAL_RESPONSE' WHEN 2 THEN 'WRONG_CONTEXT' WHEN 3 THEN NULL ELSE 'HIDDEN_TRIGGER_SUSPECTED' END AS r2,
    CASE (event_id % 3)::INT WHEN 0 THEN 'DIRECT_RESPONSE' WHEN 1 THEN 'WRONG_CONTEXT' END AS r3, least(1.0, value / 60.0) AS c1, least(1.0, value / 50.0) AS c2 FROM events),
v AS (SELECT *, r1 <> 'NO_SUCH' AS v1, r1 IN ('DIRECT_RESPONSE', 'CONTEXTUAL_RESPONSE') AND c1 >= 0.75 AS a1, r2 IN ('DIRECT_RESPONSE', 'CONTEXTUAL_RESPONSE') AND c2 >= 0.75 AS a2, r3 = 'DIRECT_RESPONSE' AND c1 >= 0.75 AS a3,
    r1 IN ('HIDDEN_TRIGGER_SUSPECTED', 'WRONG_CONTEXT') AND c1 >= 0.75 AS x1, r2 IN ('HIDDEN_TRIGGER_SUSPECTED', 'WRONG_CONTEXT') AND c2 >= 0.75 AS x2, r3 = 'WRONG_CONTEXT' AND c1 >= 0.75 AS x3 FROM j)"""


def _pass(relation: Column, confidence: Column) -> Column:
    episode, yes = F.lit("KEEP_CURRENT"), F.lit(True)
    valid = O.judgement_valid(relation, episode, confidence, yes)
    accepted = O.judgement_accepted(valid, relation, episode, confidence, yes)
    made = F.struct(relation.alias("relation"), episode.alias("episode"), confidence.alias("confidence"), valid.alias("valid"), accepted.alias("accepted"))
    return F.when(relation.isNotNull(), made)


def _pick(n: int, names: list[str | None]) -> Column:
    return F.get(F.array(*map(F.lit, names)), (F.col("event_id") % n).cast("int"))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    c1, c2 = F.least(F.lit(1.0), F.col("value") / 60.0), F.least(F.lit(1.0), F.col("value") / 50.0)
    r1 = _pick(7, ["DIRECT_RESPONSE", "CONTEXTUAL_RESPONSE", "WRONG_CONTEXT", "UNCLEAR", "HIDDEN_TRIGGER_SUSPECTED", "NO_SUCH", "DIRECT_RESPONSE"])
    r2 = _pick(5, ["DIRECT_RESPONSE", "CONTEXTUAL_RESPONSE", "WRONG_CONTEXT", None, "HIDDEN_TRIGGER_SUSPECTED"])
    r3 = _pick(3, ["DIRECT_RESPONSE", "WRONG_CONTEXT", None])
    return table(spark, sf_dir, "events").select("event_id", _pass(r1, c1).alias("p"), _pass(r2, c2).alias("s"), _pass(r3, c1).alias("a"))


@query(f"WITH {JUDGED} SELECT event_id, v1 AS valid, coalesce(v1 AND a1, false) AS accepted FROM v")
def judge_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select("event_id", F.col("p.valid").alias("valid"), F.col("p.accepted").alias("accepted"))


@query(f"""WITH {JUDGED} SELECT event_id, CASE WHEN NOT v1 THEN 'MISSING_INVALID_EVIDENCE' WHEN x1 AND r2 IS NULL THEN 'REJECTED' WHEN NOT a1 AND r2 IS NULL THEN 'AMBIGUOUS' WHEN r2 IS NULL THEN 'PENDING_STRICT'
    WHEN a1 AND a2 AND r1 = r2 THEN 'VERIFIED' WHEN NOT a1 AND NOT a2 AND x1 AND x2 AND r1 = r2 THEN 'REJECTED' WHEN NOT a1 AND NOT a2 THEN 'AMBIGUOUS' WHEN r3 IS NULL THEN 'JUDGE_CONFLICT' WHEN a3 THEN 'VERIFIED' WHEN x3 THEN 'REJECTED' ELSE 'AMBIGUOUS' END AS state,
CASE WHEN NOT v1 THEN 'PRIMARY_INVALID' WHEN x1 AND r2 IS NULL THEN 'PRIMARY_EXPLICIT_OBSERVABILITY_REJECT' WHEN NOT a1 AND r2 IS NULL THEN 'PRIMARY_NON_ACCEPT_UNRESOLVED' WHEN r2 IS NULL THEN 'SECOND_SEMANTIC_VERIFICATION_REQUIRED'
    WHEN a1 AND a2 AND r1 = r2 THEN 'SEMANTIC_PASSES_AGREE' WHEN NOT a1 AND NOT a2 AND x1 AND x2 AND r1 = r2 THEN 'SEMANTIC_PASSES_AGREE_REJECT' WHEN NOT a1 AND NOT a2 THEN 'SEMANTIC_PASSES_NON_ACCEPT' WHEN r3 IS NULL THEN 'PRIMARY_STRICT_DISAGREEMENT'
    WHEN a3 THEN 'CONFLICT_ADJUDICATED_ACCEPT' WHEN x3 THEN 'CONFLICT_ADJUDICATED_REJECT' ELSE 'CONFLICT_ADJUDICATED_UNCLEAR' END AS reason FROM v""")
def resolve_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select("event_id", O.resolve_passes("p", "s", "a").alias("r")).select("event_id", "r.state", "r.reason")


@query("""WITH i AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS invalid, count(*) AS n FROM events GROUP BY 1) SELECT user_id, CASE WHEN invalid = 0 THEN 'VALID' WHEN invalid < 12 THEN 'RETRYABLE_INVALID' ELSE 'TERMINAL_INVALID_QUARANTINED' END AS state, n FROM i""")
def invalid_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States by the number of invalid results against a retry budget."""
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("invalid"), F.count("*").alias("n"))
    state = F.when(F.col("invalid") == 0, "VALID").when(F.col("invalid") < 12, "RETRYABLE_INVALID").otherwise("TERMINAL_INVALID_QUARANTINED")
    return rows.select("user_id", state.alias("state"), "n")


@query(f"""WITH {TURNS}, p AS (SELECT *, lag(text) OVER w AS ctx, lag(identity) OVER w AS cid, start_ms - lag(end_ms) OVER w AS gap FROM turns WINDOW w AS (PARTITION BY source_id ORDER BY idx))
SELECT turn_id, CASE WHEN ctx IS NULL THEN 'UNSUPPORTED' WHEN cid = 'UNKNOWN' THEN 'CONTEXT_INCOMPLETE' WHEN gap <= 2000 THEN 'SELF_CONTAINED' WHEN gap <= 8000 AND length(ctx) >= 100 THEN 'SELF_CONTAINED' ELSE 'CONTEXT_INCOMPLETE' END AS state FROM p WHERE identity = 'TARGET_HIGH'""")
def sufficiency_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a target's context is enough, by rules in place of a judge."""
    w = turn_ops.by_turn()
    rows = _turns(spark, sf_dir).withColumn("ctx", F.lag("text").over(w)).withColumn("cid", F.lag("identity").over(w)).withColumn("gap", F.col("start_ms") - F.lag("end_ms").over(w))
    state = O.first_rule(
        [
            (F.col("ctx").isNull(), "UNSUPPORTED", "no_context"), (F.col("cid") == "UNKNOWN", "CONTEXT_INCOMPLETE", "unknown_speaker"), (F.col("gap") <= 2000, "SELF_CONTAINED", "near"),
            ((F.col("gap") <= 8000) & (F.length("ctx") >= 100), "SELF_CONTAINED", "full"),
        ], "CONTEXT_INCOMPLETE", "weak",
    )
    return rows.where("identity = 'TARGET_HIGH'").select("turn_id", state["state"].alias("state"))


@query(f"""WITH {TURNS}, s AS (SELECT t.turn_id, k, (SELECT sum(length(c.text)) FROM turns c WHERE c.source_id = t.source_id AND c.idx BETWEEN t.idx - k AND t.idx - 1) AS chars FROM turns t, generate_series(1, 4) AS g(k) WHERE t.identity = 'TARGET_HIGH' AND t.idx >= k)
SELECT turn_id, min(k)::BIGINT AS size FROM s WHERE chars >= 200 GROUP BY 1""")
def minimal_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least number of turns before a target that hold 200 characters."""
    size = F.lit(None).cast("long")
    for k in (4, 3, 2, 1):
        frame = turn_ops.by_turn().rowsBetween(-k, -1)
        size = F.when((F.count("*").over(frame) == k) & (F.sum(F.length("text")).over(frame) >= 200), F.lit(k).cast("long")).otherwise(size)
    return _turns(spark, sf_dir).withColumn("size", size).where("identity = 'TARGET_HIGH' and size is not null").select("turn_id", "size")


@query(f"""WITH {TURNS} SELECT turn_id, CASE WHEN speaker = 'system' THEN 'AMBIGUOUS_SPEAKER' WHEN speaker_confidence >= 0.7 AND identity = 'TARGET_HIGH' THEN 'CONFIRMED_TARGET' WHEN speaker_confidence >= 0.7 AND identity = 'NON_TARGET' THEN 'CONFIRMED_NON_TARGET' ELSE 'AMBIGUOUS_SPEAKER' END AS state,
CASE WHEN speaker = 'system' OR speaker_confidence < 0.7 THEN NULL WHEN identity = 'TARGET_HIGH' THEN 'assistant' ELSE 'user' END AS role FROM turns""")
def speaker_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed speakers; an unknown one is ambiguous and gets no role."""
    sure = F.col("speaker_confidence") >= 0.7
    state = O.first_rule([(F.col("identity") == "UNKNOWN", "AMBIGUOUS_SPEAKER", ""), (sure & (F.col("identity") == "TARGET_HIGH"), "CONFIRMED_TARGET", "assistant"), (sure & (F.col("identity") == "NON_TARGET"), "CONFIRMED_NON_TARGET", "user")], "AMBIGUOUS_SPEAKER", "")
    return _turns(spark, sf_dir).select("turn_id", state["state"].alias("state"), F.nullif(state["reason"], F.lit("")).alias("role"))


@query(f"""WITH {SPANS}, p AS (SELECT a.event_id, count(b.event_id) > 0 AND a.event_id % 2 = 0 AS overlap, count(DISTINCT b.event_type) FILTER (b.event_type <> a.event_type) + 1 AS speakers, any_value(a.event_type) AS t, any_value(a.value) AS v FROM spans a LEFT JOIN spans b ON a.user_id = b.user_id AND a.event_id <> b.event_id AND a.s < b.e AND b.s < a.e GROUP BY 1)
SELECT event_id, CASE WHEN v > 300 THEN 'FORCED' WHEN v < 1 THEN 'BACKGROUND_SPEECH' WHEN t = 'error' THEN 'SPEAKER_AMBIGUITY' WHEN overlap AND t = 'purchase' THEN 'TARGET_OVERLAP' WHEN speakers > 1 AND t = 'purchase' THEN 'MULTI_SPEAKER_TARGET' ELSE 'CLEAN' END AS route FROM p""")
def route_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes of events as windows; purchases are the target, and overlaps are marked at even ids only."""
    from colloquy.operators.joins import overlap_join
    from colloquy.plans.joins import HOUR, _left, _right

    met = overlap_join(_left(spark, sf_dir), _right(spark, sf_dir), ["user_id"], 2 * HOUR).where("event_id <> other")
    met = spans(spark, sf_dir).select("event_id", "event_type").join(met.select("event_id", "type_r"), "event_id")
    met = met.groupBy("event_id").agg(F.count_distinct(F.when(F.col("type_r") != F.col("event_type"), F.col("type_r"))).alias("others"))
    rows = spans(spark, sf_dir).join(met, "event_id", "left")
    t, marked = F.col("event_type"), F.col("others").isNotNull() & (F.col("event_id") % 2 == 0)
    route = O.route(F.col("value") > 300, F.col("value") < 1, t == "error", marked, F.coalesce("others", F.lit(0)) + 1, t == "purchase")
    return rows.select("event_id", route.alias("route"))


@query("""WITH e AS (SELECT vec_id, label, embedding[1]::DOUBLE AS m, embedding[2]::DOUBLE AS m2, abs(embedding[3]) * 5 AS style, CASE WHEN vec_id % 5 > 0 THEN embedding[4]::DOUBLE END AS x FROM embeddings),
f AS (SELECT *, label < 5 AND m >= 0.135 AND coalesce(x >= 0, true) AS audio FROM e)
SELECT vec_id, CASE WHEN vec_id % 23 = 0 THEN 'NON_TARGET_TTS' WHEN vec_id % 19 = 0 THEN 'UNKNOWN' WHEN label = 9 THEN 'NON_TARGET_GUEST' WHEN m2 < -0.1 THEN 'NON_TARGET_GUEST' WHEN m2 < 0 THEN 'NON_TARGET_KNOWN' WHEN audio AND vec_id % 2 = 0 AND vec_id % 7 = 0 THEN 'UNKNOWN'
    WHEN audio AND vec_id % 2 = 0 AND vec_id % 3 <> 0 AND style >= 0.6 THEN 'TARGET_HIGH' WHEN audio AND vec_id % 3 <> 0 THEN 'TARGET_MEDIUM' WHEN label >= 5 AND vec_id % 3 = 0 THEN 'NON_TARGET_KNOWN' ELSE 'UNKNOWN' END AS identity,
    CASE WHEN m2 >= 0 AND vec_id % 23 > 0 AND vec_id % 19 > 0 AND label > 5 AND label < 9 AND vec_id % 3 = 0 THEN CASE WHEN m > -0.135 OR coalesce(x > 0, false) THEN 'weak' ELSE 'strong' END END AS evidence FROM f""")
def fusion_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identities fused from vectors' first dimensions as margins and from ids as metadata."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", *[F.get("embedding", F.lit(k)).cast("double").alias(n) for k, n in enumerate(("m", "m2", "m3", "m4"))])
    ident = F.col("vec_id")
    second = F.when(F.col("m2") < -0.1, "GUEST").when(F.col("m2") < 0, "OTHER").otherwise("TARGET")
    state = O.fuse_identity(
        F.when(F.col("label") < 5, "TARGET").otherwise("OTHER"), F.col("m"), F.when(ident % 5 > 0, F.col("m4")), second, ident % 2 == 0, ident % 3 == 0, ident % 7 == 0, F.abs(F.get(F.array("m3"), F.lit(0)).cast("float")) * 5, ident % 23 == 0, ident % 19 == 0, F.col("label") == 9
    )
    by_metadata = state["reason"].isin("model_and_metadata", "weak_margin_and_metadata") & F.col("label").between(6, 8)
    evidence = F.when(by_metadata, F.when(state["reason"] == "weak_margin_and_metadata", "weak").otherwise("strong"))
    return rows.select("vec_id", state["state"].alias("identity"), evidence.alias("evidence"))


@query(f"""WITH {TURNS}, w AS (SELECT source_id, count(*) AS n, count(*) FILTER (identity = 'TARGET_HIGH') AS t, count(*) FILTER (suspicious) AS s, count(*) FILTER (identity = 'UNKNOWN') AS u FROM turns GROUP BY 1)
SELECT source_id, CASE WHEN u > 1 THEN 'Q' WHEN t >= 0.4 * n AND s = 0 THEN 'S' WHEN t >= 0.3 * n AND s <= 1 THEN 'A' WHEN t > 0 THEN 'B' ELSE 'Q' END AS grade FROM w""")
def grade_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades of conversations by their shares of target, suspicious and unknown turns."""
    rows = _turns(spark, sf_dir).groupBy("source_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("identity") == "TARGET_HIGH").alias("t"), F.count_if("suspicious_transcription").alias("s"), F.count_if(F.col("identity") == "UNKNOWN").alias("u")
    )
    n, t, s = F.col("n"), F.col("t"), F.col("s")
    grade = F.when(F.col("u") > 1, "Q").when((t >= 0.4 * n) & (s == 0), "S").when((t >= 0.3 * n) & (s <= 1), "A").when(t > 0, "B").otherwise("Q")
    return rows.select("source_id", grade.alias("grade"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'acquire' WHEN 'P' THEN 'process' ELSE 'done' END AS stage, round((6 - o_orderpriority[1]::INT) * 10 + least(o_totalprice / 50000.0, 5.0), 8) AS score FROM orders""")
def closure_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A work queue's stage and score from status, priority and size."""
    stage = F.when(F.col("o_orderstatus") == "O", "acquire").when(F.col("o_orderstatus") == "P", "process").otherwise("done")
    score = (6 - F.substring("o_orderpriority", 1, 1).cast("int")) * 10 + F.least(F.col("o_totalprice") / 50000.0, F.lit(5.0))
    return table(spark, sf_dir, "orders").select("o_orderkey", stage.alias("stage"), F.round(score, 8).alias("score"))


@query("""SELECT CASE WHEN count(*) = count(DISTINCT o_orderkey) THEN 'PASS' ELSE 'FAIL' END AS unique_keys, CASE WHEN count(*) FILTER (o_totalprice IS NULL OR o_totalprice < 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS prices, CASE WHEN count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) = 0 THEN 'PASS' ELSE 'FAIL' END AS closed_states,
CASE WHEN (SELECT count(*) FROM orders ANTI JOIN customer ON o_custkey = c_custkey) = 0 THEN 'PASS' ELSE 'FAIL' END AS customers_known FROM orders""")
def gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gates over the orders: unique keys, valid values, allowed states, references that resolve."""
    orders = table(spark, sf_dir, "orders")
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("known")).distinct()
    counts = orders.join(known, "o_custkey", "left").agg(
        F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("keys"), F.count_if(F.col("o_totalprice").isNull() | (F.col("o_totalprice") < 0)).alias("bad"),
        F.count_if(~F.col("o_orderstatus").isin("F", "O")).alias("open"), F.count_if(F.col("known").isNull()).alias("lost"),
    )
    return counts.select(*O.gates(unique_keys=F.col("n") == F.col("keys"), prices=F.col("bad") == 0, closed_states=F.col("open") == 0, customers_known=F.col("lost") == 0))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag IS DISTINCT FROM 'N' THEN 'STALE_FLAG' WHEN l_linestatus IS DISTINCT FROM 'O' THEN 'STALE_STATUS' WHEN l_discount > 0.05 THEN 'STALE_DISCOUNT' ELSE 'COMPATIBLE' END AS state FROM lineitem""")
def version_compatibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first key in which a record differs from what is expected."""
    state = F.when(~F.col("l_returnflag").eqNullSafe("N"), "STALE_FLAG").when(~F.col("l_linestatus").eqNullSafe("O"), "STALE_STATUS").when(F.col("l_discount") > 0.05, "STALE_DISCOUNT").otherwise("COMPATIBLE")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", state.alias("state"))


@query("""SELECT conv_id, turn, array_to_string(list_filter([CASE WHEN r IS NULL OR r = '' THEN 'role' END, CASE WHEN t IS NULL OR t = '' THEN 'text' END, CASE WHEN len(w) = 0 THEN 'words' END, CASE WHEN k IS NULL THEN 'k' END], lambda x: x IS NOT NULL), ',') AS missing
FROM (SELECT conv_id, turn, nullif(role, 'system') AS r, CASE WHEN length(text) % 7 = 0 THEN '' ELSE text END AS t, regexp_extract_all(text, '[0-9]+') AS w, CASE WHEN turn % 3 > 0 THEN turn END AS k FROM conversations)""")
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of four required fields each turn lacks; some are emptied so that there is something to find."""
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.nullif("role", F.lit("system")).alias("role"), F.when(F.length("text") % 7 == 0, "").otherwise(F.col("text")).alias("text"),
        F.regexp_extract_all("text", F.lit("([0-9]+)"), 1).alias("words"), F.when(F.col("turn") % 3 > 0, F.col("turn")).alias("k"),
    )
    return rows.select("conv_id", "turn", F.array_join(O.missing_fields(rows, ["role", "text", "words", "k"]), ",").alias("missing"))
