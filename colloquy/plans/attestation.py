"""Queries over enrolments, names that speakers give themselves, findings that rows bear out, and near samples of one target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import attestation as O
from colloquy.operators import turns
from colloquy.operators.redundancy import near_duplicate_ledger as ledger
from colloquy.plans.base import query
from colloquy.plans.turns import TURNS, _turns
from colloquy.tables import table


@query("""WITH e AS (SELECT event_id, user_id % 9 <> 0 AS complete, event_id % 7 = 0 AS longer, event_id % 5 <> 0 AS apart, event_id % 11 <> 0 AS whole, event_type IN ('click', 'purchase') AS confirmed, event_id % 4 AS m,
    event_id % 13 = 0 AS synthetic, event_id % 2 = 0 AS published, event_id % 6 <> 0 AS supported, event_id % 3 AS d, event_id % 10 <> 0 AS clear, event_id % 17 = 0 AS conflict, value IS NULL AS unknown FROM events),
x AS (SELECT event_id, confirmed, [CASE WHEN NOT complete THEN 'INCOMPLETE_PROVENANCE' END, CASE WHEN longer OR unknown THEN 'DURATION_MISMATCH' END, CASE WHEN confirmed AND NOT apart THEN 'UNRESOLVED_OVERLAP' END,
    CASE WHEN NOT whole THEN 'CHECKSUM_LENGTH' END, CASE WHEN confirmed AND NOT supported THEN 'EVIDENCE_AGAINST' END, CASE WHEN confirmed AND m = 2 AND (NOT synthetic OR published) THEN 'FIXTURE_IN_USE' END,
    CASE WHEN confirmed AND m <> 2 AND synthetic THEN 'REAL_MARKED_SYNTHETIC' END, CASE WHEN confirmed AND m = 0 AND d <> 1 THEN 'NO_GOLD_EVIDENCE' END, CASE WHEN confirmed AND m = 1 AND d <> 0 THEN 'NOT_INDEPENDENT' END,
    CASE WHEN confirmed AND m = 3 THEN 'UNSUPPORTED_METHOD' END, CASE WHEN confirmed AND m <> 2 AND (NOT clear OR conflict) THEN 'UNCLEAR_IDENTITY' END] AS r FROM e)
SELECT event_id, array_to_string(list_sort(list_filter(r, lambda v: v IS NOT NULL)), ',') AS errors, confirmed AND len(list_filter(r, lambda v: v IS NOT NULL)) = 0 AS stands FROM x""")
def enrolment_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as enrolments: what stands against each, and which may be confirmed."""
    k, value = F.col("event_id"), F.col("value").cast("double")
    pick = lambda n, *values: F.get(F.array(*map(F.lit, values)), (k % n).cast("int"))
    kinds = F.get(F.array(F.array(*map(F.lit, O.INDEPENDENT)), F.array(F.lit("HUMAN_GOLD")), F.array(F.lit("SOURCE_PROVENANCE"))), (k % 3).cast("int"))
    e = F.struct(
        (F.col("user_id") % 9 != 0).alias("complete"), F.lit(0.0).alias("start"), value.alias("end"), (value + F.when(k % 7 == 0, 0.5).otherwise(0.0)).alias("duration"),
        F.when(k % 5 != 0, "NO_OVERLAP_CONFIRMED").otherwise("OVERLAP").alias("overlap"), F.when(k % 11 != 0, F.sha2(k.cast("string"), 256)).otherwise(F.sha1(k.cast("string"))).alias("checksum"),
        F.when(F.col("event_type").isin("click", "purchase"), "CONFIRMED_TARGET").otherwise("PENDING").alias("status"), pick(4, "HUMAN_GOLD", "MULTI_EVIDENCE_CONSENSUS", "SYNTHETIC_FIXTURE", "GUESS").alias("method"),
        (k % 13 == 0).alias("synthetic"), (k % 2 == 0).alias("published"), F.array(F.lit("SUPPORTS_CONFIRMATION"), F.when(k % 6 != 0, "SUPPORTS_CONFIRMATION").otherwise("INCONCLUSIVE")).alias("decisions"),
        kinds.alias("domains"), (k % 10 != 0).alias("boundary_clear"), (k % 17 == 0).alias("conflict"), F.lit(False).alias("collision"),
    )
    rows = table(spark, sf_dir, "events").select("event_id", e["status"].alias("status"), O.enrolment_errors(e).alias("x"))
    return rows.select("event_id", F.array_join("x", ",").alias("errors"), ((F.col("status") == "CONFIRMED_TARGET") & (F.size("x") == 0)).alias("stands"))


_SELF = "(i\\s*['’]?m|i am|my name is|this is|hey( guys)?[, ]+i\\s*['’]?m)"
_BACK = "(^|[^a-z0-9_])(pretend|pretending|roleplay|call|called|like|quote)\\s*"
_SAID = "CASE n % 5 WHEN 0 THEN 'I''m ' || speaker || '. ' WHEN 1 THEN 'Pretend  I''m ' || speaker || ' ' WHEN 2 THEN speaker || ' here. ' WHEN 3 THEN 'I am ' || speaker || '''s ' ELSE '' END || text"


@query(f"""WITH {TURNS}, s AS (SELECT turn_id, regexp_replace(lower(trim(regexp_replace({_SAID}, '\\s+', ' ', 'g'))), '{_BACK.replace("'", "''")}{_SELF.replace("'", "''")}', ' ', 'g') AS v FROM turns)
SELECT turn_id, array_to_string(list_filter(['user', 'assistant'], lambda x: regexp_matches(v, '(^|[^a-z0-9_]){_SELF.replace("'", "''")}\\s+(an? )?' || x || '($|[^a-z0-9_''’])') OR regexp_matches(v, '(^|[^a-z0-9_])' || x || ' here($|[^a-z0-9_])')), ',') AS names FROM s""")
def self_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles by which speakers call themselves at the beginning of turns, some of them taken back or possessive."""
    n, speaker = F.length("text") % 5, F.col("speaker")
    opening = F.when(n == 0, F.concat(F.lit("I'm "), speaker, F.lit(". "))).when(n == 1, F.concat(F.lit("Pretend  I'm "), speaker, F.lit(" "))).when(n == 2, F.concat(speaker, F.lit(" here. ")))
    said = F.concat(opening.when(n == 3, F.concat(F.lit("I am "), speaker, F.lit("'s "))).otherwise(""), "text")
    found = O.self_identified(said, F.array(F.lit("user"), F.lit("assistant")))
    return _turns(spark, sf_dir).select("turn_id", F.array_join(found, ",").alias("names"))


@query(f"""WITH {TURNS}, t AS (SELECT turn_id, source_id, idx, CASE n % 3 WHEN 0 THEN speaker WHEN 1 THEN 'Redacted' ELSE text END AS text, n % 7 <> 0 AS verified, n % 4 AS c FROM turns),
v AS (SELECT *, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS v FROM t),
w AS (SELECT *, lag(v, 1) OVER o AS a, lag(v, 2) OVER o AS b, lag(v, 3) OVER o AS d, lag(idx // 2, 1) OVER o AS ia, lag(idx // 2, 2) OVER o AS ib, lag(idx // 2, 3) OVER o AS id FROM v WINDOW o AS (PARTITION BY source_id ORDER BY idx))
SELECT turn_id, CASE WHEN NOT verified THEN NULL WHEN c = 0 AND length(v) >= 4 AND (v = a OR v = b OR v = d) THEN 'target_leakage'
    WHEN c = 1 AND (length(a) >= 8 AND (a = b AND ia = ib OR a = d AND ia = id) OR length(b) >= 8 AND b = d AND ib = id) THEN 'duplicate_speech'
    WHEN c = 2 AND ('redacted' IN (v, coalesce(a, ''), coalesce(b, ''), coalesce(d, ''))) THEN 'asr_noise' WHEN c = 3 AND trim(text) <> '' THEN 'context_too_thin' END AS category FROM w""")
def corroborated_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims about turns and the three before each, and which of them the turns bear out."""
    n = F.length("text")
    rows = _turns(spark, sf_dir).withColumn("said", F.when(n % 3 == 0, F.col("speaker")).when(n % 3 == 1, "Redacted").otherwise(F.col("text")))
    message = F.struct(F.col("said").alias("text"), F.array(F.floor(F.col("idx") / 2).cast("string")).alias("turn_ids"), F.col("start_ms").alias("start"), F.col("end_ms").alias("end"))
    window = F.collect_list(message).over(turns.by_turn().rowsBetween(-3, 0))
    category = F.get(F.array(*map(F.lit, ["target_leakage", "Duplicate-Speech", "control noise", "context_too_thin"])), (n % 4).cast("int"))
    claim = F.struct(F.lit(True).alias("finding"), (n % 7 != 0).alias("verified"), category.alias("category"), F.col("said").alias("evidence"))
    return rows.withColumn("m", window).select("turn_id", O.corroborated(claim, F.col("m"), F.lit(None).cast("string")).alias("category"))


@query()
def near_duplicate_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of each turn with one and with two turns before it: near pairs of a conversation, and which sample goes; a test compares the rule with a loop."""
    tokens = T.tokens(F.col("text"))
    rows = _turns(spark, sf_dir).select("source_id", "turn_id", "idx", "speaker", "start_ms", "end_ms", tokens.alias("target"))
    rows = rows.withColumn("w", F.collect_list("target").over(turns.by_turn().rowsBetween(-2, -1)))
    each = rows.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("k")).where(F.size("w") >= F.col("k"))
    samples = each.select(
        F.concat_ws(":", "turn_id", F.col("k").cast("string")).alias("id"), F.col("source_id").alias("family"), F.col("speaker").alias("source"), "start_ms", "end_ms",
        F.flatten(F.slice("w", -F.col("k"), F.col("k"))).alias("context"), "target", F.array("turn_id").alias("target_ids"), (F.col("idx") % 2 == 0).alias("original"), F.col("k").alias("context_size"),
    )
    return ledger(samples)
