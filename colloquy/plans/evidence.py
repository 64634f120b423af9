"""Queries over triggers, texts that stand, roles and clips for review."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import evidence as O
from colloquy.operators import fold, splits, turns
from colloquy.plans.base import query
from colloquy.plans.turns import TURNS, _turns
from colloquy.tables import table

_STOP = ", ".join("'" + w + "'" for w in T.STOP_WORDS)
_CONTENT = f"list_distinct(list_filter(regexp_extract_all(lower({{}}), '[a-z]{{{{3,}}}}'), lambda x: x NOT IN ({_STOP})))"


def _has(words: str) -> str:
    return f"regexp_matches(v, '(^|[^a-z0-9_])({words})([^a-z0-9_]|$)')"


@query(f"""WITH {TURNS}, c AS (SELECT turn_id, speaker, text, lag(text) OVER (PARTITION BY source_id ORDER BY idx) AS ctx FROM turns),
n AS (SELECT *, lower(trim(regexp_replace(ctx, '\\s+', ' ', 'g'))) AS v, list_sort(list_intersect({_CONTENT.format('ctx')}, {_CONTENT.format('text')})) AS o FROM c WHERE ctx IS NOT NULL),
f AS (SELECT *, list_sort(list_filter([CASE WHEN contains(v, '?') THEN 'QUESTION_MARK' END, CASE WHEN {_has('what|why|how|where|when|who|which|can|could|would|do|did|is|are|will|should')} THEN 'QUESTION_OR_MODAL_PATTERN' END,
    CASE WHEN {_has('try|check|look|tell|show|remember|explain|use|press|go|get|please|stop|wait|listen')} THEN 'IMPERATIVE_OR_REQUEST_PATTERN' END,
    CASE WHEN {_has('you|your|yours|we|our|than')} THEN 'ADDRESS_OR_PARTICIPANT_PATTERN' END, CASE WHEN len(o) > 0 THEN 'CONTENT_TOKEN_OVERLAP' END], lambda x: x IS NOT NULL)) AS fs FROM n)
SELECT turn_id, array_to_string(fs, ',') AS flags, array_to_string(o, ',') AS overlap, (2 * (len(fs) > 0)::INT + (len(o) > 0)::INT + (speaker = 'assistant')::INT) AS score FROM f""")
def trigger_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signs in the turn before that it calls for an answer; 'than' stands for a participant's name."""
    rows = _turns(spark, sf_dir).withColumn("ctx", F.lag("text").over(turns.by_turn())).where("ctx is not null")
    rows = rows.withColumn("e", O.trigger_evidence(F.col("ctx"), F.col("text"), ["than"]))
    return rows.select("turn_id", F.array_join("e.flags", ",").alias("flags"), F.array_join("e.overlap", ",").alias("overlap"), O.trigger_score(F.col("e"), F.col("speaker") == "assistant").alias("score"))


_KINDS = ["MATCH", "MINOR_TEXT_CHANGE", "MISSING_NEW_SPEECH", "MAJOR_TRANSCRIPT_CONFLICT", "BOUNDARY_CHANGE"]


@query(f"""WITH {TURNS}, p AS (SELECT turn_id, CASE WHEN n % 13 = 0 THEN ' ' ELSE text END AS a, CASE WHEN n % 3 = 0 THEN '' ELSE text || ' x' END AS b, n % 11 = 0 AS unheard,
    CASE n % 7 WHEN 0 THEN 'MATCH' WHEN 1 THEN 'MINOR_TEXT_CHANGE' WHEN 2 THEN 'MISSING_NEW_SPEECH' WHEN 3 THEN 'MAJOR_TRANSCRIPT_CONFLICT' WHEN 4 THEN 'BOUNDARY_CHANGE' END AS d FROM turns),
q AS (SELECT *, CASE WHEN unheard THEN NULL ELSE d END AS k FROM p),
r AS (SELECT *, CASE WHEN trim(a) = '' THEN 'FROZEN_TARGET_OLD_TRANSCRIPT_MISSING' WHEN k IS NULL AND b <> '' THEN 'FROZEN_TARGET_DISAGREEMENT_UNCLASSIFIED' WHEN k IS NULL THEN 'FROZEN_VERIFIED_TARGET_NO_NEW_ASR_EVIDENCE' WHEN k = 'MATCH' THEN 'FROZEN_VERIFIED_TARGET_EXACT_MATCH'
    WHEN k IN ('MINOR_TEXT_CHANGE', 'MISSING_NEW_SPEECH') THEN 'FROZEN_VERIFIED_TARGET_OLD_TRANSCRIPT_AUTHORITY' ELSE 'FROZEN_TARGET_' || k END AS resolver FROM q)
SELECT turn_id, resolver, starts_with(resolver, 'FROZEN_VERIFIED') AS resolved, CASE WHEN resolver = 'FROZEN_VERIFIED_TARGET_EXACT_MATCH' THEN trim(b) WHEN starts_with(resolver, 'FROZEN_VERIFIED') THEN trim(a) END AS text,
    CASE WHEN trim(a) <> '' AND b = '' AND d IS NULL THEN 'EXISTING_TRANSCRIPT_AUTHORITY' WHEN trim(a) <> '' AND b <> '' AND d = 'MATCH' THEN 'EXACT_OLD_NEW_MATCH' END AS plain_resolver FROM r""")
def frozen_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of an old and a new text stands for each turn, for verified targets and for others."""
    n = F.length("text")
    a, b = F.when(n % 13 == 0, " ").otherwise(F.col("text")), F.when(n % 3 == 0, "").otherwise(F.concat("text", F.lit(" x")))
    kind = F.get(F.array(*map(F.lit, _KINDS)), (n % 7).cast("int"))
    rows = _turns(spark, sf_dir).select("turn_id", O.resolve_frozen_text(a, b, kind, n % 11 == 0).alias("f"), O.resolve_text(a, b, kind).alias("p"))
    return rows.select("turn_id", "f.resolver", (F.col("f.state") == "RESOLVED").alias("resolved"), "f.text", F.col("p.resolver").alias("plain_resolver"))


@query(f"""WITH {TURNS} SELECT turn_id, CASE WHEN n % 2 = 0 AND speaker IN ('user', 'assistant') THEN speaker WHEN identity IN ('TARGET_HIGH', 'TARGET_MEDIUM') THEN 'assistant' ELSE 'user' END AS role FROM turns""")
def turn_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles of turns, half of which have none of their own."""
    role = F.when(F.length("text") % 2 == 0, F.col("speaker"))
    return _turns(spark, sf_dir).select("turn_id", O.role_of_turn(role, F.col("identity"), turns.TARGETS).alias("role"))


@query()
def review_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surest stretches of 12 s or more of each conversation that do not overlap, four at most; greedy, so a test compares it with a loop."""
    rows = _turns(spark, sf_dir).withColumn("cluster", F.floor(F.col("idx") / 4))
    found = turns.growing_windows(rows, "cluster", least_confidence=0.72, shortest_ms=12_000)
    first = F.regexp_extract("turn_id", r"(\d+)$", 1).cast("long")
    clips = found.select(F.col("source_id").alias("grp"), first.alias("id"), F.col("start_ms").alias("start"), F.col("end_ms").alias("end"), F.col("confidence").alias("weight"))
    return fold.greedy_non_overlap(clips, 4)


@query()
def target_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' market segments and nations as families that fill splits; a test compares it with a loop."""
    rows = table(spark, sf_dir, "customer").groupBy(F.concat_ws("/", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("family")).agg(F.count("*").alias("n"))
    return splits.target_filled_splits(rows, "family")
