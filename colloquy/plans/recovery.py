"""Queries over the recovery of turns from a second transcript."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import recovery as O
from colloquy.operators.joins import overlap_join
from colloquy.operators.similarity import sequence_ratio
from colloquy.operators.turns import by_turn
from colloquy.operators.turns import growing_windows as growing
from colloquy.plans.base import query
from colloquy.plans.turns import TURNS, _turns
from colloquy.tables import table

_QUOTED = lambda names: ", ".join(f"'{x}'" for x in names)
#: The texts that stand for something not said, in SQL.
_SENTINELS = "'filtered', 'filter', 'censored', 'redacted', 'content filtered', 'message filtered', 'audio filtered'"


def _tok(text: str) -> str:
    return rf"regexp_extract_all(trim(regexp_replace(lower(coalesce({text}, '')), '\s+', ' ', 'g')), '[a-z0-9'']+')"


def _overlap(a: str, b: str) -> str:
    """Jaccard overlap of two token lists in SQL."""
    union = f"len(list_distinct(list_concat({a}, {b})))"
    return f"CASE WHEN {union} = 0 THEN 1.0 ELSE len(list_intersect(list_distinct({a}), list_distinct({b})))::DOUBLE / {union} END"


def _holds(a: str, b: str) -> str:
    pad = lambda x: f"' ' || array_to_string({x}, ' ') || ' '"
    return f"(len({b}) > 0 AND contains({pad(a)}, {pad(b)}))"


@query(f"""WITH {TURNS}, c AS (SELECT *, CASE n % 5 WHEN 0 THEN NULL WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN '' ELSE identity END AS label, CASE n % 3 WHEN 0 THEN 'assistant' WHEN 1 THEN 'user' END AS role0, CASE n % 2 WHEN 0 THEN 'user' END AS role1 FROM turns)
SELECT turn_id, CASE WHEN label IN ('TARGET_HIGH', 'TARGET_MEDIUM') THEN 'CONFIRMED_TARGET' WHEN coalesce(label, '') NOT IN ('', 'UNKNOWN', 'AMBIGUOUS') THEN 'CONFIRMED_NON_TARGET' WHEN role0 = 'assistant' THEN 'CONFIRMED_TARGET' WHEN role0 = 'user' OR role1 = 'user' THEN 'CONFIRMED_NON_TARGET' ELSE 'AMBIGUOUS_SPEAKER' END AS speaker_state,
CASE WHEN coalesce(label, '') NOT IN ('', 'UNKNOWN', 'AMBIGUOUS') THEN 'FROZEN_IDENTITY_AUTHORITY' WHEN role0 IS NOT NULL THEN 'BASELINE_MATERIALIZED_ROLE_MONOTONICITY' WHEN role1 = 'user' THEN 'FROZEN_SEMANTIC_CONTEXT_ROLE' ELSE 'INSUFFICIENT_IDENTITY_EVIDENCE' END AS basis FROM c""")
def speaker_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakers by identity, else by the role of the baseline, else by a frozen user role."""
    n = F.length("text")
    label = F.when(n % 5 == 0, F.lit(None)).when(n % 5 == 1, "UNKNOWN").when(n % 5 == 2, "").otherwise(F.col("identity"))
    state = O.speaker_state(label, F.when(n % 3 == 0, "assistant").when(n % 3 == 1, "user"), F.when(n % 2 == 0, "user"))
    return _turns(spark, sf_dir).select("turn_id", state.alias("s")).select("turn_id", "s.speaker_state", "s.basis")


@query("""WITH k AS (SELECT event_id, user_id % 40 AS a, (event_id * 7) % 40 AS b, event_id % 3 AS n FROM events),
an AS (SELECT i AS key, CASE WHEN i % 4 = 0 THEN NULL WHEN i % 3 = 0 THEN 'CONFIRMED_TARGET' ELSE 'CONFIRMED_NON_TARGET' END AS st FROM range(40) AS r(i)),
e AS (SELECT event_id, n, x.st AS sa, y.st AS sb FROM k JOIN an x ON x.key = a JOIN an y ON y.key = b)
SELECT event_id, CASE WHEN n = 1 AND sa IS NOT NULL THEN sa WHEN n = 2 AND sa = sb THEN sa ELSE 'AMBIGUOUS_SPEAKER' END AS speaker_state,
CASE WHEN n = 0 THEN 'INSUFFICIENT_IDENTITY_EVIDENCE' WHEN (n = 1 AND sa IS NOT NULL) OR (n = 2 AND sa = sb) THEN 'ANCHOR' ELSE 'CONFLICTING_WINDOW_LOCAL_CLUSTER_ANCHORS' END AS basis FROM e""")
def anchored_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakers of events with none, one or two cluster keys, a quarter of which have no anchor."""
    a, b = F.col("user_id") % 40, (F.col("event_id") * 7) % 40
    keys = F.when(F.col("event_id") % 3 == 0, F.array().cast("array<long>")).when(F.col("event_id") % 3 == 1, F.array(a)).otherwise(F.array(a, b))
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), keys.alias("keys"))
    state = F.when(F.col("id") % 3 == 0, O.TARGET).otherwise(O.OTHER)
    anchors = spark.range(40).where("id % 4 <> 0").select(F.col("id").alias("key"), state.alias("speaker_state"), F.lit("ANCHOR").alias("basis"))
    return O.anchored_speakers(rows, anchors).select(F.col("id").alias("event_id"), "speaker_state", "basis")


#: Assistant turns with up to three turns before them; a turn of length divisible by 9 has no settled speaker.
_CONTEXT = f"""WITH {TURNS}, c AS (
    SELECT *, CASE WHEN n % 9 = 0 THEN 'AMBIGUOUS_SPEAKER' ELSE 'SETTLED' END AS st, {_tok('text')} AS tk FROM turns),
l AS (SELECT turn_id, speaker, text, tk, start_ms, {", ".join(f"lag(struct_pack(id := turn_id, role := speaker, st := st, text := text, tk := tk, e := end_ms), {k}) OVER w AS c{k}" for k in (1, 2, 3))}
    FROM c WINDOW w AS (PARTITION BY source_id ORDER BY idx)),
"""


def _verdict(size: int) -> str:
    """SQL of a target's state, reason and trigger with the last size turns as context."""
    listed = ", ".join(f"c{k}" for k in range(size, 0, -1))
    return f"""v{size} AS (SELECT *, list_filter(list_filter([{listed}], lambda x: x IS NOT NULL), lambda x: x.st <> 'AMBIGUOUS_SPEAKER' AND array_to_string(x.tk, ' ') NOT IN ({_SENTINELS})) AS vis FROM l WHERE speaker = 'assistant'),
u{size} AS (SELECT *, list_filter(vis, lambda x: x.role = 'user') AS us FROM v{size}),
j{size} AS (SELECT turn_id, us[-1].id AS trigger_id, c1 IS NOT NULL AS h1, c2 IS NOT NULL AS h2, c3 IS NOT NULL AS h3,
  CASE WHEN trim(text) = '' THEN 'TARGET_TEXT_MISSING' WHEN len(vis) = 0 THEN 'NO_VISIBLE_CONTEXT' WHEN len(us) = 0 THEN 'NO_CONFIRMED_NON_TARGET_CONTEXT'
    WHEN (start_ms - vis[-1].e) / 1000.0 > 2.0 THEN 'LARGE_PRE_TARGET_GAP'
    WHEN len(tk) <= 4 OR coalesce(tk[1] IN ({_QUOTED(O.ANSWER_STARTERS)}), false) OR len(list_intersect(us[-1].tk, tk)) > 0 THEN 'VISIBLE_IMMEDIATE_USER_TRIGGER' ELSE 'MISSING_IMMEDIATE_TRIGGER' END AS reason FROM u{size}),
s{size} AS (SELECT *, CASE WHEN reason IN ('TARGET_TEXT_MISSING', 'NO_VISIBLE_CONTEXT') THEN 'CONTEXT_INSUFFICIENT' WHEN reason = 'VISIBLE_IMMEDIATE_USER_TRIGGER' THEN 'CONTEXT_SUFFICIENT' ELSE 'CONTEXT_AMBIGUOUS' END AS state FROM j{size})"""


def _targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns with their context; pauses of more than two seconds count as large, so that the table has some."""
    n = F.length("text")
    state = F.when(n % 9 == 0, O.AMBIGUOUS).otherwise("SETTLED")
    own = F.struct(F.col("turn_id").alias("id"), F.col("speaker").alias("role"), state.alias("state"), "text", (F.col("end_ms") / 1000.0).alias("end"))
    before = F.array_compact(F.array(*[F.lag("own", k).over(by_turn()) for k in (3, 2, 1)]))
    rows = _turns(spark, sf_dir).withColumn("own", own).withColumn("context", before)
    return rows.where("speaker = 'assistant'").select("turn_id", "context", "text", (F.col("start_ms") / 1000.0).alias("start"))


@query(_CONTEXT + _verdict(3) + " SELECT turn_id, state, reason, CASE WHEN state = 'CONTEXT_SUFFICIENT' THEN trigger_id END AS trigger_id FROM s3")
def context_sufficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether up to three turns before a target hold what it answers."""
    judged = O.context_sufficiency(F.col("context"), F.col("text"), F.col("start"), 2.0)
    return _targets(spark, sf_dir).select("turn_id", judged.alias("j")).select("turn_id", "j.state", "j.reason", "j.trigger_id")


@query(_CONTEXT + ", ".join(map(_verdict, (1, 2, 3))).replace("> 2.0 THEN", "> 8.0 THEN") + """ SELECT s3.turn_id, CASE WHEN s1.h1 AND s1.state = 'CONTEXT_SUFFICIENT' THEN 1 WHEN s2.h2 AND s2.state = 'CONTEXT_SUFFICIENT' THEN 2 ELSE s3.h1::INT + s3.h2::INT + s3.h3::INT END AS size,
CASE WHEN (s1.h1 AND s1.state = 'CONTEXT_SUFFICIENT') OR (s2.h2 AND s2.state = 'CONTEXT_SUFFICIENT') THEN 'CONTEXT_SUFFICIENT' ELSE s3.state END AS state FROM s1 JOIN s2 USING (turn_id) JOIN s3 USING (turn_id)""")
def sufficient_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shortest context that the sufficiency check accepts."""
    found = O.minimal_suffix(F.col("context"), F.col("text"), F.col("start"))
    return _targets(spark, sf_dir).select("turn_id", found.alias("f")).select("turn_id", "f.size", "f.state")


#: Old and new texts of turns: the same, without the first five characters, with more words, the next turn's, or nothing.
_PAIRS = f"""WITH {TURNS}, p AS (SELECT *, CASE n % 5 WHEN 0 THEN text WHEN 1 THEN substring(text, 6) WHEN 2 THEN text || ' and more words here' WHEN 3 THEN coalesce(lead(text) OVER (PARTITION BY source_id ORDER BY idx), '') ELSE '' END AS fresh FROM turns),
t AS (SELECT *, {_tok('text')} AS a, {_tok('fresh')} AS b FROM p), q AS (SELECT *, {_overlap('a', 'b')} AS sim FROM t)
"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, following = F.length("text"), F.coalesce(F.lead("text").over(by_turn()), F.lit(""))
    fresh = (
        F.when(n % 5 == 0, F.col("text")).when(n % 5 == 1, F.substring("text", 6, 1 << 30)).when(n % 5 == 2, F.concat("text", F.lit(" and more words here")))
        .when(n % 5 == 3, following).otherwise("")
    )
    rows = _turns(spark, sf_dir).withColumn("fresh", fresh)
    return rows.withColumn("sim", T.jaccard(F.array_distinct(T.tokens(F.col("text"))), F.array_distinct(T.tokens(F.col("fresh")))))


_TURN_STATE = f"""CASE WHEN len(b) = 0 OR a = b OR sim >= 0.88 THEN 'MATCH_EXISTING' WHEN {_holds('b', 'a')} AND len(b) > len(a) AND speaker <> 'assistant' AND (len(b) - len(a)) <= 0.5 * greatest(1, len(a)) THEN 'EXTEND_EXISTING'
    WHEN {_holds('b', 'a')} AND len(b) > len(a) THEN 'AMBIGUOUS' WHEN {_holds('a', 'b')} AND sim >= 0.55 THEN 'MATCH_EXISTING' ELSE 'AMBIGUOUS' END"""


@query(_PAIRS + f"""SELECT turn_id, {_TURN_STATE} AS state, round(CASE WHEN len(b) = 0 THEN 0.55 WHEN a = b OR sim >= 0.88 THEN greatest(0.88, sim) WHEN {_TURN_STATE} = 'EXTEND_EXISTING' THEN greatest(0.75, sim)
    WHEN {_TURN_STATE} = 'MATCH_EXISTING' THEN greatest(0.7, sim) ELSE sim END, 6) AS confidence FROM q""")
def turn_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old against new texts of turns; assistant turns are frozen. The similarity is that of token sets, so that SQL has it too."""
    state = O.reconcile_turn(F.col("text"), F.col("fresh"), F.col("sim"), F.col("speaker") == "assistant")
    return _pairs(spark, sf_dir).select("turn_id", state.alias("r")).select("turn_id", "r.state", "r.confidence")


@query(_PAIRS + f"""SELECT turn_id, CASE WHEN array_to_string(a, ' ') IN ({_SENTINELS}) OR trim(text) = '' OR speaker <> 'assistant' THEN 'UNRESOLVED' WHEN n % 23 = 0 THEN 'LOCAL_REASR_REQUIRED' WHEN n % 7 = 0 OR trim(fresh) = '' THEN 'BASELINE_CONFIRMED'
    WHEN sim >= 0.86 THEN 'AUDIO_CONFIRMED' WHEN sim >= 0.55 THEN 'AUDIO_MINOR_DISAGREEMENT' WHEN n % 11 < greatest(3, least(8, floor(len(a) * 0.4))) THEN 'AUDIO_UNAVAILABLE' ELSE 'AUDIO_MAJOR_CONTRADICTION' END AS state FROM q""")
def target_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether new texts confirm the assistant's turns."""
    n = F.length("text")
    state = O.resolve_target(F.col("text"), F.col("fresh"), F.col("sim"), n % 7 != 0, F.col("speaker") == "assistant", n % 23 == 0, n % 11)
    return _pairs(spark, sf_dir).select("turn_id", state["state"].alias("state"))


@query(f"""WITH {TURNS}, s AS (SELECT turn_id AS span_id, source_id, CASE n % 3 WHEN 0 THEN end_ms + 100000000 ELSE start_ms END AS s, CASE n % 3 WHEN 0 THEN end_ms + 100001000 WHEN 1 THEN end_ms ELSE end_ms + 8000 END AS e, text AS fresh, n % 2 = 0 AS echo FROM turns),
o AS (SELECT span_id, any_value(fresh) AS fresh, any_value(s.echo) AS echo, count(t.turn_id) AS olds, coalesce(string_agg(t.text, ' ' ORDER BY t.start_ms, t.turn_id), '') AS text
    FROM s LEFT JOIN turns t ON t.source_id = s.source_id AND s.s < t.end_ms AND t.start_ms < s.e GROUP BY 1),
t AS (SELECT *, 'user' AS speaker, {_tok('text')} AS a, {_tok('fresh')} AS b FROM o), q AS (SELECT *, {_overlap('a', 'b')} AS sim FROM t)
SELECT span_id, olds, CASE WHEN olds = 0 AND echo THEN 'BOUNDARY_ECHO' WHEN olds = 0 THEN 'TRUE_NEW' WHEN olds = 1 THEN {_TURN_STATE} WHEN sim >= 0.6 THEN 'MERGE_EXISTING' ELSE 'AMBIGUOUS_BOUNDARY' END AS state FROM q""")
def span_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans that overlap none, one or several old turns, a third each."""
    n = F.length("text")
    far = F.col("end_ms") + 100_000_000
    turns = _turns(spark, sf_dir)
    start, end = F.when(n % 3 == 0, far).otherwise(F.col("start_ms")), F.when(n % 3 == 0, far + 1000).when(n % 3 == 1, F.col("end_ms")).otherwise(F.col("end_ms") + 8000)
    spans = turns.select("source_id", F.col("turn_id").alias("span_id"), start.alias("start"), end.alias("end"), F.col("text").alias("fresh"), (n % 2 == 0).alias("echo"))
    olds = turns.select("source_id", F.col("start_ms").alias("start_r"), F.col("end_ms").alias("end_r"), "turn_id", "text")
    met = overlap_join(spans, olds, ["source_id"], 60_000, how="left").groupBy("span_id").agg(
        F.first("fresh").alias("fresh"), F.first("echo").alias("echo"), F.count("turn_id").alias("olds"),
        F.array_sort(F.collect_list(F.when(F.col("turn_id").isNotNull(), F.struct("start_r", "turn_id", "text")))).alias("parts"),
    )
    text = F.array_join(F.transform("parts", lambda x: x["text"]), " ")
    met = met.withColumn("text", text).withColumn("sim", T.jaccard(F.array_distinct(T.tokens(F.col("text"))), F.array_distinct(T.tokens(F.col("fresh")))))
    one = O.reconcile_turn(F.col("text"), F.col("fresh"), F.col("sim"), F.lit(False))["state"]
    return met.select("span_id", "olds", O.reconcile_span(F.col("olds"), F.col("echo"), one, F.col("sim")).alias("state"))


def recovery_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two candidate samples of every assistant turn, whose interaction is its opening and the number of its words."""
    turns = _turns(spark, sf_dir).where("speaker = 'assistant'").select("source_id", "idx", "turn_id", "text", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    words = T.tokens(F.col("text"))
    return turns.select(
        F.concat_ws(":", "turn_id", F.col("k").cast("string")).alias("id"), (F.length("text") % 4 == F.col("k")).alias("baseline"), F.col("turn_id").alias("target"),
        F.concat_ws("|", F.get(words, F.lit(0)), F.size(words).cast("string"), (F.col("idx") % 3).cast("string")).alias("interaction"),
        F.concat_ws("|", "source_id", (F.col("idx") % 2).cast("string")).alias("grp"), F.slice(words, 1, 3).alias("tokens"),
    )


@query()
def recovery_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which samples remain, and why the others go; an order of decisions is not SQL, so a test compares it with a plain fold."""
    return O.recovery_dedup(recovery_rows(spark, sf_dir))


@query()
def text_similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger of sequence ratio and token overlap of old and new texts; a test compares it with difflib."""
    rows = _pairs(spark, sf_dir)
    ratio = sequence_ratio(T.tokens(F.col("text")), T.tokens(F.col("fresh")))
    return rows.select("turn_id", F.round(O.text_similarity(F.col("text"), F.col("fresh"), ratio), 6).alias("similarity"))


@query(rf"""WITH {TURNS}, u AS (SELECT *, idx // 4 AS cl, regexp_replace(lower(text), '[^a-z0-9 ]', '', 'g') AS bare FROM turns WHERE speaker_confidence >= 0.78),
us AS (SELECT * FROM u WHERE NOT regexp_matches(text, '(?i)\[\s*(?:music|applause|laughter)\s*\]|<[^>]+>|seekiframe|javascript:') AND len(regexp_extract_all(text, '[A-Za-z0-9'']+')) >= 2
    AND NOT (length(bare) >= 20 AND len(list_distinct(list_filter(string_split(bare, ' '), lambda w: w <> ''))) <= 3)),
l AS (SELECT *, row_number() OVER w AS place, (cl IS DISTINCT FROM lag(cl) OVER w OR coalesce(start_ms - lag(end_ms) OVER w > 2500, false))::INT AS new FROM us WINDOW w AS (PARTITION BY source_id ORDER BY start_ms, idx)),
i AS (SELECT *, sum(new) OVER (PARTITION BY source_id ORDER BY place) AS run FROM l),
p AS (SELECT a.source_id, a.turn_id, a.start_ms, b.place, b.end_ms, b.speaker_confidence AS c, min(b.place) FILTER (b.end_ms - a.start_ms > 45000 AND b.place > a.place) OVER (PARTITION BY a.turn_id) AS stop
    FROM i a JOIN i b ON a.source_id = b.source_id AND a.run = b.run AND b.place >= a.place)
SELECT source_id, turn_id, any_value(start_ms) AS start_ms, arg_max(end_ms, place) AS end_ms, count(*) AS segments, round(avg(c), 4) AS confidence FROM p WHERE stop IS NULL OR place < stop
GROUP BY 1, 2 HAVING count(*) >= 2 AND arg_max(end_ms, place) - any_value(start_ms) BETWEEN 15000 AND 60000""")
def growing_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From every confident turn with usable text on the stretch of four neighbouring turns that grows to at most 45 s and lasts 15 s or more."""
    return growing(_turns(spark, sf_dir).withColumn("cluster", F.floor(F.col("idx") / 4)), "cluster")
