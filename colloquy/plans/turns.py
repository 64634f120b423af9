"""Queries over conversation turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import turns as O
from colloquy.plans.base import query
from colloquy.tables import table

#: The turns of conversations in SQL; see operators.turns.timeline().
TURNS = r"""
turns0 AS (
    SELECT conv_id::VARCHAR AS source_id, turn::BIGINT AS idx, format('{}:turn:{:06d}', conv_id, turn) AS turn_id, role AS speaker,
           CASE role WHEN 'assistant' THEN 'TARGET_HIGH' WHEN 'user' THEN 'NON_TARGET' ELSE 'UNKNOWN' END AS identity,
           coalesce(sum(length(text) * 50 + (length(text) % 40) * 100) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_ms,
           length(text) AS n, text
    FROM conversations),
turns AS (
    SELECT *, start_ms + n * 50 AS end_ms, 0.6 + (n % 41) / 100 AS speaker_confidence, n % 17 = 0 AS suspicious, n % 23 = 0 AS event_boundary,
           CASE WHEN n % 19 = 0 THEN 'REVIEW' ELSE 'PASS' END AS asr_quality
    FROM turns0)"""

QA = r"""
qa0 AS (
    SELECT *, trim(regexp_replace(text, '\s+', ' ', 'g')) AS v FROM turns),
qa1 AS (
    SELECT *, regexp_extract_all(v, '[A-Za-z]{2,}(?:[''-][A-Za-z]+)*|\d+') AS words FROM qa0),
annotated AS (
    SELECT *, suspicious AS bad,
           CASE WHEN v = '' OR lower(v) IN ('filtered', 'heart', 'underscore', 'subtitle', '[music]', '[applause]')
                  OR (len(words) >= 5 AND len(list_distinct(list_transform(words, lambda x: lower(x)))) = 1)
                  OR regexp_full_match(v, '[^\p{L}\p{N}]+')
                  OR (regexp_matches(v, '(https?://|www\.)\S+') AND len(words) <= 3)
                  OR length(regexp_replace(v, '[\p{L}\p{N}\s''".,?!:;()\-]', '', 'g'))::DOUBLE / greatest(length(v), 1) > 0.35
                  OR (len(words) = 0 AND NOT regexp_matches(v, '[\x{4e00}-\x{9fff}\x{3040}-\x{30ff}]'))
                THEN 'FAIL' ELSE 'PASS' END AS text_qa,
           greatest(0, coalesce(start_ms - lag(end_ms) OVER (PARTITION BY source_id ORDER BY idx), 0)) AS gap_ms
    FROM qa1)"""

ELIGIBLE = """CASE WHEN identity NOT IN ('TARGET_HIGH', 'TARGET_MEDIUM') THEN 'IDENTITY_INELIGIBLE'
     WHEN speaker_confidence < 0.70 THEN 'SPEAKER_CONFIDENCE_LOW' WHEN text_qa <> 'PASS' THEN 'TEXT_QA_FAIL'
     WHEN asr_quality = 'REVIEW' THEN 'ASR_REVIEW' WHEN bad THEN 'BAD_BOUNDARY' ELSE 'ELIGIBLE' END"""

CONTINUATION = r"""
cont AS (
    SELECT *, regexp_replace(split_part(lower(v), ' ', 1), '^[''".,!?;:]+|[''".,!?;:]+$', '', 'g') AS first_word,
           lag(speaker) OVER w AS p_speaker, lag(bad) OVER w AS p_bad, lag(event_boundary) OVER w AS p_event, lag(text_qa) OVER w AS p_qa, lag(v) OVER w AS p_v
    FROM annotated WINDOW w AS (PARTITION BY source_id ORDER BY idx)),
continued AS (
    SELECT *, CASE WHEN p_speaker IS NULL THEN 'SOURCE_START'
         WHEN p_speaker <> speaker OR identity NOT IN ('TARGET_HIGH', 'TARGET_MEDIUM') THEN 'SPLIT_NEW_SPEECH_ACT'
         WHEN p_bad OR bad OR p_event OR event_boundary THEN 'SPLIT_EVENT'
         WHEN p_qa <> 'PASS' OR text_qa <> 'PASS' OR asr_quality = 'REVIEW' THEN 'UNCLEAR'
         WHEN gap_ms > 1500 THEN 'SPLIT_HIDDEN_TRIGGER'
         WHEN regexp_matches(v, '^[a-z]') OR first_word IN ('and', 'or', 'because', 'which', 'that', 'to', 'then', 'than') OR NOT regexp_matches(p_v, '[.!?]\s*$') THEN 'MERGE_SYNTACTIC_CONTINUATION'
         WHEN gap_ms <= 550 AND len(string_split(p_v, ' ')) <= 8 THEN 'MERGE_TIGHT_FRAGMENT' ELSE 'SPLIT_NEW_SPEECH_ACT' END AS continuation
    FROM cont)"""

CONTEXT = """
lags AS (
    SELECT *,
""" + ",\n".join(
    f"coalesce(lag(identity, {k}) OVER w NOT IN ('TARGET_HIGH', 'TARGET_MEDIUM') AND NOT lag(bad, {k}) OVER w AND lag(text_qa, {k}) OVER w = 'PASS' AND lag(asr_quality, {k}) OVER w <> 'REVIEW', false) AS c{k}, "
    f"NOT coalesce(lag(event_boundary, {k}) OVER w, false) AS q{k}, coalesce(lag(gap_ms, {k}) OVER w <= 10000, false) AS g{k}, lag(turn_id, {k}) OVER w AS id{k}, lag(v, {k}) OVER w AS v{k}"
    for k in (1, 2, 3)
) + """
    FROM continued WINDOW w AS (PARTITION BY source_id ORDER BY idx)),
sized AS (
    SELECT *, CASE WHEN NOT c1 THEN 0 WHEN NOT (c2 AND q2 AND q1 AND g1) THEN 1 WHEN NOT (c3 AND q3 AND q2 AND g2) THEN 2 ELSE 3 END AS n_context
    FROM lags)"""


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.timeline(table(spark, sf_dir, "conversations"))


@query(f"WITH {TURNS}, {QA} SELECT turn_id, identity, start_ms, end_ms, text_qa, gap_ms::BIGINT AS gap_ms, {ELIGIBLE} AS eligibility FROM annotated")
def turn_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    noted = O.annotate(_turns(spark, sf_dir)).withColumn("eligibility", O.target_eligibility())
    return noted.select("turn_id", "identity", "start_ms", "end_ms", "text_qa", "gap_ms", "eligibility")


@query(f"""WITH {TURNS}, {QA}, {CONTINUATION}, {CONTEXT},
o AS (SELECT *, {ELIGIBLE} AS eligibility,
        coalesce(lead(identity, 1) OVER w IN ('TARGET_HIGH', 'TARGET_MEDIUM'), false) AS t1, coalesce(starts_with(lead(continuation, 1) OVER w, 'MERGE'), false) AS m1,
        coalesce(lead(identity, 2) OVER w IN ('TARGET_HIGH', 'TARGET_MEDIUM'), false) AS t2, coalesce(starts_with(lead(continuation, 2) OVER w, 'MERGE'), false) AS m2,
        coalesce(lead(identity, 3) OVER w IN ('TARGET_HIGH', 'TARGET_MEDIUM'), false) AS t3
      FROM sized WINDOW w AS (PARTITION BY source_id ORDER BY idx))
SELECT substr(sha256(source_id || '|' || turn_id || '|' || n_context), 1, 20) AS sample_id, source_id,
       CASE n_context WHEN 1 THEN id1 WHEN 2 THEN id2 || ',' || id1 ELSE id3 || ',' || id2 || ',' || id1 END AS context_turn_ids, turn_id AS target_turn_id,
       CASE n_context WHEN 1 THEN v1 WHEN 2 THEN v2 || chr(10) || v1 ELSE v3 || chr(10) || v2 || chr(10) || v1 END AS context_text, v AS response_text,
       n_context::BIGINT AS n_context, (t1::INT + (t1 AND m1 AND t2)::INT + (t1 AND m1 AND t2 AND m2 AND t3)::INT)::BIGINT AS offered, gap_ms::BIGINT AS gap_ms
FROM o WHERE eligibility = 'ELIGIBLE' AND n_context > 0 AND gap_ms <= 10000""")
def struct_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.seeds(_turns(spark, sf_dir))


@query(f"WITH {TURNS}, {QA}, {CONTINUATION}, {CONTEXT} SELECT turn_id, n_context::BIGINT AS n_context FROM sized")
def context_episode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.annotate(_turns(spark, sf_dir)).select("turn_id", O.context_size().cast("long").alias("n_context"))


@query(f"""WITH {TURNS}, {QA}, {CONTINUATION}, {CONTEXT}
SELECT turn_id, k::BIGINT AS size, CASE k WHEN 1 THEN id1 WHEN 2 THEN id2 || ',' || id1 ELSE id3 || ',' || id2 || ',' || id1 END AS suffix
FROM sized, generate_series(1, 3) AS g(k) WHERE k <= n_context""")
def context_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All contiguous context suffixes of every turn, shortest first."""
    noted = O.annotate(_turns(spark, sf_dir)).withColumn("n", O.context_size())
    ids = F.collect_list("turn_id").over(O.by_turn().rowsBetween(-3, -1))
    sized = noted.withColumn("ids", ids).where("n > 0").select("turn_id", "ids", F.explode(F.sequence(F.lit(1), "n")).alias("size"))
    return sized.select("turn_id", F.col("size").cast("long").alias("size"), F.array_join(F.slice("ids", -F.col("size"), F.col("size")), ",").alias("suffix"))


@query(f"WITH {TURNS}, {QA}, {CONTINUATION} SELECT continuation, count(*) AS n, max(gap_ms)::BIGINT AS longest_gap_ms FROM continued GROUP BY 1")
def continuation_offer(spark: SparkSession, sf_dir: str) -> DataFrame:
    noted = O.annotate(_turns(spark, sf_dir)).withColumn("continuation", O.continuation_reason())
    return noted.groupBy("continuation").agg(F.count("*").alias("n"), F.max("gap_ms").alias("longest_gap_ms"))


#: Natural turns of the events of a user; see natural_turns().
NATURAL_TURNS = r"""WITH s AS (
    SELECT user_id::VARCHAR AS source_id, event_id AS idx, event_type AS speaker, epoch_us(ts) // 1000 AS start_ms, epoch_us(ts) // 1000 + (value * 60000)::BIGINT AS end_ms, props AS text
    FROM events),
l AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY start_ms, idx) AS rn FROM s),
m AS (SELECT *, lag(speaker) OVER w AS ps, lag(start_ms) OVER w AS p0, lag(end_ms) OVER w AS p1, lag(text) OVER w AS pt FROM l WINDOW w AS (PARTITION BY source_id ORDER BY rn)),
r AS (SELECT *, CASE WHEN ps IS NULL THEN 'source_start' WHEN ps <> speaker THEN 'speaker_change' WHEN end_ms - p0 > 45000 * 1000 THEN 'length_limit'
        WHEN greatest(0, start_ms - p1) <= 800 * 1000 THEN 'asr_fragment_merge'
        WHEN greatest(0, start_ms - p1) <= 2500 * 1000 AND (NOT regexp_matches(pt, '([.!?…]|\[[^\]]*\])$') OR regexp_matches(lower(text), '^(and|but|or|so|because|then|which|that|to|of|a|the)\b')
             OR len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) <= 3) THEN 'same_speaker_adaptive_pause'
        ELSE 'pause_and_punctuation' END AS reason FROM m),
i AS (SELECT *, sum((reason NOT IN ('asr_fragment_merge', 'same_speaker_adaptive_pause'))::INT) OVER (PARTITION BY source_id ORDER BY rn) - 1 AS turn FROM r)
SELECT source_id, turn::BIGINT AS turn, count(*) AS segments, min(start_ms) AS start_ms, max(end_ms) AS end_ms, arg_min(speaker, rn) AS speaker,
       arg_min(reason, rn) AS turn_boundary, string_agg(text, ' ' ORDER BY rn) AS text
FROM i GROUP BY 1, 2"""


def event_segments(events: DataFrame) -> DataFrame:
    """Events of a user as segments of a source, which last value minutes; minutes stand for seconds."""
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(
        F.col("user_id").cast("string").alias("source_id"), F.col("event_type").alias("speaker"), start.alias("start_ms"),
        (start + F.round(F.col("value") * 60000).cast("long")).alias("end_ms"), F.col("props").alias("text"), "event_id",
    )


@query(NATURAL_TURNS)
def natural_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user as segments; minutes stand for seconds, so all limits are a thousand times longer."""
    rows = event_segments(table(spark, sf_dir, "events"))
    place = F.row_number().over(O.W.partitionBy("source_id").orderBy("start_ms", "event_id"))
    segments = rows.withColumn("idx", place.cast("long")).withColumn("reason", O.merge_reason(45_000_000, 800_000, 2_500_000))
    starts = ~F.col("reason").isin("asr_fragment_merge", "same_speaker_adaptive_pause")
    return O.islands(segments, starts).drop("first_idx")


_QUOTED = lambda words: ", ".join("'" + w.replace("'", "''") + "'" for w in words)


@query(f"""WITH {TURNS}, q AS (SELECT *, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS v FROM turns),
p AS (SELECT *, lag(v) OVER w AS ctx, list_filter([lead(text) OVER w, lead(text, 2) OVER w], lambda x: x IS NOT NULL) AS more, lag(idx, 2) OVER w IS NOT NULL AS extended FROM q WINDOW w AS (PARTITION BY source_id ORDER BY idx)),
f AS (SELECT *, list_transform(more, lambda x: struct_pack(t := trim(x), f := regexp_replace(split_part(lower(trim(x)), ' ', 1), '^[''".,!?;:]+|[''".,!?;:]+$', '', 'g'))) AS fs FROM p)
SELECT turn_id, array_to_string(list_sort(list_filter([
    CASE WHEN len(list_filter(fs, lambda x: x.f IN ({_QUOTED(T.INDEPENDENT_STARTERS)}))) > 0 THEN 'POSSIBLE_INDEPENDENT_SPEECH_ACT' END,
    CASE WHEN len(list_filter(fs, lambda x: x.f NOT IN ({_QUOTED(T.INDEPENDENT_STARTERS)}) AND (regexp_matches(x.t, '^[a-z]') OR x.f IN ('and', 'or', 'because', 'which', 'that', 'to', 'then', 'than', 'as', 'if', 'of', 'in', 'with')))) > 0 THEN 'POSSIBLE_GRAMMATICAL_CONTINUATION' END,
    CASE WHEN extended THEN 'CONTEXT_EXTENSION_AVAILABLE' END, CASE WHEN suspicious OR asr_quality = 'REVIEW' THEN 'TRANSCRIPT_OR_BOUNDARY_RISK' END,
    CASE WHEN regexp_matches(text[1], '^[a-z]') THEN 'LOWERCASE_RESPONSE_START' END,
    CASE WHEN NOT regexp_matches(lower(text), '{T.ACKNOWLEDGEMENT.replace("'", "''")}') THEN 'NO_ACKNOWLEDGEMENT_PATTERN' END,
    CASE WHEN NOT list_has_any(list_filter(regexp_extract_all(ctx, '[a-z]{{3,}}'), lambda x: x NOT IN ({_QUOTED(T.STOP_WORDS)})), regexp_extract_all(v, '[a-z]{{3,}}')) THEN 'NO_CONTENT_TOKEN_OVERLAP' END,
    CASE WHEN NOT regexp_matches(ctx, '{T.TRIGGER}') THEN 'NO_QUESTION_OR_EXPLICIT_TRIGGER_PATTERN' END], lambda x: x IS NOT NULL)), ',') AS flags
FROM f WHERE ctx IS NOT NULL""")
def risk_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = F.array_compact(F.array(*[F.lead("text", k).over(O.by_turn()) for k in (1, 2)]))
    turns = _turns(spark, sf_dir).withColumn("ctx", F.lag("text").over(O.by_turn())).withColumn("more", more)
    turns = turns.withColumn("extended", F.lag("idx", 2).over(O.by_turn()).isNotNull()).where("ctx is not null")
    doubtful = F.col("suspicious_transcription") | (F.col("asr_quality") == "REVIEW")
    flags = T.risk_flags(F.col("ctx"), F.col("text"), F.col("more"), F.col("extended"), doubtful)
    return turns.select("turn_id", F.array_join(flags, ",").alias("flags"))


@query(f"""WITH {TURNS}, q AS (SELECT *, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS v FROM turns),
c AS (SELECT *, (lag(speaker) OVER (PARTITION BY source_id ORDER BY idx) IS DISTINCT FROM speaker)::INT AS change FROM q WHERE v <> ''),
r AS (SELECT *, sum(change) OVER (PARTITION BY source_id ORDER BY idx) - 1 AS message FROM c)
SELECT source_id, message::BIGINT AS message, arg_min(speaker, idx) AS role, string_agg(v, chr(10) ORDER BY idx) AS content FROM r GROUP BY 1, 2""")
def merged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring turns of one role as one message, joined by line ends; blank turns are left out."""
    turns = _turns(spark, sf_dir).withColumn("v", T.collapse(F.col("text"))).where("v <> ''")
    change = ~F.col("speaker").eqNullSafe(F.lag("speaker").over(O.by_turn()))
    runs = turns.withColumn("message", F.sum(change.cast("long")).over(O.by_turn()) - 1)
    content = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "v"))), lambda x: x["v"]), "\n")
    return runs.groupBy("source_id", "message").agg(F.min_by("speaker", "idx").alias("role"), content.alias("content"))


@query(f"""WITH {TURNS}, r AS (SELECT *, CASE WHEN starts_with(lower(text), 'yes') OR starts_with(lower(text), 'no') OR starts_with(lower(text), 'why') OR starts_with(lower(text), 'that')
    OR starts_with(lower(text), 'it') OR starts_with(lower(text), 'he') OR starts_with(lower(text), 'she') OR starts_with(lower(text), 'because') OR starts_with(lower(text), 'yeah') THEN 'likely_context_dependent'
    WHEN len(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '')) <= 3 THEN 'possible_context_dependent' ELSE 'low_or_unknown' END AS dependency FROM turns)
SELECT dependency, speaker, count(*) AS n FROM r GROUP BY 1, 2""")
def context_dependency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir).groupBy(T.context_dependency(F.col("text")).alias("dependency"), "speaker").agg(F.count("*").alias("n"))


@query(f"""WITH {TURNS}, {QA},
w AS (SELECT *, lag(v) OVER (PARTITION BY source_id ORDER BY idx) AS pv FROM annotated)
SELECT turn_id, CASE WHEN pv IS NULL THEN 'REJECT' WHEN gap_ms > 10000 THEN 'REJECT' WHEN text_qa <> 'PASS' OR bad THEN 'REJECT' ELSE 'ACCEPT' END AS status,
       CASE WHEN pv IS NULL THEN 'UNCLEAR' WHEN gap_ms > 10000 THEN 'HIDDEN_TRIGGER_SUSPECTED' WHEN text_qa <> 'PASS' THEN 'ASR_GARBAGE' WHEN bad THEN 'UNCLEAR'
            WHEN regexp_matches(lower(pv), '{T.QUESTION}') THEN 'DIRECT_RESPONSE' ELSE 'VALID_CONTEXTUAL_RESPONSE' END AS label
FROM w WHERE identity = 'TARGET_HIGH'""")
def structural_judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule judge of each target turn against the turn before it."""
    noted = O.annotate(_turns(spark, sf_dir)).withColumn("pv", F.lag(T.collapse(F.col("text"))).over(O.by_turn())).where("identity = 'TARGET_HIGH'")
    reject = F.col("pv").isNull() | (F.col("gap_ms") > 10_000) | (F.col("text_qa") != "PASS") | F.col("bad")
    label = (
        F.when(F.col("pv").isNull(), "UNCLEAR").when(F.col("gap_ms") > 10_000, "HIDDEN_TRIGGER_SUSPECTED").when(F.col("text_qa") != "PASS", "ASR_GARBAGE")
        .when(F.col("bad"), "UNCLEAR").when(F.lower("pv").rlike(T.QUESTION), "DIRECT_RESPONSE")
        .otherwise("VALID_CONTEXTUAL_RESPONSE")
    )
    return noted.select("turn_id", F.when(reject, "REJECT").otherwise("ACCEPT").alias("status"), label.alias("label"))
