"""Turns of a conversation: timelines, merging, context episodes and continuations.

A turns table has source_id, idx (place in the source), start_ms and end_ms, speaker, identity, text and
the evidence columns that timeline() makes. Within a source everything is a window ordered by idx.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.functions.hashing import joined_id

TARGETS = ["TARGET_HIGH", "TARGET_MEDIUM"]
LEAST_SPEAKER_CONFIDENCE = 0.70
FLAGS = ("uncertain_transcription", "suspicious_transcription", "overlap", "malformed")
TERMINAL = r"([.!?…]|\[[^\]]*\])$"
FRAGMENT = r"^(and|but|or|so|because|then|which|that|to|of|a|the)\b"

def by_turn() -> WindowSpec:
    """Turns of a source in their order."""
    return W.partitionBy("source_id").orderBy("idx")


def timeline(conversations: DataFrame) -> DataFrame:
    """Turns from rows of (conv_id, turn, role, text), which have no clock of their own.

    A character takes 50 ms, and a pause of 100 ms for each unit of length modulo 40 follows a turn;
    confidence and flags are fixed functions of the length too.
    """
    n = F.length(F.coalesce("text", F.lit(""))).cast("long")
    span = n * 50 + (n % 40) * 100
    before = F.coalesce(F.sum(span).over(W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return conversations.select(
        F.col("conv_id").cast("string").alias("source_id"), F.col("turn").cast("long").alias("idx"),
        F.format_string("%s:turn:%06d", F.col("conv_id").cast("string"), F.col("turn")).alias("turn_id"),
        F.col("role").alias("speaker"),
        F.when(F.col("role") == "assistant", "TARGET_HIGH").when(F.col("role") == "user", "NON_TARGET").otherwise("UNKNOWN").alias("identity"),
        before.alias("start_ms"), (before + n * 50).alias("end_ms"), F.coalesce("text", F.lit("")).alias("text"),
        (0.6 + (n % 41) / 100).alias("speaker_confidence"), (n % 17 == 0).alias("suspicious_transcription"),
        (n % 23 == 0).alias("event_boundary"), F.when(n % 19 == 0, "REVIEW").otherwise("PASS").alias("asr_quality"),
    )


def with_identity(turns: DataFrame, mapping: DataFrame) -> DataFrame:
    """turns with the identity that mapping (source_id, cluster, identity) gives their speaker, else UNKNOWN."""
    known = mapping.groupBy("source_id", F.col("cluster").alias("speaker")).agg(F.min("identity").alias("_identity"))
    joined = turns.drop("identity").join(known, ["source_id", "speaker"], "left")
    return joined.withColumn("identity", F.coalesce("_identity", F.lit("UNKNOWN"))).drop("_identity")


def bad_boundary(turns: DataFrame) -> Column:
    """Whether any of the flag columns that the table has is true; a null is not."""
    present = [F.coalesce(F.col(c), F.lit(False)) for c in (*FLAGS, "bad_boundary") if c in turns.columns]
    return reduce(lambda a, b: a | b, present, F.lit(False))


def annotate(turns: DataFrame) -> DataFrame:
    """turns with text_qa, bad and gap_ms (time since the previous turn, 0 at the start and never negative)."""
    gap = F.greatest(F.lit(0), F.coalesce(F.col("start_ms") - F.lag("end_ms").over(by_turn()), F.lit(0)))
    return turns.withColumn("text_qa", T.text_qa(F.col("text"))).withColumn("bad", bad_boundary(turns)).withColumn("gap_ms", gap)


def target_eligibility(continuation: bool = False, speaker: Column | None = None) -> Column:
    """The first reason why an annotated turn cannot be a target, or ELIGIBLE."""
    out = F.when(~F.col("identity").isin(TARGETS), "IDENTITY_INELIGIBLE")
    if speaker is not None:
        out = out.when(~F.col("speaker").eqNullSafe(speaker), "SPEAKER_MISMATCH")
    out = (
        out.when(F.coalesce("speaker_confidence", F.lit(0.0)) < LEAST_SPEAKER_CONFIDENCE, "SPEAKER_CONFIDENCE_LOW")
        .when(F.col("text_qa") != "PASS", "TEXT_QA_FAIL")
        .when(F.col("asr_quality") == "REVIEW", "ASR_REVIEW")
        .when(F.col("bad"), "BAD_BOUNDARY")
    )
    if continuation:
        out = out.when(F.coalesce("event_boundary", F.lit(False)), "EVENT_BOUNDARY")
    return out.otherwise("ELIGIBLE")


def context_size(most: int = 3, max_gap_ms: int = 10_000) -> Column:
    """How many turns before an annotated turn form its context, from the nearest backward, at most most.

    A turn joins while it is no target, clean and fit, and neither an event nor a gap of more than
    max_gap_ms stands between it and the turn after it; those two are not asked of the nearest turn.
    """
    clean = lambda k: (
        F.coalesce(~F.lag("identity", k).over(by_turn()).isin(TARGETS), F.lit(False))
        & ~F.coalesce(F.lag("bad", k).over(by_turn()), F.lit(True))
        & F.coalesce(F.lag("text_qa", k).over(by_turn()) == "PASS", F.lit(False))
        & F.coalesce(F.lag("asr_quality", k).over(by_turn()) != "REVIEW", F.lit(False))
    )
    quiet = lambda k: ~F.coalesce(F.lag("event_boundary", k).over(by_turn()), F.lit(False))
    holds, size = clean(1), F.lit(0)
    for k in range(1, most + 1):
        if k > 1:
            near = F.coalesce(F.lag("gap_ms", k - 1).over(by_turn()) <= max_gap_ms, F.lit(False))
            holds = holds & clean(k) & quiet(k) & quiet(k - 1) & near
        size = size + holds.cast("int")
    return size


def continuation_reason(max_gap_ms: int = 1_500) -> Column:
    """Why an annotated turn continues the one before it (MERGE_...) or does not (SPLIT_..., UNCLEAR)."""
    before = lambda c: F.lag(c).over(by_turn())
    previous, current = T.collapse(before("text")), T.collapse(F.col("text"))
    first = T.first_word(F.col("text"))
    event = F.coalesce(before("event_boundary"), F.lit(False)) | F.coalesce("event_boundary", F.lit(False))
    unfinished = current.rlike("^[a-z]") | first.isin(T.CONTINUATION_STARTERS) | ~previous.rlike(r"[.!?]\s*$")
    return (
        F.when(before("speaker").isNull(), "SOURCE_START")
        .when((before("speaker") != F.col("speaker")) | ~F.col("identity").isin(TARGETS), "SPLIT_NEW_SPEECH_ACT")
        .when(before("bad") | F.col("bad") | event, "SPLIT_EVENT")
        .when((before("text_qa") != "PASS") | (F.col("text_qa") != "PASS") | (F.col("asr_quality") == "REVIEW"), "UNCLEAR")
        .when(F.col("gap_ms") > max_gap_ms, "SPLIT_HIDDEN_TRIGGER")
        .when(unfinished, "MERGE_SYNTACTIC_CONTINUATION")
        .when((F.col("gap_ms") <= 550) & (F.size(F.split(previous, " ")) <= 8), "MERGE_TIGHT_FRAGMENT")
        .otherwise("SPLIT_NEW_SPEECH_ACT")
    )


def offered_continuations(most: int = 3) -> Column:
    """How many following turns are offered as continuations: targets, up to and with the first that cannot merge.

    Needs a column continuation with continuation_reason().
    """
    holds, offered = F.lit(True), F.lit(0)
    for k in range(1, most + 1):
        holds = holds & F.coalesce(F.lead("identity", k).over(by_turn()).isin(TARGETS), F.lit(False))
        offered = offered + holds.cast("int")
        holds = holds & F.coalesce(F.lead("continuation", k).over(by_turn()).startswith("MERGE"), F.lit(False))
    return offered


def seeds(turns: DataFrame, max_context: int = 3, max_gap_ms: int = 10_000, trigger_gap_ms: int = 10_000) -> DataFrame:
    """Context and response candidates: one row for each eligible target turn that has a context.

    The response is the seed turn alone; following turns are offered, not merged.
    """
    noted = annotate(turns).withColumn("continuation", continuation_reason())
    sized = (
        noted.withColumn("n_context", context_size(max_context, max_gap_ms))
        .withColumn("offered", offered_continuations())
        .withColumn("eligibility", target_eligibility())
        .withColumn("before", F.collect_list(F.struct("idx", "turn_id", "text")).over(by_turn().rowsBetween(-max_context, -1)))
    )
    kept = sized.where((F.col("eligibility") == "ELIGIBLE") & (F.col("n_context") > 0) & (F.col("gap_ms") <= trigger_gap_ms))
    context = F.slice("before", -F.col("n_context"), F.col("n_context"))
    return kept.select(
        joined_id(F.col("source_id"), F.col("turn_id"), F.col("n_context")).alias("sample_id"), "source_id",
        F.array_join(F.transform(context, lambda c: c["turn_id"]), ",").alias("context_turn_ids"), F.col("turn_id").alias("target_turn_id"),
        F.array_join(F.transform(context, lambda c: T.collapse(c["text"])), "\n").alias("context_text"), T.collapse(F.col("text")).alias("response_text"),
        F.col("n_context").cast("long").alias("n_context"), F.col("offered").cast("long").alias("offered"), "gap_ms",
    )


def ends_sentence(text: Column) -> Column:
    return text.rlike(TERMINAL)


def is_fragment(text: Column) -> Column:
    """Whether a text begins like the rest of a sentence, or has at most three words."""
    return F.lower(text).rlike(FRAGMENT) | (F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")) <= 3)


def merge_reason(max_ms: int = 45_000, tight_ms: int = 800, pause_ms: int = 2_500) -> Column:
    """Why a segment joins the one before it, seen from their times and texts alone."""
    before = lambda c: F.lag(c).over(by_turn())
    gap = F.greatest(F.lit(0), F.col("start_ms") - before("end_ms"))
    fragment = is_fragment(F.col("text"))
    return (
        F.when(before("speaker").isNull(), "source_start")
        .when(before("speaker") != F.col("speaker"), "speaker_change")
        .when(F.col("end_ms") - before("start_ms") > max_ms, "length_limit")
        .when(gap <= tight_ms, "asr_fragment_merge")
        .when((gap <= pause_ms) & (~ends_sentence(before("text")) | fragment), "same_speaker_adaptive_pause")
        .otherwise("pause_and_punctuation")
    )


def islands(segments: DataFrame, starts: Column) -> DataFrame:
    """One row a run of segments; starts marks the first of each run."""
    numbered = segments.withColumn("turn", F.sum(starts.cast("long")).over(by_turn()) - 1)
    return numbered.groupBy("source_id", "turn").agg(
        F.min("idx").alias("first_idx"), F.count("*").alias("segments"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"),
        F.min_by("speaker", "idx").alias("speaker"), F.min_by("reason", "idx").alias("turn_boundary"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda x: x["text"]), " ").alias("text"),
    )


def natural_turns(segments: DataFrame) -> DataFrame:
    """Segments of one speaker merged into turns: runs by merge_reason(), which ends them at 45 seconds."""
    marked = segments.withColumn("reason", merge_reason())
    return islands(marked, ~F.col("reason").isin("asr_fragment_merge", "same_speaker_adaptive_pause"))


# Fixed value: texts that are no speech to learn a voice from.
NO_SPEECH = r"(?i)\[\s*(?:music|applause|laughter)\s*\]|<[^>]+>|seekiframe|javascript:"


def is_reference_text(text: Column) -> Column:
    """Whether a text is speech of two words or more that does not only repeat itself: of 20 letters, digits and spaces on, more than three different words."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("([A-Za-z0-9']+)"), 1)
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9 ]", "")
    different = F.size(F.array_distinct(F.filter(F.split(bare, r"\s+"), lambda w: w != "")))
    return ~F.coalesce(text, F.lit("")).rlike(NO_SPEECH) & (F.size(words) >= 2) & ~((F.length(bare) >= 20) & (different <= 3))


def growing_windows(turns: DataFrame, cluster: str = "speaker", least_confidence: float = 0.78, pause_ms: int = 2_500, most_ms: int = 45_000, shortest_ms: int = 15_000, longest_ms: int = 60_000) -> DataFrame:
    """(source_id, turn_id, start_ms, end_ms, segments, confidence): from each usable turn on the stretch of its cluster that grows until it would last longer than most_ms.

    Usable turns are of least_confidence and is_reference_text(); they follow one another by start and idx, whatever lies between them. A stretch ends before a turn of another cluster, after a
    pause of more than pause_ms, and before the first turn that would make it too long. Only stretches of two turns or more that last from shortest_ms to longest_ms remain.
    """
    order = W.partitionBy("source_id").orderBy("start_ms", "idx")
    usable = turns.where((F.col("speaker_confidence") >= least_confidence) & is_reference_text(F.col("text")))
    gap = F.col("start_ms") - F.lag("end_ms").over(order)
    fresh = ~F.col(cluster).eqNullSafe(F.lag(cluster).over(order)) | F.coalesce(gap > pause_ms, F.lit(False))
    runs = usable.withColumn("_new", fresh).withColumns({"_run": F.sum(F.col("_new").cast("int")).over(order), "_at": F.row_number().over(order)})
    # What starts later than most_ms after the first turn ends later too, so the frame holds all that can belong to a stretch.
    frame = W.partitionBy("source_id", "_run").orderBy("start_ms").rangeBetween(0, most_ms)
    own = F.filter(F.array_sort(F.collect_list(F.struct(F.col("_at").alias("at"), F.col("end_ms").alias("e"), F.col("speaker_confidence").alias("c"))).over(frame)), lambda x: x["at"] >= F.col("_at"))
    held = runs.withColumn("_rows", own)
    past = F.array_position(F.transform("_rows", lambda x: (x["e"] - F.col("start_ms") > most_ms) & (x["at"] > F.col("_at"))), True)
    held = held.withColumn("_rows", F.when(past > 0, F.slice("_rows", F.lit(1), past.cast("int") - 1)).otherwise(F.col("_rows"))).withColumn("_end", F.element_at("_rows", -1)["e"])
    lasts = F.col("_end") - F.col("start_ms")
    mean = F.aggregate("_rows", F.lit(0.0), lambda s, x: s + x["c"]) / F.size("_rows")
    kept = held.where((F.size("_rows") >= 2) & lasts.between(shortest_ms, longest_ms))
    return kept.select("source_id", "turn_id", "start_ms", F.col("_end").alias("end_ms"), F.size("_rows").cast("long").alias("segments"), F.round(mean, 4).alias("confidence"))
