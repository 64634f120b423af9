"""State machines over evidence: ordered rules, the first that holds decides.

A rule table is a list of (condition, state, reason). Unknown or conflicting evidence ends in a state
that says so, never in a forced label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The vocabulary of judgements.
RELATIONS = ["DIRECT_RESPONSE", "CONTEXTUAL_RESPONSE", "GAME_STATE_RESPONSE", "SELF_CONTINUATION", "HIDDEN_TRIGGER_SUSPECTED", "WRONG_CONTEXT", "UNCLEAR"]
ACCEPTED_RELATIONS = ["DIRECT_RESPONSE", "CONTEXTUAL_RESPONSE", "GAME_STATE_RESPONSE"]
EPISODES = ["KEEP_CURRENT", "MERGE_CONTINUATION", "SPLIT_HIDDEN_TRIGGER", "SPLIT_NEW_SPEECH_ACT", "SPLIT_EVENT_BOUNDARY", "UNCLEAR"]
ACCEPTED_EPISODES = ["KEEP_CURRENT", "MERGE_CONTINUATION"]
LEAST_CONFIDENCE = 0.75


def first_rule(rules: list[tuple[Column, str, str]], state: str, reason: str) -> Column:
    """struct(state, reason) of the first rule that holds, else of the default; an unknown condition does not hold."""
    out = None
    for condition, s, r in rules:
        value = F.struct(F.lit(s).alias("state"), F.lit(r).alias("reason"))
        holds = F.coalesce(condition, F.lit(False))
        out = F.when(holds, value) if out is None else out.when(holds, value)
    default = F.struct(F.lit(state).alias("state"), F.lit(reason).alias("reason"))
    return default if out is None else out.otherwise(default)


def judgement_valid(relation: Column, episode: Column, confidence: Column, bounded: Column) -> Column:
    """Whether a judgement keeps to the vocabulary, to 0..1 and to the turns that it was offered."""
    return F.coalesce(relation.isin(RELATIONS) & episode.isin(EPISODES) & confidence.between(0.0, 1.0) & bounded, F.lit(False))


def judgement_accepted(valid: Column, relation: Column, episode: Column, confidence: Column, complete: Column) -> Column:
    good = relation.isin(ACCEPTED_RELATIONS) & episode.isin(ACCEPTED_EPISODES) & (confidence >= LEAST_CONFIDENCE) & complete
    return valid & F.coalesce(good, F.lit(False))


def explicit_reject(valid: Column, relation: Column, confidence: Column) -> Column:
    return valid & F.coalesce(relation.isin("HIDDEN_TRIGGER_SUSPECTED", "WRONG_CONTEXT") & (confidence >= LEAST_CONFIDENCE), F.lit(False))


def resolve_passes(primary: str, strict: str, adjudication: str, quarantined: Column | None = None) -> Column:
    """struct(state, reason) from struct columns with relation, episode, confidence, valid and accepted; a missing pass is null."""
    p, s, a = F.col(primary), F.col(strict), F.col(adjudication)
    reject = lambda x: explicit_reject(x["valid"], x["relation"], x["confidence"])
    same = (p["relation"] == s["relation"]) & (p["episode"] == s["episode"])
    rules = [] if quarantined is None else [(quarantined, "TERMINAL_INVALID_QUARANTINED", "INVALID_TERMINAL_QUARANTINED")]
    rules += [
        (p.isNull(), "PENDING_PRIMARY", "PRIMARY_MISSING"),
        (~p["valid"], "MISSING_INVALID_EVIDENCE", "PRIMARY_INVALID"),
        (reject(p) & s.isNull(), "REJECTED", "PRIMARY_EXPLICIT_OBSERVABILITY_REJECT"),
        (~p["accepted"] & s.isNull(), "AMBIGUOUS", "PRIMARY_NON_ACCEPT_UNRESOLVED"),
        (s.isNull(), "PENDING_STRICT", "SECOND_SEMANTIC_VERIFICATION_REQUIRED"),
        (~s["valid"], "MISSING_INVALID_EVIDENCE", "STRICT_INVALID"),
        (p["accepted"] & s["accepted"] & same, "VERIFIED", "SEMANTIC_PASSES_AGREE"),
        (~p["accepted"] & ~s["accepted"] & reject(p) & reject(s) & (p["relation"] == s["relation"]), "REJECTED", "SEMANTIC_PASSES_AGREE_REJECT"),
        (~p["accepted"] & ~s["accepted"], "AMBIGUOUS", "SEMANTIC_PASSES_NON_ACCEPT"),
        (a.isNull(), "JUDGE_CONFLICT", "PRIMARY_STRICT_DISAGREEMENT"),
        (~a["valid"], "MISSING_INVALID_EVIDENCE", "ADJUDICATION_INVALID"),
        (a["accepted"], "VERIFIED", "CONFLICT_ADJUDICATED_ACCEPT"),
        (reject(a), "REJECTED", "CONFLICT_ADJUDICATED_REJECT"),
    ]
    return first_rule(rules, "AMBIGUOUS", "CONFLICT_ADJUDICATED_UNCLEAR")


def route(forced: Column, background: Column, ambiguous: Column, overlap: Column, speakers: Column, target_active: Column) -> Column:
    """Where a window goes, strongest reason first; overlap is marked speech of several, speakers those that speak at one time, marked or not."""
    return (
        F.when(forced, "FORCED").when(background, "BACKGROUND_SPEECH").when(ambiguous, "SPEAKER_AMBIGUITY")
        .when(overlap & target_active, "TARGET_OVERLAP").when((speakers > 1) & target_active, "MULTI_SPEAKER_TARGET").otherwise("CLEAN")
    )


def fuse_identity(
    current: Column, margin: Column, cross_margin: Column, second: Column, explicit_target: Column, explicit_other: Column, named_guest: Column,
    style: Column, rejected: Column, quarantined: Column, guest: Column,
) -> Column:
    """struct(state, reason): identity from acoustic margins, a second model, metadata and style.

    cross_margin is the margin by other features: null, or it must not speak against. Metadata and style only
    strengthen what two independent models agree on; they never promote alone.
    """
    audio = (current == "TARGET") & (margin >= 0.135) & F.coalesce(cross_margin >= 0, F.lit(True))
    audio_other = (current == "OTHER") & (margin <= -0.135) & F.coalesce(cross_margin <= 0, F.lit(True))
    return first_rule(
        [
            (rejected, "NON_TARGET_TTS", "synthetic_voice"),
            (quarantined, "UNKNOWN", "synthetic_voice_suspected"),
            (guest, "NON_TARGET_GUEST", "recurring_guest"),
            (second == "GUEST", "NON_TARGET_GUEST", "second_model_guest"),
            (second == "OTHER", "NON_TARGET_KNOWN", "second_model_other"),
            (audio & (second == "TARGET") & explicit_target & named_guest, "UNKNOWN", "ambiguous_participants"),
            (audio & (second == "TARGET") & explicit_target & ~explicit_other & (style >= 0.6), "TARGET_HIGH", "models_metadata_and_style"),
            (audio & (second == "TARGET") & ~explicit_other, "TARGET_MEDIUM", "models_agree"),
            (audio & (second != "TARGET"), "UNKNOWN", "models_disagree"),
            (audio_other & explicit_other, "NON_TARGET_KNOWN", "model_and_metadata"),
            ((current == "OTHER") & explicit_other, "NON_TARGET_KNOWN", "weak_margin_and_metadata"),
        ],
        "UNKNOWN",
        "insufficient_evidence",
    )


def gates(**passed: Column) -> list[Column]:
    """PASS, FAIL or NOT_CHECKED (unknown) for each condition over aggregates."""
    return [F.when(c.isNull(), "NOT_CHECKED").when(c, "PASS").otherwise("FAIL").alias(name) for name, c in passed.items()]


def missing_fields(rows: DataFrame, fields: list[str]) -> Column:
    """Names of the fields of rows that a row must have and has not, in their order: null, an empty text or an empty array or map is missing."""

    def missing(name: str) -> Column:
        kind = rows.schema[name].dataType.typeName()
        empty = F.col(name) == "" if kind in ("string", "char", "varchar") else F.size(name) == 0 if kind in ("array", "map") else F.lit(False)
        return F.when(F.col(name).isNull() | empty, name)

    return F.array_compact(F.array(*map(missing, fields)))


def require_fields(rows: DataFrame, fields: list[str]) -> DataFrame:
    """rows, if no row lacks any of the fields; else the query that reads them fails and names what is missing."""
    lacking = missing_fields(rows, fields)
    message = F.concat(F.lit("missing required fields: "), F.array_join(lacking, ", "))
    return rows.where(F.when(F.size(lacking) == 0, True).otherwise(F.raise_error(message).cast("boolean")))
