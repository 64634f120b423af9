"""Recovery of turns from a second transcript: who speaks, what the old and the new text agree on, and which samples to keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators.dedup import contained_runs
from colloquy.session import Scratch

# Names of states and reasons, identities and first words that results depend on.
TARGET, OTHER, AMBIGUOUS = "CONFIRMED_TARGET", "CONFIRMED_NON_TARGET", "AMBIGUOUS_SPEAKER"
TARGET_IDENTITIES = ["TARGET_HIGH", "TARGET_MEDIUM"]
UNSETTLED_IDENTITIES = ["", "UNKNOWN", "AMBIGUOUS"]
ANSWER_STARTERS = ["it", "they", "that", "this", "yes", "no", "sure", "probably", "maybe"]


def _state(*parts: tuple[str, str]) -> Column:
    return F.struct(*[F.lit(v).alias(k) for k, v in parts])


def _spoken(state: str, basis: str) -> Column:
    role = {TARGET: F.lit("assistant"), OTHER: F.lit("user")}.get(state, F.lit(None).cast("string"))
    return F.struct(F.lit(state).alias("speaker_state"), role.alias("role"), F.lit(basis).alias("basis"))


def speaker_state(identity: Column, baseline_role: Column, frozen_role: Column) -> Column:
    """(speaker_state, role, basis): a settled identity counts first, then the role of the baseline, then a frozen user role."""
    label = F.upper(F.coalesce(identity, F.lit("")))
    return (
        F.when(label.isin(TARGET_IDENTITIES), _spoken(TARGET, "FROZEN_IDENTITY_AUTHORITY"))
        .when(~label.isin(UNSETTLED_IDENTITIES), _spoken(OTHER, "FROZEN_IDENTITY_AUTHORITY"))
        .when(baseline_role == "assistant", _spoken(TARGET, "BASELINE_MATERIALIZED_ROLE_MONOTONICITY"))
        .when(baseline_role == "user", _spoken(OTHER, "BASELINE_MATERIALIZED_ROLE_MONOTONICITY"))
        .when(frozen_role == "user", _spoken(OTHER, "FROZEN_SEMANTIC_CONTEXT_ROLE"))
        .otherwise(_spoken(AMBIGUOUS, "INSUFFICIENT_IDENTITY_EVIDENCE"))
    )


def anchored_speakers(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """(id, speaker_state, role, basis) of rows (id, keys): all cluster keys must have an anchor (key, speaker_state, basis), and all the same settled state.

    A row without keys stays ambiguous; the basis tells keys without an anchor, or anchors of several states, from anchors that settle nothing. An anchor
    with a null state is there but settles nothing. Of an anchor's repeated keys the least state counts.
    """
    known = anchors.groupBy("key").agg(F.min(F.struct("speaker_state", "basis")).alias("anchor"))
    each = rows.select("id", F.posexplode_outer("keys").alias("_at", "key")).join(known, "key", "left")
    state = F.coalesce("anchor.speaker_state", F.lit(""))
    seen = each.groupBy("id").agg(
        F.count("key").alias("keys"), F.count("anchor").alias("met"), F.count_distinct(F.when(F.col("key").isNotNull(), state)).alias("states"),
        F.min("anchor.speaker_state").alias("state"), F.min_by("anchor.basis", "_at").alias("basis"), F.count_if(state.isin(TARGET, OTHER)).alias("settled"),
    )
    agreed = (F.col("keys") > 0) & (F.col("settled") == F.col("keys")) & (F.col("states") == 1)
    conflict = (F.col("states") > 1) | (F.col("met") < F.col("keys"))
    basis = (
        F.when(agreed, F.col("basis")).when(conflict, "CONFLICTING_WINDOW_LOCAL_CLUSTER_ANCHORS")
        .when(F.col("keys") > 0, "INSUFFICIENT_WINDOW_LOCAL_CLUSTER_ANCHORS").otherwise("INSUFFICIENT_IDENTITY_EVIDENCE")
    )
    role = F.when(agreed, F.when(F.col("state") == TARGET, "assistant").otherwise("user"))
    return seen.select("id", F.when(agreed, F.col("state")).otherwise(AMBIGUOUS).alias("speaker_state"), role.alias("role"), basis.alias("basis"))


def context_sufficiency(context: Column, text: Column, start: Column, most_gap: float = 8.0) -> Column:
    """(state, relation, reason, trigger_id) of a target with its context, an array of (id, role, state, text, end), oldest first.

    Only turns of a settled speaker that are no sentinel are visible. Nearness alone is never enough: the last
    user turn must be answered, by few words, a word that answers start with, or a shared word. Times are seconds, a gap counts in whole
    microseconds, so that noise in the difference makes no gap longer.
    """
    sound = lambda x: (x["state"] != AMBIGUOUS) & ~T.is_sentinel(x["text"])
    visible = F.filter(context, sound)
    users = F.filter(visible, lambda x: x["role"] == "user")
    last_user = F.element_at(users, -1)
    words = T.tokens(text)
    answers = (
        (F.size(words) <= 4) | F.get(words, F.lit(0)).isin(ANSWER_STARTERS)
        | (F.size(F.array_intersect(T.tokens(last_user["text"]), words)) > 0)
    )

    def out(state: str, relation: str, reason: str, trigger: Column | None = None) -> Column:
        named = _state(("state", f"CONTEXT_{state}"), ("relation", relation), ("reason", reason))
        return F.struct(*[named[k].alias(k) for k in ("state", "relation", "reason")], (F.lit(None).cast("string") if trigger is None else trigger).alias("trigger_id"))

    return (
        F.when(T.collapse(text) == "", out("INSUFFICIENT", "MISSING_IMMEDIATE_TRIGGER", "TARGET_TEXT_MISSING"))
        .when(F.size(visible) == 0, out("INSUFFICIENT", "MISSING_IMMEDIATE_TRIGGER", "NO_VISIBLE_CONTEXT"))
        .when(F.size(users) == 0, out("AMBIGUOUS", "CONTEXT_RESPONDS_TO_TARGET", "NO_CONFIRMED_NON_TARGET_CONTEXT"))
        .when(F.round(start - F.element_at(visible, -1)["end"], 6) > most_gap, out("AMBIGUOUS", "MISSING_IMMEDIATE_TRIGGER", "LARGE_PRE_TARGET_GAP"))
        .when(answers, out("SUFFICIENT", "TARGET_RESPONDS_TO_CONTEXT", "VISIBLE_IMMEDIATE_USER_TRIGGER", last_user["id"]))
        .otherwise(out("AMBIGUOUS", "MISSING_IMMEDIATE_TRIGGER", "MISSING_IMMEDIATE_TRIGGER"))
    )


def minimal_suffix(context: Column, text: Column, start: Column, most: int = 3) -> Column:
    """(size, state, reason): the shortest suffix of the context, of at most most turns, that suffices with its trigger inside; else all of it."""
    judged = [context_sufficiency(F.slice(context, F.greatest(F.size(context) - k + 1, F.lit(1)), F.lit(k)), text, start) for k in range(1, most + 1)]
    out = F.lit(None)
    for k, judge in reversed(list(enumerate(judged, 1))):
        suffix = F.slice(context, F.greatest(F.size(context) - k + 1, F.lit(1)), F.lit(k))
        inside = F.array_contains(F.transform(suffix, lambda x: x["id"]), judge["trigger_id"])
        there = (F.size(context) >= k) & (judge["state"] == "CONTEXT_SUFFICIENT") & inside
        here = F.struct(F.lit(k).alias("size"), judge["state"].alias("state"), judge["reason"].alias("reason"))
        whole = F.struct(F.least(F.size(context), F.lit(most)).alias("size"), judged[-1]["state"].alias("state"), judged[-1]["reason"].alias("reason"))
        out = F.when(there, here).otherwise(whole if k == most else out)
    return out


def text_similarity(a: Column, b: Column, sequence: Column) -> Column:
    """The larger of a sequence ratio and the token sets' overlap; two texts without tokens are equal, one without is unlike any other."""
    x, y = T.tokens(a), T.tokens(b)
    empty = (F.size(x) == 0).cast("int") + (F.size(y) == 0).cast("int")
    return F.when(empty == 2, 1.0).when(empty == 1, 0.0).otherwise(F.greatest(sequence, T.jaccard(F.array_distinct(x), F.array_distinct(y))))


def reconcile_turn(old: Column, new: Column, similarity: Column, frozen: Column) -> Column:
    """(state, reason, authority, confidence): what a turn's old text and the tokens newly given to it say together; frozen targets are never extended."""
    a, b = T.tokens(old), T.tokens(new)
    extra = (F.size(b) - F.size(a)) / F.greatest(F.lit(1), F.size(a))

    def out(state: str, reason: str, authority: str, confidence: Column) -> Column:
        named = _state(("state", state), ("reason", reason), ("authority", authority))
        return F.struct(*[named[k].alias(k) for k in ("state", "reason", "authority")], F.round(confidence, 6).alias("confidence"))

    old_text = "OLD_TRANSCRIPT"
    longer = T.contains_run(b, a) & (F.size(b) > F.size(a))
    return (
        F.when(F.size(b) == 0, out("MATCH_EXISTING", "NO_ATTRIBUTED_NEW_TOKENS_OLD_EVIDENCE_RETAINED", old_text, F.lit(0.55)))
        .when((a == b) | (similarity >= 0.88), out("MATCH_EXISTING", "NORMALIZED_OR_FUZZY_OLD_NEW_MATCH", old_text, F.greatest(F.lit(0.88), similarity)))
        .when(longer & ~frozen & (extra <= 0.5), out("EXTEND_EXISTING", "AUDIO_RECOVERS_BOUNDED_PREFIX_OR_SUFFIX", "RECONCILED_TEXT", F.greatest(F.lit(0.75), similarity)))
        .when(longer, out("AMBIGUOUS", "TARGET_OR_LARGE_EXTENSION_REQUIRES_LOCAL_VERIFICATION", old_text, similarity))
        .when(T.contains_run(a, b) & (similarity >= 0.55), out("MATCH_EXISTING", "NEW_ASR_MINOR_OMISSION_OLD_TEXT_RETAINED", old_text, F.greatest(F.lit(0.7), similarity)))
        .otherwise(out("AMBIGUOUS", "MAJOR_OR_UNCLASSIFIED_OLD_NEW_DISAGREEMENT", old_text, similarity))
    )


def reconcile_span(olds: Column, echo: Column, one: Column, similarity: Column) -> Column:
    """The state of a span that overlaps olds old turns: new, an echo of the turn before, the one turn's own state, or one that covers several."""
    return (
        F.when((olds == 0) & echo, "BOUNDARY_ECHO").when(olds == 0, "TRUE_NEW").when(olds == 1, one)
        .when(similarity >= 0.6, "MERGE_EXISTING").otherwise("AMBIGUOUS_BOUNDARY")
    )


def resolve_target(old: Column, new: Column, similarity: Column, aligned: Column, identified: Column, doubtful_boundary: Column, aligned_tokens: Column) -> Column:
    """(state, reason, contradicts): whether new audio evidence confirms a frozen target text; only substantial evidence may contradict it."""
    substantial = aligned_tokens >= F.greatest(F.lit(3), F.least(F.lit(8), F.floor(F.size(T.tokens(old)) * 0.4)))
    bare_old, bare_new = T.collapse(old), T.collapse(new)

    def out(state: str, reason: str, contradicts: bool = False) -> Column:
        return F.struct(F.lit(state).alias("state"), F.lit(reason).alias("reason"), F.lit(contradicts).alias("contradicts"))

    return (
        F.when(T.is_sentinel(old), out("UNRESOLVED", "NON_CONVERSATIONAL_SENTINEL_TARGET", True))
        .when((bare_old == "") | ~identified, out("UNRESOLVED", "FROZEN_TARGET_TEXT_OR_IDENTITY_AUTHORITY_MISSING", True))
        .when(doubtful_boundary, out("LOCAL_REASR_REQUIRED", "TARGET_BOUNDARY_AMBIGUOUS"))
        .when(~aligned | (bare_new == ""), out("BASELINE_CONFIRMED", "VERIFIED_TARGET_RETAINED_WITHOUT_NEW_AUDIO_CONFIRMATION"))
        .when(similarity >= 0.86, out("AUDIO_CONFIRMED", "TOKEN_ALIGNED_AUDIO_MATCH"))
        .when(similarity >= 0.55, out("AUDIO_MINOR_DISAGREEMENT", "MINOR_AUDIO_TEXT_DISAGREEMENT_FROZEN_TEXT_RETAINED"))
        .when(~substantial, out("AUDIO_UNAVAILABLE", "INSUFFICIENT_ALIGNED_TOKENS_FOR_CONTRADICTION"))
        .otherwise(out("AUDIO_MAJOR_CONTRADICTION", "TOKEN_ALIGNED_AUDIO_MAJOR_CONTRADICTION", True))
    )


def recovery_dedup(rows: DataFrame) -> DataFrame:
    """(id, reason, kept_id) of rows (id, baseline, target, interaction, grp, tokens), baseline rows first, then by id; reason is null for kept rows.

    A row goes for the first of these that a kept row before it has in common with it: the target (TARGET_REUSE), the interaction, unless
    it is null (SAME_INTERACTION_DUPLICATE), or, in one group, tokens of which one's stand in the other's (PREFIX_LADDER; rows of
    equal tokens don't count). Ids are unique.

    The order is settled in rounds of joins: a row is kept once no undecided or kept row before it conflicts, and goes once a kept one does.
    """
    scratch = Scratch(rows.sparkSession, "recovery-dedup")
    place = F.struct((~F.coalesce("baseline", F.lit(False))).cast("int").alias("late"), F.col("id"))
    base = scratch.save(rows.select("id", place.alias("o"), "target", "interaction", "grp", "tokens"))
    used = base.where(F.size("tokens") > 0).select("grp", "id", "o", F.col("tokens").alias("t"))
    texts = used.groupBy("grp", "t").agg(F.min("id").alias("id"))
    held = contained_runs(texts.select("grp", "id", "t"), ["grp"], 1).select("grp", F.col("short").alias("x"), F.col("long").alias("y"))
    either = held.unionAll(held.select("grp", F.col("y").alias("x"), F.col("x").alias("y")))
    of = lambda name, at: used.select("grp", F.col("t").alias(at), F.col("id").alias(name), F.col("o").alias(f"o_{name}"))
    ladders = scratch.save(either.join(of("early", "x"), ["grp", "x"]).join(of("late", "y"), ["grp", "y"]).where("o_early < o_late").select("early", "o_early", "late"))
    open_, kept = base.select("id", "o", "target", "interaction"), None
    while not open_.isEmpty():
        standing = open_ if kept is None else open_.unionByName(kept)
        first = standing
        for key in ("target", "interaction"):
            low = standing.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("o").alias(f"low_{key}"))
            first = first.join(low, key, "left")
        leads = F.col("o").eqNullSafe(F.coalesce("low_target", "o")) & F.col("o").eqNullSafe(F.coalesce("low_interaction", "o"))
        blocked = ladders.join(standing.select(F.col("id").alias("early")), "early", "left_semi").select(F.col("late").alias("id")).distinct()
        kept = scratch.save(first.where(leads).join(blocked, "id", "left_anti").select("id", "o", "target", "interaction"))
        after = open_.join(kept.select("id"), "id", "left_anti")
        for key in ("target", "interaction"):
            after = after.join(kept.where(F.col(key).isNotNull()).select(key), key, "left_anti")
        laddered = ladders.join(kept.select(F.col("id").alias("early")), "early", "left_semi").select(F.col("late").alias("id")).distinct()
        open_ = scratch.save(after.join(laddered, "id", "left_anti").select("id", "o", "target", "interaction"))
    if kept is None:
        return base.select("id", F.lit(None).cast("string").alias("reason"), F.col("id").alias("kept_id"))
    by_target = kept.select("target", F.col("id").alias("k1"), F.col("o").alias("o1"))
    by_interaction = kept.where("interaction is not null").select("interaction", F.col("id").alias("k2"), F.col("o").alias("o2"))
    by_ladder = ladders.join(kept.select(F.col("id").alias("early")), "early", "left_semi").groupBy(F.col("late").alias("id")).agg(F.min("o_early")["id"].alias("k3"))
    met = base.select("id", "o", "target", "interaction").join(by_target, "target", "left").join(by_interaction, "interaction", "left").join(by_ladder, "id", "left")
    met = met.join(kept.select("id", F.lit(True).alias("stays")), "id", "left")
    gone, has1, has2 = F.col("stays").isNull(), F.col("o1") < F.col("o"), F.col("o2") < F.col("o")
    reason = F.when(gone & has1, "TARGET_REUSE").when(gone & has2, "SAME_INTERACTION_DUPLICATE").when(gone, "PREFIX_LADDER")
    return met.select("id", reason.alias("reason"), F.when(gone & has1, F.col("k1")).when(gone & has2, F.col("k2")).when(gone, F.col("k3")).alias("kept_id"))
