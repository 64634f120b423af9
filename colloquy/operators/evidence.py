"""What texts alone give: triggers in a context, the text that stands when two transcripts differ, and a turn's role."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy.functions import text as T

# Words and patterns that flags depend on. Word ends are spelt out in ASCII: engines differ on accented letters.
TRIGGER_WORDS = {
    "QUESTION_OR_MODAL_PATTERN": "what|why|how|where|when|who|which|can|could|would|do|did|is|are|will|should",
    "IMPERATIVE_OR_REQUEST_PATTERN": "try|check|look|tell|show|remember|explain|use|press|go|get|please|stop|wait|listen",
    "ADDRESS_OR_PARTICIPANT_PATTERN": "you|your|yours|we|our",
}


def trigger_evidence(context: Column, target: Column, names: list[str] | None = None) -> Column:
    """(flags, overlap, observable): sorted signs that a context calls for an answer, the content words that it shares with the target, and whether there is any sign.

    names: participants that count as being addressed, in lower case.
    """
    said = T.norm(context)
    overlap = F.array_sort(F.array_intersect(T.content_tokens(context), T.content_tokens(target)))
    flags = {"QUESTION_MARK": said.contains("?"), "CONTENT_TOKEN_OVERLAP": F.size(overlap) > 0}
    for flag, words in TRIGGER_WORDS.items():
        more = "|".join([words, *(names or [])]) if flag.startswith("ADDRESS") else words
        flags[flag] = said.rlike(rf"(^|[^a-z0-9_])({more})([^a-z0-9_]|$)")
    found = F.array_sort(T.labels(**flags))
    return F.struct(found.alias("flags"), overlap.alias("overlap"), (F.size(found) > 0).alias("observable"))


def trigger_score(evidence: Column, accepted: Column) -> Column:
    """2 for any sign, 1 more for shared words and 1 for an accepted relation."""
    return evidence["observable"].cast("int") * 2 + (F.size(evidence["overlap"]) > 0).cast("int") + F.coalesce(accepted, F.lit(False)).cast("int")


def _text(state: str, authority: str | None, text: Column | None, resolver: Column | str) -> Column:
    return F.struct(
        F.lit(state).alias("state"), F.lit(authority).cast("string").alias("authority"), (F.lit(None).cast("string") if text is None else text).alias("text"),
        (F.lit(resolver) if isinstance(resolver, str) else resolver).alias("resolver"),
    )


def resolve_text(old: Column, new: Column, disagreement: Column) -> Column:
    """(state, authority, text, resolver): only evidence without doubt is resolved: an old text that nothing new was compared with, or a MATCH, which takes the new one."""
    a, b = F.trim(F.coalesce(old, F.lit(""))), F.trim(F.coalesce(new, F.lit("")))
    return (
        F.when((a != "") & (b == "") & disagreement.isNull(), _text("RESOLVED", "OLD_TRANSCRIPT", a, "EXISTING_TRANSCRIPT_AUTHORITY"))
        .when((a != "") & (b != "") & (disagreement == "MATCH"), _text("RESOLVED", "NEW_ASR", b, "EXACT_OLD_NEW_MATCH"))
        .otherwise(_text("UNRESOLVED", None, None, F.lit(None).cast("string")))
    )


def resolve_frozen_text(old: Column, new: Column, disagreement: Column, unheard: Column) -> Column:
    """(state, authority, text, resolver) of a verified target: its old text stands unless it is missing or the disagreement is major; the new text is evidence and never replaces it.

    unheard: the audio stage gave no text at all for it, so that there is nothing to disagree with. resolver is the reason where the text stays unresolved.
    """
    a, b = F.trim(F.coalesce(old, F.lit(""))), F.trim(F.coalesce(new, F.lit("")))
    kind = F.when(~F.coalesce(unheard, F.lit(False)), disagreement)
    return (
        F.when(a == "", _text("UNRESOLVED", None, None, "FROZEN_TARGET_OLD_TRANSCRIPT_MISSING"))
        .when(kind.isNull() & (b != ""), _text("UNRESOLVED", None, None, "FROZEN_TARGET_DISAGREEMENT_UNCLASSIFIED"))
        .when(kind.isNull(), _text("RESOLVED", "OLD_TRANSCRIPT", a, "FROZEN_VERIFIED_TARGET_NO_NEW_ASR_EVIDENCE"))
        .when(kind == "MATCH", _text("RESOLVED", "NEW_ASR", b, "FROZEN_VERIFIED_TARGET_EXACT_MATCH"))
        .when(kind.isin("MINOR_TEXT_CHANGE", "MISSING_NEW_SPEECH"), _text("RESOLVED", "OLD_TRANSCRIPT", a, "FROZEN_VERIFIED_TARGET_OLD_TRANSCRIPT_AUTHORITY"))
        .otherwise(_text("UNRESOLVED", None, None, F.concat(F.lit("FROZEN_TARGET_"), kind)))
    )


def role_of_turn(role: Column, identity: Column, targets: list[str]) -> Column:
    """An explicit role of user or assistant, else assistant for the identities that are targets and user for all others."""
    return F.when(role.isin("user", "assistant"), role).when(identity.isin(targets), "assistant").otherwise("user")
