"""Rules on who says what: names that speakers give themselves, enrolments that may be confirmed, findings that visible rows bear out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy.functions import text as T

# How a speaker introduces themself, and words before it that take it back.
SELF_PREFIX = "(?:i\\s*['’]?m|i am|my name is|this is|hey(?: guys)?[, ]+i\\s*['’]?m)"
TAKEN_BACK = "(?:pretend|pretending|roleplay|call|called|like|quote)"
LOOK_BACK = 32
# Evidence that a confirmation by several sources needs, and that one by gold labels needs one of.
INDEPENDENT = ["EXISTING_IDENTITY_AUTHORITY", "SOURCE_PROVENANCE", "CLEAN_SINGLE_SPEAKER"]
GOLD = ["HUMAN_GOLD", "KNOWN_OFFICIAL_SINGLE_SPEAKER"]
SEMANTIC = ["semantic_disconnect", "context_too_thin", "context_too_wide"]
NOISE = ["asr_noise", "asr_control_noise", "control_noise"]


def self_identified(text: Column, names: Column) -> Column:
    """Those of names (lower case) by which a speaker calls themself: "i'm <name>", "my name is <name>", "<name> here".

    A mention does not count as a possessive, or if the LOOK_BACK characters before it end in a word that takes it back ("pretend i'm ..."). A null or empty
    text names nobody; null and empty names are passed over; a repeated name comes out once. Order is that of names.
    """
    said = T.norm(F.coalesce(text, F.lit("")))
    before = F.lit(f"(?<!\\b{TAKEN_BACK}\\s{{0,{LOOK_BACK}}})")

    def pattern(name: Column) -> Column:
        quoted = F.concat(F.lit("\\Q"), name, F.lit("\\E"))
        return F.concat(before, F.lit(f"(?:\\b{SELF_PREFIX}\\s+(?:an? )?"), quoted, F.lit("(?!['’]s)\\b|\\b"), quoted, F.lit(" here\\b)"))

    known = F.array_distinct(F.filter(names, lambda n: n.isNotNull() & (n != "")))
    return F.coalesce(F.filter(known, lambda n: F.regexp_like(said, pattern(n))), F.array().cast("array<string>"))


def enrolment_errors(e: Column) -> Column:
    """What stands against an enrolment e, sorted; none if it may be kept as it is, and confirmed if it says so.

    e is a struct (complete, start, end, duration, overlap, checksum, status, method, synthetic, published, decisions, domains, boundary_clear, conflict, collision).
    A null in a condition counts as not met.
    """
    holds = lambda c: F.coalesce(c, F.lit(False))
    confirmed = holds(e["status"] == "CONFIRMED_TARGET")
    fixture = holds(e["method"] == "SYNTHETIC_FIXTURE")
    real = confirmed & ~fixture
    several = holds(e["method"].isin("EXISTING_IDENTITY_PLUS_INDEPENDENT", "MULTI_EVIDENCE_CONSENSUS"))
    gold = holds(e["method"] == "HUMAN_GOLD")
    domains = F.coalesce(e["domains"], F.array().cast("array<string>"))
    supported = holds(F.forall(e["decisions"], lambda d: F.coalesce(d == "SUPPORTS_CONFIRMATION", F.lit(False))))
    clear = holds(e["boundary_clear"]) & ~F.coalesce(e["conflict"], F.lit(False)) & ~F.coalesce(e["collision"], F.lit(False))
    return F.array_sort(
        T.labels(
            INCOMPLETE_PROVENANCE=~holds(e["complete"]),
            DURATION_MISMATCH=~holds(F.abs(e["duration"] - (e["end"] - e["start"])) <= 1e-6),
            UNRESOLVED_OVERLAP=confirmed & ~holds(e["overlap"] == "NO_OVERLAP_CONFIRMED"),
            CHECKSUM_LENGTH=~holds(F.length(e["checksum"]) == 64),
            EVIDENCE_AGAINST=confirmed & ~supported,
            FIXTURE_IN_USE=confirmed & fixture & (~holds(e["synthetic"]) | holds(e["published"])),
            REAL_MARKED_SYNTHETIC=real & holds(e["synthetic"]),
            NO_GOLD_EVIDENCE=real & gold & (F.size(F.array_intersect(domains, F.array(*map(F.lit, GOLD)))) == 0),
            NOT_INDEPENDENT=real & several & (F.size(F.array_except(F.array(*map(F.lit, INDEPENDENT)), domains)) > 0),
            UNSUPPORTED_METHOD=real & ~gold & ~several,
            UNCLEAR_IDENTITY=real & ~clear,
        )
    )


def corroborated(claim: Column, messages: Column, topology: Column) -> Column:
    """The category in which visible rows bear a verified claim out; null if they do not.

    claim: struct (finding, verified, category, evidence). messages: array of struct (text, turn_ids, start, end), the last being the target; null for a claim about
    topology, whose state stands in topology. Leakage needs the target's text (4 characters or more) among earlier ones; duplicate speech needs two equal earlier texts (8 or
    more) that share a source turn or overlap in time; noise needs a sentinel; a claim about meaning needs evidence that is not blank.
    """
    category = F.regexp_replace(F.lower(F.trim(F.coalesce(claim["category"], F.lit("other")))), "[- ]", "_")
    texts = F.transform(messages, lambda m: F.struct(T.norm(F.coalesce(m["text"], F.lit(""))).alias("v"), m["turn_ids"].alias("ids"), m["start"].alias("s"), m["end"].alias("e")))
    target = F.element_at(F.transform(texts, lambda m: m["v"]), -1)
    history = F.slice(texts, 1, F.greatest(F.size(texts) - 1, F.lit(0)))
    leaks = (F.length(target) >= 4) & F.exists(history, lambda m: m["v"] == target)
    numbered = F.transform(history, lambda m, k: F.struct(k.alias("k"), m.alias("m")))

    def again(x: Column, y: Column) -> Column:
        a, b = x["m"], y["m"]
        met = F.coalesce(F.arrays_overlap(a["ids"], b["ids"]), F.lit(False)) | F.coalesce(F.least(a["e"], b["e"]) > F.greatest(a["s"], b["s"]), F.lit(False))
        return (x["k"] < y["k"]) & (a["v"] == b["v"]) & met

    twice = F.exists(numbered, lambda y: (F.length(y["m"]["v"]) >= 8) & F.exists(numbered, lambda x: again(x, y)))
    noise = F.exists(messages, lambda m: F.coalesce(T.is_sentinel(m["text"]), F.lit(False)))
    seen = F.size(F.coalesce(messages, F.array().cast("array<struct<text:string,turn_ids:array<string>,start:bigint,end:bigint>>"))) > 0
    found = (
        F.when(seen & (category == "target_leakage") & leaks, category).when(seen & (category == "duplicate_speech") & twice, category)
        .when(seen & category.isin(NOISE) & noise, "asr_noise").when(seen & category.isin(SEMANTIC) & (F.trim(claim["evidence"]) != ""), category)
        .when(~seen & category.isin("speaker_topology", "role_assignment") & (topology == "AMBIGUOUS_BOUNDARY"), category)
    )
    return F.when(claim["finding"] & claim["verified"], found)
