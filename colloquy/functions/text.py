"""Text functions as Spark columns."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Word lists and patterns that results depend on.
STOP_WORDS = (
    "the a an and or but if then than to of in on at for from with as is are was were be been being i you he she it we "
    "they this that those these do did does can could would should will may might have has had not no yes just really very "
    "like my your our their his her its how what why when where who please tell explain imagine guess"
).split()
INDEPENDENT_STARTERS = ["i", "i'm", "im", "well", "now", "but", "also", "actually", "so", "okay", "ok", "wait", "you", "we", "they"]
CONTINUATION_STARTERS = ["and", "or", "because", "which", "that", "to", "then", "than"]
#: Words that continue a sentence, for risk flags; a longer list than that for turns.
RISK_CONTINUATIONS = ["and", "or", "because", "which", "that", "to", "then", "than", "as", "if", "of", "in", "with"]
#: Texts that stand for something not said.
SENTINELS = ["filtered", "filter", "censored", "redacted", "content filtered", "message filtered", "audio filtered"]
ARTIFACTS = ["filtered", "heart", "underscore", "subtitle", "[music]", "[applause]"]
DEPENDENT_PREFIXES = ["yes", "no", "why", "that", "it", "he", "she", "because", "yeah"]
# Word ends are spelt out in ASCII: engines differ on accented letters beside \\b.
_TRIGGERS = "what|why|how|when|where|who|can|could|would|should|do|did|does|is|are|will|please|tell|explain|imagine|guess"
TRIGGER = rf"\?|(^|[^a-z0-9_])({_TRIGGERS})([^a-z0-9_]|$)"
QUESTION = r"\?$|(^|[^a-z0-9_])(what|why|how|where|when|can|could|would|do|did|is|are)([^a-z0-9_]|$)"
ACKNOWLEDGEMENT = r"^(yes|no|okay|ok|right|sure|exactly|i think|i guess|well|that|yeah|oh|got that|let's go)([^a-z0-9_]|$)"
QUALITY_WORD = r"[A-Za-z]{2,}(?:['-][A-Za-z]+)*|\d+"
SURFACE_MARKERS = {
    "first_person": "i|me|my|mine|myself|we|our|us",
    "second_person": "you|your|yours|yourself",
    "question": "why|how|what|when|where|who",
    "hedge": "maybe|perhaps|probably|i think|i guess|not sure|might|could",
    "assertion": "definitely|obviously|of course|must|never|always|certainly",
    "repair": "no no|i mean|wait|actually|or rather|sorry|uh|um",
    "banter": "lol|lmao|haha|chat|bro|stupid|idiot|dummy",
    "machine": "ai|artificial intelligence|robot|computer|model",
    "disfluency": "uh|um|hmm|er|ah",
}
SECRET_PATTERNS = {
    "api_key": r"\b(sk|pk|api)[-_][A-Za-z0-9]{16,}",
    "access_token": r"\bgh[pousr]_[A-Za-z0-9]{20,}",
    "cloud_key": r"\bAKIA[0-9A-Z]{16}\b",
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "email": r"[a-z0-9._]+@[a-z0-9.]+\.[a-z]+",
}


def collapse(text: Column) -> Column:
    """White space runs become one space, ends are trimmed; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def norm(text: Column) -> Column:
    return F.lower(collapse(text))


def is_sentinel(text: Column) -> Column:
    """Whether a text's tokens are one of SENTINELS and nothing else."""
    return F.array_join(tokens(text), " ").isin(SENTINELS)


def norm_key(text: Column) -> Column:
    """Lower case without URLs, everything but a-z and 0-9 as one space."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"https?://\S+", " ")
    return F.trim(F.regexp_replace(bare, r"[^a-z0-9]+", " "))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(norm(text), F.lit(r"([a-z0-9']+)"), 1)


def content_tokens(text: Column) -> Column:
    """Distinct words of three or more letters that are no stop words."""
    found = F.array_distinct(F.regexp_extract_all(norm(text), F.lit(r"([a-z]{3,})"), 1))
    return F.array_except(found, F.array(*map(F.lit, STOP_WORDS)))


def compound_words(text: Column) -> Column:
    return F.regexp_extract_all(norm(text), F.lit(r"([a-z0-9]+(?:['-][a-z0-9]+)?)"), 1)


def first_word(text: Column) -> Column:
    """The first word in lower case without punctuation around it."""
    return F.regexp_replace(F.element_at(F.split(norm(text), " "), 1), r"""^['".,!?;:]+|['".,!?;:]+$""", "")


def labels(**conditions: Column) -> Column:
    """Names of the conditions that hold, in the order given."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in conditions.items()]))


def quality_words(value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit(f"({QUALITY_WORD})"), 1)


def quality_reasons(text: Column, url_words: int = 3, value: Column | None = None, words: Column | None = None) -> Column:
    """Why a text is unfit: an empty array if it is fit.

    Chinese and Japanese text needs no Latin word. value and words may be columns that hold collapse(text) and quality_words() of
    it, so that long texts are searched once.
    """
    value = collapse(text) if value is None else value
    words = quality_words(value) if words is None else words
    n, kinds = F.size(words), F.size(F.array_distinct(F.transform(words, F.lower)))
    cjk = value.rlike("[\\x{4e00}-\\x{9fff}\\x{3040}-\\x{30ff}]")
    odd = F.length(F.regexp_replace(value, r"""[\p{L}\p{N}\s'".,?!:;()\-]""", ""))
    reasons = labels(
        artifact=F.lower(value).isin(ARTIFACTS),
        repeated_nonsense=(n >= 5) & (kinds == 1),
        symbol_only=value.rlike(r"^[^\p{L}\p{N}]+$"),
        url_artifact=value.rlike(r"(https?://|www\.)\S+") & (n <= url_words),
        token_soup=odd / F.greatest(F.length(value), F.lit(1)) > 0.35,
        no_lexical_content=(n == 0) & ~cjk,
    )
    return F.when(value == "", F.array(F.lit("empty"))).otherwise(reasons)


def text_qa(text: Column) -> Column:
    return F.when(F.size(quality_reasons(text)) == 0, "PASS").otherwise("FAIL")


def transcript_suspicious(text: Column, compression: Column, no_speech: Column) -> Column:
    """Signs of a hallucinated transcript: too compressible, no speech, or few distinct words in a long text."""
    value = collapse(text)
    kinds = F.size(F.array_distinct(F.regexp_extract_all(F.lower(value), F.lit(r"(\w+)"), 1)))
    return (
        (F.coalesce(compression, F.lit(0.0)) >= 2.8) | (F.coalesce(no_speech, F.lit(0.0)) >= 0.85) | ((F.length(value) >= 40) & (kinds <= 4))
    )


def transcription_confidence(log_probability: Column) -> Column:
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.5 + F.coalesce(log_probability, F.lit(-2.0)) / 4)), 4)


def context_dependency(text: Column) -> Column:
    lowered = F.lower(F.coalesce(text, F.lit("")))
    starts = F.lit(False)
    for prefix in DEPENDENT_PREFIXES:
        starts = starts | lowered.startswith(prefix)
    words = F.size(F.filter(F.split(lowered, r"\s+"), lambda w: w != ""))
    return F.when(starts, "likely_context_dependent").when(words <= 3, "possible_context_dependent").otherwise("low_or_unknown")


def padded_words(text: Column) -> Column:
    """Lower-case words with two spaces between and one at the ends; words are runs of a-z, 0-9 and apostrophes."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^a-z0-9']+", "  "), F.lit(" "))


def marker_count(padded: Column, alternatives: str) -> Column:
    """How often any of the words or phrases stands in padded_words() of a text."""
    return F.regexp_count(padded, F.lit(f" ({alternatives.replace(' ', '  ')}) ")).cast("long")


def with_surface_features(rows: DataFrame, text: str) -> DataFrame:
    """rows with counts of surface markers, sentences and question marks, and a length bucket; the text is split into words once."""
    t = F.col(text)
    padded = rows.withColumn("_padded", padded_words(t)).withColumn("word_count", F.regexp_count(F.lower(t), F.lit(r"[a-z0-9']+")).cast("long"))
    words, bare = F.col("word_count"), F.trim(t)
    sentences = F.when(bare == "", 0).otherwise(F.regexp_count(bare, F.lit(r"[.!?]\s+")) + 1).cast("long")
    bucket = F.when(words < 40, "short").when(words < 160, "medium").otherwise("long")
    counted = {f"{k}_count": marker_count(F.col("_padded"), p) for k, p in SURFACE_MARKERS.items()}
    marks = (F.length(t) - F.length(F.replace(t, F.lit("?")))).cast("long")
    return padded.withColumns(
        {"char_count": F.length(t).cast("long"), **counted, "sentence_count": sentences, "question_mark_count": marks, "length_bucket": bucket}
    ).drop("_padded")


def risk_flags(context: Column, response: Column, continuation: Column | None = None, extended: Column | None = None, doubtful: Column | None = None) -> Column:
    """Lexical signs for routing a pair to closer reading; they never decide.

    continuation: an array of texts that may go on with the response; extended: more context is at hand; doubtful: a turn
    with a doubtful transcript or boundary takes part.
    """
    no = F.lit(False)
    first = lambda x: F.regexp_replace(F.element_at(F.split(F.lower(F.trim(x)), " "), 1), r"""^['".,!?;:]+|['".,!?;:]+$""", "")
    starts = no if continuation is None else F.exists(continuation, lambda x: first(x).isin(INDEPENDENT_STARTERS))
    goes_on = no if continuation is None else F.exists(
        continuation, lambda x: ~first(x).isin(INDEPENDENT_STARTERS) & (F.trim(x).rlike("^[a-z]") | first(x).isin(RISK_CONTINUATIONS))
    )
    flags = labels(
        LOWERCASE_RESPONSE_START=F.substring(response, 1, 1).rlike("^[a-z]"),
        NO_ACKNOWLEDGEMENT_PATTERN=~F.lower(response).rlike(ACKNOWLEDGEMENT),
        NO_CONTENT_TOKEN_OVERLAP=F.size(F.array_intersect(content_tokens(context), content_tokens(response))) == 0,
        NO_QUESTION_OR_EXPLICIT_TRIGGER_PATTERN=~F.lower(context).rlike(TRIGGER),
        POSSIBLE_INDEPENDENT_SPEECH_ACT=starts,
        POSSIBLE_GRAMMATICAL_CONTINUATION=goes_on,
        CONTEXT_EXTENSION_AVAILABLE=no if extended is None else extended,
        TRANSCRIPT_OR_BOUNDARY_RISK=no if doubtful is None else doubtful,
    )
    return F.array_sort(flags)


def raw_asr_reasons(segments: Column) -> Column:
    """Why a turn's transcript is unreliable, from its segments: array of (text, no_speech, compression, log_probability, words: array of probabilities)."""
    words = F.aggregate(segments, F.lit(0), lambda n, x: n + F.size(F.filter(F.split(F.trim(x["text"]), r"\s+"), lambda w: w != "")))
    most = lambda name: F.array_max(F.transform(segments, lambda x: x[name]))
    least = F.array_min(F.transform(segments, lambda x: x["log_probability"]))
    chances = F.flatten(F.transform(segments, lambda x: x["words"]))
    mean = F.aggregate(chances, F.lit(0.0), lambda a, x: a + x) / F.greatest(F.lit(1), F.size(chances))
    return labels(
        no_speech=(most("no_speech") >= 0.985) & (words > 2),
        compression=most("compression") >= 3.5,
        log_probability=(least <= -1.6) & (words >= 4),
        word_probability=(mean < 0.25) & (F.size(chances) >= 3),
    )


def _folded(values: pd.Series) -> pd.Series:
    return values.map(lambda x: " ".join(re.sub(r"[^\w\s.-]", " ", unicodedata.normalize("NFKC", x or "").casefold()).split()))


def norm_unicode(text: Column) -> Column:
    """Compatibility form (NFKC), case folded, with letters, digits, dots and hyphens only; null becomes empty. Spark has no NFKC of its own."""
    return F.pandas_udf(_folded, "string")(text)


def secret_kinds(text: Column) -> Column:
    return labels(**{k: F.coalesce(text, F.lit("")).rlike(p) for k, p in SECRET_PATTERNS.items()})


def contains_run(longer: Column, shorter: Column) -> Column:
    """Whether the tokens of shorter stand in longer one after the other."""
    pad = lambda a: F.concat(F.lit(" "), F.array_join(a, " "), F.lit(" "))
    return (F.size(shorter) > 0) & (F.instr(pad(longer), pad(shorter)) > 0)


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two token sets; two empty ones are equal."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def disagreement(old: Column, new: Column, speaker_conflict: Column | None = None, boundary_conflict: Column | None = None) -> Column:
    """How two transcripts of one stretch differ."""
    a, b = tokens(old), tokens(new)
    return (
        F.when(F.coalesce(speaker_conflict, F.lit(False)) if speaker_conflict is not None else F.lit(False), "SPEAKER_CONFLICT")
        .when(F.coalesce(boundary_conflict, F.lit(False)) if boundary_conflict is not None else F.lit(False), "BOUNDARY_CONFLICT")
        .when((F.size(a) == 0) & (F.size(b) > 0), "MISSING_OLD")
        .when((F.size(a) > 0) & (F.size(b) == 0), "MISSING_NEW")
        .when(a == b, "MATCH")
        .when(jaccard(F.array_distinct(a), F.array_distinct(b)) >= 0.7, "MINOR")
        .otherwise("MAJOR")
    )


def clock_seconds(clock: Column) -> Column:
    """H:M:S.mmm, M:S or S as seconds."""
    parts = F.transform(F.split(F.replace(clock, F.lit(","), F.lit(".")), ":"), lambda x: F.try_to_number(x, F.lit("999999.999")).cast("double"))
    return F.aggregate(parts, F.lit(0.0), lambda total, x: total * 60 + x)


def iso_duration_seconds(duration: Column) -> Column:
    """PT#H#M#S as seconds; null if it is no such duration."""
    part = lambda unit: F.coalesce(F.regexp_extract(duration, rf"(\d+){unit}", 1).try_cast("long"), F.lit(0))
    valid = duration.rlike(r"^PT(\d+H)?(\d+M)?(\d+S)?$") & (F.length(duration) > 2)
    return F.when(valid, part("H") * 3600 + part("M") * 60 + part("S"))


def strip_html(html: Column) -> Column:
    """Text without scripts, styles, tags and the five basic character references."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b[^>]*>.*?</(script|style)>", " ")
    bare = F.regexp_replace(bare, r"(?s)<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return collapse(bare)


def safe_name(text: Column, length: int = 80) -> Column:
    """A file name of letters, digits, dot, dash and underscore."""
    return F.substring(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^A-Za-z0-9._-]+", "_"), 1, length)


def error_category(message: Column) -> Column:
    m = F.lower(F.coalesce(message, F.lit("")))
    return (
        F.when(m.rlike("ssl|certificate"), "ssl")
        .when(m.rlike("timeout|timed out"), "timeout")
        .when(m.rlike("forbidden|blocked|captcha"), "blocked")
        .otherwise("other")
    )


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether one insertion, deletion or substitution at most turns a into b."""
    return F.levenshtein(a, b, 1) >= 0


def normalised_id(selected: Column, offered: Column) -> Column:
    """The offered id that a selected one means, or null: itself; the only one equal but for case; the only one of equal ending within one edit."""
    exact = F.array_contains(offered, selected)
    folded = F.filter(offered, lambda x: F.lower(x) == F.lower(selected))
    tail = F.substring(selected, -6, 6)
    typo = F.filter(offered, lambda x: (F.substring(x, -6, 6) == tail) & within_one_edit(F.lower(x), F.lower(selected)))
    return F.when(exact, selected).when(F.size(folded) == 1, F.get(folded, F.lit(0))).when(F.size(typo) == 1, F.get(typo, F.lit(0)))


def boundary_echo(previous: Column, current: Column, most: int = 8, tail: int = 12) -> Column:
    """Whether a turn's tokens, at most most, only repeat a run within the last tail tokens of the turn before."""
    end = F.slice(previous, -F.least(F.size(previous), F.lit(tail)), F.lit(tail))
    fits = F.size(current).between(1, most) & (F.size(previous) > 0)
    return F.when(fits, contains_run(end, current)).otherwise(False)
