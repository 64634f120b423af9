"""Names of a dictionary found in texts, and what they say about who takes part.

A dictionary of any size is met by joins on tokens: a place in a text goes on only if its token begins some alias, and then only with as
many tokens as such an alias has. No alias is compared with a text that does not hold its first token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions import text as T

WORD = r"[\p{L}\p{N}_]"
DATE = r"^(?:\d{1,2}[-/]\d{1,2}(?:#\d+)?|\d{4}[-/]\d{1,2}[-/]\d{1,2})$"


def name_norm(text: Column) -> Column:
    """Lower case; all but letters, digits, ``_``, ``.`` and ``-`` as one space."""
    return T.collapse(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_\s.-]+", " "))


def _tokens(text: Column) -> Column:
    """Runs of word characters, and each other character: an alias stands in a text as a whole word where its tokens do."""
    return F.regexp_extract_all(text, F.lit(f"({WORD}+|[^\\p{{L}}\\p{{N}}_])"), 1)


def alias_hits(texts: DataFrame, aliases: DataFrame, least: int = 4) -> DataFrame:
    """(id, label, alias): the aliases (label, alias, short) that stand in texts (id, text), each once a text.

    Both are compared as name_norm() gives them. An alias may not touch a word character at either end. Aliases of fewer than least characters count only
    if short is true; those that are empty, never. ids are unique.
    """
    known = aliases.select("label", "alias", name_norm(F.col("alias")).alias("a"), F.coalesce("short", F.lit(False)).alias("short"))
    known = known.where((F.col("a") != "") & (F.col("short") | (F.length("a") >= least))).distinct()
    known = known.withColumn("t", _tokens(F.col("a"))).withColumn("n", F.size("t"))
    firsts = known.groupBy(F.col("t")[0].alias("tok")).agg(F.array_sort(F.collect_set("n")).alias("sizes"))  # a set of lengths each
    words = texts.select("id", _tokens(name_norm(F.col("text"))).alias("w"))
    begun = words.select("id", F.posexplode("w").alias("i", "tok")).join(firsts, "tok")
    places = begun.groupBy("id").agg(F.collect_list(F.struct("i", "sizes")).alias("places"))  # of one text
    each = words.join(places, "id").select("id", "w", F.explode("places").alias("p")).select("id", "w", "p.i", F.explode("p.sizes").alias("n"))
    is_word = lambda c: F.coalesce(c.rlike(WORD), F.lit(False))
    part = F.slice("w", F.col("i") + 1, F.col("n"))
    outer = ~is_word(F.get("w", F.col("i") - 1)) & ~is_word(F.get("w", F.col("i") + F.col("n")))
    met = each.where((F.size(part) == F.col("n")) & outer).select("id", F.array_join(part, "").alias("a")).distinct()
    return met.join(known.select("label", "alias", "a"), "a").select("id", "label", "alias").distinct()


def participant_priors(rows: DataFrame, aliases: DataFrame, least: int = 4) -> DataFrame:
    """(id, explicit, hits, possible, confidence) of rows (id, text, participants): sorted labels that participants are aliases of, that the text holds, and both.

    A participant counts if it equals an alias, compared by name_norm(); empty ones and dates do not count. confidence is high with an explicit label, medium with a
    hit, else low. It narrows who may speak and never names a speaker.
    """
    known = aliases.select("label", name_norm(F.col("alias")).alias("a")).where("a <> ''").distinct()
    named = rows.select("id", F.explode("participants").alias("p")).select("id", name_norm(F.col("p")).alias("a")).where(~F.col("a").rlike(DATE)).distinct()
    explicit = named.join(known, "a").groupBy("id").agg(F.array_sort(F.collect_set("label")).alias("explicit"))
    hits = alias_hits(rows.select("id", "text"), aliases, least).groupBy("id").agg(F.array_sort(F.collect_set("label")).alias("hits"))
    none = F.array().cast(hits.schema["hits"].dataType)
    out = rows.select("id").join(explicit, "id", "left").join(hits, "id", "left")
    out = out.select("id", F.coalesce("explicit", none).alias("explicit"), F.coalesce("hits", none).alias("hits"))
    confidence = F.when(F.size("explicit") > 0, "high").when(F.size("hits") > 0, "medium").otherwise("low")
    return out.select("*", F.array_sort(F.array_union("explicit", "hits")).alias("possible"), confidence.alias("confidence"))
