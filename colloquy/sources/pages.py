"""Transcripts in web pages: structured data first, else the page's own blocks of entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.functions.jsonscan import unescape
from colloquy.functions.text import collapse

# How the pages mark up transcripts.
LD_JSON = r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""
ENTRY = r"""(?i)<div class=["']transcript-entry["']>"""
ENTRY_TIME = r"""data-time=["']([0-9.]+)["']"""
ENTRY_SPEAKER = r"""(?is)<div class=["']entry-speaker[^>]*>(.*?)</div>"""
ENTRY_TEXT = r"""(?is)<div class=["']entry-text[^>]*>(.*?)</div>"""
NO_SPEAKER = "Speaker A"
EMPTY_JSON = ['""', "[]", "{}", "false", "0", "0.0", "null"]


def ld_json_transcripts(pages: DataFrame, ident: str, html: str) -> DataFrame:
    """(ident, transcript): of each page that has one the first transcript in its ld+json scripts, as JSON text.

    A script holds an object or a list of them, of any shape; one that is no JSON is passed over, and so is an object whose transcript is empty, false or zero.
    """
    bodies = pages.select(ident, F.posexplode(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(LD_JSON), 1)).alias("script", "body"))
    parsed = bodies.select(ident, "script", F.try_parse_json(unescape(F.col("body"))).alias("v"))
    objects = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
    each = parsed.where("v is not null").select(ident, "script", F.posexplode(objects).alias("place", "o"))
    found = each.select(ident, "script", "place", F.to_json(F.try_variant_get("o", "$.transcript", "variant")).alias("transcript"))
    kept = found.where(F.col("transcript").isNotNull() & ~F.col("transcript").isin(EMPTY_JSON))
    return kept.groupBy(ident).agg(F.min_by("transcript", F.struct("script", "place")).alias("transcript"))


def _inner(text: Column) -> Column:
    spaced = F.regexp_replace(text, r"(?i)<br\s*/?>", " ")
    return F.regexp_replace(spaced, r"<[^>]+>", "")


def entry_transcripts(pages: DataFrame, ident: str, html: str) -> DataFrame:
    """(ident, entry, speaker, start, end, text): the entry blocks of each page that have a time and text, numbered from 0; an entry ends where the next begins, the last where it begins."""
    blocks = F.split(F.coalesce(html, F.lit("")), ENTRY)
    each = pages.select(ident, F.posexplode(blocks).alias("block", "b")).where("block > 0")
    some = each.select(
        ident, "block", F.regexp_extract("b", ENTRY_TIME, 1).try_cast("double").alias("start"), F.col("b").rlike(ENTRY_SPEAKER).alias("named"),
        F.regexp_extract("b", ENTRY_SPEAKER, 1).alias("s"), F.regexp_extract("b", ENTRY_TEXT, 1).alias("t"),
    ).where("start is not null")
    said = some.select(ident, "block", "start", "named", unescape(F.col("s")).alias("s"), unescape(_inner(F.col("t"))).alias("t")).withColumn("text", collapse(F.col("t"))).where("text <> ''")
    order = W.partitionBy(ident).orderBy("block")
    return said.select(
        ident, (F.row_number().over(order) - 1).alias("entry"), F.when(F.col("named"), collapse(F.col("s"))).otherwise(NO_SPEAKER).alias("speaker"), "start",
        F.coalesce(F.lead("start").over(order), F.col("start")).alias("end"), "text",
    )


def page_transcripts(pages: DataFrame, ident: str = "page_id", html: str = "html") -> DataFrame:
    """(ident, kind, transcript): LD_JSON with its JSON, else ENTRIES with a JSON list of its entries, else nulls; a row a page. Page ids are unique."""
    ld = ld_json_transcripts(pages, ident, html)
    entries = entry_transcripts(pages, ident, html)
    listed = F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("entry", "speaker", "start", "end", "text"))), lambda e: F.struct(e["speaker"].alias("speaker"), e["start"].alias("start"), e["end"].alias("end"), e["text"].alias("text"))))
    blocks = entries.groupBy(ident).agg(listed.alias("entries"))  # of one page
    kind = F.when(F.col("transcript").isNotNull(), "LD_JSON").when(F.col("entries").isNotNull(), "ENTRIES")
    return pages.select(ident).join(ld, ident, "left").join(blocks, ident, "left").select(ident, kind.alias("kind"), F.coalesce("transcript", "entries").alias("transcript"))
