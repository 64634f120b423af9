"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A benchmark item is cut into windows of ten consecutive words. A window can occur in a document only
if all its word shingles do, so one necessary shingle is enough to find every occurrence: the
rarest, by its count in the documents. The documents are read once, for the places of those of their
shingles that the benchmark has at all. Windows with a shingle that no document has fall away; the
prefix join takes each remaining window's rarest shingle; length and position bounds drop places
where the window cannot stand; and a place is an occurrence if all the window's shingles, compared
as text, are found at their places from it on, which a join by document and place counts.

The benchmark's shingles and contaminated texts' hashes are broadcast only after their number is checked, and joined in a
shuffle beyond that; all else is joined by shuffles of the found places at every size. No row holds more than one place, so
that a long text that repeats a window is as much work as it has places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.session import Scratch

WINDOW = 10
SHINGLE = 3
BROADCAST_ROWS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text after lower-casing A-Z; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BETWEEN_WORDS), "")


def _shingles(tokens: Column, size: int) -> Column:
    """Runs of size tokens joined by spaces, which no token holds; none if there are fewer tokens."""
    last = F.size(tokens) - size
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda k: F.concat_ws(" ", *[F.get(tokens, k + j) for j in range(size)]))


def _placed_shingles(tokens: Column, size: int) -> Column:
    return F.transform(_shingles(tokens, size), lambda h, k: F.struct(F.lit(size).alias("size"), k.alias("pos"), h.alias("h")))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(window_id, tokens, n, items): distinct windows of all items, with the ids of those that have it; written, the numbers stay.

    An item of fewer words than a window, but at least one, is one window; null and wordless items have none.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).where(
        (F.size("w") > 0) & F.col("item_id").isNotNull()
    )
    n = F.least(F.size("w"), F.lit(window))
    placed = items.select("item_id", n.alias("n"), "w", F.explode(F.sequence(F.lit(0), F.size("w") - n)).alias("at"))
    cut = placed.select("item_id", "n", F.slice("w", F.col("at") + 1, F.col("n")).alias("tokens")).distinct()
    return (
        cut.groupBy("tokens", "n")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
        .withColumn("window_id", F.monotonically_increasing_id())
    )


def find_contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, k1, k2) of every row of documents.

    A word is hit if it stands in an occurrence of any window. A null or wordless text has 0 words
    and no hits; repeated rows come out as often as they are; a null doc_id stays null; with an empty
    benchmark nothing is hit. Extra columns are not read. k1 and k2 are hashes of the text.
    """
    scratch = Scratch(documents.sparkSession, "decontaminate")
    windows = scratch.save(item_windows(benchmark, window))
    sizes = sorted(r[0] for r in windows.select(F.least("n", F.lit(shingle))).distinct().collect())
    wanted = scratch.save(_all_shingles(windows, sizes, shingle))
    asked = wanted.select("size", "h").distinct().unionAll(wanted.sparkSession.createDataFrame([(0, "")], "size int, h string"))
    few = asked.count() <= BROADCAST_ROWS
    if few:
        asked = F.broadcast(asked)

    # One row at place -1 for each document, whatever it holds, and one for each of its places with a shingle of the benchmark.
    row = F.monotonically_increasing_id().alias("row")  # stays, because the found places are written
    texts = documents.select(row, "doc_id", *text_key(), words(F.col("text")).alias("w"))
    none = F.struct(F.lit(0).alias("size"), F.lit(-1).alias("pos"), F.lit("").alias("h"))
    parts = [F.array(none)]
    for size in sizes:
        parts.append(_placed_shingles(F.col("w"), size))
    places = texts.select("row", "doc_id", "k1", "k2", F.size("w").alias("n_words"), F.inline(F.concat(*parts)))
    found = scratch.save(places.join(asked, ["size", "h"]))

    hits = found.where("pos >= 0").select("row", "size", "pos", "h", "n_words")
    counts = hits.groupBy("size", "h").agg(F.count("*").alias("seen"))
    ranked = wanted.join(counts, ["size", "h"], "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    prefix = ranked.groupBy("window_id", "n", "size").agg(F.min(F.struct("seen", "k", "h")).alias("p")).where("p.seen > 0")
    prefix = scratch.save(prefix.select("window_id", "n", "size", F.col("p.k").alias("k"), F.col("p.h").alias("h")))
    if few:  # a row a window, and a window has a shingle
        prefix = F.broadcast(prefix)
    start = F.col("pos") - F.col("k")
    within = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    places = hits.join(prefix, ["size", "h"]).where(within).select("row", "window_id", "n", "size", start.alias("start"))
    run = wanted.join(prefix.select("window_id"), "window_id", "left_semi").select("window_id", "k", "h")
    expected = places.join(F.broadcast(run) if few else run, "window_id").withColumn("pos", F.col("start") + F.col("k"))
    met = expected.join(hits.select("row", "size", "pos", "h"), ["row", "size", "pos", "h"])
    true = met.groupBy("row", "start", "window_id", "n", "size").agg(F.count("*").alias("met")).where(F.col("met") == F.col("n") - F.col("size") + 1)
    true = scratch.save(true.select("row", "start", "n", "window_id"))
    # Hit words are those of the union of the occurrences' spans.
    spans = true.groupBy("row", "start").agg(F.max(F.col("start") + F.col("n")).alias("end"))
    before = F.max("end").over(W.partitionBy("row").orderBy("start").rowsBetween(W.unboundedPreceding, -1))
    more = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), F.coalesce(before, F.lit(0))))
    n_hit = spans.select("row", more.alias("more")).groupBy("row").agg(F.sum("more").cast("long").alias("n_hit"))
    of_window = windows.select("window_id", F.explode("items").alias("item"))
    items = true.select("row", "window_id").distinct().join(of_window, "window_id").groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    of_row = n_hit.join(items, "row")

    out = found.where("pos < 0").join(of_row, "row", "left")
    n_hit, items = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "k1", "k2",
    )


def text_key() -> list[Column]:
    """Two hashes that stand for a text where rows are found again; together 96 bits."""
    return [F.xxhash64("text").alias("k1"), F.hash("text").alias("k2")]


def _sized(tokens: Column, sizes: list[int], shingle: int) -> Column:
    """A window's shingles: of the usual size, or one of all its words if it has fewer."""
    out = F.array().cast("array<string>")
    for size in sizes:
        fits = F.size(tokens) >= size if size == shingle else F.size(tokens) == size
        out = F.when(fits, _shingles(tokens, size)).otherwise(out)
    return out


def _all_shingles(windows: DataFrame, sizes: list[int], shingle: int) -> DataFrame:
    """(window_id, n, size, k, h): shingle h at place k of every window."""
    return windows.select(
        "window_id", "n", F.least("n", F.lit(shingle)).alias("size"), F.posexplode(_sized(F.col("tokens"), sizes, shingle)).alias("k", "h")
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """documents without the rows whose text holds a window of the benchmark.

    Rows with a null or wordless text, or a null id, stay unless they are hit; of repeated rows all stay or go.
    """
    scratch = Scratch(documents.sparkSession, "drop-contaminated")
    gone = scratch.save(find_contamination(documents, benchmark).where("contaminated").select("k1", "k2").distinct())
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone.hint("merge")
    keyed = documents.select("*", *[c.alias(f"_{k}") for c, k in zip(text_key(), ("k1", "k2"), strict=True)])
    left = keyed.join(gone, (keyed["_k1"] == gone["k1"]) & (keyed["_k2"] == gone["k2"]), "left_anti")
    return left.select(*documents.columns)
