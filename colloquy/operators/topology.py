"""Two segmentations of a recording side by side: spans built from timed tokens, and old turns that they split or merge.

A token has the labels that local windows gave its speaker, a map from window to cluster. A cluster means nothing outside its
window, so two tokens are of one speaker, of two, or it is unknown, by the windows that labelled both. All of this is lags, running sums and joins
by recording and time; no recording is gathered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators.joins import overlap_join
from colloquy.operators.recovery import AMBIGUOUS, anchored_speakers, text_similarity
from colloquy.operators.similarity import sequence_ratio
from colloquy.session import Scratch


def relation(left: Column, right: Column) -> Column:
    """same, different or unknown: whether two tokens' maps from window to cluster agree in all windows that both have."""
    shared = F.array_intersect(F.map_keys(left), F.map_keys(right))
    differs = F.exists(shared, lambda k: ~left[k].eqNullSafe(right[k]))
    return F.when(F.coalesce(F.size(shared), F.lit(0)) < 1, "unknown").when(differs, "different").otherwise("same")


def _clusters() -> Column:
    return F.coalesce("clusters", F.create_map().cast("map<string,string>"))


def cluster_keys(tokens: DataFrame, by: list[str], ties: bool) -> DataFrame:
    """(*by, cluster_keys): sorted ``window::cluster`` of the most frequent cluster of each window of a group of tokens (place, clusters).

    Of equally frequent clusters the one that comes first counts if ties, else the window has none.
    """
    votes = tokens.select(*by, "place", F.explode("clusters").alias("window", "cluster")).groupBy(*by, "window", "cluster")
    votes = votes.agg(F.count("*").alias("n"), F.min("place").alias("first"))
    best = votes.groupBy(*by, "window").agg(
        F.max(F.struct("n", (-F.col("first")).alias("first"), "cluster")).alias("best"), F.sort_array(F.collect_list("n"), asc=False).alias("counts")
    )  # a count for each cluster of a window
    kept = best if ties else best.where((F.size("counts") == 1) | (F.get("counts", F.lit(0)) > F.get("counts", F.lit(1))))
    return kept.groupBy(*by).agg(F.array_sort(F.collect_list(F.concat_ws("::", "window", "best.cluster"))).alias("cluster_keys"))


def _joined_text(by: str = "place") -> Column:
    parts = F.transform(F.array_sort(F.collect_list(F.struct(by, F.trim(F.coalesce("text", F.lit(""))).alias("text")))), lambda x: x["text"])
    return F.trim(F.array_join(parts, " "))


def candidate_spans(tokens: DataFrame, max_gap: float = 1.25) -> DataFrame:
    """(recording, span, start, end, text, n_tokens, overlap, cluster_keys, speaker_cluster) of tokens (recording, token_id, start, end, text, clusters, overlap).

    A span ends where the next token begins more than max_gap after the last one's end, where either of the two lies in overlapped speech, or where
    the two are of different speakers. span numbers a recording's spans from 0 in order of time; spans without text are left out.
    cluster_keys has the dominant cluster of each window, none where two are equally frequent; speaker_cluster is the key if there is one only. Null maps have no windows; a null overlap is none.
    """
    order = W.partitionBy("recording").orderBy("start", "end", "token_id")
    rows = tokens.withColumns({"clusters": _clusters(), "overlap": F.coalesce("overlap", F.lit(False))})
    before = lambda c: F.lag(c).over(order)
    breaks = (F.col("start") - before("end") > max_gap) | F.col("overlap") | before("overlap") | (relation(before("clusters"), F.col("clusters")) == "different")
    numbered = rows.withColumn("breaks", F.coalesce(breaks, F.lit(False))).withColumns(
        {"span": F.sum(F.col("breaks").cast("long")).over(order), "place": F.row_number().over(order)}
    )
    spans = numbered.groupBy("recording", "span").agg(
        F.min_by("start", "place").alias("start"), F.max_by("end", "place").alias("end"), _joined_text().alias("text"), F.count("*").alias("n_tokens"), F.max("overlap").alias("overlap")
    )
    keys = cluster_keys(numbered, ["recording", "span"], ties=False)
    out = spans.where("text <> ''").join(keys, ["recording", "span"], "left")
    named = F.coalesce("cluster_keys", F.array().cast("array<string>"))
    return out.withColumn("cluster_keys", named).withColumn("speaker_cluster", F.when(F.size("cluster_keys") == 1, F.get("cluster_keys", F.lit(0))))


def _scoped(recording: Column, keys: Column) -> Column:
    return F.transform(keys, lambda k: F.concat_ws("|", recording, k))


def split_turns(assigned: DataFrame, anchors: DataFrame, least: int = 2) -> DataFrame:
    """(recording, turn_id, part, start, end, text, n_tokens, speaker_state, role, cluster_keys): the children of turns that timed tokens prove to be of several speakers.

    assigned: tokens (recording, turn_id, frozen, token_id, start, end, text, clusters) of old turns; anchors: (key, speaker_state, basis), key being
    ``recording|window::cluster``. Tokens without clusters are passed over; a part ends where two tokens that follow one another are of different speakers. A
    turn is split if it is not frozen, has two parts or more, each of at least least tokens with text that is no sentinel, all their
    speakers are settled by anchors, and at least two differ.
    """
    order = W.partitionBy("recording", "turn_id").orderBy("start", "end", "token_id")
    rows = assigned.withColumn("clusters", _clusters()).where(~F.coalesce("frozen", F.lit(False)) & (F.size("clusters") > 0))
    fresh = F.coalesce(relation(F.lag("clusters").over(order), F.col("clusters")) == "different", F.lit(False))
    numbered = rows.withColumn("fresh", fresh).withColumns({"part": F.sum(F.col("fresh").cast("long")).over(order), "place": F.row_number().over(order)})
    # A turn of one part is not split; it leaves before words are joined and votes counted.
    numbered = numbered.withColumn("last", F.max("part").over(W.partitionBy("recording", "turn_id"))).where("last > 0")
    numbered = Scratch(assigned.sparkSession, "splits").save(numbered.select("recording", "turn_id", "part", "place", "start", "end", "text", "clusters"))
    by = ["recording", "turn_id", "part"]
    parts = numbered.groupBy(*by).agg(F.min_by("start", "place").alias("start"), F.max_by("end", "place").alias("end"), _joined_text().alias("text"), F.count("*").alias("n_tokens"))
    parts = parts.join(cluster_keys(numbered, by, ties=True), by).withColumn("id", F.struct(*by))
    spoken = anchored_speakers(parts.select("id", _scoped(F.col("recording"), F.col("cluster_keys")).alias("keys")), anchors)
    told = parts.join(spoken, "id").drop("id", "basis")
    sound = (F.col("n_tokens") >= least) & (F.col("speaker_state") != AMBIGUOUS) & (F.col("text") != "") & ~T.is_sentinel(F.col("text"))
    turn = W.partitionBy("recording", "turn_id")
    whole = {"parts": F.count("*").over(turn), "sound": F.min(sound.cast("int")).over(turn), "several": F.min("speaker_state").over(turn) < F.max("speaker_state").over(turn)}
    kept = told.withColumns(whole).where("parts > 1 and sound = 1 and several")
    return kept.select("recording", "turn_id", "part", "start", "end", "text", "n_tokens", "speaker_state", "role", "cluster_keys")


def merge_turns(spans: DataFrame, turns: DataFrame, anchors: DataFrame, bin_width: float, least: float = 0.6, similarity: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(recording, span, turn_ids, start, end, text, speaker_state, role): spans that show several old turns to be one turn of one speaker.

    spans as candidate_spans() gives them; turns: (recording, turn_id, start, end, text, frozen); anchors as in split_turns(). A span merges the old turns that
    it overlaps if they are two or more, none is frozen, its own speaker is settled, it is no overlapped speech, and their joined text is
    at least so similar to its own (text_similarity() with the sequence ratio, or another measure of old and new text). Turns and spans meet by bins of bin_width.
    """
    old = turns.select("recording", F.col("start").alias("start_r"), F.col("end").alias("end_r"), "turn_id", F.col("text").alias("old_text"), "frozen")
    met = overlap_join(spans.where(~F.col("overlap")), old, ["recording"], bin_width)
    part = F.array_sort(F.collect_list(F.struct(F.col("start_r").alias("at"), "turn_id", F.trim(F.coalesce("old_text", F.lit(""))).alias("text"))))
    held = met.groupBy("recording", "span").agg(
        part.alias("old"), F.min("start_r").alias("old_start"), F.max(F.struct("start_r", "turn_id", "end_r")).alias("last"), F.first("text").alias("text"),
        F.first("cluster_keys").alias("cluster_keys"), F.max(F.coalesce("frozen", F.lit(False))).alias("frozen"), F.count("*").alias("n"),
    ).where("n > 1 and not frozen")
    joined = F.trim(F.array_join(F.transform("old", lambda x: x["text"]), " "))
    ids = F.transform("old", lambda x: x["turn_id"])
    held = held.withColumn("old_text", joined).withColumn("id", F.struct("recording", "span"))
    measure = similarity or (lambda a, b: text_similarity(a, b, sequence_ratio(T.tokens(a), T.tokens(b))))
    held = Scratch(spans.sparkSession, "merges").save(held.where(measure(F.col("old_text"), F.col("text")) >= least).withColumn("turn_ids", ids).drop("text", "old", "n"))
    spoken = anchored_speakers(held.select("id", _scoped(F.col("recording"), F.col("cluster_keys")).alias("keys")), anchors).where(F.col("speaker_state") != AMBIGUOUS)
    return held.join(spoken, "id").select(
        "recording", "span", "turn_ids", F.col("old_start").alias("start"), F.col("last.end_r").alias("end"),
        F.col("old_text").alias("text"), "speaker_state", "role",
    )


def turn_topology(turns: DataFrame, splits: DataFrame, merges: DataFrame) -> DataFrame:
    """(recording, turn_id, state, nodes): SPLIT_EXISTING with its number of children, MERGE_EXISTING with its number of merges, or MATCH_EXISTING for every turn.

    A turn that is split is not merged.
    """
    split = splits.groupBy("recording", "turn_id").agg(F.count("*").alias("children"))
    merged = merges.select("recording", F.explode("turn_ids").alias("turn_id")).groupBy("recording", "turn_id").agg(F.count("*").alias("merges"))
    rows = turns.select("recording", "turn_id").join(split, ["recording", "turn_id"], "left").join(merged, ["recording", "turn_id"], "left")
    state = F.when(F.col("children").isNotNull(), "SPLIT_EXISTING").when(F.col("merges").isNotNull(), "MERGE_EXISTING").otherwise("MATCH_EXISTING")
    return rows.select("recording", "turn_id", state.alias("state"), F.coalesce("children", "merges", F.lit(1)).cast("long").alias("nodes"))
