"""Queries over review queues, coverage, comparisons of runs and split assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import review as O
from colloquy.operators.joins import overlap_join, overlap_length
from colloquy.plans.base import query
from colloquy.plans.texts import NORM
from colloquy.plans.turns import TURNS, _turns
from colloquy.plans.windows import SPANS, spans
from colloquy.tables import table


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


@query("""SELECT event_id, CASE WHEN value >= 20 AND event_id % 3 = event_id % 4 THEN 'dual_model_agreement' WHEN event_id % 3 <> user_id % 3 OR event_id % 4 <> user_id % 3 THEN 'model_disagreement_or_mismatch' ELSE 'low_margin_or_unselected' END AS bucket FROM events""")
def review_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second, hint = F.col("event_id") % 3, F.col("event_id") % 4, F.col("user_id") % 3
    return _events(spark, sf_dir).select("event_id", O.review_bucket((F.col("value") >= 20) & (first == second), first, second, hint).alias("bucket"))


@query(f"""WITH {TURNS} SELECT source_id, speaker, count(*) AS n_turns, sum(greatest(0, end_ms - start_ms))::BIGINT AS speech_ms, round(avg(speaker_confidence), 6) AS confidence,
count(*) FILTER (suspicious) AS n_suspicious FROM turns GROUP BY 1, 2""")
def cluster_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns, speech and mean confidence of each speaker of a source."""
    return _turns(spark, sf_dir).groupBy("source_id", "speaker").agg(
        F.count("*").alias("n_turns"), F.sum(F.greatest(F.lit(0), F.col("end_ms") - F.col("start_ms"))).alias("speech_ms"),
        F.round(F.avg("speaker_confidence"), 6).alias("confidence"), F.count_if("suspicious_transcription").alias("n_suspicious"),
    )


#: Buckets of documents by words of four languages.
BUCKETS = {"english": "(?:^| )(?:the|and)(?: |$)", "french": "(?:^| )(?:les|une)(?: |$)", "mail": "[a-z0-9.]+@[a-z0-9.]+", "address": "https?://[a-z0-9./]+", "licence": "licen[sc]e"}


@query("WITH f AS (SELECT doc_id, " + ", ".join(f"list_sort(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '{p}')))[1:8] AS h_{n}" for n, p in BUCKETS.items())
       + ' FROM documents), b AS (SELECT doc_id, list_filter([' + ", ".join(f"CASE WHEN len(h_{n}) > 0 THEN '{n}' END" for n in BUCKETS) + "], lambda x: x IS NOT NULL) AS bs, " + " + ".join(f"len(h_{n})" for n in BUCKETS)
       + ' AS n_hits FROM f) SELECT doc_id, bs[1] AS "primary", array_to_string(bs, \',\') AS buckets, n_hits FROM b')
def metadata_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All buckets of a document with their evidence; the first is the primary one."""
    rows = table(spark, sf_dir, "documents").select("doc_id", O.bucketed(F.col("text"), BUCKETS).alias("b"))
    return rows.select("doc_id", "b.primary", F.array_join("b.buckets", ",").alias("buckets"), F.size("b.hits").cast("long").alias("n_hits"))


@query(f"""WITH {TURNS}, c AS (SELECT source_id, count(*) AS n, count(*) FILTER (identity = 'TARGET_HIGH') AS fam, count(*) FILTER (identity = 'UNKNOWN') AS unk, count(*) FILTER (n % 29 = 0) AS oth, count(*) FILTER (suspicious) AS sus, count(*) FILTER (n % 31 = 0) AS tts FROM turns GROUP BY 1)
SELECT source_id, CASE WHEN n NOT BETWEEN 2 AND 16 THEN 'B' WHEN oth > 0 OR tts > 0 OR fam = 0 OR unk / n > 0.5 OR sus / n > 0.25 THEN 'Q' WHEN fam >= 2 AND unk = 0 AND sus = 0 AND fam / n >= 0.5 THEN 'S'
  WHEN fam >= 1 AND unk / n <= 0.2 AND sus / n <= 0.1 AND fam / n >= 0.4 THEN 'A' ELSE 'B' END AS grade FROM c""")
def fusion_regrade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades of conversations by who speaks in them, with vetoes of known others and of overlaps with a challenge."""
    n = F.length("text")
    counts = _turns(spark, sf_dir).groupBy("source_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("identity") == "TARGET_HIGH").alias("fam"), F.count_if(F.col("identity") == "UNKNOWN").alias("unk"),
        F.count_if(n % 29 == 0).alias("oth"), F.count_if("suspicious_transcription").alias("sus"), F.count_if(n % 31 == 0).alias("tts"),
    )
    grade = O.fusion_grade(F.col("n").between(2, 16), *[F.col(x) for x in ("n", "fam", "unk", "oth", "sus", "tts")])
    return counts.select("source_id", grade.alias("grade"))


@query("""WITH j AS (SELECT event_id, CASE WHEN event_id % 10 > 0 THEN value * 400 END AS secs, event_type = 'view' AS has, user_id % 7 AS people FROM events),
c AS (SELECT *, greatest(1.0, coalesce(secs, 3600) * 0.03) AS cost FROM j)
SELECT event_id, round(165 + CASE WHEN has THEN 35 ELSE 0 END + 5.0 * least(4, people) + 60.0 / (1 + cost / 900.0) - cost / 45.0, 6) AS score FROM c""")
def dispatch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What jobs near closure bring, less what they cost."""
    seconds = F.when(F.col("event_id") % 10 > 0, F.col("value") * 400)
    score = O.dispatch_score(seconds, 0.03, True, F.col("event_type") == "view", F.col("user_id") % 7)
    return _events(spark, sf_dir).select("event_id", F.round(score, 6).alias("score"))


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS counts FROM c GROUP BY 1""")
def count_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map of counts for each user, written as text."""
    pairs = F.transform(F.map_entries("counts"), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string")))
    return O.count_entries(_events(spark, sf_dir), ["user_id"], "event_type").select("user_id", F.array_join(F.array_sort(pairs), ",").alias("counts"))


@query("""WITH a AS (SELECT doc_id, 'calibration' AS bank FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, 'review' FROM documents WHERE doc_id % 3 = 1 UNION ALL SELECT doc_id, 'mined' FROM documents WHERE doc_id % 3 = 2),
x AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1) SELECT a.doc_id, bank, x.doc_id IS NOT NULL AS excluded FROM a LEFT JOIN x ON a.doc_id = x.doc_id""")
def confound_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three inputs in one tagged bank, rows with a confound marked and kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    tag = F.when(F.col("doc_id") % 3 == 0, "calibration").when(F.col("doc_id") % 3 == 1, "review").otherwise("mined")
    confounds = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct().withColumn("excluded", F.lit(True))
    return docs.withColumn("bank", tag).join(confounds, "doc_id", "left").withColumn("excluded", F.coalesce("excluded", F.lit(False)))


@query("""WITH m AS (SELECT user_id, max(value) / 60.0 AS m1, min(value) / 60.0 - 0.02 AS m2, CASE WHEN user_id % 2 = 0 THEN 'TARGET' ELSE 'OTHER' END AS identity FROM events GROUP BY 1)
SELECT user_id, CASE WHEN m1 >= 0.20 AND m2 < 0 AND identity = 'TARGET' THEN 'UNKNOWN' ELSE identity END AS identity, m1 >= 0.20 AND m2 < 0 AND identity = 'TARGET' AS quarantined FROM m""")
def hard_negative_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters that one model takes for the target by far and the other does not lose their identity."""
    margins = _events(spark, sf_dir).groupBy("user_id").agg((F.max("value") / 60.0).alias("m1"), (F.min("value") / 60.0 - 0.02).alias("m2"))
    held = (F.col("m1") >= 0.20) & (F.col("m2") < 0) & (F.col("identity") == "TARGET")
    named = margins.withColumn("identity", F.when(F.col("user_id") % 2 == 0, "TARGET").otherwise("OTHER"))
    return named.select("user_id", F.when(held, "UNKNOWN").otherwise(F.col("identity")).alias("identity"), held.alias("quarantined"))


@query("""WITH m AS (SELECT user_id, event_type, median(value) AS median FROM events GROUP BY 1, 2), p AS (SELECT *, row_number() OVER w AS place, lead(median) OVER w AS next FROM m WINDOW w AS (PARTITION BY user_id ORDER BY median, event_type))
SELECT user_id, event_type, round(median, 6) AS median FROM p WHERE place = 1 AND next - median >= 1.0""")
def lowest_by_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's kind of event with the lowest median value, where the next is clearly higher."""
    return O.lowest_by_gap(_events(spark, sf_dir), "user_id", "event_type", "value", 1.0).withColumn("median", F.round("median", 6))


@query("""SELECT user_id, count(*) AS windows, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)::BIGINT AS views, round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 4) AS spent,
count(*) FILTER (value >= 20) AS grade_a, count(*) FILTER (value >= 5 AND value < 20) AS grade_b, count(*) FILTER (value < 5) AS grade_c FROM events GROUP BY 1""")
def coverage_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditional sums and counts of grades for each source."""
    grade = lambda low, high: F.count_if((F.col("value") >= low) & (F.col("value") < high))
    return _events(spark, sf_dir).groupBy("user_id").agg(
        F.count("*").alias("windows"), F.count_if(F.col("event_type") == "view").alias("views"),
        F.round(F.sum(F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0)), 4).alias("spent"),
        grade(20, float("inf")).alias("grade_a"), grade(5, 20).alias("grade_b"), grade(float("-inf"), 5).alias("grade_c"),
    )


@query(f"""WITH {SPANS}, w AS (SELECT * FROM spans WHERE event_type = 'view'), t AS (SELECT * FROM spans WHERE event_type = 'click'),
m AS (SELECT t.event_id, w.event_id AS window_id, (w.s <= t.s AND t.e <= w.e)::INT AS inside, least(t.e, w.e) - greatest(t.s, w.s) AS shared FROM t JOIN w ON t.user_id = w.user_id AND t.s < w.e AND w.s < t.e),
p AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY inside DESC, shared DESC, window_id DESC) AS place FROM m) SELECT event_id, window_id, inside = 1 AS contained, shared FROM p WHERE place = 1""")
def best_evidence_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window with the best evidence for a target: one that holds it, then the one that shares most."""
    rows = spans(spark, sf_dir)
    targets = rows.where("event_type = 'click'").select("user_id", "event_id", F.col("s").alias("start"), F.col("e").alias("end"))
    windows = rows.where("event_type = 'view'").select("user_id", F.col("event_id").alias("window_id"), F.col("s").alias("start_r"), F.col("e").alias("end_r"))
    met = overlap_join(targets, windows, ["user_id"], 600_000)
    inside = (F.col("start_r") <= F.col("start")) & (F.col("end") <= F.col("end_r"))
    shared = overlap_length(F.col("start"), F.col("end"), F.col("start_r"), F.col("end_r"))
    best = met.groupBy("event_id").agg(F.max(F.struct(inside.cast("int").alias("inside"), shared.alias("shared"), "window_id")).alias("b"))
    return best.select("event_id", "b.window_id", (F.col("b.inside") == 1).alias("contained"), "b.shared")


@query(f"""WITH {SPANS}, n AS (SELECT * FROM spans WHERE event_type = 'click'), o AS (SELECT * FROM spans WHERE event_type = 'view')
SELECT event_id FROM n WHERE e - s >= 250 AND NOT EXISTS (SELECT 1 FROM o WHERE o.user_id = n.user_id AND o.s < n.e AND n.s < o.e AND least(o.e, n.e) - greatest(o.s, n.s) >= 0.5 * (n.e - n.s))""")
def suppressed_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New spans that are long enough and of which no old turn covers half."""
    rows = spans(spark, sf_dir)
    new = rows.where("event_type = 'click'").select("user_id", "event_id", F.col("s").alias("start"), F.col("e").alias("end"))
    old = rows.where("event_type = 'view'").select("user_id", F.col("s").alias("start_r"), F.col("e").alias("end_r"))
    length = F.col("end") - F.col("start")
    covered = overlap_join(new, old, ["user_id"], 600_000).where(overlap_length(F.col("start"), F.col("end"), F.col("start_r"), F.col("end_r")) >= 0.5 * length)
    return new.where(length >= 250).select("event_id").join(covered.select("event_id").distinct(), "event_id", "left_anti")


@query("""WITH o AS (SELECT lang, count(*) AS n, avg(n_chars) AS a FROM documents WHERE lang IS DISTINCT FROM 'de' GROUP BY 1), w AS (SELECT lang, count(*) AS n, avg(n_chars) AS a FROM documents WHERE doc_id % 5 > 0 AND lang IS DISTINCT FROM 'es' GROUP BY 1)
SELECT l.lang, coalesce(o.n, 0) AS n_old, coalesce(w.n, 0) AS n_new, coalesce(w.n, 0) - coalesce(o.n, 0) AS n_change, round(w.a - o.a, 6) AS mean_change
FROM (SELECT lang FROM o UNION SELECT lang FROM w) l LEFT JOIN o ON o.lang IS NOT DISTINCT FROM l.lang LEFT JOIN w ON w.lang IS NOT DISTINCT FROM l.lang""")
def run_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An old run without German and a new one without Spanish and a fifth of the ids, by language: counts and mean lengths side by side."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    old, new = docs.where(~F.col("lang").eqNullSafe("de")), docs.where((F.col("doc_id") % 5 > 0) & ~F.col("lang").eqNullSafe("es"))
    return O.compare_runs(old, new, "lang", "n_chars").withColumn("mean_change", F.round("mean_change", 6))


@query("SELECT doc_id FROM documents WHERE NOT (doc_id % 5 > 0 OR length(coalesce(text, '')) < 200 OR lang = 'de')")
def lost_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline documents that a run neither kept nor quarantined; a fifth is left out, but short and German ones are quarantined."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    quarantined = docs.where((F.length(F.coalesce("text", F.lit(""))) < 200) | (F.col("lang") == "de"))
    return O.monotone(docs.select("doc_id"), docs.where("doc_id % 5 > 0"), quarantined, "doc_id")


@query("""WITH s AS (SELECT user_id, count(*) FILTER (event_type = 'view') AS a, count(*) FILTER (event_type = 'click') AS b, max(value) AS m FROM events GROUP BY 1)
SELECT user_id, (CASE WHEN a > 15 THEN 'done' ELSE 'pending' END) = 'done' AND (CASE WHEN b > 12 THEN 'done' WHEN b > 5 THEN 'not_available' ELSE 'failed' END) IN ('done', 'not_available') AND m > 30 AS complete FROM s""")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each of a source's stages has a status that closes it."""
    counts = _events(spark, sf_dir).groupBy("user_id").agg(F.count_if(F.col("event_type") == "view").alias("a"), F.count_if(F.col("event_type") == "click").alias("b"), F.max("value").alias("m"))
    stages = {"metadata": (F.when(F.col("a") > 15, "done").otherwise("pending"), ["done"]),
              "speech": (F.when(F.col("b") > 12, "done").when(F.col("b") > 5, "not_available").otherwise("failed"), ["done", "not_available"]),
              "measure": (F.when(F.col("m") > 30, "path").otherwise(""), ["path"])}
    closed = F.lit(True)
    for status, allowed in stages.values():
        closed = closed & status.isin(allowed)
    return counts.select("user_id", closed.alias("complete"))


@query(f"""WITH {TURNS}, m AS (SELECT source_id, bool_or(speaker = 'assistant' AND n % 4 = 0) AS history, bool_and(n % 19 > 0) AS closed, count(*) AS n FROM turns GROUP BY 1)
SELECT source_id, CASE WHEN NOT closed THEN NULL WHEN history THEN 'history' ELSE 'natural' END AS view_name, n FROM m""")
def history_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations by view: with an unsupervised assistant turn they are history; those with an open turn are in no view."""
    messages = F.collect_list(F.struct("speaker", (F.length("text") % 4 != 0).alias("supervise"), (F.length("text") % 19 > 0).alias("closed")))
    rows = _turns(spark, sf_dir).groupBy("source_id").agg(messages.alias("messages"))
    history = F.exists("messages", lambda x: (x["speaker"] == "assistant") & ~x["supervise"])
    closed = F.forall("messages", lambda x: x["closed"])
    return rows.select("source_id", F.when(closed, F.when(history, "history").otherwise("natural")).alias("view_name"), F.size("messages").cast("long").alias("n"))


@query("""WITH d AS (SELECT doc_id, source, coalesce(CASE WHEN doc_id % 4 > 0 THEN CASE WHEN length(source) % 2 = 0 THEN 'train' ELSE 'validation' END END, CASE WHEN doc_id % 3 > 0 THEN 'sealed' END) AS split FROM documents) SELECT doc_id, split FROM d WHERE split IS NOT NULL""")
def split_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split of a document's family, else its own; documents with neither are dropped."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 4 > 0, F.col("source")).alias("source"))
    families = table(spark, sf_dir, "documents").select("source").distinct().withColumn("s1", F.when(F.length("source") % 2 == 0, "train").otherwise("validation"))
    members = table(spark, sf_dir, "documents").where("doc_id % 3 > 0").select("doc_id", F.lit("sealed").alias("s2"))
    out = docs.join(families, "source", "left").join(members, "doc_id", "left").select("doc_id", F.coalesce("s1", "s2").alias("split"))
    return out.where("split is not null")


@query("""WITH p AS (SELECT doc_id, CASE WHEN doc_id % 10 < 8 THEN 'train' ELSE 'sealed' END AS part FROM documents UNION ALL SELECT doc_id, 'validation' FROM documents WHERE doc_id % 97 = 1),
c AS (SELECT d.doc_id, count(p.part) AS n FROM documents d LEFT JOIN p ON p.doc_id = d.doc_id AND d.doc_id % 89 > 0 GROUP BY 1)
SELECT count(*) FILTER (n = 0) AS missing, count(*) FILTER (n > 1) AS repeated, bool_and(n = 1) AS partition FROM c""")
def partition_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether parts are disjoint and cover everything; some rows here are in two parts, and some in none."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    parts = docs.where("doc_id % 89 > 0").unionAll(docs.where("doc_id % 97 = 1 and doc_id % 89 > 0"))
    counts = docs.withColumn("n", F.lit(0)).unionAll(parts.withColumn("n", F.lit(1))).groupBy("doc_id").agg(F.sum("n").alias("n"))
    return counts.agg(F.count_if(F.col("n") == 0).alias("missing"), F.count_if(F.col("n") > 1).alias("repeated"), F.bool_and(F.col("n") == 1).alias("partition"))


@query()
def filled_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits of families by fill; an order of decisions is not SQL, so a test compares it with a plain fold."""
    counts = _events(spark, sf_dir).groupBy(F.concat(F.lit("f"), F.col("user_id").cast("string")).alias("family")).agg(F.count("*").alias("n"))
    return O.filled_splits(counts, "family")


@query("""WITH d AS (SELECT o_orderkey AS id, o_custkey AS grp, lower(o_orderpriority) AS title, o_totalprice AS dur FROM orders)
SELECT a.id AS a, b.id AS b FROM d a JOIN d b ON a.grp = b.grp AND a.title = b.title AND a.id < b.id AND length(a.title) >= 5 AND abs(a.dur - b.dur) <= greatest(5.0, 0.01 * greatest(a.dur, b.dur, 1.0))""")
def title_duration_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of one customer with the same title and durations that differ by at most 1 %.

    Durations are dealt to bins of equal ratio, so that a title that many share does not meet itself as a whole.
    """
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("grp"), F.lower("o_orderpriority").alias("title"), F.col("o_totalprice").alias("dur"),
        F.floor(F.log(F.greatest(F.col("o_totalprice"), F.lit(500.0))) / F.log(F.lit(1.02))).alias("bin"),
    ).where("length(title) >= 5")
    near = rows.withColumn("bin", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)))
    b = near.select("grp", "title", "bin", F.col("id").alias("b"), F.col("dur").alias("dur_b"))
    met = rows.withColumnRenamed("id", "a").join(b, ["grp", "title", "bin"]).where("a < b")
    close = F.abs(F.col("dur") - F.col("dur_b")) <= F.greatest(F.lit(5.0), 0.01 * F.greatest(F.col("dur"), F.col("dur_b"), F.lit(1.0)))
    return met.where(close).select("a", "b").distinct()


@query(f"""WITH d AS (SELECT doc_id, {NORM} AS v FROM documents) SELECT doc_id, len(regexp_extract_all(v, '[a-z0-9'']+'))::BIGINT AS n_tokens, contains(v, '?') AS asks_back,
regexp_matches(v, '(^|[^a-z0-9])(ai|artificial intelligence|robot|model)([^a-z0-9]|$)') AS names_machine, least(1.0, len(regexp_extract_all(' ' || regexp_replace(v, '[^a-z0-9]+', '  ', 'g') || ' ', ' (love|hate|angry|sad|happy|feel) ')) / 4.0) AS emotion FROM d""")
def distribution_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of a text for sampling and analysis; they decide nothing."""
    v = T.norm(F.col("text"))
    machine = v.rlike("(^|[^a-z0-9])(ai|artificial intelligence|robot|model)([^a-z0-9]|$)")
    padded = F.concat(F.lit(" "), F.regexp_replace(v, "[^a-z0-9]+", "  "), F.lit(" "))
    emotion = F.least(F.lit(1.0), F.regexp_count(padded, F.lit(" (love|hate|angry|sad|happy|feel) ")) / 4.0)
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(T.tokens(F.col("text"))).cast("long").alias("n_tokens"), v.contains("?").alias("asks_back"), machine.alias("names_machine"), emotion.alias("emotion")
    )


@query(f"""WITH {TURNS}, a AS (SELECT turn_id, source_id, start_ms, end_ms, (idx % 4) * 600000 AS base, n FROM turns)
SELECT turn_id, base + least(600000, start_ms % 700000) AS start_ms, base + least(600000, start_ms % 700000 + n) AS end_ms, start_ms % 700000 + n <= 600000 AS inside FROM a""")
def timebase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window-local times on the recording's clock, with a check of the window's bounds."""
    base, local = (F.col("idx") % 4) * 600_000, F.col("start_ms") % 700_000
    end = local + F.length("text")
    return _turns(spark, sf_dir).select(
        "turn_id", (base + F.least(F.lit(600_000), local)).alias("start_ms"), (base + F.least(F.lit(600_000), end)).alias("end_ms"), (end <= 600_000).alias("inside")
    )


@query("""WITH n AS (SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events), t AS (SELECT * FROM n WHERE event_id % 50 = 0)
SELECT t.event_id, count(*) AS n_near, min(n.event_id) AS first_id, max(n.event_id) AS last_id FROM t JOIN n ON t.user_id = n.user_id AND n.p BETWEEN t.p - 4 AND t.p + 4 GROUP BY 1""")
def neighbours_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth event with the four before and behind it: a report of examples, so the cut is its feature."""
    near = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-4, 4)
    rows = _events(spark, sf_dir).select("event_id", F.count("*").over(near).alias("n_near"), F.min("event_id").over(near).alias("first_id"), F.max("event_id").over(near).alias("last_id"))
    return rows.where("event_id % 50 = 0")


@query("""WITH c AS (SELECT event_id, md5(event_type) AS h FROM events), r AS (SELECT event_id, md5(event_type || CASE WHEN event_id % 11 = 0 THEN 'x' ELSE '' END) AS h, event_type FROM events WHERE event_id % 3 > 0),
p AS (SELECT event_id, value FROM events WHERE event_id % 4 > 0)
SELECT c.event_id, CASE WHEN r.event_id IS NULL THEN 'NO_REQUEST' WHEN r.h <> c.h THEN 'STALE_REQUEST' WHEN p.event_id IS NULL THEN 'NO_PRIMARY' WHEN p.value >= 10 THEN 'ACCEPTED' ELSE 'REFUSED' END AS outcome FROM c LEFT JOIN r USING (event_id) LEFT JOIN p USING (event_id)""")
def hashed_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with their requests and judgements; a request whose input hash is not the candidate's is stale."""
    kind = F.col("event_type")
    candidates = _events(spark, sf_dir).select("event_id", F.md5(kind.cast("binary")).alias("h"))
    altered = F.when(F.col("event_id") % 11 == 0, F.concat(kind, F.lit("x"))).otherwise(kind)
    requests = _events(spark, sf_dir).where("event_id % 3 > 0").select("event_id", F.md5(altered.cast("binary")).alias("asked"))
    primary = _events(spark, sf_dir).where("event_id % 4 > 0").select("event_id", "value")
    outcome = (
        F.when(F.col("asked").isNull(), "NO_REQUEST").when(F.col("asked") != F.col("h"), "STALE_REQUEST").when(F.col("value").isNull(), "NO_PRIMARY")
        .when(F.col("value") >= 10, "ACCEPTED").otherwise("REFUSED")
    )
    return candidates.join(requests, "event_id", "left").join(primary, "event_id", "left").select("event_id", outcome.alias("outcome"))
