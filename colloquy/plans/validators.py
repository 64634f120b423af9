"""Queries over validators, roll-ups of closure, near pairs that are decided, and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import validation as O
from colloquy.operators import windows as N
from colloquy.operators.similarity import jaccard_join
from colloquy.plans.base import query
from colloquy.plans.texts import TOKENS
from colloquy.plans.vectors import MARGIN, _margins
from colloquy.plans.windows import SPANS, spans
from colloquy.session import Scratch
from colloquy.tables import table

_STATE = "CASE WHEN decided = 0 THEN 'NOT_CHECKED' WHEN broken = 0 THEN 'PASS' ELSE 'FAIL' END"
_GATES_SQL = """WITH d AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS k FROM documents), l AS (SELECT labels.*, d.doc_id AS known, count(*) OVER (PARTITION BY labels.doc_id) AS k FROM labels LEFT JOIN documents d ON d.doc_id = labels.doc_id),
c AS (SELECT *, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS p, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS pr FROM conversations), e AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events),
r AS (""" + " UNION ALL ".join(
    f"SELECT '{gate}' AS gate, count(*) FILTER (NOT ({rule})) AS broken, count({rule}) AS decided FROM {rows}"
    for gate, rows, rule in (
        ("document_ids_unique", "d", "k = 1"), ("document_text_present", "d", "length(text) > 0"), ("document_length_right", "d", "n_chars = length(text)"), ("document_language_known", "d", "lang IN ('en', 'fr', 'de', 'es')"),
        ("document_source_present", "d", "coalesce(source, '') <> ''"), ("document_without_address", "d", "NOT contains(text, '@')"),
        ("label_refers_to_document", "l", "known IS NOT NULL"), ("label_quality_binary", "l", "quality IN (0, 1)"), ("label_toxic_binary", "l", "toxic IN (0, 1)"), ("label_unique", "l", "k = 1"),
        ("turn_follows", "c", "CASE WHEN p IS NULL THEN turn = 0 ELSE turn = p + 1 END"), ("turn_role_known", "c", "role IN ('user', 'assistant', 'system')"), ("turn_text_present", "c", "length(trim(text)) > 0"),
        ("turn_roles_alternate", "c", "CASE WHEN pr IN ('user', 'assistant') THEN role <> pr END"),
        ("event_time_rises", "e", "p <= ts"), ("event_value_positive", "e", "value >= 0"), ("event_props_parse", "e", "json_valid(props)"), ("event_type_known", "e", "event_type IN ('click', 'view', 'purchase', 'error', 'login')"),
        ("event_in_a_cancelled_run", "e", "CASE WHEN event_id < 0 THEN false END"),
    )
) + ")"


def _gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    copies = docs.groupBy("doc_id").agg(F.count("*").alias("k"))
    text = F.col("text")
    of_docs = O.gate_table(
        docs.join(copies, "doc_id"), document_ids_unique=F.col("k") == 1, document_text_present=F.length(text) > 0, document_length_right=F.col("n_chars") == F.length(text),
        document_language_known=F.col("lang").isin("en", "fr", "de", "es"), document_source_present=F.coalesce("source", F.lit("")) != "", document_without_address=~text.contains("@"),
    )
    labels = table(spark, sf_dir, "labels")
    known = labels.join(docs.select("doc_id", F.lit(True).alias("known")), "doc_id", "left").join(labels.groupBy("doc_id").agg(F.count("*").alias("k")), "doc_id")
    of_labels = O.gate_table(
        known, label_refers_to_document=F.col("known").isNotNull(), label_quality_binary=F.col("quality").isin(0, 1), label_toxic_binary=F.col("toxic").isin(0, 1), label_unique=F.col("k") == 1,
    )
    by_turn = W.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf_dir, "conversations").withColumn("p", F.lag("turn").over(by_turn)).withColumn("pr", F.lag("role").over(by_turn))
    of_turns = O.gate_table(
        turns, turn_follows=F.when(F.col("p").isNull(), F.col("turn") == 0).otherwise(F.col("turn") == F.col("p") + 1), turn_role_known=F.col("role").isin("user", "assistant", "system"),
        turn_text_present=F.length(F.trim("text")) > 0, turn_roles_alternate=F.when(F.col("pr").isin("user", "assistant"), F.col("role") != F.col("pr")),
    )
    events = table(spark, sf_dir, "events").withColumn("p", F.lag("ts").over(W.partitionBy("user_id").orderBy("event_id")))
    of_events = O.gate_table(
        events, event_time_rises=F.col("p") <= F.col("ts"), event_value_positive=F.col("value") >= 0, event_props_parse=F.get_json_object("props", "$").isNotNull(),
        event_type_known=F.col("event_type").isin("click", "view", "purchase", "error", "login"), event_in_a_cancelled_run=F.when(F.col("event_id") < 0, False),
    )
    return of_docs.unionAll(of_labels).unionAll(of_turns).unionAll(of_events)


@query(_GATES_SQL + f" SELECT gate, broken, {_STATE} AS state FROM r")
def validator_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nineteen gates over documents, labels, turns and events, each table read once."""
    return _gates(spark, sf_dir)


@query(_GATES_SQL + f""", s AS (SELECT {_STATE} AS state FROM r) SELECT count(*) AS gates, count(*) FILTER (state = 'FAIL') AS failed, count(*) FILTER (state = 'NOT_CHECKED') AS unchecked,
CASE WHEN count(*) FILTER (state = 'FAIL') > 0 THEN 'FAIL' WHEN count(*) FILTER (state = 'NOT_CHECKED') > 0 THEN 'PARTIAL' ELSE 'PASS' END AS state FROM s""")
def validator_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.overall(_gates(spark, sf_dir))


@query("""SELECT user_id, count(*) AS requests, count(*) FILTER (event_type = 'purchase') AS accepted, count(*) FILTER (event_type = 'error') AS refused, count(*) FILTER (event_type NOT IN ('purchase', 'error')) AS pending,
count(*) FILTER (event_type NOT IN ('purchase', 'error')) <= 0.8 * count(*) AND count(*) FILTER (event_type = 'error') > 0 AS complete FROM events GROUP BY 1""")
def closure_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of each source by what became of them, and whether enough are closed."""
    kind = F.col("event_type")
    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count("*").alias("requests"), F.count_if(kind == "purchase").alias("accepted"), F.count_if(kind == "error").alias("refused"), F.count_if(~kind.isin("purchase", "error")).alias("pending")
    )
    return counts.withColumn("complete", (F.col("pending") <= 0.8 * F.col("requests")) & (F.col("refused") > 0))


@query(f"""WITH {MARGIN} SELECT label, round(avg((t >= o)::INT), 6) AS accuracy, round(avg(t - o), 6) AS mean_margin, round(quantile_cont(t - o, 0.05), 6) AS p05 FROM mg GROUP BY 1""")
def margin_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy, mean margin and its interpolated fifth percentile, by label."""
    rows = _margins(spark, sf_dir)
    right = (F.col("target_score") >= F.col("other_score")).cast("int")
    return rows.groupBy("label").agg(F.round(F.avg(right), 6).alias("accuracy"), F.round(F.avg("margin"), 6).alias("mean_margin"), F.round(F.percentile("margin", 0.05), 6).alias("p05"))


@query(f"""WITH t AS (SELECT doc_id, source, {TOKENS} AS w, list_distinct({TOKENS}) AS s FROM documents), u AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM t),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
q AS (SELECT a, b, x.w = y.w AS same, k / greatest(1, least(na, nb)) AS part FROM p JOIN t x ON x.doc_id = a JOIN t y ON y.doc_id = b WHERE k / (na + nb - k) >= 0.7 AND x.source IS NOT DISTINCT FROM y.source)
SELECT a AS kept_id, b AS removed_id, CASE WHEN same THEN 'MIRROR' ELSE 'CONTAINED' END AS reason FROM q WHERE same OR part >= 0.9""")
def adjudicated_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near pairs of documents and which of them goes: mirrors and contained texts of one source."""
    scratch = Scratch(spark, "adjudicated")
    rows = scratch.save(table(spark, sf_dir, "documents").select("doc_id", "source", T.tokens(F.col("text")).alias("w")))
    named = scratch.save(rows.select("doc_id", "source", F.sha2(F.to_json(F.array("w")), 256).alias("name"), F.size(F.array_distinct("w")).alias("n")))
    # Words carry their source, so that documents of two sources share none; a null source is one of its own.
    near = jaccard_join(rows.select("doc_id", F.transform(F.array_distinct("w"), lambda x: F.concat_ws(" ", x, F.col("source"))).alias("s")), "doc_id", "s", 0.7)
    scratch.drop(rows)
    firsts = named.groupBy("name").agg(F.min("doc_id").alias("text"))
    known = scratch.save(named.join(firsts, "name").select("doc_id", "source", "text", "n"))
    side = lambda x: known.select(F.col("doc_id").alias(x), F.col("source").alias(f"family_{x}"), F.col("text").alias(f"text_{x}"), F.col("n").alias(f"n_{x}"))
    return O.adjudicated(near.join(side("a"), "a").join(side("b"), "b"))


@query("""WITH r AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS top, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events),
u AS (SELECT *, round(value, 0) AS k FROM r WHERE top <= 4 OR p % 5 = 1), d AS (SELECT *, row_number() OVER (PARTITION BY user_id, k ORDER BY top, event_id) AS again FROM u),
c AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY top <= 4 DESC, event_id) AS place FROM d WHERE again = 1) SELECT user_id, event_id FROM c WHERE place <= 8""")
def top_and_stride(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each user the four largest and every fifth event, one of each rounded value, eight at most: a sample, so its cap is the feature."""
    user = W.partitionBy("user_id")
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "value", F.row_number().over(user.orderBy(F.desc("value"), "event_id")).alias("top"), F.row_number().over(user.orderBy("event_id")).alias("p"))
    some = rows.where("top <= 4 or p % 5 = 1").withColumn("k", F.round("value", 0))
    one = N.first_by(some, ["user_id", "k"], [F.col("top"), F.col("event_id")])
    return N.top_by(one, ["user_id"], [F.desc(F.col("top") <= 4), F.col("event_id")], 8).select("user_id", "event_id")


@query("""WITH s AS (SELECT doc_id, 'random' AS c FROM documents WHERE substr(md5(doc_id::VARCHAR), 1, 1) IN ('0', '1') UNION ALL SELECT doc_id, 'long' FROM documents WHERE n_chars >= 2000
UNION ALL SELECT DISTINCT doc_id, 'risk' FROM labels WHERE toxic = 1 UNION ALL SELECT DISTINCT doc_id, 'good' FROM labels WHERE quality = 1) SELECT doc_id, string_agg(c, ',' ORDER BY c) AS categories FROM s GROUP BY 1""")
def merged_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of several kinds as one, each document with all the kinds that it is in."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "n_chars"), table(spark, sf_dir, "labels")
    kinds = {
        "random": docs.where(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 1).isin("0", "1")), "long": docs.where("n_chars >= 2000"),
        "risk": labels.where("toxic = 1"), "good": labels.where("quality = 1"),
    }
    tagged = None
    for name, rows in kinds.items():
        part = rows.select("doc_id", F.lit(name).alias("c"))
        tagged = part if tagged is None else tagged.unionAll(part)
    return tagged.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("c")), ",").alias("categories"))


@query(f"""WITH {SPANS}, p AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) - 1) // 32 AS win FROM spans)
SELECT user_id, win::BIGINT AS win, count(*) AS n, min(s) AS first_ms, max(s) AS last_ms FROM p GROUP BY 1, 2 HAVING count(*) >= 20""")
def count_windows_32(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 32 events of a user, the last one kept from 20 on."""
    kept = N.count_windows(spans(spark, sf_dir), ["user_id"], ["s", "event_id"], 32, 20)
    return kept.groupBy("user_id", F.col("window").alias("win")).agg(F.count("*").alias("n"), F.min("s").alias("first_ms"), F.max("s").alias("last_ms"))


@query("""SELECT conv_id, role, count(*) AS n, max(turn) - min(turn) + 1 = count(DISTINCT turn) AS contiguous FROM conversations GROUP BY 1, 2""")
def contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a speaker's turns follow one another without another's between."""
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id", "role")
    return rows.agg(F.count("*").alias("n"), (F.max("turn") - F.min("turn") + 1 == F.count_distinct("turn")).alias("contiguous"))


@query(f"SELECT doc_id, len({TOKENS})::BIGINT AS n_tokens FROM documents")
def single_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result that is computed once for each different text and joined back by its digest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("key", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    done = docs.groupBy("key").agg(F.first("text").alias("text")).select("key", F.size(T.tokens(F.col("text"))).cast("long").alias("n_tokens"))
    return docs.select("doc_id", "key").join(done, "key").select("doc_id", "n_tokens")
