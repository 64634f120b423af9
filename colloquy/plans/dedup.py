"""Queries over deduplication and leakage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import dedup as O
from colloquy.operators import fold, settle
from colloquy.operators import windows as W
from colloquy.operators.turns import by_turn
from colloquy.plans.base import query
from colloquy.plans.texts import NORM, TOKENS, _documents
from colloquy.plans.turns import TURNS, _turns
from colloquy.tables import table


@query(f"""WITH k AS (SELECT doc_id, source, {NORM} AS v FROM documents) SELECT doc_id, min(doc_id) OVER (PARTITION BY source, v) AS kept_id FROM k""")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the first of its source that has the same normal text."""
    return O.exact_dedup(_documents(spark, sf_dir), [F.col("source"), T.norm(F.col("text"))], "doc_id").select("doc_id", "kept_id")


@query("""SELECT sha256(text) AS key, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents GROUP BY 1 HAVING count(*) > 1""")
def dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.duplicate_groups(_documents(spark, sf_dir), F.sha2("text", 256), "doc_id")


@query(f"""WITH k AS (SELECT doc_id, source, {NORM}[1:60] AS head, (n_chars / 30)::BIGINT AS size FROM documents) SELECT source, head, size, count(*) AS n FROM k GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def metadata_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near keys of metadata: source, the start of the text and its rounded length, halves to the even number."""
    rows = table(spark, sf_dir, "documents").select("source", F.substring(T.norm(F.col("text")), 1, 60).alias("head"), F.bround(F.col("n_chars") / 30).cast("long").alias("size"))
    return rows.groupBy("source", "head", "size").agg(F.count("*").alias("n")).where("n > 1")


@query(f"""WITH t AS (SELECT doc_id, source, ' ' || array_to_string({TOKENS}, ' ') || ' ' AS w FROM documents WHERE len({TOKENS}) > 0),
p AS (SELECT a.doc_id AS x, b.doc_id AS y FROM t a JOIN t b ON a.source = b.source AND a.doc_id < b.doc_id AND (contains(a.w, b.w) OR contains(b.w, a.w)))
SELECT y AS removed_id, min(x) AS kept_id FROM p GROUP BY 1""")
def containment_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold, or stand in, an earlier one of their source."""
    rows = _documents(spark, sf_dir).select("source", "doc_id", T.tokens(F.col("text")).alias("tokens"))
    return O.contained_rows(rows, ["source"], "doc_id", "tokens")


@query(f"""WITH t AS (SELECT source, doc_id, {NORM} AS v FROM documents), p AS (
    SELECT b.doc_id AS longer_id, a.doc_id AS shorter_id, length(a.v) AS n FROM t a JOIN t b ON a.source = b.source AND a.v <> '' AND starts_with(b.v, a.v) AND (length(a.v) < length(b.v) OR a.doc_id < b.doc_id))
SELECT arg_max(shorter_id, (n, shorter_id)) AS shorter_id, longer_id FROM p GROUP BY 2""")
def prefix_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that begin with the one before them in text order."""
    rows = _documents(spark, sf_dir).select("source", "doc_id", T.norm(F.col("text")).alias("v"))
    return O.prefix_pairs(rows, ["source"], "doc_id", "v")


@query(f"""WITH t AS (SELECT doc_id, source, {NORM} AS v FROM documents), s AS (SELECT v, count(DISTINCT source) AS k FROM t WHERE v <> '' GROUP BY 1 HAVING count(DISTINCT source) >= 2)
SELECT doc_id, 'br_' || substr(sha256(v), 1, 16) AS behaviour_id FROM t JOIN s USING (v)""")
def behaviour_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that several sources have: kept and marked."""
    marked = O.behaviour_repeats(_documents(spark, sf_dir), "source", T.norm(F.col("text")), "doc_id")
    return marked.where("behaviour_id is not null").select("doc_id", "behaviour_id")


@query(f"""WITH k AS (SELECT doc_id, source, {NORM} AS v FROM documents), a AS (SELECT doc_id AS removed_id, min(doc_id) OVER (PARTITION BY source, v) AS kept_id FROM k),
b AS (SELECT doc_id AS removed_id, min(doc_id) OVER (PARTITION BY v) AS kept_id FROM k),
l AS (SELECT removed_id, kept_id, 'SAME_SOURCE' AS reason, 0 AS r FROM a WHERE removed_id <> kept_id UNION ALL SELECT removed_id, kept_id, 'ANY_SOURCE', 1 FROM b WHERE removed_id <> kept_id)
SELECT removed_id, kept_id, reason FROM (SELECT *, row_number() OVER (PARTITION BY removed_id ORDER BY r, kept_id) AS rn FROM l) WHERE rn = 1""")
def removal_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every removal once, with the strongest reason and the kept row."""
    rows = _documents(spark, sf_dir)
    value = T.norm(F.col("text"))
    part = lambda keys: O.exact_dedup(rows, keys, "doc_id").where("doc_id <> kept_id").select(F.col("doc_id").alias("removed_id"), "kept_id")
    return O.ledger(("SAME_SOURCE", part([F.col("source"), value])), ("ANY_SOURCE", part([value])))


@query(f"""WITH k AS (SELECT doc_id, {NORM} AS v, CAST(concat('0x', substr(sha1(doc_id::VARCHAR), 1, 8)) AS BIGINT) % 5 AS b FROM documents), s AS (SELECT v, CASE WHEN b = 0 THEN 'sealed' WHEN b = 1 THEN 'validation' ELSE 'train' END AS split FROM k)
SELECT a.split AS split_a, b.split AS split_b, count(*) AS shared FROM (SELECT DISTINCT v, split FROM s) a JOIN (SELECT DISTINCT v, split FROM s) b ON a.v = b.v AND a.split < b.split GROUP BY 1, 2""")
def split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that stand in more than one split when rows are split by id alone."""
    from colloquy.functions.hashing import hash_bucket

    b = hash_bucket(F.col("doc_id"), 5)
    split = F.when(b == 0, "sealed").when(b == 1, "validation").otherwise("train")
    rows = _documents(spark, sf_dir).select(F.xxhash64(T.norm(F.col("text"))).alias("v"), split.alias("split")).distinct()
    a, c = rows.alias("a"), rows.alias("c")
    pairs = a.join(c, (F.col("a.v") == F.col("c.v")) & (F.col("a.split") < F.col("c.split")))
    return pairs.groupBy(F.col("a.split").alias("split_a"), F.col("c.split").alias("split_b")).agg(F.count("*").alias("shared"))


@query(f"""WITH {TURNS}, p AS (SELECT lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))[1:12] AS head, count(*) AS n, count(DISTINCT source_id) AS sources FROM turns GROUP BY 1) SELECT head, n, sources FROM p WHERE n > 1""")
def prompt_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _turns(spark, sf_dir).groupBy(F.substring(T.norm(F.col("text")), 1, 12).alias("head"))
    return rows.agg(F.count("*").alias("n"), F.count_distinct("source_id").alias("sources")).where("n > 1")


@query(f"""WITH r AS (SELECT doc_id, source, lang, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS rn FROM documents) SELECT doc_id, source, lang FROM r WHERE rn = 1""")
def first_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.first_by(_documents(spark, sf_dir).select("doc_id", "source", "lang"), ["source", "lang"], [F.col("doc_id")])


@query()
def ordered_fold_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy containment dedup against kept rows, short ones first, in each source and language."""
    rows = _documents(spark, sf_dir).select(F.concat_ws("|", "source", "lang").alias("grp"), F.col("doc_id").alias("id"), T.tokens(F.col("text")).alias("tokens"))
    return fold.containment_fold(rows)


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as interactions of a family of sixteen conversations: two uploads of each conversation, some with one turn more as context, and shared anchors and targets."""
    turns = _turns(spark, sf_dir).withColumn("ctx", F.lag("text").over(by_turn())).where("speaker = 'assistant'").withColumn("up", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    conv, n, up = F.col("source_id").cast("long"), F.length("text"), F.col("up")
    words = T.tokens(F.col("text"))
    cut = F.when((up == 1) & (n % 3 == 0), F.slice(words, 1, 12)).otherwise(words)
    own = F.when(n % 2 == 0, up.cast("string")).otherwise("")
    key = F.concat_ws(":", "source_id", F.col("idx").cast("string"), F.when((up == 2) & (n % 2 == 0), "x").when((up == 1) & (n % 3 == 0), "y"))
    targets = F.array(F.concat_ws(":", "source_id", F.floor(F.col("idx") / 4).cast("string"), own), F.concat_ws(":", "source_id", F.lit("t"), F.col("idx").cast("string"), own))
    return turns.select(
        F.format_string("%s/%d", "turn_id", up).alias("id"), F.floor(conv / 16).cast("string").alias("family"), F.concat_ws("/", "source_id", F.when(up == 1, "b").otherwise("a")).alias("source"),
        F.array(F.coalesce("ctx", F.lit(""))).alias("context"), targets.alias("targets"),
        F.when(n % 5 == 0, F.lit("one")).otherwise(key).alias("anchor"), F.array_join(cut, " ").alias("text"), cut.alias("tokens"),
    )


@query()
def provenance_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions deduplicated by provenance, text, anchor, target and containment, in that order; a test compares it with a plain fold."""
    return settle.provenance_dedup(interactions(spark, sf_dir))


@query()
def global_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions deduplicated over all families; a test compares it with a plain fold."""
    return settle.global_dedup(interactions(spark, sf_dir))


@query()
def greedy_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four dearest events of each user that do not overlap one another."""
    from colloquy.plans.windows import spans

    rows = spans(spark, sf_dir).select(F.col("user_id").cast("string").alias("grp"), F.col("event_id").alias("id"), F.col("s").alias("start"), F.col("e").alias("end"), F.col("value").alias("weight"))
    return fold.greedy_non_overlap(rows, 4)


@query()
def speaker_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user cut into units by gap and by a longest span, which starts anew with each unit."""
    from colloquy.plans.windows import spans

    rows = spans(spark, sf_dir).select(F.col("user_id").cast("string").alias("grp"), F.col("event_id").alias("id"), F.col("s").alias("start"), F.col("e").alias("end"))
    return fold.span_units(rows, gap=3_600_000, longest=12 * 3_600_000, least=600_000)


@query()
def overlap_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunked transcription's repeated segments: each is compared with the last one kept."""
    from colloquy.plans.windows import spans

    rows = spans(spark, sf_dir).select(F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("grp"), F.col("event_id").alias("id"), F.col("s").alias("start"), F.col("e").alias("end"), F.col("event_type").alias("text"))
    return fold.repeated_segments(rows, overlap=-3_600_000, drift=7_200_000)
