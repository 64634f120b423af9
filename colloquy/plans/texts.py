"""Queries over text functions and text filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import hashing as H
from colloquy.functions import text as T
from colloquy.plans.base import query
from colloquy.plans.turns import QA, TURNS, _turns
from colloquy.tables import table

NORM = r"trim(regexp_replace(lower(coalesce(text, '')), '\s+', ' ', 'g'))"
TOKENS = rf"regexp_extract_all({NORM}, '[a-z0-9'']+')"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")


def _marker(p: str) -> str:
    return f"len(regexp_extract_all(' ' || regexp_replace(lower(text), '[^a-z0-9'']+', '  ', 'g') || ' ', ' ({p.replace(' ', '  ')}) '))::BIGINT"


@query(rf"""WITH v0 AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS v FROM documents),
v1 AS (SELECT *, regexp_extract_all(v, '[A-Za-z]{{2,}}(?:[''-][A-Za-z]+)*|\d+') AS w FROM v0)
SELECT doc_id, CASE WHEN v = '' THEN 'empty' ELSE array_to_string(list_filter([
    CASE WHEN lower(v) IN ('filtered', 'heart', 'underscore', 'subtitle', '[music]', '[applause]') THEN 'artifact' END,
    CASE WHEN len(w) >= 5 AND len(list_distinct(list_transform(w, lambda x: lower(x)))) = 1 THEN 'repeated_nonsense' END,
    CASE WHEN regexp_full_match(v, '[^\p{{L}}\p{{N}}]+') THEN 'symbol_only' END,
    CASE WHEN regexp_matches(v, '(https?://|www\.)\S+') AND len(w) <= 3 THEN 'url_artifact' END,
    CASE WHEN length(regexp_replace(v, '[\p{{L}}\p{{N}}\s''".,?!:;()\-]', '', 'g'))::DOUBLE / greatest(length(v), 1) > 0.35 THEN 'token_soup' END,
    CASE WHEN len(w) = 0 AND NOT regexp_matches(v, '[\x{{4e00}}-\x{{9fff}}\x{{3040}}-\x{{30ff}}]') THEN 'no_lexical_content' END], lambda x: x IS NOT NULL), ',') END AS reasons FROM v1""")
def text_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _documents(spark, sf_dir).select("doc_id", T.collapse(F.col("text")).alias("value")).withColumn("words", T.quality_words(F.col("value")))
    return rows.select("doc_id", F.array_join(T.quality_reasons(F.col("value"), value=F.col("value"), words=F.col("words")), ",").alias("reasons"))


@query(f"""SELECT doc_id, length({NORM})::BIGINT AS norm_len, md5({NORM}) AS norm_md5, len({TOKENS})::BIGINT AS n_tokens,
trim(regexp_replace(regexp_replace(lower(text), 'https?://\\S+', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))[1:40] AS key40,
len(regexp_extract_all({NORM}, '[a-z0-9]+(?:[''-][a-z0-9]+)?'))::BIGINT AS n_compound FROM documents""")
def text_normal_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return _documents(spark, sf_dir).select(
        "doc_id", F.length(T.norm(t)).cast("long").alias("norm_len"), F.md5(T.norm(t).cast("binary")).alias("norm_md5"), F.size(T.tokens(t)).cast("long").alias("n_tokens"),
        F.substring(T.norm_key(t), 1, 40).alias("key40"), F.size(T.compound_words(t)).cast("long").alias("n_compound"),
    )


@query(f"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all({NORM}, '[a-z]{{3,}}'), lambda x: x NOT IN ({", ".join(f"'{w}'" for w in T.STOP_WORDS)})))), ' ') AS words FROM documents""")
def content_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", F.array_join(F.array_sort(T.content_tokens(F.col("text"))), " ").alias("words"))


@query("SELECT doc_id, length(text)::BIGINT AS char_count, len(regexp_extract_all(lower(text), '[a-z0-9'']+'))::BIGINT AS word_count, " + ", ".join(f"{_marker(p)} AS {k}_count" for k, p in T.SURFACE_MARKERS.items())
       + r", CASE WHEN trim(text) = '' THEN 0 ELSE len(regexp_extract_all(trim(text), '[.!?]\s+')) + 1 END::BIGINT AS sentence_count, (length(text) - length(replace(text, '?', '')))::BIGINT AS question_mark_count"
       + ", CASE WHEN len(regexp_extract_all(lower(text), '[a-z0-9'']+')) < 40 THEN 'short' WHEN len(regexp_extract_all(lower(text), '[a-z0-9'']+')) < 160 THEN 'medium' ELSE 'long' END AS length_bucket FROM documents")
def surface_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.with_surface_features(_documents(spark, sf_dir), "text")
    counts = [f"{k}_count" for k in T.SURFACE_MARKERS]
    return rows.select("doc_id", "char_count", "word_count", *counts, "sentence_count", "question_mark_count", "length_bucket")


@query(f"WITH {TURNS} SELECT speaker, count(*) AS turns, round(avg(len(regexp_extract_all(lower(text), '[a-z0-9'']+'))), 6) AS mean_words, " + ", ".join(f"sum({_marker(p)})::BIGINT AS {k}_count" for k, p in T.SURFACE_MARKERS.items()) + " FROM turns GROUP BY 1")
def style_by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.with_surface_features(_turns(spark, sf_dir), "text")
    return rows.groupBy("speaker").agg(
        F.count("*").alias("turns"), F.round(F.avg("word_count"), 6).alias("mean_words"), *[F.sum(f"{k}_count").alias(f"{k}_count") for k in T.SURFACE_MARKERS]
    )


@query("SELECT kind, count(*) AS n, min(doc_id) AS first_id FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS kind, doc_id FROM documents WHERE regexp_matches(coalesce(text, ''), '{p}')" for k, p in T.SECRET_PATTERNS.items()) + ") GROUP BY 1")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _documents(spark, sf_dir).select("doc_id", F.explode(T.secret_kinds(F.col("text"))).alias("kind"))
    return found.groupBy("kind").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@query(r"""WITH f AS (SELECT source, CASE WHEN regexp_matches(lower(text), '<(script|div|span)|function *\(') THEN 'html_or_js' WHEN regexp_matches(lower(text), 'https?://') THEN 'url'
    WHEN regexp_matches(text, '[%&$#*]{3}') THEN 'symbols' WHEN regexp_matches(text, '!!') THEN 'shouting' ELSE 'clean' END AS flag FROM documents)
SELECT source, flag, count(*) AS n FROM f GROUP BY 1, 2""")
def contamination_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source and first sign of contamination."""
    t, low = F.col("text"), F.lower("text")
    flag = (
        F.when(low.rlike(r"<(script|div|span)|function *\("), "html_or_js").when(low.rlike("https?://"), "url").when(t.rlike(r"[%&$#*]{3}"), "symbols")
        .when(t.rlike("!!"), "shouting").otherwise("clean")
    )
    return _documents(spark, sf_dir).groupBy("source", flag.alias("flag")).agg(F.count("*").alias("n"))


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)\b[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM pages""")
def pages_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All text of a page without markup."""
    return table(spark, sf_dir, "pages").select("page_id", T.strip_html(F.col("html")).alias("text"))


@query(r"""SELECT page_id, regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g')[1:80] AS name, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
CASE WHEN regexp_matches(url, '\.html?($|\?)') THEN 'page' WHEN regexp_matches(url, '[?&](utm_|ref=)') THEN 'tracked' WHEN regexp_matches(url, 'blog') THEN 'blog' ELSE 'other' END AS category FROM pages""")
def path_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A safe name, the host and a category by ordered rules for every address."""
    url = F.col("url")
    category = F.when(url.rlike(r"\.html?($|\?)"), "page").when(url.rlike(r"[?&](utm_|ref=)"), "tracked").when(url.rlike("blog"), "blog").otherwise("other")
    return table(spark, sf_dir, "pages").select("page_id", T.safe_name(url).alias("name"), F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), category.alias("category"))


@query(r"""SELECT event_id, (v // 3600)::BIGINT * 3600 + (v % 3600 // 60) * 60 + v % 60 AS seconds, round(v / 1.0 + 0.25, 3) AS clock FROM (SELECT event_id, epoch_us(ts) // 1000000 % 86400 AS v FROM events)""")
def clock_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations and clocks written as text and read back."""
    v = F.expr("unix_seconds(cast(ts as timestamp)) % 86400")
    h, m, s = F.expr("v div 3600"), F.expr("v % 3600 div 60"), F.expr("v % 60")
    rows = table(spark, sf_dir, "events").select("event_id", v.alias("v"))
    written = rows.select("event_id", F.format_string("PT%dH%dM%dS", h, m, s).alias("iso"), F.format_string("%02d:%02d:%02d.250", h, m, s).alias("clock"))
    return written.select("event_id", T.iso_duration_seconds(F.col("iso")).alias("seconds"), F.round(T.clock_seconds(F.col("clock")), 3).alias("clock"))


@query("""SELECT user_id, CASE WHEN regexp_matches(lower(props), '"k": [0-4]') THEN 'timeout' WHEN regexp_matches(lower(props), '"k": [5-7]') THEN 'blocked' ELSE 'other' END AS category, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL""")
def error_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where("event_type = 'error'")
    message = F.when(F.col("props").rlike('"k": [0-4]'), "request timed out").when(F.col("props").rlike('"k": [5-7]'), "403 Forbidden").otherwise("connection reset")
    return rows.groupBy("user_id", T.error_category(message).alias("category")).agg(F.count("*").alias("n"))


@query(f"""WITH {TURNS}, {QA} SELECT speaker, text_qa, asr_quality, count(*) AS n, round(avg(greatest(0.0, least(1.0, 0.5 - (n % 7) / 8.0))), 4) AS confidence FROM annotated GROUP BY 1, 2, 3""")
def transcript_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text fitness by speaker, with the confidence of a log probability that falls with the length."""
    rows = _turns(spark, sf_dir).withColumn("text_qa", T.text_qa(F.col("text")))
    n = F.length("text") % 7
    confidence = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.5 + (-n / 2.0) / 4))
    return rows.groupBy("speaker", "text_qa", "asr_quality").agg(F.count("*").alias("n"), F.round(F.avg(confidence), 4).alias("confidence"))


@query(r"""SELECT doc_id, CASE WHEN text LIKE '%@%' THEN NULL ELSE text END AS body, source, n_chars FROM documents""")
def redact_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export whose texts with an address are withheld."""
    rows = table(spark, sf_dir, "documents")
    return rows.select("doc_id", F.when(~F.col("text").contains("@"), F.col("text")).alias("body"), "source", "n_chars")


@query("""SELECT event_id, substr(sha256(event_id || '|' || user_id || '|' || event_type), 1, 20) AS id, printf('%.6f', value) AS fixed, CAST(concat('0x', substr(sha1(event_id::VARCHAR), 1, 8)) AS BIGINT) % 5 AS split,
CAST(concat('0x', substr(sha256(event_id::VARCHAR), 57, 8)) AS BIGINT) % 16 AS shard FROM events""")
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id", H.joined_id(key, F.col("user_id"), F.col("event_type")).alias("id"), F.format_string("%.6f", "value").alias("fixed"), H.hash_bucket(key, 5).alias("split"), H.hash_shard(key, 16).alias("shard")
    )


@query("""SELECT event_id, sha256('{"k":' || (props->>'k') || '}') AS digest FROM events""")
def canonical_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 of properties as JSON with sorted keys and no spaces."""
    return table(spark, sf_dir, "events").select("event_id", H.canonical_json_sha256(F.col("props")).alias("digest"))


@query(f"""WITH t AS (SELECT doc_id, list_distinct({TOKENS}) AS w FROM documents), u AS (SELECT doc_id, len(w) AS n, unnest(w) AS g FROM t),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2)
SELECT a AS doc_id, b AS other, round(k / (na + nb - k), 6) AS jaccard FROM p WHERE k / (na + nb - k) >= 0.8""")
def jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose sets of words overlap by at least four fifths, by a prefix-filtered token join."""
    from colloquy.operators.similarity import jaccard_join

    rows = _documents(spark, sf_dir).select("doc_id", F.array_distinct(T.tokens(F.col("text"))).alias("tokens"))
    return jaccard_join(rows, "doc_id", "tokens", 0.8).select(F.col("a").alias("doc_id"), F.col("b").alias("other"), F.round("jaccard", 6).alias("jaccard"))


@query()
def difflib_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence similarity of each turn's words to the turn before, and the longest common run."""
    from colloquy.operators.similarity import longest_run, sequence_ratio
    from colloquy.operators.turns import by_turn

    rows = _turns(spark, sf_dir).withColumn("old", F.lag("text").over(by_turn())).where("old is not null")
    a, b = T.tokens(F.col("old")), T.tokens(F.col("text"))
    return rows.select("turn_id", F.round(sequence_ratio(a, b), 6).alias("ratio"), longest_run(a, b).alias("longest"))


@query("""WITH p AS (SELECT s_suppkey, s_name, lead(s_name) OVER (ORDER BY s_suppkey) AS following FROM supplier) SELECT s_suppkey, levenshtein(s_name, following) <= 1 AS near FROM p WHERE following IS NOT NULL""")
def edit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each supplier's name is one edit from the name with the next key."""
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    following = rows.select((F.col("s_suppkey") - 1).alias("s_suppkey"), F.col("s_name").alias("following"))
    return rows.join(following, "s_suppkey").select("s_suppkey", T.within_one_edit(F.col("s_name"), F.col("following")).alias("near"))


@query("""SELECT c_custkey, CASE (c_custkey % 4)::INT WHEN 0 THEN c_name WHEN 1 THEN c_name WHEN 2 THEN c_name END AS resolved FROM customer""")
def id_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names given exactly, in another case, with a typo or wrongly, resolved against three offers."""
    name = F.col("c_name")
    given = F.when(F.col("c_custkey") % 4 == 0, name).when(F.col("c_custkey") % 4 == 1, F.lower(name)).when(F.col("c_custkey") % 4 == 2, F.concat(F.lit("x"), name)).otherwise("nobody")
    return table(spark, sf_dir, "customer").select("c_custkey", T.normalised_id(given, F.array(name, F.lit("Other 1"), F.lit("Other 2"))).alias("resolved"))


@query(f"""WITH {TURNS}, t AS (SELECT *, regexp_extract_all(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), '[a-z0-9'']+') AS w FROM turns), p AS (SELECT *, lag(w) OVER (PARTITION BY source_id ORDER BY idx) AS b FROM t)
SELECT turn_id, len(w) BETWEEN 1 AND 8 AND len(b) > 0 AND contains(' ' || array_to_string(b[-12:], ' ') || ' ', ' ' || array_to_string(w, ' ') || ' ') AS echo FROM p WHERE b IS NOT NULL""")
def boundary_echoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that only repeat the end of the turn before."""
    from colloquy.operators.turns import by_turn

    rows = _turns(spark, sf_dir).withColumn("w", T.tokens(F.col("text"))).withColumn("b", F.lag("w").over(by_turn())).where("b is not null")
    return rows.select("turn_id", T.boundary_echo(F.col("b"), F.col("w")).alias("echo"))


#: Segments of a turn as a transcriber would give them, from the turn's own numbers.
_SEGMENTS = """sg AS (SELECT event_id, user_id, [struct_pack(t := event_type || ' one two three', ns := (event_id % 101) / 100.0, cr := 1.0 + (event_id % 53) / 20.0, lp := -(event_id % 37) / 20.0, w := [(event_id % 7) / 10.0, 0.2, 0.1]),
    struct_pack(t := event_type, ns := (user_id % 100) / 100.0, cr := 2.0, lp := -0.5, w := [0.3])] AS s FROM events)"""


@query(f"""WITH {_SEGMENTS}, m AS (SELECT event_id, list_max(list_transform(s, lambda x: x.ns)) AS ns, list_max(list_transform(s, lambda x: x.cr)) AS cr, list_min(list_transform(s, lambda x: x.lp)) AS lp,
list_sum(list_transform(s, lambda x: len(string_split(x.t, ' ')))) AS n, list_avg(flatten(list_transform(s, lambda x: x.w))) AS p, len(flatten(list_transform(s, lambda x: x.w))) AS k FROM sg)
SELECT event_id, array_to_string(list_filter([CASE WHEN ns >= 0.985 AND n > 2 THEN 'no_speech' END, CASE WHEN cr >= 3.5 THEN 'compression' END, CASE WHEN lp <= -1.6 AND n >= 4 THEN 'log_probability' END,
CASE WHEN p < 0.25 AND k >= 3 THEN 'word_probability' END], lambda x: x IS NOT NULL), ',') AS reasons FROM m""")
def raw_asr_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why transcripts are unreliable, from nested segments and word probabilities."""
    e, kind = F.col("event_id"), F.col("event_type")
    segment = lambda text, *numbers: F.struct(text.alias("text"), *[x.alias(n) for x, n in zip(numbers, ("no_speech", "compression", "log_probability", "words"), strict=True)])
    first = segment(F.concat(kind, F.lit(" one two three")), e % 101 / 100.0, 1.0 + e % 53 / 20.0, -(e % 37) / 20.0, F.array(e % 7 / 10.0, F.lit(0.2), F.lit(0.1)))
    second = segment(kind, F.col("user_id") % 100 / 100.0, F.lit(2.0), F.lit(-0.5), F.array(F.lit(0.3)))
    rows = table(spark, sf_dir, "events").select("event_id", F.array(first, second).alias("segments"))
    return rows.select("event_id", F.array_join(T.raw_asr_reasons(F.col("segments")), ",").alias("reasons"))


@query(rf"""WITH {TURNS}, v AS (SELECT *, trim(regexp_replace(text, '\s+', ' ', 'g')) AS v, n % 40 / 12.0 AS cr, n % 100 / 100.0 AS ns, CASE WHEN n % 3 > 0 THEN -(n % 30) / 10.0 END AS lp FROM turns)
SELECT turn_id, cr >= 2.8 OR ns >= 0.85 OR (length(v) >= 40 AND len(list_distinct(regexp_extract_all(lower(v), '[a-z0-9_]+'))) <= 4) AS suspicious, round(greatest(0, least(1, 0.5 + coalesce(lp, -2.0) / 4)), 4) AS confidence FROM v""")
def transcript_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signs of a made-up transcript, and the confidence that its log probability gives."""
    n = F.length("text")
    suspicious = T.transcript_suspicious(F.col("text"), n % 40 / 12.0, n % 100 / 100.0)
    return _turns(spark, sf_dir).select("turn_id", suspicious.alias("suspicious"), T.transcription_confidence(F.when(n % 3 > 0, -(n % 30) / 10.0)).alias("confidence"))


@query()
def unicode_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compatibility forms of documents; a test compares them with unicodedata, as DuckDB has no NFKC."""
    return _documents(spark, sf_dir).select("doc_id", F.md5(T.norm_unicode(F.col("text")).cast("binary")).alias("norm_md5"))
