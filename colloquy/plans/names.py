"""Queries over names in texts, JSON in answers and transcripts in pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.functions.jsonscan import first_json_object
from colloquy.operators import aliases as O
from colloquy.plans.base import query
from colloquy.sources import pages as P
from colloquy.tables import table

_NAME = r"trim(regexp_replace(regexp_replace(lower(coalesce({}, '')), '[^\p{{L}}\p{{N}}_\s.-]+', ' ', 'g'), '\s+', ' ', 'g'))"

#: The first words of benchmark items are aliases, as many as their ids say; an item's label is its id modulo 7. The first four words of a document are its participants.
NAMES = f"""al AS (SELECT 'L' || item_id % 7 AS label, array_to_string(string_split(text, ' ')[1 : 1 + (item_id % 4)::INT], ' ') AS alias, item_id % 5 = 0 AS short FROM benchmark),
an AS (SELECT label, alias, short, {_NAME.format('alias')} AS a FROM al),
tx AS (SELECT doc_id, {_NAME.format('text')} AS v, list_transform(string_split(coalesce(text, ''), ' ')[1:4], lambda p: {_NAME.format('p')}) AS ps FROM documents),
tk AS (SELECT *, chr(1) || array_to_string(regexp_extract_all(v, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]'), chr(1)) || chr(1) AS w FROM tx),
hit AS (SELECT DISTINCT doc_id, label, alias FROM tk JOIN (SELECT * FROM an WHERE a <> '' AND (short OR length(a) >= 4)) n
    ON CASE WHEN contains(v, a) AND contains(w, chr(1) || array_to_string(regexp_extract_all(a, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]'), chr(1)) || chr(1))
       THEN regexp_matches(v, '(^|[^\\p{{L}}\\p{{N}}_])' || regexp_escape(a) || '($|[^\\p{{L}}\\p{{N}}_])') ELSE false END)"""


def _aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, item = F.split("text", " "), F.col("item_id")
    alias = F.array_join(F.slice(words, F.lit(1), (item % 4 + 1).cast("int")), " ")
    return table(spark, sf_dir, "benchmark").select(F.concat(F.lit("L"), (item % 7).cast("string")).alias("label"), alias.alias("alias"), (item % 5 == 0).alias("short"))


@query(f"WITH {NAMES} SELECT doc_id, label, alias FROM hit")
def alias_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which names of a dictionary stand in each document as whole words."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return O.alias_hits(rows, _aliases(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@query(f"""WITH {NAMES}, ex AS (SELECT DISTINCT doc_id, label FROM (SELECT doc_id, unnest(ps) AS p FROM tx) JOIN an ON p = a WHERE a <> ''),
e AS (SELECT doc_id, list(DISTINCT label) AS ls FROM ex GROUP BY 1), h AS (SELECT doc_id, list(DISTINCT label) AS ls FROM hit GROUP BY 1)
SELECT d.doc_id, array_to_string(list_sort(coalesce(e.ls, [])), ',') AS explicit, array_to_string(list_sort(coalesce(h.ls, [])), ',') AS hits,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(e.ls, []), coalesce(h.ls, [])))), ',') AS possible, CASE WHEN e.ls IS NOT NULL THEN 'high' WHEN h.ls IS NOT NULL THEN 'medium' ELSE 'low' END AS confidence
FROM documents d LEFT JOIN e USING (doc_id) LEFT JOIN h USING (doc_id)""")
def participant_priors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who may take part in each document, by its first words as participants and by names in its text."""
    words = F.slice(F.split(F.coalesce("text", F.lit("")), " "), 1, 4)
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", words.alias("participants"))
    out = O.participant_priors(rows, _aliases(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), *[F.array_join(c, ",").alias(c) for c in ("explicit", "hits", "possible")], "confidence")


@query("""SELECT event_id, CASE event_id % 5 WHEN 4 THEN NULL ELSE props END AS found FROM events""")
def json_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON object in an answer that has words, braces and quotes around it, or is cut short."""
    n, props = F.col("event_id") % 5, F.col("props")
    text = (
        F.when(n == 0, props).when(n == 1, F.concat(F.lit('Sure: {not "it"} then '), props, F.lit(" and {more"))).when(n == 2, F.concat(F.lit("{x: {y} "), props, F.lit("}")))
        .when(n == 3, F.concat(F.lit('"{" ```json\n'), props, F.lit("\n``` }"))).otherwise(F.substring(props, 1, 5))
    )
    return table(spark, sf_dir, "events").select("event_id", first_json_object(text).alias("found"))


_BARE = r"""trim(regexp_replace(regexp_replace(coalesce(html, ''), '[^A-Za-z. ]+', ' ', 'g'), '\s+', ' ', 'g'))"""


@query(rf"""WITH b AS (SELECT page_id, {_BARE} AS v FROM pages), s AS (SELECT page_id, v, list_filter(list_transform(string_split(v, '. '), lambda x: trim(x)), lambda x: x <> '') AS ss FROM b),
e AS (SELECT page_id, generate_subscripts(ss, 1) - 1 AS i, unnest(ss) AS t, len(ss) AS n FROM s WHERE page_id % 3 = 1)
SELECT page_id, 'LD_JSON' AS kind, 0 AS entry, NULL AS speaker, NULL AS start, NULL AS "end", v AS text FROM s WHERE page_id % 3 = 0 AND v <> ''
UNION ALL SELECT page_id, 'ENTRIES', i::INT, CASE WHEN i % 2 = 0 THEN 'A & B' ELSE 'Speaker A' END, i * 2.5, CASE WHEN i + 1 < n THEN (i + 1) * 2.5 ELSE i * 2.5 END, t || ' <end>' FROM e""")
def page_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts of pages that carry their words as structured data, or as blocks of entries; a third has neither."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), "[^A-Za-z. ]+", " "), r"\s+", " "))
    rows = table(spark, sf_dir, "pages").select("page_id", bare.alias("v"))
    script = F.concat(F.lit('<script>x</script><script type="application/ld+json">[{"a": 1}, {"transcript": "'), "v", F.lit('"}]</script>'))
    said = F.filter(F.transform(F.split("v", r"\. "), lambda x: F.trim(x)), lambda x: x != "")

    def block(x, i):
        name = F.when(i % 2 == 0, '<div class="entry-speaker">A &amp; B</div>').otherwise("")
        return F.concat(F.lit('<div class="transcript-entry"><i data-time="'), (i * 2.5).cast("string"), F.lit('"></i>'), name, F.lit('<div class="entry-text"><b>'), x, F.lit("</b><br/>&lt;end&gt;</div></div>"))

    made = F.when(F.col("page_id") % 3 == 0, script).when(F.col("page_id") % 3 == 1, F.array_join(F.transform(said, block), "\n")).otherwise(F.col("v"))
    pages = rows.select("page_id", made.alias("html"))
    told = P.page_transcripts(pages)
    entries = F.from_json("transcript", "array<struct<speaker string, start double, end double, text string>>")
    whole = told.where("kind = 'LD_JSON'").select("page_id", "kind", F.lit(0).alias("entry"), *[F.lit(None).cast(t).alias(c) for c, t in (("speaker", "string"), ("start", "double"), ("end", "double"))], F.from_json(F.concat(F.lit('{"t":'), "transcript", F.lit("}")), "t string")["t"].alias("text"))
    listed = told.where("kind = 'ENTRIES'").select("page_id", "kind", F.posexplode(entries).alias("entry", "e")).select("page_id", "kind", "entry", "e.speaker", "e.start", "e.end", "e.text")
    return whole.unionByName(listed)
