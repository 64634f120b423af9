"""Registered queries of the training-data operators, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import archive, decontaminate, html_text, language, lm, nearest, neardup, packing, quality, ranked, repair, search, toxicity
from colloquy.llm.common import id_remainder
from colloquy.tables import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train_toxicity(documents, table(spark, sf_dir, "labels"), id_remainder("doc_id", 3) != 1)
    scored = toxicity.score_toxicity(documents, model)
    return scored.select(
        "doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), F.col("toxic_score").alias("score"),
        F.col("toxic_pred").alias("predicted"), "offending",
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    profiles = language.language_profiles(documents, id_remainder("doc_id", 5) != 0)
    named = language.identify_languages(documents.select("doc_id", "text"), profiles)
    return named.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train_quality(documents, table(spark, sf_dir, "labels"), id_remainder("doc_id", 4) != 2)
    scored = quality.score_quality(documents, model)
    return scored.select(
        "doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), F.col("quality_score").alias("score"),
        F.col("quality_pred").alias("predicted"),
    )


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, threshold=80)


def op6_pitman_yor_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    learnt = id_remainder("doc_id", 10) != 0
    scored = lm.score_lm(documents, lm.train_lm(documents, learnt), learnt)
    return scored.withColumn("held_out", id_remainder("doc_id", 10) == 0)


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query set is every document whose id is divisible by 20, searched in all documents."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = search.build_index(documents)
    asked = documents.where(F.col("doc_id") % 20 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return search.search(index, asked, k=10).withColumn("score", F.round("score", 6))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_contamination(documents, table(spark, sf_dir, "benchmark")).drop("k1", "k2")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages"))


def op10_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = archive.write_archive(spark, table(spark, sf_dir, "pages"))
    return archive.archive_index(archive.read_archive(spark, path))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked.search_documents(documents, table(spark, sf_dir, "benchmark"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest.search(nearest.build_index(vectors), vectors.where(F.col("vec_id") % 100 == 0))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(repair.find_faults(repair.damage_conversations(table(spark, sf_dir, "conversations"))))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_toxicity, op3_language_id, op4_quality, op5_minhash_near_dedup, op6_pitman_yor_lm, op7_topk_search, op8_decontamination, op9_html_extraction, op10_warc_archive,
    op11_ranked_search, op12_nearest_neighbours, op13_conversation_repair,
)}

ORACLES: dict[str, str] = {
    "op5_minhash_near_dedup": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, list_aggregate(w[i : i + least(len(w), 2) - 1], 'string_agg', ' ') AS g
            FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 1, 1))) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
        r AS (
            SELECT doc_id, doc_id AS seen FROM documents
            UNION
            SELECT r.doc_id, CASE WHEN e.x = r.seen THEN e.y ELSE e.x END FROM r JOIN e ON e.x = r.seen OR e.y = r.seen),
        c AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY 1)
        SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, c.doc_id = component_id AS kept
        FROM c LEFT JOIN n USING (doc_id)""",
    "op7_topk_search": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        q AS (
            SELECT query_id, t, count(*) AS times FROM (SELECT doc_id AS query_id, unnest(w) AS t FROM d WHERE doc_id % 20 = 0) GROUP BY 1, 2),
        n AS (SELECT count(*) AS n, avg(len(w)) AS mean_len FROM d),
        p AS (SELECT doc_id, t, count(*) AS tf, any_value(dl) AS dl
              FROM (SELECT doc_id, len(w) AS dl, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY 1, 2),
        f AS (SELECT t, count(*) AS df FROM p GROUP BY 1),
        s AS (
            SELECT query_id, doc_id, sum(times * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean_len))) AS score
            FROM q JOIN p USING (t) JOIN f USING (t), n GROUP BY 1, 2),
        r AS (SELECT query_id, doc_id, round(score, 6) AS score,
                     row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM s)
        SELECT query_id, rank, doc_id, score FROM r WHERE rank <= 10""",
    "op8_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        b AS (
            SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        bw AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, list_aggregate(w[i : i + least(len(w), 10) - 1], 'string_agg', ' ') AS win
            FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
        dw AS (
            SELECT doc_id, n, i, list_aggregate(w[i : i + n - 1], 'string_agg', ' ') AS win
            FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
                  FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
        occ AS (SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (n, win)),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM occ) GROUP BY 1),
        its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY 1)
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op10_warc_archive": """
        WITH p AS (
            SELECT page_id, sha1(encode(coalesce(html, ''))) AS payload_digest, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes
            FROM pages),
        m AS (SELECT payload_digest, max(page_id) AS first_id, count(*) AS n FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
        SELECT p.page_id, p.payload_bytes, p.payload_digest,
               CASE WHEN m.n > 1 AND p.page_id <> m.first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN m.n > 1 AND p.page_id <> m.first_id THEN m.first_id END AS refers_to
        FROM p LEFT JOIN m ON p.payload_digest = m.payload_digest AND p.payload_bytes >= 1000""",
    "op11_ranked_search": r"""
        WITH d AS (
            SELECT doc_id, unnest(w) AS t, len(w) AS n
            FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents)),
        q AS (
            SELECT item_id, t, count(*) AS times
            FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY 1, 2),
        g AS (SELECT count(DISTINCT doc_id) AS big_n, count(*) AS big_l FROM d),
        p AS (SELECT doc_id, t, n, count(*) AS tf FROM d WHERE t IN (SELECT t FROM q) GROUP BY ALL),
        f AS (SELECT t, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, g GROUP BY 1),
        s AS (
            SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l))))::BIGINT AS score
            FROM q JOIN p USING (t) JOIN f USING (t), g GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""",
    # States 0 nothing yet, 1 system, 2 user, 3 assistant; a row of w is a way from one to another with its edits' letters.
    "op13_conversation_repair": r"""
        WITH RECURSIVE
        raw AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::UBIGINT)),
                       lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
                           lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)), 4294967295::UBIGINT) % 20 AS kind
            FROM conversations),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM raw WHERE kind <> 0),
        repeats AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen FROM damaged),
        numbered AS (
            SELECT *, left(role, 1) AS initial, row_number() OVER byturn AS i, lag(left(role, 1)) OVER byturn AS before
            FROM repeats WINDOW byturn AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen)),
        marked AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                           WHEN right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
            FROM numbered),
        counted AS (
            SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
            FROM marked GROUP BY 1),
        ins(a, b, cost, letters, said) AS (
            VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
                   (0, 2, 3, 'I', 'user:'), (1, 2, 3, 'I', 'user:'), (2, 3, 3, 'I', 'assistant:'), (3, 2, 3, 'I', 'user:'),
                   (0, 3, 6, 'II', 'user:' || chr(10) || 'assistant:'), (1, 3, 6, 'II', 'user:' || chr(10) || 'assistant:')),
        legal(a, initial, role, b) AS (
            VALUES (0, 's', NULL, 1), (0, 'u', 'user', 2), (1, 'u', 'user', 2), (2, 'a', 'assistant', 3), (3, 'u', 'user', 2)),
        edit AS (
            SELECT s AS a, s AS b, 'D' AS letter, 4 AS cost, NULL::VARCHAR AS initial, NULL::VARCHAR AS role FROM range(4) t(s)
            UNION ALL SELECT a, b, 'R', 3, NULL, role FROM legal WHERE role IS NOT NULL
            UNION ALL SELECT a, b, 'K', 0, initial, NULL FROM legal),
        ways AS (
            SELECT ins.a, edit.b, letter, ins.cost + edit.cost AS cost, letters || letter AS letters, said, initial, role
            FROM ins JOIN edit ON ins.b = edit.a),
        walk AS (
            SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, NULL::VARCHAR AS said FROM counted
            UNION ALL
            SELECT conv_id, i, state, best.cost, best.audit, best.said
            FROM (
                SELECT w.conv_id, m.i, y.b AS state,
                       min(struct_pack(cost := w.cost + y.cost + CASE WHEN m.fault = 'truncated' AND y.letter <> 'D' THEN 3 ELSE 0 END, audit := w.audit || y.letters,
                           said := nullif(concat_ws(chr(10), w.said, nullif(y.said, ''), CASE y.letter WHEN 'K' THEN m.role || ':' || m.text WHEN 'R' THEN y.role || ':' || m.text END), ''))) AS best
                FROM walk w JOIN marked m ON w.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = w.i + 1
                JOIN ways y ON y.a = w.state AND (y.letter = 'D' OR m.fault NOT IN ('blank', 'duplicate')) AND (y.letter <> 'K' OR y.initial = m.initial)
                GROUP BY ALL)),
        ended AS (
            SELECT w.conv_id, min(struct_pack(cost := w.cost + ins.cost, audit := w.audit || ins.letters, said := concat_ws(chr(10), w.said, nullif(ins.said, '')))) AS best
            FROM walk w JOIN counted c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n JOIN ins ON ins.a = w.state AND ins.b IN (0, 3) GROUP BY 1)
        SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
               coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(best.said, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id""",
}
