"""Content-addressed WARC archive.

``write_archive`` stores two Parquet tables in the shared folder: each distinct payload once, by
its verified SHA-256, and for every record the exact bytes of its WARC header with the digest of
its payload. ``read_archive`` joins the two and gives back the original records, whose headers
and payloads are then checked against each other.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.session import scratch_root

REVISIT_FROM = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _records(pages: DataFrame, revisit_from: int) -> DataFrame:
    """(page_id, url, strong, weak, size, record_type, refers_to) of every row; the payload is not carried along."""
    payload = _payload()
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        F.sha2(payload, 256).alias("strong"),
        F.sha1(payload).alias("weak"),
        F.octet_length(payload).cast("long").alias("size"),
    )
    first = (
        rows.where(F.col("size") >= revisit_from)
        .groupBy("strong")
        .agg(F.max("page_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    # One row a repeated payload on the right, so a hot payload's rows on the left can be split.
    rows = rows.join(first, "strong", "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.select(
        "page_id", "url", "strong", "weak", "size",
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(again, F.col("first_id")).alias("refers_to"),
    )


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def _header(date: str) -> Column:
    """The WARC/1.1 header block of a record."""

    def name(page_id: Column, strong: Column) -> Column:
        key = F.sha1(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), strong).cast("binary"))
        parts = [F.substring(key, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    revisit = F.col("record_type") == "revisit"
    no_break = F.regexp_replace("url", r"[\r\n]", "")
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", name(F.col("page_id"), F.col("strong"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", no_break),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("weak"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name(F.col("refers_to"), F.col("strong"))))).otherwise(""),
        F.when(F.col("page_id").isNull(), F.lit("")).otherwise(line("X-Page-ID", F.col("page_id").cast("string"))),
        F.when(revisit, line("X-Refers-To-Page-ID", F.col("refers_to").cast("string"))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
        line("X-Payload-Length", F.col("size").cast("string")),
        F.lit("\r\n"),
    ).cast("binary")


def write_archive(
    spark: SparkSession, pages: DataFrame, path: str | None = None,
    revisit_from: int = REVISIT_FROM, date: str = "2024-01-01T00:00:00Z",
) -> str:
    """Write a record for every row of pages (page_id, url, html) and return the archive's folder.

    Of equal payloads of at least revisit_from bytes, the record with the largest page_id is a
    response and the others revisit it; smaller ones are all responses. A null html is an empty
    payload, a null url an empty target; a row with a null page_id is a response without an id,
    unless its payload has a response with one. Rows repeated with the largest page_id are all
    responses. An empty table gives an archive without records. Extra columns are ignored.
    """
    path = path or f"{scratch_root(spark)}/warc-{uuid.uuid4().hex}"
    records = _records(pages, revisit_from)
    strong = F.sha2(_payload(), 256).alias("strong")
    payloads = pages.select(strong, _payload().alias("payload")).groupBy("strong").agg(F.first("payload").alias("payload"))
    payloads.write.option("compression", "zstd").parquet(f"{path}/payloads")
    records.select("url", "strong", _header(date).alias("header")).write.option("compression", "zstd").parquet(f"{path}/headers")
    return path


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload, verified) of every record, the payload found by its digest.

    verified says that the stored payload still has the digest that it is stored by, and the
    length and SHA-1 that the header states. A revisit's payload is that of the record it refers to.
    """
    headers = spark.read.schema("url string, strong string, header binary").parquet(f"{path}/headers")
    payloads = spark.read.schema("strong string, payload binary").parquet(f"{path}/payloads")
    payloads = payloads.select(
        "strong", "payload",
        F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("bytes"),
        (F.sha2("payload", 256) == F.col("strong")).alias("intact"),
    )
    joined = headers.join(payloads, "strong", "left").withColumn("head", F.col("header").cast("string"))
    same = (
        F.col("intact")
        & (F.regexp_extract("head", r"\r\nWARC-Payload-Digest: sha1:([0-9a-f]+)", 1) == F.col("digest"))
        & (F.regexp_extract("head", r"\r\nX-Payload-Length: (\d+)", 1) == F.col("bytes").cast("string"))
    )
    return joined.select("header", "head", "url", "payload", "digest", "bytes", F.coalesce(same, F.lit(False)).alias("verified"))


def original_records(records: DataFrame) -> DataFrame:
    """(record) bytes as a WARC file holds them: header, then the payload of a response, then two line ends."""
    body = F.when(F.col("head").contains("\r\nWARC-Type: revisit\r\n"), F.lit(b"")).otherwise(F.col("payload"))
    return records.select(F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record"))


def archive_index(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) parsed from read_archive()'s records."""
    number = lambda key: F.regexp_extract("head", rf"\r\n{key}: (-?\d+)\r\n", 1).try_cast("long")
    checked = F.when(F.col("verified"), F.col("digest")).otherwise(
        F.raise_error(F.lit("a stored payload does not match its digest")).cast("string")
    )
    return records.select(
        number("X-Page-ID").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        checked.alias("payload_digest"),
        F.regexp_extract("head", r"\r\nWARC-Type: (\w+)\r\n", 1).alias("record_type"),
        number("X-Refers-To-Page-ID").alias("refers_to"),
    )
