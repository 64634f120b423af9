"""JSON, JSONL and transcript sources, and versioned sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.text import clock_seconds, collapse

CUE = r"((?:\d+:)?\d{1,2}:\d{2}[.,]\d{3})\s+-->\s+((?:\d+:)?\d{1,2}:\d{2}[.,]\d{3})[^\n]*\n((?:[^\n]+\n?)*)"


def read_json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a file, at any depth below path; file names the file that it came from. Folders are listed by tasks where they are many."""
    return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path).withColumn("file", F.input_file_name())


def write_json_documents(rows: DataFrame, path: str, folder: str) -> None:
    """One object a row, in a folder for each value of folder. Small files cost by number, not by size, so rows are dealt to all cores
    by a hash that no exchange before has (it would be taken for this one and merged by size), and tasks move their own files into place."""
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.sparkSession.sparkContext.defaultParallelism)
    rows.repartition(parts, F.xxhash64(folder)).write.partitionBy(folder).option("mapreduce.fileoutputcommitter.algorithm.version", "2").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True, header: str | None = "manifest_header") -> DataFrame:
    """One object a line, without header records. strict: a malformed line is an error; else it is dropped."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)
    if header and "record_type" in rows.columns:
        rows = rows.where(~F.col("record_type").eqNullSafe(header))
    return rows


def parse_cues(text: Column) -> Column:
    """Cues of a WebVTT text: array of (start, end, text), times in seconds."""
    found = F.regexp_extract_all(F.regexp_replace(text, "\r\n?", "\n"), F.lit(f"({CUE})"), 1)

    def cue(x: Column) -> Column:
        part = lambda k: F.regexp_extract(x, CUE, k)
        return F.struct(clock_seconds(part(1)).alias("start"), clock_seconds(part(2)).alias("end"), collapse(F.regexp_replace(part(3), "<[^>]*>", "")).alias("text"))

    return F.filter(F.transform(found, cue), lambda c: c["text"] != "")


def bracket_lines(text: Column) -> Column:
    """Lines [mm:ss] body of a transcript: array of (start, text)."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"^\[\d+:\d{2}\]"))
    return F.transform(lines, lambda x: F.struct(clock_seconds(F.regexp_extract(x, r"^\[(\d+:\d{2})\]", 1)).alias("start"), collapse(F.regexp_replace(x, r"^\[\d+:\d{2}\]", "")).alias("text")))


def write_jsonl(rows: DataFrame, path: str, append: bool = False) -> None:
    rows.write.mode("append" if append else "overwrite").json(path)


def write_run(rows: DataFrame, path: str, by: list[str] | None = None) -> None:
    """A versioned run's folder: refused if it exists; one subfolder a value of by."""
    writer = rows.write.mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def put_missing(cache: DataFrame, computed: DataFrame, key: str, path: str) -> None:
    """Append those rows to a content-addressed cache whose key it does not hold."""
    computed.dropDuplicates([key]).join(cache.select(key), key, "left_anti").write.mode("append").parquet(path)


def redact(rows: DataFrame, fields: set[str]) -> DataFrame:
    """rows without the fields, at any depth of structs."""
    kept = [c for c in rows.columns if c not in fields]

    def clean(column: Column, kind) -> Column:
        if kind.typeName() == "struct":
            gone = [f.name for f in kind if f.name in fields]
            column = column.dropFields(*gone) if gone and len(gone) < len(kind.fields) else column
            for f in kind:
                if f.name not in fields and f.dataType.typeName() in ("struct", "array"):
                    column = column.withField(f.name, clean(column[f.name], f.dataType))
        elif kind.typeName() == "array" and kind.elementType.typeName() == "struct":
            column = F.transform(column, lambda x: clean(x, kind.elementType))
        return column

    return rows.select(*[clean(F.col(c), rows.schema[c].dataType).alias(c) for c in kept])
