"""Helpers that several training-data operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller pieces of Arrow batches, so that Python holds few texts at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def share_below(key: Column, share: Column) -> Column:
    """True for a fixed share of the keys, chosen by hash."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) < share * float(1 << 30)


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int) -> DataFrame:
    """(doc_id, text, y, class_rows): a sample of about per_class training rows of each class.

    labels: doc_id and a 0/1 column; train: a condition on doc_id. Rows with a null id or label
    are not learnt from; of repeated labels of one id the largest counts. Ids are kept by hash,
    so that the sample is the same in every run. class_rows is the number of labelled
    training rows of the class before sampling.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & train)
        .groupBy("doc_id")
        .agg((F.max(label) > 0).cast("int").alias("y"))
    )
    sizes = known.groupBy("y").agg(F.count("*").alias("class_rows"))
    kept = known.join(F.broadcast(sizes), "y").where(
        share_below(F.col("doc_id"), F.least(F.lit(1.0), F.lit(float(per_class)) / F.col("class_rows")))
    )
    # About 2 * per_class rows of three numbers: small by construction.
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(kept), "doc_id")
