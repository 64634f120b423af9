"""From raw documents to packed training sequences.

Every stage takes the documents that its predecessor kept. All but the last return the columns of
documents; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import decontaminate, language, neardup, packing, quality
from colloquy.llm.common import id_remainder
from colloquy.session import Scratch
from colloquy.tables import table

#: A text whose n-grams save less of the greatest possible distance than this is in no learnt language.
LEAST_LANGUAGE_SCORE = 0.15


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled neighbours vote good."""
    model = quality.train_quality(docs, table(spark, sf_dir, "labels"), id_remainder("doc_id", 4) != 2)
    return quality.score_quality(docs, model).where("quality_pred = 1").select(*docs.columns)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the documents are marked with; no letters or no likeness goes."""
    profiles = language.language_profiles(docs, id_remainder("doc_id", 5) != 0)
    named = language.identify_languages(docs, profiles)
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE)
    return named.where(known).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return neardup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten consecutive words of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, with their sequence and their place in it."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", keep_quality),
    ("language", keep_known_language),
    ("near_dedup", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Models and tokenizers are no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
