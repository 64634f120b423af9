import collections

import pytest

import corpus_pipeline
from colloquy.llm import decontaminate, neardup, queries
from colloquy.tables import table
from tests.llm.test_operators import brute
from tests.oracle import connect, rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, name):
    assert rows(queries.QUERIES[name](spark, SF).toPandas()) == rows(connect(SF).execute(queries.ORACLES[name]).df())


def test_one_query_an_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_dedup", "decontamination", "packing"]
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:2]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns
    kept = spark.createDataFrame(kept.collect(), docs.schema)
    groups = brute([(r["doc_id"], r["text"]) for r in kept.collect()], neardup.SHINGLE)
    single = corpus_pipeline.keep_one_of_near_copies(spark, kept, SF)
    assert {r["doc_id"] for r in single.collect()} == {k for k, (_, low) in groups.items() if k == low}
    clean = corpus_pipeline.drop_contaminated(spark, single, SF)
    hit = {r["doc_id"] for r in decontaminate.find_contamination(single, table(spark, SF, "benchmark")).where("contaminated").collect()}
    want = {r["doc_id"] for r in single.collect()} - hit
    assert {r["doc_id"] for r in clean.collect()} == want
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == want
    used = collections.Counter()
    for r in packed:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048
