"""Steps that must not grow faster than their input: what they read, keep and hand to Python."""

import glob
import os
import tempfile

from pyspark.sql import functions as F

from colloquy.operators import fold, validation
from colloquy.sources import artifacts
from colloquy.streaming import incremental


def test_repeated_segments_read_small_groups_as_one_stream(spark):
    rows = [(f"g{g}", g * 100 + k, 10.0 * k, 10.0 * k + 12, text) for g in range(30) for k, text in enumerate(["a", "a b", "x", "x"])] + [(None, 9000, 0.0, 1.0, "a"), (None, 9001, 0.5, 2.0, "a")]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # groups go over from batch to batch
    try:
        found = fold.repeated_segments(spark.createDataFrame(rows, "grp string, id long, start double, end double, text string"), overlap=0.4, drift=20.0)
        want = {g * 100 + k: kept for g in range(30) for k, kept in enumerate([g * 100 + 1, None, None, g * 100 + 2])} | {9000: None, 9001: 9000}
        assert {r.id: r.kept_id for r in found.collect()} == want
        assert "FlatMapGroups" not in found._jdf.queryExecution().toString()  # no call of Python for each group
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_windows_from_counts_of_steps(spark):
    events = spark.sql("SELECT id % 3 AS user, timestamp_seconds(1700000000 + id * 1234) AS ts FROM range(100)")
    length = lambda of: events.groupBy(F.window("ts", of, "1 hour").alias("w"), "user").agg(F.count("*").alias("n")).select("user", F.col("w.start").alias("start"), "n")
    got = incremental.spread_steps(length("1 hour"), "user", 12)
    assert sorted(map(tuple, got.select("user", "start", "n").collect())) == sorted(map(tuple, length("12 hours").collect()))


def test_documents_are_written_by_all_tasks_one_file_each(spark):
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/docs"
    rows = spark.range(200).groupBy("id").agg(F.array_sort(F.collect_list("id")).alias("events"))  # its exchange could stand for the one by folder
    artifacts.write_json_documents(rows.withColumn("folder", F.col("id")), path, "folder")
    files = glob.glob(f"{path}/*/*.json")
    assert len(files) == len({os.path.dirname(f) for f in files}) == 200
    assert len({os.path.basename(f).split("-")[1] for f in files}) >= 4  # tasks
    read = artifacts.read_json_documents(spark, path, "id long, events array<long>")
    assert sorted((r.id, r.events, f"folder={r.id}/" in r.file) for r in read.collect()) == [(k, [k], True) for k in range(200)]


def test_near_pairs_are_decided_without_their_texts(spark):
    texts = {1: "a b c d e f g h i j", 2: "a b c d e f g h i j", 3: "a b c d e f g h i", 4: "b a c d e f g h i j k", 5: "a b c d e f g x y", 6: "a b c d e f g h i j"}
    sets = {k: set(v.split()) for k, v in texts.items()}
    pairs = [(a, b, "s" if a < 6 else "t", "s" if b < 6 else "t", texts[a], texts[b], len(sets[a]), len(sets[b]), len(sets[a] & sets[b]) / len(sets[a] | sets[b])) for a in texts for b in texts if a < b]
    frame = spark.createDataFrame(pairs, "a long, b long, family_a string, family_b string, text_a string, text_b string, n_a int, n_b int, jaccard double")
    want = {(a, b): "MIRROR" if texts[a] == texts[b] else "CONTAINED" for a in range(1, 6) for b in range(a + 1, 6) if len(sets[a] & sets[b]) >= 0.9 * min(len(sets[a]), len(sets[b]))}
    assert {(r.kept_id, r.removed_id): r.reason for r in validation.adjudicated(frame).collect()} == want and len(want) == 6
