import random
import tempfile

import pytest
from pyspark.sql import functions as F

from colloquy.operators import turns
from colloquy.streaming import incremental, stateful

SEGMENTS = "source_id string, segment_id long, start_ms long, end_ms long, speaker string, text string"


def segments(rng, sources, n):
    out = []
    for s in range(sources):
        at = 1_700_000_000_000 + rng.randrange(5000)
        for k in range(n):
            at += rng.choice([0, 300, 900, 1500, 2600, 4000, 30_000])
            end = at + rng.choice([200, 1000, 5000, 44_000])
            out.append((f"s{s}", s * 1000 + k, at, end, rng.choice("AAAB"), rng.choice(["It is done.", "and then", "one two three four", "Go on?", "no"])))
            at = end - rng.choice([0, 0, 100])
    return out


def plain(spark, rows):
    """The batch operator over all rows, numbered by time."""
    df = spark.createDataFrame(rows, SEGMENTS).withColumn("idx", F.row_number().over(turns.W.partitionBy("source_id").orderBy("start_ms", "segment_id")).cast("long"))
    return sorted((r["source_id"], r["turn"], r["segments"], r["start_ms"], r["end_ms"], r["speaker"], r["turn_boundary"], r["text"]) for r in turns.natural_turns(df).collect())


class Stream:
    """Files that are given one after the other, and the rows that came out of all runs."""

    def __init__(self, spark, schema, shape):
        self.spark, self.schema, self.shape = spark, schema, shape
        self.base, self.n = tempfile.mkdtemp(prefix="spark-", dir="/tmp"), 0
        stateful.use_rocksdb(spark)

    def feed(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(f"{self.base}/in/f{self.n}")
        self.n += 1

    def run(self):
        stream = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.base}/in/*")
        out = self.shape(stream)
        self.out = out.schema
        incremental.run_available(out, lambda batch, k: batch.withColumn("batch", F.lit(k)).write.mode("overwrite").parquet(f"{self.base}/out/b={k}"), f"{self.base}/checkpoint")

    def rows(self):
        return [tuple(r)[: len(self.out)] for r in self.spark.read.schema(self.out).parquet(f"{self.base}/out/*").collect()]


CLOSE = [("~", -1, 1_900_000_000_000, 1_900_000_000_000, "", "")]


@pytest.mark.parametrize("seed", range(1))
def test_natural_turns_of_several_files_with_a_restart(spark, seed):
    rng = random.Random(seed)
    rows = segments(rng, 5, 25)
    rows.sort(key=lambda r: r[2])
    stream = Stream(spark, SEGMENTS, lambda s: stateful.natural_turns(s, late="2 minutes"))
    files = [rows[a : a + 45] for a in range(0, len(rows), 45)]
    for k in range(len(files) - 1):  # rows that come late, but not too late
        behind = [r for r in files[k] if r[2] > files[k][-1][2] - 20_000]
        moved = behind[: len(behind) // 2]
        files[k + 1] = moved + files[k + 1]
        files[k] = [r for r in files[k] if r not in moved]
    for f in files[:2]:
        rng.shuffle(f)
        stream.feed(f)
    stream.run()
    early = stream.rows()
    for f in [*files[2:], CLOSE]:
        rng.shuffle(f)
        stream.feed(f)
    stream.run()
    assert 0 < len(early) < len(stream.rows())
    assert sorted(r for r in stream.rows() if r[0] != "~") == plain(spark, rows)


def test_too_late_rows_are_dropped_and_idle_sources_leave(spark):
    one = [("a", 1, 10_000, 11_000, "A", "one"), ("a", 2, 11_500, 12_000, "A", "two"), ("b", 3, 10_000, 11_000, "A", "x")]
    stream = Stream(spark, SEGMENTS, lambda s: stateful.natural_turns(s, late="10 seconds", idle_ms=60_000))
    stream.feed(one)
    stream.feed([("b", 4, 200_000, 201_000, "A", "moves the clock")])
    stream.feed([("c", 7, 210_000, 211_000, "A", "and again")])  # a batch drops what is behind the clock of the one before
    stream.feed([("a", 5, 12_500, 13_000, "A", "far too late")])
    stream.feed([("a", 6, 300_000, 301_000, "A", "back again")])
    stream.feed(CLOSE)
    stream.run()
    got = sorted(r for r in stream.rows() if r[0] != "~")
    assert got == [
        ("a", 0, 1, 300_000, 301_000, "A", "source_start", "back again"), ("a", 0, 2, 10_000, 12_000, "A", "source_start", "one two"),
        ("b", 0, 1, 10_000, 11_000, "A", "source_start", "x"), ("b", 0, 1, 200_000, 201_000, "A", "source_start", "moves the clock"),
        ("c", 0, 1, 210_000, 211_000, "A", "source_start", "and again"),
    ]


def test_a_key_is_computed_once_over_batches_and_restarts(spark):
    stream = Stream(spark, "request_id long, key string, payload string", lambda s: stateful.single_flight(s, str.upper))
    stream.feed([(1, "a", "a"), (2, "a", "a"), (3, "b", "b"), (4, None, "n")])
    stream.feed([(5, "a", "a"), (6, "c", "c"), (7, None, "n")])
    stream.run()
    stream.feed([(8, "a", "a"), (9, "c", "c"), (10, "d", "d"), (11, "d", "d")])
    stream.run()
    rows = sorted(stream.rows())
    assert [(r[0], r[2]) for r in rows] == [(k, v.upper()) for k, v in zip(range(1, 12), "aabnacnacdd")]
    assert sorted(str(r[1]) for r in rows if r[3]) == ["None", "a", "b", "c", "d"]


def test_a_result_expires_by_the_clock(spark):
    clock = lambda s: s.withColumn("ts", F.timestamp_seconds("at"))
    stream = Stream(spark, "request_id long, key string, payload string, at long", lambda s: stateful.single_flight(clock(s), str.upper, expiry_ms=60_000, late="1 second"))
    for k, (key, at) in enumerate([("a", 100), ("a", 150), ("b", 200), ("a", 201), ("a", 202)]):
        stream.feed([(k, key, key, at)])
    stream.run()
    assert [r[3] for r in sorted(stream.rows())] == [True, False, True, True, False]


class Store:
    """A state of a processor's handle, or the handle itself, that counts its calls."""

    def __init__(self):
        self.rows, self.calls, self.states = [], 0, {}

    def getListState(self, name, schema):
        return self.states.setdefault(name, Store())

    getValueState = getListState

    def listTimers(self):
        return iter(())

    def registerTimer(self, at):
        self.calls += 1

    def exists(self):
        return bool(self.rows)

    def appendValue(self, row):
        self.calls += 1
        self.rows.append(row)

    def update(self, row):
        self.calls += 1
        self.rows = [row]

    def clear(self):
        self.calls += 1
        self.rows = []


class Lists(Store):
    def get(self):
        return iter(self.rows)

    def appendList(self, rows):
        self.calls += 1
        self.rows += rows


class Value(Store):
    def get(self):
        return self.rows[0] if self.rows else None


class Clock:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at

    getExpiryTimeInMs = getCurrentWatermarkInMs


def test_turns_that_end_where_they_begin_do_not_meet_the_store():
    handle = Store()
    handle.states = {"waiting": Lists(), "texts": Lists(), "open": Value(), "last": Value()}
    rule = stateful._NaturalTurns(45_000, 800, 2_500, 86_400_000)
    rule.init(handle)
    row = stateful.Row("start_ms", "segment_id", "end_ms", "speaker", "text", "terminal", "fragment")
    list(rule.handleInputRows(("s",), iter([row(k * 10_000, k, k * 10_000 + 100, "A", f"t{k}", True, False) for k in range(2_500)]), Clock(0)))
    out = list(rule.handleExpiredTimer(("s",), Clock(10**8), Clock(0)))
    assert [r.text for r in out] == [f"t{k}" for k in range(2_500)]
    assert sum(s.calls for s in handle.states.values()) < 10  # more than ten thousand when each turn went through the store


def test_a_key_of_many_requests_asks_the_store_once():
    handle = Store()
    handle.states = {"result": Value()}
    asked = []
    handle.states["result"].exists = lambda: asked.append(1)
    rule = stateful._SingleFlight(str.upper, None)
    rule.init(handle)
    row = stateful.Row("request_id", "key", "payload", "at")
    for first in (0, 50):
        out = list(rule.handleInputRows(("k",), iter([row(n, "k", "x", 0) for n in range(first, first + 50)]), Clock(0)))
        assert [tuple(r) for r in out] == [(n, "k", "X", n == 0) for n in range(first, first + 50)]
    assert handle.states["result"].calls == 1 and not asked
