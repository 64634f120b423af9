"""Streams with a state of their own for each key: turns merged as segments arrive, and results computed once.

The state lies in Spark's state store (set spark.sql.streaming.stateStore.providerClass to ROCKSDB), so it survives restarts and lost
executors with the checkpoint, and leaves the store by event time or age.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from colloquy.operators import turns

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep the states of streams that start from now on in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


TURNS = "source_id string, turn long, segments long, start_ms long, end_ms long, speaker string, turn_boundary string, text string"
_TURN = Row(*(c.split()[0] for c in TURNS.split(", ")))
_WAITING = ("start_ms", "segment_id", "end_ms", "speaker", "text", "terminal", "fragment")
_CHUNK = 1_000  # segments of one entry, as JSON: an entry of its own for each would cost more than all the rest
_OPEN = "turn long, segments long, start_ms long, end_ms long, speaker string, reason string"
_LAST = "turn long, start_ms long, end_ms long, speaker string, terminal boolean"


class _NaturalTurns(StatefulProcessor):
    """Of a source: segments that wait for the watermark, the open turn with its texts, and the last segment that was taken."""

    def __init__(self, max_ms: int, tight_ms: int, pause_ms: int, idle_ms: int):
        self.max_ms, self.tight_ms, self.pause_ms, self.idle_ms = max_ms, tight_ms, pause_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "segments string")
        self.open = handle.getValueState("open", _OPEN)
        self.texts = handle.getListState("texts", "text string")
        self.last = handle.getValueState("last", _LAST)

    def _wake(self, at: int, fired: int | None = None) -> None:
        """One timer a source, at the earliest time that is asked for; fired is the one that has gone off and is still listed."""
        for timer in [t for t in self.handle.listTimers() if t != fired]:
            if timer <= at:
                return
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(at)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first = None
        while new := [tuple(row[c] for c in _WAITING) for row in islice(rows, _CHUNK)]:
            self.waiting.appendValue((json.dumps(new),))
            earliest = min(r[0] for r in new)
            first = earliest if first is None else min(first, earliest)
        if first is not None:
            self._wake(first)
        yield from ()

    def _reason(self, last: tuple | None, row: tuple) -> str:
        start, _, end, speaker, _, _, fragment = row
        if last is None:
            return "source_start"
        _, last_start, last_end, last_speaker, terminal = last
        gap = max(0, start - last_end)
        if last_speaker != speaker:
            return "speaker_change"
        if end - last_start > self.max_ms:
            return "length_limit"
        if gap <= self.tight_ms:
            return "asr_fragment_merge"
        return "same_speaker_adaptive_pause" if gap <= self.pause_ms and (not terminal or fragment) else "pause_and_punctuation"

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Take what the watermark has passed. A turn that begins and ends here never meets the store: each call of it is a message to the JVM."""
        now, fired = timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()
        rows = sorted(tuple(r) for (chunk,) in self.waiting.get() for r in json.loads(chunk)) if self.waiting.exists() else []
        ready, wait = [r for r in rows if r[0] <= now], [r for r in rows if r[0] > now]
        last, unit = self.last.get(), self.open.get()
        stored = unit is not None  # its texts, too, lie in the store; those of texts come after them
        unit, texts, done = list(unit or ()), [], []

        def close() -> None:
            before = [t for (t,) in self.texts.get()] if stored else []
            done.append(_TURN(key[0], *unit, " ".join(before + texts)))

        for row in ready:
            start, _, end, speaker, text, terminal, _ = row
            last = None if last and start - last[2] > self.idle_ms else last
            reason = self._reason(last, row)
            if unit and reason in ("asr_fragment_merge", "same_speaker_adaptive_pause"):
                unit[1], unit[3] = unit[1] + 1, max(unit[3], end)
                texts.append(text)
            else:
                if unit:
                    close()
                    if stored:
                        self.texts.clear()
                        self.open.clear()
                        stored = False
                unit, texts = [last[0] + 1 if last else 0, 1, start, end, speaker, reason], [text]
            last = (unit[0], start, end, speaker, bool(terminal))
        if unit and not wait and now > last[2] + self.pause_ms:  # what comes now begins after the longest pause
            close()
            if stored:
                self.texts.clear()
                self.open.clear()
            unit = None
        elif unit and texts:
            self.open.update(tuple(unit))
            self.texts.appendList([(t,) for t in texts])
        if ready:
            self.waiting.clear()
            for at in range(0, len(wait), _CHUNK):
                self.waiting.appendValue((json.dumps(wait[at : at + _CHUNK]),))
            self.last.update(last)
        if wait:
            self._wake(wait[0][0], fired)
        elif unit:
            self._wake(last[2] + self.pause_ms + 1, fired)
        elif last and now <= last[2] + self.idle_ms:
            self._wake(last[2] + self.idle_ms + 1, fired)
        else:
            self.last.clear()
        yield from done

    def close(self) -> None:
        pass


def natural_turns(segments: DataFrame, late: str = "1 minute", max_ms: int = 45_000, tight_ms: int = 800, pause_ms: int = 2_500, idle_ms: int = 86_400_000) -> DataFrame:
    """The turns of operators.turns.natural_turns() over a stream of segments, each as soon as nothing more can join it.

    segments: source_id, segment_id (long), start_ms (since the epoch), end_ms, speaker, text, none of them null. Rows may come in any order within late; rows later than that are dropped, from the batch after on. A
    segment waits until the watermark has passed its start, so that a source is read in order of start_ms and segment_id whatever the order of
    arrival. Of a source the store holds the segments behind the watermark, the open turn and the last segment; a source that pauses for
    more than idle_ms leaves it, and begins at turn 0 when it comes back. Needs use_rocksdb(); output mode append.
    """
    rows = segments.select(
        F.timestamp_millis("start_ms").alias("ts"), "source_id", "start_ms", F.col("segment_id").cast("long").alias("segment_id"), "end_ms", "speaker", "text",
        turns.ends_sentence(F.col("text")).alias("terminal"), turns.is_fragment(F.col("text")).alias("fragment"),
    )
    rule = _NaturalTurns(max_ms, tight_ms, pause_ms, idle_ms)
    return rows.withWatermark("ts", late).groupBy("source_id").transformWithState(rule, outputStructType=TURNS, outputMode="Append", timeMode="EventTime")


ANSWERS = "request_id long, key string, value string, computed boolean"
_ANSWER = Row(*(c.split()[0] for c in ANSWERS.split(", ")))


class _SingleFlight(StatefulProcessor):
    """The result of a key, until the clock passes its request's time by expiry_ms."""

    def __init__(self, compute: Callable[[str], str], expiry_ms: int | None):
        self.compute, self.expiry_ms = compute, expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.result = handle.getValueState("result", "value string, until long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        found = self.result.get()
        value, until = found or (None, None)
        known = found is not None and (until is None or timerValues.getCurrentWatermarkInMs() <= until)
        for row in rows:
            computed = not known
            if computed:
                value, known = self.compute(row["payload"]), True
                until = None if self.expiry_ms is None else row["at"] + self.expiry_ms
                self.result.update((value, until))
                if until is not None:
                    self.handle.registerTimer(until + 1)
            yield _ANSWER(row["request_id"], key[0], value, computed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.result.exists() and self.result.get()[1] < timerValues.getCurrentWatermarkInMs():  # else computed anew since
            self.result.clear()
        yield from ()

    def close(self) -> None:
        pass


def single_flight(requests: DataFrame, compute: Callable[[str], str], expiry_ms: int | None = None, late: str = "1 minute") -> DataFrame:
    """(request_id, key, value, computed): a stream of requests (request_id long, key, payload), each answered by compute(payload).

    Requests of a key meet in one place, so that a key is computed once: whether it is repeated within a batch, in a
    later one or after a restart, its value comes from the state store. Keys stand for payloads: of a key's rows the first payload counts. A null
    key is a key. With expiry_ms the requests have a timestamp ts: a value leaves the store when the watermark has passed the time of the request that it was computed for by
    so much, and requests later than late are dropped. Needs use_rocksdb(); output mode append.
    """
    at = F.lit(0).cast("long") if expiry_ms is None else F.unix_millis("ts")
    mode = "None" if expiry_ms is None else "EventTime"
    rows = requests if expiry_ms is None else requests.withWatermark("ts", late)
    rows = rows.select(F.col("request_id").cast("long").alias("request_id"), "key", "payload", at.alias("at"), *(["ts"] if expiry_ms is not None else []))
    return rows.groupBy("key").transformWithState(_SingleFlight(compute, expiry_ms), outputStructType=ANSWERS, outputMode="Append", timeMode=mode)
