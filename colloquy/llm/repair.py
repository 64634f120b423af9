"""Repair of the turn structure of conversations by a dynamic programme over sorted streams.

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``: nothing, or pairs of user
and assistant turns after at most one system turn. ``repair_conversations`` finds the cheapest edits that make one so.
Rows are dealt by conversation and sorted by turn inside the partition; ``mapInPandas`` reads the sorted rows batch by
batch and carries the programme's state - four states of the pattern, each with its cost, its place in the order of audits and a
running digest of the text repaired so far - from batch to batch, so that a conversation never has to fit a batch or
the memory. What is kept of a row are four bytes that say which way each state was reached; for giant conversations
they go to a file of the task's own, which is gone with the task.

Edits of a row: K keeps it, R gives it the role that the pattern asks for, D deletes it; I inserts an empty turn. Of equally cheap
repairs the one whose letters are least in ASCII counts.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

#: Backpointers of one conversation that are held in memory, in bytes (four a row).
HELD_BYTES = 1 << 22

#: States of the pattern: nothing yet, after the system turn, after a user turn, after an assistant turn.
STATES = 4
_ENDS = (0, 3)
_ASKED = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

FAULTS = ("", "blank", "duplicate", "truncated")


def _inserted(state: int, n: int) -> int:
    for _ in range(n):
        state = _ASKED[state][1]
    return state


def _ways(initial: str, fault: str) -> list[tuple[int, int, int, str, int]]:
    """(from, to, cost, letters, inserted) for a row, the best for each from and to; more than two inserts only go round."""
    best: dict[tuple[int, int], tuple[int, str, int]] = {}
    extra = TRUNCATED if fault == "truncated" else 0
    for start in range(STATES):
        for n in range(3):
            at = _inserted(start, n)
            ends = [("D", at, DELETE)]
            if fault not in ("blank", "duplicate"):
                ends.append(("R", _ASKED[at][1], REROLE + extra))
                if (at, initial) in _KEPT:
                    ends.append(("K", _KEPT[at, initial], KEEP + extra))
            for letter, to, cost in ends:
                way = (cost + n * INSERT, "I" * n + letter, n)
                best[start, to] = min(best.get((start, to), way), way)
    return [(a, b, *way) for (a, b), way in sorted(best.items())]


_INITIALS = ("s", "u", "a", "")
_WAYS = {(i, f): _ways(i, f) for i in _INITIALS for f in FAULTS}
#: Letters that a way can have, by a number below 16; a backpointer is 16 * (the state before) + this number.
_LETTERS = sorted({way[3] for ways in _WAYS.values() for way in ways})
_CODE = {x: k for k, x in enumerate(_LETTERS)}


class Backpointers:
    """Four bytes a row, appended in order and read from the end; beyond HELD_BYTES they lie in a file of the task's own."""

    def __init__(self, held: int = HELD_BYTES):
        self.held, self.new, self.file, self.spilled = held, bytearray(), None, 0

    def append(self, four: bytes) -> None:
        self.new += four
        if len(self.new) >= self.held:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.new)
            self.spilled += len(self.new)
            self.new = bytearray()

    def backwards(self) -> Iterator[bytes]:
        part, end = bytes(self.new), self.spilled
        while True:
            for k in range(len(part) - STATES, -1, -STATES):
                yield part[k : k + STATES]
            if not end:
                break
            size = min(self.held - self.held % STATES or STATES, end)
            end -= size
            self.file.seek(end)
            part = self.file.read(size)
        if self.file:
            self.file.close()


class Repair:
    """The programme over one conversation: add() its rows in order, then end()."""

    def __init__(self, held: int = HELD_BYTES):
        self.costs: list[int | None] = [0, None, None, None]
        self.order = [0, 0, 0, 0]  # of the states' audits; no audit begins another one, as each ends with its row's letter
        self.digests = [hashlib.sha256(), None, None, None]
        self.back = Backpointers(held)

    def add(self, role: str, text: str, fault: str) -> None:
        best: list[tuple | None] = [None] * STATES
        initial = role[:1]
        for before, to, cost, letters, inserted in _WAYS[initial if initial in _INITIALS else "", fault]:
            if self.costs[before] is not None:
                way = (self.costs[before] + cost, self.order[before], letters, before, inserted)
                if best[to] is None or way < best[to]:
                    best[to] = way
        digests = [None if way is None else self._digest(way, role, text) for way in best]
        ranked = sorted((way[1], way[2], to) for to, way in enumerate(best) if way)
        for k, (_, _, to) in enumerate(ranked):
            self.order[to] = k
        self.costs, self.digests = [way and way[0] for way in best], digests
        self.back.append(bytes(0 if way is None else 16 * way[3] + _CODE[way[2]] for way in best))

    def _digest(self, way: tuple, role: str, text: str) -> hashlib._Hash:
        _, _, letters, state, inserted = way
        digest = self.digests[state].copy()
        for _ in range(inserted):
            new, after = _ASKED[state]
            digest.update(f"{chr(10) if state else ''}{new}:".encode())
            state = after
        if letters[-1] != "D":
            new = role if letters[-1] == "K" else _ASKED[state][0]
            digest.update(f"{chr(10) if state else ''}{new}:{text}".encode("utf-8", "replace"))
        return digest

    def end(self) -> tuple[int, str, str]:
        """Cost, audit and SHA-256 of the repaired conversation."""
        _, _, last, state = min(
            (self.costs[s] + n * INSERT, self.order[s], "I" * n, s)
            for s in range(STATES) for n in range(3) if self.costs[s] is not None and _inserted(s, n) in _ENDS
        )
        cost, digest, at = self.costs[state] + len(last) * INSERT, self.digests[state].copy(), state
        for _ in last:
            new, after = _ASKED[at]
            digest.update(f"{chr(10) if at else ''}{new}:".encode())
            at = after
        letters = [last]
        for four in self.back.backwards():
            letters.append(_LETTERS[four[state] % 16])
            state = four[state] // 16
        return cost, "".join(reversed(letters)), digest.hexdigest()


def _spoken(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): conversations with faults put in by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row (it stays as a row with gone true, so that its conversation is not lost), 1 empties the text, 2 takes
    its ``.``, ``!`` and ``?`` away, 3 repeats the row, 4 makes the role user. A null id, turn, role or text counts as one
    space in all of this; ids and turns themselves stay null. Other columns are left out.
    """
    kind = F.crc32(F.concat(_spoken("conv_id"), F.lit(":"), _spoken("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(_spoken("text"), ".!?", "")).otherwise(_spoken("text"))
    role = F.when(kind == 4, "user").otherwise(_spoken("role"))
    rows = conversations.select(
        "conv_id", "turn", F.when(kind != 0, role).alias("role"), F.when(kind != 0, text).alias("text"), (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def find_faults(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text, gone) with fault: blank, duplicate, truncated or empty text, the first that holds.

    blank: nothing but white space; duplicate: role and text occur in an earlier turn (or in a row before of one turn); truncated: the last character that
    is no white space is none of ``.!?``. The rows that repeat a text meet by conversation, role and text, so that a giant
    conversation is spread over tasks here. Rows that are gone have no fault.
    """
    last = F.regexp_extract("text", r"(?s)^.*([^\x20\x09-\x0D])", 1)
    seen = F.row_number().over(W.partitionBy("conv_id", "role", "text", "gone").orderBy(F.col("turn").asc_nulls_first()))
    fault = (
        F.when(F.col("gone"), "")
        .when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
        .when(F.col("seen") > 1, "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    return turns.withColumn("seen", seen).withColumn("fault", fault).drop("seen")


REPAIRS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_PAIRS = ("su", "ua", "au")


class _Conversation:
    """What a task carries of the conversation that it is reading."""

    def __init__(self, conv_id: str | None, held: int):
        self.conv_id, self.repair, self.faults = conv_id, Repair(held), dict.fromkeys(FAULTS, 0)
        self.first = self.turn = self.initial = None
        self.turns = self.illegal = 0

    def add(self, turn: str | None, role: str, text: str, fault: str) -> None:
        if turn is not None and (at := int(turn)) != self.turn:
            self.first, self.turn, self.turns = at if self.first is None else self.first, at, self.turns + 1
        self.illegal += self.initial is not None and self.initial + role[:1] not in _PAIRS
        self.initial = role[:1]
        self.faults[fault] += 1
        self.repair.add(role, text, fault)

    def row(self) -> tuple:
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *(self.faults[f] for f in FAULTS[1:]), self.illegal, *self.repair.end())


def repair_conversations(turns: DataFrame, held: int = HELD_BYTES) -> DataFrame:
    """One row a conversation of turns (conv_id, turn, role, text, gone, fault): its faults and its cheapest repair.

    Returns conv_id, gaps (missing turn numbers), blank, duplicate, truncated, illegal (neighbours whose initials are
    not su, ua or au), cost, audit (a letter for each edit, in order) and repaired_sha256 (of ``role:text`` lines). Rows are
    taken by turn, nulls first, rows of one turn by role and text, repeats last; a null conv_id is a conversation. A role without an initial
    can't be kept. Rows that are gone only keep their conversation; one without other rows has zeros, no audit and the digest of no text.
    Memory holds one Arrow batch and HELD_BYTES of backpointers, and the audit, one letter an edit.
    """
    kind = turns.schema["conv_id"].dataType
    dealt = (
        turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "gone", "fault")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", F.col("fault") == "duplicate")
        # As strings: pandas would make floats of whole numbers beside nulls.
        .select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("string").alias("turn"), "role", "text", "gone", "fault")
    )
    names = ["conv_id", *(x.split()[0] for x in REPAIRS.split(", "))]

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None
        for frame in frames:
            done = []
            for conv_id, turn, role, text, gone, fault in zip(*(frame[c].tolist() for c in frame.columns), strict=True):
                if now is None or now.conv_id != conv_id:
                    if now:
                        done.append(now.row())
                    now = _Conversation(conv_id, held)
                if not gone:
                    now.add(turn, role, text, fault)
            if done:
                yield pd.DataFrame(done, columns=names)
        if now:
            yield pd.DataFrame([now.row()], columns=names)

    return dealt.mapInPandas(run, f"conv_id string, {REPAIRS}").withColumn("conv_id", F.col("conv_id").cast(kind))


def repaired_turns(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """(conv_id, place, edit, turn, role, text): the repaired conversations themselves, edit by edit.

    turns and repairs as taken and given by repair_conversations. place counts edits from 0 and orders the rows; deleted rows are left out. An
    inserted turn has no turn number and empty text. The audit is dealt out as one row an edit and joined to the numbered
    rows; what R and I make of a turn follows from how many turns come after it, as the last one is the assistant's.
    """
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", F.col("fault") == "duplicate")
    numbered = turns.where(~F.col("gone")).select("conv_id", F.row_number().over(order).alias("n"), "turn", F.col("role").alias("was"), "text")
    kind = repairs.schema["conv_id"].dataType
    names = ["conv_id", "place", "edit", "n", "new"]

    def edits(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for conv_id, audit in zip(frame["conv_id"].tolist(), frame["audit"].tolist(), strict=True):
                n, after, rows = 0, len(audit) - audit.count("D"), []
                for place, letter in enumerate(audit):
                    n += letter != "I"
                    after -= letter != "D"
                    new = None if letter in "KD" else "user" if after % 2 else "assistant"
                    rows.append((conv_id, place, letter, 0 if letter == "I" else n, new))
                    if len(rows) == 10_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    dealt = repairs.select(F.col("conv_id").cast("string").alias("conv_id"), "audit").mapInPandas(edits, "conv_id string, place long, edit string, n int, new string")
    a, b = dealt.where("edit <> 'D'").withColumn("conv_id", F.col("conv_id").cast(kind)).alias("a"), numbered.alias("b")
    return a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.n") == F.col("b.n")), "left").select(
        "a.conv_id", "place", "edit", "turn", F.coalesce("new", "was").alias("role"), F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text")
    )
