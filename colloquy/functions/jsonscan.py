"""JSON found inside other text: the first object in a model's answer, and character references of pages."""

from __future__ import annotations

import html
import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_MARKS = re.compile(r'["\\{}]')
#: How an object begins: with its end, or with a key and a colon (a key of more than 200 characters is taken on trust).
_BEGINS = re.compile(r'\{\s*(?:\}|"(?:[^"\\]|\\.){0,200}(?:"\s*:|[^"]))', re.DOTALL)
#: Objects in one another beyond which none is accepted.
DEEPEST = 500
_FIRST_PART = 4096


def _matches(text: str, start: int, ends: dict[int, tuple[int, int, int] | None]) -> None:
    """From an opening brace on, where each brace outside strings closes, how deep it is and where the pass began, or None; stops where the first one closes."""
    open_, quoted, at = [], False, start
    while mark := _MARKS.search(text, at):
        at = mark.end()
        c = mark.group()
        if quoted:
            if c == "\\":
                at += 1
            elif c == '"':
                quoted = False
        elif c == '"':
            quoted = True
        elif c == "{":
            open_.append([mark.start(), 0])
            ends[mark.start()] = None
        elif c == "}":
            place, depth = open_.pop()
            ends[place] = at, depth, start
            if not open_:
                return
            open_[-1][1] = max(open_[-1][1], depth + 1)


def _fault(text: str, start: int, end: int) -> int | None:
    """None if text[start:end] is a JSON object, else the place where it stops being one; an early fault is found in the first part alone."""
    if not _BEGINS.match(text, start):
        return start
    size = _FIRST_PART
    while True:
        part = text[start : min(end, start + size)]
        try:
            json.loads(part)
        except json.JSONDecodeError as fault:
            cut = len(part) < end - start and (fault.pos > len(part) - 16 or fault.msg.startswith("Unterminated"))
            if not cut:
                return start + fault.pos
        except RecursionError:
            return end
        else:
            return None
        size *= 8


def find_object(text: str | None) -> str | None:
    """The first part of text, by where it begins, that is a JSON object, as it stands; null if there is none.

    Braces are paired in one pass that knows strings and escapes; those that such a pass took as parts of strings are paired in a pass of their own. Where an object is
    faulty, so are all objects around the fault that it holds, and they are not read again: time grows with the length of the text.
    Objects that hold others more than DEEPEST deep are none.
    """
    text = text or ""
    ends: dict[int, tuple[int, int, int] | None] = {}
    faults: dict[int, int] = {}  # the last of each pass, as passes read quotes differently
    start = text.find("{")
    while start >= 0:
        if start not in ends:
            _matches(text, start, ends)
        if ends[start] is not None:
            end, depth, reading = ends[start]
            if depth <= DEEPEST and not start < faults.get(reading, -1) < end:
                fault = _fault(text, start, end)
                if fault is None:
                    return text[start:end]
                faults[reading] = max(faults.get(reading, -1), fault)
        start = text.find("{", start + 1)
    return None


def first_json_object(text: Column) -> Column:
    """find_object() of each text, in Arrow batches."""
    return F.pandas_udf(lambda s: s.map(find_object), "string")(text)


def unescape(text: Column) -> Column:
    """Text with all of HTML's character references decoded; null stays null."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else html.unescape(x))

    return F.pandas_udf(run, "string")(text)
