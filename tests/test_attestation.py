"""Self-identification, enrolments and corroborated findings, case by case and against a plain version."""

import re

import pytest
from pyspark.sql import functions as F

from colloquy.operators import attestation as A

TEXTS = [
    ("Hi, I'm Robin", ["robin"]), ("i am a robin", ["robin"]), ("My name is  Sam and this is Robin", ["robin", "sam"]), ("Robin here!", ["robin"]), ("I'm Robin's friend", []),
    ("pretend I'm Robin", []), ("you can call   i'm robin", []), ("don't pretend, I'm Robin", ["robin"]), ("they said like robin here", []), ("Pretend I'm Robin. Really, I'm Robin", ["robin"]),
    ("robins here", []), ("I'm a.b", ["a.b"]), ("I'm axb", []), ("", []), (None, []), ("hey guys, I'm sam", ["sam"]), ("i’m sam", ["sam"]),
]


def test_self_identified(spark):
    names = ["robin", "sam", "a.b", "sam", None, ""]
    frame = spark.createDataFrame([(k, t, names) for k, (t, _) in enumerate(TEXTS)], "k long, text string, names array<string>")
    got = {r.k: r.found for r in frame.select("k", A.self_identified(F.col("text"), F.col("names")).alias("found")).collect()}
    for k, (text, want) in enumerate(TEXTS):
        assert got[k] == want, text
    nobody = spark.createDataFrame([("I'm Robin", None)], "text string, names array<string>").select(A.self_identified(F.col("text"), F.col("names")).alias("f")).first().f
    assert nobody == []


GOOD = {
    "complete": True, "start": 1.0, "end": 3.5, "duration": 2.5, "overlap": "NO_OVERLAP_CONFIRMED", "checksum": "a" * 64, "status": "CONFIRMED_TARGET", "method": "MULTI_EVIDENCE_CONSENSUS", "synthetic": False,
    "published": True, "decisions": ["SUPPORTS_CONFIRMATION"], "domains": ["CLEAN_SINGLE_SPEAKER", "SOURCE_PROVENANCE", "EXISTING_IDENTITY_AUTHORITY"], "boundary_clear": True, "conflict": False, "collision": None,
}
E = "complete boolean, start double, end double, duration double, overlap string, checksum string, status string, method string, synthetic boolean, published boolean, decisions array<string>, domains array<string>, boundary_clear boolean, conflict boolean, collision boolean"


@pytest.mark.parametrize(
    "change, errors",
    [
        ({}, []), ({"duration": 2.4}, ["DURATION_MISMATCH"]), ({"end": None}, ["DURATION_MISMATCH"]), ({"overlap": "OVERLAP"}, ["UNRESOLVED_OVERLAP"]), ({"overlap": "OVERLAP", "status": "PENDING"}, []),
        ({"checksum": "abc"}, ["CHECKSUM_LENGTH"]), ({"decisions": ["SUPPORTS_CONFIRMATION", "INCONCLUSIVE"]}, ["EVIDENCE_AGAINST"]), ({"domains": ["SOURCE_PROVENANCE"]}, ["NOT_INDEPENDENT"]),
        ({"method": "HUMAN_GOLD"}, ["NO_GOLD_EVIDENCE"]), ({"method": "HUMAN_GOLD", "domains": ["HUMAN_GOLD"]}, []), ({"method": "GUESS"}, ["UNSUPPORTED_METHOD"]), ({"synthetic": True}, ["REAL_MARKED_SYNTHETIC"]),
        ({"method": "SYNTHETIC_FIXTURE"}, ["FIXTURE_IN_USE"]), ({"method": "SYNTHETIC_FIXTURE", "synthetic": True, "published": False}, []), ({"conflict": True, "complete": False}, ["INCOMPLETE_PROVENANCE", "UNCLEAR_IDENTITY"]),
    ],
)
def test_enrolments(spark, change, errors):
    frame = spark.createDataFrame([(GOOD | change,)], f"e struct<{E.replace(' ', ':').replace(',:', ',')}>")
    assert frame.select(A.enrolment_errors(F.col("e")).alias("x")).first().x == errors


def plain(finding, verified, category, evidence, messages, topology):
    if not finding or not verified:
        return None
    category = re.sub("[- ]", "_", category.strip().lower())
    texts = [" ".join((m[0] or "").lower().split()) for m in messages or []]
    if messages:
        history = list(zip(texts, messages, strict=True))[:-1]
        if category == "target_leakage":
            return category if len(texts[-1]) >= 4 and texts[-1] in texts[:-1] else None
        if category == "duplicate_speech":
            for j, (t, m) in enumerate(history):
                for u, o in history[:j]:
                    if len(t) >= 8 and t == u and (set(m[1]) & set(o[1]) or min(m[3], o[3]) > max(m[2], o[2])):
                        return category
            return None
        if category in ("asr_noise", "control_noise"):
            return "asr_noise" if any(t in ("redacted", "filtered") for t in texts) else None
        return category if category == "context_too_thin" and evidence.strip() else None
    return category if category in ("speaker_topology", "role_assignment") and topology == "AMBIGUOUS_BOUNDARY" else None


def test_corroborated(spark):
    talk = [
        [("Hello there you", ["a"], 0, 5), ("Well", ["b"], 5, 6), ("hello  There you", ["a"], 9, 12), ("well", ["d"], 12, 13)],
        [("Hello there you", ["a"], 0, 5), ("hello there you", ["b"], 4, 6), ("ok", ["c"], 7, 8)],
        [("Hello there you", ["a"], 0, 5), ("hello there you", ["b"], 5, 6), ("REDACTED", ["c"], 7, 8)], [("only", ["a"], 0, 1)], [(None, [], None, None)], [], None,
    ]
    kinds = ["target_leakage", "Duplicate-Speech", "control noise", "context_too_thin", "role_assignment", "other"]
    rows = [(f, v, k, e, t, s) for f, v in ((True, True), (True, False), (False, True)) for k in kinds for e in ("seen", " ") for t in talk for s in ("AMBIGUOUS_BOUNDARY", "MATCH")]
    schema = "finding boolean, verified boolean, category string, evidence string, m array<struct<text:string,turn_ids:array<string>,start:bigint,end:bigint>>, topology string"
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], f"k long, {schema}")
    got = dict(frame.select("k", A.corroborated(F.struct("finding", "verified", "category", "evidence"), F.col("m"), F.col("topology")).alias("c")).collect())
    assert got == {k: plain(*r) for k, r in enumerate(rows)}
    assert {"target_leakage", "duplicate_speech", "asr_noise", "context_too_thin", "role_assignment"} <= set(got.values())
