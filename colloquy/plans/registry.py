"""All registered queries of the library and their oracle SQL."""

from __future__ import annotations

from colloquy.plans import (  # noqa: F401
    aggregates, attestation, dedup, evidence, graphs, joins, names, recovery, reviews, samples, scans, sinks, states, streams, texts, topology, turns, validators, vectors, windows,
)
from colloquy.plans.base import ORACLES, QUERIES  # noqa: F401
