"""Stable identifiers, hash samples and hash splits."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_id(*parts: Column, prefix: str = "", length: int = 20) -> Column:
    """The first characters of the SHA-256 of the parts joined by |; a null part is empty text."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, length))


def hash_order(salt: str, key: Column) -> Column:
    """A fixed random-looking order of keys."""
    return F.sha2(F.concat_ws("|", F.lit(salt), key.cast("string")), 256)


def hash_bucket(key: Column, buckets: int) -> Column:
    """The first 32 bits of the key's SHA-1, modulo buckets."""
    return F.conv(F.substring(F.sha1(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % buckets


def hash_shard(key: Column, shards: int) -> Column:
    """The last 32 bits of the key's SHA-256, modulo shards: the whole number's remainder if shards is a power of two."""
    if shards & (shards - 1):
        raise ValueError("the number of shards must be a power of two")
    return F.conv(F.substring(F.sha2(key.cast("string"), 256), 57, 8), 16, 10).cast("long") % shards


def _canonical_digest(text: str | None) -> str | None:
    try:
        return hashlib.sha256(json.dumps(json.loads(text), ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    except (TypeError, ValueError):
        return None


def _digests(values: pd.Series) -> pd.Series:
    return values.map(_canonical_digest)


def canonical_json_sha256(value: Column) -> Column:
    """SHA-256 of JSON text with sorted keys and no spaces; null for what is no JSON."""
    return F.pandas_udf(_digests, "string")(value)
