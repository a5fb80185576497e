"""Stable hashing used for splits and identifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_mod100(text: Column) -> Column:
    """SHA-256 of a string as one 256-bit integer, modulo 100.

    The 64 hex digits are read as four signed 64-bit numbers; 16**16 = 2**64
    leaves 16 when divided by 100, which also corrects a negative reading.
    """
    digest = F.sha2(text, 256)
    words = [F.conv(F.substring(digest, 1 + 16 * i, 16), 16, -10).cast("bigint") for i in range(4)]
    parts = [word % 100 + F.when(word < 0, 116).otherwise(0) for word in words]
    return reduce(lambda acc, part: (acc * 16 + part) % 100, parts, F.lit(0)).cast("int")


def split_bucket(key: Column) -> Column:
    """Bucket 0..99 of a split key; a missing key hashes like the text ``nan``."""
    return sha256_mod100(F.coalesce(key.cast("string"), F.lit("nan")))


def split_label(bucket: Column, train: int = 70, val: int = 15) -> Column:
    return (
        F.when(bucket < train, F.lit("train")).when(bucket < train + val, F.lit("val")).otherwise(F.lit("test"))
    )


def source_id(uri: Column) -> Column:
    """24 hex digits derived from the URI, so a retried registration yields the same id."""
    return F.substring(F.sha2(uri, 256), 1, 24)
