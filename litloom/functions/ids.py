"""Deterministic identifiers, as columns."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The name space of DNS names in RFC 9562. Fixed value.
DNS = "6ba7b8109dad11d180b400c04fd430c8"


def uuid5(name: Column, space: str = DNS) -> Column:
    """The version-5 UUID of a name."""
    h = F.sha1(F.concat(F.unhex(F.lit(space)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def section_id(doc: Column, title: Column) -> Column:
    return F.substring(F.sha2(F.concat(doc, F.lit(":"), F.lower(F.trim(title))), 256), 1, 16)


def checkpoint_key(space: str, *parts: Column) -> Column:
    return F.concat_ws(":", F.lit(space), *(F.trim(p) for p in parts))


def checkpoint_key_of(source: Column, name: Column, etag: Column) -> Column:
    """The key of an inventory row: source, name and etag, which may be empty."""
    return F.concat_ws(":", source, name, F.coalesce(etag, F.lit("")))


def shard(token: Column, shards: int) -> Column:
    """The shard of a token: the first 8 bytes of its BLAKE2b digest, big-endian, modulo the number of shards."""
    if shards <= 1:
        return F.lit(0)

    @F.pandas_udf("int")
    def of(tokens: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "big") % shards for t in tokens], dtype="Int32")

    return of(token)


def shard_names(base: str, shards: int, pattern: str = "{base}_shard_{shard}") -> list[str]:
    """Names of the shards of a collection; one shard is the collection itself."""
    if shards <= 1:
        return [base]
    pattern = pattern if "{base}" in pattern else "{base}_" + pattern
    pattern = pattern if "{shard}" in pattern else pattern + "_{shard}"
    return [pattern.format(base=base, shard=i) for i in range(shards)]


def routing_token(doc_id: Column, checkpoint: Column, position: Column) -> Column:
    """The document a point belongs to, or its place in its batch if it names none."""
    return F.coalesce(F.nullif(F.trim(doc_id), F.lit("")), F.concat(F.coalesce(checkpoint, F.lit("pmc_s3")), F.lit(":"), position.cast("string")))
