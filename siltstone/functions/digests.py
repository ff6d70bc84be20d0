"""Keyed digests: what a secret leaves behind.

The key comes from the session setting ``siltstone.digest.key``.  Without it each
driver takes a random key, so digests compare within one run and with no other.
"""

from __future__ import annotations

import secrets
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SETTING = "siltstone.digest.key"
_BLOCK = 64


@lru_cache(maxsize=1)
def _random_key() -> bytes:
    return secrets.token_bytes(32)


def digest_key(spark: SparkSession) -> bytes:
    given = spark.conf.get(SETTING, None)
    return given.encode() if given else _random_key()


def keyed(c: Column, key: bytes) -> Column:
    """HMAC-SHA-256 in hex, of the text's UTF-8 form, in expressions alone; ``key`` has at most 64 bytes."""
    padded = key.ljust(_BLOCK, b"\0")
    if len(padded) > _BLOCK:
        raise ValueError("the digest key has more than 64 bytes")
    inner, outer = (F.lit(bytearray(b ^ x for b in padded)) for x in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(c, "UTF-8")), 256))), 256)
