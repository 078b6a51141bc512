"""Row hashes that depend on values only, never on partitioning."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 1000
Hasher = Callable[..., Column]


def row_hash(key: Sequence[str], salt: str = "") -> Column:
    """First 32 bits of the md5 of the key columns joined by ``:``, as bigint.

    Any SQL engine can compute it; NULL counts as empty text.
    """
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in key]
    joined = [F.lit(salt)] if salt else []
    for part in parts:
        joined += [F.lit(":"), part] if joined else [part]
    digest = F.md5(F.concat(*joined))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def fast_row_hash(key: Sequence[str], salt: str = "") -> Column:
    """32 bits of Spark's xxhash64, an order of magnitude cheaper than ``row_hash``."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(salt), *key), 32)


def bucket_of(hashed: Column, buckets: int = BUCKETS) -> Column:
    return hashed % F.lit(buckets)
