"""Stable hashes: md5 buckets and md5 sort keys."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_bucket(text: Column, num_buckets: int) -> Column:
    """int(md5(text), 16) mod num_buckets, for any 1 <= num_buckets <= 2^31."""
    return digest_bucket(F.md5(text), num_buckets)


def digest_bucket(digest: Column, num_buckets: int) -> Column:
    """The remainder of a 32-digit hexadecimal number.

    A power of two only needs the last eight digits.  Otherwise the number is read as two signed
    64-bit halves; each half's own remainder is taken (2^64 more for a negative one), and the sum of
    first * 2^64 + second stays below 2^63 in remainders.
    """
    if not 1 <= num_buckets <= 1 << 31:
        raise ValueError("num_buckets must be from 1 to 2^31")
    if num_buckets & (num_buckets - 1) == 0:
        return (F.conv(F.substring(digest, 25, 8), 16, 10).cast("bigint") % F.lit(num_buckets)).cast("int")
    span = (1 << 64) % num_buckets

    def half(start: int) -> Column:
        """A half's remainder, not yet brought below num_buckets: from 1 - num_buckets to 2 * num_buckets."""
        signed = F.conv(F.substring(digest, start, 16), 16, -10).cast("bigint")
        return signed % F.lit(num_buckets) + F.when(F.substring(digest, start, 1) >= F.lit("8"), F.lit(span)).otherwise(F.lit(0))

    return F.pmod(half(1) % F.lit(num_buckets) * F.lit(span) + half(17), F.lit(num_buckets)).cast("int")


def md5_buckets(num_buckets: int) -> Callable[[list[bytes]], np.ndarray]:
    """``md5_bucket`` for many words within a task: each digest is read as two unsigned 64-bit halves.

    The function returned needs no module of this library where it runs.
    """
    if not 1 <= num_buckets <= 1 << 31:
        raise ValueError("num_buckets must be from 1 to 2^31")
    span = (1 << 64) % num_buckets

    def buckets(words):
        digests = b"".join([hashlib.md5(w).digest() for w in words])
        halves = np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 2) % num_buckets
        return ((halves[:, 0] * span + halves[:, 1]) % num_buckets).astype(np.int64)

    return buckets


def md5_unit(key: Column, seed: int | str) -> Column:
    """A stable pseudo-random integer in [0, 2^32) from seed and key (for splits and samples)."""
    s = F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")
