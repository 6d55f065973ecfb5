"""Partition keys as bytes and their tokens.

Tokens of int and bigint keys are JVM expressions. Spark's arithmetic may raise on overflow, so 64-bit products and sums
modulo 2^64 are put together from halves whose products fit. Tokens of keys of any bytes take a vectorised Arrow function.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_M = (1 << 64) - 1


def int_bytes(value: Column) -> Column:
    """A 4-byte big-endian int."""
    return F.unhex(F.lpad(F.right(F.hex(value.cast("long")), F.lit(8)), 8, "0"))


def long_bytes(value: Column) -> Column:
    return F.unhex(F.lpad(F.hex(value.cast("long")), 16, "0"))


def text_bytes(value: Column) -> Column:
    return value.cast("binary")


def composite_key(*parts: Column) -> Column:
    """Several key columns as bytes: each with its length before it and a zero byte after it. One column: its bytes."""
    if len(parts) == 1:
        return parts[0]
    framed = []
    for p in parts:
        framed += [F.unhex(F.lpad(F.hex(F.octet_length(p).cast("long")), 4, "0")), p, F.unhex(F.lit("00"))]
    return F.concat(*framed)


def random_token_hex(key: Column) -> Column:
    """The absolute value of the MD5 read as a signed 128-bit number, as 32 hex digits: its order is the tokens' order."""
    digest = F.md5(key)
    inverted = F.translate(digest, "0123456789abcdef", "fedcba9876543210")
    # minus x is the complement plus one, done on two halves because no Spark number holds 128 bits
    low = F.substring(inverted, 17, 16)
    high = F.substring(inverted, 1, 16)
    carry = low == "f" * 16
    low_up = F.when(carry, F.lit("0" * 16)).otherwise(_plus_one(low))
    high_up = F.when(carry, _plus_one(high)).otherwise(high)
    return F.when(F.substring(digest, 1, 1) < "8", digest).otherwise(F.concat(high_up, low_up))


def _plus_one(hex16: Column) -> Column:
    """16 hex digits plus one, where they aren't all f: the trailing fs become 0, the digit before them grows."""
    tail = F.regexp_extract(hex16, "(f*)$", 1)
    n = F.length(tail)
    digit = F.substring(hex16, F.lit(16) - n, F.lit(1))
    return F.concat(F.substring(hex16, F.lit(1), F.lit(15) - n), F.translate(digit, "0123456789abcde", "123456789abcdef"), F.repeat(F.lit("0"), n))


def murmur3_token(data: bytes) -> int:
    """The first 64 bits of the store's 128-bit Murmur3, whose tail bytes count as signed; never the least long."""

    def rotl(x: int, r: int) -> int:
        return (x << r | x >> (64 - r)) & _M

    def fmix(k: int) -> int:
        k = (k ^ k >> 33) * 0xFF51AFD7ED558CCD & _M
        k = (k ^ k >> 33) * 0xC4CEB9FE1A85EC53 & _M
        return k ^ k >> 33

    c1, c2 = 0x87C37B91114253D5, 0x4CF5AD432745937F
    h1 = h2 = 0
    n = len(data)
    whole = n // 16 * 16
    for i in range(0, whole, 16):
        k1, k2 = int.from_bytes(data[i : i + 8], "little"), int.from_bytes(data[i + 8 : i + 16], "little")
        h1 ^= rotl(k1 * c1 & _M, 31) * c2 & _M
        h1 = ((rotl(h1, 27) + h2) * 5 + 0x52DCE729) & _M
        h2 ^= rotl(k2 * c2 & _M, 33) * c1 & _M
        h2 = ((rotl(h2, 31) + h1) * 5 + 0x38495AB5) & _M
    signed = [b - 256 if b > 127 else b for b in data[whole:]]
    k1 = k2 = 0
    for i, b in enumerate(signed):
        if i < 8:
            k1 ^= (b << 8 * i) & _M
        else:
            k2 ^= (b << 8 * (i - 8)) & _M
    if len(signed) > 8:
        h2 ^= rotl(k2 * c2 & _M, 33) * c1 & _M
    if signed:
        h1 ^= rotl(k1 * c1 & _M, 31) * c2 & _M
    h1, h2 = h1 ^ n, h2 ^ n
    h1 = h1 + h2 & _M
    h2 = h2 + h1 & _M
    h1, h2 = fmix(h1), fmix(h2)
    token = h1 + h2 & _M
    token = token - (1 << 64) if token >> 63 else token
    return (1 << 63) - 1 if token == -(1 << 63) else token


_LOW = (1 << 32) - 1


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shifted(x: Column, n: int) -> Column:
    """Shifted right, zeros moving in."""
    return F.shiftrightunsigned(x, n)


def _plus(x: Column, y: Column) -> Column:
    """x + y modulo 2^64."""

    def both(p: Column) -> Column:
        low = p["x"].bitwiseAND(F.lit(_LOW)) + p["y"].bitwiseAND(F.lit(_LOW))
        return _let(low, lambda s: F.shiftleft(_shifted(p["x"], 32) + _shifted(p["y"], 32) + _shifted(s, 32), 32).bitwiseOR(s.bitwiseAND(F.lit(_LOW))))

    return _let(F.struct(x.alias("x"), y.alias("y")), both)


def _times(x: Column, c: int) -> Column:
    """x times a constant modulo 2^64; no product of a 32-bit and a 16-bit number overflows."""
    parts = [c >> 16 * i & 0xFFFF for i in range(4)]

    def product(halves: Column) -> Column:
        low, high = halves["l"], halves["h"]
        upper = low * parts[2] + F.shiftleft((low * parts[3]).bitwiseAND(F.lit(0xFFFF)), 16) + high * parts[0] + F.shiftleft((high * parts[1]).bitwiseAND(F.lit(0xFFFF)), 16)
        return _plus(_plus(low * parts[0], F.shiftleft(low * parts[1], 16)), F.shiftleft(upper, 32))

    return _let(F.struct(x.bitwiseAND(F.lit(_LOW)).alias("l"), _shifted(x, 32).alias("h")), product)


def _rotated(x: Column, n: int) -> Column:
    return F.shiftleft(x, n).bitwiseOR(_shifted(x, 64 - n))


def _mixed(x: Column) -> Column:
    """The finaliser of the hash."""
    fold = lambda k: k.bitwiseXOR(_shifted(k, 33))
    once = _let(x, lambda k: _times(fold(k), 0xFF51AFD7ED558CCD))
    return _let(_let(once, lambda k: _times(fold(k), 0xC4CEB9FE1A85EC53)), fold)


def _token_of_tail(tail: Column, width: int) -> Column:
    """The token of a key of `width` bytes, at most 8, that are packed in `tail`."""
    k1 = _let(_times(tail, 0x87C37B91114253D5), lambda k: _times(_rotated(k, 31), 0x4CF5AD432745937F))
    first = _let(k1, lambda k: _plus(k.bitwiseXOR(F.lit(width).cast("long")), F.lit(width).cast("long")))
    token = _let(first, lambda h1: _plus(_mixed(h1), _mixed(_plus(h1, F.lit(width).cast("long")))))
    return _let(token, lambda t: F.when(t == F.lit(-(2**63)), F.lit(2**63 - 1)).otherwise(t))


def _tail(key: Column, width: int) -> Column:
    """The key's big-endian bytes, each as a signed number, from the lowest place up."""
    out = None
    for i in range(width):
        byte = F.shiftright(key, 8 * (width - 1 - i)).bitwiseAND(F.lit(255).cast("long")).bitwiseXOR(F.lit(128).cast("long")) - 128
        byte = F.shiftleft(byte, 8 * i) if i else byte
        out = byte if out is None else out.bitwiseXOR(byte)
    return out


def _int_token(key: Column, width: int) -> Column:
    token = _let(key.cast("long"), lambda k: _token_of_tail(_tail(k, width), width))
    return F.when(key.isNotNull(), token)


def murmur3_bigint(key: str | Column) -> Column:
    """Token of a bigint key; null for null."""
    return _int_token(F.col(key) if isinstance(key, str) else key, 8)


def murmur3_int(key: str | Column) -> Column:
    """Token of an int key; null for null."""
    return _int_token(F.col(key) if isinstance(key, str) else key, 4)


def _tokens(keys: list[bytes]) -> np.ndarray:
    """Tokens of keys of any lengths, keys of one length at once."""
    u = np.uint64
    out = np.zeros(len(keys), np.int64)
    sizes = np.array([len(k) for k in keys])
    rotl = lambda v, r: v << u(r) | v >> u(64 - r)
    c1, c2 = u(0x87C37B91114253D5), u(0x4CF5AD432745937F)

    def fmix(k):
        k = (k ^ k >> u(33)) * u(0xFF51AFD7ED558CCD)
        k = (k ^ k >> u(33)) * u(0xC4CEB9FE1A85EC53)
        return k ^ k >> u(33)

    with np.errstate(over="ignore"):
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            data = np.frombuffer(b"".join(keys[i] for i in at), np.uint8).reshape(len(at), size)
            whole = size // 16 * 16
            words = np.ascontiguousarray(data[:, :whole]).view("<u8").astype(u)
            h1, h2 = np.zeros(len(at), u), np.zeros(len(at), u)
            for i in range(0, words.shape[1], 2):
                h1 = h1 ^ rotl(words[:, i] * c1, 31) * c2
                h1 = (rotl(h1, 27) + h2) * u(5) + u(0x52DCE729)
                h2 = h2 ^ rotl(words[:, i + 1] * c2, 33) * c1
                h2 = (rotl(h2, 31) + h1) * u(5) + u(0x38495AB5)
            tails = [np.zeros(len(at), u), np.zeros(len(at), u)]
            for i in range(size - whole):
                tails[i // 8] ^= data[:, whole + i].view(np.int8).astype(np.int64).view(u) << u(8 * (i % 8))
            if size - whole > 8:
                h2 = h2 ^ rotl(tails[1] * c2, 33) * c1
            if size > whole:
                h1 = h1 ^ rotl(tails[0] * c1, 31) * c2
            h1, h2 = h1 ^ u(size), h2 ^ u(size)
            h1 = h1 + h2
            h2 = h2 + h1
            token = (fmix(h1) + fmix(h2)).view(np.int64)
            out[at] = np.where(token == np.iinfo(np.int64).min, np.iinfo(np.int64).max, token)
    return out


@F.pandas_udf(T.LongType())
def murmur3(key: pd.Series) -> pd.Series:
    """Token of key bytes; null for null."""
    known = key.notna().to_numpy()
    out = pd.array(np.zeros(len(key), np.int64), "Int64")
    out[known] = _tokens([bytes(k) for k in key[known]])
    out[~known] = pd.NA
    return pd.Series(out)


def in_range(token: Column, start, end, start_inclusive: bool = False, end_inclusive: bool = True) -> Column:
    lo = token >= F.lit(start) if start_inclusive else token > F.lit(start)
    hi = token <= F.lit(end) if end_inclusive else token < F.lit(end)
    return lo & hi


def bucket_of(token: Column, cuts: list[int]) -> Column:
    """How many of the ascending `cuts` lie below the token, as a search tree of conditions: log2(cuts) comparisons a row, no join."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(token <= F.lit(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(cuts))
