"""Values as bytes: the public serialised forms of the store's types, for the Value fields of change events.

Numbers are big-endian; a collection is a 4-byte count and its elements, each after its 4-byte length; tuples and user
types are their fields, each after its length, -1 for null; trailing fields may be missing. Spark hands over and gets
back the types of `schema.parse_type` (a uuid is text, a time nanoseconds, a timestamp a datetime in UTC).
"""

from __future__ import annotations

import datetime as dt
import re
import struct
import uuid
from collections.abc import Callable, Mapping
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorate.functions.schema import parse_type, parse_udts, split_arguments, udt_texts

Udts = Mapping[str, list[tuple[str, str]]]
_EPOCH = dt.datetime(1970, 1, 1)
_DAY_ZERO = dt.date(1970, 1, 1)

#: Struct formats of the types of fixed width.
PACKED = {"tinyint": ">b", "smallint": ">h", "int": ">i", "bigint": ">q", "time": ">q", "float": ">f", "double": ">d", "boolean": ">?"}


def _varint(n: int) -> bytes:
    return n.to_bytes((n if n >= 0 else ~n).bit_length() // 8 + 1, "big", signed=True)


def _framed(data: bytes | None) -> bytes:
    return struct.pack(">i", -1) if data is None else struct.pack(">i", len(data)) + data


def _parts(data: bytes, at: int, count: int | None) -> list[bytes | None]:
    """`count` framed values from `at` on, or all; null for a negative length."""
    out: list[bytes | None] = []
    while at < len(data) if count is None else len(out) < count:
        (n,) = struct.unpack_from(">i", data, at)
        at += 4
        if at + max(n, 0) > len(data):
            raise ValueError("a value ends too early")
        out.append(None if n < 0 else data[at : at + n])
        at += max(n, 0)
    return out


def _shape(text: str, udts: Udts) -> tuple[str, list]:
    """(kind, arguments): the types inside a collection or tuple, the (name, type) fields of a user type."""
    text = text.strip()
    if m := re.fullmatch(r"(set|list|map|tuple|frozen)\s*<(.*)>", text, re.I | re.S):
        inner = split_arguments(m[2])
        return _shape(inner[0], udts) if m[1].lower() == "frozen" else (m[1].lower(), inner)
    name = text.strip('"') if text.startswith('"') else text.lower()
    if (own := name.rpartition(".")[2]) in udts:
        return "udt", list(udts[own])
    return name, []


def encode(value, type_text: str, udts: Udts | None = None) -> bytes | None:
    if value is None:
        return None
    kind, args = _shape(type_text, udts or {})
    if kind in PACKED:
        return struct.pack(PACKED[kind], value)
    if kind in ("text", "varchar", "ascii"):
        return value.encode("ascii" if kind == "ascii" else "utf-8")
    if kind in ("blob", "inet"):
        return bytes(value)
    if kind in ("uuid", "timeuuid"):
        return uuid.UUID(value).bytes
    if kind == "timestamp":
        naive = value.astimezone(dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value
        return struct.pack(">q", (naive - _EPOCH) // dt.timedelta(milliseconds=1))
    if kind == "date":
        return struct.pack(">I", (value - _DAY_ZERO).days + (1 << 31))
    if kind == "varint":
        return _varint(int(value))
    if kind == "decimal":
        sign, digits, exponent = Decimal(value).as_tuple()
        return struct.pack(">i", -exponent) + _varint(int("".join(map(str, digits))) * (-1 if sign else 1))
    if kind in ("set", "list"):
        return struct.pack(">i", len(value)) + b"".join(_framed(encode(v, args[0], udts)) for v in value)
    if kind == "map":
        return struct.pack(">i", len(value)) + b"".join(_framed(encode(x, t, udts)) for kv in value.items() for x, t in zip(kv, args))
    if kind == "tuple":
        return b"".join(_framed(encode(v, t, udts)) for v, t in zip(value, args))
    if kind == "udt":
        field = value.get if isinstance(value, Mapping) else lambda n: getattr(value, n)
        return b"".join(_framed(encode(field(n), t, udts)) for n, t in args)
    raise ValueError(f"type {type_text} can't be written")


def decode(data: bytes | None, type_text: str, udts: Udts | None = None):
    """The value of serialised bytes; collections as list or dict, tuples as tuple, user types as dict."""
    if data is None:
        return None
    data = bytes(data)
    kind, args = _shape(type_text, udts or {})
    if kind in ("text", "varchar", "ascii"):
        return data.decode("utf-8")
    if kind in ("blob", "inet"):
        return data
    if not data and kind not in ("tuple", "udt"):
        return None  # an empty value of a type that has none
    if kind in PACKED:
        return struct.unpack(PACKED[kind], data)[0]
    if kind in ("uuid", "timeuuid"):
        return str(uuid.UUID(bytes=data))
    if kind == "timestamp":
        return _EPOCH + dt.timedelta(milliseconds=struct.unpack(">q", data)[0])
    if kind == "date":
        return _DAY_ZERO + dt.timedelta(days=struct.unpack(">I", data)[0] - (1 << 31))
    if kind == "varint":
        return Decimal(int.from_bytes(data, "big", signed=True))
    if kind == "decimal":
        n = int.from_bytes(data[4:], "big", signed=True)
        return Decimal((n < 0, tuple(map(int, str(abs(n)))), -struct.unpack_from(">i", data)[0]))
    if kind in ("set", "list", "map"):
        (n,) = struct.unpack_from(">i", data)
        types = args if kind == "map" else args[:1]
        flat = [decode(x, types[i % len(types)], udts) for i, x in enumerate(_parts(data, 4, n * len(types)))]
        return dict(zip(flat[::2], flat[1::2])) if kind == "map" else flat
    if kind in ("tuple", "udt"):
        types = args if kind == "tuple" else [t for _, t in args]
        own = [decode(x, t, udts) for x, t in zip(_parts(data, 0, None), types)]
        own += [None] * (len(types) - len(own))
        return tuple(own) if kind == "tuple" else {n: v for (n, _), v in zip(args, own)}
    raise ValueError(f"type {type_text} can't be read")


def _column(type_text: str, udts: list[str], out, one: Callable) -> Callable[[Column], Column]:
    fields = udt_fields(udts)

    @F.pandas_udf(out)
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([one(v, type_text, fields) for v in values], dtype=object)

    return run


def udt_fields(statements: list[str]) -> dict[str, list[tuple[str, str]]]:
    """Names and type texts of the fields of CREATE TYPE statements."""
    parse_udts(statements)  # an unresolved or unknown type is an error here
    return udt_texts(statements)


def decoder(type_text: str, udts: list[str] | None = None) -> Callable[[Column], Column]:
    """An Arrow-batched function of a binary column; numbers and text need none: see `decode_native`."""
    return _column(type_text, udts or [], parse_type(type_text, parse_udts(udts or [])), decode)


def encoder(type_text: str, udts: list[str] | None = None) -> Callable[[Column], Column]:
    """An Arrow-batched function that gives a column's bytes, for types that `encode_native` hasn't."""
    return _column(type_text, udts or [], T.BinaryType(), encode)


def encode_native(value: Column, type_text: str) -> Column | None:
    """Bytes of a value inside the JVM, for the types that Spark's functions can write; None for the others."""
    width = {"tinyint": 2, "smallint": 4, "int": 8, "bigint": 16, "time": 16}.get(type_text.lower())
    if width:
        return F.unhex(F.right(F.lpad(F.hex(value.cast("long")), 16, "0"), F.lit(width)))
    if type_text.lower() in ("text", "varchar", "ascii", "blob", "inet"):
        return value.cast("binary")
    if type_text.lower() == "boolean":
        return F.unhex(F.when(value, "01").when(~value, "00"))
    if type_text.lower() in ("uuid", "timeuuid"):
        return F.unhex(F.translate(value, "-", ""))
    return None


def decode_native(data: Column, type_text: str) -> Column | None:
    """The value of bytes inside the JVM, for the types that Spark's functions can read; None for the others."""
    kind = type_text.lower()
    digits = {"tinyint": 2, "smallint": 4, "int": 8, "bigint": 16, "time": 16}.get(kind)
    if digits:
        sign = F.when(F.substring(F.hex(data), 1, 1) >= "8", "F").otherwise("0")
        wide = F.concat(F.repeat(sign, F.lit(16 - digits)), F.hex(data))
        return F.when(F.octet_length(data) == digits // 2, F.conv(wide, 16, -10).cast(parse_type(kind)))
    if kind in ("text", "varchar", "ascii"):
        return data.cast("string")
    return data if kind in ("blob", "inet") else None
