"""Declared schemas: table and type statements to Spark types."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

#: Native types and their Spark types; None: known but not supported.
NATIVE = {
    "ascii": T.StringType(), "text": T.StringType(), "varchar": T.StringType(), "uuid": T.StringType(), "timeuuid": T.StringType(),
    "blob": T.BinaryType(), "inet": T.BinaryType(), "tinyint": T.ByteType(), "smallint": T.ShortType(), "int": T.IntegerType(),
    "bigint": T.LongType(), "time": T.LongType(), "boolean": T.BooleanType(), "float": T.FloatType(), "double": T.DoubleType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "decimal": T.DecimalType(38, 19), "varint": T.DecimalType(38, 0),
    "empty": None, "counter": None, "duration": None,
}
_VALUE = T.StructType([T.StructField("Name", T.StringType()), T.StructField("Type", T.StringType()), T.StructField("Value", T.BinaryType())])
_RANGE = T.StructType([T.StructField("Start", T.ArrayType(_VALUE)), T.StructField("StartInclusive", T.BooleanType()), T.StructField("End", T.ArrayType(_VALUE)), T.StructField("EndInclusive", T.BooleanType())])
#: Optional columns; those that a snapshot read may ask for come first.
FEATURES = {
    "last_modified_timestamp": T.TimestampType(),
    "operation_type": T.StringType(),
    "cell_deletion_in_complex": T.MapType(T.StringType(), T.ArrayType(T.BinaryType())),
    "range_deletion": T.ArrayType(_RANGE),
    "ttl": T.ArrayType(T.IntegerType()),
}
REQUESTABLE = ("last_modified_timestamp",)
CDC_SCHEMA = T.StructType(
    [T.StructField("Keyspace", T.StringType()), T.StructField("Table", T.StringType())]
    + [T.StructField(n, T.ArrayType(_VALUE)) for n in ("PartitionKeys", "ClusteringKeys", "StaticColumns", "ValueColumns")]
    + [T.StructField(n, t) for n, t in FEATURES.items()]
)


def split_arguments(text: str) -> list[str]:
    """Cut at commas outside angle brackets."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(text[at:i].strip())
            at = i + 1
    return [*out, text[at:].strip()]


def parse_type(text: str, udts: dict[str, T.StructType] | None = None, decimals: tuple[int, int] | None = None) -> T.DataType:
    """The Spark type of a type's text. ValueError for one that isn't known or isn't supported."""
    text = text.strip()
    m = re.fullmatch(r"(set|list|map|tuple|frozen)\s*<(.*)>", text, re.I | re.S)
    if m:
        kind = m[1].lower()
        inner = [parse_type(x, udts, decimals) for x in split_arguments(m[2])]
        if kind == "frozen":
            return inner[0]
        if kind in ("set", "list"):
            return T.ArrayType(inner[0])
        if kind == "map":
            return T.MapType(inner[0], inner[1])
        return T.StructType([T.StructField(str(i), t) for i, t in enumerate(inner)])
    name = text.strip('"') if text.startswith('"') else text.lower()
    if udts and name.rpartition(".")[2] in udts:
        return udts[name.rpartition(".")[2]]
    if NATIVE.get(name.lower()) is None:
        raise ValueError(f"type {text} isn't {'supported' if name.lower() in NATIVE else 'known'}")
    if decimals and name.lower() in ("decimal", "varint"):
        return T.DecimalType(*decimals)
    return NATIVE[name.lower()]


def udt_texts(statements: list[str]) -> dict[str, list[tuple[str, str]]]:
    """Fields (name, type text) of each CREATE TYPE statement."""
    out = {}
    for s in statements:
        m = re.match(r"\s*CREATE\s+TYPE\s+(?:IF\s+NOT\s+EXISTS\s+)?([\w.\"]+)\s*\((.*)\)\s*;?\s*$", s, re.I | re.S)
        if not m:
            raise ValueError(f"not a type statement: {s}")
        out[m[1].rpartition(".")[2].strip('"')] = [_name_and_rest(f) for f in split_arguments(m[2])]
    return out


def parse_udts(statements: list[str]) -> dict[str, T.StructType]:
    """CREATE TYPE statements in any order; a type waits until those that it uses are known."""
    waiting = list(udt_texts(statements).items())
    out: dict[str, T.StructType] = {}
    while waiting:
        left = []
        for name, fields in waiting:
            try:
                out[name] = T.StructType([T.StructField(n, parse_type(t, out)) for n, t in fields])
            except ValueError:
                left.append((name, fields))
        if len(left) == len(waiting):
            raise ValueError(f"types that can't be resolved: {[n for n, _ in left]}")
        waiting = left
    return out


def _name_and_rest(text: str) -> tuple[str, str]:
    m = re.match(r'("(?:[^"])+"|\w+)\s+(.*)$', text.strip(), re.S)
    if not m:
        raise ValueError(f"not a column: {text}")
    return m[1].strip('"') if m[1].startswith('"') else m[1].lower(), m[2].strip()


@dataclass(frozen=True)
class Field:
    name: str
    type_text: str
    type: T.DataType
    position: int
    partition_key: bool = False
    clustering_key: bool = False
    static: bool = False

    def spark(self) -> T.StructField:
        value = not (self.partition_key or self.clustering_key or self.static)
        meta = {"position": self.position, "cqlType": self.type_text, "isPartitionKey": self.partition_key, "isPrimaryKey": self.partition_key or self.clustering_key, "isClusteringKey": self.clustering_key, "isStaticColumn": self.static, "isValueColumn": value}
        return T.StructField(self.name, self.type, True, meta)


@dataclass(frozen=True)
class TableSpec:
    keyspace: str
    name: str
    fields: tuple[Field, ...]
    cdc: bool = False
    descending: tuple[str, ...] = ()
    features: tuple[str, ...] = field(default=())

    def of(self, **flags: bool) -> list[str]:
        return [f.name for f in self.fields if all(getattr(f, k) == v for k, v in flags.items())]

    @property
    def partition_keys(self) -> list[str]:
        return self.of(partition_key=True)

    @property
    def clustering_keys(self) -> list[str]:
        return self.of(clustering_key=True)

    @property
    def statics(self) -> list[str]:
        return self.of(static=True)

    @property
    def values(self) -> list[str]:
        return self.of(partition_key=False, clustering_key=False, static=False)

    def schema(self) -> T.StructType:
        return T.StructType([f.spark() for f in self.fields] + [T.StructField(n, FEATURES[n]) for n in self.features])


def parse_table(statement: str, udts: list[str] | None = None, features: tuple[str, ...] = (), decimals: dict[str, tuple[int, int]] | None = None) -> TableSpec:
    """A CREATE TABLE statement: columns in the order partition keys, clustering keys, statics, values (each by name for the last two)."""
    types = parse_udts(udts or [])
    m = re.match(r"\s*CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?(?:(\w+)\.)?(\"[^\"]+\"|\w+)\s*\((.*)\)\s*(?:WITH\s+(.*?))?;?\s*$", statement, re.I | re.S)
    if not m:
        raise ValueError("not a table statement")
    depth, parts, at, body = 0, [], 0, m[3]
    for i, c in enumerate(body):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            parts.append(body[at:i])
            at = i + 1
    parts.append(body[at:])
    columns: dict[str, tuple[str, bool]] = {}
    partition: list[str] = []
    clustering: list[str] = []
    clean = lambda x: x.strip().strip('"') if x.strip().startswith('"') else x.strip().lower()
    for p in (x.strip() for x in parts if x.strip()):
        if k := re.match(r"PRIMARY\s+KEY\s*\((.*)\)$", p, re.I | re.S):
            inner = k[1].strip()
            if inner.startswith("("):
                end = inner.index(")")
                partition, rest = [clean(x) for x in inner[1:end].split(",")], inner[end + 1 :].strip(" ,")
            else:
                first, _, rest = inner.partition(",")
                partition = [clean(first)]
            clustering = [clean(x) for x in rest.split(",") if x.strip()]
            continue
        name, rest = _name_and_rest(p)
        if rest.upper().endswith(" PRIMARY KEY"):
            partition, rest = [name], rest[: -len(" PRIMARY KEY")].strip()
        static = rest.upper().endswith(" STATIC")
        columns[name] = (rest[: -len(" STATIC")].strip() if static else rest, static)
    if not partition or any(x not in columns for x in partition + clustering):
        raise ValueError("the primary key is missing or names unknown columns")
    others = sorted(n for n in columns if n not in partition + clustering)
    order = partition + clustering + [n for n in others if columns[n][1]] + [n for n in others if not columns[n][1]]
    fields = tuple(
        Field(n, columns[n][0], parse_type(columns[n][0], types, (decimals or {}).get(n)), i, n in partition, n in clustering, columns[n][1]) for i, n in enumerate(order)
    )
    options = m[4] or ""
    descending = tuple(clean(x) for x in re.findall(r"(\"[^\"]+\"|\w+)\s+DESC", options, re.I))
    unknown = [f for f in features if f not in REQUESTABLE]
    if unknown:
        raise ValueError(f"features that a snapshot read can't give: {unknown}")
    return TableSpec((m[1] or "").lower(), clean(m[2]), fields, bool(re.search(r"cdc\s*=\s*true", options, re.I)), descending, features)


def evolved(registered: dict[str, TableSpec], declared: TableSpec) -> dict[str, TableSpec]:
    """The registry with the declared table in place of the registered one; a table that isn't registered is an error."""
    key = f"{declared.keyspace}.{declared.name}"
    if key not in registered:
        raise KeyError(f"table {key} isn't registered")
    return {**registered, key: declared}


def with_cdc(registered: dict[str, TableSpec], name: str, on: bool) -> dict[str, TableSpec]:
    """The registry with change capture of the table `keyspace.name` switched on or off; an unknown table is an error."""
    if name not in registered:
        raise KeyError(f"table {name} isn't registered")
    return {**registered, name: replace(registered[name], cdc=on)}


def cdc_tables(registered: dict[str, TableSpec]) -> list[str]:
    return sorted(n for n, spec in registered.items() if spec.cdc)
