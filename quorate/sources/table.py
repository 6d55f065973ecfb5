"""Reading a declared table from version files, and partition sizes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorate.functions import codec, tokens
from quorate.functions.schema import Field, TableSpec, parse_table
from quorate.operators.reconcile import Cell, last_modified, merge_cells, visible_rows, without_deletions

WRITE_TIME = "write_ts"


def strict_bool(text: str) -> bool:
    if text.strip().lower() in ("true", "1", "yes"):
        return True
    if text.strip().lower() in ("false", "0", "no"):
        return False
    raise ValueError(f"not a boolean: {text}")


def spec_from_options(options: Mapping[str, str]) -> TableSpec:
    """Options as a reader gets them (names in any case): keyspace, createStmt, udts (lines), last_modified_timestamp.

    `decimals`: precision and scale of varint and decimal columns, as `name:precision:scale`, comma-separated.
    """
    o = {k.lower(): v for k, v in options.items()}
    missing = [k for k in ("keyspace", "createstmt", "dirs") if k not in o]
    if missing:
        raise ValueError(f"options are missing: {missing}")
    features = ("last_modified_timestamp",) if strict_bool(o.get("last_modified_timestamp", "false")) else ()
    sizes = [x.strip().split(":") for x in o.get("decimals", "").split(",") if x.strip()]
    return parse_table(o["createstmt"], [u for u in o.get("udts", "").split("\n") if u.strip()], features, {name: (int(p), int(s)) for name, p, s in sizes})


def read_table(spark: SparkSession, options: Mapping[str, str], now: Column | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Current rows of a declared table whose versions lie as Parquet in `dirs` (comma-separated).

    A version has the key columns, write_ts and any of the other columns; `unset` (array of names) tells columns
    that it doesn't touch from those it deletes (null), `expires_at` its expiry. Columns of the files that the
    schema doesn't have are dropped columns and are ignored; columns that the files lack are null. Filters and
    column selection on the result reach the scan: filters on keys pass the merge, whose groups are the keys.

    Option `deletionDirs`: deletions of partitions, rows and clustering intervals (see `without_deletions`). They hide
    rows; a static value goes only with its whole partition. Unfrozen collections are merged by element where the
    files give a column's elements: see `merged_collection`. Option `writeTimeColumn` names the write time.

    `columns` reads only some value and static columns: a row is then visible if one of these is live, and always if
    none of them is a value column.

    Cells expire against `now`: the argument, else option `readTime`, else the time of the call, frozen. Option
    `expiresColumn` names the expiry.

    The schema is that of one file, with the declared columns that it lacks; so no other file's footer is read for it. Option
    `mergeSchema` reads all footers, for files of which only some have the columns that this reader adds (unset, `<name>_put`).
    """
    spec = spec_from_options(options)
    o = {k.lower(): v for k, v in options.items()}
    declared = {f.name: f.type for f in spec.fields}

    def read(key: str, more: Mapping[str, T.DataType]) -> DataFrame:
        paths = [d for d in o[key].split(",") if d]
        if strict_bool(o.get("mergeschema", "false")):
            return spark.read.option("mergeSchema", "true").parquet(*paths)
        one = spark.read.parquet(*paths).schema
        missing = [T.StructField(n, kind) for n, kind in more.items() if n not in one.names]
        return spark.read.schema(T.StructType([*one, *missing])).parquet(*paths)

    versions = read("dirs", declared)
    if "expirescolumn" in o:
        versions = versions.withColumn("expires_at", F.col(o["expirescolumn"]))
    versions = versions.withColumnRenamed(o.get("writetimecolumn", WRITE_TIME), WRITE_TIME)
    if now is None and "expires_at" in versions.columns:
        now = read_time(o.get("readtime")).cast(versions.schema["expires_at"].dataType)
    wanted = lambda names: [n for n in names if columns is None or n in columns]
    values, statics = wanted(spec.values), wanted(spec.statics)
    have = set(versions.columns)
    keys = spec.partition_keys + spec.clustering_keys
    for_statics = versions
    if o.get("deletiondirs"):
        deletions = read("deletiondirs", {})
        for_rows = without_deletions(versions, deletions, spec.partition_keys, spec.clustering_keys, WRITE_TIME)
        for_statics = without_deletions(versions, deletions.where(whole_partition(deletions, spec)), spec.partition_keys, [], WRITE_TIME) if statics else versions
        versions = for_rows
    untouched = F.coalesce(F.col("unset"), F.array()) if "unset" in have else None
    by_element = [f for f in spec.fields if f.name in values and f"{f.name}_put" in have]
    merged_whole = [n for n in values if n not in {f.name for f in by_element}]

    def cells(names: Sequence[str]) -> list[Cell]:
        kinds = {f.name: f.type for f in spec.fields}
        out = []
        for n in names:
            v = F.col(n).cast(kinds[n]) if n in have else F.lit(None).cast(kinds[n])
            is_set = ~F.array_contains(untouched, n) if untouched is not None else None
            out.append(Cell(n, v, is_set, v.isNull(), F.col("expires_at") if "expires_at" in have else None))
        return out

    rows = merge_cells(versions, keys, WRITE_TIME, cells(merged_whole), now, keep_times=bool(spec.features))
    for f in by_element:
        rows = rows.join(merged_collection(versions, keys, f, now), keys, "left")
    rows = visible_rows(rows, values, keys_only=not values)
    if spec.features and values:
        rows = last_modified(rows, values)
    if statics:
        rows = rows.join(merge_cells(for_statics, spec.partition_keys, WRITE_TIME, cells(statics), now), spec.partition_keys, "left")
    return rows.select(*(f.name for f in spec.fields if f.name in rows.columns), *(x for x in spec.features if x in rows.columns))


def read_time(text: str | None = None) -> Column:
    """A time as a literal: the given one (UTC), else now."""
    at = dt.datetime.fromisoformat(text) if text else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def register_table(spark: SparkSession, name: str, options: Mapping[str, str]) -> None:
    """The table's current rows as a view for SQL; filters and column selection of queries reach the scan."""
    read_table(spark, options).createOrReplaceTempView(name)


def save_clustered(versions: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    """Versions as a table bucketed by their partition keys: merging, joining and aggregating by keys that include these then needs no shuffle."""
    versions.write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").saveAsTable(name)


def whole_partition(deletions: DataFrame, spec: TableSpec) -> Column:
    out = F.lit(True)
    for c in spec.clustering_keys:
        out = out & F.col(f"lo_{c}").isNull() & F.col(f"hi_{c}").isNull()
    return out


def merged_collection(versions: DataFrame, keys: Sequence[str], field: Field, now: Column | None = None) -> DataFrame:
    """(keys, the collection, `<name>_ts`) of an unfrozen set, list or map from the elements that versions put and remove.

    A version's `<name>_put` is a map from an element's path to its value (map: key to value; list: time-ordered path
    to value; set: element to true). `<name>_removed` (array of paths) deletes elements, `<name>_replaced` (true)
    everything older than the version. The latest cell of a path wins, and a deletion wins a tie. No live element: null.
    """
    name, have = field.name, set(versions.columns)
    put = F.transform(F.map_entries(f"{name}_put"), lambda e: F.struct(e["key"].alias("path"), e["value"].alias("value"), F.lit(False).alias("dead")))
    value_type = versions.schema[f"{name}_put"].dataType.valueType
    put = F.coalesce(put, F.array().cast(versions.select(put.alias("x")).schema["x"].dataType))
    if f"{name}_removed" in have:
        gone = F.transform(F.col(f"{name}_removed"), lambda p: F.struct(p.alias("path"), F.lit(None).cast(value_type).alias("value"), F.lit(True).alias("dead")))
        put = F.concat(put, F.coalesce(gone, F.array().cast(versions.select(gone.alias("x")).schema["x"].dataType)))
    ends = F.col("expires_at") if "expires_at" in have else F.lit(None).cast("timestamp_ntz")
    elements = versions.select(*keys, F.col(WRITE_TIME).alias("ts"), ends.alias("ends"), F.explode(put).alias("e"))
    elements = elements.select(*keys, "ts", "e.path", "e.dead", F.col("e.value").alias("value"), "ends")
    if f"{name}_replaced" in have:  # what the replacing version itself puts is younger than its deletion
        cut = versions.where(F.col(f"{name}_replaced")).groupBy(*keys).agg(F.max(WRITE_TIME).alias("_cut"))
        elements = elements.join(cut, list(keys), "left").where(F.col("_cut").isNull() | (F.col("ts") >= F.col("_cut"))).drop("_cut")
    won = merge_cells(elements, [*keys, "path"], "ts", [Cell("value", F.col("value"), is_dead=F.col("dead") | F.col("value").isNull(), expires_at=F.col("ends"))], now, keep_times=True)
    entries = F.array_sort(F.collect_list(F.struct("path", "value")))
    out = won.where("value is not null").groupBy(*keys).agg(entries.alias("_e"), F.max("value_ts").alias(f"{name}_ts"))
    kind = field.type_text.strip().lower()
    whole = F.map_from_entries("_e") if kind.startswith("map") else F.transform("_e", lambda e: e["path"] if kind.startswith("set") else e["value"])
    return out.select(*keys, whole.cast(field.type).alias(name), f"{name}_ts")


def key_filters(spec: TableSpec, restricted: Mapping[str, Sequence]) -> list[tuple] | None:
    """All partition keys that = and IN filters name; None if they don't restrict every partition key column. An empty IN names none."""
    if any(k not in restricted for k in spec.partition_keys):
        return None
    return list(product(*(restricted[k] for k in spec.partition_keys)))


def with_key_filter(versions: DataFrame, spec: TableSpec, restricted: Mapping[str, Sequence]) -> DataFrame:
    """Versions of the named partition keys only, as predicates that reach the scan; no row if an IN is empty."""
    keys = key_filters(spec, restricted)
    if keys is None:
        return versions
    if not keys:
        return versions.where(F.lit(False))
    for k in spec.partition_keys:
        versions = versions.where(F.col(k).isin(list(restricted[k])))
    return versions


def keys_in_range(key: str, values: Sequence[int], start: int, end: int) -> Column:
    """The bigint keys among `values` whose tokens lie in (start, end], chosen on the driver: an IN that reaches the scan, or an empty scan."""
    inside = [v for v in values if start < tokens.murmur3_token(codec.encode(v, "bigint")) <= end]
    return F.col(key).isin(inside) if inside else F.lit(False)


def partition_of(versions: DataFrame, kinds: Mapping[str, str], key: Mapping[str, object]) -> DataFrame:
    """Versions of one partition: equal values, which reach the scan, and then equal encoded bytes.

    Values can be equal and their bytes differ (0.0 and -0.0, text in several forms): the bytes decide.
    """
    encoded = [codec.encode(key[k], kind) for k, kind in kinds.items()]
    data = encoded[0] if len(encoded) == 1 else b"".join(len(e).to_bytes(2, "big") + e + b"\0" for e in encoded)
    for k in kinds:
        versions = versions.where(F.col(k) == F.lit(key[k]))
    return versions.where(tokens.composite_key(*(codec.encode_native(F.col(k), kind) for k, kind in kinds.items())) == F.lit(bytearray(data)))


def partition_sizes(versions: DataFrame, keys: Sequence[str], file: str, size: Column, compressed: Column | None = None) -> DataFrame:
    """Bytes of each partition in each file; not merged across files."""
    return versions.groupBy(*keys, file).agg(F.sum(size).cast("long").alias("uncompressed"), F.sum(compressed if compressed is not None else size).cast("long").alias("compressed"))


def read_partition_sizes(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """(partition keys, file, uncompressed, compressed) of a table of read_table's options, a row for each partition and file.

    A version's size is the bytes of its values as text; `compressed` shares each file's bytes out by that.
    """
    spec = spec_from_options(options)
    o = {k.lower(): v for k, v in options.items()}
    versions = spark.read.parquet(*(d for d in o["dirs"].split(",") if d))
    size = F.lit(0)
    for n in spec.partition_keys + spec.clustering_keys + spec.values + spec.statics:
        if n in versions.columns:
            size = size + F.coalesce(F.octet_length(F.col(n).cast("string")), F.lit(0))
    meta = versions.select(*spec.partition_keys, size.alias("_size"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("_bytes"))
    found = meta.groupBy(*spec.partition_keys, "file").agg(F.sum("_size").cast("long").alias("uncompressed"), F.first("_bytes").alias("_bytes"))
    whole = found.groupBy("file").agg(F.sum("uncompressed").alias("_whole"))
    shared = F.floor(F.col("_bytes") * F.col("uncompressed") / F.greatest(F.col("_whole"), F.lit(1)))
    return found.join(whole, "file").select(*spec.partition_keys, "file", "uncompressed", shared.cast("long").alias("compressed"))


def partition_sizes_from_index(index: DataFrame, file: str, offset: str, data_length: str, stretch: int = 64 << 20) -> DataFrame:
    """Bytes of each index entry: up to the next entry's offset in its file, the last up to the file's end.

    A file's entries are dealt to stretches of offsets, and the last entry of one ends where the next one that has any begins, so
    no task holds a whole file's index.
    """
    from pyspark.sql import Window

    rows = index.withColumn("_part", F.floor(F.col(offset) / stretch))
    firsts = rows.groupBy(file, "_part").agg(F.min(offset).alias("_first"))
    ends = firsts.select(file, "_part", F.lead("_first").over(Window.partitionBy(file).orderBy("_part")).alias("_end"))
    own = F.lead(offset).over(Window.partitionBy(file, "_part").orderBy(offset))
    found = rows.withColumn("_next", own).join(ends, [file, "_part"])
    return found.withColumn("uncompressed", F.coalesce("_next", "_end", data_length) - F.col(offset)).drop("_part", "_next", "_end")


def unrepaired_or_primary(files: DataFrame, repaired: str, is_repair_primary: Column) -> DataFrame:
    """Repaired files are read from one replica only, the others from all."""
    return files.where(~F.col(repaired) | is_repair_primary)
