"""Reconciliation of versions: last write wins, four kinds of deletion, expiry, collections, statics.

Every merge is an associative max(struct(write time, dead, tie key, value)), so Spark aggregates it partially before
the shuffle and a hot key costs one row a task. Deletions hide what was written at or before their time and are
applied before the merge; dead and expired cells first win and are dropped afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tie_key(value: Column, kind: T.DataType) -> Column | None:
    """What decides between equal write times before the value does: with it, the order of the serialised bytes.

    Big-endian two's complement puts negative numbers above the others; floats likewise by their bits. Maps have no
    order in Spark: their text decides. Other values decide themselves (None).
    """
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.struct((value < 0).alias("negative"), F.abs(value).alias("size"))
    if isinstance(kind, T.IntegralType):
        return value < 0
    return None if orderable(kind) else F.to_json(value)


def orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(orderable(f.dataType) for f in kind)
    return not isinstance(kind, T.MapType)


@dataclass(frozen=True)
class Cell:
    """A value column of row versions: when a version sets it, when that is a deletion, when it expires.

    `dropped_at`: the column was dropped then and declared again, so what was written up to that time doesn't count.
    """

    name: str
    value: Column
    is_set: Column | None = None
    is_dead: Column | None = None
    expires_at: Column | None = None
    dropped_at: Column | None = None


def merge_rows(versions: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The latest whole version of each key; `order` is a total order."""
    rest = [c for c in columns if c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return versions.groupBy(*keys).agg(best).select(*keys, *(F.col(f"_best.{c}").alias(c) for c in columns))


def merge_cells(versions: DataFrame, keys: Sequence[str], ts: str, cells: Sequence[Cell], now: Column | None = None, keep_times: bool = False, keep_dead: bool = False) -> DataFrame:
    """The latest live cell of each column and key; with keep_times also `<name>_ts`, the winner's write time.

    With keep_dead a dead or expired winner stays, and `<name>_dead` says so: for purged(). The struct that is merged has only
    the fields that can differ.
    """
    aggregates = []
    kinds = [f.dataType for f in versions.select(*(c.value.alias(c.name) for c in cells)).schema] if cells else []
    for c, kind in zip(cells, kinds):
        order = [F.col(ts).alias("ts")]
        if c.is_dead is not None:
            order.append(F.coalesce(c.is_dead, F.lit(False)).alias("dead"))
        if (tie := tie_key(c.value, kind)) is not None:
            order.append(tie.alias("tie"))
        ends = [] if c.expires_at is None else [c.expires_at.alias("ends")]
        won = F.struct(*order, c.value.alias("value"), *ends)
        is_set = c.is_set
        if c.dropped_at is not None:
            later = F.col(ts) > c.dropped_at
            is_set = later if is_set is None else is_set & later
        won = F.when(is_set, won) if is_set is not None else won
        if orderable(kind):
            best = F.max(won)
        else:
            by = F.struct(*order, *ends)
            best = F.max_by(won, F.when(is_set, by) if is_set is not None else by)
        aggregates.append(best.alias(f"_{c.name}"))
    out = versions.groupBy(*keys).agg(*aggregates) if aggregates else versions.select(*keys).distinct()
    columns = []
    for c in cells:
        won = F.col(f"_{c.name}")
        dead = F.lit(False)
        if c.is_dead is not None:
            dead = won["dead"]
        if now is not None and c.expires_at is not None:
            dead = dead | F.coalesce(won["ends"] <= now, F.lit(False))
        dead = won.isNull() | dead  # null: no version sets the column
        columns.append((won["value"] if keep_dead else F.when(~dead, won["value"])).alias(c.name))
        if keep_times:
            columns.append((won["ts"] if keep_dead else F.when(~dead, won["ts"])).alias(f"{c.name}_ts"))
        if keep_dead:
            columns.append(dead.alias(f"{c.name}_dead"))
    return out.select(*keys, *columns)


def purged(merged: DataFrame, cells: Sequence[str]) -> DataFrame:
    """What merge_cells(keep_dead=True) left, without dead cells and rows that have no other."""
    alive = {n: F.when(~F.col(f"{n}_dead"), F.col(n)) for n in cells}
    return guarded(visible_rows(merged.withColumns(alive), cells), F.array(*(F.col(f"{n}_dead") & F.col(n).isNotNull() for n in cells))).drop(*(f"{n}_dead" for n in cells))


def guarded(rows: DataFrame, deletions: Column) -> DataFrame:
    """The rows, or an error if one of the array's flags is true: no deletion may be left after a merge."""
    left = F.array_contains(deletions, True)
    return rows.where(F.when(left, F.raise_error(F.lit("a deletion is left after the merge"))).otherwise(F.lit(True)))


def visible_rows(merged: DataFrame, cells: Sequence[str], keys_only: bool = False, liveness: str | None = None) -> DataFrame:
    """Rows with a live value cell; a read of keys only keeps rows without one as well.

    `liveness`: a boolean column that is true where the row itself lives (an insert that isn't deleted or expired). A read of
    keys only then keeps live rows and rows with a live cell; a read of values doesn't look at it, so updated rows stay.
    """
    alive = F.lit(False)
    for c in cells:
        alive = alive | F.col(c).isNotNull()
    if keys_only and liveness:
        return merged.where(alive | F.coalesce(F.col(liveness), F.lit(False)))
    return merged if keys_only or not cells else merged.where(alive)


def without_deleted(versions: DataFrame, deletions: DataFrame, on: Sequence[str], ts: str, deleted_at: str) -> DataFrame:
    """Hide versions that a deletion of their partition, row or column (whatever `on` names) covers."""
    last = deletions.groupBy(*on).agg(F.max(deleted_at).alias("_deleted"))
    kept = versions.join(last, list(on), "left").where(F.col("_deleted").isNull() | (F.col(ts) > F.col("_deleted")))
    return kept.drop("_deleted")


def without_ranges(versions: DataFrame, ranges: DataFrame, partition: Sequence[str], clustering: str, ts: str) -> DataFrame:
    """Hide versions inside a deleted clustering interval of their partition.

    `ranges`: partition columns, lo, lo_inclusive, hi, hi_inclusive (null bound: open), deleted_at.
    """
    r = ranges.alias("r")
    v = versions.alias("v")
    value = F.col(f"v.{clustering}")
    same = F.lit(True)
    for p in partition:
        same = same & (F.col(f"v.{p}") == F.col(f"r.{p}"))
    above = F.col("r.lo").isNull() | (value > F.col("r.lo")) | (F.col("r.lo_inclusive") & (value == F.col("r.lo")))
    below = F.col("r.hi").isNull() | (value < F.col("r.hi")) | (F.col("r.hi_inclusive") & (value == F.col("r.hi")))
    return v.join(r, same & above & below & (F.col(f"v.{ts}") <= F.col("r.deleted_at")), "left_anti")


def inside(clustering: Sequence[Column], lo: Sequence[Column], hi: Sequence[Column], lo_inclusive: Column, hi_inclusive: Column) -> Column:
    """Whether a clustering key lies in an interval whose bounds may name only its first columns (the others null).

    A bound without any column is open. Columns are compared one after the other, a bound ends where it is null.
    """

    def side(at: int, bound: Sequence[Column], closed: Column, beyond) -> Column:
        if at == len(clustering):
            return closed
        here = beyond(clustering[at], bound[at]) | ((clustering[at] == bound[at]) & side(at + 1, bound, closed, beyond))
        return F.when(bound[at].isNull(), closed if at else F.lit(True)).otherwise(here)

    return side(0, lo, lo_inclusive, lambda c, b: c > b) & side(0, hi, hi_inclusive, lambda c, b: c < b)


def without_deletions(versions: DataFrame, deletions: DataFrame, partition: Sequence[str], clustering: Sequence[str], ts: str) -> DataFrame:
    """Hide what deletions of partitions, rows and clustering intervals cover.

    `deletions`: the partition columns, `lo_<c>` and `hi_<c>` for each clustering column c, lo_inclusive, hi_inclusive,
    deleted_at. Without bounds a partition goes, with equal whole bounds a row; both are pre-aggregated and joined by
    equality. Only true intervals need the join on a condition, still by the partition's key.
    """
    bounds = [F.col(f"{side}_{c}") for side in ("lo", "hi") for c in clustering]
    none, row = F.lit(True), F.col("lo_inclusive") & F.col("hi_inclusive")
    for b in bounds:
        none = none & b.isNull()
    for c in clustering:
        row = row & F.coalesce(F.col(f"lo_{c}") == F.col(f"hi_{c}"), F.lit(False))
    row = F.coalesce(row, F.lit(False)) & ~none
    out = without_deleted(versions, deletions.where(none), partition, ts, "deleted_at")
    if not clustering:
        return out
    rows = deletions.where(row).select(*partition, *(F.col(f"lo_{c}").alias(c) for c in clustering), "deleted_at")
    out = without_deleted(out, rows, [*partition, *clustering], ts, "deleted_at")
    v, d = out.alias("v"), deletions.where(~none & ~row).alias("d")
    hit = F.col(f"v.{ts}") <= F.col("d.deleted_at")
    for p in partition:
        hit = hit & (F.col(f"v.{p}") == F.col(f"d.{p}"))
    side = lambda name: [F.col(f"d.{name}_{c}") for c in clustering]
    closed = lambda name: F.coalesce(F.col(f"d.{name}_inclusive"), F.lit(False))
    return v.join(d, hit & inside([F.col(f"v.{c}") for c in clustering], side("lo"), side("hi"), closed("lo"), closed("hi")), "left_anti")


def merge_elements(elements: DataFrame, keys: Sequence[str], path: str, ts: str, value: str, dead: Column | None = None, expires_at: Column | None = None, now: Column | None = None) -> DataFrame:
    """Unfrozen collections: the latest cell of each element, by the rules of merge_cells(); dead elements go after they have won."""
    cell = Cell("_element", F.col(value), None, dead, expires_at)
    won = merge_cells(elements, [*keys, path], ts, [cell], now, keep_times=True).where("_element is not null")
    return won.select(*keys, path, F.col("_element").alias(value), F.col("_element_ts").alias(ts))


def as_map(elements: DataFrame, keys: Sequence[str], path: str, value: str, name: str) -> DataFrame:
    return elements.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(path, value)))).alias(name))


def as_set(elements: DataFrame, keys: Sequence[str], path: str, name: str) -> DataFrame:
    return elements.groupBy(*keys).agg(F.array_sort(F.collect_list(path)).alias(name))


def as_list(elements: DataFrame, keys: Sequence[str], path: str, value: str, name: str) -> DataFrame:
    """A list's elements in the order of their paths."""
    entries = F.array_sort(F.collect_list(F.struct(path, value)))
    return elements.groupBy(*keys).agg(F.transform(entries, lambda e: e[value]).alias(name))


def with_statics(rows: DataFrame, statics: DataFrame, partition: Sequence[str]) -> DataFrame:
    """Each partition's static values on each of its rows; a partition without rows gives none."""
    return rows.join(statics, list(partition), "left")


def last_modified(merged: DataFrame, cells: Sequence[str]) -> DataFrame:
    """Add last_modified_timestamp: the latest write time of the live cells read."""
    times = [F.col(f"{c}_ts") for c in cells]
    return merged.withColumn("last_modified_timestamp", F.greatest(*times) if len(times) > 1 else times[0])
