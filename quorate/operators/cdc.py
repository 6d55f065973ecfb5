"""Change events from replicated mutations: kinds, quorum, late data, markers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

#: Event kinds, in the order of precedence.
KINDS = ("PARTITION_DELETE", "ROW_DELETE", "RANGE_DELETE", "COMPLEX_ELEMENT_DELETE", "DELETE", "UPDATE", "INSERT")


def kind(partition_delete: Column, row_delete: Column, range_delete: Column, element_delete: Column, collection_delete: Column, has_liveness: Column) -> Column:
    """The kind of a mutation; element deletes before whole-collection deletes before update before insert."""
    return (
        F.when(partition_delete, "PARTITION_DELETE").when(row_delete, "ROW_DELETE").when(range_delete, "RANGE_DELETE")
        .when(element_delete, "COMPLEX_ELEMENT_DELETE").when(collection_delete, "DELETE").when(has_liveness, "INSERT").otherwise("UPDATE")
    )


def value(name: str, type_text: str, data: Column) -> Column:
    return F.struct(F.lit(name).alias("Name"), F.lit(type_text).alias("Type"), data.cast("binary").alias("Value"))


def touched(*columns: tuple[Column, Column]) -> Column:
    """An array of the values whose column was touched: a null value is a deletion, an untouched one is absent."""
    return F.array_compact(F.array(*(F.when(is_set, v) for is_set, v in columns)))


def digest(*columns: str, touched: Column | None = None) -> Column:
    """Identity of an update: the same on each replica that holds the same content.

    A null is part of the content (a deletion). `touched`, an array of names, tells deleted columns from untouched ones.
    """
    more = [] if touched is None else [F.sort_array(touched).alias("touched")]
    return F.md5(F.to_json(F.struct(*columns, *more), {"ignoreNullFields": "false"}).cast("binary"))


def quorum(copies: DataFrame, identity: str, needed: int | Column, replica: str | None = None, seen: DataFrame | None = None) -> DataFrame:
    """(identity, copies, published) of each update: copies of this batch and those seen before, against what is needed.

    With `replica` distinct replicas count, and `seen` is what pending() left, rows (identity, replica): a replica whose copy
    comes twice counts once. Else copies count, and `seen` is (identity, copies).
    """
    if replica:
        rows = copies.select(identity, replica)
        rows = rows if seen is None else rows.unionByName(seen.select(identity, replica))
        now = rows.groupBy(identity).agg(F.countDistinct(replica).cast("long").alias("copies"))
    else:
        now = copies.groupBy(identity).agg(F.count(F.lit(1)).cast("long").alias("copies"))
        if seen is not None:
            now = now.unionByName(seen.select(identity, "copies")).groupBy(identity).agg(F.sum("copies").alias("copies"))
    return now.withColumn("published", F.col("copies") >= (F.lit(needed) if isinstance(needed, int) else needed))


def pending(copies: DataFrame, result: DataFrame, identity: str, replica: str, seen: DataFrame | None = None) -> DataFrame:
    """The state after a batch: (identity, replica) of the updates that quorum() didn't publish."""
    rows = copies.select(identity, replica)
    rows = rows if seen is None else rows.unionByName(seen.select(identity, replica))
    return rows.join(result.where("published").select(identity), identity, "left_anti").distinct()


def merged_states(*states: DataFrame, within: Column | None = None) -> DataFrame:
    """States of pending() of adjoining token ranges as one: every replica once; `within` keeps the updates of the new range."""
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return (out if within is None else out.where(within)).distinct()


def complex_cells(cells: DataFrame, mutation: Sequence[str], path: str, value: str, dead: Column) -> DataFrame:
    """Collection updates of mutations: (mutation, live, deleted).

    `live` is an array of (path, value) in the order of the paths, null if every cell is dead; `deleted` the dead elements' paths.
    A mutation's cells are what one write holds, so the arrays don't grow with the table.
    """
    cell = F.struct(F.col(path).alias("path"), F.col(value).alias("value"))
    live = F.sort_array(F.collect_list(F.when(~dead, cell)))
    out = cells.groupBy(*mutation).agg(live.alias("live"), F.sort_array(F.collect_list(F.when(dead, F.col(path)))).alias("deleted"))
    return out.withColumn("live", F.when(F.size("live") > 0, F.col("live")))


def first_ttl(cells: DataFrame, mutation: Sequence[str], position: str, ttl: str, written: str) -> DataFrame:
    """(mutation, ttl, expires_at) of the first cell of each mutation that expires; null where none does."""
    expiring = F.when(F.col(ttl).isNotNull(), F.struct(F.col(ttl).alias("ttl"), (F.col(written) + F.make_dt_interval(secs=F.col(ttl))).alias("expires_at")))
    found = cells.groupBy(*mutation).agg(F.min_by(expiring, F.when(F.col(ttl).isNotNull(), F.col(position))).alias("_t"))
    return found.select(*mutation, "_t.ttl", "_t.expires_at")


def event_time(cells: DataFrame, mutation: Sequence[str], ts: str, deleted_at: str) -> DataFrame:
    """(mutation, modified): the latest write time of its cells and deletions; a row's deletion alone has its own time."""
    return cells.groupBy(*mutation).agg(F.greatest(F.max(ts), F.max(deleted_at)).alias("modified"))


def sequenced(events: DataFrame, keys: Sequence[str], ts: str, span_seconds: int = 3600) -> DataFrame:
    """`events` with `seq`, each event's number from 1 among those of its partition, in the order of `ts`.

    Events are numbered inside spans of time, and the spans' sizes summed up, so no task sorts a whole hot partition.
    """
    span = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (span_seconds * 1_000_000))
    events = events.withColumn("_span", span)
    sizes = events.groupBy(*keys, "_span").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, "_span", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    at = F.row_number().over(Window.partitionBy(*keys, "_span").orderBy(ts))
    return events.withColumn("_at", at).join(starts, [*keys, "_span"]).withColumn("seq", (F.col("_start") + F.col("_at")).cast("long")).drop("_span", "_at", "_start")


def of_table(events: DataFrame, keyspace: str, name: str, needed: int) -> DataFrame:
    """Events of one table of a stream of many: with Keyspace, Table and the replicas that its keyspace needs."""
    return events.select(F.lit(keyspace).alias("Keyspace"), F.lit(name).alias("Table"), F.lit(needed).alias("needed"), "*")


def in_scope(entries: DataFrame, table: str, tracked: Sequence[str], token: str, start: int, end: int, ts: str, oldest: Column) -> DataFrame:
    """Mutations of tables with change capture on, inside the token range and the window."""
    return entries.where(F.col(table).isin(list(tracked)) & (F.col(token) > F.lit(start)) & (F.col(token) <= F.lit(end)) & (F.col(ts) >= oldest))


def named_tables(entries: DataFrame, table_id: str, ids: Mapping[str, str]) -> DataFrame:
    """Entries with the name (`table`) that the registry `ids` (name -> id) has for their table's id; unknown tables are skipped."""
    known = F.create_map(*(F.lit(x) for name, i in ids.items() for x in (i, name))) if ids else None
    name = F.lit(None).cast("string") if known is None else F.element_at(known, F.col(table_id))
    return entries.withColumn("table", name).where("table is not null")


def within_window(events: DataFrame, ts: str, start: Column, seconds: int = 600) -> DataFrame:
    """Updates that aren't older than the batch's start by more than the window."""
    return events.where(F.col(ts) >= start - F.make_dt_interval(secs=F.lit(seconds)))


def after_markers(entries: DataFrame, markers: DataFrame) -> DataFrame:
    """Log entries (instance, segment, position) from their instance's start marker on; all, where there is none."""
    m = markers.select("instance", F.struct("segment", "position").alias("_from"))
    return entries.join(F.broadcast(m), "instance", "left").where(F.col("_from").isNull() | (F.struct("segment", "position") >= F.col("_from"))).drop("_from")


def latest_markers(entries: DataFrame) -> DataFrame:
    """The end of each instance's logs."""
    return entries.groupBy("instance").agg(F.max(F.struct("segment", "position")).alias("m")).select("instance", "m.segment", "m.position")


def least_markers(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two marker tables as one: the earlier marker of each instance."""
    return a.unionByName(b).groupBy("instance").agg(F.min(F.struct("segment", "position")).alias("m")).select("instance", "m.segment", "m.position")


def range_deletions(markers: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Open, close and boundary markers of range deletions as intervals (lo, lo_inclusive, hi, hi_inclusive).

    `markers`: keys, position (clustering value), kind in open / close / boundary, inclusive. A boundary closes one
    interval and opens the next. An interval that is never closed is an error where the result is used: hi is null
    and `unclosed` true.
    """
    ends = F.when(F.col("kind") == "open", F.array(F.lit("open"))).when(F.col("kind") == "close", F.array(F.lit("close"))).otherwise(F.array(F.lit("close"), F.lit("open")))
    flat = markers.select(*keys, position, "inclusive", F.posexplode(ends).alias("step", "end"))
    w = Window.partitionBy(*keys).orderBy(position, "step")
    nxt = lambda c: F.lead(c).over(w)
    out = flat.withColumns({"hi": nxt(position), "hi_inclusive": nxt("inclusive"), "_end": nxt("end")})
    return out.where("end = 'open'").select(*keys, F.col(position).alias("lo"), F.col("inclusive").alias("lo_inclusive"), "hi", "hi_inclusive", (F.coalesce(F.col("_end"), F.lit("")) != "close").alias("unclosed"))


def require_closed(intervals: DataFrame) -> DataFrame:
    """What range_deletions() gave, or an error if an interval is open at the end of its partition."""
    closed = F.when(F.col("unclosed"), F.raise_error(F.lit("a range deletion is never closed"))).otherwise(F.lit(True))
    return intervals.where(closed).drop("unclosed")


def range_markers(*tables: DataFrame) -> DataFrame:
    """Markers (range, instance, segment, position) of token ranges that are read on together: every range keeps its own."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.groupBy("range", "instance").agg(F.max(F.struct("segment", "position")).alias("m")).select("range", "instance", "m.segment", "m.position")


def start_markers(markers: DataFrame) -> DataFrame:
    """Where each instance's log must be read from: the earliest marker of its ranges."""
    return markers.groupBy("instance").agg(F.min(F.struct("segment", "position")).alias("m")).select("instance", "m.segment", "m.position")


def after_range_markers(entries: DataFrame, markers: DataFrame) -> DataFrame:
    """Entries (range, instance, segment, position) from the marker of their range and instance on; all, where there is none."""
    m = markers.select("range", "instance", F.struct("segment", "position").alias("_from"))  # a row for each range and instance of the ring
    return entries.join(F.broadcast(m), ["range", "instance"], "left").where(F.col("_from").isNull() | (F.struct("segment", "position") >= F.col("_from"))).drop("_from")


def observed(events: DataFrame, name: str | Observation, **counters: Column) -> DataFrame:
    """`events` with counters of the rows that meet conditions, as metrics of the query (a batch's or each micro-batch's)."""
    return events.observe(name, *(F.count(F.when(c, F.lit(1))).alias(n) for n, c in counters.items()))
