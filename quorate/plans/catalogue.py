"""Every query of the engine on the driver's tables, with the SQL that must give the same rows.

`events` is the mutation log: user_id is the partition key, event_type the clustering key, ts the write time,
value and props the cells. `lineitem` has natural versions of (l_orderkey, l_linenumber). `nation` and `customer` stand for
instances and keyspaces where a query needs some.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorate.functions import codec, schema, tokens
from quorate.operators import cdc, reconcile, ring
from quorate.operators.reconcile import Cell
from quorate.sources import replicated, table
from quorate.streaming import iterator, quorum, source

_QUERIES: dict = {}
_SQL: dict[str, str] = {}

PK, CK = "user_id", "event_type"
NOW = "2024-06-01 00:00:00"
_LATEST = "row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1"


def query(sql: str | None):
    def register(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def _events(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/lineitem.parquet")


def _every(n: int, rest: int = 0):
    return F.col("event_id") % n == rest


def _money(c):
    return c.cast("decimal(18,2)")


# --- reconciliation -------------------------------------------------------------------------------------------

_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query(
    f"""with w as (select *, row_number() over (partition by l_orderkey, l_linenumber order by {', '.join(c + ' desc' for c in _ORDER)}) rn from lineitem)
    select l_returnflag, cast(sum(cast(l_quantity as decimal(18,2))) as decimal(28,2)) as sum_qty, count(*) as n_rows from w where rn = 1 group by 1"""
)
def merge_lww_row(spark, d):
    rows = reconcile.merge_rows(_lines(spark, d), ["l_orderkey", "l_linenumber"], _ORDER, ["l_returnflag", "l_quantity"])
    return rows.groupBy("l_returnflag").agg(F.sum(_money(F.col("l_quantity"))).cast("decimal(28,2)").alias("sum_qty"), F.count(F.lit(1)).alias("n_rows"))


def _cells() -> list[Cell]:
    return [Cell("value", F.col("value"), ~_every(3), _every(11)), Cell("props", F.col("props"), ~_every(5), _every(7))]


_CELLS_SQL = """select user_id, event_type,
    arg_max({'v': case when event_id % 11 = 0 then null else value end, 't': case when event_id % 11 = 0 then null else ts end}, ts) filter (event_id % 3 <> 0) as a,
    arg_max({'v': case when event_id % 7 = 0 then null else props end, 't': case when event_id % 7 = 0 then null else ts end}, ts) filter (event_id % 5 <> 0) as b
    from events group by all"""


def _merged(spark, d, **more):
    return reconcile.merge_cells(_events(spark, d), [PK, CK], "ts", _cells(), **more)


@query(f"select user_id, event_type, a.v as value, b.v as props from ({_CELLS_SQL}) where a.v is not null or b.v is not null")
def merge_lww_cell(spark, d):
    return reconcile.visible_rows(_merged(spark, d), ["value", "props"])


@query(f"select count(*) as n_keys, count(a.v) as n_value, count(b.v) as n_props from ({_CELLS_SQL})")
def merge_purge_all(spark, d):
    return _merged(spark, d).agg(F.count(F.lit(1)).alias("n_keys"), F.count("value").alias("n_value"), F.count("props").alias("n_props"))


@query(f"select user_id, event_type, case when a.v is null then 0 else 1 end as has_value from ({_CELLS_SQL})")
def tomb_cell(spark, d):
    return _merged(spark, d).select(PK, CK, F.when(F.col("value").isNull(), 0).otherwise(1).alias("has_value"))


@query(f"select user_id, event_type, a.v as value, b.v as props from ({_CELLS_SQL}) where a.v is not null or b.v is not null")
def merge_guard(spark, d):
    """Winners that are deletions are kept, purged and then looked for once more: one that is left is an error."""
    return reconcile.purged(_merged(spark, d, keep_dead=True), ["value", "props"])


@query(f"select user_id, event_type, strftime(greatest(a.t, b.t), '%Y-%m-%d %H:%M:%S.%f') as modified from ({_CELLS_SQL}) where a.v is not null or b.v is not null")
def last_modified(spark, d):
    rows = reconcile.last_modified(reconcile.visible_rows(_merged(spark, d, keep_times=True), ["value", "props"]), ["value", "props"])
    return rows.select(PK, CK, F.date_format("last_modified_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("modified"))


def _survivors(sql_deletions: str, on: str) -> str:
    match = " and ".join(f"e.{c} = x.{c}" for c in on.split(","))
    return f"""with x as (select {on}, max(ts) as del from events where {sql_deletions} group by all),
    v as (select e.* from events e left join x on {match} where x.del is null or e.ts > x.del)
    select user_id, event_type, arg_max(value, ts) as value from v group by all"""


@query(_survivors("event_id % 211 = 0", "user_id"))
def tomb_partition(spark, d):
    e = _events(spark, d)
    left = reconcile.without_deleted(e, e.where(_every(211)), [PK], "ts", "ts")
    return reconcile.merge_cells(left, [PK, CK], "ts", [Cell("value", F.col("value"))])


@query(_survivors("event_id % 97 = 0", "user_id,event_type"))
def tomb_row(spark, d):
    e = _events(spark, d)
    left = reconcile.without_deleted(e, e.where(_every(97)), [PK, CK], "ts", "ts")
    return reconcile.merge_cells(left, [PK, CK], "ts", [Cell("value", F.col("value"))])


def _ranges(e: DataFrame) -> DataFrame:
    return e.where(_every(89)).select(PK, F.floor("value").cast("long").alias("lo"), _every(2).alias("lo_inclusive"), (F.floor("value") + 20).cast("long").alias("hi"), (~_every(2)).alias("hi_inclusive"), F.col("ts").alias("deleted_at"))


@query(
    """with r as (select user_id, cast(floor(value) as bigint) lo, event_id % 2 = 0 as li, cast(floor(value) + 20 as bigint) hi, event_id % 2 <> 0 as ri, ts as del from events where event_id % 89 = 0),
    v as (select user_id, cast(floor(value) as bigint) as slot, ts, event_id from events e)
    select user_id, slot, max(event_id) as event_id from v where not exists (select 1 from r where r.user_id = v.user_id and v.ts <= r.del
      and (v.slot > r.lo or (r.li and v.slot = r.lo)) and (v.slot < r.hi or (r.ri and v.slot = r.hi))) group by all"""
)
def tomb_range(spark, d):
    e = _events(spark, d)
    versions = e.select(PK, F.floor("value").cast("long").alias("slot"), "ts", "event_id")
    left = reconcile.without_ranges(versions, _ranges(e), [PK], "slot", "ts")
    return left.groupBy(PK, "slot").agg(F.max("event_id").alias("event_id"))


@query(
    f"""with w as (select *, {_LATEST} as won from events)
    select user_id, event_type, case when ts + to_days(cast(event_id % 7 as integer)) > timestamp '{NOW}' or event_id % 7 = 0 then value end as value from w where won"""
)
def ttl_expire(spark, d):
    ends = F.when(~_every(7), F.col("ts") + F.make_dt_interval(days=(F.col("event_id") % 7).cast("int")))
    return reconcile.merge_cells(_events(spark, d), [PK, CK], "ts", [Cell("value", F.col("value"), expires_at=ends)], now=F.lit(NOW).cast("timestamp_ntz"))


def _elements(spark, d) -> DataFrame:
    return _events(spark, d).withColumn("path", F.get_json_object("props", "$.k").cast("bigint"))


_ELEMENTS_SQL = """e as (select *, try_cast(json_extract_string(props, '$.k') as bigint) as path from events),
    won as (select user_id, path, arg_max({'dead': event_id % 13 = 0, 'id': event_id, 'ts': ts}, ts) as c from e where path is not null group by all)"""


def _won(spark, d):
    return reconcile.merge_elements(_elements(spark, d).where("path is not null"), [PK], "path", "ts", "event_id", _every(13))


@query(f"with {_ELEMENTS_SQL} select user_id, string_agg(path || '=' || c.id, ',' order by path) as entries from won where not c.dead group by all")
def coll_merge_map(spark, d):
    m = reconcile.as_map(_won(spark, d), [PK], "path", "event_id", "m")
    return m.select(PK, F.array_join(F.transform(F.map_entries("m"), lambda x: F.concat_ws("=", x["key"].cast("string"), x["value"].cast("string"))), ",").alias("entries"))


@query(f"with {_ELEMENTS_SQL} select user_id, string_agg(cast(path as varchar), ',' order by path) as members from won where not c.dead group by all")
def coll_merge_set(spark, d):
    return reconcile.as_set(_won(spark, d), [PK], "path", "s").select(PK, F.array_join(F.transform("s", lambda x: x.cast("string")), ",").alias("members"))


@query(f"with {_ELEMENTS_SQL} select user_id, string_agg(cast(c.id as varchar), ',' order by path) as items from won where not c.dead group by all")
def coll_merge_list(spark, d):
    return reconcile.as_list(_won(spark, d), [PK], "path", "event_id", "l").select(PK, F.array_join(F.transform("l", lambda x: x.cast("string")), ",").alias("items"))


@query(f"with {_ELEMENTS_SQL} select user_id, strftime(max(c.ts), '%Y-%m-%d %H:%M:%S.%f') as modified from won where not c.dead group by all")
def coll_timestamp(spark, d):
    return _won(spark, d).groupBy(PK).agg(F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("modified"))


@query(
    f"""with x as (select user_id, max(ts) as del from events where event_id % 307 = 0 group by all), {_ELEMENTS_SQL.replace('from events', 'from events left join x using (user_id) where x.del is null or ts > x.del')}
    select user_id, count(*) as n_live from won where not c.dead group by all"""
)
def coll_tombstone(spark, d):
    e = _elements(spark, d)
    left = reconcile.without_deleted(e, e.where(_every(307)), [PK], "ts", "ts").where("path is not null")
    return reconcile.merge_elements(left, [PK], "path", "ts", "event_id", _every(13)).groupBy(PK).agg(F.count(F.lit(1)).alias("n_live"))


@query("select user_id, arg_max(event_type, ts) as kind, arg_max(props, ts) as body from events group by all")
def coll_frozen(spark, d):
    one = reconcile.merge_cells(_events(spark, d), [PK], "ts", [Cell("whole", F.struct(F.col(CK).alias("kind"), F.col("props").alias("body")))])
    return one.select(PK, "whole.kind", "whole.body")


@query("select user_id, arg_max(event_type, ts) filter (event_id % 2 = 0) as kind, arg_max(props, ts) filter (event_id % 2 = 1) as body from events group by all")
def udt_merge(spark, d):
    fields = [Cell("kind", F.col(CK), _every(2)), Cell("body", F.col("props"), ~_every(2))]
    udt = reconcile.merge_cells(_events(spark, d), [PK], "ts", fields).select(PK, F.struct("kind", "body").alias("u"))
    return udt.select(PK, "u.kind", "u.body")


@query(
    """with s as (select user_id, arg_max(value, ts) as static_value from events where event_type = 'signup' group by all),
    r as (select user_id, event_type, arg_max(value, ts) as value from events where event_type <> 'signup' group by all) select r.*, s.static_value from r left join s using (user_id)"""
)
def static_broadcast(spark, d):
    e = _events(spark, d)
    statics = reconcile.merge_cells(e.where(F.col(CK) == "signup"), [PK], "ts", [Cell("static_value", F.col("value"))])
    rows = reconcile.merge_cells(e.where(F.col(CK) != "signup"), [PK, CK], "ts", [Cell("value", F.col("value"))])
    return reconcile.with_statics(rows, statics, [PK])


@query(
    """with s as (select user_id, arg_max(value, ts) as static_value from events where event_id % 2 = 0 group by all),
    r as (select user_id, event_type, arg_max(value, ts) as value from events where event_id % 31 = 0 group by all)
    select user_id, event_type, r.value, s.static_value from r left join s using (user_id)"""
)
def static_only_partition(spark, d):
    """Most partitions have statics only here, and give no row."""
    e = _events(spark, d)
    statics = reconcile.merge_cells(e.where(_every(2)), [PK], "ts", [Cell("static_value", F.col("value"))])
    rows = reconcile.merge_cells(e.where(_every(31)), [PK, CK], "ts", [Cell("value", F.col("value"))])
    return reconcile.with_statics(rows, statics, [PK])


_LIVENESS_SQL = f"""with c as ({_CELLS_SQL}), l as (select user_id, event_type, arg_max(event_id % 4 <> 1, ts) filter (event_id % 4 < 2) as live from events group by all)
    select user_id, event_type, coalesce(live, false) as live, a.v as value, b.v as props from c join l using (user_id, event_type)"""


def _with_liveness(spark, d) -> DataFrame:
    """A quarter of the versions are inserts, which set the row's own marker, a quarter deletes it, the others are updates."""
    marker = Cell("live", F.lit(True), F.col("event_id") % 4 < 2, _every(4, 1))
    return reconcile.merge_cells(_events(spark, d), [PK, CK], "ts", [*_cells(), marker])


@query(f"select user_id, event_type, live, value is not null as has_value, props is not null or value is not null as in_values, live or value is not null or props is not null as in_keys from ({_LIVENESS_SQL})")
def row_liveness_only(spark, d):
    """Which reads show a row: one of values needs a live cell, one of keys a live cell or the row's own marker."""
    rows = _with_liveness(spark, d).withColumn("live", F.coalesce("live", F.lit(False)))
    by_values = reconcile.visible_rows(rows, ["value", "props"]).select(PK, CK, F.lit(True).alias("in_values"))
    by_keys = reconcile.visible_rows(rows, ["value", "props"], keys_only=True, liveness="live").select(PK, CK, F.lit(True).alias("in_keys"))
    shown = rows.select(PK, CK, "live", F.col("value").isNotNull().alias("has_value")).join(by_values, [PK, CK], "left").join(by_keys, [PK, CK], "left")
    return shown.fillna(False, ["in_values", "in_keys"])


@query("select distinct user_id, event_type from events")
def proj_keys_only(spark, d):
    merged = reconcile.merge_cells(_events(spark, d), [PK, CK], "ts", [Cell("value", F.col("value"))])
    return reconcile.visible_rows(merged.select(PK, CK), [], keys_only=True)


@query("select count(*) as n_rows from (select distinct user_id, event_type from events)")
def proj_no_columns(spark, d):
    return proj_keys_only(spark, d).agg(F.count(F.lit(1)).alias("n_rows"))


@query("select user_id, event_type, arg_max(value, ts) filter (event_id % 2 = 0) as value, arg_max(props, ts) filter (event_id % 4 = 1) as props from events group by all")
def row_partial(spark, d):
    return reconcile.merge_cells(_events(spark, d), [PK, CK], "ts", [Cell("value", F.col("value"), _every(2)), Cell("props", F.col("props"), _every(4, 1))])


@query(f"select user_id, event_type, value, props from ({_LIVENESS_SQL}) where not live and (value is not null or props is not null)")
def row_upsert(spark, d):
    """Rows that only updates wrote are read like any other."""
    rows = _with_liveness(spark, d)
    return reconcile.visible_rows(rows, ["value", "props"]).where(~F.coalesce("live", F.lit(False))).select(PK, CK, "value", "props")


@query("select user_id, event_type, arg_max(value, ts) filter (ts > timestamp '2024-01-05 00:00:00') as value from events group by all")
def dropped_column(spark, d):
    """The column was dropped and declared again: what was written before doesn't count."""
    dropped = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    return reconcile.merge_cells(_events(spark, d), [PK, CK], "ts", [Cell("value", F.col("value"), dropped_at=dropped)])


@query("select user_id, event_type, arg_max(value, ts) as value from events group by all")
def undeclared_column(spark, d):
    """The files have props, the declared table doesn't."""
    return table.read_table(spark, _OPTIONS | {"dirs": f"{d}/events.parquet", "createStmt": "create table k.events (user_id bigint, event_type text, value double, never_written int, primary key (user_id, event_type))"}).drop("never_written")


@query("select user_id, event_type, arg_max(props, ts) as props from events group by all")
def proj_prune(spark, d):
    both = reconcile.merge_cells(_events(spark, d), [PK, CK], "ts", [Cell("value", F.col("value")), Cell("props", F.col("props"))])
    return both.select(PK, CK, "props")


_CURRENT_SQL = "select user_id, event_type, arg_max(value, ts) as value from events group by all"


def _current(spark, d):
    return reconcile.merge_cells(_events(spark, d), [PK, CK], "ts", [Cell("value", F.col("value"))])


@query(f"select event_type, cast(sum(cast(value as decimal(18,2))) as decimal(28,2)) as total, count(*) as n from ({_CURRENT_SQL}) group by all")
def src_table_batch(spark, d):
    return _current(spark, d).groupBy(CK).agg(F.sum(_money(F.col("value"))).cast("decimal(28,2)").alias("total"), F.count(F.lit(1)).alias("n"))


_OPTIONS = {"keyspace": "k", "createStmt": "create table k.events (user_id bigint, event_type text, value double, props text, primary key (user_id, event_type))", "writeTimeColumn": "ts"}


@query("select user_id, event_type, arg_max(props, ts) as props, arg_max(value, ts) as value from events group by all")
def src_local(spark, d):
    return table.read_table(spark, _OPTIONS | {"dirs": f"{d}/events.parquet"})


@query("select user_id, event_type, arg_max(value, ts) as value, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as modified from events group by all")
def feat_last_modified(spark, d):
    rows = table.read_table(spark, _OPTIONS | {"dirs": f"{d}/events.parquet", "last_modified_timestamp": "true"}, columns=["value"])
    return rows.select(PK, CK, "value", F.date_format("last_modified_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("modified"))


@query(f"select * from ({_CURRENT_SQL}) where user_id = 7")
def filt_pk_eq(spark, d):
    return _current(spark, d).where(F.col(PK) == 7)


@query(f"select * from ({_CURRENT_SQL}) where user_id in (1, 3, 5, 100000)")
def filt_pk_in(spark, d):
    return _current(spark, d).where(F.col(PK).isin(1, 3, 5, 100000))


@query("select user_id, event_type, arg_max(value, ts) as value from events where user_id in (2, 3) and event_type in ('click', 'view', 'error') group by all")
def filt_pk_cartesian(spark, d):
    spec = table.parse_table("create table t (user_id bigint, event_type text, value double, primary key ((user_id, event_type)))")
    chosen = table.with_key_filter(_events(spark, d), spec, {PK: [2, 3], CK: ["click", "view", "error"]})
    return reconcile.merge_cells(chosen, [PK, CK], "ts", [Cell("value", F.col("value"))])


@query(f"select * from ({_CURRENT_SQL}) where event_type >= 'e' and value is not null and not value < 10")
def filt_residual(spark, d):
    return _current(spark, d).where((F.col(CK) >= "e") & F.col("value").isNotNull() & ~(F.col("value") < 10))


@query(f"select * from ({_CURRENT_SQL}) where user_id = -1")
def filt_none(spark, d):
    return _current(spark, d).where(F.col(PK) == -1)


@query("select event_id from events where 1 = 0")
def filt_pk_in_empty(spark, d):
    spec = table.parse_table("create table t (user_id bigint, event_type text, value double, primary key ((user_id, event_type)))")
    return table.with_key_filter(_events(spark, d), spec, {PK: [2, 3], CK: []}).select("event_id")


@query(f"select event_type, cast(sum(cast(value as decimal(18,2))) as decimal(28,2)) as total from ({_CURRENT_SQL}) group by all")
def agg_group_sum(spark, d):
    rows = table.read_table(spark, _OPTIONS | {"dirs": f"{d}/events.parquet"}, columns=["value"])
    return rows.groupBy(CK).agg(F.sum(_money(F.col("value"))).cast("decimal(28,2)").alias("total"))


@query(f"select user_id, count(*) as n from ({_CURRENT_SQL}) group by all")
def agg_count(spark, d):
    return table.read_table(spark, _OPTIONS | {"dirs": f"{d}/events.parquet"}, columns=["value"]).groupBy(PK).agg(F.count(F.lit(1)).alias("n"))


@query("select user_id, event_type, arg_max(value, ts) as value from events group by all having max(ts) > timestamp '2024-01-05 00:00:00'")
def ttl_read_time(spark, d):
    """Every version expires at its write time; the table is read as of a given time."""
    options = _OPTIONS | {"dirs": f"{d}/events.parquet", "expiresColumn": "ts", "readTime": "2024-01-05 00:00:00"}
    return table.read_table(spark, options, columns=["value"])


@query("select user_id, event_type, arg_max(value, ts) as value from events group by all having max(ts) > cast(now() as timestamp)")
def ttl_clock(spark, d):
    """Without a read time the clock decides: what expired long ago isn't there."""
    return table.read_table(spark, _OPTIONS | {"dirs": f"{d}/events.parquet", "expiresColumn": "ts"}, columns=["value"])


@query(f"select event_type, cast(sum(cast(value as decimal(18,2))) as decimal(28,2)) as total, count(*) as n from ({_CURRENT_SQL}) where user_id <= 40 group by all")
def src_table_sql(spark, d):
    table.register_table(spark, "quorate_events", _OPTIONS | {"dirs": f"{d}/events.parquet"})
    return spark.sql("select event_type, cast(sum(cast(value as decimal(18,2))) as decimal(28,2)) as total, count(*) as n from quorate_events where user_id <= 40 group by event_type")


@query("select 'k.t' || n_nationkey as name, n_nationkey % 3 <> 1 as cdc from nation")
def schema_cdc_toggle(spark, d):
    """Tables are declared with change capture on for every second key; then it is switched for some."""
    keys = [r[0] for r in spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey").collect()]
    specs = {f"k.t{k}": schema.parse_table(f"create table k.t{k} (a int primary key, b text) with cdc = {'true' if k % 2 else 'false'}") for k in keys}
    for k in keys:
        specs = schema.with_cdc(specs, f"k.t{k}", k % 3 != 1)
    on = set(schema.cdc_tables(specs))
    return spark.createDataFrame([(n, n in on) for n in specs], "name string, cdc boolean")


@query("select c_custkey, 'k.t' || c_nationkey as table from customer where c_nationkey % 3 <> 0")
def schema_table_id(spark, d):
    """Mutations carry a table's id; those of tables that the registry doesn't know are skipped."""
    keys = [r[0] for r in spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey").collect()]
    ids = {f"k.t{k}": hashlib.md5(str(k).encode()).hexdigest() for k in keys if k % 3}
    entries = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.md5(F.col("c_nationkey").cast("string").cast("binary")).alias("table_id"))
    return cdc.named_tables(entries, "table_id", ids).select("c_custkey", "table")


@query(
    """with c as (select n_nationkey as k, unnest([{'name': 'a', 'kind': 'partition', 'type': 'bigint', 'p': 0}, {'name': 'b', 'kind': 'clustering', 'type': 'string', 'p': 1},
      {'name': 's', 'kind': 'static', 'type': 'int', 'p': 2}, {'name': 'v', 'kind': 'value', 'type': case when n_nationkey % 2 = 0 then 'map<string,int>' else 'array<double>' end, 'p': 3}]) as f from nation)
    select 't' || k as tbl, f.name, f.kind, f.type, cast(f.p as bigint) as position from c"""
)
def schema_build(spark, d):
    rows = []
    for (k,) in spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey").collect():
        spec = schema.parse_table(f"create table k.t{k} (v {'list<double>' if k % 2 else 'map<text, int>'}, s int static, a bigint, b text, primary key (a, b))")
        kind = lambda f: "partition" if f.partition_key else "clustering" if f.clustering_key else "static" if f.static else "value"
        rows += [(spec.name, f.name, kind(f), f.type.simpleString(), f.position) for f in spec.fields]
    return spark.createDataFrame(rows, "tbl string, name string, kind string, type string, position bigint")


# --- keys, tokens, ring ---------------------------------------------------------------------------------------


def _token_sql(table: str, key: str) -> str:
    """CTEs that end in t(key, token): the tokens of a table's distinct bigint keys, in 128-bit arithmetic modulo 2^64."""
    steps: list[str] = []

    def step(**columns: str) -> None:
        steps.append(f"t{len(steps) + 1} as (select *, {', '.join(f'{e} as {n}' for n, e in columns.items())} from t{len(steps)})")

    wrap = lambda e: f"(({e}) % 18446744073709551616::uhugeint)"
    times = lambda x, c: wrap(f"{x} * {c}::uhugeint")
    rotated = lambda x, n: wrap(f"({x} << {n}) | ({x} >> {64 - n})")
    fold = lambda x: f"xor({x}, {x} >> 33)"
    tail = None
    for i in range(8):
        byte = f"(({key} >> {56 - 8 * i}) & 255)"
        signed = f"(case when {byte} > 127 then {byte}::uhugeint + 18446744073709551360::uhugeint else {byte}::uhugeint end)"
        part = wrap(f"{signed} << {8 * i}")
        tail = part if tail is None else f"xor({tail}, {part})"
    step(tail=tail)
    step(k=times("tail", 0x87C37B91114253D5))
    step(r=rotated("k", 31))
    step(k1=times("r", 0x4CF5AD432745937F))
    step(a=wrap("xor(k1, 8::uhugeint) + 8::uhugeint"))
    step(b=wrap("a + 8::uhugeint"))
    for n, c in ((0, 0xFF51AFD7ED558CCD), (1, 0xC4CEB9FE1A85EC53)):
        x, y = ("a", "b") if n == 0 else ("a0", "b0")
        step(fa=fold(x), fb=fold(y)) if n == 0 else step(ga=fold(x), gb=fold(y))
        step(**{f"a{n}": times("fa" if n == 0 else "ga", c), f"b{n}": times("fb" if n == 0 else "gb", c)})
    step(u=wrap(f"{fold('a1')} + {fold('b1')}"))
    last = f"select {key}, cast(case when u >= 9223372036854775808::uhugeint then u::hugeint - 18446744073709551616::hugeint else u::hugeint end as bigint) as token from t{len(steps)}"
    return f"t0 as (select distinct {key} from {table}), {', '.join(steps)}, t as ({last})"


_TOKENS = _token_sql("events", PK)


def _tokened(spark, d) -> DataFrame:
    return _events(spark, d).withColumn("token", tokens.murmur3_bigint(PK))


@query(
    """select distinct user_id, '0008' || lpad(lower(to_hex(user_id)), 16, '0') || '00' || lpad(lower(to_hex(octet_length(encode(event_type)))), 4, '0') || lower(hex(encode(event_type))) || '00' as key_hex from events"""
)
def key_encode(spark, d):
    key = tokens.composite_key(tokens.long_bytes(F.col(PK)), tokens.text_bytes(F.col(CK)))
    return _events(spark, d).select(PK, F.lower(F.hex(key)).alias("key_hex")).distinct()


@query("select distinct user_id, lpad(hex(user_id), 16, '0') as as_bigint, right(lpad(hex(user_id), 16, '0'), 8) as as_int, hex(encode(event_type)) as as_text from events")
def type_encode(spark, d):
    as_hex = lambda c, kind: F.hex(codec.encode_native(F.col(c), kind))
    return _events(spark, d).select(PK, as_hex(PK, "bigint").alias("as_bigint"), as_hex(PK, "int").alias("as_int"), as_hex(CK, "text").alias("as_text")).distinct()


@query("select event_id, user_id - 75 as n, event_type, value from events")
def type_decode(spark, d):
    shown = _events(spark, d).select("event_id", codec.encode_native(F.col(PK) - 75, "bigint").alias("n"), codec.encode_native(F.col(CK), "text").alias("t"), codec.encoder("double")(F.col("value")).alias("v"))
    return shown.select("event_id", codec.decode_native(F.col("n"), "bigint").alias("n"), codec.decode_native(F.col("t"), "text").alias("event_type"), codec.decoder("double")(F.col("v")).alias("value"))


@query(f"with {_TOKENS} select user_id, token from t")
def token_murmur3(spark, d):
    return _events(spark, d).select(PK).distinct().withColumn("token", tokens.murmur3_bigint(PK))


@query("select distinct event_type, case when substr(md5(event_type), 1, 1) < '8' then 'positive' else 'negated' end as half from events")
def token_random_half(spark, d):
    digest = F.md5(F.col(CK).cast("binary"))
    half = F.when(tokens.random_token_hex(F.col(CK).cast("binary")) == digest, "positive").otherwise("negated")
    return _events(spark, d).select(CK, half.alias("half")).distinct()


@query(
    """with h as (select c_name, md5(c_name) as d, translate(md5(c_name), '0123456789abcdef', 'fedcba9876543210') as x from customer),
    n as (select c_name, d, cast('0x' || substr(x, 1, 16) as ubigint) as high, cast('0x' || substr(x, 17, 16) as ubigint) as low from h),
    m as (select c_name, d, case when low = 18446744073709551615 then high + 1 else high end as high, case when low = 18446744073709551615 then 0 else low + 1 end as low from n)
    select c_name, case when substr(d, 1, 1) < '8' then d else lpad(lower(hex(high)), 16, '0') || lpad(lower(hex(low)), 16, '0') end as token from m"""
)
def token_random(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet")
    return c.select("c_name", tokens.random_token_hex(F.col("c_name").cast("binary")).alias("token"))


#: A quarter and three quarters of the way around the ring.
_FROM, _TO = -(2**62), 2**62


@query(f"with {_TOKENS} select user_id, token from t where token > {_FROM} and token <= {_TO}")
def filt_token_range(spark, d):
    return _tokened(spark, d).where(tokens.in_range(F.col("token"), _FROM, _TO)).select(PK, "token").distinct()


@query(f"with {_TOKENS} select user_id, event_type, value from ({_CURRENT_SQL}) join t using (user_id) where user_id in (1, 5, 9, 20, 33) and token > {_FROM} and token <= {_TO}")
def filt_key_in_range(spark, d):
    return _current(spark, d).where(table.keys_in_range(PK, [1, 5, 9, 20, 33], _FROM, _TO))


@query(f"with {_TOKENS} select event_id from events join t using (user_id) where user_id = 7 and token = (select token from t where user_id = 7)")
def filt_partition_key_bytes(spark, d):
    """One partition by its token and then its encoded key."""
    return table.partition_of(_events(spark, d), {PK: "bigint"}, {PK: 7}).select("event_id")


#: Every nation is an instance; every second one is in data centre DC2.
_INSTANCES = "i as (select n_name as node, ((n_nationkey * 7 + 3) % 25 - 12) * 700000000000000000 as token, case when n_nationkey % 2 = 0 then 'DC1' else 'DC2' end as dc, n_nationkey as k from nation)"
_LO, _HI = ring.MURMUR3
_LEAST = "(-9223372036854775807 - 1)"


def _ring(spark, d) -> list[ring.Instance]:
    keys = spark.read.parquet(f"{d}/nation.parquet").select("n_name", "n_nationkey").collect()
    return [ring.Instance(((k * 7 + 3) % 25 - 12) * 700000000000000000, name, "DC2" if k % 2 else "DC1") for name, k in keys]


@query(
    f"""with {_INSTANCES}, o as (select *, row_number() over (order by token) - 1 as rn, count(*) over () as n from i),
    w as (select a.node, a.token, b.token as start from o a join o b on b.rn = (a.rn + a.n - 3) % a.n)
    select node, cast(start as bigint) as range_start, cast(token as bigint) as range_end from w where start < token
    union all select node, cast(start as bigint), {_HI} from w where start >= token union all select node, {_LEAST}, cast(token as bigint) from w where start >= token"""
)
def ring_ranges(spark, d):
    owned = ring.owned_ranges(_ring(spark, d), 3)
    return spark.createDataFrame([(i.node, r.start, r.end) for i, rs in owned.items() for r in rs], "node string, range_start bigint, range_end bigint")


@query(
    f"""with {_INSTANCES}, cuts as (select token as c from i union select {_LEAST} union select {_HI}), r as (select c as a, lead(c) over (order by c) as b from cuts),
    o as (select r.a, r.b, i.node, row_number() over (partition by r.a, i.dc order by i.token < r.b, i.token) as n from r cross join i where r.b is not null)
    select cast(a as bigint) as range_start, cast(b as bigint) as range_end, string_agg(node, ',' order by node) as replicas from o where n <= 2 group by all"""
)
def ring_replicas(spark, d):
    nts = ring.parse_replication({"class": "NetworkTopologyStrategy", "dc1": "2", "dc2": "2", "dc3": "0"})
    rows = [(r.start, r.end, ",".join(sorted(i.node for i in who))) for r, who in ring.replica_map(_ring(spark, d), nts)]
    return spark.createDataFrame(rows, "range_start bigint, range_end bigint, replicas string")


@query(
    """with p as (select n_nationkey as k, n_nationkey * 1000 as a, n_nationkey * 1000 + 100 + n_nationkey as b, (100 + n_nationkey) // 3 as size from nation)
    select k, cast(a + x * size as bigint) as range_start, cast(least(a + x * size + size, b) as bigint) as range_end from (select *, unnest(range((b - a + size - 1) // size)) as x from p)"""
)
def range_split(spark, d):
    keys = [r[0] for r in spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey").collect()]
    parts = [(k, r.start, r.end) for k in keys for r in ring.split_range(ring.Range(k * 1000, k * 1000 + 100 + k), 3)]
    return spark.createDataFrame(parts, f"k {_key_type(spark, d)}, range_start bigint, range_end bigint")


def _key_type(spark, d) -> str:
    return spark.read.parquet(f"{d}/nation.parquet").schema["n_nationkey"].dataType.simpleString()


@query(f"with {_TOKENS} select user_id, cast((token::hugeint + 9223372036854775808::hugeint) // 4611686018427387904 as bigint) as part, count(*) as n from events join t using (user_id) group by all")
def token_to_partition(spark, d):
    part = tokens.bucket_of(F.col("token"), [-(2**62) - 1, -1, 2**62 - 1])
    return _tokened(spark, d).groupBy(PK, part.cast("long").alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """select r_name as keyspace, level, cast(case level when 'TWO' then 2 when 'THREE' then 3 when 'QUORUM' then (r_regionkey + 4) // 2 + 1 when 'ALL' then r_regionkey + 4
      when 'LOCAL_QUORUM' then (r_regionkey + 1) // 2 + 1 when 'EACH_QUORUM' then (r_regionkey + 1) // 2 + 1 + 2 else 1 end as bigint) as needed
    from region cross join (values ('ONE'), ('TWO'), ('THREE'), ('QUORUM'), ('ALL'), ('LOCAL_QUORUM'), ('EACH_QUORUM'), ('LOCAL_ONE'), ('ANY')) l(level)"""
)
def cl_block_for(spark, d):
    """Every region is a keyspace with r_regionkey + 1 copies in one data centre and 3 in the other."""
    levels = ["ONE", "TWO", "THREE", "QUORUM", "ALL", "LOCAL_QUORUM", "EACH_QUORUM", "LOCAL_ONE", "ANY"]
    rows = []
    for name, k in spark.read.parquet(f"{d}/region.parquet").select("r_name", "r_regionkey").collect():
        nts = ring.parse_replication({"class": "NetworkTopologyStrategy", "dc1": str(k + 1), "dc2": "3"})
        rows += [(name, x, ring.block_for(x, nts, "dc1")) for x in levels]
    return spark.createDataFrame(rows, "keyspace string, level string, needed bigint")


@query(
    """select n_name as keyspace, level, case when level in ('EACH_QUORUM', 'SERIAL', 'LOCAL_SERIAL') then false when level like 'LOCAL_%' and n_nationkey % 3 > 0 then n_regionkey < 2 else true end as allowed
    from nation cross join (values ('EACH_QUORUM'), ('LOCAL_QUORUM'), ('ONE'), ('SERIAL'), ('LOCAL_SERIAL'), ('LOCAL_ONE'), ('ALL')) l(level)"""
)
def cl_validate(spark, d):
    """Every nation is a keyspace: every third one of the simple strategy, the others in data centres 0 and 1; the reader is in that of its region."""
    rows = []
    for name, k, region in spark.read.parquet(f"{d}/nation.parquet").select("n_name", "n_nationkey", "n_regionkey").collect():
        simple, topology = {"class": "SimpleStrategy", "replication_factor": "3"}, {"class": "NetworkTopologyStrategy", "dc0": "3", "dc1": "3"}
        replication = ring.parse_replication(topology if k % 3 else simple)
        for level in ("EACH_QUORUM", "LOCAL_QUORUM", "ONE", "SERIAL", "LOCAL_SERIAL", "LOCAL_ONE", "ALL"):
            try:
                allowed = bool(ring.validate_level(level, replication, f"dc{region}"))
            except (ValueError, NotImplementedError):
                allowed = False
            rows.append((name, level, allowed))
    return spark.createDataFrame(rows, "keyspace string, level string, allowed boolean")


@query(
    """select n_name as keyspace, case when n_nationkey % 2 = 0 then 'NetworkTopologyStrategy' else 'SimpleStrategy' end as strategy,
    cast(case when n_nationkey % 2 = 0 then n_regionkey + 3 else n_regionkey + 1 end as bigint) as total, case when n_nationkey % 2 = 0 then 'EAST,WEST' else '' end as centres from nation"""
)
def rf_parse(spark, d):
    rows = []
    for name, k, region in spark.read.parquet(f"{d}/nation.parquet").select("n_name", "n_nationkey", "n_regionkey").collect():
        options = {"class": "SimpleStrategy", "replication_factor": str(region + 1)} if k % 2 else {"class": "org.example.locator.NetworkTopologyStrategy", "east": str(region), "West": "3"}
        r = ring.parse_replication(options)
        rows.append((name, r.strategy, r.total, ",".join(sorted(r.factors))))
    return spark.createDataFrame(rows, "keyspace string, strategy string, total bigint, centres string")


@query(f"with {_INSTANCES} select node from i where dc = 'DC2'")
def replica_candidates(spark, d):
    return spark.createDataFrame([(i.node,) for i in ring.replica_candidates(_ring(spark, d), "LOCAL_QUORUM", "dc2")], "node string")


_HELD_SQL = """r as (select t.user_id, i.node, i.token as place, row_number() over (partition by t.user_id order by i.token < t.token, i.token) as n from t cross join i),
    two as (select user_id, node, row_number() over (partition by user_id order by place) as m from r where n <= 3)"""


@query(f"with {_TOKENS}, {_INSTANCES}, {_HELD_SQL} select node, count(*) as n from events join two using (user_id) where m <= 2 group by all")
def src_partitioned(spark, d):
    """Every instance has a copy of every version; a quorum of the three replicas of each token answers."""
    instances = _ring(spark, d)
    parts = replicated.read_plan(instances, ring.parse_replication({"class": "SimpleStrategy", "replication_factor": "3"}), "QUORUM")
    held = _tokened(spark, d).select("event_id", "token", F.explode(F.array(*(F.lit(i.node) for i in instances))).alias("node"))
    return replicated.read_replicas(held, parts).groupBy("node").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {_TOKENS}, {_INSTANCES}, {_HELD_SQL.replace('n <= 3', 'n <= 3 and k % 4 > 0').replace('i.node, i.token as place', 'i.node, i.k, i.token as place')} select node, count(*) as n from events join two using (user_id) where m <= 1 group by all")
def replica_failover_read(spark, d):
    """Every fourth instance fails after the plan was made; the next backup of each range takes its place."""
    instances = _ring(spark, d)
    down = {n for n, k in spark.read.parquet(f"{d}/nation.parquet").select("n_name", "n_nationkey").collect() if k % 4 == 0}
    parts = replicated.without_failed(replicated.read_plan(instances, ring.parse_replication({"class": "SimpleStrategy", "replication_factor": "3"}), "ONE"), down)
    held = _tokened(spark, d).select("event_id", "token", F.explode(F.array(*(F.lit(i.node) for i in instances))).alias("node"))
    return replicated.read_replicas(held, parts).groupBy("node").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {_INSTANCES} select node, row_number() over (order by k % 3, token) <= 9 as is_primary from i")
def replica_split(spark, d):
    """Instances are up, unknown or down by their key's remainder."""
    keys = {n: k for n, k in spark.read.parquet(f"{d}/nation.parquet").select("n_name", "n_nationkey").collect()}
    first, rest = ring.choose_replicas([(i, ("UP", "UNKNOWN", "DOWN")[keys[i.node] % 3]) for i in _ring(spark, d)], 9)
    return spark.createDataFrame([(i.node, True) for i in first] + [(i.node, False) for i in rest], "node string, is_primary boolean")


@query(
    f"""with {_INSTANCES}, o as (select *, row_number() over (order by token) as rn from i), f as (select *, sum(case when rn > 10 and k % 4 > 0 then 1 else 0 end) over (order by token) as spare from o)
    select node from f where k % 4 > 0 and (rn <= 10 or spare <= (select count(*) from o where rn <= 10 and k % 4 = 0))"""
)
def replica_failover(spark, d):
    """The first ten instances are opened; of every four one fails and a backup takes its place."""
    keys = {n: k for n, k in spark.read.parquet(f"{d}/nation.parquet").select("n_name", "n_nationkey").collect()}

    def opener(i):
        if keys[i.node] % 4 == 0:
            raise OSError("down")
        return i.node

    r = sorted(_ring(spark, d))
    return spark.createDataFrame([(x,) for x in ring.open_replicas(r[:10], r[10:], opener)], "node string")


@query("select l_suppkey % 3 as replica, count(*) as n from lineitem where l_returnflag <> 'R' or l_suppkey % 3 = 0 group by all")
def repair_aware(spark, d):
    files = _lines(spark, d).select((F.col("l_suppkey") % 3).alias("replica"), (F.col("l_returnflag") == "R").alias("repaired"))
    return table.unrepaired_or_primary(files, "repaired", F.col("replica") == 0).groupBy("replica").agg(F.count(F.lit(1)).alias("n"))


@query("select user_id, event_id % 3 as file, cast(sum(octet_length(encode(props)) + 8) as bigint) as uncompressed, cast(sum(octet_length(encode(props))) as bigint) as compressed from events group by all")
def src_partition_size(spark, d):
    e = _events(spark, d).withColumn("file", F.col("event_id") % 3)
    return table.partition_sizes(e, [PK], "file", F.octet_length("props") + 8, F.octet_length("props"))


@query("select user_id, 'events.parquet' as file, cast(sum(octet_length(encode(cast(user_id as varchar))) + octet_length(encode(event_type)) + octet_length(encode(props))) as bigint) as uncompressed from events group by all")
def src_local_partition_size(spark, d):
    statement = "create table k.events (user_id bigint, event_type text, props text, primary key (user_id, event_type))"
    sizes = table.read_partition_sizes(spark, _OPTIONS | {"dirs": f"{d}/events.parquet", "createStmt": statement})
    return sizes.select(PK, "file", "uncompressed")


@query("select event_id, coalesce(lead(event_id * 10) over (partition by event_id % 3 order by event_id * 10), 1000000000) - event_id * 10 as uncompressed from events")
def partition_size_index(spark, d):
    e = _events(spark, d).select("event_id", (F.col("event_id") % 3).alias("file"), (F.col("event_id") * 10).alias("at"), F.lit(1000000000).cast("long").alias("len"))
    return table.partition_sizes_from_index(e, "file", "at", "len").select("event_id", "uncompressed")


# --- change events --------------------------------------------------------------------------------------------


@query(
    """select event_id, case when event_id % 211 = 0 then 'PARTITION_DELETE' when event_id % 97 = 0 then 'ROW_DELETE' when event_id % 89 = 0 then 'RANGE_DELETE' when event_id % 13 = 0 then 'COMPLEX_ELEMENT_DELETE'
    when event_id % 11 = 0 then 'DELETE' when event_type = 'signup' then 'INSERT' else 'UPDATE' end as kind from events"""
)
def cdc_kind(spark, d):
    return _events(spark, d).select("event_id", cdc.kind(_every(211), _every(97), _every(89), _every(13), _every(11), F.col(CK) == "signup").alias("kind"))


@query("select event_id, case when event_id % 3 <> 0 then 'value' || case when event_id % 11 = 0 then '-' else '+' end else '' end || case when event_id % 5 <> 0 then 'props+' else '' end as columns from events")
def cdc_event_build(spark, d):
    v = cdc.value("value", "double", F.when(~_every(11), F.col("value").cast("string")))
    cells = cdc.touched((~_every(3), v), (~_every(5), cdc.value("props", "text", F.col("props"))))
    shown = F.array_join(F.transform(cells, lambda c: F.concat(c["Name"], F.when(c["Value"].isNull(), "-").otherwise("+"))), "")
    return _events(spark, d).select("event_id", shown.alias("columns"))


_MUTATION = "user_id, event_id // 20 as mutation"


def _mutations(spark, d) -> DataFrame:
    """Up to 20 cells that one user's write holds."""
    return _events(spark, d).withColumn("mutation", F.floor(F.col("event_id") / 20))


@query(
    f"""select {_MUTATION}, string_agg(event_type || '=' || event_id, ',' order by event_type, event_id) filter (event_id % 3 <> 0) as live,
    coalesce(string_agg(event_type, ',' order by event_type) filter (event_id % 3 = 0), '') as deleted from events group by all"""
)
def cdc_complex(spark, d):
    cells = cdc.complex_cells(_mutations(spark, d), [PK, "mutation"], CK, "event_id", _every(3))
    shown = F.array_join(F.transform("live", lambda c: F.concat_ws("=", c["path"], c["value"].cast("string"))), ",")
    return cells.select(PK, "mutation", shown.alias("live"), F.array_join("deleted", ",").alias("deleted"))


@query("with s as (select user_id, arg_max(props, ts) as stored from events where event_type <> 'click' group by all) select event_id, stored from events left join s using (user_id) where event_type = 'click'")
def cdc_list_readback(spark, d):
    e = _events(spark, d)
    stored = reconcile.merge_cells(e.where(F.col(CK) != "click"), [PK], "ts", [Cell("stored", F.col("props"))])
    return e.where(F.col(CK) == "click").join(stored, PK, "left").select("event_id", "stored")


@query(
    """with m as (select user_id, event_id, row_number() over (partition by user_id order by event_id) rn, count(*) over (partition by user_id) n from events), o as (select *, lead(event_id) over (partition by user_id order by event_id) as hi from m)
    select user_id, event_id as lo, hi from o where rn < n"""
)
def cdc_range_tombstone(spark, d):
    w = Window.partitionBy(PK)
    rn, n = F.row_number().over(w.orderBy("event_id")), F.count(F.lit(1)).over(w)
    marks = _events(spark, d).select(PK, F.col("event_id").alias("at"), F.when(rn == 1, "open").when(rn == n, "close").otherwise("boundary").alias("kind"), F.lit(True).alias("inclusive"), n.alias("n")).where("n > 1")
    return cdc.require_closed(cdc.range_deletions(marks, [PK], "at")).select(PK, "lo", "hi")


@query(
    f"""with m as (select {_MUTATION}, arg_min(event_id % 7 * 86400, event_id) filter (event_id % 7 > 0) as ttl, arg_min(ts, event_id) filter (event_id % 7 > 0) as written from events group by all)
    select user_id, mutation, ttl, strftime(written + to_seconds(ttl), '%Y-%m-%d %H:%M:%S.%f') as expires from m"""
)
def cdc_ttl(spark, d):
    cells = _mutations(spark, d).withColumn("ttl", F.when(~_every(7), F.col("event_id") % 7 * 86400))
    found = cdc.first_ttl(cells, [PK, "mutation"], "event_id", "ttl", "ts")
    return found.select(PK, "mutation", "ttl", F.date_format("expires_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("expires"))


@query(
    f"""with c as (select {_MUTATION}, case when event_id % 5 > 0 then ts end as t, case when event_id % 5 = 0 then ts + interval 1 hour end as gone from events)
    select user_id, mutation, strftime(greatest(max(t), max(gone)), '%Y-%m-%d %H:%M:%S.%f') as modified from c group by all"""
)
def cdc_timestamp(spark, d):
    """Every fifth version is a deletion of the row, an hour later than its cells."""
    cells = _mutations(spark, d).select(PK, "mutation", F.when(~_every(5), F.col("ts")).alias("t"), F.when(_every(5), F.col("ts") + F.make_dt_interval(hours=F.lit(1))).alias("gone"))
    return cdc.event_time(cells, [PK, "mutation"], "t", "gone").select(PK, "mutation", F.date_format("modified", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("modified"))


@query("select user_id, event_id, row_number() over (partition by user_id order by ts) as seq from events")
def cdc_order(spark, d):
    return cdc.sequenced(_events(spark, d), [PK], "ts").select(PK, "event_id", "seq")


@query("select count(*) as n_updates from (select distinct user_id, event_type, case when event_id % 5 > 0 then props end, event_id % 10 = 0 from events)")
def cdc_digest(spark, d):
    """Props are deleted in some updates and not touched in others."""
    touched = F.when(_every(10), F.array(F.lit(PK))).otherwise(F.array(F.lit(PK), F.lit("props")))
    updates = _events(spark, d).withColumn("props", F.when(~_every(5), F.col("props")))
    return updates.select(cdc.digest(PK, CK, "props", touched=touched).alias("digest")).distinct().agg(F.count(F.lit(1)).alias("n_updates"))


def _copies(e: DataFrame) -> DataFrame:
    """Copies of each mutation on three replicas, some of them missing."""
    return e.withColumn("replica", F.explode(F.array(*(F.lit(i) for i in range(3))))).where((F.col("event_id") + F.col("replica") * 7) % 5 > 1)


_COPIES_SQL = "c as (select e.*, r as replica from events e, range(3) t(r) where (event_id + r * 7) % 5 > 1)"


@query(f"with {_COPIES_SQL} select event_id, count(*) as copies from c group by all having count(*) >= 2")
def cdc_quorum(spark, d):
    return cdc.quorum(_copies(_events(spark, d)), "event_id", 2, "replica").where("published").select("event_id", "copies")


@query("select user_id, event_type, count(*) as n_events from events group by all")
def cdc_no_compaction(spark, d):
    published = cdc.quorum(_events(spark, d), "event_id", 1).where("published")
    return _events(spark, d).join(published, "event_id", "left_semi").groupBy(PK, CK).agg(F.count(F.lit(1)).alias("n_events"))


@query("select n_name as keyspace, cast((n_nationkey % 5 + 1) // 2 + 1 as bigint) as needed from nation")
def cdc_required_replicas(spark, d):
    keys = spark.read.parquet(f"{d}/nation.parquet").select("n_name", "n_nationkey").collect()
    rows = [(n, ring.block_for("QUORUM", ring.parse_replication({"class": "SimpleStrategy", "replication_factor": str(k % 5 + 1)}))) for n, k in keys]
    return spark.createDataFrame(rows, "keyspace string, needed bigint")


@query(f"with {_TOKENS} select event_id from events join t using (user_id) where event_type in ('click', 'view', 'purchase') and token > {_FROM} and token <= {_TO} and ts >= timestamp '2024-01-05 00:00:00' - interval 600 second")
def cdc_filters(spark, d):
    """Event types are tables here; change capture is on for three of them."""
    oldest = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(600))
    return cdc.in_scope(_tokened(spark, d), CK, ["click", "view", "purchase"], "token", _FROM, _TO, "ts", oldest).select("event_id")


@query(
    """with c as (select 'events' as tbl, event_id as id, 2 as needed from events, range(3) t(r) where (event_id + r * 7) % 5 > 1
      union all select 'orders', o_orderkey, 1 from orders, range(3) t(r) where (o_orderkey + r * 7) % 5 > 1),
    p as (select tbl, id from c group by tbl, id, needed having count(*) >= needed) select tbl, count(*) as n from p group by all"""
)
def cdc_multi_table(spark, d):
    """Two tables in one stream, whose keyspaces need one and two replicas."""
    orders = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").cast("long").alias("event_id"))
    copies = cdc.of_table(_copies(_events(spark, d).select("event_id")), "k", "events", 2).unionByName(cdc.of_table(_copies(orders), "m", "orders", 1))
    copies = copies.withColumn("update", F.struct("Keyspace", "Table", "needed", "event_id"))
    found = cdc.quorum(copies, "update", F.col("update.needed"), "replica").where("published")
    return found.groupBy(F.col("update.Table").alias("tbl")).agg(F.count(F.lit(1)).alias("n"))


@query("select event_id from events where ts >= (select max(ts) from events) - interval 6000 second")
def st_window(spark, d):
    e = _events(spark, d)
    return cdc.within_window(e, "ts", e.agg(F.max("ts")).scalar(), 6000).select("event_id")


@query(f"with {_COPIES_SQL} select event_id, count(*) as copies from c group by all having count(*) >= 2")
def st_late_publish(spark, d):
    """The first batch has one replica's copies; the second brings them once more, with the others."""
    c = _copies(_events(spark, d))
    early = c.where("replica = 0")
    state = cdc.pending(early, cdc.quorum(early, "event_id", 2, "replica"), "event_id", "replica")
    return cdc.quorum(c, "event_id", 2, "replica", seen=state).where("published").select("event_id", "copies")


@query(f"with {_COPIES_SQL} select count(*) as lost from (select event_id from c group by all having count(*) >= 2 and count(*) filter (replica = 0) < 2 and count(*) filter (replica > 0) < 2)")
def st_null_state(spark, d):
    """Without a state an update whose copies come in two batches is never published."""
    c = _copies(_events(spark, d))
    batches = [cdc.quorum(c.where(w), "event_id", 2, "replica").where("published").select("event_id") for w in ("replica = 0", "replica > 0")]
    whole = cdc.quorum(c, "event_id", 2, "replica").where("published").select("event_id")
    return whole.join(batches[0].unionByName(batches[1]), "event_id", "left_anti").agg(F.count(F.lit(1)).alias("lost"))


@query(f"with {_COPIES_SQL}, {_TOKENS} select event_id, count(*) as copies from c join t using (user_id) where token > {_FROM} and token <= {_TO} group by all")
def st_state_merge(spark, d):
    """Two states that overlap become that of a new token range: a replica that both know counts once."""
    c = _copies(_tokened(spark, d)).select("event_id", "replica", "token")
    merged = cdc.merged_states(c.where("replica <= 1"), c.where("replica >= 1"), within=tokens.in_range(F.col("token"), _FROM, _TO))
    return merged.groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))


def _log_lines(spark, d) -> DataFrame:
    """The copies of the events as lines of logs of three nodes."""
    line = F.to_json(F.struct(F.col("event_id").cast("string").alias("digest"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), F.col("props").alias("body")))
    node = F.concat(F.lit("n"), F.col("replica").cast("string"))
    return _copies(_events(spark, d)).select(node.alias("instance"), F.floor(F.col("event_id") / 2000).alias("segment"), F.col("event_id").alias("position"), line.alias("line"))


@query(f"with {_COPIES_SQL} select event_id from c group by all having count(*) >= 2")
def src_cdc_stream(spark, d):
    """Logs of three nodes as a stream; an update is published once two of them have it."""
    folder = source.shared_folder(spark, "logs")
    source.write_logs(_log_lines(spark, d), folder)
    quorum.use_state_store(spark)
    spark.dataSource.register(source.MutationLogSource)
    rows = spark.readStream.format("mutation_log").option("problems", "keep").load(folder)
    found = quorum.published(source.counted_problems(rows).select("digest", "replica"), 2)
    out = source.shared_folder(spark, "published")
    run = found.writeStream.format("parquet").option("checkpointLocation", source.shared_folder(spark, "progress")).trigger(availableNow=True).start(out)
    run.awaitTermination()
    return spark.read.schema("digest string, copies long").parquet(out).select(F.col("digest").cast("long").alias("event_id"))


@query(f"with {_COPIES_SQL} select event_id, count(*) as copies from c group by all having count(*) >= 2")
def src_cdc_jdk(spark, d):
    """The same logs pulled in two epochs: one node's first, the others' after; the state goes through its saved form."""
    logs, epochs = source.shared_folder(spark, "logs"), source.shared_folder(spark, "epochs")
    window = {"windowSeconds": "1e11"}
    source.write_logs(_log_lines(spark, d).where("instance = 'n0'"), logs)
    first = iterator.ChangeIterator(spark, logs, 2, epochs, options=window)
    early = next(first)
    source.write_logs(_log_lines(spark, d).where("instance <> 'n0'"), logs)
    late = next(iterator.ChangeIterator(spark, logs, 2, epochs, iterator.State.from_bytes(first.state.to_bytes()), window))
    return early.unionByName(late).select(F.col("digest").cast("long").alias("event_id"), "copies")


_LOG_SQL = "l as (select 'i' || (user_id % 3) as instance, event_id // 1000 as segment, event_id % 1000 as position from events)"


def _log(spark, d):
    return _events(spark, d).select(F.concat(F.lit("i"), (F.col(PK) % 3).cast("string")).alias("instance"), F.floor(F.col("event_id") / 1000).cast("long").alias("segment"), (F.col("event_id") % 1000).alias("position"))


@query(f"with {_LOG_SQL} select instance, segment, position from l where (segment, position) >= (0, 500)")
def st_marker_skip(spark, d):
    markers = spark.createDataFrame([(f"i{i}", 0, 500) for i in range(3)], "instance string, segment bigint, position bigint")
    return cdc.after_markers(_log(spark, d), markers)


@query(f"with {_LOG_SQL} select instance, max(segment * 1000 + position) as marker from l group by all")
def st_latest_offset(spark, d):
    return cdc.latest_markers(_log(spark, d)).select("instance", (F.col("segment") * 1000 + F.col("position")).alias("marker"))


@query(f"with {_LOG_SQL} select instance, min(segment * 1000 + position) as marker from (select * from l where position > 10) group by all")
def st_markers_merge(spark, d):
    e = _log(spark, d).where("position > 10")
    low = e.groupBy("instance").agg(F.min(F.struct("segment", "position")).alias("m")).select("instance", "m.segment", "m.position")
    return cdc.least_markers(cdc.latest_markers(e), low).select("instance", (F.col("segment") * 1000 + F.col("position")).alias("marker"))


_RANGED_SQL = f"""{_LOG_SQL}, g as (select *, user_id % 4 as range from (select e.*, l.instance, l.segment, l.position from events e join (select event_id, 'i' || (user_id % 3) as instance, event_id // 1000 as segment, event_id % 1000 as position from events) l using (event_id)))"""


def _ranged(spark, d) -> DataFrame:
    return _events(spark, d).select("event_id", (F.col(PK) % 4).alias("range"), F.concat(F.lit("i"), (F.col(PK) % 3).cast("string")).alias("instance"), F.floor(F.col("event_id") / 1000).cast("long").alias("segment"), (F.col("event_id") % 1000).alias("position"))


def _range_markers(entries: DataFrame) -> DataFrame:
    """Token range 0 was read up to position 300 of each log's first segment, range 1 to 600; the others not at all."""
    ends = entries.where("segment = 0 and ((range = 0 and position <= 300) or (range = 1 and position <= 600))")
    return ends.groupBy("range", "instance").agg(F.max(F.struct("segment", "position")).alias("m")).select("range", "instance", "m.segment", "m.position")


_RANGE_MARKERS_SQL = f"""{_RANGED_SQL}, k as (select range, instance, max(position) as p from g where segment = 0 and ((range = 0 and position <= 300) or (range = 1 and position <= 600)) group by all)"""


@query(f"with {_RANGE_MARKERS_SQL} select event_id from g left join k using (range, instance) where p is null or segment > 0 or position >= p")
def st_range_markers(spark, d):
    e = _ranged(spark, d)
    return cdc.after_range_markers(e, cdc.range_markers(_range_markers(e.where("range = 0")), _range_markers(e.where("range = 1")))).select("event_id")


@query(f"with {_RANGE_MARKERS_SQL} select instance, min(p) as position from k group by all")
def st_start_markers(spark, d):
    return cdc.start_markers(_range_markers(_ranged(spark, d))).select("instance", "position")


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
