import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from quorate.operators import cdc, reconcile
from quorate.operators.reconcile import Cell
from quorate.sources import table


def test_merge_does_not_depend_on_files(spark, tmp_path):
    r = random.Random(3)
    rows = [(r.randint(0, 5), r.randint(0, 3), r.randint(0, 40), r.choice([None, r.randint(0, 9)])) for _ in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, ts int, v int")
    cell = [Cell("v", F.col("v"), is_dead=F.col("v").isNull())]
    want = {(x.a, x.b): x.v for x in reconcile.merge_cells(df, ["a", "b"], "ts", cell).collect()}
    for files in (1, 2, 5):
        again = df.union(df).repartition(files)
        assert {(x.a, x.b): x.v for x in reconcile.merge_cells(again, ["a", "b"], "ts", cell).collect()} == want
    for (a, b), v in want.items():  # a deletion beats a value of the same time, then the greater value wins
        last = max(t for x, y, t, _ in rows if (x, y) == (a, b))
        at = [w for x, y, t, w in rows if (x, y, t) == (a, b, last)]
        assert v == (None if None in at else max(at))


def test_expired_cell_does_not_bring_back_the_older_one(spark):
    t = lambda n: datetime.datetime(2024, 1, n)
    df = spark.createDataFrame([(1, t(1), "old", None), (1, t(2), "new", t(3))], "a int, ts timestamp_ntz, v string, e timestamp_ntz")
    cell = [Cell("v", F.col("v"), expires_at=F.col("e"))]
    at = lambda n: reconcile.merge_cells(df, ["a"], "ts", cell, now=F.lit(t(n)).cast("timestamp_ntz")).first()["v"]
    assert at(2) == "new" and at(4) is None


def test_range_bounds(spark):
    v = spark.createDataFrame([(1, i, 1) for i in range(6)], "a int, b int, ts int")
    for inclusive in (True, False):
        ranges = spark.createDataFrame([(1, 2, inclusive, 4, inclusive, 1)], "a int, lo int, lo_inclusive boolean, hi int, hi_inclusive boolean, deleted_at int")
        left = {x.b for x in reconcile.without_ranges(v, ranges, ["a"], "b", "ts").collect()}
        assert left == ({0, 1, 5} if inclusive else {0, 1, 2, 4, 5})
    later = v.withColumn("ts", F.lit(2))
    assert reconcile.without_ranges(later, ranges, ["a"], "b", "ts").count() == 6


def test_elements_merge_across_files(spark):
    e = spark.createDataFrame([(1, "x", 1, "a", False), (1, "x", 2, "b", False), (1, "y", 1, "c", False), (1, "y", 3, "c", True)], "k int, p string, ts int, v string, dead boolean")
    won = reconcile.merge_elements(e, ["k"], "p", "ts", "v", F.col("dead"))
    assert reconcile.as_map(won, ["k"], "p", "v", "m").first()["m"] == {"x": "b"}


def test_read_table(spark, tmp_path):
    rows = [(1, 1, 10, "a", 5, None), (1, 1, 20, None, 6, ["d"]), (1, 2, 10, None, None, None), (2, 1, 5, "z", 7, None)]
    spark.createDataFrame(rows, "a int, b int, write_ts int, d string, c int, unset array<string>").write.parquet(str(tmp_path / "v"))
    options = {"keyspace": "k", "createStmt": "create table k.t (a int, b int, c int, d text, st int static, primary key (a, b))", "dirs": str(tmp_path / "v")}
    got = {(r.a, r.b): (r.c, r.d, r.st) for r in table.read_table(spark, options).collect()}
    assert got == {(1, 1): (6, "a", None), (2, 1): (7, "z", None)}


def test_ties_follow_the_bytes(spark):
    df = spark.createDataFrame([(1, 1, -1, -0.5), (1, 1, 7, 2.0)], "k int, ts int, i int, d double")
    got = reconcile.merge_cells(df, ["k"], "ts", [Cell("i", F.col("i")), Cell("d", F.col("d")), Cell("m", F.create_map(F.lit("x"), F.col("i")))]).first()
    assert (got["i"], got["d"], got["m"]) == (-1, -0.5, {"x": 7})


def test_deletions_against_brute_force(spark):
    r = random.Random(11)
    rows = [(r.randint(0, 3), r.randint(0, 3), r.randint(0, 3), r.randint(0, 9)) for _ in range(400)]
    dels = []
    for _ in range(25):
        lo, hi = ([r.randint(0, 3) for _ in range(n)] + [None] * (2 - n) for n in (r.randint(0, 2), r.randint(0, 2)))
        dels.append((r.randint(0, 3), *lo, *hi, r.random() < 0.5, r.random() < 0.5, r.randint(0, 5)))
    dels += [(1, 2, 2, 2, 2, True, True, 6), (2, None, None, None, None, True, True, 3)]
    v = spark.createDataFrame(rows, "p int, a int, b int, ts int")
    d = spark.createDataFrame(dels, "p int, lo_a int, lo_b int, hi_a int, hi_b int, lo_inclusive boolean, hi_inclusive boolean, deleted_at int")

    def hidden(row, x):
        lo, hi = ([c for c in part if c is not None] for part in (x[1:3], x[3:5]))
        key = list(row[1:3])
        above = not lo or key[: len(lo)] > lo or (x[5] and key[: len(lo)] == lo)
        below = not hi or key[: len(hi)] < hi or (x[6] and key[: len(hi)] == hi)
        return row[0] == x[0] and row[3] <= x[7] and above and below

    want = sorted(row for row in rows if not any(hidden(row, x) for x in dels))
    assert sorted(tuple(x) for x in reconcile.without_deletions(v, d, ["p"], ["a", "b"], "ts").select("p", "a", "b", "ts").collect()) == want
    assert 0 < len(want) < len(rows)


def test_read_table_with_deletions_and_collections(spark, tmp_path):
    versions = [
        (1, 1, 10, 5, 50, {"x": 1, "y": 2}, None, None), (1, 1, 20, 6, None, {"x": 3}, ["y"], None),
        (1, 2, 10, 7, None, {"q": 1}, None, None), (1, 2, 30, None, None, {"z": 9}, None, True),
        (2, 1, 10, 8, 60, None, None, None), (3, 1, 10, 9, 70, {"k": 1}, None, None),
    ]
    spark.createDataFrame(versions, "a int, b int, write_ts int, c int, s int, m_put map<string,int>, m_removed array<string>, m_replaced boolean").write.parquet(str(tmp_path / "v"))
    deletions = [(2, None, None, None, None, 10), (3, 1, 1, True, True, 10), (1, 1, 1, True, True, 9)]
    spark.createDataFrame(deletions, "a int, lo_b int, hi_b int, lo_inclusive boolean, hi_inclusive boolean, deleted_at int").write.parquet(str(tmp_path / "d"))
    options = {"keyspace": "k", "createStmt": "create table k.t (a int, b int, c int, m map<text, int>, s int static, primary key (a, b))", "dirs": str(tmp_path / "v"), "deletionDirs": str(tmp_path / "d")}
    got = {(r.a, r.b): (r.c, r.m) for r in table.read_table(spark, options).collect()}
    assert got == {(1, 1): (6, {"x": 3}), (1, 2): (None, {"z": 9})}


def test_key_filters_need_every_key():
    spec = table.parse_table("create table t (a int, b int, c int, primary key ((a, b)))")
    assert table.key_filters(spec, {"a": [1, 2]}) is None and table.key_filters(spec, {"a": [1, 2], "b": []}) == []
    assert table.key_filters(spec, {"a": [2, 3], "b": [2, 3, 4]}) == [(a, b) for a in (2, 3) for b in (2, 3, 4)]


def test_boundary_markers(spark):
    m = spark.createDataFrame([(1, 1, "open", True), (1, 5, "boundary", False), (1, 9, "close", True), (2, 3, "open", True)], "k int, at int, kind string, inclusive boolean")
    got = {(r.k, r.lo, r.hi, r.unclosed) for r in cdc.range_deletions(m, ["k"], "at").collect()}
    assert got == {(1, 1, 5, False), (1, 5, 9, False), (2, 3, None, True)}


def test_stream_quorum_equals_batch(spark, tmp_path):
    from quorate.streaming import quorum
    from quorate.streaming.source import MutationLogSource

    r = random.Random(5)
    copies = [(f"d{i}", rep) for i in range(60) for rep in ("n0", "n1", "n2") if r.random() < 0.6]
    for node in ("n0", "n1", "n2"):
        (tmp_path / "log" / node).mkdir(parents=True)
        lines = [json.dumps({"digest": d, "ts": 1, "body": {}}) for d, rep in copies if rep == node]
        (tmp_path / "log" / node / "1.log").write_text("".join(f"{x}\n" for x in lines))
    spark.dataSource.register(MutationLogSource)
    stream = spark.readStream.format("mutation_log").load(str(tmp_path / "log")).select("digest", "replica")
    seen = []
    quorum.write_events(quorum.published(stream, 2), lambda df, _: seen.extend(x.digest for x in df.collect()), str(tmp_path / "cp")).awaitTermination(120)
    batch = cdc.quorum(spark.createDataFrame(copies, "digest string, replica string"), "digest", 2, "replica").where("published")
    assert sorted(seen) == sorted(x.digest for x in batch.collect())


def test_expired_rows_go_by_the_clock(spark, tmp_path):
    rows = [(1, 1, 10, 5, datetime.datetime(2020, 1, 1)), (1, 2, 10, 6, datetime.datetime(2999, 1, 1)), (1, 3, 10, 7, None)]
    spark.createDataFrame(rows, "a int, b int, write_ts int, c int, expires_at timestamp_ntz").write.parquet(str(tmp_path / "v"))
    options = {"keyspace": "k", "createStmt": "create table k.t (a int, b int, c int, d text, primary key (a, b))", "dirs": str(tmp_path / "v")}
    assert sorted(r.b for r in table.read_table(spark, options).collect()) == [2, 3]
    assert sorted(r.b for r in table.read_table(spark, options | {"readTime": "2019-12-31 00:00:00"}).collect()) == [1, 2, 3]


def test_an_empty_list_of_keys_gives_no_row(spark):
    spec = table.parse_table("create table t (a int, b int, c int, primary key ((a, b)))")
    rows = spark.range(10).select(F.col("id").alias("a"), F.col("id").alias("b"))
    assert table.with_key_filter(rows, spec, {"a": [1, 2], "b": []}).count() == 0
    assert table.with_key_filter(rows, spec, {"a": [1, 2]}).count() == 10
    assert table.with_key_filter(rows, spec, {"a": [1, 2], "b": [2, 3]}).count() == 1
    assert rows.where(table.keys_in_range("a", [1, 2, 3], 0, 0)).count() == 0


def test_elements_tie_and_expire_as_cells_do(spark):
    t = lambda n: datetime.datetime(2024, 1, n)
    e = spark.createDataFrame([(1, "x", 1, 5, False, None), (1, "x", 1, -5, False, None), (1, "y", 1, 7, False, t(2)), (1, "z", 1, 1, False, None), (1, "z", 1, 2, True, None)], "k int, p string, ts int, v int, dead boolean, e timestamp_ntz")
    won = reconcile.merge_elements(e, ["k"], "p", "ts", "v", F.col("dead"), F.col("e"), F.lit(t(3)).cast("timestamp_ntz"))
    assert [(r.p, r.v) for r in won.collect()] == [("x", -5)]


def test_a_deletion_that_is_left_is_an_error(spark):
    rows = spark.createDataFrame([(1, False), (2, True)], "k int, dead boolean")
    assert reconcile.guarded(rows.where("not dead"), F.array("dead")).count() == 1
    with pytest.raises(Exception, match="deletion is left"):
        reconcile.guarded(rows, F.array("dead")).collect()


def test_a_replica_counts_once_over_batches(spark):
    a = spark.createDataFrame([("d1", "n0"), ("d2", "n0"), ("d2", "n1")], "digest string, replica string")
    state = cdc.pending(a, cdc.quorum(a, "digest", 2, "replica"), "digest", "replica")
    assert [tuple(r) for r in state.collect()] == [("d1", "n0")]
    again = cdc.quorum(spark.createDataFrame([("d1", "n0")], a.schema), "digest", 2, "replica", seen=state)
    assert [tuple(r) for r in again.collect()] == [("d1", 1, False)]


def test_open_interval_is_an_error(spark):
    m = spark.createDataFrame([(1, 1, "open", True)], "k int, at int, kind string, inclusive boolean")
    with pytest.raises(Exception, match="never closed"):
        cdc.require_closed(cdc.range_deletions(m, ["k"], "at")).collect()


def test_clustered_versions_merge_without_a_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"), F.col("id").alias("ts"), F.col("id").alias("v"))
    table.save_clustered(rows, "clustered_versions", ["a"], 4)
    merged = reconcile.merge_cells(spark.table("clustered_versions"), ["a", "b"], "ts", [Cell("v", F.col("v"))])
    assert merged.count() == 21 and "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
    spark.sql("drop table clustered_versions")


def test_index_sizes_over_stretches(spark):
    rows = [(f, at, 1_000) for f in range(3) for at in (0, 5, 99, 100, 101, 450, 999)]
    index = spark.createDataFrame(rows, "file int, at bigint, len bigint")
    want = {(f, a): n for f in range(3) for a, n in zip((0, 5, 99, 100, 101, 450, 999), (5, 94, 1, 1, 349, 549, 1))}
    got = {(r.file, r.at): r.uncompressed for r in table.partition_sizes_from_index(index, "file", "at", "len", stretch=100).collect()}
    assert got == want


def test_precision_through_options():
    options = {"keyspace": "k", "createStmt": "create table k.t (a int primary key, v varint, d decimal)", "dirs": "x", "decimals": "v:20:0, d:10:2"}
    kinds = {f.name: f.type.simpleString() for f in table.spec_from_options(options).fields}
    assert kinds == {"a": "int", "v": "decimal(20,0)", "d": "decimal(10,2)"}


def test_partition_sizes_by_options(spark, tmp_path):
    for i in range(2):
        spark.createDataFrame([(k, "x" * (k + i)) for k in range(1, 4) for _ in range(5)], "a int, c string").coalesce(1).write.parquet(str(tmp_path / f"v{i}"))
    options = {"keyspace": "k", "createStmt": "create table k.t (a int, c text, primary key (a))", "dirs": f"{tmp_path}/v0,{tmp_path}/v1"}
    rows = table.read_partition_sizes(spark, options).collect()
    assert len(rows) == 6 and sorted(r.uncompressed for r in rows if r.a == 2) == [5 * 3, 5 * 4] and all(0 < r.compressed for r in rows)
