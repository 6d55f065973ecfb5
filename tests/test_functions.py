import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorate.functions import schema, tokens
from quorate.operators import ring
from quorate.plans import catalogue


def test_murmur3_vectors():
    want = {1: -4069959284402364209, 2: -3248873570005575792, 3: 9010454139840013625, 5: -7509452495886106294}
    for k, v in want.items():
        assert tokens.murmur3_token(k.to_bytes(4, "big")) == v


def test_tokens_of_numbers(spark):
    r = np.random.default_rng(1)
    keys = [1, 2, -1, 0, 200, 2**53 + 1, 2**63 - 1, -(2**63), 2**31 - 1, -(2**31), *r.integers(-(2**63), 2**63 - 1, 200).tolist()]
    rows = spark.createDataFrame([(k, k % 2**32 - 2**31) for k in keys] + [(None, None)], "k bigint, i int")
    for x in rows.select("*", tokens.murmur3_bigint("k").alias("kt"), tokens.murmur3_int("i").alias("it")).collect():
        assert x.kt == (None if x.k is None else tokens.murmur3_token(x.k.to_bytes(8, "big", signed=True)))
        assert x.it == (None if x.i is None else tokens.murmur3_token(x.i.to_bytes(4, "big", signed=True)))


def test_tokens_of_bytes(spark):
    r = np.random.default_rng(2)
    keys = [r.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (*range(40), 200, 15, 16, 17)]
    assert tokens._tokens(keys).tolist() == [tokens.murmur3_token(k) for k in keys]
    rows = spark.createDataFrame([(bytearray(k),) for k in keys[1:]] + [(None,)], "k binary").select("k", tokens.murmur3("k").alias("t")).collect()
    assert all(x.t == (None if x.k is None else tokens.murmur3_token(bytes(x.k))) for x in rows)


def test_random_token(spark):
    keys = [bytes([i, j]) for i in range(16) for j in range(8)]
    rows = spark.createDataFrame([(bytearray(k),) for k in keys], "k binary").select("k", tokens.random_token_hex(F.col("k")).alias("t")).collect()
    for r in rows:
        assert int(r["t"], 16) == abs(int.from_bytes(hashlib.md5(bytes(r["k"])).digest(), "big", signed=True))


def test_plus_one_carries(spark):
    rows = spark.createDataFrame([("0123456789abcdef",), ("00000000000fffff",), ("7fffffffffffffff",)], "h string")
    assert [int(r[0], 16) for r in rows.select(tokens._plus_one(F.col("h"))).collect()] == [0x0123456789ABCDF0, 0x100000, 0x8000000000000000]


def test_composite_key(spark):
    key = tokens.composite_key(tokens.int_bytes(F.lit(1)), tokens.text_bytes(F.lit("ab")))
    assert bytes(spark.range(1).select(key).first()[0]) == b"\x00\x04\x00\x00\x00\x01\x00\x00\x02ab\x00"
    assert bytes(spark.range(1).select(tokens.int_bytes(F.lit(-2))).first()[0]) == b"\xff\xff\xff\xfe"


def test_types():
    assert schema.parse_type("map<text, frozen<set<int>>>") == T.MapType(T.StringType(), T.ArrayType(T.IntegerType()))
    assert schema.parse_type("tuple<int, map<text, int>>").fieldNames() == ["0", "1"]
    assert schema.parse_type("varint", decimals=(10, 2)) == T.DecimalType(10, 2)
    for bad in ("counter", "duration", "list<empty>", "nonsense"):
        with pytest.raises(ValueError):
            schema.parse_type(bad)


def test_table_statement():
    spec = schema.parse_table(
        'CREATE TABLE ks.T (a uuid, b int, s text static, z frozen<outer_t>, c bigint, PRIMARY KEY ((a, b), c)) WITH CLUSTERING ORDER BY (c DESC) AND cdc = true',
        ["CREATE TYPE ks.outer_t (x int, y frozen<inner_t>)", "CREATE TYPE ks.inner_t (v text)"], ("last_modified_timestamp",),
    )
    assert (spec.partition_keys, spec.clustering_keys, spec.statics, spec.values) == (["a", "b"], ["c"], ["s"], ["z"])
    assert spec.cdc and spec.descending == ("c",)
    assert spec.schema().fieldNames() == ["a", "b", "c", "s", "z", "last_modified_timestamp"]
    assert spec.schema()["c"].metadata["isClusteringKey"] and not spec.schema()["c"].metadata["isPartitionKey"]
    with pytest.raises(ValueError):
        schema.parse_udts(["CREATE TYPE a (x frozen<b>)", "CREATE TYPE b (x frozen<a>)"])
    with pytest.raises(KeyError):
        schema.evolved({}, spec)


def test_ring():
    nodes = [ring.Instance(t, f"n{t}") for t in (0, 100, 200)]
    lo, hi = ring.MURMUR3
    one = ring.owned_ranges(nodes, 1)
    assert one[nodes[1]] == [ring.Range(0, 100)] and one[nodes[0]] == [ring.Range(200, hi), ring.Range(lo, 0)]
    assert all(r == [ring.Range(lo, hi)] for r in ring.owned_ranges(nodes, 3).values())
    with pytest.raises(ValueError):
        ring.owned_ranges(nodes, 4)
    rep = ring.parse_replication({"class": "SimpleStrategy", "replication_factor": "2"})
    parts = ring.replica_map(nodes, rep)
    assert all(len(who) == 2 for _, who in parts)
    assert parts[0][0].start == lo and parts[-1][0].end == hi and all(a[0].end == b[0].start for a, b in zip(parts, parts[1:]))
    assert sum(r.end - r.start for r in ring.split_range(ring.Range(0, 100), 3)) == 100
    with pytest.raises(ring.NotEnoughReplicas):
        ring.choose_replicas([(nodes[0], "UP")], 2)


def test_bucket_of(spark):
    cuts = [-5, 0, 7, 8]
    rows = spark.range(-10, 15).select("id", tokens.bucket_of(F.col("id"), cuts).alias("n")).collect()
    assert all(r["n"] == sum(c < r["id"] for c in cuts) for r in rows)


def test_read_plan(spark):
    from quorate.sources import replicated

    nodes = [ring.Instance(100 * i, f"n{i}", ("dc1", "dc2")[i % 2]) for i in range(6)]
    nts = ring.parse_replication({"class": "NetworkTopologyStrategy", "dc1": "3", "dc2": "3"})
    parts = replicated.read_plan(nodes, nts, "LOCAL_QUORUM", "dc1", {"n0": "DOWN"})
    assert all({i.node for i in p.primary} == {"n2", "n4"} and [i.node for i in p.backup] == ["n0"] for p in parts)
    after = replicated.without_failed(parts, {"n2"})
    assert all([i.node for i in p.primary] == ["n4", "n0"] for p in after)
    with pytest.raises(ring.NotEnoughReplicas):
        replicated.without_failed(after, {"n2", "n4"})
    assert ring.uncovered([ring.Range(ring.MURMUR3[0], 5), ring.Range(9, ring.MURMUR3[1])]) == [ring.Range(5, 9)]
    held = spark.createDataFrame([(t, f"n{i}", rep) for t in (-3, 50, 900) for i in range(6) for rep in (True, False)], "token long, node string, repaired boolean")
    got = {(r.token, r.node, r.repaired) for r in replicated.read_replicas(held, parts, repaired="repaired").collect()}
    assert got == {(t, n, rep) for t in (-3, 50, 900) for n, rep in (("n2", True), ("n2", False), ("n4", False))}


def test_random_tokens_of_all_customers(spark):
    rows = catalogue.queries()["token_random"](spark, "/root/testdata/sf0.001").collect()
    signed = {r.c_name: int.from_bytes(hashlib.md5(r.c_name.encode()).digest(), "big", signed=True) for r in rows}
    assert min(signed.values()) < 0 < max(signed.values())
    assert all(int(r.token, 16) == abs(signed[r.c_name]) and len(r.token) == 32 for r in rows)
