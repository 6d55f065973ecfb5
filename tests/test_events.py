import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from quorate.functions import codec
from quorate.operators import cdc
from quorate.streaming import messages, source

UDTS = ["CREATE TYPE ks.inner_t (x int, y text)", "CREATE TYPE ks.outer_t (i frozen<inner_t>, m map<text, int>)"]
CASES = [
    ("int", -2, b"\xff\xff\xff\xfe"), ("tinyint", -1, b"\xff"), ("smallint", 258, b"\x01\x02"), ("bigint", 1, b"\0" * 7 + b"\x01"), ("boolean", True, b"\x01"),
    ("double", 1.0, b"\x3f\xf0" + b"\0" * 6), ("text", "é", b"\xc3\xa9"), ("text", "", b""), ("blob", b"\x00\x01", b"\x00\x01"), ("varint", Decimal(128), b"\x00\x80"),
    ("varint", Decimal(-129), b"\xff\x7f"), ("varint", Decimal(0), b"\0"), ("decimal", Decimal("-1.5"), b"\0\0\0\x01\xf1"), ("date", dt.date(1970, 1, 2), b"\x80\0\0\x01"),
    ("timestamp", dt.datetime(1969, 12, 31, 23, 59, 59, 999000), b"\xff" * 8), ("uuid", "00112233-4455-6677-8899-aabbccddeeff", bytes.fromhex("00112233445566778899aabbccddeeff")),
    ("list<int>", [1], b"\0\0\0\x01\0\0\0\x04\0\0\0\x01"), ("frozen<map<text, frozen<set<int>>>>", {"a": [1, 2], "b": []}, None), ("tuple<int, text>", (None, "x"), b"\xff\xff\xff\xff\0\0\0\x01x"),
    ("outer_t", {"i": {"x": 3, "y": None}, "m": {"k": 1}}, None),
]


@pytest.mark.parametrize("kind,value,data", CASES)
def test_codec(kind, value, data):
    udts = codec.udt_fields(UDTS)
    got = codec.encode(value, kind, udts)
    assert data is None or got == data
    assert codec.decode(got, kind, udts) == value
    assert codec.encode(None, kind, udts) is None and codec.decode(None, kind, udts) is None


def test_short_user_type_and_damage():
    udts = codec.udt_fields(UDTS)
    assert codec.decode(codec.encode({"x": 1, "y": "z"}, "inner_t", udts)[:8], "inner_t", udts) == {"x": 1, "y": None}
    with pytest.raises(ValueError):
        codec.decode(b"\0\0\0\x09ab", "tuple<text>")


def test_native_forms_agree(spark):
    for kind, value in (("int", -7), ("bigint", -(2**63)), ("smallint", 300), ("tinyint", -128), ("text", "ab"), ("boolean", False), ("uuid", CASES[15][1])):
        data = spark.range(1).select(codec.encode_native(F.lit(value), kind).alias("d"))
        assert bytes(data.first()["d"]) == codec.encode(value, kind)
        if (back := codec.decode_native(F.col("d"), kind)) is not None:
            assert data.select(back).first()[0] == value


def test_decoder_column(spark):
    kind = "map<text, frozen<tuple<int, text>>>"
    df = spark.createDataFrame([(bytearray(codec.encode({"k": (1, "v")}, kind)),), (None,)], "b binary")
    got = [r[0] for r in df.select(codec.decoder(kind)(F.col("b"))).collect()]
    assert got[0]["k"][:] == (1, "v") and got[1] is None


def event(**more):
    v = lambda name, kind, value: Row(Name=name, Type=kind, Value=codec.encode(value, kind))
    base = dict(
        Keyspace="k", Table="t", PartitionKeys=[v("a", "int", 1)], ClusteringKeys=[v("b", "text", "x")], StaticColumns=None, ValueColumns=[v("c", "bigint", None)], operation_type="UPDATE",
        last_modified_timestamp=dt.datetime(2024, 1, 1), ttl=[42, 99], cell_deletion_in_complex={"m": [b"p"]}, range_deletion=[Row(Start=[v("b", "text", "a")], StartInclusive=True, End=[], EndInclusive=False)],
    )
    return Row(**(base | more))


def test_message(spark):
    m = messages.message_of(event())
    assert [v.value for v in m.primary_keys] == [1, "x"] and m.column("c").deleted and m.column("d") is None
    assert m.ttl == (42, 99) and m.range_deletions[0].start[0].value == "a" and m.deleted_elements == {"m": [b"p"]}
    for missing in ("operation_type", "last_modified_timestamp"):
        with pytest.raises(ValueError):
            messages.message_of(event(**{missing: None}))


def test_log_reader(tmp_path, monkeypatch):
    monkeypatch.setattr(source, "PART_BYTES", 100)
    monkeypatch.setattr(source, "BLOCK_BYTES", 16)
    (tmp_path / "n0").mkdir()
    log = tmp_path / "n0" / "1.log"
    line = lambda i, ts: json.dumps({"digest": f"d{i}", "ts": ts, "body": "x" * (i % 7)}) + "\n"
    log.write_text("".join(line(i, 1) for i in range(50)) + "not json\n" + line(50, 1) + '{"digest": "half')
    reader = source.MutationLogReader({"path": str(tmp_path)})
    start, end = reader.initialOffset(), reader.latestOffset()
    parts = reader.partitions(start, end)
    rows = [r for p in parts for r in reader.read(p)]
    assert len(parts) > 5 and [r[3] for r in rows] == [f"d{i}" for i in range(51)] and reader.latestOffset() == end
    with log.open("a") as f:
        f.write('", "ts": 9e18}\n' + line(51, 1) + line(52, 2**60))
    later = reader.latestOffset()
    assert source.ordered(end, later) and json.loads(json.dumps(later)) == later
    late = [r[3] for p in reader.partitions(end, later) for r in reader.read(p)]
    assert late == ["half", "d52"]  # d51 is older than the window
    keeping = source.MutationLogReader({"path": f"file://{tmp_path}", "problems": "keep"})
    assert [(r[3], r[-1]) for p in keeping.partitions(end, later) for r in keeping.read(p)] == [("half", None), ("d51", "late"), ("d52", None)]
    assert [r[-1] for p in keeping.partitions(start, end) for r in keeping.read(p)].count("unreadable") == 1
    log.unlink()
    assert [r for p in reader.partitions(end, later) for r in reader.read(p)] == []


def test_problems_are_counted(spark):
    from pyspark.sql import Observation

    rows = spark.createDataFrame([("a", None), (None, "unreadable"), ("b", "late"), ("c", None)], "digest string, problem string")
    seen = Observation("log")
    counted = cdc.observed(rows, seen, late=F.col("problem") == "late", read=F.col("problem").isNull())
    assert counted.count() == 4 and seen.get == {"late": 1, "read": 2}
    assert [r.digest for r in source.counted_problems(rows).collect()] == ["a", "c"]


def test_pull_iterator_hands_its_state_over(spark, tmp_path):
    from quorate.streaming import iterator

    def write(node, *digests):
        (tmp_path / "log" / node).mkdir(parents=True, exist_ok=True)
        with (tmp_path / "log" / node / "1.log").open("a") as f:
            f.write("".join(json.dumps({"digest": d, "ts": 2**60, "body": {"d": d}}) + "\n" for d in digests))

    pull = lambda state, name="a", within=None: iterator.ChangeIterator(spark, str(tmp_path / "log"), 2, f"file://{tmp_path}/{name}", state, within=within)
    write("n0", "d1", "d2")
    write("n1", "d1", "d3")
    first = pull(None)
    assert [(r.digest, r.copies, json.loads(r.body)) for r in next(first).collect()] == [("d1", 2, {"d": "d1"})]
    assert next(first, None) is None
    moved = iterator.State.from_bytes(first.state.to_bytes())
    assert moved == first.state and moved.epoch == 1
    write("n0", "d2", "d4")  # the same replica once more
    write("n2", "d3")
    second = pull(moved)
    assert [r.digest for r in next(second).collect()] == ["d3"] and second.state.epoch == 2
    halves = [pull(None, f"h{i}", F.pmod(F.crc32(F.col("digest").cast("binary")), F.lit(2)) == i) for i in range(2)]
    found = sorted(r.digest for h in halves for r in next(h).collect())
    assert found == ["d1", "d3"]
    whole = iterator.merged(halves[0].state, halves[1].state)
    write("n1", "d2", "d4")
    assert sorted(r.digest for r in next(pull(whole, "w")).collect()) == ["d2", "d4"]
    assert iterator.merged(whole, iterator.State()).offset is None
