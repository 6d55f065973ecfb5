"""Media columns: payloads as PNG members of tar shards, addressed by their content.

Each task writes the payloads of its rows once per content into tar shards in the shared folder; a row keeps
digest, shard, offset and length. A shard is written under a temporary name and then renamed to the hash of what
it holds, so a task that runs again leaves the same file. The index is a table; later columns come from range
reads: `read_headers` reads the first 33 bytes of a member, `read_payloads` the member.

The shared folder must be one that pyarrow.fs can open (file, s3, gs, hdfs with libhdfs). Payload: the text's
UTF-8 bytes, zero-padded to a positive multiple of 64, as rows of a 64-pixel-wide 8-bit grey image. Null texts
count as empty (a payload of 64 zeros). An empty table gives no rows; equal texts and repeated rows give equal values; a
text of any length is one member; other columns than key and text are ignored.

A shard is closed at SHARD_BYTES or SHARD_ROWS, so a task holds the rows of one shard only, even if their texts are equal.
Content is addressed inside a shard: a payload is stored once in each shard whose rows have it.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quorate.llm.common import durable, fresh_path

WIDTH = 64
HEADER_BYTES = 33  # signature and IHDR chunk
SIGNATURE = b"\x89PNG\r\n\x1a\n"
SHARD_BYTES, SHARD_ROWS = 64 << 20, 100_000
#: zlib level: fast, and the same bytes for the same payload.
LEVEL = 1


def payload_of(text: str | None) -> tuple[bytes, int]:
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + bytes((-len(data)) % WIDTH or (0 if data else WIDTH)), len(data)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(payload: bytes) -> bytes:
    """An 8-bit grey image of 64 columns, filter 0 in each row."""
    height = len(payload) // WIDTH
    rows = np.zeros((height, WIDTH + 1), np.uint8)
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(height, WIDTH)
    header = struct.pack(">IIBBBBB", WIDTH, height, 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def decode_header(head: bytes) -> tuple[int, int, int]:
    """(width, height, bit depth) from the first 33 bytes."""
    if head[:8] != SIGNATURE or head[12:16] != b"IHDR" or zlib.crc32(head[12:29]) != struct.unpack(">I", head[29:33])[0]:
        raise ValueError("not a PNG header")
    width, height, depth = struct.unpack(">IIB", head[16:25])
    return width, height, depth


def decode_png(data: bytes) -> bytes:
    width, height, _ = decode_header(data[:HEADER_BYTES])
    at, parts = HEADER_BYTES, []
    while at < len(data):
        n, kind = struct.unpack(">I", data[at : at + 4])[0], data[at + 4 : at + 8]
        body = data[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("a chunk is damaged")
        if kind == b"IDAT":
            parts.append(body)
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("only filter 0 is written")
    return rows[:, 1:].tobytes()


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class _Shard:
    def __init__(self, filesystem, folder: str):
        self.fs, self.folder = filesystem, folder
        self.temporary = f"{folder}/.{uuid.uuid4().hex}"
        self.out = filesystem.open_output_stream(self.temporary, compression=None)
        self.at, self.members, self.names, self.rows, self.keys = 0, {}, hashlib.sha256(), [], []

    def add(self, payload: bytes, n_bytes: int) -> None:
        digest = hashlib.sha256(payload).hexdigest()
        if digest not in self.members:
            data = encode_png(payload)
            info = tarfile.TarInfo(f"{digest}.png")
            info.size = len(data)
            head = info.tobuf(tarfile.GNU_FORMAT)
            self.members[digest] = (self.at + len(head), len(data))
            for part in (head, data, bytes(-len(data) % tarfile.BLOCKSIZE)):
                self.out.write(part)
                self.at += len(part)
            self.names.update(digest.encode())
        self.rows.append((n_bytes, digest, *self.members[digest]))

    def close(self, schema: pa.Schema) -> pa.RecordBatch:
        """Rows of the index; `keys` holds the keys of these rows as Arrow arrays."""
        self.out.write(bytes(2 * tarfile.BLOCKSIZE))
        self.out.close()
        name = f"{self.names.hexdigest()}.tar"
        self.fs.move(self.temporary, f"{self.folder}/{name}")
        columns = [*map(list, zip(*self.rows)), [name] * len(self.rows)]
        return pa.RecordBatch.from_arrays([pa.concat_arrays(self.keys), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:]))], schema.names)


INDEX = "n_bytes bigint, digest string, offset bigint, length bigint, shard string"


def write_shards(docs: DataFrame, folder: str, text: str = "text", key: str = "doc_id", most: int = SHARD_BYTES, most_rows: int = SHARD_ROWS) -> DataFrame:
    """The index (key, INDEX); running it writes the shards into `folder`."""
    schema = T.StructType([docs.schema[key], *T.StructType.fromDDL(INDEX)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = _filesystem(folder)
        shard = None
        for batch in batches:
            first = 0  # of the batch's rows that the open shard has
            for i, t in enumerate(batch.column(1)):
                if shard is None:
                    filesystem.create_dir(path, recursive=True)
                    shard = _Shard(filesystem, path)
                shard.add(*payload_of(t.as_py()))
                if shard.at >= most or len(shard.rows) >= most_rows:
                    shard.keys.append(batch.column(0).slice(first, i + 1 - first))
                    yield shard.close(arrow)
                    shard, first = None, i + 1
            if shard is not None and first < batch.num_rows:
                shard.keys.append(batch.column(0).slice(first))
        if shard is not None:
            yield shard.close(arrow)

    return docs.select(key, F.col(text).alias("_source")).mapInArrow(run, schema)


class _Reader:
    """Range reads; the last shard stays open, the last member stays known."""

    def __init__(self, folder: str):
        self.fs, self.path = _filesystem(folder)
        self.name, self.file, self.last = None, None, (None, b"")

    def read(self, shard: str, offset: int, length: int) -> bytes:
        if self.last[0] != (shard, offset, length):
            if shard != self.name:
                self.name, self.file = shard, self.fs.open_input_file(f"{self.path}/{shard}")
            self.last = ((shard, offset, length), self.file.read_at(length, offset))
        return self.last[1]


def read_headers(index: DataFrame, folder: str) -> DataFrame:
    """The index with width, height and bit_depth, from 33 bytes of each member."""
    schema = T.StructType([*index.schema, *T.StructType.fromDDL("width bigint, height bigint, bit_depth int")])
    kinds = list(to_arrow_schema(schema).types)[-3:]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(folder)
        for batch in batches:
            places = zip(batch.column("shard").to_pylist(), batch.column("offset").to_pylist())
            heads = [decode_header(reader.read(s, o, HEADER_BYTES)) for s, o in places]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([h[i] for h in heads], kind) for i, kind in enumerate(kinds))], names)

    return index.mapInArrow(run, schema)


FEATURES = "payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"


def read_features(index: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """What is computed from each stored member: its hash, the payload read back and the payload's features."""
    schema = T.StructType([index.schema[key], index.schema["n_bytes"], *T.StructType.fromDDL(FEATURES)])
    kinds = list(to_arrow_schema(schema).types)[2:]
    names = schema.names

    def one(data: bytes, width: int, height: int, depth: int) -> tuple:
        payload = decode_png(data)
        counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
        mean = int(counts @ np.arange(256)) / len(payload)
        feature = f"{width}x{height}x{depth} mean={mean:.4f} levels={int((counts > 0).sum())} zeros={int(counts[0])}"
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(data), hashlib.sha256(data).hexdigest(), feature

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(folder)
        for batch in batches:
            known: dict[tuple, tuple] = {}
            out: list[list] = [[] for _ in kinds]
            for place in zip(*(batch.column(c).to_pylist() for c in ("shard", "offset", "length", "width", "height", "bit_depth"))):
                if place not in known:
                    known[place] = one(reader.read(*place[:3]), *place[3:])
                for column, value in zip(out, known[place]):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, kind) for c, kind in zip(out, kinds))], names)

    return index.select(key, "n_bytes", "shard", "offset", "length", "width", "height", "bit_depth").mapInArrow(run, schema)


def media_columns(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Write all payloads, then fill the columns from range reads."""
    folder = fresh_path(docs.sparkSession, "media")
    index = durable(write_shards(docs, folder, text, key), "media-index")
    return read_features(read_headers(index, folder), folder, key)


def members(data: bytes) -> dict[str, bytes]:
    """The members of a shard, as any tar reader sees them."""
    with tarfile.open(fileobj=io.BytesIO(data)) as tar:
        return {m.name: tar.extractfile(m).read() for m in tar}
