"""A micro-batch source of mutation logs.

An offset is a dict of `timestampMicros` and `instanceLogs`: instance -> segment -> bytes read. Only bytes that came
since the last offset are read; a log is opened for its end (found from its last block) only when its size has changed, so a
batch costs one listing and what is new. The path is a folder or a URI of any store that pyarrow.fs opens (file, s3, gs, hdfs).
"""

from __future__ import annotations

import io
import json
import tempfile
import time
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from quorate.operators.cdc import observed

LOG_SCHEMA = "instance string, segment bigint, position bigint, digest string, replica string, ts bigint, body string, problem string"
#: Bytes that one task reads of a log; more are several tasks.
PART_BYTES = 64 << 20
BLOCK_BYTES = 64 << 10


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def end_of_lines(store: fs.FileSystem, log: str) -> int:
    """Bytes up to the last line end: what a writer has finished."""
    with store.open_input_file(log) as f:
        at = f.size()
        while at:
            start = max(0, at - BLOCK_BYTES)
            found = f.read_at(at - start, start).rfind(b"\n")
            if found >= 0:
                return start + found + 1
            at = start
    return 0


def ordered(a: dict, b: dict) -> bool:
    """Whether offset `a` isn't later than `b`."""
    return a["timestampMicros"] <= b["timestampMicros"]


class LogPart(InputPartition):
    """Lines that begin in [first, last) of a log; those written before `oldest` (microseconds) are too late."""

    def __init__(self, path: str, instance: str, segment: int, first: int, last: int, whole_line: bool, oldest: int):
        self.path, self.instance, self.segment, self.first, self.last, self.whole_line, self.oldest = path, instance, segment, first, last, whole_line, oldest


class MutationLogReader(DataSourceStreamReader):
    """Logs are JSON lines in <path>/<instance>/<segment>.log; a line's first byte is its position.

    A log that is gone counts as empty. Options: `windowSeconds` (600: an update older than a batch's start by more is
    late), `minMutationAgeSeconds` (0: a batch's time is so much before now), `startingOffsets` (earliest, or window: at
    the first batch only what is in the window before now counts), `problems`: drop (the default) leaves out late updates
    and lines that can't be read, keep gives them with `late` or `unreadable` in the column problem (a line that can't be
    read in body), to be counted by counted_problems().
    """

    def __init__(self, options: dict):
        o = {k.lower(): v for k, v in options.items()}
        self.path = o["path"]
        self.window = int(float(o.get("windowseconds", 600)) * 1e6)
        self.age = int(float(o.get("minmutationageseconds", 0)) * 1e6)
        self.start = o.get("startingoffsets", "earliest")
        if self.start not in ("earliest", "window"):
            raise ValueError(f"startingOffsets is earliest or window, not {self.start}")
        self.keep = o.get("problems", "drop")
        if self.keep not in ("drop", "keep"):
            raise ValueError(f"problems is drop or keep, not {self.keep}")
        self.last: dict | None = None
        self.ends: dict[str, tuple[int, int]] = {}  # log -> size, end of its last line

    def _now(self) -> int:
        return time.time_ns() // 1000 - self.age

    def initialOffset(self) -> dict:
        return {"timestampMicros": 0 if self.start == "earliest" else self._now(), "instanceLogs": {}}

    def latestOffset(self) -> dict:
        ends: dict[str, dict[str, int]] = {}
        store, root = opened(self.path)
        known = {}
        for log in sorted(store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)), key=lambda i: i.path):
            if log.type != fs.FileType.File or log.extension != "log":
                continue
            try:
                old = self.ends.get(log.path)
                known[log.path] = old if old and old[0] == log.size else (log.size, end_of_lines(store, log.path))
            except FileNotFoundError:
                continue
            ends.setdefault(log.path.split("/")[-2], {})[log.base_name.removesuffix(".log")] = known[log.path][1]
        self.ends = known
        if self.last is None or self.last["instanceLogs"] != ends:  # else the same offset: no empty batches
            self.last = {"timestampMicros": self._now(), "instanceLogs": ends}
        return self.last

    def partitions(self, start: dict, end: dict) -> list[LogPart]:
        out = []
        oldest = start["timestampMicros"] - self.window
        for instance, logs in end["instanceLogs"].items():
            for segment, last in logs.items():
                first = start["instanceLogs"].get(instance, {}).get(segment, 0)
                for at in range(first, last, PART_BYTES):
                    out.append(LogPart(f"{self.path}/{instance}/{segment}.log", instance, int(segment), at, min(at + PART_BYTES, last), at == first, oldest))
        return out

    def read(self, partition: LogPart) -> Iterator[tuple]:
        store, path = opened(partition.path)
        try:
            lines = io.BufferedReader(store.open_input_file(path), BLOCK_BYTES)
        except FileNotFoundError:
            return
        with lines:
            at = partition.first
            if not partition.whole_line:  # the line that reaches into this part is the part's before it
                lines.seek(at - 1)
                at += len(lines.readline()) - 1
            lines.seek(at)
            while at < partition.last and (line := lines.readline()):
                try:
                    m = json.loads(line)
                    row = partition.instance, partition.segment, at, m["digest"], m.get("replica", partition.instance), int(m["ts"]), json.dumps(m.get("body")), None
                    if row[5] < partition.oldest:
                        row = *row[:-1], "late"
                except (ValueError, KeyError, TypeError, AttributeError):
                    row = partition.instance, partition.segment, at, None, None, None, line.decode("utf-8", "replace"), "unreadable"
                if row[-1] is None or self.keep == "keep":
                    yield row
                at += len(line)

    def commit(self, end: dict) -> None:
        pass


class MutationLogSource(DataSource):
    """spark.readStream.format("mutation_log").load(path)"""

    @classmethod
    def name(cls) -> str:
        return "mutation_log"

    def schema(self) -> str:
        return LOG_SCHEMA

    def streamReader(self, schema) -> MutationLogReader:
        return MutationLogReader(dict(self.options))


def counted_problems(rows: DataFrame, name: str = "mutation_log") -> DataFrame:
    """The rows of a source with problems=keep without those that have one; `late`, `unreadable` and `read` are metrics called `name`."""
    problem = F.col("problem")
    return observed(rows, name, late=problem == "late", unreadable=problem == "unreadable", read=problem.isNull()).where("problem is null")


def write_logs(rows: DataFrame, path: str) -> int:
    """Write rows (instance, segment, position, line) as logs that the source reads, each segment by one task; returns how many.

    A segment is as large as a writer lets a log file grow. It is written beside its place and then moved, so that a task
    that runs again leaves the same file.
    """

    def write(segment: pd.DataFrame) -> pd.DataFrame:
        store, root = opened(path)
        folder = f"{root}/{segment['instance'].iloc[0]}"
        store.create_dir(folder, recursive=True)
        log = f"{folder}/{segment['segment'].iloc[0]}.log"
        with store.open_output_stream(own := f"{log}.{uuid.uuid4().hex}") as out:
            out.write("".join(f"{x}\n" for x in segment.sort_values("position")["line"]).encode())
        store.move(own, log)
        return pd.DataFrame({"n": [len(segment)]})

    return rows.select("instance", "segment", "position", "line").groupBy("instance", "segment").applyInPandas(write, "n long").count()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder that driver and executors share: in spark.checkpoint.dir; unset, a temporary one for local sessions only."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}/quorate-checkpoints"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
