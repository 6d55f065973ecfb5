"""Change events pulled batch by batch, without a stream: epochs whose state can be saved, moved and merged.

An epoch reads what came to the logs since the last one, publishes the updates that enough replicas hold by now, and leaves
the others as state. The state is small (epoch, markers, the folder of the pending copies); pending copies lie as
Parquet in the folder that driver and executors share, so nothing of a table is collected.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quorate.operators import cdc
from quorate.streaming.source import LOG_SCHEMA, LogPart, MutationLogReader

_PENDING = "digest string, replica string"


@dataclass(frozen=True)
class State:
    """Where an epoch ended: its markers (an offset of the log source) and the folders of pending copies."""

    epoch: int = 0
    offset: dict | None = None
    pending: list[str] = field(default_factory=list)

    def to_bytes(self) -> bytes:
        return zlib.compress(json.dumps(asdict(self)).encode())

    @staticmethod
    def from_bytes(data: bytes) -> State:
        return State(**json.loads(zlib.decompress(data)))


def merged(a: State, b: State) -> State:
    """The state of two token ranges as one: the later epoch, the earlier marker of each log, all pending copies."""
    if a.offset is None or b.offset is None:
        offset = None  # one range hasn't begun: its logs are read from the start
    else:
        logs = {}
        for instance in a.offset["instanceLogs"].keys() & b.offset["instanceLogs"].keys():
            one, two = a.offset["instanceLogs"][instance], b.offset["instanceLogs"][instance]
            logs[instance] = {segment: min(one[segment], two[segment]) for segment in one.keys() & two.keys()}
        offset = {"timestampMicros": min(a.offset["timestampMicros"], b.offset["timestampMicros"]), "instanceLogs": logs}
    return State(max(a.epoch, b.epoch), offset, sorted({*a.pending, *b.pending}))


class ChangeIterator:
    """for events in ChangeIterator(...): a DataFrame (digest, ts, body, copies) of each epoch that has new log entries.

    `folder`: shared folder for epochs; `options`: those of the log source; `within`: a condition over the log's columns for
    the token range that this iterator is for. `state` after an epoch is what the next one, here or elsewhere, goes on from.
    """

    def __init__(self, spark: SparkSession, path: str, needed: int, folder: str, state: State | None = None, options: dict | None = None, within: Column | None = None):
        self.spark, self.needed, self.folder, self.within = spark, needed, folder.rstrip("/"), within
        self.options = {**(options or {}), "path": path}
        self.state = state or State()

    def _read(self, parts: list[LogPart]) -> DataFrame:
        options = self.options
        rows = [(p.path, p.instance, p.segment, p.first, p.last, p.whole_line, p.oldest) for p in parts]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            reader = MutationLogReader(options)
            names = [c.split(" ")[0] for c in LOG_SCHEMA.split(", ")]
            for batch in batches:
                for part in batch.itertuples(index=False):
                    found = []
                    for row in reader.read(LogPart(*part)):
                        found.append(row)
                        if len(found) == 10_000:
                            yield pd.DataFrame(found, columns=names)
                            found = []
                    yield pd.DataFrame(found, columns=names).astype(object)

        table = self.spark.createDataFrame(rows, "path string, instance string, segment bigint, first bigint, last bigint, whole_line boolean, oldest bigint")
        return table.repartition(max(1, len(rows)), "path", "first").mapInPandas(run, LOG_SCHEMA)

    def __iter__(self) -> Iterator[DataFrame]:
        return self

    def __next__(self) -> DataFrame:
        reader = MutationLogReader(self.options)
        start, end = self.state.offset or reader.initialOffset(), reader.latestOffset()
        parts = reader.partitions(start, end)
        if not parts:
            raise StopIteration
        here = f"{self.folder}/epoch{self.state.epoch + 1}"
        copies = self._read(parts)
        copies = copies if self.within is None else copies.where(self.within)
        copies.write.mode("overwrite").parquet(f"{here}/copies")
        copies = self.spark.read.schema(LOG_SCHEMA).parquet(f"{here}/copies").where("problem is null")
        seen = self.spark.read.schema(_PENDING).parquet(*self.state.pending) if self.state.pending else None
        result = cdc.quorum(copies, "digest", self.needed, "replica", seen=seen)
        cdc.pending(copies, result, "digest", "replica", seen=seen).select("digest", "replica").write.mode("overwrite").parquet(f"{here}/pending")
        content = copies.groupBy("digest").agg(F.min("ts").alias("ts"), F.min("body").alias("body"))
        events = content.join(result.where("published").drop("published"), "digest")
        events.write.mode("overwrite").parquet(f"{here}/events")
        self.state = State(self.state.epoch + 1, end, [f"{here}/pending"])
        return self.spark.read.schema(events.schema).parquet(f"{here}/events")
