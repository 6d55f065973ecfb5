"""Replica quorum over a stream of mutation copies, with checkpointed state and expiry."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class QuorumProcessor(StatefulProcessor):
    """Publishes an update once, when enough copies have come; forgets it after the window.

    State of an update: the replicas seen and whether it was published. A copy that comes later than that is
    swallowed until the state ends, so an update isn't published twice.
    """

    def __init__(self, needed: int, window_ms: int = 600_000):
        self.needed, self.window_ms = needed, window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "replicas string, published boolean", self.window_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        replicas, published = set(), False
        if self.seen.exists():
            old = self.seen.get()
            replicas, published = set(old[0].split(",")) - {""}, old[1]
        for batch in rows:
            replicas |= set(batch["replica"].astype(str))
        publish = not published and len(replicas) >= self.needed
        self.seen.update((",".join(sorted(replicas)), published or publish))
        if publish:
            yield pd.DataFrame({"digest": [key[0]], "copies": [len(replicas)]})

    def close(self) -> None:
        pass


def published(copies: DataFrame, needed: int, window_ms: int = 600_000) -> DataFrame:
    """A stream of (digest, replica) copies as a stream of (digest, copies) of published updates."""
    return copies.groupBy("digest").transformWithStateInPandas(
        statefulProcessor=QuorumProcessor(needed, window_ms), outputStructType="digest string, copies long", outputMode="Append", timeMode="ProcessingTime"
    )


def use_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def write_events(events: DataFrame, sink, checkpoint: str, available_now: bool = True):
    """Hand each micro-batch of events to `sink(DataFrame, batch id)`."""
    writer = events.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
