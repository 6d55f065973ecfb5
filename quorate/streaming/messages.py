"""Change events decoded for a consumer, and the writers that hand them over."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Row

from quorate.functions.codec import Udts, decode

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Value:
    name: str
    type_text: str
    value: Any

    @property
    def deleted(self) -> bool:
        return self.value is None


@dataclass(frozen=True)
class RangeDeletion:
    """Bounds as values of the first clustering columns; an empty one is open."""

    start: list[Value]
    start_inclusive: bool
    end: list[Value]
    end_inclusive: bool


@dataclass(frozen=True)
class Message:
    """One change event with typed values. A column that wasn't touched is absent; a deleted one has the value None."""

    keyspace: str
    table: str
    partition_keys: list[Value]
    clustering_keys: list[Value]
    static_columns: list[Value]
    value_columns: list[Value]
    operation: str
    modified: dt.datetime
    ttl: tuple[int, int] | None = None
    deleted_elements: dict[str, list[bytes]] = field(default_factory=dict)
    range_deletions: list[RangeDeletion] = field(default_factory=list)

    @property
    def primary_keys(self) -> list[Value]:
        return self.partition_keys + self.clustering_keys

    @property
    def all_columns(self) -> list[Value]:
        return self.primary_keys + self.static_columns + self.value_columns

    def column(self, name: str) -> Value | None:
        return next((v for v in self.all_columns if v.name == name), None)


def message_of(row: Row, udts: Udts | None = None) -> Message:
    """A row of the change event schema as a message. An event without a kind or a time is an error."""
    if row["operation_type"] is None or row["last_modified_timestamp"] is None:
        raise ValueError("a change event needs a kind and a time")
    values = lambda name: [Value(v["Name"], v["Type"], decode(v["Value"], v["Type"], udts)) for v in row[name] or []]
    bound = lambda vs: [Value(v["Name"], v["Type"], decode(v["Value"], v["Type"], udts)) for v in vs or []]
    return Message(
        row["Keyspace"], row["Table"], values("PartitionKeys"), values("ClusteringKeys"), values("StaticColumns"), values("ValueColumns"),
        row["operation_type"], row["last_modified_timestamp"], tuple(row["ttl"]) if row["ttl"] else None,
        {k: [bytes(x) for x in v] for k, v in (row["cell_deletion_in_complex"] or {}).items()},
        [RangeDeletion(bound(r["Start"]), r["StartInclusive"], bound(r["End"]), r["EndInclusive"]) for r in row["range_deletion"] or []],
    )


class EventWriter:
    """For writeStream.foreach: each event as a message to `process`, on the executors."""

    def __init__(self, process: Callable[[Message], None], udts: Udts | None = None):
        self.deliver, self.udts = process, udts

    def open(self, partition_id: int, epoch_id: int) -> bool:
        return True

    def process(self, row: Row) -> None:
        self.deliver(message_of(row, self.udts))

    def close(self, error: Exception | None) -> None:
        if error is not None:
            raise error


def consume(events: DataFrame, process: Callable[[Message], None], udts: Udts | None = None) -> None:
    """Deliver a batch's events from its partitions; a failing event is logged and the others go on."""

    def deliver(rows: Iterator[Row]) -> None:
        for row in rows:
            try:
                process(message_of(row, udts))
            except Exception:
                log.exception("a change event was not delivered")

    events.foreachPartition(deliver)
