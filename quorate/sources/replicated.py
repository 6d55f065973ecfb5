"""Reads at a consistency level: which replicas answer for which part of the ring, and the versions that they hold.

The plan is a driver-side list of a few hundred ranges. It becomes a search tree of conditions over the token, so the
choice costs no join and no shuffle, and reaches every row where it is scanned.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorate.functions.tokens import bucket_of
from quorate.operators.ring import Instance, Range, Replication, block_for, choose_replicas, replica_candidates, replica_map, uncovered, validate_level


@dataclass(frozen=True)
class Part:
    """A token range, the replicas that answer for it, and those that stand in for a failing one."""

    range: Range
    primary: tuple[Instance, ...]
    backup: tuple[Instance, ...]


def read_plan(instances: list[Instance], replication: Replication, level: str = "LOCAL_QUORUM", dc: str | None = None, hints: Mapping[str, str] | None = None, partitioner: str = "murmur3") -> list[Part]:
    """Parts over the whole ring, in its order. NotEnoughReplicas where a part has too few."""
    validate_level(level, replication, dc)
    needed = block_for(level, replication, dc)
    parts = []
    for r, replicas in replica_map(instances, replication, partitioner):
        own = [(i, (hints or {}).get(i.node, "UP")) for i in replica_candidates(replicas, level, dc)]
        first, rest = choose_replicas(own, needed)
        parts.append(Part(r, tuple(first), tuple(rest)))
    if gaps := uncovered([p.range for p in parts], partitioner):
        raise ValueError(f"no replica holds {gaps}")
    return parts


def without_failed(parts: list[Part], failed: set[str]) -> list[Part]:
    """The plan after nodes have failed: the next backup takes the place of each. NotEnoughReplicas if none is left."""
    out = []
    for p in parts:
        alive = [(i, "UP") for i in (*p.primary, *p.backup) if i.node not in failed]
        kept = [i for i in p.primary if i.node not in failed]
        chosen, _ = choose_replicas(alive, len(p.primary))
        chosen = kept + [i for i in chosen if i not in kept][: len(p.primary) - len(kept)]
        out.append(Part(p.range, tuple(chosen), tuple(i for i, _ in alive if i not in chosen)))
    return out


def answering(parts: list[Part], token: Column, node: Column, repaired: Column | None = None) -> Column:
    """Whether a node's copy of a token's versions is read; a repaired file's only on the first replica of its range."""
    number = bucket_of(token, [p.range.end for p in parts[:-1]])
    nodes = F.array(*(F.array(*(F.lit(i.node) for i in p.primary)) for p in parts))
    mine = F.get(nodes, number)
    reads = F.array_contains(mine, node)
    return reads if repaired is None else reads & (~repaired | (F.get(mine, F.lit(0)) == node))


def read_replicas(versions: DataFrame, parts: list[Part], token: str = "token", node: str = "node", repaired: str | None = None) -> DataFrame:
    """The versions that the plan's replicas hold; merge them next, as copies are still there."""
    return versions.where(answering(parts, F.col(token), F.col(node), F.col(repaired) if repaired else None))
