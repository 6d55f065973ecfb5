"""Byte-balanced shards by Karmarkar-Karp differencing over indivisible groups of equal texts.

Differencing repeatedly takes the two partial partitions with the largest spread (largest minus smallest part)
and adds them in opposite order, largest part to smallest.

It runs in three steps, so that no task holds more than CELL groups or FAN partial partitions, and a group that holds a
third of all rows is one number, not rows:
1. groups of more than 1/(2 CELL) of the bytes (there are fewer than 2 CELL) are differenced together on the driver;
2. the others fill what these leave open: they are dealt by hash to layers, where layer m goes in m equal parts to the m
   least loaded shards; a layer is a tree of cells of a bounded number of groups, each differenced to one partial
   partition, of which up to FAN are differenced again, until one is left;
3. about CELL groups kept apart by hash are differenced last against the sums of all layers.
Up to CELL groups this is plain differencing of step 3, after step 1.

Law: `bytes`. A group's size is the sum over its rows of the UTF-8 bytes of the text plus 8. Null texts count as
no bytes; all null and empty texts form one group. An empty table gives no rows. Repeated rows are rows, each with a slot
of its own, also where all of a shard's rows are equal; texts of any length are one group; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import durable, join_on_hot_key, numbered, ranked

SHARDS = 24
ROW_BYTES = 8
#: Most groups in a cell (cells hold half as many on average), and most partial partitions that are combined at once.
CELL = 4_000
FAN = 1_000


def difference(partials: list[list[int]]) -> list[list[int]]:
    """For each partial partition the part of the result that each of its parts goes to."""
    if not partials:
        return []
    k = len(partials[0])
    members: list = []  # node -> (left node, right node) or (partial, part)

    def start(i: int, sums: list[int]) -> tuple[int, int, list[tuple[int, int]]]:
        own = []
        for j, s in sorted(enumerate(sums), key=lambda x: (x[1], x[0])):
            members.append((None, i, j))
            own.append((s, len(members) - 1))
        return own[0][0] - own[-1][0], i, own

    heap = [start(i, sums) for i, sums in enumerate(partials)]
    heapq.heapify(heap)
    n = len(partials)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        new = []
        for (x, p), (y, q) in zip(a, reversed(b)):
            members.append((p, q, None))
            new.append((x + y, len(members) - 1))
        new.sort()
        heapq.heappush(heap, (new[0][0] - new[-1][0], n, new))
        n += 1
    out = [[0] * k for _ in partials]
    for part, (_, node) in enumerate(reversed(heap[0][2])):
        stack = [node]
        while stack:
            first, second, third = members[stack.pop()]
            if first is None:
                out[second][third] = part
            else:
                stack += [first, second]
    return out


def layers(loads: list[int], rest: int) -> list[float]:
    """Shares of `rest` bytes that go in equal parts to the 1, 2, ... least of the loads (ascending), so that all end level.

    A load above the level that is reached gets nothing.
    """
    k = len(loads)
    used = next(m for m in range(k, 0, -1) if m == 1 or loads[m - 1] * m <= rest + sum(loads[:m]))
    level = (rest + sum(loads[:used])) / used
    needs = [max(0.0, level - x) for x in loads] + [0.0]
    return [m * (needs[m - 1] - needs[m]) / max(rest, 1) for m in range(1, k + 1)]


def assign_groups(groups: DataFrame, shards: int = SHARDS, cell: int = CELL, fan: int = FAN) -> DataFrame:
    """(group, shard) for a table (group binary, bytes long) with one row a group."""
    spark = groups.sparkSession
    n, total = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    large = F.col("bytes") > total // (2 * cell)  # holds for fewer than 2 * cell groups
    spare = F.pmod(F.xxhash64("group", F.lit(1)), F.lit(max(1, -(-n // cell)))) == 0
    singles = groups.where(large | spare).select("group", "bytes", large.alias("large")).collect()
    singles = sorted(((bytes(r["group"]), r["bytes"], r["large"]) for r in singles), key=lambda r: (-r[1], r[0]))
    first, last = [r for r in singles if r[2]], [r for r in singles if not r[2]]
    alone = lambda rows: [[r[1]] + [0] * (shards - 1) for r in rows]
    parts = [x[0] for x in difference(alone(first))]
    loads = [0] * shards
    for r, part in zip(first, parts):
        loads[part] += r[1]
    order = sorted(range(shards), key=lambda j: (loads[j], j))
    rank = {j: i for i, j in enumerate(order)}
    base = [loads[j] for j in order]
    shares = layers(base, total - sum(base))

    placed = route = None
    if len(singles) < n:
        # The groups that are left are dealt to layers of `width` parts, and to cells inside these.
        spot, scale, upto, width, cells = F.pmod(F.xxhash64("group", F.lit(2)), F.lit(1 << 30)), 1 << 30, 0.0, None, {}
        for m, share in enumerate(shares, 1):
            if share > 0:
                upto += share
                here = spot < round(upto * scale)
                width = F.when(here, m) if width is None else width.when(here, m)
                cells[m] = max(1, math.ceil(share * n / (cell // 2)))
        width = width.otherwise(max(cells)).cast("int")
        n_cells = F.element_at(F.create_map(*[F.lit(x) for pair in cells.items() for x in pair]), F.col("width"))
        dealt = groups.where(~(large | spare)).select("group", "bytes", width.alias("width"))
        dealt = dealt.withColumn("cell", F.pmod(F.xxhash64("group"), n_cells).cast("long"))

        def leaf(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["bytes", "group"], ascending=[False, True], ignore_index=True)
            found = difference([[int(b)] + [0] * (int(pdf["width"].iloc[0]) - 1) for b in pdf["bytes"]])
            return pdf.assign(part=[p[0] for p in found])

        placed = durable(dealt.groupBy("width", "cell").applyInPandas(leaf, "group binary, bytes bigint, width int, cell bigint, part int"), "cells")
        sums = placed.groupBy("width", "cell", "part").agg(F.sum("bytes").alias("bytes"))

        def node(pdf: pd.DataFrame) -> pd.DataFrame:
            k = int(pdf["width"].iloc[0])
            where = {c: i for i, c in enumerate(sorted(pdf["cell"].unique()))}
            table = [[0] * k for _ in where]
            for c, p, b in zip(pdf["cell"], pdf["part"], pdf["bytes"]):
                table[where[c]][p] = int(b)
            to = difference(table)
            rows = [(k, int(c), p, int(pdf["up"].iloc[0]), to[i][p], table[i][p]) for c, i in where.items() for p in range(k)]
            return pd.DataFrame(rows, columns=["width", "cell", "part", "at", "to", "bytes"])

        # `route`: where part `part` of cell `cell` has come to, as part `to` of the cell `at` of the level reached.
        most = max(cells.values())
        while True:
            up = sums.withColumn("up", F.floor(F.col("cell") / fan).cast("long"))
            step = durable(up.groupBy("width", "up").applyInPandas(node, "width int, cell bigint, part int, at bigint, to int, bytes bigint"), "levels")
            sums = step.groupBy("width", F.col("at").alias("cell"), F.col("to").alias("part")).agg(F.sum("bytes").alias("bytes"))
            hop = step.select("width", "cell", "part", "at", "to")
            if route is None:
                route = hop
            else:
                nxt = hop.select("width", F.col("cell").alias("at"), F.col("part").alias("to"), F.col("at").alias("at2"), F.col("to").alias("to2"))
                route = route.join(nxt, ["width", "at", "to"]).select("width", "cell", "part", F.col("at2").alias("at"), F.col("to2").alias("to"))
            most = -(-most // fan)
            if most <= 1:
                break
        for r in sums.collect():
            base[r["part"]] += r["bytes"]

    # What is level by now is brought together with the spare groups, largest first.
    last_parts = difference([base] + alone(last))
    final, parts = last_parts[0], [last_parts[0][rank[p]] for p in parts] + [x[0] for x in last_parts[1:]]
    one = [(r[0], p) for r, p in zip(first + last, parts)]
    out = durable(spark.createDataFrame(one, "group binary, shard int"), "singles")
    if placed is None:
        return out
    at = F.element_at(F.array(*map(F.lit, final)), F.col("to") + 1).alias("shard")
    return placed.join(route, ["width", "cell", "part"]).select("group", at).unionByName(out)


def shard_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", shards: int = SHARDS) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of each row."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        key,
        (F.octet_length(data) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.unhex(F.sha2(data, 256)).alias("group"),
    )
    rows = durable(numbered(rows), "texts")
    total = rows.count()
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("_copies"))
    groups = durable(groups, "groups")
    placed = assign_groups(groups.select("group", "bytes"), shards).join(groups.select("group", "_copies"), "group")
    placed = durable(placed, "placed")
    out = join_on_hot_key(rows, placed, "group", "_copies", total)
    out = ranked(out.select(key, "size", "text_crc32", "shard", "_row"), ["shard"], [key, "text_crc32", "size", "_row"], "slot", total)
    return out.select(
        key, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
