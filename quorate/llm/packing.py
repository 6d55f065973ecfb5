"""Packing token pieces into sequences of a fixed length: best fit, then swap-based local search.

A piece's length is between 1 and the capacity (1024), so how many pieces there are of each length is a table
of at most 1024 rows however large the corpus is. The plan is made on that table: a *group* is a pattern of
lengths with the number of sequences that have it. Best fit (longest pieces first, each into the fullest
sequence that has room) and the local search (move a piece, exchange one for one, two for one or one for two between
underfull sequences, always raising the sum of squared fills, until no exchange does) work on whole groups. Then each
piece takes the place that its rank among the pieces of its length has in the plan; ranks are numbered in buckets, so
that no task holds all pieces of a length.

Defined results: a null text counts as empty and gives one piece with only the end id; repeated rows are
packed each, also where all rows are equal; texts of any length are cut whole; an empty table gives no rows; other
columns than key and text are ignored. The ids are those of the library with the strings of special tokens taken as
ordinary text.
"""

from __future__ import annotations

import logging
import os
import re
import struct
import zlib
from operator import attrgetter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.llm.bpe import CHUNK, LONG_CHUNK, Memo
from quorate.llm.common import arrow_rows, durable, numbered, ranked

log = logging.getLogger(__name__)

CAPACITY = 1024
END_ID = 2
#: Runs of places are cut at multiples of so many ranks, so a piece meets only the runs of its length and slot.
SLOT_RANKS = 1 << 16
#: Up to so many cut runs are broadcast; more are joined.
BROADCAST_RUNS = 100_000

Pattern = tuple[tuple[int, int], ...]  # (length, how many), longest first


# --- the plan -------------------------------------------------------------------------------------------------


class Plan:
    """Groups of equally filled sequences: pattern -> number of sequences."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.groups: dict[Pattern, int] = {}

    def add(self, pattern: Pattern, times: int) -> None:
        if times and pattern:
            self.groups[pattern] = self.groups.get(pattern, 0) + times

    def take(self, pattern: Pattern, times: int) -> None:
        self.groups[pattern] -= times
        if not self.groups[pattern]:
            del self.groups[pattern]

    def sequences(self) -> int:
        return sum(self.groups.values())

    def squared_fill(self) -> int:
        return sum(times * fill(p) ** 2 for p, times in self.groups.items())


def fill(pattern: Pattern) -> int:
    return sum(length * n for length, n in pattern)


def changed(pattern: Pattern, out: tuple[int, ...], into: tuple[int, ...]) -> Pattern:
    counts = dict(pattern)
    for x in out:
        counts[x] -= 1
    for x in into:
        counts[x] = counts.get(x, 0) + 1
    return tuple((x, n) for x, n in sorted(counts.items(), reverse=True) if n)


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best fit decreasing, all pieces of a length at a time."""
    by_room: list[list[list]] = [[] for _ in range(capacity + 1)]  # room -> [pattern, sequences]
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        room = length
        while left:
            while room <= capacity and not by_room[room]:
                room += 1
            if room > capacity:
                each = capacity // length
                pattern, times = (), -(-left // each)
            else:
                each = room // length
                pattern, times = by_room[room].pop()
            whole = min(times, left // each)
            if whole:
                by_room[(room if pattern else capacity) - each * length].append([pattern + ((length, each),), whole])
            left -= whole * each
            times -= whole
            if times and left:
                by_room[(room if pattern else capacity) - left * length].append([pattern + ((length, left),), 1])
                times, left = times - 1, 0
            if times and pattern:
                by_room[room].append([pattern, times])
            room = length
    plan = Plan(capacity)
    for groups in by_room:
        for pattern, times in groups:
            plan.add(pattern, times)
    return plan


def pairs_of(pattern: Pattern) -> list[tuple[int, int]]:
    """The pairs of pieces of a sequence, once each."""
    return [(x, y) for i, (x, n) in enumerate(pattern) for y, _ in pattern[i:] if x != y or n > 1]


def improvement(giver: Pattern, taker: Pattern, capacity: int) -> tuple[int, tuple, tuple] | None:
    """The exchange that raises the squared fills of `giver` and `taker` most: (tokens that go over, given, given back)."""
    room, ahead = capacity - fill(taker), fill(taker) - fill(giver)
    own, other = [x for x, _ in giver], [x for x, _ in taker]
    best: tuple[int, tuple, tuple] | None = None

    def offer(tokens: int, given: tuple, back: tuple) -> None:
        nonlocal best
        if max(0, -ahead) < tokens <= room and (best is None or tokens > best[0]):
            best = (tokens, given, back)

    for x in own:
        offer(x, (x,), ())
        for y in other:
            offer(x - y, (x,), (y,))
    for x, y in pairs_of(giver):
        for z in other:
            offer(x + y - z, (x, y), (z,))
    for x, y in pairs_of(taker):
        for z in own:
            offer(z - x - y, (z,), (x, y))
    return best


def local_search(plan: Plan) -> Plan:
    """Exchange pieces between underfull sequences until no exchange raises the sum of squared fills.

    A pass tries each underfull group, emptiest first, against the others, fullest first. The sum grows with every step
    and is bounded, so the search ends; it also ends at the lower bound of the number of sequences.
    """
    capacity = plan.capacity
    tokens = sum(times * fill(p) for p, times in plan.groups.items())
    raised = True
    while raised and plan.sequences() > -(-tokens // capacity):
        raised = False
        for source in sorted((p for p in plan.groups if fill(p) < capacity), key=lambda p: (fill(p), p)):
            giver = source
            while giver and giver in plan.groups:
                best = None
                for taker in sorted((p for p in plan.groups if fill(p) < capacity), key=lambda p: (-fill(p), p)):
                    if taker == giver and plan.groups[giver] < 2:
                        continue
                    found = improvement(giver, taker, capacity)
                    if found is None:
                        continue
                    gain = 2 * found[0] * (fill(taker) - fill(giver) + found[0])
                    if best is None or gain > best[0]:
                        best = (gain, found, taker)
                    if fill(taker) + found[0] == capacity or found[0] == fill(giver):
                        break
                if best is None:
                    break
                _, (_, given, back), taker = best
                times = plan.groups[giver] // 2 if taker == giver else min(plan.groups[giver], plan.groups[taker])
                plan.take(giver, times)
                plan.take(taker, times)
                plan.add(changed(taker, back, given), times)
                rest = changed(giver, given, back)
                plan.add(rest, times)
                giver = rest
                raised = True
    return plan


def places(plan: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, pieces a sequence, first sequence, first offset) of each run.

    There are as many runs as lengths in all patterns: best fit adds a few groups for each of the at most `capacity` lengths.
    """
    used: dict[int, int] = {}
    out, sequence = [], 0
    for pattern in sorted(plan.groups, key=lambda p: (-fill(p), p)):
        times, offset = plan.groups[pattern], 0
        for length, n in pattern:
            first = used.get(length, 0)
            used[length] = first + times * n
            out.append((length, first, first + times * n, n, sequence, offset))
            offset += length * n
        sequence += times
    return out


# --- the pieces -----------------------------------------------------------------------------------------------

_encoders: dict[str, Memo] = {}
#: A chunk that byte-level pre-tokenizers leave whole.
ONE_WORD = re.compile(" ?(?:[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]+)")
#: The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on.
_printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LEVEL = {b: chr(b) for b in _printable} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _printable)}


class TwoMemos(Memo):
    """A memo that, when full, keeps what it held until it is full again, so that frequent keys aren't computed again; at most twice `most` entries."""

    def __init__(self, *args, **kw):
        super().__init__(*args, **kw)
        self.before: dict = {}

    def __missing__(self, key):
        if self.longest is not None and len(key) > self.longest:
            return self.compute(key)
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        value = self.before.get(key)
        value = self[key] = self.compute(key) if value is None else value
        return value


def _encoder(path: str) -> Memo:
    """Text between two cuts of the pre-tokenizer -> its ids as bytes, by the tokenizers library.

    A chunk of one word goes to the library's model at once, without its pre-tokenizer and its offsets, where nothing else
    stands before the model.
    """
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        before, model = tokenizer.pre_tokenizer, tokenizer.model
        plain = (
            isinstance(before, pre_tokenizers.ByteLevel) and before.use_regex and not before.add_prefix_space and isinstance(model, models.BPE) and tokenizer.normalizer is None
            and tokenizer.truncation is None and tokenizer.padding is None and all(t.special for t in tokenizer.get_added_tokens_decoder().values())
        )

        def ids(chunk: str) -> bytes:
            if plain and ONE_WORD.fullmatch(chunk):
                word = chunk.replace(" ", BYTE_LEVEL[32]) if chunk.isascii() else chunk.encode().decode("latin-1").translate(BYTE_LEVEL)
                found = list(map(attrgetter("id"), model.tokenize(word)))
            else:
                found = tokenizer.encode(chunk, add_special_tokens=False).ids
            return struct.pack(f"<{len(found)}I", *found)

        _encoders[path] = TwoMemos(ids, longest=LONG_CHUNK)
    return _encoders[path]


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens; only the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def slots_of(runs: list[tuple[int, int, int, int, int, int]], size: int = SLOT_RANKS) -> list[tuple]:
    """The runs, each once for every slot of `size` ranks that it reaches into: (length, slot, first, end, each, sequence, offset)."""
    return [(length, slot, first, end, *rest) for length, first, end, *rest in runs for slot in range(first // size, (end - 1) // size + 1)]


def pieces(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """(key, piece, start, length, ids_crc32) of each piece of each row."""

    def cut_all(texts: list) -> list[list]:
        known = _encoder(path)
        end = END_ID.to_bytes(4, "little")
        out = []
        for row, t in enumerate(texts):
            ids = b"".join(map(known.__getitem__, CHUNK.findall(t or ""))) + end
            out += [(i, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)]), row) for i, (s, n) in enumerate(cut(len(ids) // 4, capacity))]
        return [list(x) for x in zip(*out)]

    return arrow_rows(docs, [key], text, cut_all, "piece int, start bigint, length bigint, ids_crc32 bigint", many=True)


def pack(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Every piece of `docs` with its sequence_id and its offset there."""
    spark = docs.sparkSession
    cuts = durable(numbered(pieces(docs, path, text, key, capacity)), "pieces")
    histogram = {r["length"]: r["n"] for r in cuts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    plan = best_fit(histogram, capacity)
    before, tokens = plan.sequences(), sum(x * n for x, n in histogram.items())
    plan = local_search(plan)
    log.info("%d pieces: %d sequences by best fit, %d after the local search, %d at least", sum(histogram.values()), before, plan.sequences(), -(-tokens // capacity))
    runs = slots_of(places(plan))
    table = spark.createDataFrame(runs, "length bigint, _slot bigint, _first bigint, _end bigint, _each bigint, _sequence bigint, _offset bigint")
    at = F.col("_rank") - F.col("_first")
    found = ranked(cuts, ["length"], [key, "piece", "ids_crc32", "_row"], "_rank", sum(histogram.values())).withColumn("_slot", F.floor(F.col("_rank") / SLOT_RANKS))
    return (
        found.join(F.broadcast(table) if len(runs) <= BROADCAST_RUNS else table, ["length", "_slot"])
        .where((F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end")))
        .select(
            key, "piece", "start", "length", "ids_crc32",
            (F.col("_sequence") + F.floor(at / F.col("_each"))).cast("long").alias("sequence_id"),
            (F.col("_offset") + (at % F.col("_each")) * F.col("length")).cast("long").alias("offset"),
        )
    )
