"""Byte-level BPE, encoded left to right with an Aho-Corasick automaton instead of by repeated merging.

Bytes are mapped to Latin-1 characters so that the automaton finds every vocabulary entry that ends at each
place of a piece. The encoder takes the longest entry at its position whose pair with the entry before it is
compatible, falls back to shorter ones, and steps back when none is left. Two adjacent entries are compatible
when merging their joint bytes by rank gives just these two; that test is memoised. A sequence of entries is
what the merge procedure yields exactly when all its adjacent pairs are compatible, so the first sequence
found is the right one. Positions from which no continuation exists are remembered per entry before them,
which keeps the work linear in the length of the piece.

Null texts count as empty; an empty text has no ids. Repeated rows and keys are encoded each; texts of any length are
encoded whole (chunks of more than LONG_CHUNK characters without being remembered); an empty table gives no rows; other
columns than key and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re

import ahocorasick
import regex
from pyspark.sql import DataFrame

from quorate.llm.common import arrow_rows

#: Entries of each memo; a full memo is emptied, so memory stays bounded. Longer chunks than LONG_CHUNK aren't remembered.
MEMO_ENTRIES = 300_000
LONG_CHUNK = 64
#: White space as the Unicode property White_Space has it (a fixed list).
SPACE = "\t-\r \x85\xa0  -     　"
#: Cuts a text only where the usual pre-tokenizer patterns also cut: letters with the blank before them up to white
#: space, a full stop or a comma; else a run of other characters with the blank before it; else white space.
CHUNK = re.compile(f" ?[A-Za-zÀ-ÖØ-öø-ÿ]++(?![^{SPACE}.,])| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class Memo(dict):
    """A dict that computes missing values and empties itself when full; keys that are longer than `longest` aren't kept."""

    def __init__(self, compute, most: int = MEMO_ENTRIES, longest: int | None = None):
        super().__init__()
        self.compute, self.most, self.longest = compute, most, longest

    def __missing__(self, key):
        if self.longest is not None and len(key) > self.longest:
            return self.compute(key)
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.compute(key)
        return value


class BytePairCodec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.token = {rank: token for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.halves = Memo(self._halves)
        self.pairs = Memo(self._compatible)
        self.chunks = Memo(self._chunk, longest=LONG_CHUNK)

    def merged(self, data: bytes, below: int = 1 << 60) -> list[int]:
        """The definition: merge the adjacent pair of least rank until none of rank under `below` is left. For short data."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
            if best[0] >= below:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _halves(self, rank: int) -> tuple[int, int] | None:
        """The two entries whose merge makes this one; None for a single byte or an entry that merging never makes."""
        data = self.token[rank]
        if len(data) < 2:
            return None
        without = self.merged(data, rank)
        return (without[0], without[1]) if len(without) == 2 else None

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """Whether merging the joint bytes of two entries leaves them as they are.

        The merges inside either entry happen in the order of their ranks. A merge across the border would come
        first if its rank is below that of the next merge beside the border; undo these from the last one on.
        """
        left, right = pair
        bound = 1 << 60
        token, ranks = self.token, self.ranks
        while True:
            if ranks.get(token[left] + token[right], 1 << 60) < bound:
                return False
            a, b = self.halves[left], self.halves[right]
            if a is None and b is None:
                return True
            if b is None or a is not None and left > right:
                bound, left = left, a[1]
            else:
                bound, right = right + 1, b[0]

    def encode_piece(self, data: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        if (known := self.ranks.get(data)) is not None:
            return [known]
        n = len(data)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, found in self.automaton.iter(data.decode("latin-1")):
            starts[end - found[1] + 1].append(found)  # ends ascend, so the longest is last
        out: list[int] = []
        at, last, pairs, halves = 0, -1, self.pairs, self.halves
        left = [len(starts[0])]  # how many choices are left at each place on the way
        dead: set[tuple[int, int]] = set()
        while at < n:
            options, k = starts[at], left[-1]
            while k:
                k -= 1
                rank, size = options[k]
                if (size < 2 or halves[rank]) and (last < 0 or pairs[last, rank]) and (not dead or (at + size, rank) not in dead):
                    left[-1] = k
                    out.append(rank)
                    last = rank
                    at += size
                    left.append(len(starts[at]) if at < n else 0)
                    break
            else:
                if not out:
                    raise ValueError("the vocabulary lacks some single bytes")
                dead.add((at, last))
                at -= len(self.token[out.pop()])
                last = out[-1] if out else -1
                left.pop()
        return out

    def _chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        for piece in self.pattern.findall(chunk):
            ids += self.encode_piece(piece.encode("utf-8", "surrogatepass"))
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def encode_to_bytes(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.chunks.__getitem__, CHUNK.findall(text)))

    def encode(self, text: str) -> list[int]:
        return memoryview(self.encode_to_bytes(text)).cast("I").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_codecs: dict[tuple[str, str], BytePairCodec] = {}


def codec(path: str, pattern: str) -> BytePairCodec:
    """One codec a worker process for each vocabulary."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = BytePairCodec(read_ranks(path), pattern)
    return _codecs[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids array<int>, decoded binary) of each row: the encoder's output and its round trip."""

    def encode(texts: list) -> list[list]:
        c = codec(path, pattern)
        ids = [c.encode(t or "") for t in texts]
        return [[len(i) for i in ids], ids, [c.decode(i) for i in ids]]

    return arrow_rows(docs, [key], text, encode, "n_tokens bigint, ids array<int>, decoded binary", rows=250)


def digest_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of each row; the ids themselves don't leave the worker."""

    def digest(texts: list) -> list[list]:
        c = codec(path, pattern)
        out: list[list] = [[], [], []]
        for t in texts:
            packed = c.encode_to_bytes(t or "")
            decoded = c.decode(memoryview(packed).cast("I"))
            for column, value in zip(out, (len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest())):
                column.append(value)
        return out

    return arrow_rows(docs, [key], text, digest, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
