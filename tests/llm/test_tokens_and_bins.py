import hashlib
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quorate.llm import bpe, media, packing, sharding

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
CODEC = bpe.codec(RANKS, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcdeé \n\t.,'sßñ\x1c\x85 日1٢-"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_as_the_library(text):
    ids = CODEC.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


def test_long_pieces():
    r = random.Random(2)
    for text in ("a" * 20_000, "".join(r.choice("abcdefgh") for _ in range(20_000)), " " * 3_000, "!?" * 2_000):
        assert CODEC.encode(text) == LIBRARY.encode_ordinary(text)


def test_bpe_rows(spark, awkward, empty):
    got = bpe.digest_documents(awkward, RANKS, public_tokenizers.PATTERN).collect()
    texts = Counter((hashlib.sha256((r.text or "").encode()).hexdigest(), len(LIBRARY.encode_ordinary(r.text or ""))) for r in awkward.collect())
    assert Counter((r.decoded_sha256, r.n_tokens) for r in got) == texts
    assert bpe.digest_documents(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_packing_rows(spark, awkward, empty):
    got = packing.pack(awkward, JSON).collect()
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    want = Counter()
    for r in awkward.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        for i, (s, n) in enumerate(packing.cut(len(ids))):
            want[r.doc_id, i, s, n, zlib.crc32(packed[4 * s : 4 * (s + n)])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert packing.pack(empty, JSON).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_plan_holds_every_piece(lengths):
    histogram = dict(Counter(lengths))
    first = packing.best_fit(histogram, 50)
    before, fill = first.sequences(), first.squared_fill()
    plan = packing.local_search(first)
    held = Counter()
    for pattern, times in plan.groups.items():
        assert packing.fill(pattern) <= 50
        for length, n in pattern:
            held[length] += n * times
    assert dict(held) == histogram
    assert plan.sequences() <= before and plan.squared_fill() >= fill


def fewest(items, capacity, most):
    """The least number of bins by trying all placements."""
    items = sorted(items, reverse=True)
    best = most

    def place(i, bins):
        nonlocal best
        if len(bins) >= best or -(-(sum(bins) + sum(items[i:])) // capacity) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for held in set(bins):
            if held + items[i] <= capacity:
                bins[bins.index(held)] += items[i]
                place(i + 1, bins)
                bins[bins.index(held + items[i])] -= items[i]
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best


def test_local_search_against_the_optimum():
    r = random.Random(1)
    first = after = optimum = 0
    for trial in range(60):
        pairs = [(r.randint(26, 40), r.randint(26, 40)) for _ in range(5)]
        items = [x for a, b in pairs for x in (a, b, 100 - a - b)] if trial % 2 else [r.choice([51, 27, 26, 23, 25, 24, 49]) for _ in range(15)]
        plan = packing.best_fit(dict(Counter(items)), 100)
        first += plan.sequences()
        found = packing.local_search(plan).sequences()
        after += found
        optimum += fewest(items, 100, found)
    assert optimum <= after < first and first - after >= 0.3 * (first - optimum)


def test_local_search_on_many_triples():
    r = random.Random(2)
    pairs = [(r.randint(260, 400), r.randint(260, 400)) for _ in range(300)]
    plan = packing.best_fit(dict(Counter(x for a, b in pairs for x in (a, b, 1024 - a - b))))
    before = plan.sequences()
    assert packing.local_search(plan).sequences() - 300 <= (before - 300) / 4


def test_runs_cut_at_slots():
    runs = [(7, 0, 10, 2, 0, 0), (7, 10, 35, 1, 5, 3), (9, 0, 1, 1, 30, 0)]
    cut = packing.slots_of(runs, 8)
    for length, rank in [(7, i) for i in range(35)] + [(9, 0)]:
        assert len([r for r in cut if r[0] == length and r[1] == rank // 8 and r[2] <= rank < r[3]]) == 1


def test_equal_rows_are_ranked_and_packed(spark):
    rows = spark.range(3_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("same text").alias("text"))
    got = packing.pack(rows, JSON).collect()
    assert len(got) == 3_000 == len({(r.sequence_id, r.offset) for r in got})
    shards = sharding.shard_documents(rows).collect()
    assert sorted(r.slot for r in shards) == list(range(3_000)) and len({r.shard for r in shards}) == 1


def test_special_strings_and_long_chunks():
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    known = packing._encoder(JSON)
    for text in ("<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "x" * 5_000, "日本" * 900):
        ids = b"".join(map(known.__getitem__, bpe.CHUNK.findall(text)))
        assert memoryview(ids).cast("I").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert all(len(k) <= bpe.LONG_CHUNK for k in known) and all(len(k) <= bpe.LONG_CHUNK for k in CODEC.chunks)


def test_a_full_memo_keeps_frequent_keys():
    computed = []
    memo = packing.TwoMemos(lambda k: computed.append(k) or k.upper(), most=10, longest=5)
    for i in range(100):
        assert memo[f"k{i}"] == f"K{i}" and memo["often"] == "OFTEN" and memo["longer"] == "LONGER"
        assert len(memo) <= 10 and len(memo.before) <= 10
    assert computed.count("often") == 1 and computed.count("longer") == 100 and isinstance(packing._encoder(JSON), packing.TwoMemos)


def test_words_go_to_the_model_at_once(monkeypatch):
    """Ids of single words are the library's, without a call of its whole encoder; all other chunks go through that."""
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    words = ["a", " a", "Hello", " hello", " ÀÉîøÿ", "àéîøÿ", " 0", "2026", " 31415926535", "x" * 500, " " + "é" * 300]
    letters = [chr(c) for c in range(0x250)]
    others = [" ", "  ", "'s", "don't", "(word)", " word's", "3D", "²", "½", "<|endoftext|>", "×÷", "a×b", "漢字", " ıx", "🙂", "\x1c", "a\n", *letters, *(" " + c for c in letters)]
    called = []

    class Counted:
        def __init__(self, own):
            self.__dict__["own"] = own

        @classmethod
        def from_file(cls, path):
            return cls(Tokenizer.from_file(path))

        def __getattr__(self, name):
            return getattr(self.own, name)

        def __setattr__(self, name, value):
            setattr(self.own, name, value)

        def encode(self, chunk, **kw):
            called.append(chunk)
            return self.own.encode(chunk, **kw)

    monkeypatch.setattr(packing, "_encoders", {})
    monkeypatch.setattr("tokenizers.Tokenizer", Counted)
    known = packing._encoder(JSON)
    for chunk in words + others:
        want = library.encode(chunk, add_special_tokens=False).ids
        assert memoryview(known[chunk]).cast("I").tolist() == want, chunk
    assert not set(called) & set(words)


def test_local_search_empties_a_sequence():
    plan = packing.Plan(10)
    for pattern in (((6, 1), (2, 1)), ((5, 1), (3, 1)), ((4, 1),)):
        plan.add(pattern, 1)
    assert packing.local_search(plan).sequences() == 2


def test_differencing_beats_dealing():
    r = random.Random(1)
    sizes = [int(r.paretovariate(1.2) * 100) for _ in range(2_000)]
    parts = sharding.difference([[s, 0, 0, 0] for s in sizes])
    sums = [0] * 4
    for s, p in zip(sizes, parts):
        sums[p[0]] += s
    assert max(sums) - min(sums) <= max(1, max(sizes) - sum(sizes) // 4)


def test_sharding_rows(spark, awkward, empty):
    docs = awkward.unionByName(spark.range(100, 1_100).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 300).cast("string")).alias("text"), F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(1).cast("long").alias("n_chars"), F.lit("x").alias("rule")))
    got = sharding.shard_documents(docs).collect()
    assert len(got) == docs.count() and {r.law for r in got} == {"bytes"}
    slots = defaultdict(list)
    shards = defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        shards[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))
    assert all(len(s) == 1 for s in shards.values())
    assert sharding.shard_documents(empty).count() == 0


def test_levels_of_cells(spark):
    groups = spark.range(3_000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("group"), (F.col("id") % 97 + 1).alias("bytes"))
    got = sharding.assign_groups(groups, 24, cell=100, fan=5)
    sums = [r["s"] for r in got.join(groups, "group").groupBy("shard").agg(F.sum("bytes").alias("s")).collect()]
    assert got.count() == 3_000 and len(sums) == 24 and max(sums) - min(sums) <= 97


def test_a_large_group_over_many_cells(spark):
    r = random.Random(3)
    sizes = [int(r.lognormvariate(8, 1)) for _ in range(40_000)]
    for shares in ([0.03], [0.03, 0.02, 0.02, 0.001], [0.3]):
        held = sizes + [int(sum(sizes) * x / (1 - sum(shares))) for x in shares]
        groups = spark.createDataFrame([(i.to_bytes(4, "big"), s) for i, s in enumerate(held)], "group binary, bytes bigint")
        got = [(bytes(x["group"]), x["shard"]) for x in sharding.assign_groups(groups).collect()]
        assert len(got) == len(held) == len(dict(got))
        sums = Counter()
        for g, shard in got:
            sums[shard] += held[int.from_bytes(g, "big")]
        least = max(sum(held) / 24, max(held))  # no shard can be smaller than the largest group
        assert len(sums) == 24 and max(sums.values()) <= 1.001 * least
        others = sorted(sums.values())[:-1]
        assert max(others) <= 1.001 * min(others)


def test_media(spark, awkward, empty, tmp_path):
    folder = f"file://{tmp_path}/media"
    index = media.write_shards(awkward.coalesce(1), folder).cache()
    rows = media.read_features(media.read_headers(index, folder), folder).collect()
    want = Counter(hashlib.sha256(media.payload_of(r.text)[0]).hexdigest() for r in awkward.collect())
    assert Counter(r.payload_sha256 for r in rows) == want
    assert all(r.payload_bytes % 64 == 0 and r.payload_bytes >= max(64, r.n_bytes) for r in rows)
    held = {}
    for shard in (tmp_path / "media").glob("*.tar"):
        held |= media.members(shard.read_bytes())
    assert set(held) == {f"{d}.png" for d in want}
    assert all(hashlib.sha256(media.decode_png(v)).hexdigest() == k[:-4] for k, v in held.items())
    assert media.media_columns(empty).count() == 0
    ids = Counter(r.doc_id for r in awkward.collect())
    assert Counter(r.doc_id for r in rows) == ids


def test_shards_close_by_rows(spark, tmp_path):
    folder = f"file://{tmp_path}/media"
    docs = spark.createDataFrame([(i if i % 3 else None, "equal") for i in range(1_000)], "doc_id bigint, text string").coalesce(1)
    index = media.write_shards(docs, folder, most_rows=64).cache()
    rows = media.read_features(media.read_headers(index, folder), folder).collect()
    assert len(rows) == 1_000 and len({r[2:] for r in rows}) == 1
    assert Counter(r.doc_id for r in rows) == Counter(i if i % 3 else None for i in range(1_000))
    assert len(list((tmp_path / "media").glob("*.tar"))) == 1  # 16 shards of the same content have one name
