"""Near-duplicates by BagMinHash: weighted-Jaccard signatures of word-shingle multisets, banding, verification.

A text's words (lower-cased; ASCII non-alphanumerics separate) give a multiset of five-word shingles; a text of
fewer words is one shingle. Each weight is cut into the dyadic intervals [0,1), [1,2), [2,4), ...; over each interval
of a shingle runs a Poisson process of the interval's width as rate, whose points carry a place inside the
interval and one of COMPONENTS signature components. A point counts if its place lies below the weight, and a
component keeps the earliest point of all shingles. So two signatures agree in a component with the
probability of the weighted Jaccard similarity. Points are made only up to the time by which all components are
expected to be met; a text that missed one is done again up to a later time.

Texts of equal multisets form one class first, whose name is their fingerprint; ids play no part, so rows without
id or with an id that other texts have as well are compared like any other. Classes that agree in a band share a
bucket. No bucket is collected or expanded into all its pairs:
1. each member is compared with the bucket's pivot, the member that meets most others in all its buckets: linear in
   the members;
2. verified links are joined into components; buckets with more than one component get a further pivot, a few times;
3. in buckets that still have more than one component, the members outside the largest component are compared with all
   members, block by block, by signature; pairs of different components that agree in at least ESTIMATE of it are
   verified there, and only links are emitted.
Verification is on the multisets of 64-bit shingle hashes. Components of all verified links are the classes.

Defined results: null texts count as empty; all texts without a word form one class; repeated rows share a class;
texts of any length are read whole; extra columns are ignored; an empty table gives no rows. The least doc_id of a class is its class_id; a row
without id gets the class_id of its texts' class but can't name one (null if no row of the class has an id). If texts
of several classes have the same id, these classes may have the same class_id; deduplicated() keeps a row of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.llm.bpe import Memo
from quorate.llm.common import arrow_rows, durable, join_on_hot_key, numbered

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
COMPONENTS = BANDS * ROWS
#: Least share of equal components for a pair to be verified: four standard deviations under SIMILARITY.
ESTIMATE = 0.66
#: Times that the members of a bucket with several components are compared with a pivot.
STAR_ROUNDS = 2
#: Members of a bucket's block.
BLOCK = 512
#: Up to so many ids are broadcast to fetch their texts; beyond that they are joined.
BROADCAST_IDS = 200_000
#: Words that are signed at once.
WORDS_AT_ONCE = 200_000

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_hashes = Memo(xxhash.xxh64_intdigest, 200_000)
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U(30))
        x = x * U(0xBF58476D1CE4E5B9)
        x = x ^ (x >> U(27))
        x = x * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


def fold(text: str | None) -> bytes:
    """The text in lower case, with blanks for ASCII characters that are no letters or digits."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_FOLD)


def word_hashes_of(folded: bytes) -> np.ndarray:
    words = folded.split()
    return np.fromiter(map(_hashes.__getitem__, words), U, len(words))


def word_hashes(text: str | None) -> np.ndarray:
    return word_hashes_of(fold(text))


def shingles(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle hash) of all shingles of texts given as word hashes, texts in order."""
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.concatenate([*words, np.zeros(SHINGLE - 1, U)])
    with np.errstate(over="ignore"):
        n = int(sizes.sum())
        h = mix(flat[:n] + U(1))
        for k in range(1, SHINGLE):
            h = mix(h * U(0x9E3779B97F4A7C15) + flat[k : k + n])
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    full = place + SHINGLE <= sizes[owner]
    owner, h = owner[full], h[full]
    short = [i for i, s in enumerate(sizes) if 0 < s < SHINGLE]
    if short:
        own = np.array([xxhash.xxh64_intdigest(words[i].tobytes()) for i in short], U)
        owner, h = np.concatenate([owner, short]), np.concatenate([h, own])
        order = np.argsort(owner, kind="stable")
        owner, h = owner[order], h[order]
    return owner, h


def multisets(owner: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, distinct shingle, weight), sorted."""
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return owner[at], h[at], np.diff(np.append(at, len(h)))


def signatures(owner: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, m: int = COMPONENTS) -> np.ndarray:
    """(n, m) 32-bit components; zeros for a text without shingles."""
    # The dyadic intervals below each weight: number 0 is [0,1), number i is [2^(i-1), 2^i).
    levels = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    e_owner, e_weight = np.repeat(owner, levels), np.repeat(weight, levels)
    level = np.arange(levels.sum()) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 2 ** np.maximum(level - 1, 0), 0)
    width = np.maximum(low, 1)
    with np.errstate(over="ignore"):
        seed = mix(np.repeat(h, levels) + level.astype(U) * U(0xD6E8FEB86659FD93))
    out = np.zeros((n, m), np.uint32)
    total = np.bincount(owner, weight, n)
    due = np.flatnonzero(total > 0)
    aim = m * (np.log(m) + 3.0)
    while len(due):
        until = np.zeros(n)
        until[due] = aim / total[due]
        active = np.flatnonzero(until[e_owner] > 0)
        time = np.zeros(len(active))
        found: list[tuple] = []
        turn = 0
        while len(active):
            turn += 1
            with np.errstate(over="ignore"):
                state = mix(seed[active] + U(turn) * U(0x9E3779B97F4A7C15))
            time = time - np.log(uniform(state)) / width[active]
            early = time <= until[e_owner[active]]
            active, time, state = active[early], time[early], state[early]
            place = low[active] + (uniform(mix(state + U(1))) * width[active]).astype(np.int64)
            ok = place < e_weight[active]
            second = mix(state[ok] + U(2))
            found.append((e_owner[active[ok]] * m + (second % U(m)).astype(np.int64), time[ok], (second >> U(32)).astype(np.uint32)))
        cell, when, value = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((value, when, cell))
        cell, value = cell[order], value[order]
        first = np.ones(len(cell), bool)
        first[1:] = cell[1:] != cell[:-1]
        met = np.bincount(cell[first] // m, minlength=n)
        whole = met == m
        take = first & whole[cell // m]
        out.reshape(-1)[cell[take]] = value[take]
        due = due[~whole[due]]
        aim *= 2
    return out


def bands_of(signature: np.ndarray) -> np.ndarray:
    """(n, BANDS) bucket keys."""
    parts = signature.reshape(len(signature), BANDS, ROWS).astype(U)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U), parts.shape[:2])
        for k in range(ROWS):
            key = mix(key * U(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


def _groups(texts: list) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Texts as word hashes, in runs of a bounded number of words."""
    first, run, held = 0, [], 0
    for i, t in enumerate(texts):
        run.append(word_hashes(t))
        held += len(run[-1])
        if held >= WORDS_AT_ONCE or i + 1 == len(texts):
            yield first, run
            first, run, held = i + 1, [], 0


def signed(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(doc, mark, print, n_shingles, bands, signature) of each row; mark: hash of the text, print: fingerprint of the multiset."""

    def sign(texts: list) -> list[list]:
        out: list[list] = [[], [], [], []]
        for _, words in _groups(texts):
            n = len(words)
            owner, h, weight = multisets(*shingles(words))
            with np.errstate(over="ignore"):
                heavy = weight.astype(U)
                prints = []
                for salt in (U(11), U(12)):
                    sums = np.zeros(n, U)
                    np.add.at(sums, owner, mix(mix(h + salt) + heavy))
                    prints.append(sums.view(np.int64))
            signature = signatures(owner, h, weight, n)
            sizes = np.bincount(owner, weight, n).astype(np.int64)
            print_ = np.stack([sizes, *prints], 1)
            for column, values in zip(out, ([x.tobytes() for x in print_], sizes.tolist(), list(bands_of(signature)), [x.tobytes() for x in signature])):
                column += values
        return out

    rows = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    return arrow_rows(rows, ["doc", "mark"], "text", sign, "print binary, n_shingles bigint, bands array<bigint>, signature binary")


def bags(texts: DataFrame) -> DataFrame:
    """(rep, bag) of a table (rep, text): the sorted shingle hashes of each row, as often as they occur."""
    return arrow_rows(texts, ["rep"], "text", lambda found: [[np.sort(shingles([word_hashes(t)])[1]).tobytes() for t in found]], "bag binary")


def jaccard(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two sorted multisets."""
    x, y = np.frombuffer(a, U), np.frombuffer(b, U)
    if not len(x) or not len(y):
        return 1.0 if len(x) == len(y) else 0.0
    if min(len(x), len(y)) < SIMILARITY * max(len(x), len(y)):
        return min(len(x), len(y)) / max(len(x), len(y))  # an upper bound that is too small already
    # A value's copies in x meet its copies in y, the k-th the k-th.
    copy = np.arange(len(x)) - np.searchsorted(x, x)
    at = np.searchsorted(y, x) + copy
    both = int((y[np.minimum(at, len(y) - 1)][at < len(y)] == x[at < len(y)]).sum())
    return both / (len(x) + len(y) - both)


def texts_at(docs: DataFrame, text: str, key: str, places: DataFrame) -> DataFrame:
    """`docs` with the columns of `places`, a table (..., _doc, _mark) of rows named by their id and their text's hash."""
    few = places.count() <= BROADCAST_IDS
    at = F.col(key).eqNullSafe(F.col("_doc")) & (F.xxhash64(text) == F.col("_mark"))
    return docs.join(F.broadcast(places) if few else places, at)


def bags_of(ids: DataFrame, places: DataFrame, docs: DataFrame, text: str, key: str) -> DataFrame:
    """(rep, bag) of the classes in the table (rep), with (rep, _doc, _mark) of all classes."""
    wanted = durable(places.join(ids.distinct(), "rep"), "wanted")
    texts = texts_at(docs.select(key, text), text, key, wanted).select("rep", F.col(text).alias("text"))
    return durable(bags(texts).dropDuplicates(["rep"]), "bags")


def verified(pairs: DataFrame, places: DataFrame, docs: DataFrame, text: str, key: str, similarity: float) -> DataFrame:
    """The pairs (a, b) whose similarity is at least `similarity`, with it."""
    held = bags_of(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")), places, docs, text, key)
    both = pairs.join(held.select(F.col("rep").alias("b"), F.col("bag").alias("bag_b")), "b").join(held.select(F.col("rep").alias("a"), F.col("bag").alias("bag_a")), "a")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["a", "b"]].assign(similarity=[jaccard(x, y) for x, y in zip(batch["bag_a"], batch["bag_b"])])
            yield out[out["similarity"] >= similarity]

    return durable(both.select("a", "b", "bag_a", "bag_b").mapInPandas(run, "a bigint, b bigint, similarity double"), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b): least labels spread and jump until nothing changes."""
    both = durable(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        spread = labels.join(seen, "node").select("node", F.least("component", "near").alias("component"), F.col("component").alias("old"))
        spread = durable(spread, "labels")
        roots = spread.select(F.col("node").alias("component"), F.col("component").alias("root"))
        new = durable(spread.join(roots, "component").select("node", F.col("root").alias("component"), (F.col("root") != F.col("old")).alias("moved")), "labels")
        labels = new.select("node", "component")
        if new.where("moved").isEmpty():
            return labels


def compare_blocks(group: pd.DataFrame, estimate: float, similarity: float) -> list[tuple]:
    """Links between different components of a block of the members on the left and one of those on the right.

    A bucket of one block has its members once, on the right; those outside its largest component are the left as well. A pair that shares several buckets is compared in the first of these only, and two members that are both on the left
    only once. Pairs whose signatures agree enough are verified here, so that only links leave the task.
    """
    least = int(np.ceil(estimate * COMPONENTS))
    s = np.frombuffer(b"".join(group["signature"]), np.uint32).reshape(len(group), COMPONENTS)
    c, other, left, ids, bag = (group[x].to_numpy() for x in ("component", "other", "left", "rep", "bag"))
    band = group["band"].iloc[0]
    right = np.flatnonzero(~left)
    out = []
    for x in np.flatnonzero(other if group["whole"].iloc[0] else left):
        ys = right[(c[right] != c[x]) & (~other[right] | (ids[right] > ids[x]))]
        if len(ys):
            same = s[ys] == s[x]
            first = same.reshape(len(ys), BANDS, ROWS).all(2).argmax(1)
            for y in ys[(same.sum(1) >= least) & (first == band)]:
                if (found := jaccard(bag[x], bag[y])) >= similarity:
                    out.append((int(min(ids[x], ids[y])), int(max(ids[x], ids[y])), found))
    return out


def links_in_blocks(rows: Iterator[pd.DataFrame], estimate: float, similarity: float) -> Iterator[pd.DataFrame]:
    """compare_blocks() for each (bucket, i, j) of rows sorted by these; a group may span batches."""
    rest = None

    def links(whole: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        for _, group in whole.groupby(["bucket", "i", "j"], sort=False):
            if len(group) > 1:
                found += compare_blocks(group, estimate, similarity)
        return pd.DataFrame(found, columns=["a", "b", "similarity"])

    for batch in rows:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        last = batch.iloc[-1]
        same = (batch["bucket"] == last["bucket"]) & (batch["i"] == last["i"]) & (batch["j"] == last["j"])
        whole, rest = batch[~same], batch[same].reset_index(drop=True)
        if len(whole):
            yield links(whole)
    if rest is not None and len(rest):
        yield links(rest)


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, links): each row's (doc, print); (print, _copies, component, at) of each distinct multiset, where `at`
    is the least row of its component as (_unnamed, _doc, _mark, _row), rows without id last; and (a, b, similarity) of classes by number."""
    rows = durable(numbered(signed(docs, text, key)), "signed")
    here = F.struct(F.col("doc").isNull().alias("_unnamed"), F.col("doc").alias("_doc"), F.col("mark").alias("_mark"), "_row")
    # Inside, a class goes by a number: Spark aggregates and joins longs without sorting, and ships a third of the bytes.
    same = durable(numbered(rows.groupBy("print").agg(F.min(here).alias("at"), F.count(F.lit(1)).alias("_copies")), "rep"), "same")
    places = same.select("rep", "at._doc", "at._mark")
    first = same.select("rep", F.col("at._row").alias("_row"))
    reps = durable(rows.where(F.col("n_shingles") > 0).select("_row", "bands", "signature").join(first, "_row").drop("_row"), "reps")
    banded = reps.select("rep", F.posexplode("bands").alias("band", "bucket"))
    shared = durable(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    members = durable(banded.join(shared, "bucket"), "members")
    # How many others a class meets in all its buckets: the most central member of a bucket is its best pivot.
    degrees = members.groupBy("rep").agg(F.sum(F.col("n") - 1).alias("degree"))
    placed = durable(members.join(degrees, "rep").select("bucket", "band", "rep", "n", "degree", F.col("rep").alias("component"), F.lit(False).alias("used")), "placed")
    tried = links = None  # star pairs so far, and those that are links
    for _ in range(STAR_ROUNDS):
        better = F.struct("degree", F.col("rep"), "component")
        pivots = placed.groupBy("bucket").agg(F.max(F.when(~F.col("used"), better)).alias("p"), F.min("component").alias("_lo"), F.max("component").alias("_hi"))
        pivots = durable(pivots.where("_lo != _hi and p is not null").select("bucket", F.col("p.rep").alias("pivot"), F.col("p.component").alias("pivot_component")), "pivots")
        star = placed.join(pivots, "bucket").where("component != pivot_component")
        star = star.select(F.least("pivot", "rep").alias("a"), F.greatest("pivot", "rep").alias("b")).distinct()
        star = durable(star if tried is None else star.join(tried, ["a", "b"], "left_anti"), "star")
        new = verified(star, places, docs, text, key, similarity)
        tried = star if tried is None else tried.union(star)
        links = new if links is None else links.union(new)
        parts = components(links)
        placed = placed.join(pivots.select("bucket", "pivot"), "bucket", "left").join(parts.select("node", F.col("component").alias("_part")), F.col("rep") == F.col("node"), "left")
        used = F.col("used") | F.coalesce(F.col("rep") == F.col("pivot"), F.lit(False))
        placed = durable(placed.select("bucket", "band", "rep", "n", "degree", F.coalesce("_part", "rep").alias("component"), used.alias("used")), "placed")
    sizes = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("_size")).groupBy("bucket")
    sizes = sizes.agg(F.max(F.struct("_size", "component")).alias("_most"), F.count(F.lit(1)).alias("_components"), F.sum("_size").alias("_n"))
    # A bucket of two was settled by its pivot.
    mixed = durable(sizes.where("_components > 1 and _n > 2").select("bucket", F.col("_most.component").alias("_largest"), (F.col("_n") - F.col("_most._size")).alias("_others")), "mixed")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    spot = lambda n: F.pmod(F.xxhash64("rep"), blocks(n)).cast("int")
    open_ = placed.join(mixed, "bucket").select("bucket", "band", "rep", "component", (F.col("component") != F.col("_largest")).alias("other"), F.col("n").alias("_n"), "_others", (F.col("n") <= BLOCK).alias("whole"))
    lefts = open_.where("other and not whole").withColumns({"left": F.lit(True), "i": spot(F.col("_others"))}).withColumn("j", F.explode(F.sequence(F.lit(0), blocks(F.col("_n")) - 1)))
    rights = open_.withColumns({"left": F.lit(False), "j": spot(F.col("_n"))}).withColumn("i", F.explode(F.sequence(F.lit(0), blocks(F.col("_others")) - 1)))
    open_ = durable(lefts.unionByName(rights).drop("_n", "_others"), "open")
    held = bags_of(open_.select("rep"), places, docs, text, key)
    open_ = open_.join(reps.select("rep", "signature").join(held, "rep"), "rep")
    open_ = open_.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "rep")
    more = open_.mapInPandas(lambda it: links_in_blocks(it, ESTIMATE, similarity), "a bigint, b bigint, similarity double")
    more = durable(more, "more")
    if not more.isEmpty():
        links = durable(links.union(more).dropDuplicates(["a", "b"]), "links")
        parts = components(links)
    whole = same.join(parts, F.col("rep") == F.col("node"), "left").select("print", "_copies", "at", F.coalesce("component", "rep").alias("component"))
    whole = durable(whole, "classes")
    least = durable(whole.groupBy("component").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("_n")), "least")
    classes = join_on_hot_key(whole.drop("at"), least, "component", "_n", whole.count()).drop("_n")
    return rows.select("doc", "print"), durable(classes, "classes"), links


def classes_of(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, class_id) of each row."""
    rows, classes, _ = near_duplicates(docs, text, key)
    named = classes.select("print", "_copies", F.col("at._doc").alias("class_id"))
    return join_on_hot_key(rows, named, "print", "_copies", rows.count()).select(F.col("doc").alias(key), "class_id")


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`docs` with one row of each class: that of the least key, then of the least hash of the text, then of all columns."""
    classes = near_duplicates(docs, text, key)[1]
    places = durable(classes.select(F.col("component").alias("_component"), "at._doc", "at._mark").distinct(), "kept")
    plain = [F.col(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]
    found = texts_at(docs, text, key, places)
    return found.groupBy("_component").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias("_row")).select("_row.*")
