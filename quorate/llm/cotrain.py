"""Quality classifier by co-training: two views of a document teach each other, then vote.

View 1 is the text's content: rates of symbols, repetition, capitals and so on, and hashed words, pairs of words and
character trigrams, each as the root of its share of the text; both are made where the text is, in one call of Python. View 2 is the page's metadata: language, source
and length and their pairs, hashed or binned. Both are logistic regressions in numpy, fitted on the driver from at
most LABELLED_ROWS labelled rows (a documented bound; those with the least hash of the id) and what the views hand to
each other. All other documents are the pool: in each round both views score all of it, and each labels the rows that
it is surest of, at most EXCHANGED of either label and only where its calibrated confidence passes CONFIDENT, for the
other view. At the end both views are calibrated (Platt) on rows kept out of the fit and combined by a small logistic
regression on these. All documents are then scored.

The pool's features are written once as a compact table (VECTOR bytes a document); a round is a scan of it whose tasks
give their best rows, so the driver gets 4 * EXCHANGED rows a round, however large the pool is.

Defined results: null text, language, source or length count as empty, unknown or 0; texts of any length are read whole.
Without labelled rows of both classes every score is the share of good labels (1 without labels). Repeated rows
are scored each; rows of equal confidence go by the hash of their id and then their place in the table. Columns of the
input keep their values whatever they are called: score() returns them inside one struct.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorate.llm.bagminhash import U, fold, mix, word_hashes_of
from quorate.llm.common import durable, held_out, numbered
from quorate.llm.rulelist import RATES, SYMBOLS, WHITE

LABELLED_ROWS = 4_000
ROUNDS, EXCHANGED = 5, 100
CONFIDENT = 0.95
#: Each rate is clipped here and then also taken as a square root, so that a linear model can use small values.
TOP = {"mean_word": 20.0, "words_per_line": 100.0}
WORD_SLOTS, PAIR_SLOTS, GRAM_SLOTS = 512, 256, 256
VECTOR = WORD_SLOTS + PAIR_SLOTS + GRAM_SLOTS
#: Bytes of texts that are hashed or counted at once.
BYTES_AT_ONCE = 1 << 20
#: Counts that are sums over a text's bytes: those that count, of ASCII and of the first bytes of other characters.
BYTE_COUNTS = {
    "word_chars": [b for b in range(256) if chr(b) not in WHITE and b >> 6 != 2], "n_symbols": list(SYMBOLS.encode()), "n_upper": list(range(65, 91)),
    "n_exclaim": list(b"!?"), "n_digits": list(range(48, 58)), "n_lines": [10],
}
BYTE_KINDS = np.array([[b in found for found in BYTE_COUNTS.values()] for b in range(256)], np.int64)
#: Up to so many distinct words the numbers of three fit one 64-bit integer.
MOST_NUMBERS = 1 << 21
_white = re.compile(rb"[ \t-\r]")
#: Slots of the metadata view: language, source, length, source and length, language and length.
LANG_SLOTS, SOURCE_SLOTS, LENGTH_SLOTS, CROSS_SLOTS = 8, 32, 24, 64
META = LANG_SLOTS + SOURCE_SLOTS + LENGTH_SLOTS + 2 * CROSS_SLOTS
RATE_PENALTY, HASH_PENALTY, META_PENALTY = 0.01, 1.0, 1.0


# --- the views ------------------------------------------------------------------------------------------------


def pieces_of(text: str | None) -> Iterator[bytes]:
    """The folded text in parts of at most BYTES_AT_ONCE bytes, cut at blanks where there are any."""
    data, at = fold(text), 0
    while at < len(data):
        end = min(at + BYTES_AT_ONCE, len(data))
        if end < len(data) and (blank := data.rfind(b" ", at, end)) > at:
            end = blank + 1
        yield data[at:end]
        at = end


def counted(pieces: list[bytes], owners: list[int], n: int) -> np.ndarray:
    """(n, VECTOR) counts of hashed words, word pairs and character trigrams."""

    def add(own: np.ndarray, slot: np.ndarray, slots: int) -> np.ndarray:
        return np.bincount(own * slots + slot.astype(np.int64), minlength=n * slots).reshape(n, slots)

    words = [word_hashes_of(p) for p in pieces]
    own = np.repeat(owners, [len(w) for w in words])
    piece = np.repeat(np.arange(len(words)), [len(w) for w in words])
    flat = np.concatenate([*words, np.zeros(0, U)])
    chars = np.frombuffer(b"".join(pieces), np.uint8).astype(U)
    char_piece = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
    with np.errstate(over="ignore"):
        pair = mix(flat[:-1] * U(0x9E3779B97F4A7C15) + flat[1:])
        gram = mix((chars[:-2] << U(16) | chars[1:-1] << U(8) | chars[2:]) + U(1))
    near = piece[:-1] == piece[1:]
    whole = char_piece[:-2] == char_piece[2:]
    return np.hstack([
        add(own, flat % U(WORD_SLOTS), WORD_SLOTS), add(own[:-1][near], pair[near] % U(PAIR_SLOTS), PAIR_SLOTS),
        add(np.asarray(owners)[char_piece[:-2][whole]], gram[whole] % U(GRAM_SLOTS), GRAM_SLOTS),
    ])


def vectors(texts: list) -> np.ndarray:
    """(n, VECTOR) bytes: 255 times the root of the share of the text's words, pairs or trigrams that a slot has."""
    out = np.zeros((len(texts), VECTOR), np.int64)
    pieces: list[bytes] = []
    owners: list[int] = []
    held = 0

    def flush() -> None:
        first, last = owners[0], owners[-1] + 1
        out[first:last] += counted(pieces, [o - first for o in owners], last - first)

    for i, t in enumerate(texts):
        for p in pieces_of(t):
            pieces.append(p)
            owners.append(i)
            held += len(p)
            if held >= BYTES_AT_ONCE:
                flush()
                pieces, owners, held = [], [], 0
    if pieces:
        flush()
    shares, at = np.empty(out.shape), 0
    for size in (WORD_SLOTS, PAIR_SLOTS, GRAM_SLOTS):
        part = out[:, at : at + size]
        shares[:, at : at + size] = np.sqrt(part / np.maximum(part.sum(1, keepdims=True), 1))
        at += size
    return np.rint(255 * shares).astype(np.uint8)


@cache
def other_capitals() -> np.ndarray:
    """Which characters beyond ASCII are upper-case letters, by code point."""
    return np.fromiter((c > 127 and unicodedata.category(chr(c)) == "Lu" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def between_words(data: bytes) -> Iterator[bytes]:
    """Parts of about BYTES_AT_ONCE bytes that begin and end between words; a longer word stays whole."""
    at = 0
    while at < len(data):
        blank = _white.search(data, at + BYTES_AT_ONCE)
        end = blank.start() if blank else len(data)
        yield data[at:end]
        at = end


def repeated(numbers: np.ndarray, n: int) -> int:
    """How many words lie in a three-word window that the text has twice or more; words as numbers under n, equal for equal words only."""
    window = numbers[:-2] * n + numbers[1:-1]
    if n > MOST_NUMBERS:
        window = np.unique(window, return_inverse=True)[1]
    window = window * n + numbers[2:]
    order = np.argsort(window)
    same = np.diff(window[order]) == 0
    if not same.any():
        return 0
    twice = np.zeros(len(window), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    held = np.zeros(len(numbers), bool)
    for k in range(3):
        held[k : k + len(twice)] |= twice
    return int(held.sum())


def counts_of(text: str | None) -> dict[str, int]:
    """The counts of rulelist.with_statistics(), exact for a text of any length."""
    data = (text or "").encode("utf-8", "surrogatepass")
    number: dict[bytes, int] = defaultdict(count().__next__)
    numbers, sums, capitals = [np.zeros(0, np.int64)], np.zeros(len(BYTE_COUNTS), np.int64), 0
    for part in between_words(data):
        sums += np.bincount(np.frombuffer(part, np.uint8), minlength=256) @ BYTE_KINDS
        if not part.isascii():
            code = np.frombuffer(part.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
            capitals += int(other_capitals()[code].sum())
        words = part.split()
        numbers.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    flat = np.concatenate(numbers)
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    out = dict(zip(BYTE_COUNTS, sums.tolist()))
    return out | {
        "n_words": len(flat), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeated(flat, len(number)), "n_distinct": len(number),
        "n_upper": out["n_upper"] + capitals, "n_lines": out["n_lines"] + 1,
    }


def rates_of(texts: list) -> np.ndarray:
    """(n, 2 * rates): each rate of rulelist.RATES, clipped, and its root."""
    found = [counts_of(t) for t in texts]
    column = lambda name: np.array([c[name] for c in found], np.float64)
    out = []
    for name, (above, below) in RATES.items():
        top = TOP.get(name, 1.0)
        value = np.minimum(column(above) / np.maximum(column(below), 1), top) / top
        out += [value, np.sqrt(value)]
    return np.stack(out, 1)


@F.pandas_udf(T.StructType().add("rates", T.ArrayType(T.DoubleType())).add("v", T.BinaryType()))
def text_view(text: pd.Series) -> pd.DataFrame:
    values = list(text)
    v = [x.tobytes() for i in range(0, len(values), 500) for x in vectors(values[i : i + 500])]
    return pd.DataFrame({"rates": pd.Series(list(rates_of(values)), dtype=object), "v": pd.Series(v, dtype=object)})


def slots(columns: list[str]) -> Column:
    """The five slots of a row's metadata, numbered through."""
    have = lambda c, kind: F.col(f"row.{c}").cast(kind) if c in columns else F.lit(None).cast(kind)
    lang, source = F.coalesce(have("lang", "string"), F.lit("")), F.coalesce(have("source", "string"), F.lit(""))
    chars = F.greatest(F.coalesce(have("n_chars", "double"), F.lit(0.0)), F.lit(0.0))
    length = F.least(F.floor(F.log2(F.when(F.isnan(chars), 0.0).otherwise(chars) + 1)), F.lit(LENGTH_SLOTS - 1)).cast("int")
    found = [
        (F.pmod(F.xxhash64(lang), F.lit(LANG_SLOTS)), LANG_SLOTS), (F.pmod(F.xxhash64(source), F.lit(SOURCE_SLOTS)), SOURCE_SLOTS), (length, LENGTH_SLOTS),
        (F.pmod(F.xxhash64(source, length), F.lit(CROSS_SLOTS)), CROSS_SLOTS), (F.pmod(F.xxhash64(lang, length), F.lit(CROSS_SLOTS)), CROSS_SLOTS),
    ]
    starts = np.cumsum([0, *(n for _, n in found)]).tolist()
    return F.array(*((c + F.lit(at)).cast("int") for (c, _), at in zip(found, starts)))


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, rates, slots, v) of each row of `docs`: the row as a struct, and its two views. To score many rows write them with prepared()."""
    rows = docs.select(F.struct("*").alias("row")).withColumn("found", text_view(F.col(f"row.{text}")))
    return rows.select("row", "found.rates", slots(docs.columns).alias("slots"), "found.v")


def content(rates: list, v: list) -> np.ndarray:
    """(n, 2 * rates + VECTOR) inputs of the text view."""
    found = np.frombuffer(b"".join(v), np.uint8).reshape(len(v), VECTOR).astype(np.float32) / np.float32(255)
    return np.hstack([np.array(rates, np.float32).reshape(len(v), 2 * len(RATES)), found])


def page(slots: list) -> np.ndarray:
    out = np.zeros((len(slots), META), np.float32)
    if len(slots):
        np.put_along_axis(out, np.array(slots, np.int64), 1, 1)
    return out


PENALTIES = (np.concatenate([np.full(2 * len(RATES), RATE_PENALTY), np.full(VECTOR, HASH_PENALTY)]), np.full(META, META_PENALTY))


# --- learning -------------------------------------------------------------------------------------------------


def logistic(x: np.ndarray, y: np.ndarray, penalty: np.ndarray, steps: int = 30) -> np.ndarray:
    """Weights (the last is the constant) by Newton steps with L2 penalties; each step by conjugate gradients."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    squares = x * x
    ridge = np.append(penalty, 1e-6)
    w = np.zeros(x.shape[1])

    def loss(m: np.ndarray, w: np.ndarray) -> float:
        return float(np.logaddexp(0, m).sum() - y @ m + ridge @ (w * w) / 2)

    m = x @ w
    now = loss(m, w)
    for _ in range(steps):
        p = probability(m)
        gradient = x.T @ (p - y) + ridge * w
        curve = p * (1 - p) + 1e-9
        scale = 1 / (curve @ squares + ridge)  # the diagonal, as the preconditioner
        step, rest = np.zeros_like(w), gradient
        z = scale * rest
        way, before = z, rest @ z
        start = before
        if start < 1e-6 * max(1.0, now):
            break
        for _ in range(60):
            h = x.T @ (curve * (x @ way)) + ridge * way
            a = before / (way @ h)
            step = step + a * way
            rest = rest - a * h
            z = scale * rest
            after = rest @ z
            if after < 1e-4 * start:
                break
            way, before = z + after / before * way, after
        moved, size = x @ step, 1.0
        while size > 1e-4 and loss(m - size * moved, w - size * step) > now:
            size /= 2
        w, m = w - size * step, m - size * moved
        now = loss(m, w)
    return w


def logits(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def probability(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class View:
    """Linear weights and their calibration (slope, constant): calibrated logits of inputs."""

    weights: np.ndarray
    slope: float
    constant: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.slope * logits(x, self.weights) + self.constant


@dataclass
class Model:
    text: View
    meta: View
    vote: np.ndarray
    exchanged: tuple[int, int] = (0, 0)


@dataclass
class Sure:
    """A row of the pool that a view hands to the other one."""

    number: int
    x: np.ndarray
    z: np.ndarray
    label: int


#: Given both views and the numbers of rows that each has been given already, what each view hands over.
Pool = Callable[[tuple[View, View], tuple[set[int], set[int]]], tuple[list[Sure], list[Sure]]]


def train(x: np.ndarray, z: np.ndarray, y: np.ndarray, check: np.ndarray, pool: Pool, rounds: int = ROUNDS) -> Model | float:
    """The model, or the share of good labels if there is nothing to learn. `check`: rows for calibration."""
    own = ~check
    if min((y[own] == 0).sum(), (y[own] == 1).sum(), (y[check] == 0).sum(), (y[check] == 1).sum()) < 2:
        return float(y.mean()) if len(y) else 1.0
    labelled = (x, z)
    taught: tuple[list[Sure], list[Sure]] = ([], [])

    def fitted(v: int) -> View:
        more = [s.z if v else s.x for s in taught[v]]
        inputs = np.vstack([labelled[v][own], *more])
        w = logistic(inputs, np.concatenate([y[own], [s.label for s in taught[v]]]), PENALTIES[v])
        slope, constant = logistic(logits(labelled[v][check], w)[:, None], y[check], np.ones(1))
        return View(w, float(slope), float(constant))

    given = [0, 0]
    for _ in range(rounds):
        used = tuple({s.number for s in rows} for rows in taught)
        found = pool((fitted(0), fitted(1)), used)
        for v in (0, 1):
            taught[1 - v].extend(found[v])
            given[v] += len(found[v])
        if not any(found):
            break
    views = fitted(0), fitted(1)
    both = np.clip(np.stack([views[0](x[check]), views[1](z[check])], 1), -12, 12)
    return Model(*views, logistic(both, y[check], np.ones(2)), tuple(given))


def best_rows(batch: pd.DataFrame, views: tuple[View, View], used: tuple[set[int], set[int]]) -> pd.DataFrame:
    """Of some rows of the pool those that each view is surest of, for either label: at most EXCHANGED each."""
    inputs = content(list(batch["rates"]), list(batch["v"])), page(list(batch["slots"]))
    out = []
    for v in (0, 1):
        p = probability(views[v](inputs[v]))
        free = ~batch["_row"].isin(used[1 - v]).to_numpy()
        for label in (0, 1):
            sure = p if label else 1 - p
            mine = batch.assign(view=v, label=label, sure=sure)[free & (sure >= CONFIDENT)]
            out.append(mine.sort_values(["sure", "_order", "_row"], ascending=[False, True, True]).head(EXCHANGED))
    return pd.concat(out, ignore_index=True)


def pool_of(rows: DataFrame) -> Pool:
    """The pool over a written table of features: `rows` without a label."""

    def choose(views: tuple[View, View], used: tuple[set[int], set[int]]) -> tuple[list[Sure], list[Sure]]:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best = None
            for batch in batches:
                batch = best_rows(batch, views, used)
                best = batch if best is None else pd.concat([best, batch], ignore_index=True)
                best = best.sort_values(["sure", "_order", "_row"], ascending=[False, True, True]).groupby(["view", "label"]).head(EXCHANGED)
            if best is not None:
                yield best

        kinds = "rates array<double>, slots array<int>, v binary, _row bigint, _order bigint"
        found = durable(rows.select("rates", "slots", "v", "_row", "_order").mapInPandas(run, f"{kinds}, view int, label int, sure double"), "surest")
        out: tuple[list[Sure], list[Sure]] = ([], [])
        for v in (0, 1):
            for label in (0, 1):
                best = found.where((F.col("view") == v) & (F.col("label") == label)).orderBy(F.desc("sure"), "_order", "_row").limit(EXCHANGED).collect()
                for r in best:
                    out[v].append(Sure(r["_row"], content([r["rates"]], [bytes(r["v"])])[0], page([r["slots"]])[0], label))
        return out

    return choose


def prepared(docs: DataFrame, text: str = "text", key: str = "doc_id", whole: bool = False) -> DataFrame:
    """A written table of the features of all rows; `row` has all columns if `whole`, else only the key."""
    have = [c for c in ("lang", "source", "n_chars") if c in docs.columns and c not in (key, text)]
    found = features(docs if whole else docs.select(key, text, *have), text).withColumn("_id", F.col(f"row.{key}"))
    found = found if whole else found.withColumn("row", F.struct(f"row.{key}"))
    return durable(numbered(found.withColumn("_order", F.xxhash64("_id"))), "features")


def fit(rows: DataFrame, docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", labelled: int = LABELLED_ROWS) -> Model | float:
    """The model from at most `labelled` labelled rows of `docs` and the pool `rows`, a table of prepared() without these rows."""
    chosen = (
        labels.where(F.col("quality").isNotNull() & ~held_out(F.col(key)))
        .select(F.col(key).alias("_k"), F.col("quality").cast("int").alias("y"))
        .orderBy(F.xxhash64("_k"), "_k", "y").limit(labelled).dropDuplicates(["_k"])
    )
    have = [c for c in ("lang", "source", "n_chars") if c in docs.columns and c not in (key, text)]
    own = docs.select(F.col(key).alias("_i"), F.col(text).alias("_t"), *have).join(F.broadcast(chosen), F.col("_i") == F.col("_k"))
    check = F.crc32(F.concat(F.lit("c"), F.col("row._i").cast("string")).cast("binary")) % 4 == 0
    own = features(own, "_t").select("rates", "slots", "v", F.col("row.y").alias("y"), check.alias("c"), F.xxhash64("row._i").alias("_order"))
    # A key repeats only where the table repeats it; the bound holds for the rows that are collected too.
    got = own.orderBy("_order", "v").limit(labelled).collect()
    x, z = content([r["rates"] for r in got], [bytes(r["v"]) for r in got]), page([r["slots"] for r in got])
    pool = rows.join(F.broadcast(chosen.select("_k")), F.col("_id") == F.col("_k"), "left_anti")
    return train(x, z, np.array([r["y"] for r in got], int), np.array([r["c"] for r in got], bool), pool_of(pool))


def score(rows: DataFrame, model: Model | float) -> DataFrame:
    """(row, p_text, p_meta, score, kept) of a table of features() or prepared(): score is the probability of good quality, kept it is at least 0.5."""
    if not isinstance(model, Model):
        same = F.lit(float(model))
        return rows.select("row", same.alias("p_text"), same.alias("p_meta"), same.alias("score"), (same >= 0.5).alias("kept"))

    @F.pandas_udf("p_text double, p_meta double, score double")
    def judged(rates: pd.Series, slots: pd.Series, v: pd.Series) -> pd.DataFrame:
        both = np.stack([model.text(content(list(rates), list(v))), model.meta(page(list(slots)))], 1).astype(float)
        return pd.DataFrame({"p_text": probability(both[:, 0]), "p_meta": probability(both[:, 1]), "score": probability(logits(np.clip(both, -12, 12), model.vote))})

    out = rows.select("row", judged("rates", "slots", "v").alias("j"))
    return out.select("row", "j.p_text", "j.p_meta", "j.score", (F.col("j.score") >= 0.5).alias("kept"))
