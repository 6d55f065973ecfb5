"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input is its own embedding (hashed) plus the mean of the embeddings of its character n-grams (hashed,
with marks for the word's ends), so that unseen forms share what their parts have shown. A run of more than PIECE
letters is given as overlapping pieces, each a word of its own. Texts are cut into
overlapping windows of WINDOW words, STEP apart, that cover the whole text. Both directions of the network run
over a window, attention weighs its states, a linear layer gives its logit. A document's score is the calibrated
largest logit of all its windows.

The network is fitted on the driver from at most LABELLED_ROWS labelled rows (a documented bound; the least hashes
of the id) outside the held-out fifth. These are cut into windows where they lie; the driver gets at most ROW_WINDOWS of
a row and LABELLED_WINDOWS in all (documented bounds as well), so its memory doesn't depend on the texts' lengths. Toxic
documents have toxic and harmless windows, so after a first phase
training takes the windows that the network itself finds most toxic in them (multiple-instance learning), and
the harmless windows that it finds hardest. Inputs are texts only; labels, language, source and id are not.

Defined results: null and empty texts, and texts without a word, score 0. Repeated rows are scored each. Without
labels of both classes every score is 0. An empty table gives no rows; texts of any length are scored whole; other
columns than key and text are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterable
from itertools import count, islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import arrow_rows, held_out

LABELLED_ROWS = 3_000
ROW_WINDOWS, LABELLED_WINDOWS = 256, 60_000
WINDOW, STEP = 64, 32
WORD_SLOTS, GRAM_SLOTS, WIDTH, HIDDEN, ATTENTION = 4096, 16384, 16, 8, 8
GRAMS = (3, 4, 5, 6)
#: Longer runs of letters count as several words: pieces of so many letters, so many apart, that cover the whole run.
PIECE, PIECE_STEP = 64, 32
BATCH, STEPS, WARM_STEPS, RESCORE = 96, 400, 120, 70
RATE = 0.01
#: Words whose input is remembered by a worker; a full memory is emptied.
KNOWN_WORDS = 200_000
#: New words whose input is computed at once.
NEW_WORDS_AT_ONCE = 10_000
#: Words that are scored at once, so memory is bounded for any text.
WORDS_AT_ONCE = 300_000

WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """The text's words; runs of more than PIECE letters, as in scripts without blanks, as overlapping pieces."""
    words = WORD.findall((text or "").lower())
    if max(map(len, words), default=0) <= PIECE:
        return words
    return [w[i : i + PIECE] for w in words for i in range(0, max(len(w) - PIECE, 0) + PIECE_STEP, PIECE_STEP)[: None if len(w) > PIECE else 1]]


def window_starts(n: int) -> list[int]:
    """Starts of the windows over n words: every STEP words until the end is covered."""
    return list(range(0, max(n - WINDOW, 0) + STEP, STEP)) if n > WINDOW else [0] if n else []


def windows_of(text: str | None, most: int = ROW_WINDOWS) -> list[tuple[int, str]]:
    """(number, words) of a text's windows; of more than `most` those with the least hashes."""
    words = words_of(text)
    found = [(i, " ".join(words[s : s + WINDOW])) for i, s in enumerate(window_starts(len(words)))]
    if len(found) > most:
        found = sorted(sorted(found, key=lambda w: (zlib.crc32(w[1].encode("utf-8", "surrogatepass")), w[0]))[:most])
    return found


def grams_of(word: str) -> list[int]:
    marked = f"^{word}$".encode("utf-32-le", "surrogatepass")  # four bytes a character
    n = len(marked) // 4
    return [zlib.crc32(marked[4 * i : 4 * (i + k)]) % GRAM_SLOTS for k in GRAMS for i in range(n - k + 1)] or [zlib.crc32(marked) % GRAM_SLOTS]


def crc_shares(bits: range) -> np.ndarray:
    """(characters that follow in the gram, value of these bits of a code point) -> what they change in the crc32 of a gram of zeros."""
    out = np.zeros((max(GRAMS), 1 << len(bits)), np.uint32)
    for after in range(len(out)):
        zeros = zlib.crc32(bytes(4 * (after + 1)))
        for i, bit in enumerate(bits):  # crc32 is linear in the bits of texts of equal length
            out[after, 1 << i : 2 << i] = out[after, : 1 << i] ^ np.uint32(zlib.crc32((1 << bit).to_bytes(4, "little") + bytes(4 * after)) ^ zeros)
    return out


LOW_SHARES, HIGH_SHARES = crc_shares(range(16)), crc_shares(range(16, 21))


def grams_of_all(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """grams_of() of each word, one word after the other, and how many each has; many words at once."""
    points = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    counts = [np.maximum(lengths - k + 1, 0) for k in GRAMS]
    sizes = np.maximum(sum(counts), 1)
    low, high = points & 0xFFFF, points >> 16
    shares = [x[low] for x in LOW_SHARES]
    if high.any():
        shares = [s ^ x[high] for s, x in zip(shares, HIGH_SHARES, strict=True)]
    ends = np.cumsum(lengths)
    left = np.repeat(ends, lengths) - np.arange(len(points))  # characters to the word's end
    out = np.full(sizes.sum(), grams_of("")[0], np.int64)
    to = np.cumsum(sizes) - sizes - (ends - lengths)  # from a character's place to its gram's
    for k, n in zip(GRAMS, counts, strict=True):
        at = np.flatnonzero(left >= k)
        crc = np.full(max(len(points) - k + 1, 0), zlib.crc32(bytes(4 * k)), np.uint32)
        for i in range(k):
            crc ^= shares[k - 1 - i][i : i + len(crc)]
        out[np.repeat(to, n) + at] = crc[at] % GRAM_SLOTS
        to = to + n
    return out, sizes


def slot_of(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_SLOTS


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


Parameters = dict[str, np.ndarray]


def fresh(seed: int = 7) -> Parameters:
    r = np.random.default_rng(seed)
    make = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
    h, d = HIDDEN, WIDTH
    p = {"words": make(WORD_SLOTS, d, scale=0.1), "grams": make(GRAM_SLOTS, d, scale=0.3)}
    for side in "fb":
        p |= {f"in_{side}": make(d, 3 * h, scale=d**-0.5), f"re_{side}": make(h, 3 * h, scale=h**-0.5), f"bias_{side}": np.zeros(3 * h, np.float32)}
    p |= {"att": make(2 * h, ATTENTION, scale=(2 * h) ** -0.5), "att_bias": np.zeros(ATTENTION, np.float32), "query": make(ATTENTION, scale=1.0), "out": make(2 * h, scale=0.3), "out_bias": np.zeros(1, np.float32)}
    return p


# --- forward and backward over a batch of windows -----------------------------------------------------------


def recurrent(g: np.ndarray, re_: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """g: (time, batch, 3 hidden) projected inputs; mask: (time, batch, 1), 0 where there is no word. The states, and what backward needs."""
    h = HIDDEN
    state = np.zeros((g.shape[1], h), np.float32)
    states = np.empty((*g.shape[:2], h), np.float32)
    kept = []
    for t in range(len(g)):
        u = state @ re_
        zr = sigmoid(g[t, :, : 2 * h] + u[:, : 2 * h])
        z, r = zr[:, :h], zr[:, h:]
        n = np.tanh(g[t, :, 2 * h :] + r * u[:, 2 * h :])
        step = (1 - z) * (n - state) * mask[t]
        if keep:
            kept.append((state, z, r, n, u[:, 2 * h :]))
        state = state + step
        states[t] = state
    return states, kept


def recurrent_back(d_states: np.ndarray, re_: np.ndarray, mask: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of the recurrent weights."""
    h = HIDDEN
    d_g = np.empty((*d_states.shape[:2], 3 * h), np.float32)
    d_re = np.zeros_like(re_)
    d_state = np.zeros(d_states.shape[1:], np.float32)
    for t in range(len(d_states) - 1, -1, -1):
        state, z, r, n, un = kept[t]
        d = d_state + d_states[t]
        dm = d * mask[t]
        dn = dm * (1 - z) * (1 - n * n)
        dz = -dm * (n - state) * z * (1 - z)
        dr = dn * un * r * (1 - r)
        d_u = np.concatenate([dz, dr, dn * r], 1)
        d_g[t] = np.concatenate([dz, dr, dn], 1)
        d_re += state.T @ d_u
        d_state = d - dm * (1 - z) + d_u @ re_.T
    return d_g, d_re


def pooled(states: np.ndarray, mask: np.ndarray, p: Parameters) -> tuple:
    """(batch, time, 2 hidden) -> logits, and what backward needs."""
    a = np.tanh(states @ p["att"] + p["att_bias"])
    s = a @ p["query"] + (mask - 1) * 1e4
    e = np.exp(s - s.max(1, keepdims=True))
    weights = e / e.sum(1, keepdims=True)
    context = np.einsum("bt,bth->bh", weights, states)
    return context @ p["out"] + p["out_bias"][0], (a, weights, context)


class Vocabulary:
    """The training sample's distinct words with their slots."""

    def __init__(self, texts: Iterable[list[str]]):
        self.number: dict[str, int] = {}
        for ws in texts:
            for w in ws:
                self.number.setdefault(w, len(self.number))
        names = list(self.number)
        flat, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for i in range(0, len(names), NEW_WORDS_AT_ONCE):
            grams, n = grams_of_all(names[i : i + NEW_WORDS_AT_ONCE])
            flat.append(grams.astype(np.int32))  # compact: the driver's memory is small
            sizes.append(n)
        self.slots = np.fromiter(map(slot_of, names), np.int32, len(names))
        self.sizes = np.concatenate(sizes)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.grams = np.concatenate(flat)


def gradients(p: Parameters, vocabulary: Vocabulary, ids: np.ndarray, y: np.ndarray) -> Parameters:
    """Gradients of the mean log loss over windows `ids` (batch, time; -1: no word)."""
    mask = (ids >= 0).astype(np.float32)
    used, where = np.unique(np.maximum(ids, 0), return_inverse=True)
    where = where.reshape(ids.shape)
    sizes = vocabulary.sizes[used]
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    spots = np.repeat(vocabulary.starts[used] - first, sizes) + np.arange(sizes.sum())
    grams = vocabulary.grams[spots]
    slots = vocabulary.slots[used]
    vectors = p["words"][slots] + np.add.reduceat(p["grams"][grams], first, axis=0) / sizes[:, None].astype(np.float32)
    time_mask = mask.T[:, :, None]
    states, kept, projected = {}, {}, {}
    for side in "fb":
        g = (vectors @ p[f"in_{side}"] + p[f"bias_{side}"])[where.T]
        g, m = (g, time_mask) if side == "f" else (g[::-1], time_mask[::-1])
        out, kept[side] = recurrent(g, p[f"re_{side}"], m, True)
        states[side] = out if side == "f" else out[::-1]
    both = np.concatenate([states["f"], states["b"]], 2).transpose(1, 0, 2)
    logits, (a, weights, context) = pooled(both, mask, p)
    d = ((sigmoid(logits) - y) / len(y)).astype(np.float32)
    grad: Parameters = {"out": context.T @ d, "out_bias": np.array([d.sum()], np.float32)}
    d_context = d[:, None] * p["out"]
    d_both = weights[:, :, None] * d_context[:, None, :]
    d_weights = np.einsum("bth,bh->bt", both, d_context)
    d_s = weights * (d_weights - (weights * d_weights).sum(1, keepdims=True))
    grad["query"] = np.einsum("bta,bt->a", a, d_s)
    d_a = d_s[:, :, None] * p["query"] * (1 - a * a)
    grad["att"] = np.einsum("bth,bta->ha", both, d_a)
    grad["att_bias"] = d_a.sum((0, 1))
    d_both = (d_both + d_a @ p["att"].T).transpose(1, 0, 2).astype(np.float32)
    d_vectors = np.zeros_like(vectors)
    for side, part in (("f", d_both[:, :, :HIDDEN]), ("b", d_both[::-1, :, HIDDEN:])):
        m = time_mask if side == "f" else time_mask[::-1]
        d_g, grad[f"re_{side}"] = recurrent_back(part, p[f"re_{side}"], m, kept[side])
        d_g = d_g if side == "f" else d_g[::-1]
        summed = np.zeros((len(used), 3 * HIDDEN), np.float32)
        np.add.at(summed, where.T.ravel(), d_g.reshape(-1, 3 * HIDDEN))
        grad[f"in_{side}"] = vectors.T @ summed
        grad[f"bias_{side}"] = summed.sum(0)
        d_vectors += summed @ p[f"in_{side}"].T
    grad["words"] = np.zeros_like(p["words"])
    np.add.at(grad["words"], slots, d_vectors)
    grad["grams"] = np.zeros_like(p["grams"])
    np.add.at(grad["grams"], grams, np.repeat(d_vectors / sizes[:, None].astype(np.float32), sizes, axis=0))
    return grad


# --- scoring -------------------------------------------------------------------------------------------------


class Network:
    """A fitted network that scores texts; remembers the projected inputs of the words it has met."""

    def __init__(self, p: Parameters, calibration: tuple[float, float] = (1.0, 0.0)):
        self.p, self.calibration = p, calibration
        self.project = np.concatenate([p["in_f"], p["in_b"]], 1)
        self.bias = np.concatenate([p["bias_f"], p["bias_b"]])
        self.forget()

    def __reduce__(self):
        return Network, (self.p, self.calibration)

    def forget(self) -> None:
        self.rows: defaultdict[str, int] = defaultdict(count(1).__next__)  # numbers a new word when it is asked for
        self.table = np.zeros((1024, 6 * HIDDEN), np.float32)  # row 0: no word

    def ids(self, words: list[str]) -> np.ndarray:
        rows, known = self.rows, len(self.rows)
        out = np.fromiter(map(rows.__getitem__, words), np.int64, len(words))
        if len(rows) > KNOWN_WORDS and known and len(rows) > known:
            self.forget()
            return self.ids(words)
        new = list(islice(reversed(rows), len(rows) - known))[::-1]
        while len(rows) >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for i in range(0, len(new), NEW_WORDS_AT_ONCE):
            some = new[i : i + NEW_WORDS_AT_ONCE]
            grams, sizes = grams_of_all(some)
            sums = np.add.reduceat(self.p["grams"].take(grams, axis=0), np.cumsum(sizes) - sizes, axis=0)
            vectors = self.p["words"][[slot_of(w) for w in some]] + sums / sizes[:, None].astype(np.float32)
            self.table[known + 1 + i : known + 1 + i + len(some)] = vectors @ self.project + self.bias
        return out

    def window_logits(self, ids: np.ndarray, batch: int = 1024) -> np.ndarray:
        """Logits of windows (n, time) of rows of the table; 0: no word."""
        out = np.empty(len(ids), np.float32)
        h = HIDDEN
        for i in range(0, len(ids), batch):
            part = ids[i : i + batch]
            mask = (part > 0).astype(np.float32)
            g = self.table[part.T]
            m = mask.T[:, :, None]
            f, _ = recurrent(g[:, :, : 3 * h], self.p["re_f"], m, False)
            b, _ = recurrent(g[::-1, :, 3 * h :], self.p["re_b"], m[::-1], False)
            both = np.concatenate([f, b[::-1]], 2).transpose(1, 0, 2)
            out[i : i + batch] = pooled(both, mask, self.p)[0]
        return out

    def document_logits(self, texts: list[list[str]]) -> np.ndarray:
        """The largest window logit of each list of words; -inf without words."""
        best = np.full(len(texts), -np.inf, np.float32)
        group: list[tuple[int, list[str]]] = []
        held = 0

        def flush() -> None:
            words = [w for _, ws in group for w in ws]
            ids = self.ids(words)
            padded = np.concatenate([ids, np.zeros(WINDOW, np.int64)])
            starts, limits, owners, at = [], [], [], 0
            for owner, ws in group:
                own = window_starts(len(ws))
                starts += [at + s for s in own]
                limits += [at + len(ws)] * len(own)
                owners += [owner] * len(own)
                at += len(ws)
            spots = np.array(starts)[:, None] + np.arange(WINDOW)
            windows = np.where(spots < np.array(limits)[:, None], padded[np.minimum(spots, len(padded) - 1)], 0)
            order = np.argsort((windows > 0).sum(1), kind="stable")
            logits = np.empty(len(windows), np.float32)
            logits[order] = self.window_logits(windows[order])
            np.maximum.at(best, owners, logits)

        for i, ws in enumerate(texts):
            for s in range(0, len(ws), WORDS_AT_ONCE - STEP):  # a longer text in parts that share a window's overlap
                part = ws[s : s + WORDS_AT_ONCE]
                group.append((i, part))
                held += len(part)
                if held >= WORDS_AT_ONCE:
                    flush()
                    group, held = [], 0
        if group:
            flush()
        return best

    def scores(self, texts: list[str | None]) -> np.ndarray:
        logits = self.document_logits([words_of(t) for t in texts]).astype(np.float64)
        a, b = self.calibration
        return np.where(np.isneginf(logits), 0.0, sigmoid(a * np.clip(logits, -12, 12) + b))


def calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and constant of a logistic curve over logits, by damped Newton steps with a prior around (1, 0)."""
    w = np.array([1.0, 0.0])
    x = np.stack([np.clip(x, -12, 12), np.ones(len(x))], 1)
    prior = np.array([2.0, 0.2])

    def loss(w: np.ndarray) -> float:
        m = x @ w
        return float((np.logaddexp(0, m) - y * m).sum() + (prior * (w - [1, 0]) ** 2).sum() / 2)

    for _ in range(100):
        q = sigmoid(x @ w)
        step = np.linalg.solve((x * (q * (1 - q) + 1e-9)[:, None]).T @ x + np.diag(prior), x.T @ (q - y) + prior * (w - [1, 0]))
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return max(float(w[0]), 0.05), float(w[1])


def train(rows: list[tuple[object, str, int]], steps: int = STEPS, seed: int = 7) -> Network | None:
    """The network from windows: (document, words, label), a document's windows one after the other."""
    vocabulary = Vocabulary(words.split(" ") for _, words, _ in rows)
    every = np.full((len(rows), WINDOW), -1, np.int32)
    owners, marks = np.zeros(len(rows), np.int64), []
    before = None
    for i, (doc, words, y) in enumerate(rows):
        own = [vocabulary.number[w] for w in words.split(" ")]
        every[i, : len(own)] = own
        if doc != before:
            before = doc
            marks.append(int(y))
        owners[i] = len(marks) - 1
    del rows  # the words are numbers by now
    label = np.array(marks)
    if len(set(marks)) < 2:
        return None
    check = owners % 5 == 0
    windows, owner = every[~check], owners[~check]
    n_docs = len(marks)
    label = label[owner]
    bad, good = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(bad) or not len(good):
        return None
    r = np.random.default_rng(seed)
    p = fresh(seed)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    pick_bad, hard = bad, good
    for step in range(1, steps + 1):
        if step > WARM_STEPS and step % RESCORE == 1:
            net = Network(p)
            names = list(vocabulary.number)
            number = np.concatenate([net.ids(names), [0]])  # the -1 of a window without a word takes the last
            logits = net.window_logits(number[windows[bad]])
            most = np.full(n_docs, -np.inf)
            np.maximum.at(most, owner[bad], logits)
            pick_bad = bad[logits >= np.minimum(most[owner[bad]], 1.0)]
            some = r.choice(good, min(len(good), 6_000), replace=False)
            hard = some[np.argsort(-net.window_logits(number[windows[some]]))[: max(64, len(some) // 20)]]
        half = BATCH // 2
        chosen = np.concatenate([r.choice(pick_bad, half), r.choice(good, half - half // 3), r.choice(hard, half // 3)])
        grad = gradients(p, vocabulary, windows[chosen], label[chosen].astype(np.float32))
        norm = max(1.0, float(np.sqrt(sum((v * v).sum() for v in grad.values()))))
        rate = RATE * min(1.0, 1.5 * (1 - step / (steps + 1)))
        for k, v in p.items():
            g = grad[k] / norm
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            v -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
    net = Network(p)
    number = np.concatenate([net.ids(list(vocabulary.number)), [0]])
    most = np.full(n_docs, -np.inf)
    np.maximum.at(most, owners[check], net.window_logits(number[every[check]]))
    apart = np.isfinite(most)
    y = np.array(marks, float)[apart]
    net.calibration = calibrated(most[apart], y) if 0 < y.sum() < len(y) else (1.0, 0.0)
    net.forget()
    return net


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", most: int = LABELLED_ROWS) -> Network | None:
    """The network, from at most `most` labelled rows outside the held-out fifth."""
    chosen = (
        labels.where(F.col("toxic").isNotNull() & ~held_out(F.col(key)))
        .select(F.col(key).alias("_k"), F.col("toxic").alias("_y"))
        .orderBy(F.xxhash64("_k"), "_k", "_y").limit(most).dropDuplicates(["_k"])
    )
    rows = docs.select(F.col(key).alias("_d"), F.col(text).alias("_t")).join(F.broadcast(chosen), F.col("_d") == F.col("_k"))
    rows = rows.select(F.xxhash64("_d").alias("_o"), F.struct("_d", F.xxhash64("_t").alias("t")).alias("_doc"), "_y", "_t")

    def cut(texts: list) -> list[list]:
        found = [(*w, row) for row, t in enumerate(texts) for w in windows_of(t)]
        return [list(x) for x in zip(*found)] or [[], [], []]

    windows = arrow_rows(rows, ["_o", "_doc", "_y"], "_t", cut, "number bigint, words string", many=True)
    got = windows.orderBy("_o", "_doc", "number").limit(LABELLED_WINDOWS).select("_doc", "words", "_y").collect()
    return train([(r["_doc"], r["words"], r["_y"]) for r in got])


def score_documents(docs: DataFrame, network: Network | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, score) of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(network)  # of fixed size

    def score(texts: list) -> list[list]:
        net = sent.value
        return [net.scores(texts).tolist() if net else [0.0] * len(texts)]

    return arrow_rows(docs, [key], text, score, "score double")
