"""Quality rules as a learned decision list, native Spark throughout.

Statistics of every whole text are Spark expressions. A decision list is learned on the driver from the
statistics of at most LABELLED_ROWS labelled rows (a documented bound; the rows with the least hash of the id):
sequential covering grows a conjunction of threshold conditions by information gain on two thirds of them,
prunes it on the other third, keeps it if it is precise there, removes what it covers and goes on. The list is
emitted as ordered CASE WHEN conditions, so that it reads as SQL and scores all rows inside the JVM.

Defined results: a null or empty text has no words and all counts 0, so it fails the base rules. Repeated rows
are judged each. An empty table gives no rows; without labelled rows the list is empty and the base rules decide. Columns
of the input keep their values whatever they are called: judge() returns them inside one struct. A text of any length is
counted exactly.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import held_out

#: Most labelled rows that the list is learned from.
LABELLED_ROWS = 4_000
#: Candidate thresholds of a statistic.
CUTS = 24
MOST_RULES, MOST_CONDITIONS = 24, 4
#: A rule is kept if it is right for so many of the pruning rows that it covers.
PRECISION, LEAST_COVERED = 0.98, 2
MIN_WORDS = 50

WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"


def let(value: Column, body) -> Column:
    """body(value) with the value computed once: it is bound to a lambda variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{WHITE[0]}\t-\r]+"), lambda x: x != "")


def repeated_words(words: Column, hashes: Column) -> Column:
    """How many of the words lie in a three-word window that the text has twice or more; `hashes`: the words' hashes.

    A text whose windows' hashes all differ has none. Else windows are sorted as single longs, so that Spark sorts
    primitives: the hash without its lowest bits, and in these the window's number. Neighbours of equal hash are
    compared by their words. If some of these differ (hashes met by chance), the windows of equal hash are sorted by
    their words themselves. So the count is exact for every text.
    """

    def same_words(i: Column, j: Column) -> Column:
        out = F.get(words, i) == F.get(words, j)
        for k in (1, 2):
            out = out & (F.get(words, i + k) == F.get(words, j + k))
        return out

    def from_grams(grams: Column) -> Column:
        bits = F.ceil(F.log2(F.size(grams) + 1)).cast("int")

        def placed(b: Column) -> Column:
            key = F.transform(grams, lambda h, i: F.call_function("shiftleft", F.call_function("shiftright", h, b), b).bitwiseOR(i.cast("long")))
            return let(F.sort_array(key), lambda s: from_sorted(s, b))

        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(let(bits, placed))

    def marked(rows: Column, equal: Column, place) -> Column:
        """Places of the rows that equal their neighbour; `equal`: of each row with the next."""
        either = F.zip_with(equal, F.concat(F.array(F.lit(False)), equal), lambda x, y: F.coalesce(x, F.lit(False)) | F.coalesce(y, F.lit(False)))
        own = F.filter(F.zip_with(rows, either, lambda r, m: F.when(m, place(r))), lambda p: p.isNotNull())
        return F.sort_array(own)

    def union(p: Column) -> Column:
        steps = F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    def from_sorted(s: Column, bits: Column) -> Column:
        hash_of = lambda x: F.call_function("shiftright", x, bits)
        number = lambda x: x.bitwiseXOR(F.call_function("shiftleft", hash_of(x), bits))
        following = F.slice(s, F.lit(2), F.size(s))
        # 0: other hashes; 1: equal words; 2: equal hashes of other words
        meets = F.zip_with(s, following, lambda a, b: F.when(hash_of(a) != hash_of(b), 0).when(same_words(number(a).cast("int"), number(b).cast("int")), 1).otherwise(2))

        def counted(m: Column) -> Column:
            by_hash = lambda wanted: marked(s, F.transform(m, wanted), number)
            return F.when(F.array_contains(m, 2), by_words(by_hash(lambda x: x > 0))).otherwise(let(by_hash(lambda x: x == 1), union))

        return let(meets, counted)

    def by_words(places: Column) -> Column:
        window = F.transform(places, lambda p: F.struct(*(F.get(words, (p + k).cast("int")).alias(f"w{k}") for k in range(3)), p.alias("p")))
        equal = lambda a, b: (a["w0"] == b["w0"]) & (a["w1"] == b["w1"]) & (a["w2"] == b["w2"])
        return let(F.sort_array(window), lambda s: let(marked(s, F.zip_with(s, F.slice(s, F.lit(2), F.size(s)), equal), lambda r: r["p"]), union))

    def grams_of(h: Column) -> Column:
        pairs = F.zip_with(h, F.slice(h, F.lit(2), F.size(h)), lambda a, b: F.xxhash64(a, b))
        triples = F.zip_with(pairs, F.slice(h, F.lit(3), F.size(h)), lambda p, c: F.xxhash64(p, c))
        return F.slice(triples, F.lit(1), F.greatest(F.size(h) - 2, F.lit(0)))

    return let(let(hashes, grams_of), from_grams)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, s): each row of `docs` as a struct, and a struct of counts of its whole text."""
    t = F.coalesce(F.col(f"row.{text}"), F.lit(""))
    full_lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
    n = F.length(t)
    counts = docs.select(F.struct("*").alias("row")).withColumn("_w", words_of(F.col(f"row.{text}")))
    counts = counts.withColumn("_h", F.transform("_w", lambda x: F.xxhash64(x)))
    # explode of a one-element array: a step that the optimiser doesn't fold into the uses of the counts, each of
    # which would otherwise compute them again.
    return counts.select(
        "row",
        F.explode(F.array(F.struct(
            F.size("_h").cast("long").alias("n_words"),
            F.length(F.translate(t, WHITE, "")).cast("long").alias("word_chars"),
            (n - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(full_lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_words(F.col("_w"), F.col("_h")).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct("_h")).cast("long").alias("n_distinct"),
            F.length(F.regexp_replace(t, "[^\\p{Lu}]+", "")).cast("long").alias("n_upper"),
            (n - F.length(F.translate(t, "!?", ""))).cast("long").alias("n_exclaim"),
            (n - F.length(F.translate(t, "0123456789", ""))).cast("long").alias("n_digits"),
            (n - F.length(F.translate(t, "\n", "")) + 1).cast("long").alias("n_lines"),
        ))).alias("s"),
    )


#: The statistics that conditions may test: name -> (numerator, denominator) of the counts.
RATES = {
    "symbol_rate": ("n_symbols", "word_chars"),
    "repeat_rate": ("n_repeat_words", "n_words"),
    "dup_line_rate": ("n_dup_lines", "n_lines"),
    "distinct_rate": ("n_distinct", "n_words"),
    "upper_rate": ("n_upper", "word_chars"),
    "exclaim_rate": ("n_exclaim", "n_words"),
    "digit_rate": ("n_digits", "word_chars"),
    "mean_word": ("word_chars", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


def rate(name: str, s: str = "s") -> Column:
    above, below = RATES[name]
    return (F.col(f"{s}.{above}") / F.greatest(F.col(f"{s}.{below}"), F.lit(1))).cast("double")


# --- learning -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    cut: float

    def holds(self, row: dict[str, float]) -> bool:
        return row[self.name] >= self.cut if self.above else row[self.name] < self.cut

    def column(self) -> Column:
        value = rate(self.name)
        return value >= F.lit(self.cut) if self.above else value < F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def covered_by(rule: Rule, rows: list[dict]) -> list[dict]:
    return [r for r in rows if all(c.holds(r) for c in rule)]


def candidates(rows: list[dict]) -> list[Condition]:
    out = []
    for name in RATES:
        values = sorted({r[name] for r in rows})
        for i in range(1, CUTS):
            if (at := i * len(values) // CUTS) and at < len(values):
                cut = (values[at - 1] + values[at]) / 2
                out += [Condition(name, True, cut), Condition(name, False, cut)]
    return list(dict.fromkeys(out))


def grow(bad: list[dict], good: list[dict]) -> Rule:
    rule: Rule = ()
    while good and len(rule) < MOST_CONDITIONS:
        base = math.log2(len(bad) / (len(bad) + len(good)))
        best = (0.0, None, bad, good)
        for c in candidates(bad + good):
            p = [r for r in bad if c.holds(r)]
            if not p or len(p) * -base <= best[0]:
                continue
            q = [r for r in good if c.holds(r)]
            gain = len(p) * (math.log2(len(p) / (len(p) + len(q))) - base)
            if gain > best[0] + 1e-9:
                best = (gain, c, p, q)
        if best[1] is None:
            break
        rule, bad, good = (*rule, best[1]), best[2], best[3]
    return rule


def prune(rule: Rule, bad: list[dict], good: list[dict]) -> tuple[Rule, int, int]:
    """The beginning of the rule that is worth most on the pruning rows, and what it covers there."""
    best: tuple[float, Rule, int, int] = (-1.0, (), 0, 0)
    for n in range(len(rule), 0, -1):
        p, q = len(covered_by(rule[:n], bad)), len(covered_by(rule[:n], good))
        if p + q and (worth := (p - q) / (p + q)) > best[0]:
            best = (worth, rule[:n], p, q)
    return best[1:]


def learn(rows: list[dict]) -> list[Rule]:
    """Rules for rejecting, from rows of statistics with `bad` (bool) and `part` (2: pruning row)."""
    side = lambda bad, pruning: [r for r in rows if r["bad"] == bad and (r["part"] == 2) == pruning]
    bad, bad2, good, good2 = side(True, False), side(True, True), side(False, False), side(False, True)
    rules: list[Rule] = []
    for _ in range(MOST_RULES):
        grown = grow(bad, good) if bad else ()
        if not grown:
            break
        rule, p, q = prune(grown, bad2, good2)
        others = lambda rows, rule: [r for r in rows if not all(c.holds(r) for c in rule)]
        if p >= LEAST_COVERED and p >= PRECISION * (p + q):
            rules.append(rule)
            bad, bad2, good, good2 = (others(x, rule) for x in (bad, bad2, good, good2))
        else:  # not precise enough to be a rule: what it was grown for is left alone
            bad = others(bad, grown)
    return rules


def labelled_statistics(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", most: int = LABELLED_ROWS) -> list[dict]:
    """Statistics of at most `most` labelled rows outside the held-out fifth, collected to the driver."""
    chosen = (
        labels.where(F.col("quality").isNotNull() & ~held_out(F.col(key)))
        .select(F.col(key).alias("_k"), "quality")
        .orderBy(F.xxhash64("_k"), "_k").limit(most).dropDuplicates(["_k"])
    )
    rows = with_statistics(docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), F.col("_id") == F.col("_k")), "_text")
    rows = rows.select((F.col("row.quality") == 0).alias("bad"), (F.crc32(F.col("row._id").cast("string").cast("binary")) % 3).alias("part"), F.xxhash64("row._id").alias("_order"), *(rate(n).alias(n) for n in RATES))
    # A key repeats only where the table repeats it; the bound holds for the rows that are collected too.
    return [r.asDict() for r in rows.orderBy("_order", *RATES).limit(most).collect()]


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that fires, from 1; null if none does: ordered conditions of one CASE."""
    out = None
    for i, rule in enumerate(rules, 1):
        condition = rule[0].column()
        for c in rule[1:]:
            condition = condition & c.column()
        out = F.when(condition, F.lit(i)) if out is None else out.when(condition, F.lit(i))
    return F.lit(None).cast("int") if out is None else out


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """(row, s, base_failed, rule, kept): the row of `docs`, its counts, the number of the rule that fired (or null), the verdict."""
    failed = (F.col("s.n_words") < MIN_WORDS) | (100 * F.col("s.n_repeat_words") > 50 * F.col("s.n_words"))
    out = with_statistics(docs, text).select("row", "s", failed.alias("base_failed"), verdict(rules).alias("rule"))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
