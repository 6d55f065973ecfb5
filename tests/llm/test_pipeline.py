import re
import unicodedata
from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quorate.llm import common, cotrain, packing, rulelist

from .test_text_operators import brute_classes, brute_vector

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of the tables with null, empty, repeated and copied rows, and a column that operators use as well; their labels."""
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 420")
    good = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 and toxic = 0 and doc_id < 420").join(docs.where("n_chars > 600"), "doc_id", "left_semi").orderBy("doc_id").limit(8)
    chosen = docs.join(good.select("doc_id"), "doc_id", "left_semi")
    copies = chosen.withColumn("doc_id", F.col("doc_id") + 10_000).withColumn("text", F.concat("text", F.lit(" end")))
    nameless = chosen.limit(2).withColumn("doc_id", F.lit(None).cast("bigint"))
    odd = spark.createDataFrame([(20_000, None), (20_001, ""), (2**53 + 1, "few words here"), (2**53 + 3, "\n\n")], "doc_id bigint, text string")
    whole = docs.unionByName(chosen).unionByName(copies).unionByName(nameless).unionByName(odd, allowMissingColumns=True)
    whole = whole.withColumns({"kept": F.lit("mine"), "score": F.lit("mine"), "row": F.lit(1)})
    whole.coalesce(2).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").where("doc_id < 420").write.parquet(f"{path}/labels.parquet")
    return path


def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    often = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    s = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len({i + k for i in range(len(words) - 2) if often[tuple(words[i : i + 3])] > 1 for k in range(3)}), "n_distinct": len(set(words)),
        "n_upper": sum(unicodedata.category(c) == "Lu" for c in text), "n_exclaim": len(re.findall("[!?]", text)), "n_digits": len(re.findall("[0-9]", text)), "n_lines": text.count("\n") + 1,
    }
    return s | {name: s[a] / max(1, s[b]) for name, (a, b) in rulelist.RATES.items()}


def key(row):
    return (row.doc_id is None, row.doc_id or 0, row.text or "")


def test_stages_by_brute_force(spark, folder):
    docs, labels = common.documents(spark, folder), common.labels(spark, folder)
    names = docs.columns
    rows = docs.collect()

    kept = corpus_pipeline.quality_rules(spark, docs, folder)
    rules = rulelist.learn(rulelist.labelled_statistics(docs, labels))
    statistics = [brute_statistics(r.text) for r in rows]
    want = [r for r, s in zip(rows, statistics) if s["n_words"] >= 50 and 100 * s["n_repeat_words"] <= 50 * s["n_words"] and not any(all(c.holds(s) for c in rule) for rule in rules)]
    kept = kept.cache()
    assert kept.columns == names and Counter(kept.collect()) == Counter(want) and rules and len(want) < len(rows)

    model = cotrain.fit(cotrain.prepared(kept, whole=True), docs, labels)
    assert isinstance(model, cotrain.Model)
    rates = []
    for r in want:
        s = brute_statistics(r.text)
        rates.append([y for n in rulelist.RATES for x in [min(s[n], cotrain.TOP.get(n, 1.0)) / cotrain.TOP.get(n, 1.0)] for y in (x, x**0.5)])
    slots = {key(r.row): r.slots for r in cotrain.features(kept).select("row", "slots").collect()}
    x = cotrain.content(rates, [np.array(brute_vector(r.text), np.uint8).tobytes() for r in want])
    both = np.clip(np.stack([model.text(x), model.meta(cotrain.page([slots[key(r)] for r in want]))], 1), -12, 12)
    good = cotrain.logits(both, model.vote)
    sure = np.abs(good) > 1e-3
    passed = corpus_pipeline.quality_classifier(spark, kept, folder).cache()
    got = Counter(passed.collect())
    assert passed.columns == names and all(got[r] == (Counter(want)[r] if g >= 0 else 0) for r, g, s in zip(want, good, sure) if s)

    left = sorted(got.elements(), key=key)
    classes = brute_classes([r.text for r in left])
    unique = corpus_pipeline.near_duplicates(spark, passed, folder).cache()
    one = unique.collect()
    place = {key(r): c for r, c in zip(left, classes)}
    assert unique.columns == names and sorted(place[key(r)] for r in one) == sorted(set(classes))
    assert all(key(r)[:2] == min(key(x)[:2] for x, c in zip(left, classes) if c == place[key(r)]) for r in one)
    assert len(one) <= len(left) - 16 and all(r.kept == r.score == "mine" and r.row == 1 for r in one)

    pieces = corpus_pipeline.best_fit_packing(spark, unique, folder).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    sizes = Counter(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in one)
    ends = Counter(p.start + p.length for p in pieces if p.piece == max(q.piece for q in pieces if q.doc_id == p.doc_id))
    assert {r.doc_id for r in one} == {p.doc_id for p in pieces} and sum(k * n for k, n in sizes.items()) == sum(p.length for p in pieces) and not ends - sizes
    held = defaultdict(list)
    for p in pieces:
        held[p.sequence_id].append((p.offset, p.length))
    for own in held.values():
        assert [o for o, _ in sorted(own)] == np.cumsum([0] + [n for _, n in sorted(own)])[:-1].tolist() and sum(n for _, n in own) <= packing.CAPACITY

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = corpus_pipeline.run(spark, folder)
    assert Counter(tuple(r) for r in whole.select(*columns).collect()) == Counter(tuple(getattr(p, c) for c in columns) for p in pieces)


def test_classifier_stage_rejects_bad_rows_of_its_own(spark):
    """Given what the rules would have taken, the stage takes it as well and leaves good rows alone."""
    docs, labels = common.documents(spark, SF), common.labels(spark, SF)
    known = docs.join(labels, "doc_id", "left_semi")
    kept = corpus_pipeline.quality_classifier(spark, known, SF).join(labels, "doc_id").groupBy("quality").count().collect()
    left = {r.quality: r["count"] for r in kept}
    before = {r.quality: r["count"] for r in labels.groupBy("quality").count().collect()}
    assert left.get(0, 0) <= 0.1 * before[0] and left[1] >= 0.98 * before[1]


def test_empty_table(spark, folder, tmp_path):
    docs, labels = common.documents(spark, folder), common.labels(spark, folder)
    docs.where("1 = 0").write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_intermediates_are_deleted(spark, tmp_path):
    rows = spark.range(5)
    with common.scratch(spark) as made:
        a = common.durable(rows, "a")
        b = common.durable(a, "b")
        made.pop()
    assert b.count() == 5
    with pytest.raises(Exception, match="(?i)not.*exist"):
        a.collect()


def test_row_groups_of_intermediates_are_bounded(spark):
    """A task that writes much holds no more than a small row group, whatever Parquet's own size of them is."""
    rows = spark.range(0, 800_000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    with common.scratch(spark) as made:
        assert common.durable(rows, "rows").agg(F.count_distinct("text")).first()[0] == 800_000
        parts = [pq.ParquetFile(f).metadata for f in Path(made[0].removeprefix("file://")).glob("part-*")]
    sizes = [p.row_group(i).total_byte_size for p in parts for i in range(p.num_row_groups)]
    assert sum(sizes) > 3 * common.ROW_GROUP_BYTES and max(sizes) < 2 * common.ROW_GROUP_BYTES


def test_row_groups_of_a_callers_output_are_bounded(spark, folder, tmp_path):
    """A stage's output is written by its caller and read by the next stage, so its row groups are small as well, unless the session sets them."""
    name = "parquet.block.size"
    before = spark.conf.get(name, None)
    rows = spark.range(0, 800_000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    try:
        for own, want in ((None, str(common.ROW_GROUP_BYTES)), ("77777777", "77777777")):
            spark.conf.unset(name) if own is None else spark.conf.set(name, own)
            common.documents(spark, folder)
            assert spark.conf.get(name, None) == want
            rows.write.parquet(f"{tmp_path}/{want}")
        part = pq.ParquetFile(next(Path(f"{tmp_path}/{common.ROW_GROUP_BYTES}").glob("part-*"))).metadata
        sizes = [part.row_group(i).total_byte_size for i in range(part.num_row_groups)]
        assert sum(sizes) > 3 * common.ROW_GROUP_BYTES and max(sizes) < 2 * common.ROW_GROUP_BYTES
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_whole_texts_are_read_in_bounded_batches(spark, folder):
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    try:
        for own, want in (("4096", str(common.READ_ROWS)), ("777", "777")):
            spark.conf.set(name, own)
            common.documents(spark, folder)
            assert spark.conf.get(name) == want
        assert common.READ_ROWS <= 512
    finally:
        spark.conf.set(name, before)
