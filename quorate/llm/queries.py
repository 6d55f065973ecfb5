"""The operators as queries over the driver's tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorate.llm import bagminhash, boilerplate, bpe, cotrain, licences, media, packing, rulelist, sharding, toxicity
from quorate.llm.common import bounded_batches, documents, durable, held_out, labels


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    network = toxicity.fit(docs, labels(spark, sf_dir))
    scored = toxicity.score_documents(docs, network)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_documents(documents(spark, sf_dir))


def op3_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = cotrain.prepared(docs)
    return cotrain.score(rows, cotrain.fit(rows, docs, labels(spark, sf_dir))).select("row.doc_id", "p_text", "p_meta", "score", "kept")


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return boilerplate.extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rules = rulelist.learn(rulelist.labelled_statistics(docs, labels(spark, sf_dir)))
    judged = rulelist.judge(docs.select("doc_id", "text"), rules)
    return judged.select("row.doc_id", "s.n_words", "s.word_chars", "s.n_symbols", "s.n_dup_lines", "s.n_repeat_words", "base_failed", "kept", "rule")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.classes_of(documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op9_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(documents(spark, sf_dir))


# Columns that SQL can express, each through its operator.


def licences_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_licences(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def quality_rules_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_quality_rules(spark, sf_dir).drop("kept", "rule")


def sharding_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_sharding(spark, sf_dir).select("doc_id", "size", "law", "grown_shard")


def sharding_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and bytes of all shards; whether each shard's slots have no gap and each text is in one shard."""
    rows = durable(op8_sharding(spark, sf_dir), "sharded")
    shards = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.countDistinct("slot").alias("slots"), F.min("slot").alias("lo"), F.max("slot").alias("hi"))
    gapless = (F.col("lo") == 0) & (F.col("hi") + 1 == F.col("n")) & (F.col("slots") == F.col("n"))
    found = shards.agg(F.sum("n").alias("n_rows"), F.sum("bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_shards"), F.min(gapless).alias("gapless"))
    texts = documents(spark, sf_dir).select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"))
    split = rows.select("doc_id", "shard").join(texts, "doc_id").groupBy("t").agg(F.countDistinct("shard").alias("k")).where("k > 1")
    return found.withColumn("whole", split.agg(F.count(F.lit(1)) == 0).scalar())


LICENCES_BASE = r"""with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
    p as (select doc_id, len(w) as n_words, [i - 1 for i in range(1, len(w) + 1) if w[i:i + 3] = ['under', 'the', 'mit', 'license']] as a,
      [i - 1 for i in range(1, len(w) + 1) if w[i:i + 3] = ['apache', 'license', 'version', '2']] as b, [i - 1 for i in range(1, len(w) + 1) if w[i:i + 2] = ['cc', 'by', 'nc']] as c from d)
    select doc_id, cast(n_words as bigint) as n_words, cast(len(a) + len(b) + len(c) as bigint) as n_base, cast(list_min(a || b || c) as bigint) as first_word, cast(list_max(a || b || c) as bigint) as last_word,
      concat_ws(',', case when len(b) > 0 then 'apache-2' end, case when len(c) > 0 then 'cc-by-nc' end, case when len(a) > 0 then 'mit' end) as base_labels from p"""

QUALITY_RULES_BASE = r"""with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
    g as (select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as gram from (select r, w, unnest(range(1, len(w) - 1)) as i from d)),
    c as (select r, i, count(*) over (partition by r, gram) as n from g),
    m as (select r, count(distinct place) as n_repeat_words from (select r, unnest([i, i + 1, i + 2]) as place from c where n > 1) group by r),
    s as (select r, doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum([length(x) for x in w]), 0) as bigint) as word_chars,
      cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols, [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as l from d),
    f as (select doc_id, n_words, word_chars, n_symbols, cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words from s left join m using (r))
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from f"""

SHARDING_SIZES = "select doc_id, cast(octet_length(encode(coalesce(text, ''))) + 8 as bigint) as size, 'bytes' as law, cast(null as integer) as grown_shard from documents"
SHARDING_SLOTS = "select count(*) as n_rows, cast(sum(octet_length(encode(coalesce(text, ''))) + 8) as bigint) as n_bytes, 24::bigint as n_shards, true as gapless, true as whole from documents"


def queries() -> dict:
    operators = (op1_toxicity, op2_licences, op3_cotraining, op4_main_text, op5_quality_rules, op6_packing, op7_near_duplicates, op8_sharding, op9_byte_pairs, op10_media)
    return {f.__name__: f for f in (*operators, licences_base, quality_rules_base, sharding_sizes, sharding_slots)}


def oracle_sql() -> dict[str, str]:
    return {"licences_base": LICENCES_BASE, "quality_rules_base": QUALITY_RULES_BASE, "sharding_sizes": SHARDING_SIZES, "sharding_slots": SHARDING_SLOTS}
