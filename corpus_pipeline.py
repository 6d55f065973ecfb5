"""A corpus pipeline: quality rules, quality classifier, near-duplicates, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, all but the last
with the columns of documents, also columns whose names the operators use. run() writes what each stage returns and reads
it again for the next one; a stage's intermediates and its input are deleted once its output is written.

The trained stages learn from the labels and the documents as they are in `sf_dir`, so a stage's model doesn't depend on
what the stages before it left. Null, empty, repeated and very long documents are treated as the operators' docstrings say; an
empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quorate.llm import bagminhash, cotrain, packing, rulelist
from quorate.llm.common import delete, documents, durable, labels, scratch

#: The trained stages and the packing plan can't be said in SQL; tests compare them with brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    rules = rulelist.learn(rulelist.labelled_statistics(documents(spark, sf_dir), labels(spark, sf_dir)))
    return rulelist.judge(docs, rules).where("kept").select("row.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps. The rules have taken most bad rows, so labelled rows are those of all documents."""
    rows = cotrain.prepared(docs, whole=True)
    model = cotrain.fit(rows, documents(spark, sf_dir), labels(spark, sf_dir))
    return cotrain.score(rows, model).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that of the least id, then of the least hash of the text."""
    return bagminhash.deduplicated(docs).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, packed into sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near-duplicates", near_duplicates),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), []
    for i, (_, stage) in enumerate(STAGES):
        with scratch(spark) as made:
            docs = durable(stage(spark, docs, sf_dir), f"stage{i}")
            output = [made.pop()]  # written last
        delete(spark, before)
        before = output
    return docs
