"""A training-data pipeline over ``documents``: quality rules, classifier, near copies, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept. Labels for the two quality stages
are read from ``sf_dir``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loomlog.checkpoints import fresh_path
from loomlog.llm import classifier, packing, pii, rules, simhash
from loomlog.llm.common import table


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a certified cutoff rejects."""
    return rules.kept_documents(docs, table(spark, sf_dir, "labels"))


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier predicts to be good."""
    return classifier.kept_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group by SimHash (three-word shingles, links at two bits or fewer), the one with the smallest doc_id."""
    return simhash.first_of_each(docs, simhash.components(docs, shingle=3, radius=2))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1,024 tokens."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", keep_by_rules),
    ("quality classifier", keep_by_classifier),
    ("SimHash near-dedup", drop_near_copies),
    ("personal data", mask_personal_data),
    ("best-fit packing", pack),
]

#: SQL cannot express the classifier, the search for near copies or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
