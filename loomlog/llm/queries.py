"""The registered corpus queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loomlog.llm.checks import CHAT, QUALITY, SET_JOIN, STRUCTURE, TRIE
from loomlog.llm.common import table

QUERIES: dict = {}
SQL: dict[str, str] = {"op5_quality_rules": QUALITY, "op6_chat": CHAT, "op11_trie": TRIE, "op12_set_join": SET_JOIN, "op13_structure": STRUCTURE}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    from loomlog.llm.bpe import encoded_digests
    return encoded_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    from loomlog.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 1,024 tokens."""
    from loomlog.llm.packing import packed
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and whether the certified cutoffs keep it."""
    from loomlog.llm.rules import judged
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; fingerprints link at two or fewer differing bits."""
    from loomlog.llm.simhash import simhash_groups
    return simhash_groups(table(spark, sf_dir, "documents"))


#: Verdict, host and path of the written URL rules.
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, fitting rule and verdict of every page."""
    from loomlog.llm.urls import judged_urls
    return judged_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    from loomlog.llm.minhash import edit_likeness
    return edit_likeness(table(spark, sf_dir, "documents"))


@query
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data found in every document."""
    from loomlog.llm.pii import personal_data
    return personal_data(table(spark, sf_dir, "documents"))


@query
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests read back from every formatted conversation."""
    from loomlog.llm.chat import formatted, linear_tree, read_back, with_probe
    return read_back(formatted(linear_tree(with_probe(table(spark, sf_dir, "conversations")))))


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and prediction of every document."""
    from loomlog.llm.classifier import scored
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and its digest of every conversation after faults were planted."""
    from loomlog.llm.structure import damaged, structure_report
    return structure_report(damaged(table(spark, sf_dir, "conversations")))


@query
def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of conversations that share heads."""
    from loomlog.llm.trie import conversation_trie
    return conversation_trie(table(spark, sf_dir, "conversations"))


@query
def op12_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's set of shingles and its component by Jaccard similarity."""
    from loomlog.llm.set_join import linked_components
    return linked_components(table(spark, sf_dir, "documents"))
