"""The pipeline's stages on a small corpus with planted cases."""

import random

import corpus_pipeline
import pytest
from loomlog.llm import simhash


def prose(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    r, folder = random.Random(9), str(tmp_path_factory.mktemp("corpus"))
    good = {k: prose(r, 120) for k in range(200)}
    bad = {200 + k: prose(r, 120).replace(" ", " ||| ") for k in range(60)}
    copies = {300 + k: good[k] for k in range(10)}
    near = {400 + k: good[k].replace(" ", " changed ", 1) for k in range(10)}
    private = {500: prose(r, 60) + " write to me@mail.example.com or 10.1.2.3 today " + prose(r, 60)}
    short = {600: "too short", 601: "", 602: None}
    rows = [(i, t, "en", "s", len(t or "")) for group in (good, bad, copies, near, private, short) for i, t in group.items()]
    rows += [rows[0], (None, prose(r, 90), None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in good] + [(i, 0, 0) for i in bad]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_and_run(spark, sf_dir, tmp_path):
    docs = first = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, sf_dir)
        assert out.columns == first.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append([x.doc_id for x in docs.select("doc_id").collect()])
    by_rules, by_classifier, single, masked = kept
    assert not {600, 601, 602} & set(by_rules) and set(range(200)) <= set(by_rules)
    assert not set(range(200, 260)) & set(by_classifier) and len(set(range(200)) & set(by_classifier)) >= 198
    assert not set(range(300, 310)) & set(single)
    texts = {x.doc_id: simhash.fingerprint(x.text or "") for x in first.filter("doc_id is not null").collect()}
    before, after = set(by_classifier) - {None}, set(single) - {None}
    assert all(any((texts[i] ^ texts[k]).bit_count() <= 2 for k in before if k < i) for i in before - after)
    assert not any((texts[i] ^ texts[k]).bit_count() <= 2 for i in after for k in after if i < k)
    assert set(range(200)) & set(by_classifier) <= set(single) and len(single) == len(set(single))
    assert sorted(masked, key=repr) == sorted(single, key=repr)
    text = docs.filter("doc_id = 500").first()
    assert "<email>" in text.text and "<ip>" in text.text and "example.com" not in text.text and text.n_chars == len(text.text)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert pieces.select("doc_id").distinct().count() == len(set(masked))
    assert sorted(map(tuple, pieces.drop("sequence_id", "offset").collect()), key=repr) == sorted(
        map(tuple, corpus_pipeline.run(spark, sf_dir).drop("sequence_id", "offset").collect()), key=repr)


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
