"""The exact set join against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomlog.llm import set_join

SCHEMA = "doc_id long, text string, id long, grp string, n int, key string, label long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, "g", 1, "k", 2) for i, t in rows], SCHEMA)


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))}


def brute(rows, percent=90):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for x in range(len(rows)):
        for y in range(x):
            common = len(sets[x] & sets[y])
            if common and 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                root[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[find(x)] = min(least.get(find(x), i), i)
    return sorted(((i, len(s), i if not s else least.get(find(x))) for x, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def corpus(seed, groups=8):
    """Copies with some words changed, texts that share most of their words with all, short, empty and null ones."""
    draw, out = random.Random(seed), []
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 6)))
    shared = [word() for _ in range(60)]
    for g in range(groups):
        base = [word() for _ in range(draw.randrange(10, 260))] + shared * (g % 2)
        for _ in range(draw.randrange(1, 9)):
            copy = list(base)
            for _ in range(draw.randrange(0, 6)):
                copy[draw.randrange(len(copy))] = word()
            out.append(" ".join(copy[:len(copy) - draw.randrange(0, 9)]))
        out.append(" ".join(base).upper())
    out += [" ".join(shared + [word() for _ in range(k)]) for k in range(0, 24, 3)]
    out += ["", None, " \t\n", "one", "ONE", "one two", "one two three", "one two three four", "É é ü", "x " * 3000, "x y " * 900]
    rows = list(enumerate(out, start=5))
    return [*rows, (None, out[0]), (None, "only here and without any id"), (6, out[2]), (6, "another text of one id"), (6, ""), (900, out[0])]


@pytest.mark.parametrize("seed, hot, low, members, rows", [(1, 32, 0.2, 500, 50_000), (2, 2, 0.2, 3, 20), (3, 3, 0.99, 2, 50_000), (4, 2, 0.02, 1, 1)])
def test_components_match_all_pairs(spark, monkeypatch, seed, hot, low, members, rows):
    for name, value in (("HOT", hot), ("_LIMIT", int(low * 2**63)), ("MEMBERS", members), ("ROWS", rows), ("WORDS", 64 if rows < 100 else 1 << 21)):
        monkeypatch.setattr(set_join, name, value)
    docs = corpus(seed)
    assert found(set_join.linked_components(frame(spark, docs))) == brute(docs)


def test_other_similarity(spark):
    docs = corpus(9, 4)
    assert found(set_join.linked_components(frame(spark, docs), percent=70)) == brute(docs, 70)


def test_a_large_group_in_parts(spark, monkeypatch):
    """Two groups of near copies that share nine tenths of their words, each in several parts, and a chain between texts."""
    monkeypatch.setattr(set_join, "MEMBERS", 8)
    draw, docs = random.Random(4), []
    base = [f"w{k}" for k in range(200)]
    for g in range(2):
        own = base[:170] + [f"g{g}x{k}" for k in range(30)]
        for _ in range(25):
            copy = list(own)
            copy[draw.randrange(len(copy))] = f"r{draw.random()}"
            docs.append(" ".join(copy))
    chain = [f"c{k}" for k in range(100)]
    docs += [" ".join(f"{'d' if k < 2 * n else ''}{x}" for k, x in enumerate(chain)) for n in range(20)]
    rows = list(enumerate(docs))
    assert found(set_join.linked_components(frame(spark, rows))) == brute(rows)


def test_dealt_rows_are_not_joined(spark, monkeypatch):
    """What is compared joins before rows are dealt to blocks: dealt rows may be many more than the planner expects."""
    plans = []
    for name in ("listed", "settled"):
        def watched(rows, percent, meet=getattr(set_join, name)):
            plans.append(rows._jdf.queryExecution().sparkPlan().toString())
            return meet(rows, percent)
        monkeypatch.setattr(set_join, name, watched)
    monkeypatch.setattr(set_join, "MEMBERS", 4)
    draw, docs = random.Random(8), []
    shared = [f"s{k}" for k in range(12)]
    for _ in range(30):  # of one list or more, but apart
        docs.append(" ".join(shared + [f"w{draw.random()}" for _ in range(20)]))
    base = [f"b{k}" for k in range(120)]
    for k in range(20):
        docs.append(" ".join([*base[:k], f"c{k}", *base[k + 1:]]))
    rows = list(enumerate(docs))
    assert found(set_join.linked_components(frame(spark, rows))) == brute(rows)
    assert len(plans) >= 3 and any("Union" in plan for plan in plans)
    assert [re.search("Join|Generate", plan)[0] for plan in plans] == ["Generate"] * len(plans)
    assert all("SortMergeJoin [id#" in plan for plan in plans if "Union" not in plan)


def test_empty_table(spark):
    assert found(set_join.linked_components(frame(spark, []))) == []
    assert found(set_join.linked_components(frame(spark, [(3, ""), (3, None)]))) == [(3, 0, 3), (3, 0, 3)]


def test_extra_columns(spark):
    docs = corpus(12, 3)
    wide = frame(spark, docs).withColumn("token", F.lit(1)).withColumn("least", F.lit(1)).withColumn("bits", F.lit("x"))
    assert found(set_join.linked_components(wide)) == brute(docs)


def test_derived_overlaps_are_exact():
    draw = np.random.default_rng(5)
    base = np.unique(draw.integers(0, 5_000, 300))
    sets = [np.unique(np.concatenate([draw.permutation(base)[:len(base) - k], draw.integers(0, 9_000, 2 * k)])) for k in range(30)]
    sets += [np.unique(draw.integers(0, 5_000, k)) for k in (1, 2, 50, 400)]
    seen = set()
    for k, common in set_join.overlaps(sets):
        seen.add(int(k))
        assert common.tolist() == [len(np.intersect1d(sets[k], x)) for x in sets]
    assert seen == set(range(len(sets)))


def test_parities_bound_the_difference():
    draw = np.random.default_rng(6)
    base = np.unique(draw.integers(0, 2**63 - 1, 130))
    sets = [np.unique(np.concatenate([base[k:], draw.integers(0, 2**63 - 1, k)])) for k in range(0, 60, 4)]
    bits = set_join.Parities([set_join.parities(x) for x in sets])
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    least = bits.differ(a, b)
    real = np.array([len(np.setxor1d(sets[x], sets[y])) for x, y in zip(a, b)])
    assert (least <= real).all() and (least[real > 40] > 15).all()
