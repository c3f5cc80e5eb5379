import numpy as np
import pytest
from pyspark.sql import functions as F

from loomlog.operators import evaluation as ev
from loomlog.operators import lookups, sampling, windows
from loomlog.operators import quantiles as qt


def greedy_by_hand(seconds, width=60):
    starts, out = [], {}
    for s in sorted(set(seconds)):
        if not starts or s >= starts[-1] + width:
            starts.append(s)
        out[s] = starts[-1]
    return out


def events(spark, rows):
    df = spark.createDataFrame(rows, "src string, s long")
    return df.withColumn("ts", windows.from_seconds(F.col("s")))


def test_greedy_starts_from_the_data(spark):
    df = events(spark, [("a", s) for s in (0, 59, 61, 130)])
    got = {r["second"]: r["window_start"] for r in windows.greedy_window_starts(df, "src").collect()}
    assert got == {0: 0, 59: 0, 61: 61, 130: 130}


def test_greedy_across_days_matches_a_plain_loop(spark):
    rng = np.random.default_rng(7)
    rows = []
    for src, step in (("dense", 20), ("sparse", 4000), ("mid", 70)):
        s = 86_400 * 3 - 500
        for _ in range(3000 if src != "sparse" else 200):
            s += int(rng.integers(0, step * 2))
            rows.append((src, s))
    rows += [("edge", 86_400 - 1), ("edge", 86_400 + 58), ("edge", 86_400 + 59), ("edge", 86_400 + 200), ("edge", 5 * 86_400)]
    df = events(spark, rows).repartition(7)
    got = {(r["src"], r["second"]): r["window_start"] for r in windows.greedy_window_starts(df, "src").collect()}
    want = {}
    for src in {r[0] for r in rows}:
        want.update({(src, s): w for s, w in greedy_by_hand([s for x, s in rows if x == src]).items()})
    assert got == want


def test_event_frequency_and_lookup_of_any_size(spark, monkeypatch):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    freq = windows.with_event_frequency(df, "k")
    assert freq.count() == 1000 and freq.filter("k = 'hot'").select("event_freq").distinct().first()[0] == 334
    table = spark.createDataFrame([("hot", 1)], "k string, v int")
    for limit in (lookups.BROADCAST_BYTES, 0):
        monkeypatch.setattr(lookups, "BROADCAST_BYTES", limit)
        assert lookups.lookup(df, table, ["k"], "left_semi").count() == 334
        assert lookups.lookup(df, table, ["k"], "left_anti").count() == 666


@pytest.mark.parametrize("target", [0, 1, 97, 1000, 5000])
def test_quota_sample_sizes(spark, target):
    df = spark.range(1000).select("id", F.when(F.col("id") < 600, "a").when(F.col("id") < 990, "b").otherwise("c").alias("f"))
    got = sampling.proportional_sample(df, "f", target, ["id"])
    assert got.count() == min(target, 1000) and got.distinct().count() == min(target, 1000)


def test_split_is_exact_disjoint_and_repeatable(spark):
    df = spark.range(1003).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    train, test = sampling.stratified_split(df, "y", ["id"])
    assert {r["y"]: r["count"] for r in test.groupBy("y").count().collect()} == {0: 226, 1: 26}
    assert train.count() + test.count() == 1003 and train.join(test, "id").count() == 0
    again = sampling.stratified_split(df.repartition(9), "y", ["id"])[1]
    assert {r[0] for r in test.select("id").collect()} == {r[0] for r in again.select("id").collect()}


@pytest.mark.parametrize("limit", [50_000, 5])
def test_exact_quantiles_equal_numpy(spark, monkeypatch, limit):
    monkeypatch.setattr(qt, "READ_LIMIT", limit)
    monkeypatch.setattr(qt, "SKETCH_ACCURACY", 100)
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), rng.exponential(1e6, 500)])
    df = spark.createDataFrame([(float(v),) for v in data], "v double").repartition(5)
    probs = [0.0, 0.05, 0.2, 0.5, 0.6, 0.95, 1.0]
    assert np.allclose(qt.exact_quantiles(df, "v", probs), np.quantile(data, probs))
    assert qt.exact_quantiles(df.filter("v is null"), "v", [0.5]) == [None]


def test_evaluation_against_duplicates_and_missing(spark):
    pred = spark.createDataFrame([(1, True), (2, True), (3, False), (4, False)], "LineId long, flagged boolean")
    truth = spark.createDataFrame([(1, 1, "error"), (2, 2, "true"), (3, 2, "no"), (4, 4, "1")], "o int, LineId long, label string")
    row = ev.score_against_truth(pred, truth, order="o").first()
    assert (row["tp"], row["fp"], row["fn"], row["precision"], row["recall"], row["f1"]) == (1, 1, 1, 0.5, 0.5, 0.5)
    none = ev.score_against_truth(pred.filter("LineId = 3"), truth, order="o").first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)


def test_sweep_counts_each_threshold(spark):
    df = spark.createDataFrame([(0.05, 1), (0.5, 0), (0.51, 1), (0.99, 1), (0.01, 0)], "score double, y int")
    got = {r["threshold"]: (r["tp"], r["fp"], r["fn"]) for r in ev.threshold_sweep(df).collect()}
    assert len(got) == 45 and got[0.05] == (3, 1, 0) and got[0.51] == (2, 0, 1) and got[0.93] == (1, 0, 2)
    assert ev.best_threshold(ev.threshold_sweep(df)).first()["threshold"] == 0.05


def test_fractional_status_texts_count(spark):
    from loomlog.operators import aggregates
    df = spark.createDataFrame([("200.0",), ("200",), ("x",)], "status string")
    assert [(r.status, r.n) for r in aggregates.status_distribution(df).collect()] == [(200, 2)]


def test_truth_without_an_order_must_agree(spark):
    pred = spark.createDataFrame([(1, True)], "LineId long, flagged boolean")
    truth = spark.createDataFrame([(1, 1, "error"), (2, 1, "not an error")], "o int, LineId long, label string")
    assert ev.score_against_truth(pred, truth, order="o").first()["tp"] == 0
    with pytest.raises(Exception, match="row order"):
        ev.score_against_truth(pred, truth).collect()


def test_numbers_in_an_order(spark):
    from loomlog.operators.numbering import with_numbers
    df = spark.range(1000).select(F.pmod(F.xxhash64("id"), F.lit(5000)).alias("x"), "id").repartition(7)
    got = with_numbers(df, ["x", "id"], "n", start=1).collect()
    order = sorted((r["x"], r["id"]) for r in got)
    assert {(r["x"], r["id"]): r["n"] for r in got} == {x: k for k, x in enumerate(order, 1)}
    assert with_numbers(df.limit(0), ["x"], "n").count() == 0


def test_samples_follow_digests_and_stay_exact_with_repeated_ids(spark):
    import hashlib
    rows = [(k % 60, "ab"[k % 2]) for k in range(400)]
    df = spark.createDataFrame(rows, "id int, g string")
    quotas = spark.createDataFrame([("a", 37), ("b", 5000)], "g string, quota long")
    for parts in (1, 5):
        marked = sampling.mark_by_quota(df.repartition(parts), "g", quotas, ["id"]).collect()
        assert len(marked) == 400 and sum(r["_in"] for r in marked if r["g"] == "a") == 37 and all(r["_in"] for r in marked if r["g"] == "b")
        key = {r["id"]: hashlib.md5(f"42|{r['id']}".encode()).hexdigest() for r in marked}
        taken = [key[r["id"]] for r in marked if r["g"] == "a" and r["_in"]]
        left = [key[r["id"]] for r in marked if r["g"] == "a" and not r["_in"]]
        assert max(taken) <= min(left)
    assert sampling.sample_rows(df, 0, ["id"]).count() == 0


def test_sampling_ranks_no_group(spark):
    df = spark.range(5_000).withColumn("g", F.col("id") % 3)
    quotas = df.groupBy("g").agg(F.lit(100).cast("long").alias("quota"))
    plan = sampling.mark_by_quota(df, "g", quotas, ["id"])._jdf.queryExecution().toString()
    assert "row_number" not in plan
