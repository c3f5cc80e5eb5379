"""Exact quantiles in bounded memory.

Spark's exact ``percentile`` holds every distinct value of the column in one
buffer. Here a mergeable sketch brackets each wanted rank, a counting pass checks
the bracket, and only once a bracket holds few distinct values are those values
read. The answer is exact, with linear interpolation between neighbours.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from loomlog.operators.lookups import lookup

SKETCH_ACCURACY = 10_000
READ_LIMIT = 50_000


def _ranks(n: int, prob: float) -> tuple[int, int, float]:
    """Zero-based neighbours of the wanted position, and the weight of the upper one."""
    at = prob * (n - 1)
    low = math.floor(at)
    return low, min(low + 1, n - 1), at - low


def exact_quantiles(df: DataFrame, column: str, probs: list[float]) -> list[float | None]:
    """Linear-interpolated quantiles of a numeric column, nulls ignored; None for no rows."""
    return quantiles_and(df, column, probs, [])[0]


def quantiles_and(df: DataFrame, column: str, probs: list[float], also: list[Column]) -> tuple[list[float | None], Row]:
    """The quantiles and, from the same first pass, a row with the aggregates ``also`` of the values ``v``."""
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    slack = 4.0 / SKETCH_ACCURACY
    cuts = [q for p in probs for q in (max(0.0, p - slack), min(1.0, p + slack))]
    head = values.agg(
        F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"),
        F.percentile_approx("v", cuts, SKETCH_ACCURACY).alias("cuts"), *also,
    ).first()
    n = head["n"]
    if n == 0:
        return [None] * len(probs), head
    brackets = []
    for i, p in enumerate(probs):
        low = head["lo"] if p <= slack else head["cuts"][2 * i]
        high = head["hi"] if p >= 1 - slack else head["cuts"][2 * i + 1]
        brackets.append((low, high))
    wanted = sorted({r for p in probs for r in _ranks(n, p)[:2]})
    found = _values_at(values, wanted, brackets, n, (head["lo"], head["hi"]))
    out = []
    for p in probs:
        low, high, weight = _ranks(n, p)
        out.append(found[low] + (found[high] - found[low]) * weight)
    return out, head


def _values_at(values: DataFrame, ranks: list[int], brackets: list[tuple[float, float]], n: int,
               whole: tuple[float, float]) -> dict[int, float]:
    """Value at each zero-based rank, reading only brackets known to be small."""
    found: dict[int, float] = {}
    pending = _merged(brackets)
    while pending:
        counts = values.agg(*[
            c for i, (lo, hi) in enumerate(pending) for c in (
                F.count_if(F.col("v") < lo).alias(f"b{i}"),
                F.count_if(F.col("v").between(lo, hi)).alias(f"w{i}"),
                F.approx_count_distinct(F.when(F.col("v").between(lo, hi), F.col("v"))).alias(f"d{i}"),
            )
        ]).first()
        narrower: list[tuple[float, float]] = []
        for i, (lo, hi) in enumerate(pending):
            below, within = counts[f"b{i}"], counts[f"w{i}"]
            here = [r for r in ranks if r not in found and below <= r < below + within]
            if not here:
                continue
            if lo == hi:
                found.update({r: lo for r in here})
            elif counts[f"d{i}"] <= READ_LIMIT:
                rows = (
                    values.filter(F.col("v").between(lo, hi)).groupBy("v").agg(F.count("v").alias("c"))
                    .orderBy("v").collect()
                )
                at = below
                for row in rows:
                    found.update({r: row["v"] for r in here if at <= r < at + row["c"]})
                    at += row["c"]
            else:
                narrower += _split(values, lo, hi, below, within, here)
        missing = [r for r in ranks if r not in found]
        if not missing:
            return found
        # A rank the sketch put outside its bracket: start over for it from the full range.
        pending = _merged(narrower) or _merged(_split(values, *whole, 0, n, missing))
    return found


def _split(values: DataFrame, lo: float, hi: float, below: int, within: int, ranks: list[int]) -> list[tuple[float, float]]:
    """Tighter brackets for ranks inside [lo, hi], from a sketch of that range alone."""
    slack = 4.0 / SKETCH_ACCURACY
    probs = [(r - below) / max(within - 1, 1) for r in ranks]
    cuts = [q for p in probs for q in (max(0.0, p - slack), min(1.0, p + slack))]
    sketch = values.filter(F.col("v").between(lo, hi)).agg(F.percentile_approx("v", cuts, SKETCH_ACCURACY).alias("c")).first()["c"]
    return [
        (lo if p <= slack else sketch[2 * i], hi if p >= 1 - slack else sketch[2 * i + 1])
        for i, p in enumerate(probs)
    ]


def _merged(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(set(brackets)):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def grouped_quantiles(df: DataFrame, key: str, column: str, probs: list[float]) -> DataFrame:
    """key, prob, value: linear-interpolated quantiles of every group in one job, nulls ignored.

    A sketch of each group brackets the wanted ranks with more room than its error can take. Values inside a bracket are
    counted by value; of those outside only the nearest are kept, which the neighbours of a rank may still be.
    """
    values = df.select(key, F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    slack = 4.0 / SKETCH_ACCURACY
    ends = [q for p in probs for q in (max(0.0, p - slack), min(1.0, p + slack))]
    heads = values.groupBy(key).agg(F.count("v").alias("n"), F.percentile_approx("v", ends, SKETCH_ACCURACY).alias("ends"))
    at = lambda p: F.lit(p) * (F.col("n") - 1)
    wanted = F.array(*[F.struct(
        F.lit(p).alias("prob"), F.col("ends")[2 * i].alias("low"), F.col("ends")[2 * i + 1].alias("high"),
        F.floor(at(p)).alias("rank"), (at(p) - F.floor(at(p))).alias("share")) for i, p in enumerate(probs)])
    brackets = heads.select(key, "n", wanted.alias("wanted"))
    joined = lookup(values, brackets, [key], "inner")
    # each value counts below, inside or above the bracket of every rank
    marked = joined.select(key, "n", "v", F.explode("wanted").alias("w")).select(key, "n", "v", "w.*")
    inside = marked.filter(F.col("v").between(F.col("low"), F.col("high"))).groupBy(key, "n", "prob", "rank", "share", "v").agg(F.count("v").alias("c"))
    outside = marked.groupBy(key, "prob").agg(
        F.count_if(F.col("v") < F.col("low")).alias("below"), F.max(F.when(F.col("v") < F.col("low"), F.col("v"))).alias("before"),
        F.min(F.when(F.col("v") > F.col("high"), F.col("v"))).alias("after"))
    upto = Window.partitionBy(key, "prob").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.join(outside, [key, "prob"]).withColumn("last", F.col("below") + F.sum("c").over(upto) - 1)

    def value_at(rank):
        found = F.min(F.when(F.col("last") >= rank, F.col("v")))
        return F.when(F.min(rank) < F.min("below"), F.min("before")).otherwise(F.coalesce(found, F.min("after")))
    pair = ranked.groupBy(key, "prob", "share").agg(
        value_at(F.col("rank")).alias("a"), value_at(F.least(F.col("rank") + 1, F.col("n") - 1)).alias("b"))
    return pair.select(key, "prob", (F.col("a") + (F.col("b") - F.col("a")) * F.col("share")).alias("value"))
