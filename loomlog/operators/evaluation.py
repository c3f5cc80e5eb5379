"""Predictions against truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def f1_of(precision: Column, recall: Column) -> Column:
    return _ratio(precision * recall * 2.0, precision + recall)


def truth_table(truth: DataFrame, key: str = "LineId", order: str | None = None) -> DataFrame:
    """key, y: positives from ``is_error``, else a true-like ``label``, else presence. The last duplicate in ``order`` wins.

    Without ``order`` duplicates must agree, as they have no last one: contradicting ones raise when they are read.
    """
    if "is_error" in truth.columns:
        y = F.col("is_error").cast("int")
    elif "label" in truth.columns:
        y = F.lower(F.col("label").cast("string")).isin("1", "true", "error").cast("int")
    else:
        y = F.lit(1)
    agreed = F.when(F.min("y") == F.max("y"), F.max("y")).when(F.count("y") == 0, None).otherwise(
        F.raise_error(F.lit("the truth table contradicts itself: name its row order")).cast("int"))
    last = F.max_by("y", "_o") if order else agreed
    rows = truth.select(F.col(key), y.alias("y"), *([F.col(order).alias("_o")] if order else []))
    return rows.groupBy(key).agg(last.alias("y"))


def score_against_truth(predictions: DataFrame, truth: DataFrame, key: str = "LineId", flag: str = "flagged",
                        order: str | None = None) -> DataFrame:
    """precision, recall, f1, tp, fp, fn of a boolean column; rows absent from the truth are negatives."""
    joined = predictions.select(key, F.col(flag).alias("p")).join(truth_table(truth, key, order), key, "left")
    y = F.coalesce(F.col("y"), F.lit(0)) == 1
    p = F.coalesce(F.col("p"), F.lit(False))
    return with_scores(joined.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn")))


def with_scores(counts: DataFrame) -> DataFrame:
    """Add precision, recall and f1 to rows of tp, fp, fn; a zero division gives 0."""
    out = counts.withColumn("precision", _ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn(
        "recall", _ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return out.withColumn("f1", f1_of(F.col("precision"), F.col("recall")))


def confusion_matrix(df: DataFrame, truth: str = "y", pred: str = "pred", by: list[str] | None = None) -> DataFrame:
    """truth, pred, n, optionally per group."""
    return df.groupBy(*(by or []), truth, pred).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, truth: str = "y", pred: str = "pred", by: list[str] | None = None) -> DataFrame:
    """class, precision, recall, f1, support for classes 0 and 1, accuracy and the macro and weighted averages.

    One aggregate over the rows (per group in ``by``); everything after it is arithmetic on its few rows.
    """
    t, p = F.col(truth), F.col(pred)
    keys = by or []
    counts = df.groupBy(*keys).agg(*[
        F.count_if((t == a) & (p == b)).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)
    ])
    c = {(a, b): F.col(f"n{a}{b}") for a in (0, 1) for b in (0, 1)}
    total = c[0, 0] + c[0, 1] + c[1, 0] + c[1, 1]
    per_class = {}
    for k in (0, 1):
        o = 1 - k
        prec, rec = _ratio(c[k, k], c[k, k] + c[o, k]), _ratio(c[k, k], c[k, k] + c[k, o])
        per_class[k] = (prec, rec, f1_of(prec, rec), c[k, k] + c[k, o])

    def line(name: str, prec: Column, rec: Column, f1: Column, support: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), prec.alias("precision"), rec.alias("recall"),
                        f1.alias("f1"), support.cast("long").alias("support"))

    accuracy = _ratio(c[0, 0] + c[1, 1], total)
    macro = [(per_class[0][i] + per_class[1][i]) / 2.0 for i in range(3)]
    weighted = [_ratio(per_class[0][i] * per_class[0][3] + per_class[1][i] * per_class[1][3], total) for i in range(3)]
    return counts.select(*keys, F.inline(F.array(
        line("0", *per_class[0]), line("1", *per_class[1]),
        line("accuracy", accuracy, accuracy, accuracy, total),
        line("macro avg", *macro, total), line("weighted avg", *weighted, total),
    )))


SWEEP = [i / 100 for i in range(5, 95, 2)]


def threshold_sweep(df: DataFrame, score: str = "score", truth: str = "y", thresholds: list[float] | None = None) -> DataFrame:
    """threshold, tp, fp, fn, precision, recall, f1 for ``score >= threshold`` at every threshold.

    Rows are counted once by how many thresholds they reach; each threshold's counts are then suffix sums
    over that short histogram, instead of one copy of the data per threshold.
    """
    cuts = sorted(thresholds or SWEEP)
    reached = F.lit(0)
    for cut in cuts:
        reached = reached + (F.col(score) >= F.lit(cut)).cast("int")
    hist = df.groupBy(F.coalesce(reached, F.lit(0)).alias("reached")).agg(
        F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) == 0).alias("neg"))
    grid = df.sparkSession.createDataFrame([(i + 1, c) for i, c in enumerate(cuts)] + [(0, None)], "reached int, threshold double")
    full = grid.join(hist, "reached", "left").na.fill(0, subset=["pos", "neg"])
    above = Window.partitionBy().orderBy(F.desc("reached")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    counts = full.select(
        "threshold", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(everything).alias("_p"),
    ).filter(F.col("threshold").isNotNull())
    return with_scores(counts.select("threshold", "tp", "fp", (F.col("_p") - F.col("tp")).alias("fn")))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The row with the best f1; the lowest threshold among equals."""
    return sweep.orderBy(F.desc("f1"), "threshold").limit(1)


def best_by_mean_f1(results: DataFrame, key: str = "contamination", f1: str = "f1_anomaly") -> DataFrame:
    return results.groupBy(key).agg(F.avg(f1).alias("mean_f1")).orderBy(F.desc("mean_f1"), key).limit(1)


def predicted_preview(df: DataFrame, by: str, order: str, pred: str = "pred", n: int = 20) -> DataFrame:
    """First ``n`` predicted anomalies of each group; cut per task before the shuffle."""
    w = Window.partitionBy(by).orderBy(order)
    return df.filter(F.col(pred) == 1).withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= n)
