"""Train, evaluate and score log and flow models as whole jobs."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog.checkpoints import written
from loomlog.functions.severity import flow_label_is_anomaly, level_is_anomaly
from loomlog.operators import evaluation
from loomlog.operators.features import (
    Categories, FlowFeaturizer, LogFeaturizer, MinMax, TfidfModel, fit_flow_featurizer, fit_log_featurizer, prefer_normal,
)
from loomlog.operators.forest import ForestModel, fit_forest
from loomlog.operators.sampling import mark_split, sample_rows
from loomlog.options import ForestOptions
from loomlog.plans import folds
from loomlog.plans.folds import CONTAMINATIONS  # noqa: F401


def with_label(logs: DataFrame, levels: list[str] | None = None) -> DataFrame:
    """Add ``y``: 1 for the anomaly levels. Level is also a feature, so scores here flatter a model."""
    return logs.withColumn("y", level_is_anomaly(F.col("log_level"), levels))


def fit_logistic(df: DataFrame, features: str = "features", label: str = "y", max_iter: int = 1000) -> LogisticRegressionModel:
    """Class-balanced L2 logistic regression with unit inverse strength on the summed loss."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    total = sum(counts.values())
    weight = F.lit(1.0)
    for value, n in counts.items():
        weight = F.when(F.col(label) == value, F.lit(total / (len(counts) * n))).otherwise(weight)
    return LogisticRegression(
        featuresCol=features, labelCol=label, weightCol="_w", maxIter=max_iter, standardization=False,
        elasticNetParam=0.0, regParam=1.0 / total, tol=1e-4,
    ).fit(df.withColumn("_w", weight))


def probabilities(model: LogisticRegressionModel, df: DataFrame) -> DataFrame:
    """Add ``score``, the probability of class 1."""
    out = model.transform(df)
    return out.withColumn("score", vector_to_array(F.col("probability"))[1]).drop("rawPrediction", "probability", "prediction")


@dataclass
class LogModel:
    """A fitted featurizer with either a logistic model and its threshold, or a forest."""

    featurizer: LogFeaturizer
    kind: str
    logistic: LogisticRegressionModel | None = None
    threshold: float = 0.5
    forest: ForestModel | None = None

    def predict(self, logs: DataFrame) -> DataFrame:
        """Add ``pred`` (0/1); unseen levels and modules are ignored, as are terms outside the vocabulary."""
        rows = self.featurizer.transform(logs)
        if self.kind == "supervised":
            out = probabilities(self.logistic, rows)
            return out.withColumn("pred", (F.col("score") >= self.threshold).cast("int")).drop("features")
        return self.forest.predict(rows).withColumnRenamed("is_anomaly", "pred").drop("features")

    def save(self, spark: SparkSession, path: str) -> None:
        f = self.featurizer
        meta = {
            "kind": self.kind, "threshold": self.threshold, "terms": f.tfidf.terms, "idf": f.tfidf.idf,
            "stop_words": f.tfidf.stop_words, "bigrams": f.tfidf.bigrams, "categories": list(f.categories.sizes),
            "low": f.ranges.low, "high": f.ranges.high,
        }
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/featurizer")
        f.categories.save(f"{path}/categories")
        if self.kind == "supervised":
            self.logistic.write().overwrite().save(f"{path}/logistic")
        else:
            self.forest.save(spark, f"{path}/forest")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "LogModel":
        m = json.loads(spark.read.text(f"{path}/featurizer", wholetext=False).first()["value"])
        featurizer = LogFeaturizer(
            TfidfModel(m["terms"], m["idf"], m["stop_words"], m["bigrams"]), Categories.load(spark, f"{path}/categories", m["categories"]),
            MinMax(m["low"], m["high"]))
        if m["kind"] == "supervised":
            return cls(featurizer, "supervised", LogisticRegressionModel.load(f"{path}/logistic"), m["threshold"])
        return cls(featurizer, "forest", forest=ForestModel.load(spark, f"{path}/forest"))


def train_log_model(logs: DataFrame, test: DataFrame | None = None, kind: str = "forest", ids: list[str] | None = None,
                    forest: ForestOptions = ForestOptions(trees=200, contamination=0.15),
                    test_levels: list[str] | None = None, **featurizer_options) -> tuple[LogModel, DataFrame]:
    """Fit on ``logs`` and report on ``test`` (a stratified quarter of ``logs`` when none is given).

    Returns the model and its classification report. For the supervised kind the threshold is the one with the
    best f1 on the test side.
    """
    ids = ids or ["line_id"]
    columns = [*ids, "log_level", "module", "message", "y"]
    labelled = with_label(logs).select(*columns)
    if test is None:
        rows = mark_split(labelled, "y", ids, "held")
    else:
        held = with_label(test, test_levels).select(*columns, F.lit(True).alias("held"))
        rows = labelled.withColumn("held", F.lit(False)).unionByName(held)
    rows = written(rows, "split")  # read by every fitting pass
    train = rows.filter("not held")
    featurizer = fit_log_featurizer(train, **featurizer_options)
    if kind == "supervised":
        vectors = written(featurizer.transform(rows).select("y", "held", "features"), "vectors")
        logistic = fit_logistic(vectors.filter("not held").select("y", "features"))
        scored = written(probabilities(logistic, vectors.filter("held")).select("y", "score"), "scored")
        best = evaluation.best_threshold(evaluation.threshold_sweep(scored)).first()
        threshold = best["threshold"] if best else 0.5
        model = LogModel(featurizer, kind, logistic, threshold)
        pred = scored.withColumn("pred", (F.col("score") >= threshold).cast("int"))
    else:
        model = LogModel(featurizer, "forest", forest=fit_forest(train, ids, opts=forest, transform=featurizer.transform))
        pred = model.predict(rows.filter("held"))
    return model, evaluation.classification_report(pred)


def score_logs(model: LogModel, logs: DataFrame) -> DataFrame:
    """Every row with ``status`` ANOMALY or NORMAL."""
    return model.predict(logs).withColumn("status", F.when(F.col("pred") == 1, "ANOMALY").otherwise("NORMAL"))


def evaluate_by_source(model: LogModel, logs: DataFrame, source: str = "source_file") -> DataFrame:
    """Per source: accuracy, scores of the anomaly class, and true / predicted / total counts. Rows are scored once."""
    scored = model.predict(with_label(logs))
    report = evaluation.classification_report(scored, by=[source])
    wide = report.groupBy(source).agg(
        F.max(F.when(F.col("class") == "accuracy", F.col("f1"))).alias("accuracy"),
        *[F.max(F.when(F.col("class") == "1", F.col(m))).alias(f"{m}_anomaly") for m in ("f1", "recall", "precision")],
    )
    counts = scored.groupBy(source).agg(
        F.sum("y").alias("true_anomalies"), F.sum("pred").alias("predicted_anomalies"), F.count(F.lit(1)).alias("total"))
    return wide.join(counts, source)


def leave_one_out(logs: DataFrame, source: str = "source_file", **options) -> DataFrame:
    """Hold out each source and evaluate a forest trained on the others at every contamination, all folds in one job."""
    return folds.leave_one_out(with_label(logs), source, **options)


def train_all_and_save(spark: SparkSession, logs: DataFrame, path: str, contamination: float = 0.10,
                       ids: list[str] | None = None, **featurizer_options) -> LogModel:
    """Fit a forest on every row and save it with a manifest."""
    ids = ids or ["line_id"]
    featurizer = fit_log_featurizer(logs, **featurizer_options)
    opts = ForestOptions(trees=200, contamination=contamination)
    forest = fit_forest(logs, ids, opts=opts, transform=featurizer.transform)
    model = LogModel(featurizer, "forest", forest=forest)
    model.save(spark, path)
    manifest = json.dumps({"contamination": contamination, "features": featurizer.size})
    spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return model


# ---------------------------------------------------------------- flow tables

FLOW_DROP = {"unsw": ["id", "label", "attack_cat"], "nsl": ["difficulty", "label"], "ctu": ["label"]}
FLOW_NORMAL = {"unsw": "zero", "nsl": "prefix", "ctu": "words"}
FLOW_TREES = {"unsw": 300, "nsl": 300, "ctu": 100}


@dataclass
class FlowModel:
    featurizer: FlowFeaturizer
    forest: ForestModel

    def predict(self, flows: DataFrame) -> DataFrame:
        return self.forest.predict(self.featurizer.transform(flows)).drop("features")

    def save(self, spark: SparkSession, path: str) -> None:
        meta = json.dumps({"categories": list(self.featurizer.categories.sizes), "scale": self.featurizer.scale})
        self.featurizer.categories.save(f"{path}/categories")
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/featurizer")
        self.forest.save(spark, f"{path}/forest")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FlowModel":
        m = json.loads(spark.read.text(f"{path}/featurizer").first()["value"])
        return cls(FlowFeaturizer(Categories.load(spark, f"{path}/categories", m["categories"]), m["scale"]), ForestModel.load(spark, f"{path}/forest"))


def train_flow_model(flows: DataFrame, kind: str, ids: list[str], contamination: float = 0.02, trees: int | None = None,
                     sample: int | None = None) -> FlowModel:
    """Forest over a flow table, trained on normal traffic where labels say which rows are normal."""
    rows = prefer_normal(flows, "label", FLOW_NORMAL[kind])
    if sample is not None:
        rows = sample_rows(rows, sample, ids)
    featurizer = fit_flow_featurizer(rows, FLOW_DROP[kind] + [i for i in ids if i not in FLOW_DROP[kind]])
    opts = ForestOptions(trees=trees or FLOW_TREES[kind], contamination=contamination)
    return FlowModel(featurizer, fit_forest(rows, ids, opts=opts, transform=featurizer.transform))


def evaluate_flow_model(model: FlowModel, flows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(confusion matrix, classification report) on labelled flows."""
    if "label" not in flows.columns:
        raise ValueError("test data needs a 'label' column")
    scored = model.predict(flows).select(
        flow_label_is_anomaly(F.col("label").cast("string")).alias("y"), F.col("is_anomaly").alias("pred"))
    return evaluation.confusion_matrix(scored), evaluation.classification_report(scored)


def label_distribution(flows: DataFrame, column: str = "label", top: int | None = 10) -> DataFrame:
    """column, n including nulls, most frequent first."""
    out = flows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)
    return out.limit(top) if top else out


