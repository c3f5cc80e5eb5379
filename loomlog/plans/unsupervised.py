"""Unsupervised runs: per line, per window, and scoring new lines with a saved model."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog.checkpoints import written
from loomlog.functions import severity as sev
from loomlog.functions.text import extract_or_null, parse_time
from loomlog.operators import evaluation
from loomlog.operators.features import ENGLISH, fit_categories, fit_minmax, fit_tfidf, one_hot
from loomlog.operators.forest import ForestModel, fit_forest
from loomlog.operators.quantiles import exact_quantiles
from loomlog.operators.templates import mine_templates
from loomlog.operators.windows import top_templates, with_event_frequency
from loomlog.options import ForestOptions, TemplateOptions

CONTAMINATIONS = [0.20, 0.18, 0.16]


def line_features(lines: DataFrame, line: str = "line", ids: list[str] | None = None,
                  templates: TemplateOptions = TemplateOptions(), stop_words: list[str] | str | None = ENGLISH,
                  tfidf_terms: int = 20) -> DataFrame:
    """Template, severity, event type and its frequency, keyword weight, health-check usage and TF-IDF as one vector."""
    ids = ids or ["line_id"]
    text = F.col(line)
    rows = mine_templates(lines, line, opts=templates)
    cpu, mem = sev.passed_healthcheck_usage(text)
    rows = rows.withColumns({
        "severity": sev.line_severity(text), "event_type": sev.event_type(text, F.col("template")),
        "keyword_severity": sev.keyword_severity(text), "hc_cpu": cpu, "hc_mem": mem,
        "truth": sev.rule_truth(text).cast("int"),
    })
    rows = with_event_frequency(rows, "event_type")
    rows = written(rows, "lines")  # fitting makes several passes over rows that cost a join and regexes to make
    hot = fit_categories(rows.select("template", "severity", "event_type"), ["template", "severity", "event_type"])
    out = one_hot(rows, hot)
    out = fit_minmax(rows, ["hc_cpu", "hc_mem"]).transform(out)
    out = fit_tfidf(rows, None, line, tfidf_terms, 1, stop_words).vectors(out, text, "_text")
    parts = ["template_vec", "severity_vec", "event_type_vec", "event_freq", "keyword_severity", "hc_cpu", "hc_mem", "_text"]
    return VectorAssembler(inputCols=parts, outputCol="features").transform(out).drop(*[p for p in parts if p.endswith("_vec")], "_text")


@dataclass
class LineRun:
    """Scored lines and what the run decided. ``threshold`` is the cut actually used."""

    scored: DataFrame
    contamination: float
    threshold: float
    sweep: DataFrame

    @property
    def critical(self) -> DataFrame:
        """Anomalies that are WARN/ERROR or not a common benign INFO event, most isolated first."""
        return self.scored.filter((F.col("is_anomaly") == 1) & (F.col("severity").isin("WARN", "ERROR") | ~F.col("benign"))).orderBy("anomaly_score")

    @property
    def benign(self) -> DataFrame:
        return self.scored.filter((F.col("is_anomaly") == 1) & F.col("benign")).orderBy("anomaly_score")

    def timeline(self, line: str = "line") -> DataFrame:
        """Anomalies with the time written in the line; lines without one are left out."""
        both = self.critical.unionByName(self.benign)
        return both.withColumn("logged_at", line_time(F.col(line))).filter(F.col("logged_at").isNotNull())


def line_time(line):
    """``yyyy-MM-dd HH:mm:ss,fff`` anywhere in the line."""
    found = extract_or_null(line, r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}[,.]\d+)")
    return parse_time(F.translate(F.substring(found, 1, 23), ",", "."), "yyyy-MM-dd HH:mm:ss.SSS")


def contamination_sweep(scored: DataFrame, cuts: dict[float, float], line: str, truth: str = "truth") -> DataFrame:
    """contamination, tp, fp, fn, precision, recall, f1 for the cut of every contamination, in one aggregate."""
    clear = sev.is_passed_healthcheck(F.col(line))
    table = F.explode(F.array(*[
        F.struct(F.lit(c).alias("contamination"), ((F.col("decision") < F.lit(q)) & ~clear).alias("p")) for c, q in cuts.items()
    ]))
    rows = scored.select(F.col(truth).alias("y"), table.alias("t"))
    counts = rows.groupBy("t.contamination").agg(
        F.count_if((F.col("y") == 1) & F.col("t.p")).alias("tp"), F.count_if((F.col("y") == 0) & F.col("t.p")).alias("fp"),
        F.count_if((F.col("y") == 1) & ~F.col("t.p")).alias("fn"))
    return evaluation.with_scores(counts)


def detect_line_anomalies(lines: DataFrame, line: str = "line", ids: list[str] | None = None,
                          contaminations: list[float] | None = None, forest: ForestOptions = ForestOptions(),
                          **feature_options) -> LineRun:
    """Forest over line features, the contamination with the best f1 against the rules, then rules on top.

    A forest with a fixed seed is the same for every contamination, so it is grown and scored once.
    """
    ids, cuts_wanted = ids or ["line_id"], contaminations or CONTAMINATIONS
    feats = written(line_features(lines, line, ids, **feature_options), "line-features")
    model = fit_forest(feats, ids, opts=forest, calibrate=False)
    scored = written(model.with_scores(feats).withColumn("decision", -F.col("iso_score")).drop("features"), "scored-lines")
    cuts = dict(zip(cuts_wanted, exact_quantiles(scored, "decision", cuts_wanted)))
    sweep = contamination_sweep(scored, cuts, line)
    position = {c: i for i, c in enumerate(cuts_wanted)}
    rows = sweep.collect()   # one row per contamination
    best = max(rows, key=lambda r: (r["f1"], -position[r["contamination"]]))
    chosen, offset = best["contamination"], cuts[best["contamination"]]
    text = F.col(line)
    final = scored.withColumn("anomaly_score", F.col("decision") - F.lit(offset)).withColumn(
        "is_anomaly", sev.override_prediction(F.col("anomaly_score") < 0, text).cast("int"),
    ).withColumn("benign", sev.is_benign_info(F.col("severity"), F.col("event_type"), F.col("event_freq"))).drop("iso_score", "decision")
    return LineRun(final, chosen, offset, sweep)


def window_matrix(counts: DataFrame, template: str, keys: list[str], templates: list[str]) -> DataFrame:
    """keys, features: one template-count array per window, positions as in ``templates``."""
    position = F.create_map(*[x for i, t in enumerate(templates) for x in (F.lit(t), F.lit(i))])
    per_window = counts.withColumn("_i", F.try_element_at(position, F.col(template))).filter(F.col("_i").isNotNull())
    grouped = per_window.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_i", "n"))).alias("m"))
    array = F.transform(F.sequence(F.lit(0), F.lit(len(templates) - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0)).cast("double"))
    return grouped.select(*keys, array.alias("features"))


def detect_window_anomalies(counts: DataFrame, template: str, keys: list[str], templates: list[str],
                            opts: ForestOptions = ForestOptions(contamination=0.05)) -> tuple[DataFrame, ForestModel]:
    """(windows with anomaly_score and is_anomaly, the forest) from long window counts."""
    matrix = window_matrix(counts, template, keys, templates)
    model = fit_forest(matrix, keys, opts=opts)
    return model.predict(matrix).drop("features"), model


def window_alerts(scored: DataFrame, counts: DataFrame, template: str, keys: list[str], n: int = 3) -> DataFrame:
    """Top templates of each anomalous window."""
    flagged = scored.filter(F.col("is_anomaly") == 1).select(*keys, "anomaly_score")
    return top_templates(counts, template, n, keys).join(flagged, keys)


def save_template_model(spark: SparkSession, model: ForestModel, templates: list[str], path: str) -> None:
    """Forest with the template list its features stand for."""
    model.save(spark, f"{path}/forest")
    spark.createDataFrame([(json.dumps(templates),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/templates")


def score_with_saved(spark: SparkSession, counts: DataFrame, template: str, keys: list[str], path: str) -> DataFrame:
    """Score new template counts with a saved forest; templates it has not seen are ignored."""
    templates = json.loads(spark.read.text(f"{path}/templates").first()["value"])
    return ForestModel.load(spark, f"{path}/forest").predict(window_matrix(counts, template, keys, templates)).drop("features")
