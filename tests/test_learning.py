import numpy as np
import pytest
from pyspark.sql import functions as F

from loomlog.operators import aggregates as agg
from loomlog.operators import features as feat
from loomlog.operators import templates as tpl
from loomlog.operators import evaluation
from loomlog.operators.forest import ForestModel, fit_forest, offsets_for
from loomlog.options import ForestOptions, TemplateOptions
from loomlog.plans import training, unsupervised

ENT = [("A", "t1", "error foo", 200, 100, "/a"), ("A", "t2", "warn bar", 404, 200, "/b"),
       ("B", "t1", "error foo", 200, 150, "/a"), ("B", "t3", "info baz", 500, 300, "/c")]


def test_entity_fixture(spark):
    df = spark.createDataFrame(ENT, "entity_id string, template_id string, message string, status int, bytes int, path string")
    got = {r["entity_id"]: r for r in agg.entity_aggregates(df).collect()}
    assert got["A"]["bytes_sum"] == 300 and round(got["A"]["bytes_std"], 4) == 70.7107 and got["B"]["path_nunique"] == 2
    counts = {r["entity_id"]: (r["t1"], r["t2"], r["t3"]) for r in agg.entity_template_counts(df).collect()}
    assert counts == {"A": (1, 1, 0), "B": (1, 0, 1)}
    vectors = {r["entity_id"]: (r["features"]["indices"], r["features"]["values"]) for r in agg.entity_template_vectors(df).collect()}
    assert vectors == {"A": ([0, 1], [1.0, 1.0]), "B": ([0, 2], [1.0, 1.0])}


def test_tfidf_vector_and_long_form_agree(spark):
    df = spark.createDataFrame([(1, "Error foo foo bar"), (2, "warn bar"), (3, "é été x")], "id int, t string")
    model = feat.fit_tfidf(df, None, "t", 100)
    long = {(r["id"], r["term"]): r["weight"] for r in model.weights(df, "id", "t").collect()}
    assert set(k[1] for k in long) == {"error", "foo", "bar", "warn", "été"}
    vec = {r["id"]: r["v"] for r in model.vectors(df, F.col("t"), "v").collect()}
    for (i, term), w in long.items():
        assert abs(vec[i][model.terms.index(term)] - w) < 1e-9
    assert abs(sum(w * w for (i, _), w in long.items() if i == 1) - 1) < 1e-9
    assert feat.fit_tfidf(df, "id", "t", 100) == model


def test_constant_columns_scale_to_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    rows = feat.fit_minmax(df, ["a", "b"]).transform(df).collect()
    assert [tuple(r) for r in rows] == [(0.0, 0.0), (1.0, 0.0)]


def test_unseen_values_and_bad_numbers(spark):
    train = spark.createDataFrame([(1, "tcp", 1.0), (2, "udp", 3.0)], "id int, proto string, n double")
    model = feat.fit_flow_featurizer(train, ["id"])
    new = spark.createDataFrame([(3, "icmp", float("inf"))], "id int, proto string, n double")
    assert model.transform(new).first()["features"].toArray().tolist() == [0.0, 0.0, 0.0]
    assert model.transform(train).filter("id = 2").first()["features"].toArray().tolist() == [0.0, 1.0, 3.0]


def test_any_number_of_categories(spark):
    rows = spark.range(200_000).select("id", F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("c"))
    some = feat.fit_categories(rows, ["c"])
    assert some.sizes == {"c": 200_000}
    new = spark.createDataFrame([(1, "v000007"), (2, "unseen"), (3, None), (4, "v199999")], "id long, c string")
    got = {r["id"]: r["c_vec"] for r in feat.one_hot(new, some).collect()}
    assert all(v.size == 200_000 for v in got.values())
    assert {k: list(v.indices) for k, v in got.items()} == {1: [7], 2: [], 3: [], 4: [199_999]}
    counts = agg.entity_template_vectors(rows.withColumn("e", F.col("id") % 3), None, "e", "c").select("e", F.size("features.indices"))
    assert sorted(map(tuple, counts.collect())) == [(0, 66_667), (1, 66_667), (2, 66_666)]


def test_stop_words_are_those_spark_loads(spark):
    from loomlog import fixed_values as fv
    from pyspark.ml.feature import StopWordsRemover
    assert fv.ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_sparse_and_dense_rows_grow_the_same_forest(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 12)) * (rng.random((300, 12)) < 0.3)
    dense = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(x)], "id long, features array<double>")
    kept = [(k, [int(i) for i in np.flatnonzero(row)], row[row != 0].tolist()) for k, row in enumerate(x)]
    sparse = spark.createDataFrame(kept, "id long, i array<int>, v array<double>").select(
        "id", F.struct(F.col("i").alias("indices"), F.col("v").alias("values")).alias("features"))
    opts = ForestOptions(trees=15)
    one, two = fit_forest(dense, ["id"], opts=opts), fit_forest(sparse, ["id"], opts=opts)
    assert one.nodes.equals(two.nodes) and one.offset == two.offset
    scores = [{r["id"]: r["s"] for r in m.with_scores(df, name="s").collect()} for m, df in ((one, dense), (two, sparse), (one, sparse))]
    assert scores[0] == scores[1] == scores[2]


def test_training_makes_features_of_drawn_rows_only(spark):
    rows = spark.range(5_000).select("id", F.col("id").cast("double").alias("x"))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def feature(x):
        seen.add(1)
        return [x]
    fit_forest(rows, ["id"], opts=ForestOptions(trees=4, sample_size=64), calibrate=False, transform=lambda d: d.withColumn("features", feature("x")))
    assert 256 <= seen.value <= 2 * 256


def test_templates_of_a_large_group_in_parts(spark, monkeypatch):
    monkeypatch.setattr(tpl, "GROUP_TEXTS", 10)
    rows = [f"opened door{a} in hall{b} by {c} today" for a, b, c in ((k % 40, k % 7, "abcdefgh"[k % 8]) for k in range(280))]
    rows += [f"opened {k}x and closed {k}y at night then" for k in "abcdefghijklmnopqrstuvwxyz"]
    df, seen = spark.createDataFrame([(k, m) for k, m in enumerate(rows)], "id int, message string"), []
    for parts in (1, 4, 16):
        mined = tpl.mine_templates(df.repartition(parts), "message")
        assert mined.filter(~tpl.fits(tpl.tokens_of(F.col("message")), F.col("template"))).count() == 0
        seen.append({(r["id"], r["template"]) for r in mined.collect()})
    assert seen[0] == seen[1] == seen[2]
    assert {t for _, t in seen[0]} == {"opened <*> in <*> by <*> today", "opened <*> and closed <*> at night then"}


def _messages(spark):
    rows = [f"Disk usage at {i}% on server{1 + i % 2}" for i in range(20)] + [f"user u{i} logged in" for i in range(30)] + ["single"]
    return spark.createDataFrame(list(enumerate(rows)), "line_id int, message string")


def test_templates_fit_and_do_not_depend_on_partitioning(spark):
    df = _messages(spark)
    results = []
    for parts in (1, 4, 16):
        mined = tpl.mine_templates(df.repartition(parts), "message", TemplateOptions(similarity=0.5))
        assert mined.count() == 51
        assert mined.filter(~tpl.fits(tpl.tokens_of(F.col("message")), F.col("template"))).count() == 0
        results.append({(r["line_id"], r["template_id"], r["template"], tuple(r["params"])) for r in mined.collect()})
    assert results[0] == results[1] == results[2]
    names = {r[2] for r in results[0]}
    assert names == {"Disk usage at <*> on <*>", "user <*> logged in", "single"}


def test_two_readings_of_one_server_share_a_template(spark):
    df = spark.createDataFrame([(1, "Disk usage at 91% on server1"), (2, "Disk usage at 95% on server1")], "line_id int, message string")
    got = tpl.mine_templates(df, "message").select("template", "params").collect()
    assert {r["template"] for r in got} == {"Disk usage at <*> on server1"} and sorted(r["params"][0] for r in got) == ["91%", "95%"]


def test_templates_do_not_depend_on_other_data_or_partitioning(spark):
    own = [f"opened {'abc'[i % 3]} door{chr(97 + i % 26)}{chr(97 + i // 26)} now" for i in range(60)]
    other = [f"job{i % 7} {'x ' * (i % 5)}ran by user{i % 1000} step {i}" for i in range(6000)]
    alone = spark.createDataFrame([(m,) for m in own], "message string")
    mixed = spark.createDataFrame([(m,) for m in own + other], "message string")
    for df in (alone, alone.repartition(5), mixed, mixed.repartition(9)):
        mined = tpl.mine_templates(df, "message")
        assert {r.template for r in mined.filter("message like 'opened%'").select("template").distinct().collect()} == {"opened <*> <*> now"}
        assert mined.filter(~tpl.fits(tpl.tokens_of(F.col("message")), F.col("template"))).count() == 0


def _cloud(spark, n=600):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(n)] + [(n + i, [9.0 + i, -9.0, 9.0, 9.0]) for i in range(5)]
    return spark.createDataFrame(rows, "id long, features array<double>")


def test_forest_ranks_planted_outliers_first_on_any_partitioning(spark):
    df, seen = _cloud(spark), []
    for parts in (1, 4, 16):
        model = fit_forest(df.repartition(parts), ["id"], opts=ForestOptions(trees=30, contamination=0.05))
        rows = model.with_scores(df).select("id", "iso_score").orderBy(F.desc("iso_score")).collect()
        assert all(0 < r["iso_score"] < 1 for r in rows)
        assert {r["id"] for r in rows[:5]} == {600, 601, 602, 603, 604}
        seen.append([(r["id"], round(r["iso_score"], 12)) for r in rows])
    assert seen[0] == seen[1] == seen[2]


def test_forest_contamination_and_save(spark, tmp_path):
    df = _cloud(spark)
    model = fit_forest(df, ["id"], opts=ForestOptions(trees=20, contamination=0.1))
    assert abs(model.predict(df).filter("is_anomaly = 1").count() - 61) <= 1
    assert model.nodes.groupby("tree").size().max() <= 2 * 256 - 1
    model.save(spark, str(tmp_path / "m"))
    back = ForestModel.load(spark, str(tmp_path / "m"))
    a, b = (m.predict(df).agg(F.sum("anomaly_score")).first()[0] for m in (model, back))
    assert abs(a - b) < 1e-9


def _logs(spark, n=240):
    levels = ["INFO", "INFO", "INFO", "WARN", "ERROR"]
    rows = [(i, levels[i % 5], f"m{i % 3}", f"Failed password for user u{i} from 8.8.8.8" if i % 5 > 2 else f"cache warm {i}", f"set{i % 2}") for i in range(n)]
    return spark.createDataFrame(rows, "line_id long, log_level string, module string, message string, source_file string")


def test_supervised_training_and_saved_scoring(spark, tmp_path):
    logs = _logs(spark)
    model, report = training.train_log_model(logs, kind="supervised", max_terms=30)
    rows = {r["class"]: r for r in report.collect()}
    assert rows["1"]["f1"] > 0.95 and rows["1"]["support"] == 24
    model.save(spark, str(tmp_path / "m"))
    again = training.LogModel.load(spark, str(tmp_path / "m"))
    unseen = logs.withColumn("module", F.lit("never seen")).withColumn("log_level", F.lit(None).cast("string"))
    assert training.score_logs(again, unseen).filter("status = 'ANOMALY'").count() > 0
    per_source = training.evaluate_by_source(again, logs)
    assert {r["source_file"]: r["total"] for r in per_source.collect()} == {"set0": 120, "set1": 120}


def _fold_by_fold(logs, cuts, trees, **options):
    """The plain way: fit, calibrate and evaluate a model for each source."""
    out, labelled = {}, training.with_label(logs)
    for held in sorted(r[0] for r in logs.select("source_file").distinct().collect()):
        train = labelled.filter(F.col("source_file") != held)
        featurizer = feat.fit_log_featurizer(train, **options)
        model = fit_forest(train, ["line_id"], opts=ForestOptions(trees=trees), calibrate=False, transform=featurizer.transform)
        offsets = offsets_for(model, featurizer.transform(train), cuts)
        scored = model.with_scores(featurizer.transform(labelled.filter(F.col("source_file") == held))).select("y", "iso_score").collect()
        for c in cuts:
            pairs = [(r["y"], int(-r["iso_score"] < offsets[c])) for r in scored]
            tp, fp, fn = (sum(p == x for p in pairs) for x in ((1, 1), (0, 1), (1, 0)))
            out[held, c] = (2 * tp / (2 * tp + fp + fn) if tp else 0.0, sum(a == b for a, b in pairs) / len(pairs))
    return out


def test_leave_one_out_in_one_job_is_fold_by_fold(spark):
    logs, cuts = _logs(spark).withColumn("source_file", F.concat(F.lit("set"), (F.col("line_id") % 7 % 3).cast("string"))), [0.1, 0.3]
    logs = logs.withColumn("module", F.concat("module", F.when(F.col("source_file") == "set1", "own").otherwise("")))
    got = training.leave_one_out(logs, contaminations=cuts, trees=10, max_terms=20)
    found = {(r["test_dataset"], r["contamination"]): (round(r["f1_anomaly"], 9), round(r["accuracy"], 9)) for r in got.collect()}
    want = _fold_by_fold(logs, cuts, 10, max_terms=20)
    assert found == {k: (round(a, 9), round(b, 9)) for k, (a, b) in want.items()} and len(found) == 6
    best = evaluation.best_by_mean_f1(got).first()
    means = {c: sum(f for (_, x), (f, _) in want.items() if x == c) / 3 for c in cuts}
    assert best["contamination"] == max(means, key=lambda c: (means[c], -c)) and abs(best["mean_f1"] - max(means.values())) < 1e-9


def test_grouped_quantiles(spark):
    from loomlog.operators.quantiles import grouped_quantiles
    rng = np.random.default_rng(8)
    groups = {"a": rng.normal(size=1), "b": rng.integers(0, 4, 300).astype(float), "c": rng.normal(size=5_000)}
    df = spark.createDataFrame([(k, float(v)) for k, x in groups.items() for v in x] + [("a", None)], "k string, v double")
    got = {(r["k"], r["prob"]): r["value"] for r in grouped_quantiles(df.repartition(7), "k", "v", [0.0, 0.05, 0.5, 0.99, 1.0]).collect()}
    assert len(got) == 15
    for (k, p), v in got.items():
        assert abs(v - np.quantile(groups[k], p)) < 1e-12


def test_flow_model(spark, tmp_path):
    rows = [(str(i), "tcp" if i % 2 else "udp", float(i % 7), "benign") for i in range(200)] + [(f"x{i}", "icmp", 5000.0, "Attack") for i in range(4)]
    flows = spark.createDataFrame(rows, "id string, proto string, n double, label string")
    model = training.train_flow_model(flows, "ctu", ["id"], trees=20)
    matrix, report = training.evaluate_flow_model(model, flows)
    assert matrix.agg(F.sum("n")).first()[0] == 204 and report.count() == 5
    model.save(spark, str(tmp_path / "f"))
    assert training.FlowModel.load(spark, str(tmp_path / "f")).predict(flows).count() == 204
    assert feat.prefer_normal(flows.filter("label = 'Attack'"), "label", "words").count() == 4


def test_line_run(spark):
    rows = [(i, f"2024-01-01 00:00:{i % 60:02d},000 INFO [Network] packet {i}") for i in range(80)]
    rows += [(100, "2024-01-01 00:00:01,000 ERROR [Disk] failure panic"), (101, "ERROR [HealthCheck] PASSED CPU: 99%, Memory: 98%")]
    run = unsupervised.detect_line_anomalies(spark.createDataFrame(rows, "line_id int, line string"), forest=ForestOptions(trees=20))
    flags = {r["line_id"]: r["is_anomaly"] for r in run.scored.collect()}
    assert flags[100] == 1 and flags[101] == 0 and run.contamination in unsupervised.CONTAMINATIONS
    assert run.critical.filter("line_id = 100").count() == 1 and run.timeline().filter("line_id = 100").count() == 1
    assert run.sweep.count() == 3


def test_window_run_and_saved_templates(spark, tmp_path):
    rows = [(w, t, 1 + (w * 7 + i) % 3) for w in range(60) for i, t in enumerate(("a", "b", "c"))] + [(99, "a", 500)]
    counts = spark.createDataFrame(rows, "w long, template string, n long")
    scored, model = unsupervised.detect_window_anomalies(counts, "template", ["w"], ["a", "b", "c"])
    assert scored.orderBy("anomaly_score").first()["w"] == 99
    alerts = unsupervised.window_alerts(scored, counts, "template", ["w"])
    assert alerts.filter("w = 99").count() == 1
    unsupervised.save_template_model(spark, model, ["a", "b", "c"], str(tmp_path / "t"))
    new = counts.unionByName(spark.createDataFrame([(99, "unseen", 3)], "w long, template string, n long"))
    assert unsupervised.score_with_saved(spark, new, "template", ["w"], str(tmp_path / "t")).count() == 61


@pytest.mark.parametrize("name, trees", [
    ("logreg_anomaly", None), ("forest_on_logs", 200), ("evaluate_by_source", 200), ("saved_model_scores", 200),
    ("stream_score", 200), ("flow_iforest", 100), ("line_anomalies", 100),
])
def test_registered_queries_learn_at_full_size(spark, monkeypatch, name, trees):
    from loomlog.catalog import QUERIES

    class Stop(Exception):
        pass

    def stop(*args, opts=None, **kwargs):
        seen["trees"] = opts.trees if opts else None
        raise Stop

    def featurizer(df, max_terms=5000, min_docs=2, **options):
        seen["terms"] = (max_terms, min_docs)
        return real(df, max_terms, min_docs, **options)

    seen, real = {}, training.fit_log_featurizer
    monkeypatch.setattr(training, "fit_log_featurizer", featurizer)
    monkeypatch.setattr(training, "fit_logistic", stop)
    monkeypatch.setattr(unsupervised, "fit_forest", stop)
    monkeypatch.setattr(training, "fit_forest", stop)
    with pytest.raises(Stop):
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert seen["trees"] == trees
    assert seen.get("terms", (5000, 2)) == (5000, 2)


def test_registered_folds_learn_at_full_size(spark, monkeypatch):
    import inspect

    from loomlog.catalog import QUERIES
    from loomlog.plans import folds

    seen = []
    monkeypatch.setattr(folds, "leave_one_out", lambda rows, source, **options: seen.append(options))
    QUERIES["leave_one_out"](spark, "/root/testdata/sf0.001")
    monkeypatch.undo()
    defaults = {k: p.default for k, p in inspect.signature(folds.leave_one_out).parameters.items()}
    assert seen == [{}] and folds.CONTAMINATIONS == [0.05, 0.10, 0.15, 0.20]
    assert (defaults["trees"], defaults["max_terms"], defaults["min_docs"], defaults["bigrams"]) == (100, 5000, 2, True)
