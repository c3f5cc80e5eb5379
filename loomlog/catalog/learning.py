"""Queries that mine, train, score, stream, report and read files back."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog import streaming
from loomlog.catalog.forest_sql import forest, log_features, report
from loomlog.catalog.measures import _NUM
from loomlog.catalog.registry import SQL, query
from loomlog.catalog.entities import actions_sql, threat_sql
from loomlog.catalog.sql import any_has, frm, lit, union
from loomlog.catalog.template_sql import mined
from loomlog.catalog.tags import _LINE_SEV, _PASSED, _TEXT, _keyword_sql, _reason_sql, _usage, classify
from loomlog.catalog.web import ACCESS, OPTS, _counters_sql, _signals
from loomlog.checkpoints import fresh_path
from loomlog.operators import aggregates as agg
from loomlog.operators import evaluation
from loomlog.operators import templates as tpl
from loomlog.operators import windows
from loomlog.operators.forest import fit_forest
from loomlog.options import COMPACT_TEMPLATES, ForestOptions, ReportOptions, TemplateOptions
from loomlog.plans import reports, training, unsupervised
from loomlog.sources import readers, sinks
from loomlog.sources.views import VIEWS, geo_ranges, render, reputation, reputation_sql, spread, table, view

APP = frm("app_log")


# ---------------------------------------------------------------- templates

_MINED = mined(f"SELECT line_id AS id, message FROM {APP}", TemplateOptions().similarity)


@query("mine_templates", f"WITH {_MINED} SELECT array_to_string(template, ' ') AS template, count(*) AS n FROM mined GROUP BY 1")
def mine_templates(spark, d):
    """Templates of the application log with their row counts."""
    found = tpl.mine_templates(view(spark, d, "app_log").select("line_id", "message"), "message")
    return found.groupBy("template").agg(F.count(F.lit(1)).alias("n"))


@query("template_params", f"WITH {_MINED} SELECT id AS line_id, array_to_string(template, ' ') AS template,"
       " array_to_string(list_transform(list_filter(range(1, len(tokens) + 1), lambda i: template[i] = '<*>'), lambda i: tokens[i]), '|') AS params FROM mined")
def template_params(spark, d):
    """Every message's template and the values under its wildcards."""
    found = tpl.mine_templates(view(spark, d, "app_log").select("line_id", "message"), "message")
    return found.select("line_id", "template", F.array_join("params", "|").alias("params"))


@query("document_line_templates", "SELECT count(*) AS lines, count(*) AS fitting FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE len(list_filter(regexp_split_to_array(line, '[ \\t\\n\\v\\f\\r]+'), lambda t: t <> '')) > 0")
def document_line_templates(spark, d):
    """Whole document texts as lines: every non-blank line gets a template it fits."""
    lines = spread(table(spark, d, "documents"), "doc_id").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.filter(F.size(tpl.tokens_of(F.col("line"))) > 0)
    mined = tpl.mine_templates(lines, "line", COMPACT_TEMPLATES)
    tokens = tpl.tokens_of(F.col("line"), COMPACT_TEMPLATES)
    fits, blank = tpl.fits(tokens, F.col("template")), tpl.clean_text(F.col("line"), COMPACT_TEMPLATES) == ""
    return mined.agg(F.count(F.lit(1)).alias("lines"), F.count_if(blank | fits).alias("fitting"))


@query("unique_templates", "SELECT DISTINCT p_name AS EventTemplate FROM part")
def unique_templates(spark, d):
    return tpl.unique_templates(table(spark, d, "part").withColumnRenamed("p_name", "EventTemplate"))


# ---------------------------------------------------------------- forests and models

_VECTORS = "SELECT vec_id::varchar AS id, unnest(range(len(embedding))) AS f, unnest(embedding)::double AS v FROM embeddings"


@query("iforest_scores", f"WITH {forest(_VECTORS, 'SELECT vec_id::varchar AS id FROM embeddings', 100, 0.1)}"
       " SELECT vec_id, round(-score - q, 6) AS anomaly_score, CAST(-score - q < 0 AS int) AS is_anomaly FROM embeddings JOIN scored ON scored.id = vec_id::varchar, cut")
def iforest_scores(spark, d):
    """Scores of vectors by a forest of 100 trees, and the tenth of them that is most isolated."""
    rows = table(spark, d, "embeddings")
    model = fit_forest(rows, ["vec_id"], "embedding", ForestOptions(contamination=0.1))
    out = model.predict(rows, "embedding")
    return out.select("vec_id", F.round("anomaly_score", 6).alias("anomaly_score"), "is_anomaly")


_HOURS = ("SELECT *, row_number() OVER (PARTITION BY w ORDER BY n DESC, event_type) AS rank FROM (SELECT w, event_type, count(*) AS n"
          " FROM (SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS w, event_type FROM events) GROUP BY w, event_type)")
_HOUR_COUNTS = (f"SELECT a.w AS id, k.f, coalesce(b.n, 0)::double AS v FROM (SELECT DISTINCT w FROM ({_HOURS})) a CROSS JOIN"
                " (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS f FROM (SELECT DISTINCT event_type FROM events)) k"
                f" LEFT JOIN ({_HOURS}) b ON a.w = b.w AND k.event_type = b.event_type")


@query("window_anomalies", f"WITH {forest(_HOUR_COUNTS, f'SELECT DISTINCT w AS id FROM ({_HOURS})', 100, 0.05)}"
       f" SELECT w AS window_start, event_type, n, CAST(rank AS int) AS rank, round(-score - q, 6) AS anomaly_score FROM ({_HOURS}) JOIN scored ON id = w, cut WHERE rank <= 3 AND -score - q < 0")
def window_anomalies(spark, d):
    """Forest over hourly event-type counts, with the top types of each anomalous hour."""
    counts = windows.aligned_window_counts(table(spark, d, "events"), "event_type", width="1 hour")
    kinds = [r[0] for r in counts.select("event_type").distinct().orderBy("event_type").collect()]
    scored, _ = unsupervised.detect_window_anomalies(counts, "event_type", ["window_start"], kinds)
    alerts = unsupervised.window_alerts(scored, counts, "event_type", ["window_start"])
    return alerts.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n", "rank", F.round("anomaly_score", 6).alias("anomaly_score"))


def rounded(report):
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


def _flows(spark, d):
    return spread(table(spark, d, "lineitem"), "l_orderkey").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int")).alias("id"), "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_linestatus", F.when(F.col("l_returnflag") == "N", "benign").otherwise("attack").alias("label"))


_FLOWS = ("(SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS int)) AS id, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus,"
          " CASE WHEN l_returnflag = 'N' THEN 'benign' ELSE 'attack' END AS label FROM lineitem)")
_FLOW_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_FLOW_POINTS = (
    f"SELECT id, (SELECT count(DISTINCT l_linestatus) FROM {_FLOWS} WHERE label = 'benign') + k AS f, v FROM (SELECT id, unnest(range(4)) AS k, unnest(["
    + ", ".join(f"{c}::double / (SELECT CASE WHEN stddev_pop({c}::double) > 0 THEN stddev_pop({c}::double) ELSE 1 END FROM {_FLOWS} WHERE label = 'benign')" for c in _FLOW_NUMBERS)
    + f"]) AS v FROM {_FLOWS}) UNION ALL SELECT a.id, k.f, CASE WHEN a.l_linestatus = k.s THEN 1.0::double ELSE 0 END FROM {_FLOWS} a CROSS JOIN"
    f" (SELECT s, row_number() OVER (ORDER BY s) - 1 AS f FROM (SELECT DISTINCT l_linestatus AS s FROM {_FLOWS} WHERE label = 'benign')) k")


@query("flow_iforest", f"WITH {forest(_FLOW_POINTS, f'SELECT id FROM {_FLOWS} WHERE label = ' + chr(39) + 'benign' + chr(39), 100, 0.02)},"
       + report(f"SELECT CASE WHEN label = 'benign' THEN 0 ELSE 1 END AS y, CASE WHEN -score - q < 0 THEN 1 ELSE 0 END AS pred FROM {_FLOWS} JOIN scored USING (id), cut"))
def flow_iforest(spark, d):
    """Forest on normal flows only; scores every flow and evaluates against the labels."""
    flows = _flows(spark, d)
    model = training.train_flow_model(flows, "ctu", ["id"])
    return rounded(training.evaluate_flow_model(model, flows)[1])


@query("logreg_anomaly")
def logreg_anomaly(spark, d):
    """Class-balanced logistic regression with a tuned threshold, reported on the held-out quarter."""
    logs = view(spark, d, "app_log").select("line_id", "log_level", "module", "message")
    return training.train_log_model(logs, kind="supervised")[1]


_Y = "CASE WHEN log_level IN (" + ", ".join(lit(x) for x in fv.ANOMALY_LEVELS) + ") THEN 1 ELSE 0 END"
_ALL_LOGS = f"SELECT line_id::varchar AS id, log_level, module, message, false AS held FROM {APP}"
_SPLIT_LOGS = (f"SELECT id, log_level, module, message, r <= ceil(n * 0.25) AS held FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5('42|' || id)) AS r,"
               f" count(*) OVER (PARTITION BY y) AS n FROM (SELECT line_id::varchar AS id, log_level, module, message, {_Y} AS y FROM {APP}))")


def _log_forest(logs: str, contamination: float) -> str:
    """CTEs that end in rated (id, log_level, held, y, pred)."""
    return (log_features(logs, _NUM, fv.ENGLISH_STOP_WORDS) + ",\n "
            + forest("SELECT id, f, v FROM points", "SELECT id FROM logs WHERE NOT held", 200, contamination, ids="SELECT id FROM logs")
            + f",\n rated AS MATERIALIZED (SELECT id, held, {_Y} AS y, CASE WHEN -score - q < 0 THEN 1 ELSE 0 END AS pred FROM logs JOIN scored USING (id), cut)")


@query("forest_on_logs", f"WITH {_log_forest(_SPLIT_LOGS, 0.15)}, " + report("SELECT y, pred FROM rated WHERE held"))
def forest_on_logs(spark, d):
    """A forest over log features, fitted on three quarters of the rows and reported on the rest."""
    logs = view(spark, d, "app_log").select("line_id", "log_level", "module", "message")
    return rounded(training.train_log_model(logs)[1])


def _sources(spark, d):
    source = F.concat(F.lit("set"), (F.col("line_id") % 3).cast("string"))
    return view(spark, d, "app_log").select("line_id", "log_level", "module", "message", source.alias("source_file"))


def _folds_sql() -> str:
    """test_dataset, contamination and scores: a forest on all other sources, for each of the three."""
    folds = []
    for k in range(3):
        logs = f"SELECT line_id::varchar AS id, log_level, module, message, line_id % 3 = {k} AS held FROM {APP}"
        grown = forest("SELECT id, f, v FROM points", "SELECT id FROM logs WHERE NOT held", 100, 0.05, ids="SELECT id FROM logs")
        cuts = union([f"SELECT {c}::double AS contamination, quantile_cont(-score, {c}::double) AS q FROM scored JOIN logs USING (id) WHERE NOT held" for c in training.CONTAMINATIONS])
        folds.append(f"""SELECT * FROM (WITH {log_features(logs, _NUM, fv.ENGLISH_STOP_WORDS)}, {grown}, cuts AS ({cuts})
 SELECT 'set{k}' AS test_dataset, contamination, {_Y} AS y, CASE WHEN -score < cuts.q THEN 1 ELSE 0 END AS pred FROM logs JOIN scored USING (id), cuts WHERE held)""")
    return f"""WITH r AS ({union(folds)}),
 n AS (SELECT test_dataset, contamination, count(*) FILTER (y = 1 AND pred = 1) AS tp, count(*) FILTER (y = 0 AND pred = 1) AS fp, count(*) FILTER (y = 1 AND pred = 0) AS fn,
  count(*) FILTER (y = 0 AND pred = 0) AS tn FROM r GROUP BY 1, 2),
 f AS (SELECT *, CASE WHEN tp = 0 THEN 0 ELSE 2.0::double * tp / (2 * tp + fp + fn) END AS f1, CASE WHEN tn = 0 THEN 0 ELSE 2.0::double * tn / (2 * tn + fp + fn) END AS f0,
  tp + fp + fn + tn AS total FROM n)
 SELECT test_dataset, contamination, round(f1, 6) AS f1_anomaly, round(CASE WHEN tp = 0 THEN 0 ELSE tp::double / (tp + fn) END, 6) AS recall_anomaly,
  round(CASE WHEN tp = 0 THEN 0 ELSE tp::double / (tp + fp) END, 6) AS precision_anomaly, round((tp + tn)::double / total, 6) AS accuracy,
  round((f1 * (tp + fn) + f0 * (tn + fp)) / total, 6) AS f1_weighted FROM f"""


@query("leave_one_out", _folds_sql())
def leave_one_out(spark, d):
    """Scores of each held-out source at every contamination."""
    out = training.leave_one_out(_sources(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("f1_anomaly", "recall_anomaly", "precision_anomaly", "accuracy", "f1_weighted")})


@query("best_contamination", f"SELECT contamination, round(avg(f1_anomaly), 5) AS mean_f1 FROM ({_folds_sql()}) GROUP BY 1 ORDER BY mean_f1 DESC, contamination LIMIT 1")
def best_contamination(spark, d):
    """The contamination with the best mean score over all held-out sources."""
    best = evaluation.best_by_mean_f1(leave_one_out(spark, d))
    return best.withColumn("mean_f1", F.round("mean_f1", 5))


_RATIO = "CASE WHEN {b} = 0 THEN 0 ELSE ({a})::double / ({b}) END"
_BY_SOURCE = ("SELECT 'set' || (id::bigint % 3) AS source_file, count(*) FILTER (y = 1 AND pred = 1) AS tp, count(*) FILTER (y = 0 AND pred = 1) AS fp,"
              " count(*) FILTER (y = 1 AND pred = 0) AS fn, count(*) FILTER (y = pred) AS ok, count(*) AS total FROM rated GROUP BY 1")
_PRECISION, _RECALL = _RATIO.format(a="tp", b="tp + fp"), _RATIO.format(a="tp", b="tp + fn")


@query("evaluate_by_source", f"WITH {_log_forest(_ALL_LOGS, 0.2)}, s AS ({_BY_SOURCE}) SELECT source_file, round(ok::double / total, 6) AS accuracy,"
       f" round(CASE WHEN tp = 0 THEN 0 ELSE 2.0::double * tp / (2 * tp + fp + fn) END, 6) AS f1_anomaly, round({_RECALL}, 6) AS recall_anomaly, round({_PRECISION}, 6) AS precision_anomaly,"
       " tp + fn AS true_anomalies, tp + fp AS predicted_anomalies, total FROM s")
def evaluate_by_source(spark, d):
    """Train on everything, then per-source accuracy, f1 and counts from one scoring pass."""
    logs = view(spark, d, "app_log").select("line_id", "log_level", "module", "message", F.concat(F.lit("set"), (F.col("line_id") % 3).cast("string")).alias("source_file"))
    model, _ = training.train_log_model(logs, test=logs, forest=ForestOptions(trees=200, contamination=0.2))
    out = training.evaluate_by_source(model, logs)
    return out.withColumns({c: F.round(c, 6) for c in ("accuracy", "f1_anomaly", "recall_anomaly", "precision_anomaly")})


@query("saved_model_scores", f"WITH {_log_forest(_ALL_LOGS, 0.10)} SELECT CASE pred WHEN 1 THEN 'ANOMALY' ELSE 'NORMAL' END AS status, count(*) AS n FROM rated GROUP BY 1")
def saved_model_scores(spark, d):
    """Train, save, load and score: ANOMALY / NORMAL counts."""
    logs = view(spark, d, "app_log").select("line_id", "log_level", "module", "message")
    path = fresh_path(spark, "model")
    training.train_all_and_save(spark, logs, path)
    scored = training.score_logs(training.LogModel.load(spark, path), logs)
    return scored.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def _line_run_sql() -> str:
    """The per-line run: features, forest, the contamination with the best f1 against the rules, and the rules on top."""
    event = "regexp_extract(line, '\\[(.*?)\\]', 1)"
    stops = ", ".join(lit(w) for w in fv.ENGLISH_STOP_WORDS)
    severe = "(kw >= 2 OR sev IN ('WARN', 'ERROR'))"
    features = f"""signals AS MATERIALIZED (SELECT line_id::varchar AS id, line, array_to_string(template, ' ') AS template, {_LINE_SEV} AS sev, {event} AS ev, {_keyword_sql('line')} AS kw,
  {_usage('CPU')} AS cpu, {_usage('Memory')} AS mem, {_PASSED} AS passed FROM {APP} JOIN mined ON mined.id = line_id),
 kinds AS (SELECT 1 AS k, template AS v FROM signals GROUP BY template UNION ALL SELECT 2, sev FROM signals GROUP BY sev UNION ALL SELECT 3, ev FROM signals GROUP BY ev),
 places AS (SELECT k, v, row_number() OVER (ORDER BY k, v) - 1 AS f FROM kinds),
 base AS (SELECT (SELECT count(*) FROM kinds) AS b),
 tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(list_filter(regexp_extract_all(lower(line), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda x: x NOT IN ({stops}))) AS term FROM signals) GROUP BY 1, 2),
 vocabulary AS (SELECT term, df, row_number() OVER (ORDER BY n DESC, term) - 1 AS f FROM (SELECT term, sum(tf) AS n, count(*) AS df FROM tf GROUP BY term ORDER BY n DESC, term LIMIT 20)),
 weighed AS (SELECT id, f, tf * (ln((1.0 + (SELECT count(*) FROM signals)) / (1.0 + df)) + 1.0) AS w FROM tf JOIN vocabulary USING (term)),
 numbers AS (SELECT id, unnest([0, 1, 2, 3]) AS j, unnest([count(*) OVER (PARTITION BY ev)::double, kw::double,
   coalesce((cpu - min(cpu) OVER ()) / nullif(max(cpu) OVER () - min(cpu) OVER (), 0), 0), coalesce((mem - min(mem) OVER ()) / nullif(max(mem) OVER () - min(mem) OVER (), 0), 0)]) AS v FROM signals),
 points AS (SELECT id, f, 1.0::double AS v FROM signals JOIN places ON (k = 1 AND v = template) OR (k = 2 AND v = sev) OR (k = 3 AND v = ev)
  UNION ALL SELECT id, b + j, v FROM numbers, base UNION ALL SELECT id, b + 4 + f, w / sqrt(sum(w * w) OVER (PARTITION BY id)) FROM weighed, base)"""
    cuts = union([f"SELECT {i} AS place, quantile_cont(-score, {c}::double) AS q FROM scored" for i, c in enumerate(unsupervised.CONTAMINATIONS)])
    return f"""WITH {mined(f"SELECT line_id AS id, line AS message FROM {APP}", TemplateOptions().similarity)}, {features},
 {forest("SELECT id, f, v FROM points", "SELECT id FROM signals", 100, 0.2, ids="SELECT id FROM signals")}, cuts AS ({cuts}),
 judged AS (SELECT place, sum(CASE WHEN {severe} AND NOT passed AND hit THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN NOT ({severe} AND NOT passed) AND hit THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN {severe} AND NOT passed AND NOT hit THEN 1 ELSE 0 END) AS fn FROM (SELECT *, -score < cuts.q AND NOT passed AS hit FROM signals JOIN scored USING (id), cuts) GROUP BY place),
 chosen AS (SELECT cuts.q AS best FROM cuts JOIN (SELECT place FROM judged ORDER BY CASE WHEN tp = 0 THEN 0 ELSE round(2.0 * tp / (2 * tp + fp + fn), 12) END DESC, place LIMIT 1) USING (place))
 SELECT severity, event_type, is_anomaly, benign, count(*) AS n FROM (SELECT sev AS severity, ev AS event_type, CASE WHEN passed THEN 0 WHEN -score - best < 0 OR {severe} THEN 1 ELSE 0 END AS is_anomaly,
  sev = 'INFO' AND ev IN ({", ".join(lit(x) for x in fv.BENIGN_EVENT_TYPES)}) AND count(*) OVER (PARTITION BY ev) > 1 AS benign FROM signals JOIN scored USING (id), chosen) GROUP BY ALL"""


@query("line_anomalies", _line_run_sql())
def line_anomalies(spark, d):
    """The whole per-line run; rows by severity, event type and verdict."""
    run = unsupervised.detect_line_anomalies(view(spark, d, "app_log").select("line_id", "line"))
    return run.scored.groupBy("severity", "event_type", "is_anomaly", "benign").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- streams

def _events_stream(spark, d):
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


def _stream_view(spark, d, name):
    return _events_stream(spark, d).select(*[F.expr(render(e, True)).alias(c) for c, e in VIEWS[name].items()])


def _text(df):
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


_FINAL = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 MINUTE FROM {0})"
_W = "strftime(w, '%Y-%m-%d %H:%M:%S')"


@query("stream_ip_rate", f"SELECT {_W} AS window_start, ip, n FROM (SELECT date_trunc('minute', ts) AS w, ip, count(*) AS n FROM {ACCESS} GROUP BY 1, 2) WHERE n >= 2 AND w + INTERVAL 1 MINUTE <= {_FINAL.format(ACCESS)}")
def stream_ip_rate(spark, d):
    """Minutes that are final by the end of the stream; the last two minutes are still open."""
    out = streaming.ip_rate_offenders(_stream_view(spark, d, "access_log"), 2)
    return _text(streaming.run_available(out, "ip-rate"))


_HITS = f"(SELECT * FROM {ACCESS} WHERE {_signals()['bruteforce_events']})"


@query("stream_bruteforce", f"SELECT {_W} AS window_start, ip, n AS failures FROM (SELECT date_trunc('hour', ts) - to_hours(k) AS w, ip, count(*) AS n FROM {_HITS}, (SELECT unnest(range(0, 12)) AS k) GROUP BY 1, 2) WHERE n >= 2 AND w + INTERVAL 12 HOUR <= {_FINAL.format(_HITS)}")
def stream_bruteforce(spark, d):
    """Failed logins per address in twelve-hour windows that slide by the hour, two or more."""
    out = streaming.bruteforce_bursts(_stream_view(spark, d, "access_log"), OPTS.replace(bruteforce_threshold=2), window="12 hours", slide="1 hour")
    return _text(streaming.run_available(out, "bruteforce"))


@query("stream_template_counts", f"SELECT {_W} AS window_start, template, n FROM (SELECT date_trunc('minute', ts) AS w, 'event ' || event_type AS template, count(*) AS n FROM events GROUP BY 1, 2) WHERE w + INTERVAL 1 MINUTE <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 MINUTE FROM events)")
def stream_template_counts(spark, d):
    kinds = table(spark, d, "events").select("event_type").distinct()
    templates = kinds.select("event_type", F.concat(F.lit("event "), "event_type").alias("template"))
    out = streaming.template_counts(_events_stream(spark, d), templates, "event_type")
    return _text(streaming.run_available(out, "templates"))


@query("stream_parse_tag", f"SELECT line_id, status, path, parsed FROM ({SQL['parse_apache_combined']})")
def stream_parse_tag(spark, d):
    lines = _stream_view(spark, d, "raw_lines").select("line_id", "value")
    out = streaming.parse_and_tag(lines, "apache_combined").select("line_id", "status", "path", "parsed")
    return streaming.run_available(out, "parsed")


@query("stream_score", f"WITH {_log_forest(_ALL_LOGS, 0.2)} SELECT pred, count(*) AS n FROM rated GROUP BY 1")
def stream_score(spark, d):
    """Score a stream of log rows with a model fitted on the table."""
    logs = view(spark, d, "app_log").select("line_id", "log_level", "module", "message")
    model, _ = training.train_log_model(logs, test=logs, forest=ForestOptions(trees=200, contamination=0.2))
    stream = _stream_view(spark, d, "app_log").select("line_id", "log_level", "module", "message")
    out = streaming.score(stream, model).select("line_id", "pred")
    return streaming.run_available(out, "scored").groupBy("pred").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- reports

REPORT = ReportOptions(web=OPTS, custom_categories=fv.DOMAIN_CATEGORIES)


@query("report_sections", union([
    f"SELECT 'parsing' AS section, 1 AS ord, 'total_logs' AS key, CAST(count(*) AS varchar) AS value FROM {ACCESS}",
    f"SELECT 'methods', row_number() OVER (ORDER BY n DESC, method), method, CAST(n AS varchar) FROM ({SQL['method_counts']})",
    f"SELECT 'paths', row_number() OVER (ORDER BY n DESC, path), path, CAST(n AS varchar) FROM ({SQL['top_paths']})",
    f"SELECT 'signals', row_number() OVER (ORDER BY counter), counter, CAST(n AS varchar) FROM (SELECT * FROM ({_counters_sql()}) WHERE n > 0)",
    f"SELECT 'top_suspicious_paths', row_number() OVER (ORDER BY n DESC, path), path, CAST(n AS varchar) FROM ({SQL['top_suspicious_paths']})",
    f"SELECT 'top_malicious_agents', row_number() OVER (ORDER BY n DESC, user_agent), user_agent, CAST(n AS varchar) FROM ({SQL['top_malicious_ua']})",
    f"SELECT 'top_large_paths', row_number() OVER (ORDER BY bytes DESC, path), path, CAST(bytes AS varchar) FROM ({SQL['top_large_paths']})",
    f"SELECT 'bruteforce_ips', row_number() OVER (ORDER BY failures DESC, ip), ip, CAST(failures AS varchar) FROM ({SQL['bruteforce_offenders']})",
]))
def report_sections(spark, d):
    """The counting sections of the standard report over the access log."""
    df = view(spark, d, "access_log").drop("ts")
    wanted = ["methods", "paths", "signals", "top_suspicious_paths", "top_malicious_agents", "top_large_paths", "bruteforce_ips"]
    parts = reports.standard_sections(df, REPORT)
    total = parts["parsing"].filter("key = 'total_logs'")
    return reports.combined({"parsing": total, **{k: parts[k] for k in wanted}})


_RULES = {**fv.BASELINE_CATEGORIES, **fv.DOMAIN_CATEGORIES}
_A = "a AS (SELECT *, " + ", ".join(f'{any_has(chr(34) + "Content" + chr(34), pats, True)} AS "c_{n}"' for n, pats in _RULES.items()) + f" FROM {frm('auth_log')})"
_FLAGGED = " OR ".join(f'"c_{n}"' for n in ("authentication_errors", "linux_auth_errors") if n in _RULES)
_CATS = "cats AS (" + union([f"SELECT {lit(n)} AS category, {i} AS ord, count(*) FILTER (\"c_{n}\") AS n, count(*) AS total FROM a" for i, n in enumerate(_RULES)]) + ")"


def _attackers(where: str, name: str) -> str:
    return f"{name} AS (SELECT ip, count(*) AS n FROM a WHERE ({where}) AND ip IS NOT NULL GROUP BY ip ORDER BY n DESC, ip LIMIT 10)"


def _standard_sql() -> str:
    texts = fv.RECOMMENDATION_TEXTS
    before, after = texts["block_top_ip"].split("{ip}")
    rich = (f"rich AS (SELECT t.ip, t.n AS events, r.abuse_score, t.n * r.abuse_score AS risk FROM (SELECT * FROM top ORDER BY n DESC, ip LIMIT {REPORT.enrich.top_n}) t"
            f" LEFT JOIN {reputation_sql()} r ON t.ip = r.ip)")
    best = "(SELECT ip FROM top ORDER BY n DESC, ip LIMIT 1)"
    advice = union([f"SELECT 0 AS o, {lit(before)} || {best} || {lit(after)} AS t WHERE {best} IS NOT NULL", f"SELECT 1, {lit(texts['fail2ban'])} WHERE {best} IS NOT NULL",
                    f"SELECT 6, {lit(texts['auth'])} WHERE (SELECT n FROM cats WHERE category = 'authentication_errors') > 0 OR {'true' if 'linux_auth_errors' in _RULES else 'false'}"])
    one = "(SELECT ip, n, sum(n) OVER () AS total, count(*) OVER () AS ips, row_number() OVER (ORDER BY n DESC, ip) AS r FROM top)"
    return f"WITH {_A}, {_CATS}, {_attackers(_FLAGGED, 'top')}, {rich} " + union([
        "SELECT 'parsing' AS section, 1 AS ord, 'total_logs' AS key, CAST(count(*) AS varchar) AS value FROM a",
        "SELECT 'parsing', 2, 'sample_message', min_by(\"Content\", line_id) FROM a",
        "SELECT 'errors', row_number() OVER (ORDER BY n DESC, ord), category, n || '|' || round(n * 100.0 / total, 2) FROM cats WHERE n > 0",
        f"SELECT 'levels', row_number() OVER (ORDER BY level), level, CAST(n AS varchar) FROM ({SQL['level_fallback_counts']})",
        f"SELECT 'performance', 1, 'alerts_flagged', CAST(count(*) AS varchar) FROM a WHERE {_FLAGGED}",
        "SELECT 'insights', row_number() OVER (ORDER BY n DESC, ip), ip, CAST(n AS varchar) FROM top",
        f"SELECT 'targeted', 1, ip, round(n * 100.0 / total, 2) || '|' || total FROM {one} WHERE r = 1 AND (n * 100.0 / total >= 80 OR ips = 1)",
        f"SELECT 'recommendations', row_number() OVER (ORDER BY o), CAST(o AS varchar), t FROM ({advice})",
        "SELECT 'threat_intel', row_number() OVER (ORDER BY risk DESC, events DESC, ip), ip, concat_ws('|', events, abuse_score, risk) FROM rich",
    ])


@query("standard_report", _standard_sql())
def standard_report(spark, d):
    """Every section of the standard report over the authentication log."""
    opts = REPORT.replace(enrich={"enabled": True})
    return reports.combined(reports.standard_sections(
        view(spark, d, "auth_log").withColumnRenamed("Content", "message"), opts, scores=reputation(spark, d), ranges=geo_ranges(spark, d)))


_DASHBOARD_SQL = f"""(SELECT ip, n, row_number() OVER (ORDER BY score DESC, n DESC, ip) AS rank, score FROM (SELECT t.ip, t.n, CAST(round_even(least(1000.0,
 700.0 * t.n / (SELECT max(n) FROM top) + coalesce(r.abuse_score, 0) * 3.0), 0) AS int) AS score FROM top t
 LEFT JOIN (SELECT e.ip, p.abuse_score FROM (SELECT * FROM top ORDER BY n DESC, ip LIMIT {REPORT.enrich.top_n}) e LEFT JOIN {reputation_sql()} p ON e.ip = p.ip) r ON t.ip = r.ip))"""


def _intel_sql() -> str:
    flagged = f"{_FLAGGED} OR {any_has(chr(34) + 'Content' + chr(34), fv.LINUX_AUTH_PATTERNS)}"
    notes = "''"
    for pattern, label in reversed(fv.PAYLOAD_NOTES):
        notes = f"CASE WHEN regexp_matches(t, {lit(pattern)}) THEN {lit(label)} ELSE {notes} END"
    first = "(SELECT ip, line_id, \"Content\" AS m, row_number() OVER (PARTITION BY ip ORDER BY line_id) AS pos FROM a WHERE ip IN (SELECT ip FROM top))"
    summary, ranked = threat_sql(REPORT.web.bruteforce_threshold)
    brute = "(SELECT n FROM cats WHERE category = 'authentication_errors')"
    linux = "coalesce((SELECT n FROM cats WHERE category = 'linux_auth_errors'), 0)"
    return f"WITH {_A}, {_CATS}, {_attackers(flagged, 'top')}, summary AS ({summary}), q AS ({ranked}), dash AS {_DASHBOARD_SQL} " + union([
        "SELECT 'events' AS section, 1 AS ord, 'events_analyzed' AS key, CAST(count(*) AS varchar) AS value FROM a",
        "SELECT 'time_range', 1, 'start', strftime(min(ts), '%Y-%m-%d %H:%M:%S') FROM a",
        "SELECT 'time_range', 2, 'end', strftime(max(ts), '%Y-%m-%d %H:%M:%S') FROM a",
        f"SELECT 'top_threat', 1, 'threat_type', CASE WHEN {brute} > 0 OR {linux} > 0 THEN 'Brute-Force Attack' ELSE 'Suspicious Activity' END",
        f"SELECT 'top_threat', 2, 'row_label', CASE WHEN {brute} > 0 OR {linux} > 0 THEN 'Brute-Force' ELSE 'Probing' END",
        "SELECT 'unique_threats', 1, 'unique_threats', CAST(count(*) AS varchar) FROM dash WHERE rank <= 10",
        "SELECT 'dashboard', rank, ip, score || '|' || n FROM dash WHERE rank <= 10",
        "SELECT 'threat_summary', row_number() OVER (ORDER BY ord), label, concat_ws('|', matches, unique_ips, top_ips) FROM summary",
        "SELECT 'top_threat_ips', rank, ip, reason || '|' || n FROM q WHERE rank <= 5",
        f"SELECT 'actions', row_number() OVER (ORDER BY rank), ip, action FROM ({actions_sql('q')})",
        f"SELECT 'dashboard_notes', row_number() OVER (ORDER BY ip), ip, {notes} FROM (SELECT ip, string_agg(m, ' ' ORDER BY pos) AS t FROM {first} WHERE pos <= 10 GROUP BY ip)",
        f"SELECT 'evidence', row_number() OVER (ORDER BY pos), ip, m FROM {first} WHERE pos <= 2 AND ip = (SELECT ip FROM dash WHERE rank = 1)",
    ])


@query("intel_report", _intel_sql())
def intel_report(spark, d):
    """Every section of the threat-intelligence report over the authentication log."""
    opts = REPORT.replace(enrich={"enabled": True})
    return reports.combined(reports.intel_sections(view(spark, d, "auth_log").withColumnRenamed("ts", "timestamp"), opts, scores=reputation(spark, d), ranges=geo_ranges(spark, d)))


def _comparison_sql() -> str:
    rows = f"(SELECT *, {classify(_TEXT)} AS k FROM {APP})"
    summary = f"(SELECT total, normal, warn_err, expected, anomaly_rate, model_flagged FROM ({SQL['report_summary']}))"
    names = ["total", "normal", "warn_err", "expected", "anomaly_rate", "model_flagged"]
    first = f"(SELECT *, row_number() OVER (ORDER BY line_id) AS r FROM {rows} WHERE k = 'anomaly')"
    return union([
        *[f"SELECT 'summary' AS section, {i} AS ord, '{n}' AS key, CAST({n} AS varchar) AS value FROM {summary}" for i, n in enumerate(names, 1)],
        f"SELECT 'expected', r, line_id || '|' || log_level || ' [' || module || '] ' || message, {_reason_sql('message')} FROM {first} WHERE r <= 20",
        f"SELECT 'severity', row_number() OVER (ORDER BY severity), severity, n || '|' || round(pct, 2) FROM ({SQL['severity_mix']})",
        f"SELECT 'timeline', r, CAST(line_id AS varchar), timestamp FROM {first} WHERE r <= 5",
        "SELECT 'verdict', 1, 'verdict', CASE WHEN model_flagged < expected THEN 'false negatives likely' WHEN model_flagged > expected"
        f" THEN 'false positives possible' ELSE 'counts match' END FROM {summary}",
    ])


@query("comparison_report", _comparison_sql())
def comparison_report(spark, d):
    return reports.combined(reports.comparison_sections(view(spark, d, "app_log"), F.col("log_level") == "ERROR"))


# ---------------------------------------------------------------- files

@query("text_files_parsed", "SELECT source_file, format, count(*) AS n, count(*) FILTER (WHERE parsed) AS parsed, min(1) AS first_line FROM (" + SQL["parse_by_source"] + ") GROUP BY 1, 2")
def text_files_parsed(spark, d):
    """Raw lines written as one text folder per source, read back, numbered, and parsed by detected format."""
    path = fresh_path(spark, "raw")
    lines = view(spark, d, "raw_lines")
    lines.repartitionByRange("source_file", "line_id").sortWithinPartitions("source_file", "line_id").select("source_file", "value").write.partitionBy("source_file").text(path)
    read = readers.read_text_lines(spark, path, recursive=True, glob="*.txt")
    parsed = readers.parse_by_source(read, "source_file", "line_num")
    name = F.regexp_extract("source_file", r"source_file=([^/]+)/", 1)
    return parsed.groupBy(name.alias("source_file"), "format").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("parsed").alias("parsed"), F.min("line_num").alias("first_line"))


_CONTENTS = "(SELECT line_id, \"Level\", CASE line_id % 4 WHEN 0 THEN 'caf' || chr(233) || ' ' || \"Content\" WHEN 1 THEN \"Content\" || chr(10) || 'second, \"line\"' ELSE \"Content\" END AS c FROM " + frm("auth_log") + ")"


@query("csv_files_read", f'SELECT CAST(line_id AS varchar) AS line_id, "Level" AS level, c AS content FROM {_CONTENTS}')
def csv_files_read(spark, d):
    """The authentication log written as CSV, half of it in UTF-8 and half in Latin-1, with accents and quoted line breaks, and read back."""
    rows = view(spark, d, "auth_log").select("line_id", "Level", F.expr(
        "CASE line_id % 4 WHEN 0 THEN concat('caf', char(233), ' ', Content) WHEN 1 THEN concat(Content, char(10), 'second, \"line\"') ELSE Content END").alias("Content"))
    path, half = fresh_path(spark, "csv"), F.col("line_id") % 8 < 4
    sinks.write_csv(rows.filter(half), f"{path}/a")
    sinks.write_csv(rows.filter(~half), f"{path}/b", encoding="ISO-8859-1")
    read = readers.read_csv_log(spark, path, infer=False, recursive=True)
    return read.select("line_id", F.col("Level").alias("level"), F.col("Content").alias("content"))


@query("csv_files_by_name", "SELECT l_linenumber AS part, count(*) AS n, count(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END) AS quantities, round(sum(l_discount), 2) AS discount, CAST(sum(l_orderkey) AS double) AS keys FROM lineitem GROUP BY 1")
def csv_files_by_name(spark, d):
    """Order lines written as CSV folders whose columns differ in order and number, read back as one frame by name."""
    rows, path = table(spark, d, "lineitem"), fresh_path(spark, "by-name")
    even = F.col("l_linenumber") % 2 == 0
    sinks.write_csv(rows.filter(even).select("l_linenumber", "l_orderkey", "l_quantity", "l_discount"), f"{path}/even")
    sinks.write_csv(rows.filter(~even).select("l_discount", "l_linenumber", "l_orderkey"), f"{path}/odd")
    read = readers.read_csv_by_name(spark, path, recursive=True)
    return read.groupBy(F.col("l_linenumber").cast("int").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.count("l_quantity").alias("quantities"), F.round(F.sum("l_discount"), 2).alias("discount"),
        F.sum("l_orderkey").alias("keys"))


@query("rows_per_file", "SELECT 'events.parquet' AS file, count(*) AS n FROM events")
def rows_per_file(spark, d):
    out = agg.rows_per_file(spark.read.parquet(f"{d}/events.parquet"))
    return out.select(F.regexp_extract("file", r"([^/]+)$", 1).alias("file"), "n")
