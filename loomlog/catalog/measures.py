"""Queries that evaluate, window, sample and build features."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog.catalog.registry import query
from loomlog.catalog.sql import classify, frm, has, lit, union
from loomlog.operators import aggregates as agg
from loomlog.operators import evaluation as ev
from loomlog.operators import features as feat
from loomlog.operators import sampling, windows
from loomlog.operators.quantiles import exact_quantiles
from loomlog.sources.views import spread, table, view

APP = frm("app_log")
FLAG = f"({has('text', fv.BASE64_LIKE)} OR {has('text', 'http')} OR n_chars > 3000)"


def _flagged():
    return F.col("text").rlike(fv.BASE64_LIKE) | F.col("text").contains("http") | (F.col("n_chars") > 3000)


def _scores(tp: str = "tp", fp: str = "fp", fn: str = "fn") -> str:
    p, r = f"coalesce({tp} * 1.0 / nullif({tp} + {fp}, 0), 0)", f"coalesce({tp} * 1.0 / nullif({tp} + {fn}, 0), 0)"
    return f"round({p}, 6) AS precision, round({r}, 6) AS recall, round(coalesce(2.0 * {p} * {r} / nullif({p} + {r}, 0), 0), 6) AS f1"


def _rounded(df, names=("precision", "recall", "f1")):
    return df.withColumns({n: F.round(n, 6) for n in names})


_JUDGED = f"(SELECT {FLAG} AS p, coalesce(toxic, 0) AS y, n_chars, d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


@query("eval_vs_ground_truth", f"SELECT tp, fp, fn, {_scores()} FROM (SELECT count(*) FILTER (WHERE y = 1 AND p) AS tp, count(*) FILTER (WHERE y = 0 AND p) AS fp, count(*) FILTER (WHERE y = 1 AND NOT p) AS fn FROM {_JUDGED})")
def eval_vs_ground_truth(spark, d):
    pred = table(spark, d, "documents").select(F.col("doc_id").alias("LineId"), _flagged().alias("flagged"))
    truth = table(spark, d, "labels").select(F.col("doc_id").alias("LineId"), F.col("toxic").alias("is_error"))
    return _rounded(ev.score_against_truth(pred, truth))


def _labelled(spark, d):
    docs = table(spark, d, "documents").select("doc_id", _flagged().cast("int").alias("pred"), F.least(F.col("n_chars") / 5000.0, F.lit(1.0)).alias("score"))
    return docs.join(table(spark, d, "labels").select("doc_id", F.col("toxic").alias("y")), "doc_id")


_LAB = f"(SELECT CAST({FLAG} AS int) AS pred, least(n_chars / 5000.0, 1.0) AS score, toxic AS y FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


@query("confusion_matrix", f"SELECT y, pred, count(*) AS n FROM {_LAB} GROUP BY 1, 2")
def confusion_matrix(spark, d):
    return ev.confusion_matrix(_labelled(spark, d))


def _report_sql() -> str:
    base = f"(SELECT count(*) FILTER (WHERE y = 0 AND pred = 0) AS a, count(*) FILTER (WHERE y = 0 AND pred = 1) AS b, count(*) FILTER (WHERE y = 1 AND pred = 0) AS c, count(*) FILTER (WHERE y = 1 AND pred = 1) AS e FROM {_LAB})"
    def f1(p, r):
        return f"coalesce(2.0 * {p} * {r} / nullif({p} + {r}, 0), 0)"
    m = f"""(SELECT *, coalesce(a * 1.0 / nullif(a + c, 0), 0) AS p0, coalesce(a * 1.0 / nullif(a + b, 0), 0) AS r0,
 coalesce(e * 1.0 / nullif(e + b, 0), 0) AS p1, coalesce(e * 1.0 / nullif(e + c, 0), 0) AS r1, (a + b) AS s0, (c + e) AS s1, (a + b + c + e) AS t FROM {base})"""
    g = f"(SELECT *, {f1('p0', 'r0')} AS f0, {f1('p1', 'r1')} AS f1 FROM {m})"
    rows = [("0", "p0", "r0", "f0", "s0"), ("1", "p1", "r1", "f1", "s1"), ("accuracy", *["(a + e) * 1.0 / t"] * 3, "t"),
            ("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "t"),
            ("weighted avg", "(p0 * s0 + p1 * s1) / t", "(r0 * s0 + r1 * s1) / t", "(f0 * s0 + f1 * s1) / t", "t")]
    return f"WITH g AS (SELECT * FROM {g}) " + union([
        f"SELECT {lit(n)} AS class, round({p}, 6) AS precision, round({r}, 6) AS recall, round({f}, 6) AS f1, {s} AS support FROM g" for n, p, r, f, s in rows])


@query("classification_report", _report_sql())
def classification_report(spark, d):
    return _rounded(ev.classification_report(_labelled(spark, d)))


_CUTS = union([f"SELECT CAST({c} AS double) AS threshold" for c in ev.SWEEP])
_SWEEP = f"(SELECT threshold, tp, fp, fn, {_scores()} FROM (SELECT threshold, count(*) FILTER (WHERE y = 1 AND score >= threshold) AS tp, count(*) FILTER (WHERE y = 0 AND score >= threshold) AS fp, count(*) FILTER (WHERE y = 1 AND score < threshold) AS fn FROM {_LAB} CROSS JOIN ({_CUTS}) GROUP BY threshold))"


@query("threshold_sweep", f"SELECT * FROM {_SWEEP}")
def threshold_sweep(spark, d):
    return _rounded(ev.threshold_sweep(_labelled(spark, d)))


@query("best_threshold", f"SELECT threshold, f1 FROM {_SWEEP} ORDER BY f1 DESC, threshold LIMIT 1")
def best_threshold(spark, d):
    return _rounded(ev.best_threshold(ev.threshold_sweep(_labelled(spark, d)))).select("threshold", "f1")


@query("predicted_preview", f"SELECT module, line_id, CAST(r AS int) AS pos FROM (SELECT module, line_id, row_number() OVER (PARTITION BY module ORDER BY line_id) AS r FROM {APP} WHERE {has('message', 'Failed|timeout')}) WHERE r <= 20")
def predicted_preview(spark, d):
    rows = view(spark, d, "app_log").withColumn("pred", F.col("message").rlike("Failed|timeout").cast("int"))
    return ev.predicted_preview(rows, "module", "line_id").select("module", "line_id", "pos")


@query("score_quantiles", "SELECT round(quantile_cont(value, 0.05), 6) AS q05, round(quantile_cont(value, 0.16), 6) AS q16, round(quantile_cont(value, 0.2), 6) AS q20 FROM events")
def score_quantiles(spark, d):
    q = exact_quantiles(table(spark, d, "events"), "value", [0.05, 0.16, 0.2])
    return table(spark, d, "events").agg(*[F.lit(round(v, 6)).alias(n) for v, n in zip(q, ("q05", "q16", "q20"))])


# ---------------------------------------------------------------- windows

def _text(df, name="window_start"):
    return df.withColumn(name, F.date_format(name, "yyyy-MM-dd HH:mm:ss"))


_ALIGNED = "(SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2)"


@query("template_window_counts", f"SELECT * FROM {_ALIGNED}")
def template_window_counts(spark, d):
    return _text(windows.aligned_window_counts(table(spark, d, "events"), "event_type"))


@query("known_template_counts", f"SELECT * FROM {_ALIGNED} WHERE event_type IN ('error', 'click')")
def known_template_counts(spark, d):
    events = table(spark, d, "events")
    known = events.filter(F.col("event_type").isin("error", "click")).select("event_type")
    return _text(windows.only_known(windows.aligned_window_counts(events, "event_type"), known, "event_type"))


@query("window_features", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'error') AS error FROM events GROUP BY 1")
def window_features(spark, d):
    counts = windows.aligned_window_counts(table(spark, d, "events"), "event_type", width="1 hour")
    return _text(windows.window_features(counts, ["click", "error"], "event_type", ["window_start"]))


@query("top_templates_per_window", "SELECT window_start, event_type, n, CAST(r AS int) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, event_type) AS r FROM (SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2)) WHERE r <= 3")
def top_templates_per_window(spark, d):
    counts = windows.aligned_window_counts(table(spark, d, "events"), "event_type", width="1 hour")
    return _text(windows.top_templates(counts, "event_type"))


_GREEDY = """WITH RECURSIVE s AS (SELECT DISTINCT event_type, CAST(floor(epoch(ts)) AS bigint) AS sec FROM events),
 nxt AS (SELECT event_type, sec, min(sec) OVER (PARTITION BY event_type ORDER BY sec RANGE BETWEEN 60 FOLLOWING AND UNBOUNDED FOLLOWING) AS nx FROM s),
 w AS (SELECT event_type, min(sec) AS st FROM s GROUP BY event_type UNION ALL SELECT n.event_type, n.nx FROM w JOIN nxt n ON n.event_type = w.event_type AND n.sec = w.st WHERE n.nx IS NOT NULL)
 SELECT e.event_type, strftime(make_timestamp(e.st * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start, e.value_band, count(*) AS n
 FROM (SELECT event_type, CAST(value AS int) % 3 AS value_band, (SELECT max(st) FROM w WHERE w.event_type = x.event_type AND w.st <= CAST(floor(epoch(x.ts)) AS bigint)) AS st FROM (SELECT event_type, ts, floor(value) AS value FROM events) x) e GROUP BY ALL"""


@query("greedy_windows", _GREEDY)
def greedy_windows(spark, d):
    events = table(spark, d, "events").withColumn("value_band", (F.floor("value").cast("int") % 3))
    return _text(windows.greedy_window_counts(events, "event_type", "value_band"))


@query("entity_template_counts", "SELECT user_id, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS \"{t}\"" for t in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY user_id")
def entity_template_counts(spark, d):
    return agg.entity_template_counts(table(spark, d, "events"), None, "user_id", "event_type")


@query("entity_template_vectors", """SELECT l_orderkey, string_agg(i || ':' || n, ',' ORDER BY i) AS counts FROM (SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2)
 JOIN (SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) - 1 AS i FROM (SELECT DISTINCT l_partkey FROM lineitem)) USING (l_partkey) GROUP BY l_orderkey""")
def entity_template_vectors(spark, d):
    """Sparse counts of the parts of every order, by the parts' numbers."""
    out = agg.entity_template_vectors(table(spark, d, "lineitem"), None, "l_orderkey", "l_partkey")
    pairs = F.zip_with("features.indices", "features.values", lambda i, n: F.concat_ws(":", i, n.cast("long")))
    return out.select("l_orderkey", F.array_join(pairs, ",").alias("counts"))


@query("entity_template_long", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def entity_template_long(spark, d):
    return agg.entity_template_long(table(spark, d, "events"), "user_id", "event_type")


@query("event_frequency", "SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type) AS event_freq FROM events")
def event_frequency(spark, d):
    return windows.with_event_frequency(table(spark, d, "events").select("event_id", "event_type"), "event_type")


# ---------------------------------------------------------------- samples

_QUOTA = """(SELECT event_type, q + CASE WHEN usable AND turn <= abs(diff) THEN sign(diff) ELSE 0 END AS n FROM (SELECT *, sum(CAST(usable AS int)) OVER (ORDER BY event_type) AS turn
 FROM (SELECT *, 1237 - sum(q) OVER () AS diff, (1237 - sum(q) OVER () > 0 OR q > 0) AS usable FROM (SELECT event_type, CAST(round_even(1237.0 * count(*) / sum(count(*)) OVER (), 0) AS bigint) AS q FROM events GROUP BY 1))))"""


_DIGEST = "md5('42|' || event_id)"


@query("file_quota_sample", f"SELECT e.event_type, e.event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY {_DIGEST}) AS r FROM events) e JOIN {_QUOTA} q USING (event_type) WHERE r <= q.n")
def file_quota_sample(spark, d):
    """The rows of the proportional sample: of each source those with the smallest digests."""
    return sampling.proportional_sample(table(spark, d, "events").select("event_id", "event_type"), "event_type", 1237, ["event_id"])


@query("sample_rows", f"SELECT event_id FROM events ORDER BY {_DIGEST} LIMIT 4321")
def sample_rows(spark, d):
    return sampling.sample_rows(table(spark, d, "events").select("event_id"), 4321, ["event_id"])


@query("stratified_split", f"SELECT event_id, y, r <= ceil(n * 0.25) AS test FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {_DIGEST}) AS r, count(*) OVER (PARTITION BY y) AS n FROM (SELECT event_id, CAST(event_type = 'error' AS int) AS y FROM events))")
def stratified_split(spark, d):
    """Every row with its side: a quarter of each class is for testing."""
    rows = table(spark, d, "events").select("event_id", (F.col("event_type") == "error").cast("int").alias("y"))
    return sampling.mark_split(rows, "y", ["event_id"], "test")


# ---------------------------------------------------------------- features

_TXT = "log_level || ' ' || module || ' ' || message"
_NUM = {
    "hc_cpu": "coalesce(TRY_CAST(regexp_extract(message, 'CPU:\\s*(\\d+)%,\\s*Memory:\\s*(\\d+)%', 1) AS double), 0)",
    "hc_mem": "coalesce(TRY_CAST(regexp_extract(message, 'CPU:\\s*(\\d+)%,\\s*Memory:\\s*(\\d+)%', 2) AS double), 0)",
    "message_len": "CAST(length(message) AS double)",
    "digit_count": "CAST(len(regexp_extract_all(message, '\\d')) AS double)",
    "ip_count": f"CAST(len(regexp_extract_all(message, {lit(fv.ANY_IP)})) AS double)",
    "has_private_ip": f"CAST({has('message', fv.PRIVATE_IP_IN_TEXT)} AS double)",
    "has_external_ip": f"CAST({has('message', fv.ANY_IP)} AND NOT {has('message', fv.PRIVATE_IP_IN_TEXT)} AS double)",
    "url_count": "CAST(len(regexp_extract_all(message, 'https?://')) AS double)",
    "status_5xx": f"CAST({has('message', r'\s5\d{2}\s')} AS double)",
    "status_4xx": f"CAST({has('message', r'\s4\d{2}\s')} AS double)",
    "rule_flag": f"CAST({classify(_TXT)} = 'anomaly' AS double)",
}
_NUMERIC = "(SELECT line_id, " + ", ".join(f"{e} AS {n}" for n, e in _NUM.items()) + f" FROM {APP})"


@query("numeric_log_features", f"SELECT * FROM {_NUMERIC}")
def numeric_log_features(spark, d):
    return feat.with_numeric_features(view(spark, d, "app_log")).select("line_id", *feat.NUMERIC_FEATURES)


@query("minmax_features", "SELECT line_id, " + ", ".join(f"round(coalesce(({n} - min({n}) OVER ()) / nullif(max({n}) OVER () - min({n}) OVER (), 0), 0), 6) AS {n}" for n in _NUM) + f" FROM {_NUMERIC}")
def minmax_features(spark, d):
    rows = feat.with_numeric_features(view(spark, d, "app_log"))
    scaled = feat.fit_minmax(rows, feat.NUMERIC_FEATURES).transform(rows)
    return scaled.select("line_id", *[F.round(n, 6).alias(n) for n in feat.NUMERIC_FEATURES])


def _tfidf_sql(source: str, doc: str, text: str, terms: int, min_docs: int = 1) -> str:
    return f"""WITH t AS (SELECT {doc} AS doc, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM {source}),
 c AS (SELECT doc, term, count(*) AS tf FROM t GROUP BY 1, 2),
 v AS (SELECT term, sum(tf) AS n, count(*) AS df FROM c GROUP BY term HAVING count(*) >= {min_docs} ORDER BY n DESC, term LIMIT {terms}),
 w AS (SELECT doc, term, tf * (ln((1.0 + (SELECT count(DISTINCT {doc}) FROM {source})) / (1.0 + df)) + 1.0) AS w FROM c JOIN v USING (term))
 SELECT doc, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc)), 6) AS weight FROM w"""


@query("tfidf_terms", _tfidf_sql("documents", "doc_id", "text", 1000))
def tfidf_terms(spark, d):
    docs = spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    out = feat.fit_tfidf(docs, "doc_id", "text", 1000).weights(docs, "doc_id", "text")
    return out.select(F.col("doc_id").alias("doc"), "term", F.round("weight", 6).alias("weight"))


@query("tfidf_entities", _tfidf_sql(f"(SELECT module, message FROM {APP})", "module", "message", 1000))
def tfidf_entities(spark, d):
    rows = view(spark, d, "app_log").select("module", "message")
    out = feat.fit_tfidf(rows, "module", "message", 1000).weights(rows, "module", "message")
    return out.select(F.col("module").alias("doc"), "term", F.round("weight", 6).alias("weight"))


@query("entity_terms", f"SELECT module, term, count(*) AS tf FROM (SELECT module, unnest(regexp_extract_all(lower(message), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM {APP}) GROUP BY 1, 2")
def entity_terms(spark, d):
    return feat.term_counts(view(spark, d, "app_log"), "module", "message")


_STOP = ["the", "for", "by", "from", "on", "at"]


@query("bigram_counts", f"WITH t AS (SELECT list_filter(regexp_extract_all(lower(message), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda x: x NOT IN ({', '.join(lit(s) for s in _STOP)})) AS l FROM {APP}), g AS (SELECT unnest(l) AS term FROM t UNION ALL SELECT unnest(list_transform(range(1, greatest(len(l), 1)), lambda i: l[i] || ' ' || l[i + 1])) FROM t) SELECT term, count(*) AS n FROM g GROUP BY term")
def bigram_counts(spark, d):
    terms = feat.terms_of(F.col("message"), _STOP, bigrams=True)
    return view(spark, d, "app_log").select(F.explode(terms).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


_FULL = "concat_ws(' ', coalesce(log_level, 'unknown'), coalesce(module, 'unknown'), coalesce(message, 'unknown'))"


@query("tfidf_log_rows", f"""WITH t AS (SELECT line_id, list_filter(regexp_extract_all(lower({_FULL}), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda x: x NOT IN ({', '.join(lit(w) for w in fv.ENGLISH_STOP_WORDS)})) AS l FROM {APP}),
 g AS (SELECT line_id, unnest(list_concat(l, list_transform(range(1, greatest(len(l), 1)), lambda i: l[i] || ' ' || l[i + 1]))) AS term FROM t),
 c AS (SELECT line_id, term, count(*) AS tf FROM g GROUP BY 1, 2),
 v AS (SELECT term, sum(tf) AS n, count(*) AS df FROM c GROUP BY term HAVING count(*) >= 2 ORDER BY n DESC, term LIMIT 5000),
 w AS (SELECT line_id, term, tf * (ln((1.0 + (SELECT count(*) FROM t)) / (1.0 + df)) + 1.0) AS w FROM c JOIN v USING (term))
 SELECT line_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY line_id)), 6) AS weight FROM w""")
def tfidf_log_rows(spark, d):
    """TF-IDF of every log row as the models see it: 5,000 words and pairs of words, read back from the row vectors."""
    logs = view(spark, d, "app_log").select("line_id", feat.full_text(F.col("log_level"), F.col("module"), F.col("message")).alias("t"))
    model = feat.fit_tfidf(logs, None, "t", 5000, 2, feat.ENGLISH, True)
    raw = F.unwrap_udt("v")
    pairs = model.vectors(logs, F.col("t"), "v").select("line_id", F.explode(F.arrays_zip(raw["indices"].alias("i"), raw["values"].alias("w"))).alias("p"))
    terms = spark.createDataFrame(list(enumerate(model.terms)), "i int, term string")  # the vocabulary
    return pairs.select("line_id", "p.i", "p.w").join(F.broadcast(terms), "i").select("line_id", "term", F.round("w", 6).alias("weight"))


@query("one_hot_levels", f"SELECT line_id, CAST(dense_rank() OVER (ORDER BY log_level) - 1 AS int) AS hot, CAST((SELECT count(DISTINCT log_level) FROM {APP}) AS int) AS size FROM {APP}")
def one_hot_levels(spark, d):
    """The place of the one in each row's vector of levels, and the vector's size."""
    rows = view(spark, d, "app_log").select("line_id", "log_level")
    raw = F.unwrap_udt("log_level_vec")
    return feat.one_hot(rows, feat.fit_categories(rows, ["log_level"])).select("line_id", raw["indices"][0].alias("hot"), raw["size"].alias("size"))


@query("one_hot_parts", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(dense_rank() OVER (ORDER BY CAST(l_partkey AS varchar)) - 1 AS int) AS hot, CAST((SELECT count(DISTINCT l_partkey) FROM lineitem) AS int) AS size FROM lineitem")
def one_hot_parts(spark, d):
    """As :func:`one_hot_levels` for a column with many values: the part of every order line."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    raw = F.unwrap_udt("l_partkey_vec")
    return feat.one_hot(rows, feat.fit_categories(rows, ["l_partkey"])).select(
        "l_orderkey", "l_linenumber", "l_partkey", raw["indices"][0].alias("hot"), raw["size"].alias("size"))


@query("flow_scaled_numbers", "SELECT l_orderkey, l_linenumber, round(l_quantity / stddev_pop(l_quantity) OVER (), 6) AS quantity, round(l_extendedprice / stddev_pop(l_extendedprice) OVER (), 6) AS price FROM lineitem")
def flow_scaled_numbers(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    scale = feat.fit_flow_featurizer(rows, ["l_orderkey", "l_linenumber"]).scale
    return rows.select("l_orderkey", "l_linenumber",
                       F.round(feat.coerced(F.col("l_quantity")) / scale["l_quantity"], 6).alias("quantity"),
                       F.round(feat.coerced(F.col("l_extendedprice")) / scale["l_extendedprice"], 6).alias("price"))
