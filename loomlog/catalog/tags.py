"""Queries that tag, count and summarise rows by rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog.catalog.registry import query
from loomlog.catalog.sql import any_has, classify, contains_any, external, first_group, frm, group, has, lit, private, union
from loomlog.functions import ip as ipf
from loomlog.functions import severity as sev
from loomlog.operators import aggregates as agg
from loomlog.operators import categories as cats
from loomlog.operators.features import full_text
from loomlog.plans import training
from loomlog.rules import ALL_RULES, BASELINE_RULES
from loomlog.sources.views import table, view

AUTH, APP, DET = frm("auth_log"), frm("app_log"), frm("detections_log")
C = '"Content"'
_ALL = {**fv.BASELINE_CATEGORIES, **fv.DOMAIN_CATEGORIES}


def _cat(name: str, col: str = C) -> str:
    return any_has(col, _ALL[name], True)


def _counts_sql(names) -> str:
    return union([f"SELECT {lit(n)} AS category, count(*) FILTER (WHERE {_cat(n)}) AS n FROM a" for n in names])


@query("error_category_counts", f"WITH a AS (SELECT * FROM {AUTH}) " + _counts_sql(fv.BASELINE_CATEGORIES))
def error_category_counts(spark, d):
    return cats.category_counts(view(spark, d, "auth_log"), "Content").select("category", "n")


@query("error_category_distribution", f"WITH a AS (SELECT * FROM {AUTH}) SELECT category, round(n * 100.0 / (SELECT count(*) FROM a), 6) AS pct FROM ({_counts_sql(fv.BASELINE_CATEGORIES)})")
def error_category_distribution(spark, d):
    return cats.category_counts(view(spark, d, "auth_log"), "Content").select("category", F.round("pct", 6).alias("pct"))


@query("top_error_categories", f"WITH a AS (SELECT * FROM {AUTH}) SELECT category, n FROM ({_counts_sql(fv.BASELINE_CATEGORIES)}) WHERE n > 0")
def top_error_categories(spark, d):
    counts = cats.category_counts(view(spark, d, "auth_log"), "Content")
    return cats.top_categories(counts.filter(F.col("n") > 0)).select("category", "n")


@query("generic_errors", f"WITH a AS (SELECT * FROM {AUTH}) SELECT CAST(sum(n) AS bigint) AS generic_errors FROM ({_counts_sql(fv.BASELINE_CATEGORIES)})")
def generic_errors(spark, d):
    return cats.generic_errors(cats.category_counts(view(spark, d, "auth_log"), "Content", ALL_RULES))


@query("error_flags", f"SELECT line_id, " + ", ".join(f"{_cat(n)} AS error_{n}" for n in fv.BASELINE_CATEGORIES) + ", " + " OR ".join(_cat(n) for n in fv.BASELINE_CATEGORIES) + f" AS has_error FROM {AUTH}")
def error_flags(spark, d):
    rows = cats.with_error_flags(view(spark, d, "auth_log").select("line_id", "Content"), "Content")
    return rows.drop("Content")


@query("categories_of_rows", "SELECT line_id, concat_ws(',', " + ", ".join(f"CASE WHEN {_cat(n)} THEN {lit(n)} END" for n in _ALL) + f") AS categories FROM {AUTH}")
def categories_of_rows(spark, d):
    rows = cats.with_categories(view(spark, d, "auth_log").select("line_id", "Content"), "Content", ALL_RULES)
    return rows.select("line_id", F.concat_ws(",", "categories").alias("categories"))


@query("custom_category_counts", f"WITH a AS (SELECT * FROM {AUTH}) " + _counts_sql(_ALL))
def custom_category_counts(spark, d):
    return cats.category_counts(view(spark, d, "auth_log"), "Content", ALL_RULES).select("category", "n")


@query("overridden_category_counts", f"SELECT category, n FROM (SELECT 'data_errors' AS category, count(*) FILTER (WHERE {has(C, 'safe mode', True)}) AS n FROM {AUTH}) UNION ALL SELECT 'system_errors', count(*) FILTER (WHERE {_cat('system_errors')}) FROM {AUTH}")
def overridden_category_counts(spark, d):
    rules = BASELINE_RULES.extended({"data_errors": ["safe mode"]})
    out = cats.category_counts(view(spark, d, "auth_log"), "Content", rules)
    return out.filter(F.col("category").isin("data_errors", "system_errors")).select("category", "n")


@query("flagged_union_rows", f"SELECT line_id FROM {AUTH} WHERE {_cat('authentication_errors')} OR {_cat('linux_auth_errors')} OR {_cat('brute_force')}")
def flagged_union_rows(spark, d):
    rows = cats.with_categories(view(spark, d, "auth_log").select("line_id", "Content"), "Content", ALL_RULES)
    return rows.filter(cats.in_any(F.col("categories"), ["authentication_errors", "linux_auth_errors", "brute_force"])).select("line_id")


@query("level_fallback_counts", union([f"SELECT {lit(s)} AS level, count(*) FILTER (WHERE upper(trim(\"Level\")) = {lit(s)}) AS n FROM {AUTH}" for s in fv.SEVERE_LEVELS]
       + [f"SELECT 'TOTAL' AS level, count(*) FILTER (WHERE upper(trim(\"Level\")) IN ('ERROR', 'FATAL', 'CRITICAL')) AS n FROM {AUTH}"]))
def level_fallback_counts(spark, d):
    return cats.level_counts(view(spark, d, "auth_log"))


@query("linux_auth_rows", f"SELECT line_id FROM {AUTH} WHERE {any_has(C, fv.LINUX_AUTH_PATTERNS)}")
def linux_auth_rows(spark, d):
    rows = view(spark, d, "auth_log")
    return rows.filter(cats.is_linux_auth_error(F.col("Content"))).select("line_id")


@query("classify_rules", f"SELECT line_id, {classify(C)} AS class FROM {AUTH}")
def classify_rules(spark, d):
    return view(spark, d, "auth_log").select("line_id", sev.classify_entry(F.col("Content")).alias("class"))


def _reason_sql(m: str) -> str:
    t, low = fv.REASON_TEXTS, f"lower({m})"
    return (f"CASE WHEN contains({low}, 'failed password') AND contains({low}, 'user') THEN {lit(t['bruteforce'])}"
            f" WHEN contains({low}, 'connection refused') AND {contains_any(low, ['mysql', 'database'])} THEN {lit(t['database'])}"
            f" WHEN contains({low}, 'password check failed') AND contains({low}, 'root') THEN {lit(t['root'])}"
            f" WHEN {contains_any(low, ['critical', 'fatal'])} THEN {lit(t['critical'])} WHEN {contains_any(low, ['out of memory', 'oom'])} THEN {lit(t['memory'])}"
            f" WHEN contains({low}, 'connection refused') THEN {lit(t['refused'])} WHEN {contains_any(low, ['unauthorized', 'forbidden'])} THEN {lit(t['forbidden'])} ELSE {lit(t['other'])} END")


@query("rule_reason_counts", f"SELECT {_reason_sql(C)} AS reason, count(*) AS n FROM {AUTH} GROUP BY 1")
def rule_reason_counts(spark, d):
    return view(spark, d, "auth_log").groupBy(sev.rule_reason(F.col("Content")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def _keyword_sql(c: str) -> str:
    return "greatest(0, " + ", ".join(f"CASE WHEN {has(c, rf'\b{w}\b', True)} THEN {v} ELSE 0 END" for w, v in fv.KEYWORD_WEIGHTS.items()) + ")"


_LINE_SEV = f"coalesce(nullif({group('line', fv.LEVEL_FINDERS['standard'].replace('INFO|WARNING|ERROR|DEBUG|CRITICAL|FATAL|WARN|ERR|NOTICE|TRACE', 'INFO|WARN|ERROR'))}, ''), 'INFO')"
_PASSED = "(contains(line, '[HealthCheck]') AND contains(line, 'PASSED'))"


def _usage(word: str) -> str:
    return f"CASE WHEN {_PASSED} THEN coalesce(TRY_CAST({group('line', word + r':\s*(\d+)%')} AS double), 0) ELSE 0 END"


@query("line_signals", f"SELECT line_id, {_LINE_SEV} AS severity, CAST({_keyword_sql('line')} AS int) AS keyword_severity, {_usage('CPU')} AS hc_cpu, {_usage('Memory')} AS hc_mem, regexp_extract(line, '\\[(.*?)\\]', 1) AS event_type, (NOT {_PASSED} AND ({_keyword_sql('line')} >= 2 OR {_LINE_SEV} IN ('WARN', 'ERROR'))) AS truth FROM {APP}")
def line_signals(spark, d):
    line = F.col("line")
    cpu, mem = sev.passed_healthcheck_usage(line)
    return view(spark, d, "app_log").select(
        "line_id", sev.line_severity(line).alias("severity"), sev.keyword_severity(line).alias("keyword_severity"),
        cpu.alias("hc_cpu"), mem.alias("hc_mem"), sev.event_type(line, line).alias("event_type"), sev.rule_truth(line).alias("truth"))


@query("inferred_levels", f"SELECT level, count(*) AS n FROM (SELECT CASE WHEN {contains_any(f'lower({C})', fv.LEVEL_ERROR_WORDS)} THEN 'ERROR' WHEN {contains_any(f'lower({C})', fv.LEVEL_WARN_WORDS)} THEN 'WARN' ELSE 'INFO' END AS level FROM {AUTH}) GROUP BY level")
def inferred_levels(spark, d):
    return view(spark, d, "auth_log").groupBy(sev.infer_level(F.col("Content")).alias("level")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- addresses

_LOOSE = first_group(C, fv.LOOSE_IP_FINDERS)
_STRICT = first_group(C, fv.STRICT_IP_FINDERS)


@query("ip_extract_top", f"SELECT ip, count(*) AS n FROM (SELECT {_LOOSE} AS ip FROM {AUTH} WHERE {any_has(C, fv.LINUX_AUTH_PATTERNS)}) WHERE ip IS NOT NULL GROUP BY ip ORDER BY n DESC, ip LIMIT 10")
def ip_extract_top(spark, d):
    rows = view(spark, d, "auth_log").drop("ip")
    return agg.top_attackers(rows, cats.is_linux_auth_error(F.col("Content")), 10, "Content")


@query("ip_extract_rows", f"SELECT line_id, CASE WHEN regexp_matches({_STRICT}, {lit(fv.VALID_IPV4)}) THEN {_STRICT} END AS ip FROM {AUTH}")
def ip_extract_rows(spark, d):
    return view(spark, d, "auth_log").select("line_id", ipf.extract_ip(F.col("Content")).alias("ip"))


@query("ip_extract_documents", f"SELECT doc_id, ip, regexp_matches(ip, {lit(fv.VALID_IPV4)}) AS is_valid, {private('ip')} AS is_private, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, {lit(fv.ANY_IP)})) AS ip FROM documents) GROUP BY ALL")
def ip_extract_documents(spark, d):
    found = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(fv.ANY_IP), F.lit(0))).alias("ip"))
    return found.groupBy("doc_id", "ip", ipf.is_valid_ipv4(F.col("ip")).alias("is_valid"), ipf.is_private(F.col("ip")).alias("is_private")).agg(F.count(F.lit(1)).alias("n"))


@query("private_external_ip", f"SELECT line_id, {external(C)} AS external FROM {AUTH}")
def private_external_ip(spark, d):
    return view(spark, d, "auth_log").select("line_id", ipf.has_external_ip(F.col("Content")).alias("external"))


# ---------------------------------------------------------------- detections

def _tuple(name: str) -> str:
    return any_has("message", fv.TUPLE_DETECTOR_CATEGORIES[name])


_ROWS = union([f"SELECT timestamp, ip, {lit(n)} AS category, message FROM {DET} WHERE {_tuple(n)}" for n in fv.TUPLE_DETECTOR_CATEGORIES])
_ALERTS = (f"SELECT CAST(NULL AS varchar) AS timestamp, ip, CASE WHEN n >= 50 THEN 'brute_force_high_volume' ELSE 'low_and_slow_attack' END AS category,"
           f" CAST(n AS varchar) || CASE WHEN n >= 50 THEN ' failed login attempts' ELSE ' failed login attempts over long period' END AS message"
           f" FROM (SELECT ip, count(*) AS n FROM {DET} WHERE {_tuple('brute_force')} GROUP BY ip) WHERE n >= 5")


@query("detections_long", _ROWS)
def detections_long(spark, d):
    return cats.detections(view(spark, d, "detections_log"))


@query("volume_alerts", _ALERTS)
def volume_alerts(spark, d):
    return cats.volume_alerts(view(spark, d, "detections_log"))


@query("detections_and_alerts", f"SELECT * FROM ({_ROWS}) UNION ALL SELECT * FROM ({_ALERTS})")
def detections_and_alerts(spark, d):
    return cats.detect_all(view(spark, d, "detections_log"))


# ---------------------------------------------------------------- profiles

_TEXT = "log_level || ' ' || module || ' ' || message"


@query("severity_mix", f"WITH a AS (SELECT upper(log_level) AS l, {classify(_TEXT)} AS k FROM {APP}) SELECT severity, n, round(n * 100.0 / (SELECT count(*) FROM a), 6) AS pct FROM (" + union([
    "SELECT 'INFO' AS severity, count(*) FILTER (WHERE l = 'INFO') AS n FROM a", "SELECT 'WARN', count(*) FILTER (WHERE l = 'WARN') FROM a",
    "SELECT 'ERROR', count(*) FILTER (WHERE l IN ('ERROR', 'FATAL', 'CRITICAL')) FROM a", "SELECT 'ANOMALY', count(*) FILTER (WHERE k = 'anomaly') FROM a"]) + ")")
def severity_mix(spark, d):
    flagged = sev.classify_entry(full_text(F.col("log_level"), F.col("module"), F.col("message"))) == "anomaly"
    return agg.severity_mix(view(spark, d, "app_log"), flagged).withColumn("pct", F.round("pct", 6))


@query("report_summary", f"SELECT count(*) AS total, count(*) FILTER (WHERE l NOT IN ('WARN', 'ERROR', 'FATAL', 'CRITICAL')) AS normal, count(*) FILTER (WHERE l IN ('WARN', 'ERROR', 'FATAL', 'CRITICAL')) AS warn_err, count(*) FILTER (WHERE k = 'anomaly') AS expected, round(count(*) FILTER (WHERE k = 'anomaly') * 100.0 / count(*), 6) AS anomaly_rate, count(*) FILTER (WHERE l = 'ERROR') AS model_flagged FROM (SELECT log_level AS l, {classify(_TEXT)} AS k FROM {APP})")
def report_summary(spark, d):
    expected = sev.classify_entry(full_text(F.col("log_level"), F.col("module"), F.col("message"))) == "anomaly"
    out = agg.report_summary(view(spark, d, "app_log"), expected, F.col("log_level") == "ERROR")
    return out.withColumn("anomaly_rate", F.round("anomaly_rate", 6))


@query("time_range", f"SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS \"end\" FROM {APP}")
def time_range(spark, d):
    return agg.time_range(view(spark, d, "app_log").drop("ts"))


@query("time_range_epoch", f"SELECT strftime(make_timestamp(min(1131566461 + line_id) * 1000000), '%Y-%m-%d %H:%M:%S') AS start, strftime(make_timestamp(max(1131566461 + line_id) * 1000000), '%Y-%m-%d %H:%M:%S') AS \"end\" FROM {frm('structured_thunderbird')} WHERE line_id % 3 = 0")
def time_range_epoch(spark, d):
    return agg.time_range(view(spark, d, "structured_thunderbird").select("Timestamp"))


@query("dataset_profile", f"WITH a AS (SELECT 'file' || CAST(line_id % 4 AS varchar) AS source_file, substr(module, 1, 20) AS module, log_level FROM {APP}) SELECT source_file, count(*) AS valid_rows, (SELECT string_agg(m, ',' ORDER BY m) FROM (SELECT DISTINCT module AS m FROM a b WHERE b.source_file = a.source_file ORDER BY m LIMIT 5)) AS modules_preview, (SELECT string_agg(l, ',' ORDER BY l) FROM (SELECT DISTINCT log_level AS l FROM a b WHERE b.source_file = a.source_file)) AS levels_present FROM a GROUP BY source_file")
def dataset_profile(spark, d):
    rows = view(spark, d, "app_log").withColumn("source_file", F.concat(F.lit("file"), (F.col("line_id") % 4).cast("string")))
    return agg.dataset_profile(rows, "source_file")


@query("sample_message", f"SELECT count(*) AS total_logs, min_by(message, line_id) AS sample_message FROM {APP}")
def sample_message(spark, d):
    return agg.sample_message(view(spark, d, "app_log"), "line_id", "message")


@query("label_distribution", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def label_distribution(spark, d):
    return training.label_distribution(table(spark, d, "lineitem"), "l_returnflag")
