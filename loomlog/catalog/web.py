"""Queries over the access log."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog import schema
from loomlog.catalog.registry import query
from loomlog.catalog.sql import any_has, frm, has, lit, union
from loomlog.functions.text import split_request
from loomlog.operators import aggregates as agg
from loomlog.operators import categories as cats
from loomlog.operators import threats
from loomlog.operators import websignals as web
from loomlog.options import WebOptions
from loomlog.operators.lookups import with_geo
from loomlog.sources.views import geo_ranges, table, view

OPTS = WebOptions(large_bytes=1_048_576, bruteforce_threshold=5, requests_per_minute=2)
ACCESS = frm("access_log")


def _signals(ci: bool = False) -> dict[str, str]:
    sens = f"({has('path', '/(' + '|'.join(fv.SENSITIVE_WORDS) + r')(?:\b|/)', ci)} OR {has('path', fv.SUSPICIOUS_KEYWORDS, ci)})"
    uncommon = "coalesce(upper(method) IN (" + ", ".join(lit(m) for m in fv.UNCOMMON_METHODS) + "), false)"
    large = "bytes > 1048576"
    return {
        "uncommon_methods": uncommon,
        "uncommon_with_error": f"{uncommon} AND status >= 400",
        "suspicious_endpoints": sens,
        "sqli": has("path", fv.SQLI, ci), "xss": has("path", fv.XSS, ci), "cmdi": has("path", fv.CMDI, ci),
        "path_traversal": has("path", fv.TRAVERSAL, ci), "file_access": has("path", fv.FILE_ACCESS, ci),
        "empty_user_agent": "coalesce(trim(user_agent) = '' OR user_agent = '-', false)",
        "malicious_user_agent": has("user_agent", "(" + "|".join(fv.SCANNER_AGENTS) + ")", ci),
        "large_responses": large, "possible_exfiltration": f"{large} AND {sens}",
        "bruteforce_events": f"{has('path', r'/((?:login|signin))(?:\b|/)', ci)} AND status IN (401, 403)",
        "suspicious_params_chars": has("path", fv.QUOTE_LIKE, ci), "suspicious_params_base64": has("path", fv.BASE64_LIKE, ci),
        "sensitive_no_referer": f"{sens} AND coalesce(trim(referer) = '' OR referer = '-', false)",
        "sensitive_external_referer": f"{sens} AND (referer LIKE 'http://%' OR referer LIKE 'https://%') AND NOT {has('referer', fv.LOCAL_REFERER, ci)}",
    }


def _counters_sql(ci: bool = False) -> str:
    sig = _signals(ci)
    parts = [f"SELECT {lit(n)} AS counter, count(*) FILTER (WHERE {c}) AS n FROM a" for n, c in sig.items()]
    parts.append(f"SELECT 'bruteforce_offenders' AS counter, count(*) AS n FROM (SELECT ip FROM a WHERE {sig['bruteforce_events']} GROUP BY ip HAVING count(*) >= 5)")
    parts.append("SELECT 'high_freq_offenders' AS counter, count(*) AS n FROM (SELECT ip FROM (SELECT ip, date_trunc('minute', ts) AS m, count(*) AS c FROM a GROUP BY 1, 2) GROUP BY ip HAVING max(c) >= 2)")
    return f"WITH a AS (SELECT * FROM {ACCESS}) " + union(parts)


@query("web_signal_counters", _counters_sql())
def web_signal_counters(spark, d):
    return web.signal_counters(view(spark, d, "access_log"), OPTS, ts="ts")


@query("web_signal_counters_ci", _counters_sql(ci=True))
def web_signal_counters_ci(spark, d):
    return web.signal_counters(view(spark, d, "access_log"), OPTS.replace(case_sensitive=False), ts="ts")


@query("web_signal_flags", "SELECT line_id, " + " || ".join(f"(CASE WHEN {c} THEN '1' ELSE '0' END)" for c in _signals().values()) + f" AS flags FROM {ACCESS}")
def web_signal_flags(spark, d):
    rows = web.with_signals(view(spark, d, "access_log"), OPTS)
    return rows.select("line_id", F.concat(*[F.col(n).cast("int").cast("string") for n in fv.SIGNAL_NAMES]).alias("flags"))


@query("bruteforce_offenders", f"SELECT ip, count(*) AS failures FROM {ACCESS} WHERE {_signals()['bruteforce_events']} GROUP BY ip HAVING count(*) >= 5")
def bruteforce_offenders(spark, d):
    return web.bruteforce_offenders(view(spark, d, "access_log"), OPTS)


@query("high_freq_ips", f"SELECT ip, max(c) AS max_per_minute FROM (SELECT ip, date_trunc('minute', ts) AS m, count(*) AS c FROM {ACCESS} GROUP BY 1, 2) GROUP BY ip HAVING max(c) >= 2")
def high_freq_ips(spark, d):
    return web.high_frequency_ips(view(spark, d, "access_log"), OPTS, ts="ts")


@query("status_distribution", f"SELECT status, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM {ACCESS} GROUP BY status")
def status_distribution(spark, d):
    return agg.status_distribution(view(spark, d, "access_log"))


@query("status_classes", "SELECT " + ", ".join(f"round(count(*) FILTER (WHERE status BETWEEN {c}00 AND {c}99) * 100.0 / count(*), 6) AS pct_{c}xx" for c in (2, 3, 4, 5)) + f" FROM {ACCESS}")
def status_classes(spark, d):
    one = agg.status_classes(view(spark, d, "access_log"))
    return one.select(*[F.round(c, 6).alias(c) for c in one.columns])


@query("method_counts", f"SELECT method, count(*) AS n FROM {ACCESS} GROUP BY method")
def method_counts(spark, d):
    return agg.value_counts(view(spark, d, "access_log"), "method")


@query("top_paths", f"SELECT path, count(*) AS n FROM {ACCESS} GROUP BY path ORDER BY n DESC, path LIMIT 10")
def top_paths(spark, d):
    return agg.value_counts(view(spark, d, "access_log"), "path", 10)


@query("response_size_stats", f"SELECT CAST(sum(bytes) AS bigint) AS total_bytes, round(avg(bytes), 4) AS mean_bytes, round(quantile_cont(bytes, 0.5), 4) AS p50_bytes, round(quantile_cont(bytes, 0.95), 4) AS p95_bytes FROM {ACCESS}")
def response_size_stats(spark, d):
    one = agg.response_sizes(view(spark, d, "access_log"))
    return one.select("total_bytes", *[F.round(c, 4).alias(c) for c in one.columns[1:]])


@query("top_suspicious_paths", f"SELECT path, count(*) AS n FROM {ACCESS} WHERE {_signals()['suspicious_endpoints']} GROUP BY path ORDER BY n DESC, path LIMIT 5")
def top_suspicious_paths(spark, d):
    return web.top_suspicious_paths(view(spark, d, "access_log"), OPTS)


@query("top_malicious_ua", f"SELECT user_agent, count(*) AS n FROM {ACCESS} WHERE {_signals()['malicious_user_agent']} GROUP BY user_agent ORDER BY n DESC, user_agent LIMIT 5")
def top_malicious_ua(spark, d):
    return web.top_malicious_agents(view(spark, d, "access_log"), OPTS)


_LARGE = f"(SELECT path, bytes FROM {ACCESS} WHERE bytes > 1048576 ORDER BY bytes DESC, line_id LIMIT 5)"


@query("top_large_paths", f"SELECT path, min(bytes) AS bytes FROM {_LARGE} GROUP BY path")
def top_large_paths(spark, d):
    return web.top_large_paths(view(spark, d, "access_log"), OPTS)


@query("top_large_paths_max", f"SELECT path, max(bytes) AS bytes FROM {_LARGE} GROUP BY path")
def top_large_paths_max(spark, d):
    return web.top_large_paths(view(spark, d, "access_log"), OPTS, keep="max")


_REQUEST = "(method || ' ' || path || ' HTTP/1.1')"


@query("request_split", f"SELECT split_part({_REQUEST}, ' ', 1) AS method, split_part({_REQUEST}, ' ', 2) AS path, count(*) AS n FROM {ACCESS} GROUP BY 1, 2")
def request_split(spark, d):
    rows = view(spark, d, "access_log").select(F.concat_ws(" ", "method", "path", F.lit("HTTP/1.1")).alias("request"))
    method, path = split_request(F.col("request"))
    return rows.groupBy(method.alias("method"), path.alias("path")).agg(F.count(F.lit(1)).alias("n"))


@query("requests_per_minute", f"SELECT ip, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS minute, count(*) AS n FROM {ACCESS} GROUP BY 1, 2")
def requests_per_minute(spark, d):
    rates = web.requests_per_minute(view(spark, d, "access_log"), "ts")
    return rates.select("ip", F.date_format("minute", "yyyy-MM-dd HH:mm").alias("minute"), "n")


@query("entity_aggregates", f"SELECT ip, count(status) AS status_count, count(DISTINCT status) AS status_nunique, CAST(sum(bytes) AS bigint) AS bytes_sum, round(avg(bytes), 4) AS bytes_mean, round(stddev_samp(bytes), 4) AS bytes_std, count(DISTINCT path) AS path_nunique FROM {ACCESS} GROUP BY ip")
def entity_aggregates(spark, d):
    out = agg.entity_aggregates(view(spark, d, "access_log"), "ip")
    return out.select("ip", "status_count", "status_nunique", "bytes_sum", F.round("bytes_mean", 4).alias("bytes_mean"), F.round("bytes_std", 4).alias("bytes_std"), "path_nunique")


@query("entity_aggregates_by_day", f"SELECT ip, strftime(ts, '%Y-%m-%d') AS day, count(status) AS status_count, count(DISTINCT status) AS status_nunique, CAST(sum(bytes) AS bigint) AS bytes_sum, round(avg(bytes), 4) AS bytes_mean, round(stddev_samp(bytes), 4) AS bytes_std, count(DISTINCT path) AS path_nunique FROM {ACCESS} GROUP BY 1, 2")
def entity_aggregates_by_day(spark, d):
    rows = view(spark, d, "access_log").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    out = agg.entity_aggregates(rows, "ip", "day")
    return out.withColumns({"bytes_mean": F.round("bytes_mean", 4), "bytes_std": F.round("bytes_std", 4)})


@query("distinct_ips", f"SELECT count(DISTINCT ip) AS n_distinct FROM {ACCESS}")
def distinct_ips(spark, d):
    return agg.distinct_count(view(spark, d, "access_log"), "ip")


_TOP10 = f"(SELECT ip, count(*) AS n FROM {ACCESS} GROUP BY ip ORDER BY n DESC, ip LIMIT 10)"


@query("ip_user_agent", f"SELECT ip, substr(user_agent, 1, 32) AS user_agent FROM (SELECT ip, user_agent, row_number() OVER (PARTITION BY ip ORDER BY count(*) DESC, user_agent) AS r FROM {ACCESS} WHERE user_agent IS NOT NULL AND ip IN (SELECT ip FROM {_TOP10}) GROUP BY ip, user_agent) WHERE r = 1")
def ip_user_agent(spark, d):
    rows = view(spark, d, "access_log")
    return threats.agent_per_ip(rows, agg.value_counts(rows, "ip", 10))


_NOTE = "CASE " + " ".join(f"WHEN {has('t', p)} THEN {lit(n)}" for p, n in fv.PAYLOAD_NOTES) + " ELSE '' END"


@query("ip_notes", f"SELECT ip, {_NOTE} AS note FROM (SELECT ip, string_agg(path, ' ' ORDER BY line_id) AS t FROM (SELECT ip, path, line_id, row_number() OVER (PARTITION BY ip ORDER BY line_id) AS r FROM {ACCESS} WHERE ip IN (SELECT ip FROM {_TOP10})) WHERE r <= 10 GROUP BY ip)")
def ip_notes(spark, d):
    rows = view(spark, d, "access_log")
    return threats.payload_notes(rows, agg.value_counts(rows, "ip", 10), message="path")


@query("ip_evidence", f"SELECT ip, CAST(r AS int) AS pos, path FROM (SELECT ip, path, row_number() OVER (PARTITION BY ip ORDER BY line_id) AS r FROM {ACCESS} WHERE ip IN (SELECT ip FROM {_TOP10})) WHERE r <= 2")
def ip_evidence(spark, d):
    rows = view(spark, d, "access_log")
    return threats.evidence(rows, agg.value_counts(rows, "ip", 10), message="path")


def _counters(spark, d):
    rows = view(spark, d, "access_log")
    return web.signal_counters(rows, OPTS, ts="ts"), cats.category_counts(view(spark, d, "auth_log"), "Content")


def _cat_count_sql(name: str) -> str:
    return f"(SELECT count(*) FROM {frm('auth_log')} WHERE {any_has(chr(34) + 'Content' + chr(34), fv.BASELINE_CATEGORIES[name], True)})"


def _one_row_sql() -> str:
    names = ["bruteforce_events", "path_traversal", "file_access", "sqli", "xss", "high_freq_offenders", "bruteforce_offenders", "malicious_user_agent"]
    cols = ", ".join(f"max(n) FILTER (WHERE counter = {lit(n)}) AS {n}" for n in names)
    return f"(SELECT {cols}, {_cat_count_sql('authentication_errors')} AS auth FROM ({_counters_sql()}))"


@query("top_threat_type", f"""SELECT threat_type, CASE WHEN threat_type LIKE 'Brute-Force%' THEN 'Brute-Force' WHEN threat_type LIKE '%Traversal%' THEN 'Traversal' WHEN threat_type LIKE '%SQL%' THEN 'SQLi' WHEN threat_type LIKE '%XSS%' THEN 'XSS' ELSE 'Probing' END AS row_label FROM (
SELECT CASE WHEN bf > 0 AND bf >= greatest(tr, sqli, xss, hf) THEN 'Brute-Force Attack' WHEN sqli > 0 AND sqli >= greatest(tr, xss, hf) THEN 'SQL Injection Probing' WHEN xss > 0 AND xss >= greatest(tr, hf) THEN 'XSS Probing' WHEN tr > 0 THEN 'Path Traversal/File Enumeration' WHEN hf > 0 THEN 'High-Frequency Scanning' ELSE 'Suspicious Activity' END AS threat_type
FROM (SELECT CASE WHEN bruteforce_events > 0 THEN bruteforce_events ELSE auth END AS bf, path_traversal + file_access AS tr, sqli, xss, high_freq_offenders AS hf FROM {_one_row_sql()}))""")
def top_threat_type(spark, d):
    return threats.top_threat_type(*_counters(spark, d))


def _recommendations_sql() -> str:
    t = fv.RECOMMENDATION_TEXTS
    before, after = t["block_top_ip"].split("{ip}")
    rows = [
        ("0", "true", f"{lit(before)} || ip || {lit(after)}"), ("1", "true", lit(t["fail2ban"])),
        ("2", "bruteforce_offenders > 0", lit(t["bruteforce"])), ("3", "path_traversal + file_access > 0", lit(t["traversal"])),
        ("4", "malicious_user_agent > 0", lit(t["scanner"])), ("5", "high_freq_offenders > 0", lit(t["high_freq"])),
        ("6", "auth > 0", lit(t["auth"])),
    ]
    base = f"(SELECT *, (SELECT ip FROM {_TOP10} ORDER BY n DESC, ip LIMIT 1) AS ip FROM {_one_row_sql()})"
    return f"WITH o AS (SELECT * FROM {base}) " + union([f"SELECT {i} AS ord, {txt} AS recommendation FROM o WHERE {cond}" for i, cond, txt in rows])


@query("recommendations", _recommendations_sql())
def recommendations(spark, d):
    counters, counts = _counters(spark, d)
    return threats.recommendations(counters, counts, agg.value_counts(view(spark, d, "access_log"), "ip", 10))


@query("geo_lookup", f"SELECT ip, CASE WHEN start IS NULL THEN NULL WHEN start < 200000000 THEN 'US' ELSE 'XX' END AS country, CASE WHEN start IS NOT NULL THEN 'city-' || CAST(start % 97 AS varchar) END AS city FROM (SELECT DISTINCT ip, CASE WHEN CAST(split_part(ip, '.', 4) AS int) <= 199 THEN CASE split_part(ip, '.', 1) WHEN '10' THEN 167772160 WHEN '192' THEN 3232235776 WHEN '8' THEN 134743040 ELSE 757145600 END END AS start FROM {ACCESS})")
def geo_lookup(spark, d):
    ips = view(spark, d, "access_log").select("ip").distinct()
    return with_geo(ips, geo_ranges(spark, d))


_V6 = "'2001:db8:' || CAST(user_id % 7 AS {string}) || '::' || CAST(user_id AS {string})"


@query("geo_lookup_v6", """SELECT DISTINCT '2001:db8:' || CAST(user_id % 7 AS varchar) || '::' || CAST(user_id AS varchar) AS ip,
 CASE WHEN user_id % 7 = 2 AND user_id BETWEEN 10 AND 49 THEN 'NN' WHEN user_id % 7 IN (1, 2, 3) THEN 'C' || CAST(user_id % 7 AS varchar) WHEN user_id % 7 <= 5 THEN 'ALL' END AS country FROM events""")
def geo_lookup_v6(spark, d):
    """Places of IPv6 addresses: a wide range, narrower ones inside it and one inside of those."""
    ips = table(spark, d, "events").select(F.expr(_V6.format(string="string")).alias("ip")).distinct()
    last = ":ffff:ffff:ffff:ffff:ffff"
    nets = [("2001:db8::", f"2001:db8:5{last}", "ALL"), ("2001:db8:2::10", "2001:db8:2::49", "NN")]
    nets += [(f"2001:db8:{k}::", f"2001:db8:{k}{last}", f"C{k}") for k in (1, 2, 3)]
    ranges = spark.createDataFrame([(a, b, c, None) for a, b, c in nets], "start string, end string, country string, city string")
    return with_geo(ips, ranges).select("ip", "country")


@query("align_columns", "SELECT c_custkey, 0 AS c_extra, c_name FROM customer")
def align_columns(spark, d):
    return schema.align_columns(table(spark, d, "customer"), ["c_custkey", "c_extra", "c_name"], 0)


@query("union_aligned", "SELECT CASE WHEN kind = 0 THEN 'orders' ELSE 'lineitem' END AS part, count(*) AS n, round(sum(qty), 2) AS qty, count(st) AS statuses, count(ok) AS order_keys FROM (SELECT 0 AS kind, NULL AS qty, o_orderstatus AS st, o_orderkey AS ok FROM orders UNION ALL SELECT 1, l_quantity, NULL, NULL FROM lineitem) GROUP BY 1")
def union_aligned(spark, d):
    both = schema.union_aligned(table(spark, d, "orders"), table(spark, d, "lineitem"))
    part = F.when(F.col("l_linenumber").isNull(), "orders").otherwise("lineitem")
    return both.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"),
        F.count("o_orderstatus").alias("statuses"), F.count("o_orderkey").alias("order_keys"))
