"""Queries about addresses: volume buckets, threat labels, scores, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog.catalog.registry import query
from loomlog.catalog.sql import any_has, frm, has, lit, union
from loomlog.functions.ip import is_valid_ip
from loomlog.operators import aggregates as agg
from loomlog.operators import categories as cats
from loomlog.operators import threats
from loomlog.operators.lookups import with_reputation
from loomlog.rules import DOMAIN_RULES, RuleSet
from loomlog.sources.views import geo_ranges, reputation, reputation_sql, view

AUTH = frm("auth_log")
C = '"Content"'
T = 8   # failed logins per address that count as high volume in these queries


def _dom(name: str, col: str = C) -> str:
    return any_has(col, fv.DOMAIN_CATEGORIES[name])


def _buckets(threshold: int = T) -> str:
    return (f"(SELECT ip, count(*) AS n, CASE WHEN count(*) >= {threshold} THEN 'high' ELSE 'low' END AS bucket FROM {AUTH}"
            f" WHERE {_dom('brute_force')} GROUP BY ip HAVING count(*) >= {threshold // 2 or 5})")


_BUCKETS = _buckets()


@query("bruteforce_buckets", f"SELECT * FROM {_BUCKETS}")
def bruteforce_buckets(spark, d):
    return threats.bruteforce_buckets(view(spark, d, "auth_log"), DOMAIN_RULES.matches("brute_force", F.col("Content")), T)


@query("offender_rows", f"SELECT line_id, ip FROM {AUTH} WHERE ip IN (SELECT ip FROM {_BUCKETS} WHERE bucket = 'high')")
def offender_rows(spark, d):
    rows = view(spark, d, "auth_log").select("line_id", "ip", "Content")
    found = threats.bruteforce_buckets(rows, DOMAIN_RULES.matches("brute_force", F.col("Content")), T)
    return threats.rows_of(rows, found.filter("bucket = 'high'")).select("line_id", "ip")


def _label_rows(threshold: int = T) -> str:
    parts = []
    for label, names in fv.THREAT_LABELS.items():
        known = [n for n in names if n in fv.DOMAIN_CATEGORIES]
        if label in ("Brute Force (High)", "Low & Slow"):
            continue
        cond = " OR ".join(_dom(n) for n in known)
        if label == "Known Malicious IP":   # the address column has hits in this data, so it replaces the text
            cond = has("ip", fv.DOMAIN_CATEGORIES["malicious_ip"][0])
        parts.append(f"SELECT {lit(label)} AS label, ip FROM a WHERE {cond}")
    for label, bucket in (("Brute Force (High)", "high"), ("Low & Slow", "low")):
        parts.append(f"SELECT {lit(label)} AS label, ip FROM a WHERE {_dom('brute_force')} AND ip IN (SELECT ip FROM {_buckets(threshold)} WHERE bucket = '{bucket}')")
    return union(parts)


def _fallback_rows() -> str:
    fb, parts = fv.FALLBACK_PATTERNS, []
    for label in ("Application Errors", "Web Attack Probes", "SQL Injection", "Dir Traversal", "Admin Abuse"):
        parts.append(f"SELECT {lit(label)} AS label, ip FROM a WHERE {has(C, fb[label])}")
    parts.append(f"SELECT 'Known Malicious IP' AS label, ip FROM a WHERE {has('ip', fb['Known Malicious IP'])}")
    per_ip = f"SELECT ip FROM a WHERE {has(C, fb['brute_force'])} GROUP BY ip HAVING count(*)"
    parts.append(f"SELECT 'Brute Force (High)' AS label, ip FROM a WHERE {has(C, fb['brute_force'])} AND ip IN ({per_ip} >= {T})")
    parts.append(f"SELECT 'Low & Slow' AS label, ip FROM a WHERE {has(C, fb['brute_force'])} AND ip IN ({per_ip} BETWEEN {T // 10} AND {T - 1})")
    return union(parts)


def _summary_sql(labels: list[str], rows: str) -> str:
    frame = union([f"SELECT {i} AS ord, {lit(n)} AS label" for i, n in enumerate(labels)])
    return f"""WITH a AS (SELECT * FROM {AUTH}), r AS ({rows}), c AS (SELECT label, ip, count(*) AS n FROM r GROUP BY label, ip),
 k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, ip) AS pos FROM c)
 SELECT f.ord, f.label, coalesce((SELECT CAST(sum(n) AS bigint) FROM c WHERE c.label = f.label), 0) AS matches,
 (SELECT count(ip) FROM c WHERE c.label = f.label) AS unique_ips,
 coalesce((SELECT string_agg(ip || ' (' || CAST(n AS varchar) || ' events)', ', ' ORDER BY pos) FROM k WHERE k.label = f.label AND pos <= 3), '') AS top_ips
 FROM ({frame}) f"""


@query("threat_summary", _summary_sql(fv.WEB_SUMMARY_LABELS, _label_rows()))
def threat_summary(spark, d):
    return threats.threat_summary(view(spark, d, "auth_log"), fv.WEB_SUMMARY_LABELS, DOMAIN_RULES, T, "Content").drop("_top")


@query("threat_summary_ops", _summary_sql(fv.OPS_SUMMARY_LABELS, _label_rows()))
def threat_summary_ops(spark, d):
    return threats.threat_summary(view(spark, d, "auth_log"), fv.OPS_SUMMARY_LABELS, DOMAIN_RULES, T, "Content").drop("_top")


@query("threat_summary_fallback", _summary_sql(list(fv.THREAT_LABELS), _fallback_rows()))
def threat_summary_fallback(spark, d):
    """No configured rules: the simple patterns take over."""
    return threats.threat_summary(view(spark, d, "auth_log"), None, RuleSet.of({}, ignore_case=False), T, "Content").drop("_top")


def _ranked_sql(threshold: int = T) -> str:
    return f"""WITH a AS (SELECT * FROM {AUTH}), r AS ({_label_rows(threshold)}), c AS (SELECT label, ip, count(*) AS n FROM r GROUP BY label, ip),
 k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, ip) AS pos FROM c),
 w AS (SELECT 0 AS o, 'Brute Force (High)' AS label, 'Brute-force attacker' AS reason UNION ALL SELECT 1, 'Low & Slow', 'Low-and-slow brute force'
 UNION ALL SELECT 2, 'Known Malicious IP', 'Known malicious scanner' UNION ALL SELECT 3, 'Web Attack Probes', 'Web probing'),
 q AS (SELECT CAST(row_number() OVER (ORDER BY o, pos) AS int) AS rank, ip, reason, n FROM k JOIN w USING (label) WHERE pos <= 3)"""


_RANKED = _ranked_sql()


def threat_sql(threshold: int) -> tuple[str, str]:
    """The threat summary and the ranked addresses for a threshold of failed logins."""
    return _summary_sql(list(fv.THREAT_LABELS), _label_rows(threshold)), f"{_ranked_sql(threshold)} SELECT * FROM q"


def _ranked(spark, d):
    summary = threats.threat_summary(view(spark, d, "auth_log"), None, DOMAIN_RULES, T, "Content")
    return threats.ranked_threat_ips(summary)


@query("top_threat_ips", f"{_RANKED} SELECT * FROM q WHERE rank <= 5")
def top_threat_ips(spark, d):
    return _ranked(spark, d).filter("rank <= 5")


def actions_sql(ranked: str) -> str:
    cases = []
    for reason, text in fv.ACTION_TEXTS.items():
        before, after = text.split("{ip}")
        cases.append(f"WHEN {lit(reason)} THEN {lit(before)} || ip || {lit(after)}")
    return f"SELECT rank, ip, CASE reason {' '.join(cases)} END AS action FROM (SELECT *, row_number() OVER (PARTITION BY ip ORDER BY rank) AS f FROM {ranked}) WHERE f = 1 ORDER BY rank LIMIT 3"


@query("ip_actions", f"{_RANKED} " + actions_sql("q"))
def ip_actions(spark, d):
    return threats.ip_actions(_ranked(spark, d))


_TOP = f"(SELECT ip, count(*) AS n FROM {AUTH} WHERE {any_has(C, fv.LINUX_AUTH_PATTERNS)} GROUP BY ip ORDER BY n DESC, ip LIMIT 10)"


def _top(spark, d):
    return agg.top_attackers(view(spark, d, "auth_log"), cats.is_linux_auth_error(F.col("Content")), 10, "Content")


@query("top_attackers", f"SELECT * FROM {_TOP}")
def top_attackers(spark, d):
    return _top(spark, d)


@query("dominant_ip", f"SELECT ip, round(n * 100.0 / total, 6) AS share_pct, total FROM (SELECT ip, n, CAST(sum(n) OVER () AS bigint) AS total, row_number() OVER (ORDER BY n DESC, ip) AS r FROM {_TOP}) WHERE r = 1 AND n * 100.0 / total >= 8")
def dominant_ip(spark, d):
    """With an 8 % bar, so the derived data has a winner to report."""
    return threats.dominant_ip(_top(spark, d), share=8.0).withColumn("share_pct", F.round("share_pct", 6))


@query("ip_reputation", f"SELECT t.ip, t.n, CASE WHEN abuse_score IS NOT NULL THEN greatest(0, least(100, abuse_score)) END AS abuse_score, CASE WHEN ipqs_score IS NOT NULL THEN greatest(0, least(100, ipqs_score)) END AS ipqs_score FROM {_TOP} t LEFT JOIN {reputation_sql()} r ON t.ip = r.ip")
def ip_reputation(spark, d):
    return with_reputation(_top(spark, d), reputation(spark, d))


@query("threat_scores", f"SELECT t.ip, t.n, r.abuse_score, CAST(round_even(least(1000.0, 700.0 * CAST(t.n AS double) / max(t.n) OVER () + coalesce(r.abuse_score, 0) * 3.0), 0) AS int) AS score FROM {_TOP} t LEFT JOIN {reputation_sql()} r ON t.ip = r.ip")
def threat_scores(spark, d):
    return threats.threat_scores(_top(spark, d), reputation(spark, d))


@query("ranked_ips", f"SELECT *, CAST(row_number() OVER (ORDER BY score DESC, n DESC, ip) AS int) AS rank FROM (SELECT t.ip, t.n, r.abuse_score, CAST(round_even(least(1000.0, 700.0 * CAST(t.n AS double) / max(t.n) OVER () + coalesce(r.abuse_score, 0) * 3.0), 0) AS int) AS score FROM {_TOP} t LEFT JOIN {reputation_sql()} r ON t.ip = r.ip)")
def ranked_ips(spark, d):
    return threats.ranked_ips(threats.threat_scores(_top(spark, d), reputation(spark, d)))


_HEAD = f"(SELECT * FROM {_TOP} ORDER BY n DESC, ip LIMIT 5)"


@query("enriched_ips", f"SELECT h.ip, h.n AS events, abuse_score, ipqs, CASE WHEN start IS NULL THEN NULL WHEN start < 200000000 THEN 'US' ELSE 'XX' END AS country, CASE WHEN abuse_score IS NOT NULL THEN h.n * abuse_score END AS risk FROM (SELECT *, CASE WHEN CAST(split_part(ip, '.', 4) AS int) <= 199 THEN CASE split_part(ip, '.', 1) WHEN '10' THEN 167772160 WHEN '192' THEN 3232235776 WHEN '8' THEN 134743040 WHEN '45' THEN 757145600 END END AS start FROM {_HEAD}) h LEFT JOIN (SELECT ip, abuse_score, greatest(0, least(100, ipqs_score)) AS ipqs FROM {reputation_sql()}) r ON h.ip = r.ip")
def enriched_ips(spark, d):
    out = threats.enrich(_top(spark, d), reputation(spark, d), geo_ranges(spark, d))
    return out.select("ip", "events", "abuse_score", F.col("ipqs_score").alias("ipqs"), "country", "risk")


@query("valid_ips", f"SELECT ip, regexp_matches(ip, {lit(fv.VALID_IPV4)}) AS is_valid, count(*) AS n FROM {AUTH} GROUP BY 1")
def valid_ips(spark, d):
    return view(spark, d, "auth_log").groupBy("ip", is_valid_ip(F.col("ip")).alias("is_valid")).agg(F.count(F.lit(1)).alias("n"))
