import pytest
from pyspark.sql import functions as F

from loomlog.operators import threats
from loomlog.operators import websignals as web
from loomlog.options import WebOptions
from loomlog.plans import reports

ROWS = [
    ("1.1.1.1", "GET", "/index.php?id=1 UNION SELECT 1", 200, 200, "sqlmap", "-"),
    ("2.2.2.2", "DELETE", "/admin", 403, 6000000, "Mozilla", "http://evil.tld"),
    ("3.3.3.3", "GET", "/..%2e%2fetc/passwd", 200, 100, "curl", "-"),
    ("4.4.4.4", "GET", "/search?q=%27%22--", 200, 100, "zaproxy", "-"),
]
SHAPE = "ip string, method string, path string, status int, bytes long, user_agent string, referer string"


def counters(df, **opts):
    return {r["counter"]: r["n"] for r in web.signal_counters(df, WebOptions(**opts)).collect()}


def test_fixture_counts(spark):
    got = counters(spark.createDataFrame(ROWS, SHAPE), large_bytes=1024)
    assert got["sqli"] == 1 and got["suspicious_endpoints"] >= 1 and got["path_traversal"] == 1
    assert got["suspicious_params_chars"] >= 1 and got["malicious_user_agent"] == 2 and got["large_responses"] == 1
    assert got["sensitive_external_referer"] == 1 and got["uncommon_with_error"] == 1 and len(got) == 19


def test_case_sensitivity_trap(spark):
    df = spark.createDataFrame(ROWS[:1], SHAPE)
    assert counters(df)["sqli"] == 0 and counters(df, case_sensitive=False)["sqli"] == 1


def test_null_agent_is_not_empty_but_a_missing_column_is(spark):
    df = spark.createDataFrame([("/a", None, None), ("/a", "-", None), ("/a", " ", None)], "path string, user_agent string, referer string")
    assert counters(df)["empty_user_agent"] == 2 and counters(df, nulls_as_empty=True)["empty_user_agent"] == 3
    assert counters(df.drop("user_agent"))["empty_user_agent"] == 3


def test_not_http_like(spark):
    got = web.signal_counters(spark.createDataFrame([], "x string")).collect()
    assert got[0]["counter"] == web.NOTE


def test_request_and_brute_force(spark):
    rows = [("9.9.9.9", "POST /login HTTP/1.1", "401", f"2023-01-01 00:{i:02d}:00") for i in range(12)]
    df = spark.createDataFrame(rows, "ip string, request string, status string, timestamp string")
    got = counters(df, bruteforce_threshold=10, requests_per_minute=1)
    assert got["bruteforce_events"] == 12 and got["bruteforce_offenders"] == 1 and got["high_freq_offenders"] == 1
    assert tuple(web.bruteforce_offenders(df, WebOptions(bruteforce_threshold=10)).first()) == ("9.9.9.9", 12)
    assert tuple(web.with_request_parts(df).select("method", "path").first()) == ("POST", "/login")


def test_bad_numbers(spark):
    df = spark.createDataFrame([("/login", "40x", "big"), ("/login", "401", "9999999")], "path string, status string, bytes string")
    got = counters(df)
    assert got["bruteforce_events"] == 1 and got["large_responses"] == 1


def test_duplicate_large_path(spark):
    df = spark.createDataFrame([(1, "/a", 10), (2, "/a", 7), (3, "/b", 9)], "line_id int, path string, bytes long")
    assert dict(map(tuple, web.top_large_paths(df, WebOptions(large_bytes=1)).collect())) == {"/a": 7, "/b": 9}
    assert dict(map(tuple, web.top_large_paths(df, WebOptions(large_bytes=1), keep="max").collect())) == {"/a": 10, "/b": 9}


def test_scores_round_half_even_and_skip_invalid(spark):
    tops = spark.createDataFrame([("1.1.1.1", 8), ("2.2.2.2", 4), ("bad", 16)], "ip string, n long")
    scores = spark.createDataFrame([("1.1.1.1", 100)], "ip string, abuse_score int")
    assert {r["ip"]: r["score"] for r in threats.threat_scores(tops, scores).collect()} == {"1.1.1.1": 650, "2.2.2.2": 175}


@pytest.mark.parametrize("n,total,want", [(80, 100, 1), (79, 100, 0), (1, 1, 1)])
def test_dominant_address(spark, n, total, want):
    rows = [("a", n)] + ([("b", total - n)] if total > n else [])
    assert threats.dominant_ip(spark.createDataFrame(rows, "ip string, n long")).count() == want


def test_reports_survive_thin_frames(spark):
    thin = spark.createDataFrame([(1, "ok")], "line_id int, message string")
    sections = reports.standard_sections(thin)
    assert {r["key"]: r["value"] for r in sections["parsing"].collect()} == {"total_logs": "1", "sample_message": "ok"}
    assert "signals" not in sections and reports.combined(sections).count() > 2
    quiet = spark.createDataFrame([(1, 1131566461, "info"), (2, 1131566462, "ok")], "line_id int, Timestamp long, Content string")
    intel = reports.intel_sections(quiet)
    assert intel["unique_threats"].first()["value"] == "0" and intel["dashboard"].count() == 0
    web_rows = spark.createDataFrame([(1, "GET", "/admin", 200, 10, "sqlmap"), (2, "GET", "/", 200, 5, "x"), (3, "GET", "/", 404, 5, "x")],
                                     "line_id int, method string, path string, status int, bytes long, user_agent string")
    full = reports.standard_sections(web_rows)
    assert full["signals"].count() >= 1 and full["top_malicious_agents"].first()["key"] == "sqlmap"


def test_buckets_and_actions(spark):
    rows = [(i, "1.1.1.1", "Failed password for user root") for i in range(12)] + [(100 + i, "2.2.2.2", "Invalid user x") for i in range(5)] + [(200, "3.3.3.3", "Invalid user x")]
    df = spark.createDataFrame(rows, "line_id int, ip string, message string")
    summary = threats.threat_summary(df, threshold=10)
    got = {r["label"]: (r["matches"], r["unique_ips"]) for r in summary.collect()}
    assert got["Brute Force (High)"] == (12, 1) and got["Low & Slow"] == (5, 1) and got["SQL Injection"] == (0, 0)
    ranked = threats.ranked_threat_ips(summary)
    assert [r["ip"] for r in ranked.orderBy("rank").collect()] == ["1.1.1.1", "2.2.2.2"]
    assert threats.ip_actions(ranked).count() == 2
    assert threats.rows_of(df, ranked.filter(F.col("rank") == 1)).count() == 12


def test_addresses_as_ordered_keys(spark):
    import ipaddress
    texts = ["1.2.3.4", "255.255.255.255", "::", "::1", "2001:db8::1", "2001:0DB8:0:0:8:800:200C:417A", "fe80::1%eth0", "::ffff:10.0.0.1",
             "1:2:3:4:5:6:7:8", "1::8", "64:ff9b::192.0.2.33", "no", "1.2.3", "1:2", "", None]
    from loomlog.functions.ip import ip_key
    got = dict(spark.createDataFrame([(t,) for t in texts], "t string").select("t", ip_key(F.col("t")).alias("k")).collect())
    for t in texts[:11]:
        a = ipaddress.ip_address(t.split("%")[0])
        number = int(a) if a.version == 6 else int(a) + (0xFFFF << 32)
        assert got[t] == f"{number:032x}", t
    assert all(got[t] is None for t in texts[11:])


def test_smallest_range_of_an_address(spark):
    from loomlog.operators.lookups import with_geo
    ranges = spark.createDataFrame([
        ("10.0.0.0", "10.255.255.255", "WIDE", None), ("10.1.2.3", "10.1.2.200", "NARROW", "x"), ("2001:db8::", "2001:db8::ffff", "SIX", "y"),
        ("9.0.0.9", "9.0.0.1", "NONE", None), ("bad", "10.0.0.1", "NONE", None)], "start string, end string, country string, city string")
    ips = spark.createDataFrame([("10.1.2.2",), ("10.1.2.3",), ("10.1.2.200",), ("10.1.2.201",), ("2001:db8::12",), ("2001:db9::",), ("9.0.0.5",), ("x",), (None,), ("10.1.2.3",)], "ip string")
    got = sorted(((r["ip"], r["country"], r["city"]) for r in with_geo(ips, ranges).collect()), key=str)
    assert got == sorted([("10.1.2.2", "WIDE", None), ("10.1.2.3", "NARROW", "x"), ("10.1.2.3", "NARROW", "x"), ("10.1.2.200", "NARROW", "x"), ("10.1.2.201", "WIDE", None),
                          ("2001:db8::12", "SIX", "y"), ("2001:db9::", None, None), ("9.0.0.5", None, None), ("x", None, None), (None, None, None)], key=str)


def test_report_facts_are_what_the_operators_count(spark):
    from loomlog.operators import aggregates as agg
    from loomlog.operators import categories as cats
    from loomlog.options import ReportOptions
    from loomlog.plans import reports
    rows = [(k, ["1.1.1.1", "2.2.2.2", None][k % 3], ["GET", "POST", None][k % 3 - 1], ["/login", "/a?id=1 union select 1", None, "/x"][k % 4],
             ["200", "401", "bad", "404.0"][k % 4], 9000 * (k % 2), ["curl", "sqlmap", None][k % 3], None, f"2024-01-01 00:00:{k % 60:02d}", "Failed password error")
            for k in range(130)]
    df = spark.createDataFrame(rows, "line_id int, ip string, method string, path string, status string, bytes int, user_agent string, referer string, timestamp string, message string")
    opts = ReportOptions()
    facts, _, _, _ = reports._facts(df, opts, True)
    from loomlog.operators import threats
    from loomlog.operators import websignals as w
    pairs = [(facts.counters(), w.signal_counters(df, opts.web)), (facts.categories(), cats.category_counts(df, "message", reports.rules_for(opts))),
             (facts.statuses(), agg.status_distribution(df)), (facts.status_classes(), agg.status_classes(df)), (facts.values("path", "path", 3), agg.value_counts(df, "path", 3)),
             (facts.failed_logins(), w.bruteforce_offenders(df, opts.web)), (facts.busy_ips(), w.high_frequency_ips(df, opts.web)),
             (facts.threats().drop("_top"), threats.threat_summary(df, None, reports.RuleSet.of({}, ignore_case=False), opts.web.bruteforce_threshold, "message").drop("_top"))]
    for got, want in pairs:
        assert sorted(map(str, got.select(*sorted(got.columns)).collect())) == sorted(map(str, want.select(*sorted(want.columns)).collect()))
