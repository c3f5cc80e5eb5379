import pytest
from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog import schema
from loomlog.functions import ip as ipf
from loomlog.functions import severity as sev
from loomlog.operators import aggregates as agg
from loomlog.operators import categories as cats
from loomlog.options import ReportOptions
from loomlog.rules import ALL_RULES, BASELINE_RULES, RuleError, RuleSet


def texts(spark, *rows):
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "line_id long, message string")


def test_categories_and_null_message(spark):
    df = texts(spark, "Connection to db refused", "ACCESS DENIED", "Out of memory: low disk space", None, "all good")
    got = [r[0] for r in df.orderBy("line_id").select(cats.categories_of(F.col("message"))).collect()]
    assert got == [["connection_errors"], ["authentication_errors"], ["resource_errors"], [], []]


def test_override_replaces_and_bad_rules_raise(spark):
    rules = BASELINE_RULES.extended({"data_errors": ["zzz"], "mine": ["^m"]})
    counts = {r["category"]: r["n"] for r in cats.category_counts(texts(spark, "corrupt data", "zzz", "mx"), "message", rules).collect()}
    assert counts["data_errors"] == 1 and counts["mine"] == 1 and counts["system_errors"] == 0
    assert list(counts)[:6] == BASELINE_RULES.names
    with pytest.raises(RuleError):
        BASELINE_RULES.extended({"bad": ["("]})
    with pytest.raises(ValueError):
        ReportOptions().replace(nope=1)
    assert ReportOptions().replace(web={"large_bytes": 7}).web.large_bytes == 7


def test_every_category_has_a_flag(spark):
    row = cats.with_error_flags(texts(spark, "fine"), "message", ALL_RULES).first().asDict()
    flags = [v for k, v in row.items() if k.startswith("error_")]
    assert len(flags) == len(ALL_RULES.names) and not any(flags) and row["has_error"] is False
    assert len(ALL_RULES.table(spark).collect()) == sum(len(p) for _, p in ALL_RULES.categories)


def test_level_fallback(spark):
    df = spark.createDataFrame([(" error ",), ("FATAL",), ("info",)], "Severity string")
    assert {r["level"]: r["n"] for r in cats.level_counts(df).collect()} == {"ERROR": 1, "FATAL": 1, "CRITICAL": 0, "TOTAL": 2}
    assert cats.level_counts(texts(spark, "a")).count() == 0


@pytest.mark.parametrize("text,want", [
    ("cron job error", "normal"), ("please zoom in", "anomaly"), ("USB device error", "normal"),
    ("http GET 1 200 ok from 10.0.0.1 login", "normal"), ("login from 8.8.8.8", "anomaly"),
    ("login from 999.1.1.1", "anomaly"), ("login from 203.0.113.5", "normal"), ("login from 127.0.0.1", "normal"),
    ("Accepted password for guest", "anomaly"), ("Accepted password for bob", "normal"), ("plain", "normal"),
])
def test_ordered_row_rules(spark, text, want):
    assert texts(spark, text).select(sev.classify_entry(F.col("message"))).first()[0] == want


def test_private_addresses(spark):
    ips = ["999.1.1.1", "127.0.0.1", "203.0.113.5", "8.8.8.8", "172.31.0.1", "172.32.0.1", "198.19.1.1", "240.0.0.1", "192.0.0.8", "010.0.0.1"]
    df = spark.createDataFrame([(i,) for i in ips], "ip string")
    got = [r[0] for r in df.select(ipf.is_private(F.col("ip"))).collect()]
    assert got == [False, True, True, False, True, False, True, True, False, False]


def test_valid_ips(spark):
    good = ["1.2.3.4", "::1", "2001:db8::1", "::", "1:2:3:4:5:6:7:8", "::ffff:1.2.3.4", "fe80::1%eth0"]
    bad = ["01.2.3.4", "256.1.1.1", "1.2.3", "1:2:3", ":::", "1:2:3:4:5:6:7:8:9", "gggg::", ""]
    df = spark.createDataFrame([(i,) for i in good + bad], "ip string")
    assert [r[0] for r in df.select(ipf.is_valid_ip(F.col("ip"))).collect()] == [True] * len(good) + [False] * len(bad)


def test_extraction_priority(spark):
    df = texts(spark, "from 1.1.1.1 rhost=2.2.2.2", "Disconnected from 3.3.3.3 port", "from 999.2.2.2", "none")
    strict = [r[0] for r in df.select(ipf.extract_ip(F.col("message"))).collect()]
    loose = [r[0] for r in df.select(ipf.extract_ip_loose(F.col("message"))).collect()]
    assert strict == ["2.2.2.2", "3.3.3.3", None, None] and loose == ["2.2.2.2", "3.3.3.3", "999.2.2.2", None]


def test_top_attackers_without_ip_column(spark):
    msg = "authentication failure; logname= uid=0 euid=0 tty=NODEVssh ruser= rhost=218.188.2.4"
    df = spark.createDataFrame([(i, msg) for i in range(46)], "LineId int, Content string")
    got = agg.top_attackers(df, cats.is_linux_auth_error(F.col("Content")), 10)
    assert [tuple(r) for r in got.collect()] == [("218.188.2.4", 46)]


def test_column_roles(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], "id int, description string, clientIp string, Content string")
    assert schema.ip_column(df) == "clientIp" and schema.message_column(df) == "Content"
    df = spark.createDataFrame([(1, "a", "b")], "id int, description string, http_ua string")
    assert schema.ip_column(df) is None and schema.agent_column(df) == "http_ua" and schema.message_column(df) == "id"


def test_epoch_time_range(spark):
    df = spark.createDataFrame([(1131566461,), (1131566521,)], "Timestamp long")
    assert tuple(agg.time_range(df).first()) == ("2005-11-09 20:01:01", "2005-11-09 20:02:01")
    df = spark.createDataFrame([("2024/01/02", "10:00:00")], "Date string, Time string")
    assert agg.time_range(df.withColumnRenamed("Time", "time")).first()["start"].startswith("2024-01-02")
    assert agg.time_range(texts(spark, "x")).first()["start"] is None


def test_healthcheck_override_and_keywords(spark):
    line = "2024-01-01 ERROR [HealthCheck] x PASSED CPU: 12%, Memory: 30%"
    row = texts(spark, line).select(
        sev.override_prediction(F.lit(True), F.col("message")), sev.keyword_severity(F.col("message")),
        *sev.passed_healthcheck_usage(F.col("message")), sev.rule_truth(F.col("message"))).first()
    assert tuple(row) == (False, 3, 12.0, 30.0, False)


def test_alerts_per_day_and_overall(spark):
    rows = [(f"2024-01-0{1 + i % 2} 00:00:00", "1.1.1.1", "Invalid user bob") for i in range(8)] + [("2024-01-01 00:00:00", "2.2.2.2", "invalid user bob")] * 60
    df = spark.createDataFrame(rows, "timestamp string, ip string, message string")
    assert [(r["ip"], r["category"]) for r in cats.volume_alerts(df).collect()] == [("1.1.1.1", "low_and_slow_attack")]
    assert cats.volume_alerts(df, by_day="timestamp").count() == 0


def test_flagged_set_is_auth_only(spark):
    df = texts(spark, "permission denied", "corrupt data", "Authentication failed for x")
    assert df.filter(cats.flagged_for_insight(F.col("message"))).count() == 2
    assert RuleSet.of({"a": []}).matches("a", F.lit("x")) is not None and len(fv.COUNTER_NAMES) == 19
