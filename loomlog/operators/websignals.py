"""Security signals over HTTP access logs.

All row signals are boolean columns of one projection; all counters over them are
one aggregate. Only the two per-address questions (failed logins, request rate)
group by anything, and both reduce to counts before they shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog import schema
from loomlog.functions.text import split_request, to_number
from loomlog.options import WebOptions

NOTE = "No HTTP-like columns present"


def _escaped(fragments: tuple[str, ...]) -> list[str]:
    return [re.escape(f.strip("/")) for f in fragments]


def is_access_like(df: DataFrame) -> bool:
    """Does the frame have any of status, method, path (directly or through ``request``)?"""
    return bool({"status", "method", "path"} & set(with_request_parts(df).columns))


def with_request_parts(df: DataFrame) -> DataFrame:
    """Derive method and path from ``request`` when either is missing."""
    if "request" in df.columns and not {"method", "path"} <= set(df.columns):
        method, path = split_request(F.col("request"))
        return df.withColumn("method", method).withColumn("path", path)
    return df


def number_column(df: DataFrame, name: str, default: float) -> Column:
    """Numeric column, bad or null values as ``default``."""
    if name not in df.columns:
        return F.lit(default)
    kind = dict(df.dtypes)[name]
    number = to_number(F.col(name)) if kind == "string" else F.col(name).cast("double")
    return F.coalesce(number, F.lit(default))


def signal_columns(df: DataFrame, opts: WebOptions = WebOptions()) -> dict[str, Column]:
    """The 17 row signals as non-null boolean columns. ``df`` must have its request parts.

    ``case_sensitive`` searches paths, agents and referers as written; turn it off for any-case search.
    ``nulls_as_empty`` treats a null like a missing column, i.e. as an empty text.
    """
    def text(name: str) -> Column:
        col = schema.text_or(df, name)
        return F.coalesce(col, F.lit("")) if opts.nulls_as_empty else col

    def search(col: Column, pattern: str) -> Column:
        return col.rlike(pattern if opts.case_sensitive else f"(?i){pattern}")

    path = text("path") if "path" in df.columns else text("request")
    status = number_column(df, "status", -1).cast("int")
    size = number_column(df, "bytes", 0.0)
    agent, referer = text("user_agent"), text("referer")

    uncommon = F.upper(text("method")).isin(*fv.UNCOMMON_METHODS)
    words = "|".join(fv.SENSITIVE_WORDS + _escaped(opts.sensitive_paths))
    sensitive = search(path, rf"/({words})(?:\b|/)") | search(path, fv.SUSPICIOUS_KEYWORDS)
    logins = "|".join(fv.LOGIN_WORDS + _escaped(opts.login_paths))
    scanners = "|".join(fv.SCANNER_AGENTS + [re.escape(a) for a in opts.scanner_agents])
    large = size > opts.large_bytes
    from_web = referer.startswith("http://") | referer.startswith("https://")

    signals = {
        "uncommon_methods": uncommon,
        "uncommon_with_error": uncommon & (status >= 400),
        "suspicious_endpoints": sensitive,
        "sqli": search(path, fv.SQLI),
        "xss": search(path, fv.XSS),
        "cmdi": search(path, fv.CMDI),
        "path_traversal": search(path, fv.TRAVERSAL),
        "file_access": search(path, fv.FILE_ACCESS),
        "empty_user_agent": (F.trim(agent) == "") | (agent == "-"),
        "malicious_user_agent": search(agent, f"({scanners})"),
        "large_responses": large,
        "possible_exfiltration": large & sensitive,
        "bruteforce_events": search(path, rf"/({logins})(?:\b|/)") & status.isin(*opts.failure_statuses),
        "suspicious_params_chars": search(path, fv.QUOTE_LIKE),
        "suspicious_params_base64": search(path, fv.BASE64_LIKE),
        "sensitive_no_referer": sensitive & ((F.trim(referer) == "") | (referer == "-")),
        "sensitive_external_referer": sensitive & from_web & ~search(referer, fv.LOCAL_REFERER),
    }
    return {name: F.coalesce(signals[name], F.lit(False)) for name in fv.SIGNAL_NAMES}


def with_signals(df: DataFrame, opts: WebOptions = WebOptions()) -> DataFrame:
    df = with_request_parts(df)
    return df.select("*", *[c.alias(n) for n, c in signal_columns(df, opts).items()])


def bruteforce_offenders(df: DataFrame, opts: WebOptions = WebOptions()) -> DataFrame:
    """ip, failures: addresses with at least the threshold of failed logins, over the whole input."""
    df = with_request_parts(df)
    hit = signal_columns(df, opts)["bruteforce_events"]
    return (
        df.filter(hit).groupBy(schema.text_or(df, "ip").alias("ip"))
        .agg(F.count(F.lit(1)).alias("failures")).filter(F.col("failures") >= opts.bruteforce_threshold)
    )


def minute_of(df: DataFrame, ts: str) -> Column:
    """The minute of a time column, which may be text; null when it has no time."""
    time = F.col(ts)
    if dict(df.dtypes)[ts] == "string":
        time = F.try_to_timestamp(time).cast("timestamp_ntz")
    return F.date_trunc("minute", time)


def requests_per_minute(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """ip, minute, n: one count per address and minute; rows without a time are dropped."""
    return (
        df.select(schema.text_or(df, "ip").alias("ip"), minute_of(df, ts).alias("minute"))
        .filter(F.col("minute").isNotNull()).groupBy("ip", "minute").agg(F.count(F.lit(1)).alias("n"))
    )


def high_frequency_ips(df: DataFrame, opts: WebOptions = WebOptions(), ts: str = "timestamp") -> DataFrame:
    """ip, max_per_minute for addresses whose busiest minute reaches the threshold."""
    return (
        requests_per_minute(df, ts).groupBy("ip").agg(F.max("n").alias("max_per_minute"))
        .filter(F.col("max_per_minute") >= opts.requests_per_minute)
    )


def signal_counters(df: DataFrame, opts: WebOptions = WebOptions(), ts: str = "timestamp") -> DataFrame:
    """counter, n for all 19 counters. A frame without HTTP columns gives one ``note`` row."""
    if not is_access_like(df):
        return df.sparkSession.createDataFrame([(NOTE, None)], "counter string, n long")
    df = with_request_parts(df)
    signals = signal_columns(df, opts)
    minute = minute_of(df, ts) if ts in df.columns else F.lit(None).cast("timestamp")
    # One scan: counts per address and minute, rolled up to addresses and then to one row.
    by_minute = (
        df.select(schema.text_or(df, "ip").alias("_ip"), minute.alias("_minute"), *[c.alias(n) for n, c in signals.items()])
        .groupBy("_ip", "_minute").agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(n).alias(n) for n in signals])
    )
    by_ip = by_minute.groupBy("_ip").agg(
        F.max(F.when(F.col("_minute").isNotNull(), F.col("_n"))).alias("_most"), *[F.sum(n).alias(n) for n in signals])
    failures = F.col("bruteforce_events")
    one = by_ip.agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in signals],
        F.count_if((failures > 0) & (failures >= opts.bruteforce_threshold)).alias("bruteforce_offenders"),
        F.count_if(F.col("_most") >= opts.requests_per_minute).alias("high_freq_offenders"))
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("counter"), F.col(n).alias("n"))
        for n in (*fv.SIGNAL_NAMES, "bruteforce_offenders", "high_freq_offenders")
    ])))


def top_values(df: DataFrame, condition: Column, column: str, n: int = 5) -> DataFrame:
    """Most frequent values among matching rows; ties by value."""
    return (
        df.filter(condition & F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column).limit(n)
    )


def top_suspicious_paths(df: DataFrame, opts: WebOptions = WebOptions(), n: int = 5) -> DataFrame:
    df = with_request_parts(df)
    return top_values(df, signal_columns(df, opts)["suspicious_endpoints"], "path", n)


def top_malicious_agents(df: DataFrame, opts: WebOptions = WebOptions(), n: int = 5) -> DataFrame:
    return top_values(df, signal_columns(df, opts)["malicious_user_agent"], "user_agent", n)


def top_large_paths(df: DataFrame, opts: WebOptions = WebOptions(), n: int = 5, order: str = "line_id",
                    keep: str = "min") -> DataFrame:
    """path, bytes for the ``n`` largest responses.

    A path among them twice keeps its smaller size (``keep="min"``, the historical result) or its larger one.
    """
    df = with_request_parts(df)
    rows = df.select(F.col("path"), number_column(df, "bytes", 0.0).cast("long").alias("bytes"), order)
    top = rows.filter(F.col("bytes") > opts.large_bytes).orderBy(F.desc("bytes"), order).limit(n)
    pick = F.min if keep == "min" else F.max
    return top.groupBy("path").agg(pick("bytes").alias("bytes"))
