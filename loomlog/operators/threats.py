"""Address scoring, threat categories and recommendations.

Everything here works on per-address counts: rows are reduced by (label, address)
first, so a dominant address or label is one counter, not one task's row set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog import schema
from loomlog.functions.ip import is_valid_ip
from loomlog.operators.lookups import lookup, with_geo, with_reputation
from loomlog.operators.websignals import number_column
from loomlog.rules import DOMAIN_RULES, RuleSet

HIGH, LOW = "Brute Force (High)", "Low & Slow"


def bucket_limits(threshold: int, fallback: bool = False) -> tuple[int, int]:
    """(high, low) failure counts for the two brute-force buckets."""
    return threshold, (max(1, threshold // 10) if fallback else (threshold // 2 or 5))


def bruteforce_buckets(df: DataFrame, hit: Column, threshold: int = 10, ip: str = "ip") -> DataFrame:
    """ip, n, bucket (high / low) for addresses with enough matching rows."""
    high, low = bucket_limits(threshold)
    counts = df.filter(hit).groupBy(F.col(ip).alias("ip")).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= low).withColumn("bucket", F.when(F.col("n") >= high, "high").otherwise("low"))


def rows_of(df: DataFrame, offenders: DataFrame, ip: str = "ip") -> DataFrame:
    """Rows whose address is in the offender set."""
    return lookup(df, offenders.select(F.col("ip").alias(ip)), [ip], "left_semi")


def _label_hits(df: DataFrame, rules: RuleSet, message: Column, ip: Column | None, agent: Column | None,
                fallback: bool) -> Column:
    """Array of label keys a row contributes to: ``p|`` primary, ``f|`` fallback, ``i|`` by address column."""
    keys: list[Column] = []
    for label, names in fv.THREAT_LABELS.items():
        hit = F.lit(False)
        for name in names:
            if name in rules.names:
                hit = hit | rules.matches(name, message)
        keys.append(F.when(hit, F.lit(f"p|{label}")))
    if ip is not None and "malicious_ip" in rules.names:
        keys.append(F.when(rules.matches("malicious_ip", ip), F.lit("i|Known Malicious IP")))
    if fallback:
        for label, pattern in fv.FALLBACK_PATTERNS.items():
            text = {"Known Malicious IP": ip, "Suspicious UA": agent}.get(label, message)
            if text is not None:
                name = HIGH if label == "brute_force" else label
                keys.append(F.when(text.rlike(pattern), F.lit(f"f|{name}")))
        if "status" in df.columns:
            keys.append(F.when(number_column(df, "status", -1).between(400, 599), F.lit("f|Error Spikes")))
    return F.filter(F.array(*keys), lambda k: k.isNotNull())


def threat_counts(df: DataFrame, rules: RuleSet = DOMAIN_RULES, threshold: int = 10, message: str | None = None,
                  fallback: bool = True) -> DataFrame:
    """origin, label, ip, n: rows per threat label and address, brute force split by volume.

    ``origin`` is ``primary``, ``by_ip`` (the address column itself matched) or ``fallback``.
    """
    ip_name = schema.ip_column(df)
    address = F.col(ip_name).cast("string") if ip_name else F.lit(None).cast("string")
    counts = (
        df.select(address.alias("ip"), F.explode(label_hits(df, rules, message, fallback)).alias("key"))
        .groupBy("key", "ip").agg(F.count(F.lit(1)).alias("n"))
    )
    return labelled_counts(counts, threshold, ip_name is not None)


def label_hits(df: DataFrame, rules: RuleSet = DOMAIN_RULES, message: str | None = None, fallback: bool = True) -> Column:
    """Array of the label keys each row of ``df`` contributes to."""
    ip_name, ua_name = schema.ip_column(df), schema.agent_column(df)
    ip = F.col(ip_name).cast("string") if ip_name else None
    return _label_hits(df, rules, F.col(message or schema.message_column(df)), ip, F.col(ua_name) if ua_name else None, fallback)


def labelled_counts(counts: DataFrame, threshold: int, by_address: bool = True) -> DataFrame:
    """origin, label, ip, n from counts by label key and address; brute force is split by volume if addresses are known."""
    origin = F.substring("key", 1, 1)
    split = counts.select(
        F.when(origin == "p", "primary").when(origin == "i", "by_ip").otherwise("fallback").alias("origin"),
        F.expr("substring(key, 3)").alias("label"), "ip", "n",
    )
    if not by_address:
        return split
    high, low_p = bucket_limits(threshold)
    low_f = bucket_limits(threshold, fallback=True)[1]
    low = F.when(F.col("origin") == "fallback", low_f).otherwise(low_p)
    brute = F.col("label") == HIGH
    return (
        split.filter(~brute | (F.col("n") >= low))
        .withColumn("label", F.when(brute & (F.col("n") < high), LOW).otherwise(F.col("label")))
    )


def summarize(counts: DataFrame) -> DataFrame:
    """origin, label, matches, unique_ips, top_ips (array of ip, n) per label."""
    totals = counts.groupBy("origin", "label").agg(
        F.sum("n").alias("matches"), F.count("ip").alias("unique_ips"))
    rank = Window.partitionBy("origin", "label").orderBy(F.desc("n"), "ip")
    top = (
        counts.filter(F.col("ip").isNotNull()).withColumn("_r", F.row_number().over(rank)).filter(F.col("_r") <= 3)
        .groupBy("origin", "label").agg(F.array_sort(F.collect_list(F.struct(F.col("_r").alias("r"), "ip", "n"))).alias("top_ips"))
    )
    return totals.join(top, ["origin", "label"], "left")


def threat_summary(df: DataFrame, labels: list[str] | None = None, rules: RuleSet = DOMAIN_RULES, threshold: int = 10,
                   message: str | None = None, fallback: bool = True) -> DataFrame:
    """label, matches, unique_ips, top_ips text for each wanted label, zeros included.

    An address-column hit on the known-bad list replaces the text-based rows of that label. The
    fallback patterns count only when every primary label is empty.
    """
    return summary_of(threat_counts(df, rules, threshold, message, fallback), labels)


def summary_of(counts: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """The summary of :func:`threat_summary` from the counts of :func:`threat_counts`."""
    wanted = labels or list(fv.THREAT_LABELS)
    found = summarize(counts)
    # From here on there are at most three rows per label.
    everything = Window.partitionBy()
    tagged = found.withColumn("_any_primary", F.max((F.col("origin") != "fallback").cast("int")).over(everything)).withColumn(
        "_by_ip", F.max(((F.col("origin") == "by_ip") & (F.col("label") == "Known Malicious IP")).cast("int")).over(everything))
    replaced = (F.col("origin") == "primary") & (F.col("label") == "Known Malicious IP") & (F.col("_by_ip") == 1)
    unused = (F.col("origin") == "fallback") & (F.col("_any_primary") == 1)
    kept = tagged.filter(~replaced & ~unused).select("label", "matches", "unique_ips", "top_ips")
    frame = counts.sparkSession.createDataFrame([(n, i) for i, n in enumerate(wanted)], "label string, ord int")
    text = F.concat_ws(", ", F.transform("top_ips", lambda t: F.concat(t["ip"], F.lit(" ("), t["n"].cast("string"), F.lit(" events)"))))
    return frame.join(kept, "label", "left").select(
        "ord", "label", F.coalesce("matches", F.lit(0)).alias("matches"), F.coalesce("unique_ips", F.lit(0)).alias("unique_ips"),
        F.coalesce(text, F.lit("")).alias("top_ips"), F.col("top_ips").alias("_top"),
    )


REASONS = [
    (HIGH, "Brute-force attacker"), (LOW, "Low-and-slow brute force"),
    ("Known Malicious IP", "Known malicious scanner"), ("Web Attack Probes", "Web probing"),
]


def ranked_threat_ips(summary: DataFrame, limit: int | None = None) -> DataFrame:
    """rank, ip, reason, n: the top addresses of each reason, in reason order. At most twelve rows."""
    order = F.lit(None).cast("int")
    reason = F.lit(None).cast("string")
    for i, (label, text) in enumerate(REASONS):
        order = F.when(F.col("label") == label, i).otherwise(order)
        reason = F.when(F.col("label") == label, text).otherwise(reason)
    rows = summary.filter(order.isNotNull()).select(
        order.alias("o"), reason.alias("reason"), F.explode("_top").alias("t")
    ).select("o", "reason", "t.r", "t.ip", "t.n")
    ranked = rows.select(
        F.row_number().over(Window.partitionBy().orderBy("o", "r")).alias("rank"), "ip", "reason", "n")
    return ranked.filter(F.col("rank") <= limit) if limit else ranked


def ip_actions(ranked: DataFrame, limit: int = 3) -> DataFrame:
    """One action per address, by its first reason; at most ``limit``."""
    first = Window.partitionBy("ip").orderBy("rank")
    text = F.lit(None).cast("string")
    for reason, action in fv.ACTION_TEXTS.items():
        before, after = action.split("{ip}")
        text = F.when(F.col("reason") == reason, F.concat(F.lit(before), F.col("ip"), F.lit(after))).otherwise(text)
    once = ranked.withColumn("_f", F.row_number().over(first)).filter(F.col("_f") == 1)
    return once.orderBy("rank").limit(limit).select("rank", "ip", text.alias("action"))


def enrich(ip_counts: DataFrame, scores: DataFrame, ranges: DataFrame | None = None, top_n: int = 5) -> DataFrame:
    """The ``top_n`` addresses by events with scores, place and risk = events x abuse; riskiest first."""
    head = ip_counts.orderBy(F.desc("n"), "ip").limit(top_n).filter(is_valid_ip(F.col("ip")))
    out = with_reputation(head, scores)
    if ranges is not None:
        out = with_geo(out, ranges)
    risk = F.when(F.col("abuse_score").isNotNull(), (F.col("n") * F.col("abuse_score")).cast("long"))
    return (
        out.withColumn("risk", risk).withColumnRenamed("n", "events")
        .orderBy(F.desc(F.coalesce(F.col("risk"), F.lit(0))), F.desc("events"), "ip")
    )


def threat_scores(ip_counts: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """ip, n, score 0-1000: 700 by share of the busiest address, up to 300 by abuse score.

    ``ip_counts`` is a short top-k list; invalid addresses count for the maximum but are not scored.
    """
    top = F.max("n").over(Window.partitionBy())
    base = ip_counts.withColumn("_base", F.lit(700.0) * F.col("n") / top)
    if scores is not None:
        base = base.join(scores.select("ip", "abuse_score"), "ip", "left")
    else:
        base = base.withColumn("abuse_score", F.lit(None).cast("int"))
    value = F.col("_base") + F.coalesce(F.col("abuse_score"), F.lit(0)) * 3.0
    return base.filter(is_valid_ip(F.col("ip"))).select(
        "ip", "n", "abuse_score", F.bround(F.least(F.lit(1000.0), value)).cast("int").alias("score"))


def ranked_ips(scored: DataFrame, limit: int = 10) -> DataFrame:
    """Dashboard order: score, events, address."""
    order = Window.partitionBy().orderBy(F.desc("score"), F.desc("n"), "ip")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)


def _one_row(counters: DataFrame, error_counts: DataFrame) -> DataFrame:
    """Counters and category counts (both short) pivoted into one map."""
    both = counters.select(F.col("counter").alias("k"), "n").unionByName(
        error_counts.select(F.concat(F.lit("cat:"), "category").alias("k"), "n"))
    return both.agg(F.map_from_entries(F.collect_list(F.struct("k", F.coalesce("n", F.lit(0)).alias("n")))).alias("m"))


def _value(name: str) -> Column:
    return F.coalesce(F.try_element_at("m", F.lit(name)), F.lit(0))


def top_threat_type(counters: DataFrame, error_counts: DataFrame) -> DataFrame:
    """The one headline threat, and the short label rows carry for it."""
    login, auth, linux = _value("bruteforce_events"), _value("cat:authentication_errors"), _value("cat:linux_auth_errors")
    brute = F.when(login > 0, login).when(auth > 0, auth).otherwise(linux)
    walk = _value("path_traversal") + _value("file_access")
    sqli, xss, fast = _value("sqli"), _value("xss"), _value("high_freq_offenders")
    kind = (
        F.when((brute > 0) & (brute >= F.greatest(walk, sqli, xss, fast)), "Brute-Force Attack")
        .when((sqli > 0) & (sqli >= F.greatest(walk, xss, fast)), "SQL Injection Probing")
        .when((xss > 0) & (xss >= F.greatest(walk, fast)), "XSS Probing")
        .when(walk > 0, "Path Traversal/File Enumeration")
        .when(fast > 0, "High-Frequency Scanning")
        .otherwise("Suspicious Activity")
    )
    return _one_row(counters, error_counts).select(kind.alias("threat_type")).withColumn("row_label", row_label(F.col("threat_type")))


def row_label(threat_type: Column) -> Column:
    return (
        F.when(threat_type.startswith("Brute-Force"), "Brute-Force")
        .when(threat_type.contains("Traversal"), "Traversal")
        .when(threat_type.contains("SQL"), "SQLi")
        .when(threat_type.contains("XSS"), "XSS")
        .otherwise("Probing")
    )


def recommendations(counters: DataFrame, error_counts: DataFrame, top_ips: DataFrame) -> DataFrame:
    """ord, recommendation: the texts whose condition holds, in fixed order."""
    text = fv.RECOMMENDATION_TEXTS
    before, after = text["block_top_ip"].split("{ip}")
    best = top_ips.agg(F.min_by("ip", F.struct(-F.col("n"), F.col("ip"))).alias("k")).select(
        F.concat(F.lit("top:"), "k").alias("k"), F.lit(1).cast("long").alias("n")).filter(F.col("k").isNotNull())
    both = (
        counters.select(F.col("counter").alias("k"), "n")
        .unionByName(error_counts.select(F.concat(F.lit("cat:"), "category").alias("k"), "n"))
        .unionByName(best)
    )
    row = both.agg(
        F.map_from_entries(F.collect_list(F.struct("k", F.coalesce("n", F.lit(0)).alias("n")))).alias("m"),
        F.max(F.when(F.col("k").startswith("top:"), F.expr("substring(k, 5)"))).alias("top_ip"),
    )
    has_top = F.col("top_ip").isNotNull()
    linux_configured = F.exists(F.map_keys("m"), lambda k: k.startswith("cat:linux_auth"))
    rules = [
        (has_top, F.concat(F.lit(before), F.col("top_ip"), F.lit(after))),
        (has_top, F.lit(text["fail2ban"])),
        (_value("bruteforce_offenders") > 0, F.lit(text["bruteforce"])),
        ((_value("path_traversal") > 0) | (_value("file_access") > 0), F.lit(text["traversal"])),
        (_value("malicious_user_agent") > 0, F.lit(text["scanner"])),
        (_value("high_freq_offenders") > 0, F.lit(text["high_freq"])),
        ((_value("cat:authentication_errors") > 0) | linux_configured, F.lit(text["auth"])),
    ]
    picked = F.filter(F.array(*[
        F.when(cond, F.struct(F.lit(i).alias("ord"), t.alias("recommendation"))) for i, (cond, t) in enumerate(rules)
    ]), lambda r: r.isNotNull())
    fallback = F.array(F.struct(F.lit(len(rules)).alias("ord"), F.lit(text["none"]).alias("recommendation")))
    return row.select(F.inline(F.when(F.size(picked) > 0, picked).otherwise(fallback)))


def dominant_ip(top_ips: DataFrame, share: float = 80.0) -> DataFrame:
    """ip, share_pct, total when the busiest of the top addresses dominates or stands alone; else no row."""
    one = top_ips.agg(
        F.min_by("ip", F.struct(-F.col("n"), F.col("ip"))).alias("ip"), F.max("n").alias("n"),
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("ips"))
    pct = F.col("n") * 100.0 / F.col("total")
    return one.filter((F.col("total") > 0) & ((pct >= share) | (F.col("ips") == 1))).select("ip", pct.alias("share_pct"), "total")


def _of_top(df: DataFrame, top_ips: DataFrame, ip: str, limit: int) -> DataFrame:
    """Rows of the top addresses only. The list is cut to ``limit`` rows, so broadcasting it is bounded."""
    head = top_ips.orderBy(F.desc("n"), "ip").limit(limit).select(F.col("ip").alias(ip))
    return df.join(F.broadcast(head), ip, "left_semi")


def agent_per_ip(df: DataFrame, top_ips: DataFrame, ip: str = "ip", agent: str = "user_agent", limit: int = 10) -> DataFrame:
    """Most common user agent of each top address, cut to 32 characters; ties by text."""
    counts = (
        _of_top(df, top_ips, ip, limit).filter(F.col(agent).isNotNull())
        .groupBy(ip, agent).agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy(ip).agg(F.min_by(agent, F.struct(-F.col("n"), F.col(agent))).alias("ua"))
    return best.select(ip, F.substring("ua", 1, 32).alias("user_agent"))


def first_messages(df: DataFrame, top_ips: DataFrame, n: int, ip: str = "ip", message: str = "message",
                   order: str = "line_id", limit: int = 10) -> DataFrame:
    """ip, pos, message: the first ``n`` messages of each top address.

    ``row_number() <= n`` becomes a per-task limit before the shuffle, so a dominant address sends n rows per task.
    """
    w = Window.partitionBy(ip).orderBy(order)
    rows = _of_top(df.select(ip, order, message), top_ips, ip, limit)
    return rows.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= n).select(ip, "pos", message)


def payload_notes(df: DataFrame, top_ips: DataFrame, ip: str = "ip", message: str = "message", order: str = "line_id",
                  limit: int = 10) -> DataFrame:
    """A short note per top address from its first ten messages; empty when nothing stands out."""
    return notes_of(first_messages(df, top_ips, 10, ip, message, order, limit), ip, message)


def notes_of(first: DataFrame, ip: str, message: str) -> DataFrame:
    """ip, note from the first messages of each address (pos, message)."""
    joined = first.groupBy(ip).agg(F.array_sort(F.collect_list(F.struct("pos", F.col(message).alias("m")))).alias("ms"))
    text = F.concat_ws(" ", F.col("ms.m"))
    note = F.lit("")
    for pattern, label in reversed(fv.PAYLOAD_NOTES):
        note = F.when(text.rlike(pattern), label).otherwise(note)
    return joined.select(ip, note.alias("note"))


def evidence(df: DataFrame, top_ips: DataFrame, n: int = 2, message: str = "message", order: str = "line_id",
             limit: int = 10) -> DataFrame:
    """First messages that name each top address: by the ip column, else by ``rhost=`` / ``from`` in the text."""
    if "ip" in df.columns:
        return first_messages(df, top_ips, n, "ip", message, order, limit)
    found = F.array_distinct(F.concat(
        F.regexp_extract_all(F.col(message), F.lit(r"(?i)rhost\s*=\s*(\d{1,3}(?:\.\d{1,3}){3})\b"), F.lit(1)),
        F.regexp_extract_all(F.col(message), F.lit(r"(?i)\bfrom\s+(\d{1,3}(?:\.\d{1,3}){3})\b"), F.lit(1)),
    ))
    named = df.select(order, message, F.explode(found).alias("ip"))
    return first_messages(named, top_ips, n, "ip", message, order, limit)
