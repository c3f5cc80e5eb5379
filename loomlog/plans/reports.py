"""Report sections as tables.

A report is the union of short ``(section, ord, key, value)`` frames, most of them cut from
one table of counts; nothing row-sized ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlog import schema
from loomlog.checkpoints import written
from loomlog.functions.severity import classify_entry, rule_reason
from loomlog.operators import aggregates as agg
from loomlog.operators import categories as cats
from loomlog.operators import evaluation, threats
from loomlog.operators import websignals as web
from loomlog.operators.features import full_text
from loomlog.options import ReportOptions
from loomlog.plans.facts import Facts, collect_facts
from loomlog.rules import BASELINE_RULES, RuleSet


def section(df: DataFrame, name: str, key: Column | str, value: Column | str, order: list) -> DataFrame:
    """Rows of one section, numbered in ``order``. ``df`` is short: sections are aggregates or top lists."""
    pos = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("long")
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return df.select(F.lit(name).alias("section"), pos.alias("ord"), as_col(key).cast("string").alias("key"),
                     as_col(value).cast("string").alias("value"))


def _wide(one: DataFrame, name: str) -> DataFrame:
    """A one-row frame as key/value rows."""
    pairs = F.array(*[
        F.struct(F.lit(i).cast("long").alias("ord"), F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
        for i, c in enumerate(one.columns, 1)
    ])
    return one.select(F.lit(name).alias("section"), F.inline(pairs))


def rules_for(opts: ReportOptions) -> RuleSet:
    return BASELINE_RULES.extended(opts.custom_categories)


def _facts(df: DataFrame, opts: ReportOptions, threat: bool) -> tuple[Facts, str, Column, Column]:
    """The counts of ``df`` (with its request parts), its message column and what is flagged for either report."""
    msg, rules = schema.message_column(df), rules_for(opts)
    linux_msg = "Content" if "Content" in df.columns else msg
    flagged = cats.flagged_for_insight(F.col(msg), rules)
    linux = flagged | cats.is_linux_auth_error(F.col(linux_msg))
    threat_rules = RuleSet.of(opts.custom_categories, ignore_case=False) if threat else None
    return collect_facts(df, opts, rules, msg, linux_msg, flagged, linux, threat_rules), msg, flagged, linux


def standard_sections(df: DataFrame, opts: ReportOptions = ReportOptions(), truth: DataFrame | None = None,
                      scores: DataFrame | None = None, ranges: DataFrame | None = None,
                      order: str = "line_id", truth_order: str | None = None) -> dict[str, DataFrame]:
    """The standard report: parsing, HTTP distributions, categories, signals, performance, insights, advice.

    One scan counts all that is counted (:mod:`loomlog.plans.facts`). Only the first message, the quantiles and the largest
    responses of an access log, and a comparison with a truth table read the rows again.
    """
    df = web.with_request_parts(df)
    facts, msg, _, _ = _facts(df, opts, False)
    rules, out = rules_for(opts), {}
    out["parsing"] = _wide(agg.sample_message(df, order, msg), "parsing")
    if "status" in df.columns:
        out["status"] = section(facts.statuses(), "status", "status", F.concat_ws("|", "n", "pct"), ["status"])
        out["status_classes"] = _wide(facts.status_classes(), "status_classes")
    for name, column, top in (("methods", "method", None), ("paths", "path", opts.top_n_paths)):
        if column in df.columns:
            out[name] = section(facts.values(column, column, top), name, column, "n", [F.desc("n"), column])
    if schema.size_column(df):
        out["response_size"] = _wide(agg.response_sizes(df), "response_size")
    counts, counters = facts.categories(), facts.counters()
    out["errors"] = section(counts.filter(F.col("n") > 0), "errors", "category", F.concat_ws("|", "n", F.round("pct", 2)), [F.desc("n"), "ord"])
    if schema.level_column(df):
        out["levels"] = section(facts.levels(), "levels", "level", "n", ["level"])
    if facts.access_like:
        out["signals"] = section(counters.filter(F.col("n") > 0), "signals", "counter", "n", ["counter"])
        if "path" in df.columns:
            out["top_suspicious_paths"] = section(
                facts.values("suspicious_path", "path", min(5, opts.top_n_paths)), "top_suspicious_paths", "path", "n", [F.desc("n"), "path"])
            if "bytes" in df.columns:
                out["top_large_paths"] = section(
                    web.top_large_paths(df, opts.web, min(5, opts.top_n_large_paths), order), "top_large_paths", "path", "bytes", [F.desc("bytes"), "path"])
        if "user_agent" in df.columns:
            out["top_malicious_agents"] = section(
                facts.values("malicious_agent", "user_agent", min(5, opts.top_n_user_agents)), "top_malicious_agents", "user_agent", "n", [F.desc("n"), "user_agent"])
        out["bruteforce_ips"] = section(facts.failed_logins(), "bruteforce_ips", "ip", "failures", [F.desc("failures"), "ip"])
        if "timestamp" in df.columns:
            out["high_freq_ips"] = section(facts.busy_ips(), "high_freq_ips", "ip", "max_per_minute", [F.desc("max_per_minute"), "ip"])
    if truth is not None:
        scored = evaluation.score_against_truth(
            df.select("LineId", _any_category(F.col(msg), rules).alias("flagged")),
            truth, order=truth_order)
        out["performance"] = _wide(scored, "performance")
    else:
        out["performance"] = _wide(facts.total("flagged", "alerts_flagged"), "performance")
    top = facts.attackers(opts.top_n_paths)
    out["insights"] = section(top, "insights", "ip", "n", [F.desc("n"), "ip"])
    out["targeted"] = section(threats.dominant_ip(top), "targeted", "ip", F.concat_ws("|", F.round("share_pct", 2), "total"), ["ip"])
    out["recommendations"] = section(
        threats.recommendations(counters, counts, top), "recommendations", "ord", "recommendation", ["ord"])
    if opts.enrich.enabled and scores is not None:
        rich = threats.enrich(top, scores, ranges, opts.enrich.top_n)
        out["threat_intel"] = section(rich, "threat_intel", "ip", F.concat_ws("|", "events", "abuse_score", "risk"), [F.desc("risk"), F.desc("events"), "ip"])
    return out


def _any_category(message: Column, rules: RuleSet) -> Column:
    out = F.lit(False)
    for name in rules.names:
        out = out | rules.matches(name, message)
    return out


def intel_sections(df: DataFrame, opts: ReportOptions = ReportOptions(), truth: DataFrame | None = None,
                   scores: DataFrame | None = None, ranges: DataFrame | None = None,
                   order: str = "line_id", truth_order: str | None = None) -> dict[str, DataFrame]:
    """The threat-intelligence report: headline, ranked addresses, threat summaries, actions, evidence.

    Three scans: one counts all that is counted, one finds the time range, one reads the first messages of the top addresses.
    """
    df = web.with_request_parts(df)
    facts, msg, _, flagged = _facts(df, opts, True)
    top = written(facts.attackers(max(10, opts.top_n_paths), linux=True), "attackers")
    enriched = threats.enrich(top, scores, ranges, opts.enrich.top_n) if opts.enrich.enabled and scores is not None else None
    ranked = written(threats.ranked_ips(threats.threat_scores(top, enriched)), "ranked")
    summary = written(facts.threats(), "threats")
    rank_ips = threats.ranked_threat_ips(summary)
    out = {
        "events": _wide(facts.total("all", "events_analyzed"), "events"),
        "time_range": _wide(agg.time_range(df), "time_range"),
        "top_threat": _wide(threats.top_threat_type(facts.counters(), facts.categories()), "top_threat"),
        "unique_threats": _wide(ranked.agg(F.count(F.lit(1)).alias("unique_threats")), "unique_threats"),
        "dashboard": section(ranked, "dashboard", "ip", F.concat_ws("|", "score", "n"), ["rank"]),
        "threat_summary": section(summary, "threat_summary", "label", F.concat_ws("|", "matches", "unique_ips", "top_ips"), ["ord"]),
        "top_threat_ips": section(rank_ips.filter(F.col("rank") <= 5), "top_threat_ips", "ip", F.concat_ws("|", "reason", "n"), ["rank"]),
        "actions": section(threats.ip_actions(rank_ips), "actions", "ip", "action", ["rank"]),
    }
    ip, ua = schema.ip_column(df), schema.agent_column(df)
    if ip and ua:
        out["dashboard_agents"] = section(facts.agents(top), "dashboard_agents", "ip", "user_agent", ["ip"])
    # the first messages of the top addresses, the first ranked one among them, serve the notes and the evidence
    best = ranked.filter(F.col("rank") == 1).select("ip", "n")
    if ip:
        first = written(threats.first_messages(df, top, 10, ip, msg, order).select(F.col(ip).alias("ip"), "pos", F.col(msg).alias("m")), "first")
        out["dashboard_notes"] = section(threats.notes_of(first, "ip", "m"), "dashboard_notes", "ip", "note", ["ip"])
        lines = first.join(F.broadcast(best.select("ip")), "ip", "left_semi").filter("pos <= 2")
    else:
        lines = threats.evidence(df, best, 2, msg, order, 1).withColumnRenamed(msg, "m")
    out["evidence"] = section(lines, "evidence", "ip", "m", ["ip", "pos"])
    if truth is not None and "LineId" in df.columns:
        out["performance"] = _wide(evaluation.score_against_truth(df.select("LineId", flagged.alias("flagged")), truth, order=truth_order), "performance")
    return out


def comparison_sections(logs: DataFrame, model_flag: Column | None = None, order: str = "line_id", max_list: int = 20, marks: int = 5) -> dict[str, DataFrame]:
    """Model against rules: summary, severity mix, the first expected anomalies with reasons, their marks on the timeline, the verdict."""
    expected = classify_entry(full_text(F.col("log_level"), F.col("module"), F.col("message"))) == "anomaly"
    summary = agg.report_summary(logs, expected, model_flag).withColumn("anomaly_rate", F.round("anomaly_rate", 6))
    first = logs.filter(expected).orderBy(order).limit(max_list)
    listed = (
        first.select(order, F.concat(F.col("log_level"), F.lit(" ["), F.col("module"), F.lit("] "), F.col("message")).alias("content"),
                rule_reason(F.col("message")).alias("reason"))
    )
    verdict = (
        F.lit("no model") if model_flag is None else
        F.when(F.col("model_flagged") < F.col("expected"), "false negatives likely")
        .when(F.col("model_flagged") > F.col("expected"), "false positives possible").otherwise("counts match")
    )
    return {
        "summary": _wide(summary, "summary"),
        "expected": section(listed, "expected", F.concat_ws("|", order, "content"), "reason", [order]),
        "severity": section(agg.severity_mix(logs, expected), "severity", "severity", F.concat_ws("|", "n", F.round("pct", 2)), ["severity"]),
        "timeline": section(first.orderBy(order).limit(marks), "timeline", order, "timestamp", [order]),
        "verdict": _wide(summary.select(verdict.alias("verdict")), "verdict"),
    }


def combined(sections: dict[str, DataFrame]) -> DataFrame:
    """All sections as one table."""
    frames = [s.select("section", F.col("ord").cast("long").alias("ord"), "key", "value") for s in sections.values()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
