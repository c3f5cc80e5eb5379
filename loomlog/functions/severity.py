"""Ordered row rules as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog.functions.ip import has_external_ip
from loomlog.functions.text import contains_any, extract_or_null, to_number


def classify_entry(log: Column) -> Column:
    """``normal`` or ``anomaly``. Routine rules come first, so ``cron ... error`` stays normal.

    Word tests stand before the address test in every condition: it is the dearest and rarely needed.
    """
    low = F.lower(log)
    external = has_external_ip(log)
    routine = contains_any(low, fv.ROUTINE_WORDS) | (low.contains("http") & low.contains(" 200 ") & ~external)
    anomaly = (
        contains_any(low, fv.FAILED_LOGIN_WORDS)
        | (contains_any(low, fv.LOGIN_OK_WORDS) & contains_any(low, fv.PRIVILEGED_ACCOUNTS))
        | (contains_any(low, fv.SENSITIVE_SERVICES) & external)
        | contains_any(low, fv.SYSTEM_ERROR_WORDS)
    )
    return F.when(routine, "normal").when(anomaly, "anomaly").otherwise("normal")


def rule_reason(message: Column) -> Column:
    """Reason text for a flagged row; the first condition that holds decides."""
    m = F.lower(F.coalesce(message, F.lit("")))
    text = fv.REASON_TEXTS
    return (
        F.when(m.contains("failed password") & m.contains("user"), text["bruteforce"])
        .when(m.contains("connection refused") & contains_any(m, ["mysql", "database"]), text["database"])
        .when(m.contains("password check failed") & m.contains("root"), text["root"])
        .when(contains_any(m, ["critical", "fatal"]), text["critical"])
        .when(contains_any(m, ["out of memory", "oom"]), text["memory"])
        .when(m.contains("connection refused"), text["refused"])
        .when(contains_any(m, ["unauthorized", "forbidden"]), text["forbidden"])
        .otherwise(text["other"])
    )


def infer_level(content: Column) -> Column:
    low = F.lower(content)
    return (
        F.when(contains_any(low, fv.LEVEL_ERROR_WORDS), "ERROR")
        .when(contains_any(low, fv.LEVEL_WARN_WORDS), "WARN")
        .otherwise("INFO")
    )


def keyword_severity(line: Column) -> Column:
    """Highest weight among the whole words present, else 0: one search per weight, not per word."""
    out = F
    for weight in sorted(set(fv.KEYWORD_WEIGHTS.values()), reverse=True):
        words = "|".join(w for w, v in fv.KEYWORD_WEIGHTS.items() if v == weight)
        out = out.when(line.rlike(rf"(?i)\b(?:{words})\b"), weight)
    return out.otherwise(0)


def line_severity(line: Column) -> Column:
    return F.coalesce(extract_or_null(line, r"\b(INFO|WARN|ERROR)\b"), F.lit("INFO"))


def event_type(line: Column, template: Column) -> Column:
    """Text of the first ``[...]``, else the template's first token."""
    bracket = F.when(line.rlike(r"\[(.*?)\]"), F.regexp_extract(line, r"\[(.*?)\]", 1))
    token = F.coalesce(extract_or_null(template, r"^\s*(\S+)", 1), F.lit("Unknown"))
    return F.coalesce(bracket, token)


def is_passed_healthcheck(line: Column) -> Column:
    return line.contains("[HealthCheck]") & line.contains("PASSED")


def passed_healthcheck_usage(line: Column) -> tuple[Column, Column]:
    """CPU and memory percent of PASSED health-check lines, each found on its own; 0 elsewhere."""
    ok = is_passed_healthcheck(line)
    return tuple(
        F.when(ok, F.coalesce(to_number(F.regexp_extract(line, p, 1)), F.lit(0.0))).otherwise(0.0)
        for p in (r"CPU:\s*(\d+)%", r"Memory:\s*(\d+)%")
    )


def any_healthcheck_usage(message: Column) -> tuple[Column, Column]:
    """CPU and memory percent wherever ``CPU: n%, Memory: n%`` appears; 0 elsewhere."""
    pattern = r"CPU:\s*(\d+)%,\s*Memory:\s*(\d+)%"
    return tuple(
        F.coalesce(to_number(F.regexp_extract(message, pattern, g)), F.lit(0.0)) for g in (1, 2)
    )


def is_severe_by_rule(severity: Column, keyword: Column) -> Column:
    return (keyword >= 2) | severity.isin("WARN", "ERROR")


def rule_truth(line: Column) -> Column:
    """Rule-made ground truth: severe, and not a PASSED health check."""
    return ~is_passed_healthcheck(line) & is_severe_by_rule(line_severity(line), keyword_severity(line))


def override_prediction(flagged: Column, line: Column) -> Column:
    """Model flag or rule, with PASSED health checks cleared last."""
    severe = is_severe_by_rule(line_severity(line), keyword_severity(line))
    return F.when(is_passed_healthcheck(line), False).otherwise(flagged | severe)


def is_benign_info(severity: Column, event: Column, frequency: Column) -> Column:
    return (severity == "INFO") & event.isin(*fv.BENIGN_EVENT_TYPES) & (frequency > 1)


def level_is_anomaly(level: Column, levels: list[str] | None = None) -> Column:
    return F.coalesce(level.isin(*(levels or fv.ANOMALY_LEVELS)), F.lit(False)).cast("int")


def flow_label_is_anomaly(label: Column) -> Column:
    """0 for normal / benign / background, 1 for everything else (a null label included)."""
    return F.coalesce((~F.lower(F.trim(label)).isin(*fv.NORMAL_FLOW_LABELS)).cast("int"), F.lit(1))
