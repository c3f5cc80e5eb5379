"""Rule categories: tag rows, count, distribute, rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog import schema
from loomlog.functions.text import percent
from loomlog.rules import BASELINE_RULES, TUPLE_RULES, RuleSet, any_of


def categories_of(message: Column, rules: RuleSet = BASELINE_RULES) -> Column:
    """Array of the categories a message falls in, in declared order."""
    tags = [F.when(rules.matches(n, message), F.lit(n)) for n in rules.names]
    return F.filter(F.array(*tags), lambda c: c.isNotNull())


def with_categories(df: DataFrame, message: str | None = None, rules: RuleSet = BASELINE_RULES) -> DataFrame:
    return df.withColumn("categories", categories_of(F.col(message or schema.message_column(df)), rules))


def with_error_flags(df: DataFrame, message: str | None = None, rules: RuleSet = BASELINE_RULES) -> DataFrame:
    """One boolean ``error_<category>`` per category, and ``has_error``."""
    text = F.col(message or schema.message_column(df))
    flagged = df.select("*", *[rules.matches(n, text).alias(f"error_{n}") for n in rules.names])
    any_flag = F.lit(False)
    for n in rules.names:
        any_flag = any_flag | F.col(f"error_{n}")
    return flagged.withColumn("has_error", any_flag)


def category_counts(df: DataFrame, message: str | None = None, rules: RuleSet = BASELINE_RULES) -> DataFrame:
    """category, ord, is_baseline, n, pct - a row for every category, zeros included.

    One global conditional aggregate: each task sends one row, whatever the data's shape.
    """
    text = F.col(message or schema.message_column(df))
    totals = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(rules.matches(n, text)).alias(f"_c{i}") for i, n in enumerate(rules.names)],
    )
    rows = F.array(*[
        F.struct(F.lit(n).alias("category"), F.lit(i).alias("ord"),
                 F.lit(n in rules.baseline).alias("is_baseline"), F.col(f"_c{i}").alias("n"))
        for i, n in enumerate(rules.names)
    ])
    return totals.select("_total", F.inline(rows)).select(
        "category", "ord", "is_baseline", "n", percent(F.col("n"), F.col("_total")).alias("pct"))


def top_categories(counts: DataFrame) -> DataFrame:
    """Categories by count, ties in declared order."""
    return counts.orderBy(F.desc("n"), "ord")


def generic_errors(counts: DataFrame) -> DataFrame:
    """Sum over the baseline categories only."""
    return counts.agg(F.coalesce(F.sum(F.when(F.col("is_baseline"), F.col("n"))), F.lit(0)).alias("generic_errors"))


def level_counts(df: DataFrame, level: str | None = None) -> DataFrame:
    """ERROR / FATAL / CRITICAL / TOTAL rows by the level column; no rows when there is none."""
    name = level or schema.level_column(df)
    if name is None:
        return df.sparkSession.createDataFrame([], "level string, n long")
    value = F.upper(F.trim(F.col(name)))
    one = df.agg(*[F.count_if(value == s).alias(s) for s in fv.SEVERE_LEVELS])
    total = sum((F.col(s) for s in fv.SEVERE_LEVELS[1:]), F.col(fv.SEVERE_LEVELS[0]))
    pairs = [F.struct(F.lit(s).alias("level"), F.col(s).alias("n")) for s in fv.SEVERE_LEVELS]
    return one.select(F.inline(F.array(*pairs, F.struct(F.lit("TOTAL").alias("level"), total.alias("n")))))


def is_linux_auth_error(message: Column) -> Column:
    return F.coalesce(message.rlike(any_of(fv.LINUX_AUTH_PATTERNS)), F.lit(False))


def flagged_for_insight(message: Column, rules: RuleSet = BASELINE_RULES) -> Column:
    """Row is in authentication_errors, or in linux_auth_errors when that category is configured."""
    out = F.lit(False)
    for name in ("authentication_errors", "linux_auth_errors"):
        if name in rules.names:
            out = out | rules.matches(name, message)
    return out


def in_any(categories: Column, wanted: list[str]) -> Column:
    """Set union of category row sets, per row and without a shuffle."""
    return F.arrays_overlap(categories, F.array(*[F.lit(w) for w in wanted]))


def detections(df: DataFrame, message: str = "message", ts: str = "timestamp", ip: str = "ip",
               rules: RuleSet = TUPLE_RULES) -> DataFrame:
    """timestamp, ip, category, message: one row per category a message falls in."""
    tags = categories_of(F.col(message), rules)
    return df.select(
        F.col(ts).alias("timestamp"), F.col(ip).alias("ip"), F.explode(tags).alias("category"),
        F.col(message).alias("message"))


def volume_alerts(df: DataFrame, message: str = "message", ip: str = "ip", by_day: str | None = None,
                  high: int = fv.ALERT_HIGH_VOLUME, low: int = fv.ALERT_LOW_AND_SLOW) -> DataFrame:
    """Alerts for addresses with many failed logins over the whole input, or per day of ``by_day``."""
    keys = [F.col(ip).alias("ip")] + ([F.to_date(by_day).alias("day")] if by_day else [])
    counts = df.filter(TUPLE_RULES.matches("brute_force", F.col(message))).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    text = F.col("n").cast("string")
    return counts.filter(F.col("n") >= low).select(
        F.lit(None).cast("string").alias("timestamp"), "ip", *(["day"] if by_day else []),
        F.when(F.col("n") >= high, "brute_force_high_volume").otherwise("low_and_slow_attack").alias("category"),
        F.when(F.col("n") >= high, F.concat(text, F.lit(" failed login attempts")))
        .otherwise(F.concat(text, F.lit(" failed login attempts over long period"))).alias("message"))


def detect_all(df: DataFrame, **columns) -> DataFrame:
    """Row detections and aggregate alerts in one table; alerts carry no timestamp."""
    rows = detections(df, **columns)
    alert_columns = {k: v for k, v in columns.items() if k in ("message", "ip")}
    return rows.withColumn("timestamp", F.col("timestamp").cast("string")).unionByName(volume_alerts(df, **alert_columns))


