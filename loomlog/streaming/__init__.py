"""The batch rules on streams. Every function takes and returns an unbounded DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomlog import schema
from loomlog.checkpoints import fresh_path
from loomlog.operators.categories import categories_of
from loomlog.operators.parsing import parse_lines
from loomlog.operators.websignals import signal_columns, with_request_parts, with_signals
from loomlog.options import WebOptions
from loomlog.rules import BASELINE_RULES, RuleSet


def _timed(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark on ``ts``; event time has to be a TIMESTAMP, so zone-less times are read on the session's clock."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def parse_and_tag(lines: DataFrame, format_name: str, rules: RuleSet = BASELINE_RULES, opts: WebOptions = WebOptions()) -> DataFrame:
    """Parse a stream of lines and add its categories and, for access formats, its signals. Stateless."""
    parsed = parse_lines(lines, format_name)
    text = F.col("message") if "message" in parsed.columns else F.col("raw_content")
    tagged = parsed.withColumn("categories", categories_of(text, rules))
    return with_signals(tagged, opts) if {"method", "path"} <= set(tagged.columns) or "request" in tagged.columns else tagged


def ip_rate_offenders(stream: DataFrame, threshold: int, ts: str = "ts", delay: str = "2 minutes") -> DataFrame:
    """window_start, ip, n for addresses at or over the per-minute threshold, emitted once a minute is final."""
    return (
        _timed(stream, ts, delay).groupBy(F.window(ts, "1 minute").alias("w"), schema.text_or(stream, "ip").alias("ip"))
        .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= threshold)
        .select(F.col("w.start").alias("window_start"), "ip", "n")
    )


def bruteforce_bursts(stream: DataFrame, opts: WebOptions = WebOptions(), ts: str = "ts", window: str = "5 minutes",
                      slide: str = "1 minute", delay: str = "2 minutes") -> DataFrame:
    """Failed logins per address in a sliding window, at or over the brute-force threshold."""
    stream = with_request_parts(stream)
    hits = stream.filter(signal_columns(stream, opts)["bruteforce_events"])
    return (
        _timed(hits, ts, delay).groupBy(F.window(ts, window, slide).alias("w"), schema.text_or(stream, "ip").alias("ip"))
        .agg(F.count(F.lit(1)).alias("failures")).filter(F.col("failures") >= opts.bruteforce_threshold)
        .select(F.col("w.start").alias("window_start"), "ip", "failures")
    )


def template_counts(stream: DataFrame, templates: DataFrame, key: str, ts: str = "ts", width: str = "1 minute",
                    delay: str = "2 minutes") -> DataFrame:
    """window_start, template, n against a static template table joined on ``key``."""
    return (
        _timed(stream.join(templates, key), ts, delay)
        .groupBy(F.window(ts, width).alias("w"), "template").agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "template", "n")
    )


def score(stream: DataFrame, model) -> DataFrame:
    """Score a stream with a fitted model; anything with ``predict`` that only projects works."""
    return model.predict(stream)


def run_available(stream: DataFrame, label: str, out: str | None = None) -> DataFrame:
    """Process what is there, append it to Parquet under the shared folder and return the written table.

    Results go from tasks to files; a restart with the same folder carries on where the last run stopped.
    """
    spark = stream.sparkSession
    base = out or fresh_path(spark, label)
    query: StreamingQuery = (
        stream.writeStream.format("parquet").outputMode("append").option("path", f"{base}/data")
        .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/data")
