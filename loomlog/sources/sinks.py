"""Writers. All of them write from the tasks; a directory per result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlog.operators.numbering import with_numbers


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", encoding: str = "UTF-8") -> str:
    df.write.mode(mode).option("header", True).option("escape", '"').option("encoding", encoding).csv(path)
    return path


def write_parsed_directory(parsed: DataFrame, path: str) -> str:
    """Parsed lines as CSV, one folder per source file name."""
    named = parsed.withColumn("source", F.regexp_extract("source_file", r"([^/]+)$", 1)).drop("source_file")
    named.write.mode("overwrite").partitionBy("source").option("header", True).option("escape", '"').csv(path)
    return path


def write_templates(templates: DataFrame, path: str, column: str = "template") -> str:
    """``Template i: text`` lines, numbered from 1 in order on the executors."""
    numbered = with_numbers(templates.select(column).distinct(), [column], "_n", start=1)
    lines = numbered.select(F.concat(F.lit("Template "), F.col("_n").cast("string"), F.lit(": "), F.col(column)).alias("value"))
    lines.write.mode("overwrite").text(path)
    return path


def write_window_features(features: DataFrame, path: str) -> str:
    """window_start and one column per template, as CSV."""
    return write_csv(features, path)


def write_scored(scored: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Rows with anomaly_score and is_anomaly; nested columns need Parquet."""
    return write_csv(scored, path) if fmt == "csv" else _parquet(scored, path)


def write_evaluation(detail: DataFrame, summary: DataFrame, path: str) -> str:
    """JSON detail and CSV summary of an evaluation."""
    detail.write.mode("overwrite").json(f"{path}/detail")
    write_csv(summary, f"{path}/summary")
    return path


def write_unique_templates(df: DataFrame, path: str, column: str = "EventTemplate") -> str:
    """Distinct values of a template column, one per line."""
    df.select(F.col(column).alias("value")).filter("value is not null").distinct().write.mode("overwrite").text(path)
    return path


def write_report(sections: DataFrame, path: str) -> str:
    """The (section, ord, key, value) table, one folder per section."""
    sections.write.mode("overwrite").partitionBy("section").option("header", True).option("escape", '"').csv(path)
    return path


def _parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path
