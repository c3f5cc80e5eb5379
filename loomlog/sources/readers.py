"""Readers for text and CSV logs, directories, templates and network-flow tables."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlog import fixed_values as fv
from loomlog import schema
from loomlog.checkpoints import written
from loomlog.operators.lookups import lookup
from loomlog.operators.parsing import clean_lines, parse_by_source, parse_lines, structured_rows

_GLOB = "*.{" + ",".join(e.lstrip(".") for e in fv.TEXT_LOG_EXTENSIONS) + "}"


def _csv_reader(spark: SparkSession, sep: str, encoding: str | None, multi_line: bool, recursive: bool, glob: str | None):
    reader = (
        spark.read.option("header", True).option("sep", sep).option("encoding", encoding or _BYTES)
        .option("quote", '"').option("escape", '"').option("multiLine", multi_line).option("recursiveFileLookup", recursive)
    )
    return reader.option("pathGlobFilter", glob) if glob else reader


#: An encoding that every byte is one character of, so that a text can be turned back into its bytes.
_BYTES = "ISO-8859-1"


def decoded(col: Column) -> Column:
    """A text read byte by byte as UTF-8, or as Latin-1 where it is no UTF-8."""
    return F.coalesce(F.try_validate_utf8(F.encode(col, _BYTES).cast("string")), col)


def _decoded_name(name: str) -> str:
    try:
        return name.encode(_BYTES).decode()
    except UnicodeError:
        return name


def read_csv_log(spark: SparkSession, path, schema_: T.StructType | None = None, sep: str = ",",
                 encoding: str | None = None, infer: bool = True, recursive: bool = False, glob: str | None = None,
                 multi_line: bool = True) -> DataFrame:
    """CSV with a header. Pass a schema to spare the inference pass.

    Values may hold quoted line breaks; files are then read whole, one to a task. ``multi_line=False`` splits large files that
    have none. Without ``encoding`` every value is taken as UTF-8 or, where it is none, as Latin-1. Rows with more or fewer
    values than the header are dropped; :func:`malformed_csv` shows them.
    """
    reader = _csv_reader(spark, sep, encoding, multi_line, recursive, glob).option("mode", "DROPMALFORMED")
    df = (reader.schema(schema_) if schema_ is not None else reader.option("inferSchema", infer)).csv(path)
    if encoding:
        return df
    return df.select(*[(decoded(F.col(f"`{n}`")) if t == "string" else F.col(f"`{n}`")).alias(_decoded_name(n)) for n, t in df.dtypes])


def malformed_csv(spark: SparkSession, path, sep: str = ",", recursive: bool = False, glob: str | None = None, multi_line: bool = True) -> DataFrame:
    """source_file and record (as it stands in the file) of the rows that :func:`read_csv_log` drops."""
    reader = _csv_reader(spark, sep, None, multi_line, recursive, glob)
    names = [f.name for f in reader.option("inferSchema", False).csv(path).schema]
    columns = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_record"]])
    rows = reader.schema(columns).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_record").csv(path)
    # The reader gives records only together with a value, so both are written, and later queries may prune.
    kept = written(rows.select(F.col("_metadata.file_path").alias("source_file"), F.col(f"`{names[0]}`").alias("first"), "_record").filter(
        "_record is not null"), "malformed")
    return kept.select("source_file", decoded(F.col("_record")).alias("record"))


def read_text_lines(spark: SparkSession, path, recursive: bool = False, glob: str | None = None) -> DataFrame:
    """source_file, line_num, value for every physical line (blank ones too), 1-based per file.

    Lines are numbered inside each file split first; the splits' sizes, added up per file, give the offsets.
    No task ever orders more than one split's lines.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    splits = lines.groupBy("source_file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return lines.join(offsets, ["source_file", "_block"]).select(
        "source_file", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_num"), "value")


def parse_text_log(spark: SparkSession, path: str, format_name: str | None = None) -> DataFrame:
    """Parse text logs with one format, or with the one detected per file."""
    lines = read_text_lines(spark, path)
    if format_name is None:
        parsed = parse_by_source(lines, "source_file", "line_num")
        if parsed.isEmpty():
            raise ValueError("could not determine the log format: name one")
        return parsed
    return parse_lines(clean_lines(lines), format_name)


def parse_directory(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Every text log of a directory, each file by its own detected format; others are left out."""
    return parse_by_source(read_text_lines(spark, path, recursive, _GLOB), "source_file", "line_num")


def source_kind(spark: SparkSession, path: str) -> str:
    """``csv`` or ``text``: by extension, else CSV when the first line holds two or more commas."""
    ext = os.path.splitext(path)[1].lower()
    if ext == ".csv":
        return "csv"
    if ext in fv.TEXT_LOG_EXTENSIONS:
        return "text"
    first = spark.read.text(path).limit(1).collect()
    return "csv" if first and first[0]["value"].count(",") >= 2 else "text"


def read_log(spark: SparkSession, path: str, format_name: str | None = None) -> DataFrame:
    """A log table from any supported file; a missing path raises the reader's own error."""
    return read_csv_log(spark, path) if source_kind(spark, path) == "csv" else parse_text_log(spark, path, format_name)


def read_app_rows(spark: SparkSession, path: str) -> DataFrame:
    """A structured CSV of any known family as the four-column log."""
    return structured_rows(read_csv_log(spark, path, infer=False))


def structured_datasets(spark: SparkSession, roots: list[str]) -> DataFrame:
    """path of every ``*log_structured.csv`` file under the roots, in order."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*log_structured.csv").load(roots)
    return files.select("path").distinct().orderBy("path")


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_log(spark, path)


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """``Template i: text`` lines as id, template."""
    pattern = r"^Template (\d+): (.*)$"
    lines = spark.read.text(path).filter(F.col("value").rlike(pattern))
    return lines.select(F.regexp_extract("value", pattern, 1).cast("int").alias("id"), F.regexp_extract("value", pattern, 2).alias("template"))


# ---------------------------------------------------------------- network flows

def _existing(spark: SparkSession, base: str, names: list[str]) -> list[str]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}")
        if path.getFileSystem(conf).exists(path):
            found.append(path.toString())
    return found


def _required(found: list[str], what: str) -> list[str]:
    if not found:
        raise FileNotFoundError(f"no {what} files found")
    return found


def load_nsl_kdd(spark: SparkSession, base: str, all_files: bool = False, use_20_percent: bool = False) -> DataFrame:
    """The 43 fixed columns, from the full or the 20 % training file and optionally the matching test file."""
    train, test = ("KDDTrain+_20Percent.txt", "KDDTest-21.txt") if use_20_percent else ("KDDTrain+.txt", "KDDTest+.txt")
    files = _required(_existing(spark, base, [train] + ([test] if all_files else [])), "NSL-KDD")
    return spark.read.schema(schema.NSL_KDD).csv(files)


def load_unsw(spark: SparkSession, base: str, official_split: bool = True, all_files: bool = False) -> DataFrame:
    """The official training file, the four parts, or every file present with columns aligned by name."""
    official, testing = "UNSW_NB15_training-set.csv", "UNSW_NB15_testing-set.csv"
    parts = [f"UNSW-NB15_{i}.csv" for i in range(1, 5)]
    names = [official, testing, *parts] if all_files else [official] if official_split else parts
    return schema.union_aligned(*[read_csv_log(spark, f) for f in _required(_existing(spark, base, names), "UNSW-NB15")])


def read_csv_by_name(spark: SparkSession, path, sep: str = ",", glob: str = "*.csv", recursive: bool = False) -> DataFrame:
    """All CSV files of a folder as one frame, whatever columns each has and in whatever order.

    The lines of all files are one scan. A file's first line is its header; every value goes to the column that its own file's
    header names, columns that a file lacks are null. Types come from one pass over all values: a column whose every value
    reads as a number is a double. Values hold no line breaks. Lines that differ from their header in length are dropped.
    """
    lines = read_text_lines(spark, path, recursive, glob).withColumn("value", F.regexp_replace("value", "\r$", ""))
    headers = written(lines.filter("line_num = 1").select("source_file", F.col("value").alias("header")), "headers")
    widest = headers.agg(F.max(F.size(F.split("header", re.escape(sep))))).first()[0]
    if widest is None:
        raise FileNotFoundError(f"no files {glob} in {path}")
    shape = ", ".join(f"c{k} string" for k in range(widest + 1))  # one more: a longer line shows by it
    options = {"sep": sep, "quote": '"', "escape": '"'}

    def values(col: str) -> Column:
        return F.array(*[F.from_csv(F.col(col), F.lit(shape), options)[f"c{k}"] for k in range(widest + 1)])
    cut = written(headers.withColumn("names", F.filter(values("header"), lambda x: x.isNotNull())).select(
        "source_file", F.transform("names", lambda x: F.trim(x)).alias("names")), "headers")
    names = [r[0] for r in cut.select(F.explode("names")).distinct().orderBy("col").collect()]  # the schema
    rows = lookup(lines.filter((F.col("line_num") > 1) & (F.trim("value") != "")), cut, ["source_file"], "inner").withColumn("v", values("value"))
    size = F.size("names")
    fits = (F.size(F.filter(F.slice("v", size + 1, widest + 1), lambda x: x.isNotNull())) == 0) & (
        F.size(F.split("value", re.escape(sep))) >= size)
    mapped = rows.filter(fits).select("source_file", F.map_from_arrays("names", F.slice("v", F.lit(1), size)).alias("m"))
    texts = written(mapped.select("source_file", *[F.try_element_at("m", F.lit(n)).alias(n) for n in names]), "by-name")
    bad = [F.count_if(F.col(f"`{n}`").isNotNull() & F.col(f"`{n}`").try_cast("double").isNull()).alias(f"n{k}") for k, n in enumerate(names)]
    found = texts.agg(*bad).first()
    return texts.select("source_file", *[
        (F.col(f"`{n}`").cast("double") if not found[f"n{k}"] else F.col(f"`{n}`")).alias(n) for k, n in enumerate(names)])


def load_ctu_iot(spark: SparkSession, base: str) -> DataFrame:
    """All CSV files of a folder, columns aligned by name, in one scan."""
    return read_csv_by_name(spark, base).drop("source_file")
