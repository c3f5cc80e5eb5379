"""Raw lines and structured rows to columns.

A line is matched once: the format's groups are rewritten into one delimited
string in a single regex pass and then split, instead of one search per field.
All formats match at the start of the line and need not reach its end.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog import schema
from loomlog.functions.severity import infer_level
from loomlog.functions.text import parse_month_day, parse_time
from loomlog.operators.lookups import lookup

_MARK = "\x1f"


@dataclass(frozen=True)
class LineFormat:
    """A line regex and its field names, in group order; ``optional`` fields are null when empty."""

    name: str
    pattern: str
    fields: tuple[str, ...]
    optional: frozenset[str] = frozenset()

    def __post_init__(self):
        groups = re.compile(self.pattern).groups
        if groups != len(self.fields):
            raise ValueError(f"format {self.name!r}: {groups} groups for {len(self.fields)} fields")

    def parts(self, value: Column) -> Column:
        """Array of group texts, null when the line does not match."""
        anchored = f"^(?:{self.pattern})"
        n = len(self.fields)
        rewrite = _MARK.join(f"${i + 1}" for i in range(n))
        one_pass = F.split(F.regexp_replace(value, anchored + r"[\s\S]*$", rewrite), _MARK, -1)
        # A line that itself holds the mark is read group by group.
        by_group = F.transform(
            F.sequence(F.lit(1), F.lit(n)), lambda i: F.call_function("regexp_extract", value, F.lit(anchored), i))
        return F.when(value.rlike(anchored), F.when(value.contains(_MARK), by_group).otherwise(one_pass))

    def field(self, parts: Column, name: str) -> Column:
        text = F.get(parts, F.lit(self.fields.index(name)))
        return F.nullif(text, F.lit("")) if name in self.optional else text


FORMATS: dict[str, LineFormat] = {
    name: LineFormat(name, pattern, tuple(fields), frozenset({"pid"} if name == "syslog" else ()))
    for name, (pattern, fields) in fv.LINE_FORMATS.items()
}


def register_format(name: str, pattern: str, fields: list[str], optional=()) -> LineFormat:
    """Add a line format; it takes part in detection after the ones already there."""
    FORMATS[name] = LineFormat(name, pattern, tuple(fields), frozenset(optional))
    return FORMATS[name]


def _known(name: str) -> LineFormat:
    if name not in FORMATS:
        raise ValueError(f"unknown log format: {name}")
    return FORMATS[name]


def event_time(fields: dict[str, Column], year: int | None = None) -> Column | None:
    """Normalised time from ``datetime`` (two layouts) or ``date`` + ``time``, on the UTC clock; with a ``year`` also from a
    ``timestamp`` of month, day and time, which names none."""
    if "datetime" in fields:
        zoned = F.try_to_timestamp(fields["datetime"], F.lit("dd/MMM/yyyy:HH:mm:ss Z")).cast("timestamp_ntz")
        utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), zoned)
        return F.coalesce(utc, parse_time(fields["datetime"], "yyyy/MM/dd HH:mm:ss"))
    if "date" in fields and "time" in fields:
        return parse_time(F.concat_ws(" ", fields["date"], fields["time"]), "yyyy-MM-dd HH:mm:ss")
    if year is not None and "timestamp" in fields:
        return parse_month_day(fields["timestamp"], year)
    return None


def clean_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Trim, then drop blank lines. Number lines before this step."""
    return lines.withColumn(value, stripped(value)).filter(F.length(value) > 0)


def stripped(value: str) -> Column:
    """Text without white space at its ends."""
    return F.regexp_replace(F.col(value), r"^\s+|\s+$", "")


def parse_lines(lines: DataFrame, format_name: str, value: str = "value", year: int | None = None) -> DataFrame:
    """Parse every line with one format. Unmatched lines stay, with ``parsed`` false and null fields.

    ``year`` is that of times which name none, as syslog's; with it such formats get a ``datetime_obj`` too.
    """
    fmt = _known(format_name)
    keep = [c for c in lines.columns if c != value and c not in fmt.fields]
    staged = lines.select(*keep, F.col(value).alias("raw_content"), fmt.parts(F.col(value)).alias("_parts"))
    fields = {name: fmt.field(F.col("_parts"), name) for name in fmt.fields}
    when = event_time(fields, year)
    return staged.select(
        *keep, *[c.alias(n) for n, c in fields.items()],
        *([when.alias("datetime_obj")] if when is not None else []),
        "raw_content", F.col("_parts").isNotNull().alias("parsed"),
    )


def detect_formats(lines: DataFrame, source: str, order: str, value: str = "value", sample: int = 10) -> DataFrame:
    """One row per source: the format most of its first lines match, and the share that did.

    Only the first ``sample`` lines of a source are kept, and the row-number limit is applied before
    the shuffle, so a source that holds most of the data costs no more than a small one.
    """
    first = Window.partitionBy(source).orderBy(order)
    head = (
        lines.select(source, order, value)
        .withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= sample)
        .withColumn("_t", stripped(value))
    )
    real = F.length("_t") > 0
    hits = head.groupBy(source).agg(
        F.count_if(real).alias("_lines"),
        *[F.count_if(real & F.col("_t").rlike(f"^(?:{f.pattern})")).alias(f"_h_{n}") for n, f in FORMATS.items()],
    )
    ranked = F.array_max(F.array(*[
        F.struct(F.col(f"_h_{n}").alias("hits"), F.lit(-i).alias("rank"), F.lit(n).alias("name"))
        for i, n in enumerate(FORMATS)
    ]))
    best = hits.withColumn("_best", ranked)
    return best.select(
        source,
        F.when(F.col("_best.hits") > 0, F.col("_best.name")).otherwise("unknown").alias("format"),
        F.coalesce(F.try_divide(F.col("_best.hits"), F.col("_lines")), F.lit(0.0)).alias("match_ratio"),
    )


def parse_by_source(lines: DataFrame, source: str, order: str, value: str = "value") -> DataFrame:
    """Parse each source with its own detected format into the union of all fields.

    Sources with no known format are dropped, as a directory run skips files it cannot parse.
    """
    chosen = detect_formats(lines, source, order, value).filter(F.col("format") != "unknown").drop("match_ratio")
    tagged = lookup(clean_lines(lines, value), chosen, [source], how="inner")
    parts = F.lit(None).cast("array<string>")
    for name, fmt in FORMATS.items():
        parts = F.when(F.col("format") == name, fmt.parts(F.col(value))).otherwise(parts)
    staged = tagged.select(source, order, "format", F.col(value).alias("raw_content"), parts.alias("_parts"))
    all_fields = list(dict.fromkeys(f for fmt in FORMATS.values() for f in fmt.fields))

    def merged(field: str) -> Column:
        options = [
            F.when(F.col("format") == n, fmt.field(F.col("_parts"), field))
            for n, fmt in FORMATS.items() if field in fmt.fields
        ]
        return F.coalesce(*options)

    return staged.select(
        source, order, "format", *[merged(f).alias(f) for f in all_fields],
        "raw_content", F.col("_parts").isNotNull().alias("parsed"),
    )


def parse_mixed(lines: DataFrame, value: str = "value") -> DataFrame:
    """Each line by the first of the four common formats it matches, with the normalised time."""
    formats = [FORMATS[n] for n in fv.MIXED_LINE_FORMATS]
    keep = [c for c in lines.columns if c != value]
    name, parts = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    for fmt in reversed(formats):
        hit = F.col(value).rlike(f"^(?:{fmt.pattern})")
        name = F.when(hit, fmt.name).otherwise(name)
    tagged = lines.select(*keep, value, name.alias("format"))
    for fmt in reversed(formats):
        parts = F.when(F.col("format") == fmt.name, fmt.parts(F.col(value))).otherwise(parts)
    staged = tagged.select(*keep, F.col(value).alias("raw_content"), "format", parts.alias("_parts"))
    fields: dict[str, Column] = {}
    for field in dict.fromkeys(f for fmt in formats for f in fmt.fields):
        fields[field] = F.coalesce(*[
            F.when(F.col("format") == fmt.name, fmt.field(F.col("_parts"), field))
            for fmt in formats if field in fmt.fields
        ])
    when = F.coalesce(
        event_time({"datetime": fields["datetime"]}),
        event_time({"date": fields["date"], "time": fields["time"]}),
    )
    return staged.select(
        *keep, "format", *[c.alias(n) for n, c in fields.items()], when.alias("datetime_obj"),
        "raw_content", F.col("format").isNotNull().alias("parsed"),
    )


def parse_app_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """``time,ms LEVEL [module] message`` lines to the four-column log; comments and bad lines dropped."""
    fmt = LineFormat("app", fv.APP_LOG_LINE, ("timestamp", "log_level", "module", "message"))
    body = clean_lines(lines, value).filter(~F.col(value).startswith("//") & ~F.col(value).startswith("#"))
    keep = [c for c in lines.columns if c != value and c not in fmt.fields]
    staged = body.select(*keep, fmt.parts(F.col(value)).alias("_parts")).filter(F.col("_parts").isNotNull())
    at = {n: fmt.field(F.col("_parts"), n) for n in fmt.fields}
    return staged.select(
        *keep, parse_time(at["timestamp"], "yyyy-MM-dd HH:mm:ss,SSS").alias("timestamp"),
        at["log_level"].alias("log_level"), at["module"].alias("module"), at["message"].alias("message"),
    )


# ---------------------------------------------------------------- structured families

def _clean(df: DataFrame, name: str, default: str) -> Column:
    """Trimmed text; a missing column is the default, a null value is the text ``nan`` of a CSV reader."""
    if name not in df.columns:
        return F.lit(default)
    return F.coalesce(F.trim(F.col(name).cast("string")), F.lit("nan"))


def linux_rows(df: DataFrame, year: int = 2025) -> DataFrame:
    """Month + Date + Time; the level is read from the content."""
    number = F.col("Date").cast("string").try_cast("double").cast("int")
    day = F.lpad(F.coalesce(number.cast("string"), F.lit("01")), 2, "0")
    month = F.coalesce(F.nullif(F.trim(F.col("Month")), F.lit("")), F.lit("Jan"))
    clock = F.coalesce(F.trim(F.col("Time").cast("string")), F.lit("00:00:00"))
    content = _clean(df, "Content", "")
    return _app_rows(
        df, parse_time(F.concat_ws(" ", month, day, F.lit(str(year)), clock), "MMM dd yyyy HH:mm:ss"),
        infer_level(content), _clean(df, "Component", "linux"), content,
    )


def bgl_rows(df: DataFrame) -> DataFrame:
    """``yyyy-MM-dd-HH.mm.ss.ffffff`` kept to the millisecond; the level upper-cased."""
    raw = F.trim(F.col("Time"))
    main = F.regexp_extract(raw, r"^(.*)\.([^.]*)$", 1)
    millis = F.rpad(F.substring(F.regexp_extract(raw, r"^(.*)\.([^.]*)$", 2), 1, 3), 3, "0")
    ts = parse_time(F.concat_ws(".", main, millis), "yyyy-MM-dd-HH.mm.ss.SSS")
    return _app_rows(df, ts, F.upper(_clean(df, "Level", "INFO")), _clean(df, "Component", "BGQ"), _clean(df, "Content", ""))


def thunderbird_rows(df: DataFrame) -> DataFrame:
    """Epoch seconds, else Date + Time, else Month/Day with the year from Date."""
    epoch = schema.text_or(df, "Timestamp", None)
    date, clock = schema.text_or(df, "Date", ""), F.trim(schema.text_or(df, "Time", ""))
    year = F.coalesce(F.nullif(F.get(F.split(date, "\\."), F.lit(0)), F.lit("")), F.lit("2005"))
    day = F.lpad(schema.text_or(df, "Day", "01").try_cast("double").cast("int").cast("string"), 2, "0")
    month = F.trim(schema.text_or(df, "Month", "Jan"))
    from_epoch = F.when(epoch.rlike("^[0-9]+$"), epoch_to_ntz(epoch.try_cast("long")))
    ts = F.coalesce(
        from_epoch,
        parse_time(F.concat_ws(" ", F.replace(F.trim(date), F.lit("."), F.lit("-")), clock), "yyyy-MM-dd HH:mm:ss"),
        parse_time(F.concat_ws(" ", month, day, year, clock), "MMM dd yyyy HH:mm:ss"),
    )
    content = _clean(df, "Content", "")
    return _app_rows(df, ts, infer_level(content), _clean(df, "Component", "thunderbird"), content)


def epoch_to_ntz(seconds: Column) -> Column:
    """Epoch seconds on the UTC clock, whatever the session's zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.timestamp_seconds(seconds).cast("timestamp_ntz"))


def apache_rows(df: DataFrame) -> DataFrame:
    """``EEE MMM d HH:mm:ss yyyy``, days of one or two digits; NOTICE becomes INFO; rows whose time does not parse are dropped."""
    single = F.trim(F.regexp_replace("Time", r"\s+", " "))
    weekday_off = F.regexp_extract(single, r"^[A-Za-z]{3} (.*)$", 1)
    level = F.upper(_clean(df, "Level", "INFO"))
    out = _app_rows(
        df, parse_time(weekday_off, "MMM d HH:mm:ss yyyy"),
        F.when(level == "NOTICE", "INFO").otherwise(level), F.lit("apache"), _clean(df, "Content", ""),
    )
    return out.filter(F.col("timestamp").isNotNull())


def hdfs_rows(df: DataFrame, date_order: str = "MMddyy") -> DataFrame:
    """Six-digit date and time, zero-padded, also where a reader made them fractional (``81109.0``). Real HDFS dates are year first: pass ``yyMMdd`` for those."""
    stamp = F.concat(
        *[F.lpad(F.col(c).try_cast("double").cast("long").cast("string"), 6, "0") for c in ("Date", "Time")]
    )
    out = _app_rows(
        df, parse_time(stamp, date_order + "HHmmss"),
        F.upper(_clean(df, "Level", "INFO")), _clean(df, "Component", "HDFS"), _clean(df, "Content", ""),
    )
    return out.filter(F.col("timestamp").isNotNull())


def _app_rows(df: DataFrame, ts: Column, level: Column, module: Column, message: Column) -> DataFrame:
    keep = [c for c in df.columns if c in ("line_id", "source_file")]
    return df.select(
        *keep, ts.alias("timestamp"), level.alias("log_level"), module.alias("module"), message.alias("message"),
    )


def structured_family(columns: list[str]) -> str | None:
    """Which schema family a column set belongs to; the most specific sets are tried first."""
    have = set(columns)
    if {"Month", "Date", "Time", "Level", "Component", "Content"} <= have:
        return "linux"
    if {"Time", "Level", "Component", "Content"} <= have and have & {
        "EventId", "EventTemplate", "Node", "Label", "Type", "Timestamp", "Date",
    }:
        return "bgl"
    if {"Month", "Day", "Time", "Component", "Content"} <= have:
        return "thunderbird"
    if {"Date", "Time", "Component", "Content"} <= have and not have & {"Month", "Day"}:
        return "hdfs"
    if {"Time", "Level", "Content"} <= have and "Component" not in have:
        return "apache"
    return None


FAMILY_READERS = {
    "linux": linux_rows, "bgl": bgl_rows, "thunderbird": thunderbird_rows, "hdfs": hdfs_rows, "apache": apache_rows,
}


def structured_rows(df: DataFrame, family: str | None = None) -> DataFrame:
    """The four-column log from any structured family; no rows for an unknown one.

    An HDFS table that carries a Level column also satisfies the BGL set, which is tried first: name its family.
    """
    family = family or structured_family(df.columns)
    if family is None:
        return df.sparkSession.createDataFrame([], schema.APP_LOG)
    return FAMILY_READERS[family](df)


# ---------------------------------------------------------------- normalised entries

def standard_from_structured(df: DataFrame) -> DataFrame:
    """StandardLog rows from a structured table; the whole row goes to ``metadata``."""
    def role(*names: str, default: str | None = None) -> Column:
        return next((F.col(n).cast("string") for n in names if n in df.columns), F.lit(default).cast("string"))
    pairs = [x for c in df.columns for x in (F.lit(c), F.col(c).cast("string"))]
    meta = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
    return df.select(
        role("Content", "message", default="").alias("message"),
        F.concat_ws(" ", *[F.col(c).cast("string") for c in df.columns]).alias("raw_content"),
        F.lit(None).cast("string").alias("timestamp"),
        role("Level", "level").alias("level"), role("Component", "source").alias("source"),
        role("LineId", default="").alias("log_id"), F.lit(True).alias("parsed"),
        F.array().cast("array<string>").alias("tags"), meta.alias("metadata"),
    )


def standard_from_text(parsed: DataFrame, line_number: str = "line_num") -> DataFrame:
    """StandardLog rows from parsed text lines."""
    pairs = [x for c in parsed.columns for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]
    meta = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
    return parsed.select(
        schema.text_or(parsed, "message").alias("message"), F.col("raw_content"),
        schema.text_or(parsed, "timestamp", None).alias("timestamp"),
        schema.text_or(parsed, "level", None).alias("level"), schema.text_or(parsed, "source", None).alias("source"),
        schema.text_or(parsed, line_number).alias("log_id"), F.col("parsed"),
        F.array().cast("array<string>").alias("tags"), meta.alias("metadata"),
    )


def to_json(entry: DataFrame) -> Column:
    """JSON of a StandardLog row: empty optional fields and the raw text are left out."""
    def optional(name: str) -> Column:
        return F.nullif(F.col(name), F.lit("")).alias(name)
    return F.to_json(F.struct(
        "message", "parsed", "tags", "metadata",
        optional("timestamp"), optional("level"), optional("source"), optional("log_id"),
    ))


def from_json(text: Column) -> Column:
    """StandardLog struct from JSON, with defaults for what is absent."""
    row = F.from_json(text, schema.STANDARD_LOG)
    message = F.coalesce(row["message"], F.lit(""))
    return F.struct(
        message.alias("message"), F.coalesce(row["raw_content"], message).alias("raw_content"),
        row["timestamp"].alias("timestamp"), row["level"].alias("level"), row["source"].alias("source"),
        row["log_id"].alias("log_id"), F.coalesce(row["parsed"], F.lit(True)).alias("parsed"),
        F.coalesce(row["tags"], F.array().cast("array<string>")).alias("tags"),
        F.coalesce(row["metadata"], F.create_map().cast("map<string,string>")).alias("metadata"),
    )


def iso_time(text: Column) -> Column:
    """ISO-8601 text (``Z`` allowed) as a UTC timestamp without zone."""
    ts = F.try_to_timestamp(text).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts)


def add_tag(tags: Column, tag: str) -> Column:
    return F.array_union(tags, F.array(F.lit(tag)))


def add_metadata(metadata: Column, key: str, value: Column) -> Column:
    """Set a key; an earlier value for it is replaced."""
    others = F.map_filter(metadata, lambda k, v: k != key)
    return F.map_concat(others, F.create_map(F.lit(key), value.cast("string")))


def get_metadata(metadata: Column, key: str, default: str | None = None) -> Column:
    return F.coalesce(F.try_element_at(metadata, F.lit(key)), F.lit(default))
