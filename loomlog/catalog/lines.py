"""Queries over raw and structured lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog.catalog.registry import query
from loomlog.catalog.sql import contains_any, frm, group, has, lit, union
from loomlog.functions.text import extract_level, extract_timestamp, parse_month_day
from loomlog.operators import parsing
from loomlog.sources.views import view

RAW = frm("raw_lines")


def _field(name: str, fmt: str, k: int) -> str:
    text = group("value", "^(?:" + fv.LINE_FORMATS[fmt][0] + ")", k)
    return f"nullif({text}, '')" if fmt == "syslog" and name == "pid" else text


def _matches(fmt: str) -> str:
    return has("value", "^(?:" + fv.LINE_FORMATS[fmt][0] + ")")


_TIME = {
    "clf": "strftime(strptime({x}, '%d/%b/%Y:%H:%M:%S +0000'), '%Y-%m-%d %H:%M:%S')",
    "slash": "strftime(strptime({x}, '%Y/%m/%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')",
}


def _parse_sql(fmt: str) -> str:
    hit, fields = _matches(fmt), fv.LINE_FORMATS[fmt][1]
    cols = [f"CASE WHEN {hit} THEN {_field(n, fmt, i)} END AS \"{n}\"" for i, n in enumerate(fields, 1)]
    if "datetime" in fields:
        x = _field("datetime", fmt, fields.index("datetime") + 1)
        cols.append(f"CASE WHEN {hit} THEN {_TIME['slash' if fmt == 'nginx_error' else 'clf'].format(x=x)} END AS datetime_obj")
    if {"date", "time"} <= set(fields):
        cols.append(f"CASE WHEN {hit} THEN {_field('date', fmt, 1)} || ' ' || {_field('time', fmt, 2)} END AS datetime_obj")
    return f"SELECT line_id, {', '.join(cols)}, {hit} AS parsed FROM {RAW}"


def _register_parse(fmt: str) -> None:
    @query(f"parse_{fmt}", _parse_sql(fmt))
    def parse(spark, d):
        rows = parsing.parse_lines(view(spark, d, "raw_lines").select("line_id", "value"), fmt).drop("raw_content")
        if "datetime_obj" in rows.columns:
            rows = rows.withColumn("datetime_obj", F.date_format("datetime_obj", "yyyy-MM-dd HH:mm:ss"))
        return rows


for _name in fv.LINE_FORMATS:
    _register_parse(_name)


def _detect_sql() -> str:
    head = f"(SELECT source_file, trim(value) AS value FROM (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY line_id) AS r FROM {RAW}) WHERE r <= 10 AND length(trim(value)) > 0)"
    per = [f"SELECT source_file, {lit(n)} AS format, {i} AS ord, count(*) FILTER (WHERE {_matches(n)}) AS hits, count(*) AS total FROM head GROUP BY source_file" for i, n in enumerate(fv.LINE_FORMATS)]
    return (
        f"WITH head AS {head} SELECT source_file, CASE WHEN hits > 0 THEN format ELSE 'unknown' END AS format, round(hits * 1.0 / total, 6) AS match_ratio"
        f" FROM (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY hits DESC, ord) AS r FROM ({union(per)})) WHERE r = 1"
    )


@query("detect_format", _detect_sql())
def detect_format(spark, d):
    out = parsing.detect_formats(view(spark, d, "raw_lines"), "source_file", "line_id")
    return out.withColumn("match_ratio", F.round("match_ratio", 6))


def _of_format(column: str, field: str) -> str:
    cases = " ".join(
        f"WHEN {lit(n)} THEN CASE WHEN {_matches(n)} THEN {_field(field, n, fields.index(field) + 1)} END"
        for n, (_, fields) in fv.LINE_FORMATS.items() if field in fields)
    return f"CASE {column} {cases} END"


_DETECTED = f"(SELECT r.line_id, r.value, f.source_file, f.format FROM {frm('raw_lines', 'r')} JOIN ({_detect_sql()}) f USING (source_file))"


@query("parse_by_source", f"SELECT line_id, source_file, format, {_of_format('format', 'status')} AS status, {_of_format('format', 'level')} AS level, {_of_format('format', 'message')} AS message, CASE format "
       + " ".join(f"WHEN {lit(n)} THEN {_matches(n)}" for n in fv.LINE_FORMATS) + f" END AS parsed FROM {_DETECTED} WHERE format <> 'unknown'")
def parse_by_source(spark, d):
    out = parsing.parse_by_source(view(spark, d, "raw_lines"), "source_file", "line_id")
    return out.select("line_id", "source_file", "format", "status", "level", "message", "parsed")


_MIXED_FMT = "CASE " + " ".join(f"WHEN {_matches(n)} THEN {lit(n)}" for n in fv.MIXED_LINE_FORMATS) + " END"


def _mixed(field: str) -> str:
    cases = " ".join(f"WHEN {lit(n)} THEN {_field(field, n, fv.LINE_FORMATS[n][1].index(field) + 1)}" for n in fv.MIXED_LINE_FORMATS if field in fv.LINE_FORMATS[n][1])
    return f"CASE format {cases} END"


@query("parse_mixed_lines", f"""SELECT line_id, format, {_mixed('ip')} AS ip, {_mixed('method')} AS method, {_mixed('path')} AS path, {_mixed('status')} AS status, {_mixed('level')} AS level, {_mixed('message')} AS message,
 CASE WHEN format IN ('apache_combined', 'apache_common') THEN {_TIME['clf'].format(x=_mixed('datetime'))} WHEN format = 'nginx_error' THEN {_TIME['slash'].format(x=_mixed('datetime'))}
 WHEN format = 'w3c_extended' THEN {_mixed('date')} || ' ' || {_mixed('time')} END AS datetime_obj FROM (SELECT *, {_MIXED_FMT} AS format FROM {RAW})""")
def parse_mixed_lines(spark, d):
    out = parsing.parse_mixed(view(spark, d, "raw_lines").select("line_id", "value"))
    return out.select("line_id", "format", "ip", "method", "path", "status", "level", "message", F.date_format("datetime_obj", "yyyy-MM-dd HH:mm:ss").alias("datetime_obj"))


@query("parse_app_log", f"SELECT line_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS timestamp, log_level, module, message FROM {frm('app_log')}")
def parse_app_log(spark, d):
    out = parsing.parse_app_log(view(spark, d, "app_log").select("line_id", F.col("line").alias("value")))
    return out.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSS"))


@query("find_times_and_levels", "SELECT line_id, " + ", ".join(f"nullif({group('value', p)}, '') AS t_{n}" for n, p in fv.TIMESTAMP_FINDERS.items())
       + ", " + ", ".join(f"nullif({group('value', p)}, '') AS l_{n}" for n, p in fv.LEVEL_FINDERS.items()) + f" FROM {RAW}")
def find_times_and_levels(spark, d):
    v = F.col("value")
    return view(spark, d, "raw_lines").select(
        "line_id", *[extract_timestamp(v, n).alias(f"t_{n}") for n in fv.TIMESTAMP_FINDERS],
        *[extract_level(v, n).alias(f"l_{n}") for n in fv.LEVEL_FINDERS])


# ---------------------------------------------------------------- structured families

def _level_sql(c: str) -> str:
    return f"CASE WHEN {contains_any(f'lower({c})', fv.LEVEL_ERROR_WORDS)} THEN 'ERROR' WHEN {contains_any(f'lower({c})', fv.LEVEL_WARN_WORDS)} THEN 'WARN' ELSE 'INFO' END"


def _out(df):
    return df.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSS"))


_MS = "'%Y-%m-%d %H:%M:%S.%g'"


@query("structured_linux", f"""SELECT line_id, strftime(strptime("Month" || ' ' || coalesce(lpad(CAST(CAST(TRY_CAST("Date" AS double) AS int) AS varchar), 2, '0'), '01') || ' 2025 ' || "Time", '%b %d %Y %H:%M:%S'), {_MS}) AS timestamp, {_level_sql('trim("Content")')} AS log_level, "Component" AS module, trim("Content") AS message FROM {frm('structured_linux')}""")
def structured_linux(spark, d):
    return _out(parsing.structured_rows(view(spark, d, "structured_linux")))


@query("structured_bgl", f"""SELECT line_id, CASE WHEN "Time" <> 'unknown' THEN substr("Time", 1, 10) || ' ' || replace(substr("Time", 12, 8), '.', ':') || '.' || substr("Time", 21, 3) END AS timestamp, upper("Level") AS log_level, "Component" AS module, trim("Content") AS message FROM {frm('structured_bgl')}""")
def structured_bgl(spark, d):
    return _out(parsing.structured_rows(view(spark, d, "structured_bgl")))


@query("structured_thunderbird", f"""SELECT line_id, CASE WHEN line_id % 3 = 0 THEN strftime(make_timestamp((1131566461 + line_id) * 1000000), {_MS}) WHEN line_id % 3 = 1 THEN strftime(strptime("Month" || ' ' || "Day" || ' 2005 ' || "Time", '%b %d %Y %H:%M:%S'), {_MS}) ELSE replace("Date", '.', '-') || ' ' || "Time" || '.000' END AS timestamp, {_level_sql('trim("Content")')} AS log_level, "Component" AS module, trim("Content") AS message FROM {frm('structured_thunderbird')}""")
def structured_thunderbird(spark, d):
    return _out(parsing.structured_rows(view(spark, d, "structured_thunderbird")))


@query("structured_apache", f"""SELECT line_id, strftime(strptime("Time", '%a %b %d %H:%M:%S %Y'), {_MS}) AS timestamp, CASE WHEN upper("Level") = 'NOTICE' THEN 'INFO' ELSE upper("Level") END AS log_level, 'apache' AS module, trim("Content") AS message FROM {frm('structured_apache')} WHERE "Time" <> 'bad time'""")
def structured_apache(spark, d):
    return _out(parsing.structured_rows(view(spark, d, "structured_apache")))


@query("structured_hdfs", f"""SELECT line_id, strftime(strptime(lpad(CAST("Date" AS varchar), 6, '0') || lpad(CAST("Time" AS varchar), 6, '0'), '%m%d%y%H%M%S'), {_MS}) AS timestamp, "Level" AS log_level, "Component" AS module, trim("Content") AS message FROM {frm('structured_hdfs')}""")
def structured_hdfs(spark, d):
    return _out(parsing.structured_rows(view(spark, d, "structured_hdfs"), "hdfs"))


# ---------------------------------------------------------------- normalised entries

_SYS = _matches("syslog")


@query("parse_month_day_times", f"SELECT line_id, CASE WHEN {_SYS} THEN strftime(strptime('2024 ' || {_field('timestamp', 'syslog', 1)}, '%Y %b %d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') END AS at FROM {RAW}")
def parse_month_day_times(spark, d):
    """Syslog times, which name no year, in the year 2024."""
    parsed = parsing.parse_lines(view(spark, d, "raw_lines").select("line_id", "value"), "syslog")
    return parsed.select("line_id", F.date_format(parse_month_day(F.col("timestamp"), 2024), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("standard_log_json", f"SELECT CASE WHEN {_SYS} THEN {_field('message', 'syslog', 5)} ELSE '' END AS message, CAST(line_id AS varchar) AS log_id, {_SYS} AS parsed, CASE WHEN {_SYS} THEN {_field('timestamp', 'syslog', 1)} END AS timestamp, CASE WHEN {_SYS} THEN {_field('host', 'syslog', 2)} END AS host, 'seen' AS tag FROM {RAW}")
def standard_log_json(spark, d):
    parsed = parsing.parse_lines(view(spark, d, "raw_lines").select("line_id", "value"), "syslog")
    entry = parsing.standard_from_text(parsed, "line_id").withColumn("message", F.coalesce("message", F.lit("")))
    entry = entry.withColumn("tags", parsing.add_tag(parsing.add_tag(F.col("tags"), "seen"), "seen"))
    back = entry.select(parsing.from_json(parsing.to_json(entry)).alias("e")).select("e.*")
    return back.select("message", "log_id", "parsed", "timestamp", parsing.get_metadata(F.col("metadata"), "host").alias("host"),
                       F.array_join("tags", ",").alias("tag"))


@query("standard_log_structured", f'SELECT "Content" AS message, "Level" AS level, "Component" AS source, CAST("LineId" AS varchar) AS log_id, CAST(NULL AS varchar) AS timestamp, ip AS meta_ip, \'x\' AS meta_added FROM {frm("auth_log")}')
def standard_log_structured(spark, d):
    entry = parsing.standard_from_structured(view(spark, d, "auth_log"))
    meta = parsing.add_metadata(parsing.add_metadata(F.col("metadata"), "added", F.lit("w")), "added", F.lit("x"))
    return entry.select("message", "level", "source", "log_id", "timestamp", parsing.get_metadata(meta, "ip").alias("meta_ip"),
                        parsing.get_metadata(meta, "added").alias("meta_added"))
