"""Queries of single rules and of files written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog.catalog.lines import _SYS, RAW, _field
from loomlog.catalog.registry import SQL, query
from loomlog.catalog.sql import frm, lit
from loomlog.catalog.tags import _LINE_SEV, _PASSED, _keyword_sql
from loomlog.checkpoints import fresh_path
from loomlog.functions import severity as sev
from loomlog.operators import evaluation
from loomlog.operators import features as feat
from loomlog.operators import parsing, windows
from loomlog.operators import templates as tpl
from loomlog.plans import unsupervised
from loomlog.sources import readers, sinks
from loomlog.sources.views import table, view

APP = frm("app_log")
_EVENT = "regexp_extract(line, '\\[(.*?)\\]', 1)"


# ---------------------------------------------------------------- single rules

@query("rule_overrides", f"""SELECT line_id, CASE WHEN {_PASSED} THEN false ELSE line_id % 7 = 0 OR {_keyword_sql('line')} >= 2 OR {_LINE_SEV} IN ('WARN', 'ERROR') END AS anomaly,
 {_LINE_SEV} = 'INFO' AND {_EVENT} IN ('view', 'click', {', '.join(lit(x) for x in fv.BENIGN_EVENT_TYPES)}) AND count(*) OVER (PARTITION BY {_EVENT}) > 1 AS benign FROM {APP}""")
def rule_overrides(spark, d):
    """A flag on every seventh line, overridden by the rules; and which lines are common benign ones, two events counted as benign."""
    line = F.col("line")
    rows = view(spark, d, "app_log").select("line_id", "line", sev.event_type(line, line).alias("event"))
    rows = windows.with_event_frequency(rows, "event")
    known = F.when(F.col("event").isin("view", "click"), fv.BENIGN_EVENT_TYPES[0]).otherwise(F.col("event"))
    return rows.select("line_id", sev.override_prediction(F.col("line_id") % 7 == 0, line).alias("anomaly"),
                       sev.is_benign_info(sev.line_severity(line), known, F.col("event_freq")).alias("benign"))


_LABEL = "CASE event_type WHEN 'view' THEN ' Benign ' WHEN 'click' THEN 'NORMAL' WHEN 'error' THEN NULL ELSE event_type END"
_NORMAL = ", ".join(lit(x) for x in fv.NORMAL_FLOW_LABELS)


@query("flow_labels", f"SELECT event_id, CASE WHEN lower(trim({_LABEL})) IN ({_NORMAL}) THEN 0 ELSE 1 END AS y FROM events")
def flow_labels(spark, d):
    """Labels of three spellings and none as 0 for normal traffic and 1 for the rest."""
    return table(spark, d, "events").select("event_id", sev.flow_label_is_anomaly(F.expr(_LABEL)).alias("y"))


@query("prefer_normal_rows", f"""SELECT 'zero' AS style, count(*) AS n FROM lineitem WHERE l_linenumber - 1 = 0 UNION ALL
 SELECT 'prefix', count(*) FROM events WHERE event_type LIKE 'view%' UNION ALL SELECT 'words', count(*) FROM events WHERE lower({_LABEL}) IN ({_NORMAL}) UNION ALL
 SELECT 'none', count(*) FROM events""")
def prefer_normal_rows(spark, d):
    """How many rows each way of choosing normal traffic keeps; all of them where none is normal."""
    events = table(spark, d, "events")
    zero = feat.prefer_normal(table(spark, d, "lineitem").select((F.col("l_linenumber") - 1).alias("label")), "label", "zero")
    prefix = feat.prefer_normal(events.select(F.regexp_replace("event_type", "^view", "Normal.").alias("label")), "label", "prefix")
    words = feat.prefer_normal(events.select(F.expr(_LABEL).alias("label")), "label", "words")
    none = feat.prefer_normal(events.select(F.lit("attack").alias("label")), "label", "words")
    out = None
    for style, rows in (("zero", zero), ("prefix", prefix), ("words", words), ("none", none)):
        one = rows.agg(F.lit(style).alias("style"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query("line_times", f"SELECT line_id, strftime(strptime(replace(regexp_extract(line, '(\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}[,.]\\d+)', 1)[:23], ',', '.'), '%Y-%m-%d %H:%M:%S.%g'), '%Y-%m-%d %H:%M:%S.%g') AS at FROM {APP}")
def line_times(spark, d):
    """The time written in each line."""
    return view(spark, d, "app_log").select("line_id", F.date_format(unsupervised.line_time(F.col("line")), "yyyy-MM-dd HH:mm:ss.SSS").alias("at"))


@query("syslog_minutes", f"SELECT strftime(date_trunc('minute', strptime('2024 ' || {_field('timestamp', 'syslog', 1)}, '%Y %b %d %H:%M:%S')), '%Y-%m-%d %H:%M:%S') AS minute, count(*) AS n FROM {RAW} WHERE {_SYS} GROUP BY 1")
def syslog_minutes(spark, d):
    """Syslog lines by minute: the lines name no year, it is given."""
    parsed = parsing.parse_lines(view(spark, d, "raw_lines").select("line_id", "value"), "syslog", year=2024).filter("parsed")
    counts = windows.aligned_window_counts(parsed.withColumn("kind", F.lit("line")), "kind", "datetime_obj", "1 minute")
    return counts.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("minute"), "n")


# ---------------------------------------------------------------- files

@query("templates_file", f"SELECT CAST(row_number() OVER (ORDER BY template) AS int) AS id, template FROM ({SQL['mine_templates']})")
def templates_file(spark, d):
    """Mined templates written as a numbered list and read back."""
    found = tpl.mine_templates(view(spark, d, "app_log").select("line_id", "message"), "message")
    return readers.read_templates(spark, sinks.write_templates(found, fresh_path(spark, "template-list")))


@query("directory_parsed", "SELECT source_file, format, count(*) AS n, count(*) FILTER (WHERE parsed) AS parsed FROM (" + SQL["parse_by_source"] + ") GROUP BY 1, 2")
def directory_parsed(spark, d):
    """Raw lines written as one folder of text files per source, and the directory read with each file's own format."""
    path = fresh_path(spark, "logs")
    lines = view(spark, d, "raw_lines")
    lines.repartitionByRange("source_file", "line_id").sortWithinPartitions("source_file", "line_id").select("source_file", "value").write.partitionBy("source_file").text(path)
    parsed = readers.parse_directory(spark, path, recursive=True)
    name = F.regexp_extract("source_file", r"source_file=([^/]+)/", 1)
    return parsed.groupBy(name.alias("source_file"), "format").agg(F.count(F.lit(1)).alias("n"), F.count_if("parsed").alias("parsed"))


_KINDS = ["click", "error", "purchase", "signup", "view"]


@query("window_feature_files", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, " + ", ".join(
    f"CAST(count(*) FILTER (event_type = '{k}') AS varchar) AS \"{k}\"" for k in _KINDS) + " FROM events GROUP BY 1")
def window_feature_files(spark, d):
    """Event counts per hour, one column per type, written as CSV and read back as text."""
    counts = windows.aligned_window_counts(table(spark, d, "events"), "event_type", width="1 hour")
    wide = windows.window_features(counts.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")), _KINDS, "event_type", ["window_start"])
    return readers.read_csv_log(spark, sinks.write_window_features(wide, fresh_path(spark, "windows")), infer=False)


@query("scored_files", "SELECT CAST(line_id AS varchar) AS line_id, CAST(line_id % 100 - 50 AS varchar) AS anomaly_score, CAST(CAST(line_id % 100 < 50 AS int) AS varchar) AS is_anomaly FROM " + APP)
def scored_files(spark, d):
    """Rows with a score and a flag written as CSV and read back as text."""
    score = F.col("line_id") % 100 - 50
    rows = view(spark, d, "app_log").select("line_id", score.alias("anomaly_score"), (score < 0).cast("int").alias("is_anomaly"))
    return readers.read_csv_log(spark, sinks.write_scored(rows, fresh_path(spark, "scored"), "csv"), infer=False)


@query("template_list_file", "SELECT DISTINCT p_name AS value FROM part WHERE p_name IS NOT NULL")
def template_list_file(spark, d):
    """Distinct names written one per line and read back."""
    return spark.read.text(sinks.write_unique_templates(table(spark, d, "part"), fresh_path(spark, "names"), "p_name"))


@query("truth_file", f"SELECT CAST(count(*) FILTER (line_id % 3 = 0 AND line_id % 2 = 0) AS bigint) AS tp, CAST(count(*) FILTER (line_id % 3 <> 0 AND line_id % 2 = 0) AS bigint) AS fp, CAST(count(*) FILTER (line_id % 3 = 0 AND line_id % 2 <> 0) AS bigint) AS fn FROM {APP}")
def truth_file(spark, d):
    """Predictions scored against a truth table that was written as CSV and read back."""
    logs = view(spark, d, "app_log").select(F.col("line_id").alias("LineId"))
    truth = readers.read_ground_truth(spark, sinks.write_csv(logs.filter("LineId % 3 = 0").withColumn("is_error", F.lit(1)), fresh_path(spark, "truth")))
    predicted = logs.withColumn("flagged", F.col("LineId") % 2 == 0)
    return evaluation.score_against_truth(predicted, truth.withColumn("LineId", F.col("LineId").cast("long"))).select("tp", "fp", "fn")
