"""Roll-ups over log tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog import schema
from loomlog.functions.ip import extract_ip_loose
from loomlog.functions.text import let, percent, to_number
from loomlog.operators.lookups import lookup
from loomlog.operators.numbering import with_numbers
from loomlog.operators.parsing import epoch_to_ntz
from loomlog.operators.quantiles import quantiles_and
from loomlog.operators.websignals import number_column


def count_rows() -> Column:
    return F.count(F.lit(1))


def status_distribution(df: DataFrame) -> DataFrame:
    """status, n, pct of all rows; rows without a numeric status count only in the total."""
    kind = dict(df.dtypes)["status"]
    code = to_number(F.col("status")) if kind == "string" else F.col("status")
    groups = df.groupBy(code.cast("int").alias("status")).agg(count_rows().alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over the grouped rows: one per status code
    return (
        groups.select("status", "n", percent(F.col("n"), total, 2).alias("pct"))
        .filter(F.col("status").isNotNull()).orderBy("status")
    )


def status_classes(df: DataFrame) -> DataFrame:
    """Share of 2xx, 3xx, 4xx and 5xx in percent, in one row."""
    status = number_column(df, "status", -1)
    return df.agg(*[
        percent(F.count_if(status.between(c * 100, c * 100 + 99)), count_rows()).alias(f"pct_{c}xx") for c in (2, 3, 4, 5)
    ])


def response_sizes(df: DataFrame, column: str | None = None) -> DataFrame:
    """total, mean, p50, p95 of the response size; bad values count as 0."""
    name = column or schema.size_column(df)
    sizes = df.select(number_column(df, name, 0.0).alias("v"))
    (p50, p95), row = quantiles_and(sizes, "v", [0.5, 0.95], [F.sum("v").cast("long").alias("total"), F.avg("v").alias("mean")])
    return df.sparkSession.createDataFrame(
        [(row["total"], row["mean"], p50, p95)], "total_bytes long, mean_bytes double, p50_bytes double, p95_bytes double")


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """column, n by count; ties by value. With ``top`` only the head is kept, without a full sort."""
    out = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(count_rows().alias("n"))
        .orderBy(F.desc("n"), column)
    )
    return out.limit(top) if top else out


def top_attackers(df: DataFrame, flagged: Column, top: int = 10, message: str | None = None) -> DataFrame:
    """ip, n among flagged rows: by the ``ip`` column, else by the address named in the text."""
    if "ip" in df.columns:
        ip = F.trim(F.col("ip").cast("string"))
    else:
        msg = message or schema.message_column(df)
        other = "Content" if msg != "Content" else "message"
        names = ([other] if other in df.columns else []) + [msg]
        ip = let(F.concat_ws(" ", *[F.col(n).cast("string") for n in names]), extract_ip_loose)
    return value_counts(df.filter(flagged).select(ip.alias("ip")), "ip", top)


def entity_template_counts(df: DataFrame, templates: list | None = None, entity: str = "entity_id", template: str = "template_id") -> DataFrame:
    """One row per entity, one count column per template, zeros filled.

    Columns are part of the schema, so their names are read; pass the list to spare the pass that finds it. With very many
    templates :func:`entity_template_vectors` holds the same counts without a column for each.
    """
    if templates is None:
        templates = [r[0] for r in df.select(template).filter(F.col(template).isNotNull()).distinct().orderBy(template).collect()]
    counts = df.groupBy(entity).pivot(template, templates).agg(count_rows())
    return counts.na.fill(0, subset=[str(t) for t in templates])


def template_numbers(df: DataFrame, template: str = "template_id") -> DataFrame:
    """template, index: the distinct templates numbered from 0 in order, on the executors."""
    return with_numbers(df.select(template).filter(F.col(template).isNotNull()).distinct(), [template], "index")


def entity_template_vectors(df: DataFrame, numbers: DataFrame | None = None, entity: str = "entity_id", template: str = "template_id") -> DataFrame:
    """entity, features: the sparse counts of each entity as indices (of :func:`template_numbers`) and values, in order.

    Any number of templates. Templates that ``numbers`` lacks are not counted.
    """
    numbers = template_numbers(df, template) if numbers is None else numbers
    counts = lookup(entity_template_long(df, entity, template), numbers, [template], "inner")
    pairs = F.sort_array(F.collect_list(F.struct("index", "n")))  # one entity: at most a pair for each template
    return counts.groupBy(entity).agg(pairs.alias("p")).select(entity, F.struct(
        F.transform("p", lambda x: x["index"].cast("int")).alias("indices"), F.transform("p", lambda x: x["n"].cast("double")).alias("values")).alias("features"))


def entity_template_long(df: DataFrame, entity: str = "entity_id", template: str = "template_id") -> DataFrame:
    """entity, template, n without a column per template."""
    return df.groupBy(entity, template).agg(count_rows().alias("n"))


def entity_aggregates(df: DataFrame, entity: str = "entity_id", time_col: str | None = None) -> DataFrame:
    """Per entity (and time key): status count and distinct, bytes sum/mean/std, distinct paths."""
    keys = [entity] + ([time_col] if time_col else [])
    return df.groupBy(*keys).agg(
        F.count("status").alias("status_count"), F.count_distinct("status").alias("status_nunique"),
        F.sum("bytes").alias("bytes_sum"), F.avg("bytes").alias("bytes_mean"),
        F.stddev_samp("bytes").alias("bytes_std"), F.count_distinct("path").alias("path_nunique"),
    )


def dataset_profile(df: DataFrame, source: str, modules: int = 5, cut: int = 20) -> DataFrame:
    """Per source: row count, the first few module names (cut short) and the levels present."""
    base = df.select(source, F.substring("module", 1, cut).alias("module"), F.col("log_level").alias("level"))
    # Count distinct (source, module, level) first: what follows no longer sees one row per log line.
    small = base.groupBy(source, "module", "level").agg(count_rows().alias("n"))
    rows = small.groupBy(source).agg(F.sum("n").alias("valid_rows"))
    by_name = Window.partitionBy(source).orderBy("module")
    named = (
        small.filter(F.col("module").isNotNull()).select(source, "module").distinct()
        .withColumn("_r", F.row_number().over(by_name)).filter(F.col("_r") <= modules)
        .groupBy(source).agg(F.concat_ws(",", F.array_sort(F.collect_list("module"))).alias("modules_preview"))
    )
    levels = (
        small.filter(F.col("level").isNotNull()).select(source, "level").distinct()
        .groupBy(source).agg(F.concat_ws(",", F.array_sort(F.collect_list("level"))).alias("levels_present"))
    )
    return (
        rows.join(named, source, "left").join(levels, source, "left")
        .na.fill("", subset=["modules_preview", "levels_present"])
    )


def severity_mix(df: DataFrame, flagged: Column, level: str = "log_level") -> DataFrame:
    """severity, n, pct for INFO, WARN, ERROR (with FATAL and CRITICAL) and the flagged rows."""
    value = F.upper(F.coalesce(F.col(level), F.lit("INFO")))
    one = df.agg(
        count_rows().alias("_total"), F.count_if(value == "INFO").alias("INFO"), F.count_if(value == "WARN").alias("WARN"),
        F.count_if(value.isin(*fv.SEVERE_LEVELS)).alias("ERROR"), F.count_if(flagged).alias("ANOMALY"),
    )
    return one.select("_total", F.inline(F.array(*[
        F.struct(F.lit(n).alias("severity"), F.col(n).alias("n")) for n in ("INFO", "WARN", "ERROR", "ANOMALY")
    ]))).select("severity", "n", percent(F.col("n"), F.col("_total")).alias("pct"))


def report_summary(df: DataFrame, expected: Column, model: Column | None = None, level: str = "log_level") -> DataFrame:
    """total, normal, warn_err, expected, anomaly rate and model-flagged rows, in one row."""
    warn = F.count_if(F.col(level).isin(*fv.ANOMALY_LEVELS))
    return df.agg(
        count_rows().alias("total"), (count_rows() - warn).alias("normal"), warn.alias("warn_err"),
        F.count_if(expected).alias("expected"), percent(F.count_if(expected), count_rows()).alias("anomaly_rate"),
        F.count_if(model if model is not None else F.lit(False)).alias("model_flagged"),
    )


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count(column).alias("n_distinct"))


def time_range(df: DataFrame) -> DataFrame:
    """start and end of the first usable time column, as text; Date + Time when none is usable.

    Numbers and ten-digit texts between 1e9 and 1e10 are epoch seconds.
    """
    kinds = dict(df.dtypes)
    ranges: list[Column] = []

    def add(value: Column) -> None:
        ranges.append(F.when(F.count(value) > 0, F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))))

    for name in fv.TIME_COLUMNS:
        if name not in df.columns:
            continue
        col, kind = F.col(name), kinds[name]
        if kind.startswith(("timestamp", "date")):
            add(col.cast("timestamp_ntz"))
            continue
        number = col.try_cast("double")
        if kind != "string":
            add(F.when((number >= 1e9) & (number < 1e10), epoch_to_ntz(number.cast("long"))))
        else:
            add(F.when(col.rlike("^[0-9]{10}$"), epoch_to_ntz(number.cast("long"))))
            # A clock time alone names no day and is not usable.
            add(F.when(col.rlike(r"[0-9]{4}[-/]"), F.try_to_timestamp(F.translate(col, ",/", ".-")).cast("timestamp_ntz")))
    for d in ("Date", "date"):
        for t in ("Time", "time"):
            if {d, t} <= set(df.columns):
                day = F.replace(F.col(d).cast("string"), F.lit("/"), F.lit("-"))
                add(F.try_to_timestamp(F.concat_ws(" ", day, F.col(t).cast("string"))).cast("timestamp_ntz"))
    if not ranges:
        return df.limit(1).agg(F.lit(None).cast("string").alias("start"), F.lit(None).cast("string").alias("end"))
    one = df.agg(F.coalesce(*ranges).alias("r"))
    return one.select(*[
        F.date_format(F.col(f"r.{side}"), "yyyy-MM-dd HH:mm:ss").alias(name) for side, name in (("lo", "start"), ("hi", "end"))
    ])


def sample_message(df: DataFrame, order: str, message: str | None = None) -> DataFrame:
    """total_logs and the first message, in one row."""
    msg = message or schema.message_column(df)
    return df.agg(count_rows().alias("total_logs"), F.min_by(msg, order).alias("sample_message"))


def rows_per_file(df: DataFrame) -> DataFrame:
    """file, n for a frame read from files."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(count_rows().alias("n"))
