"""Row shapes and the plan-time choice of columns by role."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlog import fixed_values as fv

STANDARD_LOG = T.StructType([
    T.StructField("message", T.StringType()),
    T.StructField("raw_content", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("log_id", T.StringType()),
    T.StructField("parsed", T.BooleanType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

APP_LOG = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("log_level", T.StringType()),
    T.StructField("module", T.StringType()),
    T.StructField("message", T.StringType()),
])

NSL_KDD = T.StructType([
    T.StructField(name, T.StringType() if name in fv.NSL_KDD_TEXT_COLUMNS else T.DoubleType())
    for name in fv.NSL_KDD_COLUMNS
])


def _first_named(columns: list[str], names: list[str]) -> str | None:
    by_lower = {c.lower(): c for c in columns}
    return next((by_lower[n] for n in names if n in by_lower), None)


def message_column(df: DataFrame) -> str:
    """The column that holds the message; the first column when none is named like one."""
    return _first_named(df.columns, fv.MESSAGE_COLUMNS) or df.columns[0]


def ip_column(df: DataFrame) -> str | None:
    """The address column: a well-known name, else a name with ``ip`` as a whole word part.

    Word parts are split on ``_``, ``-``, spaces and lower-to-upper steps, so ``src_ip`` and
    ``clientIp`` qualify while ``description`` does not.
    """
    known = _first_named(df.columns, fv.IP_COLUMNS)
    if known:
        return known
    for name in df.columns:
        parts = re.split(r"[_\-\s.]+", re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name))
        if "ip" in [p.lower() for p in parts]:
            return name
    return None


def agent_column(df: DataFrame) -> str | None:
    """The user-agent column, by well-known name or by ``user`` and ``agent`` in the name."""
    known = _first_named(df.columns, fv.AGENT_COLUMNS)
    if known:
        return known
    for name in df.columns:
        lower = name.lower()
        if ("user" in lower and "agent" in lower) or lower.endswith("_ua"):
            return name
    return None


def size_column(df: DataFrame) -> str | None:
    return next((c for c in fv.SIZE_COLUMNS if c in df.columns), None)


def level_column(df: DataFrame) -> str | None:
    return next((c for c in df.columns if c.strip().lower() in ("level", "severity")), None)


def text_or(df: DataFrame, name: str, default: str | None = "") -> Column:
    """The column as string, or a literal when the frame has no such column."""
    return F.col(f"`{name}`").cast("string") if name in df.columns else F.lit(default).cast("string")


def align_columns(df: DataFrame, columns: list[str], fill=None) -> DataFrame:
    """Project to exactly ``columns``: add the missing ones as ``fill``, drop the rest, keep the order."""
    return df.select(*[
        F.col(f"`{c}`") if c in df.columns else F.lit(fill).alias(c) for c in columns
    ])


def union_aligned(*frames: DataFrame) -> DataFrame:
    """Union by name over the ordered union of all columns; absent ones become null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
