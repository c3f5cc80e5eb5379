"""Helpers the corpus operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog.checkpoints import fresh_path

#: ASCII white space, the word separator of the corpus operators.
BLANKS = "[ \\t-\\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id and text alone (a null text is empty), so other columns of any name stay out of the way."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and not lost with an executor."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """``df`` (a few numbers a row), marked for broadcasting if it is counted to have no more rows than this."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def kept_in_worker(name: str, make: Callable[[], Any]) -> Any:
    """A value made once per Python worker. Functions reach workers by value, so module globals do not last."""
    store = sys.__dict__.setdefault("_loomlog_kept", {})
    if name not in store:
        store[name] = make()
    return store[name]
