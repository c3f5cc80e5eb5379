"""Time windows over template or event streams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlog.operators.lookups import lookup

DAY = 86_400
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def to_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch, on the timestamp's own clock."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), ts.cast("timestamp_ntz"))


def from_seconds(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.expr(_EPOCH))


def aligned_window_counts(df: DataFrame, template: str, ts: str = "ts", width: str = "1 minute") -> DataFrame:
    """window_start, template, n on windows aligned to the clock."""
    return (
        df.filter(F.col(ts).isNotNull()).groupBy(F.window(ts, width).alias("w"), template).agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), template, "n")
    )


def _summarise(width: int):
    """For each day: every second a window may open at when entering the day, and the last window opened from there."""
    def summarise(days: pd.Series, seconds: pd.Series) -> pd.DataFrame:
        entries, lasts = [], []
        for day, secs in zip(days, seconds):
            s = np.sort(np.asarray(secs, dtype=np.int64))
            if not len(s):
                entries.append([]), lasts.append([])
                continue
            follow = np.minimum(np.searchsorted(s, s + width), len(s))
            last = np.append(follow, len(s))
            here = np.arange(len(s) + 1)
            last = np.where(last == len(s), here, last)   # no later window: the chain ends here
            while True:                                    # pointer doubling along the chain
                further = last[last]
                if np.array_equal(further, last):
                    break
                last = further
            first = np.unique(np.searchsorted(s, day * DAY + np.arange(width)))
            first = first[first < len(s)]
            entries.append(s[first].tolist())
            lasts.append(s[last[first]].tolist())
        return pd.DataFrame({"entries": entries, "lasts": lasts})
    return summarise


def _chain(width: int):
    """Walk one source's days in order, carrying only the last open window."""
    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("day")
        previous, rows = None, []
        source = pdf.iloc[0, 0]
        for day, entries, lasts in zip(pdf["day"], pdf["entries"], pdf["lasts"]):
            need = day * DAY if previous is None else max(previous + width, day * DAY)
            at = int(np.searchsorted(np.asarray(entries, dtype=np.int64), need))
            entry = int(entries[at]) if at < len(entries) else None
            rows.append((source, day, entry, previous))
            if entry is not None:
                previous = int(lasts[at])
        out = pd.DataFrame(rows, columns=["source", "day", "entry", "previous"])
        return out.astype({"entry": "Int64", "previous": "Int64"})
    return chain


def _expand(width: int):
    """Window start of every second of a day, given where the day is entered."""
    def expand(seconds: pd.Series, entry: pd.Series, previous: pd.Series) -> pd.DataFrame:
        all_secs, all_starts = [], []
        for secs, first, before in zip(seconds, entry, previous):
            s = np.sort(np.asarray(secs, dtype=np.int64))
            starts = [] if pd.isna(before) else [int(before)]
            at = len(s) if pd.isna(first) else int(np.searchsorted(s, int(first)))
            while at < len(s):
                starts.append(int(s[at]))
                at = int(np.searchsorted(s, s[at] + width))
            opened = np.asarray(starts, dtype=np.int64)
            own = opened[np.searchsorted(opened, s, side="right") - 1] if len(opened) else s
            all_secs.append(s.tolist())
            all_starts.append(own.tolist())
        return pd.DataFrame({"s": all_secs, "w": all_starts})
    return expand


def greedy_window_starts(df: DataFrame, source: str, ts: str = "ts", width: int = 60) -> DataFrame:
    """source, second, window_start (epoch seconds) of windows anchored at the data.

    A window opens at the first event at or after the previous window's end, so starts depend on
    all earlier events. The dependency is cut at day borders: entering a day, the next window can only
    open at the first event at or after one of ``width`` possible seconds, so a day is summarised by
    at most ``width`` (entry, last window) pairs. Only those summaries are walked in order per source;
    the days themselves, at most 86,400 distinct seconds each, are handled in parallel.
    """
    second = to_seconds(F.col(ts))
    days = (
        df.filter(F.col(ts).isNotNull()).select(F.col(source).alias("source"), second.alias("s"))
        .groupBy("source", F.floor(F.col("s") / DAY).cast("long").alias("day"))
        .agg(F.collect_set("s").alias("seconds"))
    )
    summarise = F.pandas_udf(_summarise(width), "entries array<long>, lasts array<long>")
    expand = F.pandas_udf(_expand(width), "s array<long>, w array<long>")
    kind = dict(df.dtypes)[source]
    entered = (
        days.select("source", "day", summarise("day", "seconds").alias("x")).select("source", "day", "x.entries", "x.lasts")
        .groupBy("source").applyInPandas(_chain(width), f"source {kind}, day long, entry long, previous long")
    )
    opened = days.join(entered, ["source", "day"]).select("source", expand("seconds", "entry", "previous").alias("x"))
    return opened.select(
        F.col("source").alias(source), F.explode(F.arrays_zip("x.s", "x.w")).alias("p")
    ).select(source, F.col("p.s").alias("second"), F.col("p.w").alias("window_start"))


def greedy_window_counts(df: DataFrame, source: str, template: str, ts: str = "ts", width: int = 60) -> DataFrame:
    """source, window_start, template, n on data-anchored windows; counts are reduced per second before the join."""
    per_second = (
        df.filter(F.col(ts).isNotNull()).groupBy(source, to_seconds(F.col(ts)).alias("second"), template)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    starts = greedy_window_starts(df, source, ts, width)
    return (
        per_second.join(starts, [source, "second"]).groupBy(source, "window_start", template).agg(F.sum("n").alias("n"))
        .withColumn("window_start", from_seconds(F.col("window_start")))
    )


def window_features(counts: DataFrame, templates: list[str], template: str, keys: list[str]) -> DataFrame:
    """One row per window, one count column per listed template (others are not counted)."""
    return counts.groupBy(*keys).pivot(template, templates).agg(F.sum("n")).na.fill(0, subset=[str(t) for t in templates])


def only_known(counts: DataFrame, known: DataFrame, template: str) -> DataFrame:
    """Keep the templates on the known list. Apply to counts, not to rows."""
    return counts.join(known.select(template).distinct(), template, "left_semi")


def top_templates(counts: DataFrame, template: str, n: int = 3, keys: list[str] | None = None) -> DataFrame:
    """Most frequent templates of each window, rank 1..n; zero counts never rank, ties by template."""
    keys = keys or ["window_start"]
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), template)
    return counts.filter(F.col("n") > 0).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def with_event_frequency(df: DataFrame, event: str, name: str = "event_freq") -> DataFrame:
    """How often the row's event type occurs, on each row: count first, then a salted join.

    A window over the event type would sort all rows of a dominant type in one task.
    """
    counts = df.groupBy(event).agg(F.count(F.lit(1)).alias(name))
    return lookup(df, counts, [event], "left")
