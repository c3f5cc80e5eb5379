"""Exact-size samples and splits, picked by digest so they repeat on any partitioning.

A row's place is the md5 of the seed and its ids, as hexadecimal text. How many rows a group takes is turned into a border:
histograms of the digests' prefixes find the prefix at which the number is reached, and only inside that prefix longer ones
are counted, level by level, until the number falls on an end of one. Rows are then taken by comparing their digest with the
border of their group; nothing is ranked or sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlog.checkpoints import written
from loomlog.operators.lookups import lookup

#: Hexadecimal digits that a level adds, and those of a digest.
_STEP, _DIGITS = 4, 32


def digest_of(ids: list[str], seed: int = 42) -> Column:
    """The md5 of ``seed|id|id...``; a null id counts as empty."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ids]))


def file_quotas(counts: DataFrame, source: str, target: int) -> DataFrame:
    """source, quota: ``target`` shared in proportion to row counts, rounding fixed one by one in source order."""
    whole = Window.partitionBy()
    share = counts.withColumn("quota", F.bround(F.lit(float(target)) * F.col("n") / F.sum("n").over(whole)).cast("long"))
    off = share.withColumn("_diff", F.lit(target) - F.sum("quota").over(whole))
    usable = (F.col("_diff") > 0) | (F.col("quota") > 0)
    turn = F.sum(usable.cast("int")).over(Window.partitionBy().orderBy(source).rowsBetween(Window.unboundedPreceding, 0))
    step = F.when(usable & (turn <= F.abs("_diff")), F.signum(F.col("_diff").cast("double")).cast("long")).otherwise(0)
    return off.select(source, (F.col("quota") + step).alias("quota"))


def borders(digests: DataFrame, group: str, quotas: DataFrame, digest: str = "_d") -> DataFrame:
    """group, border, tied: ``quota`` digests of the group are less than ``border``.

    Where equal digests (repeated ids) stand across the quota, ``tied`` of them are still to be taken; they equal the border.
    """
    open_, closed = quotas.filter("quota > 0").select(group, F.lit("").alias("_prefix"), F.col("quota").alias("_left")), None
    for length in range(0, _DIGITS, _STEP):
        inside = digests if not length else lookup(digests, open_.select(group, "_prefix"), [group], "inner").filter(
            F.startswith(F.col(digest), F.col("_prefix")))
        hist = inside.groupBy(group, F.substring(digest, length + 1, _STEP).alias("_next")).agg(F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy(group).orderBy("_next").rowsBetween(Window.unboundedPreceding, 0)
        total = Window.partitionBy(group)
        level = hist.withColumn("_cum", F.sum("n").over(upto)).withColumn("_all", F.sum("n").over(total)).join(open_, group)
        want = F.least("_left", "_all")
        edge = written(level.filter((F.col("_cum") >= want) & (F.col("_cum") - F.col("n") < want)).select(
            group, F.concat("_prefix", "_next").alias("_prefix"), want.alias("_want"), "_cum", "n"), "edges")
        # every digest with the prefix comes before the prefix and a letter that is no hexadecimal digit
        found = edge.filter("_cum = _want").select(group, F.concat("_prefix", F.lit("g")).alias("border"), F.lit(0).cast("long").alias("tied"))
        open_ = edge.filter("_cum > _want").select(group, "_prefix", (F.col("_want") - F.col("_cum") + F.col("n")).alias("_left"))
        closed = found if closed is None else closed.unionByName(found)
        if not open_.limit(1).count():
            return closed
    return closed.unionByName(open_.select(group, F.col("_prefix").alias("border"), F.col("_left").alias("tied")))


def mark_by_quota(df: DataFrame, group: str, quotas: DataFrame, ids: list[str], seed: int = 42) -> DataFrame:
    """All rows with ``_in`` true for exactly ``quota`` rows of each group: those with the smallest digests of ``ids``."""
    rows = df.withColumn("_d", digest_of(ids, seed))
    found = written(borders(rows.select(group, "_d"), group, quotas), "borders")
    cut = lookup(rows, found, [group], "left")
    marked = cut.withColumn("_in", F.coalesce(F.col("_d") < F.col("border"), F.lit(False)))
    if not found.filter("tied > 0").limit(1).count():
        return marked.select(*df.columns, "_in")
    # repeated ids at a border: the rows of that one digest are numbered, no others
    same = (F.col("tied") > 0) & (F.col("_d") == F.col("border"))
    nth = F.row_number().over(Window.partitionBy(group, "_d").orderBy(*ids))
    some = cut.filter(same).withColumn("_in", nth <= F.col("tied"))
    return marked.filter(~F.coalesce(same, F.lit(False))).select(*df.columns, "_in").unionByName(some.select(*df.columns, "_in"))


def sample_by_quota(df: DataFrame, group: str, quotas: DataFrame, ids: list[str], seed: int = 42) -> DataFrame:
    """Exactly ``quota`` rows of each group (all of a smaller group)."""
    return mark_by_quota(df, group, quotas, ids, seed).filter("_in").drop("_in")


def proportional_sample(df: DataFrame, source: str, target: int, ids: list[str], seed: int = 42) -> DataFrame:
    """``target`` rows over all sources, each in proportion to its size."""
    counts = df.groupBy(source).agg(F.count(F.lit(1)).alias("n"))
    return sample_by_quota(df, source, file_quotas(counts, source, target), ids, seed)


def sample_rows(df: DataFrame, n: int, ids: list[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, when there are fewer), without sorting the data."""
    one = df.withColumn("_g", F.lit(0))
    quotas = df.sparkSession.createDataFrame([(0, n)], "_g int, quota long")
    return sample_by_quota(one, "_g", quotas, ids, seed).drop("_g")


def mark_split(df: DataFrame, stratum: str, ids: list[str], name: str, test_share: float = 0.25, seed: int = 42) -> DataFrame:
    """All rows with ``name`` true for exactly ``ceil(test_share * n)`` rows of every class."""
    quotas = df.groupBy(stratum).agg(F.ceil(F.count(F.lit(1)) * F.lit(test_share)).cast("long").alias("quota"))
    return mark_by_quota(df, stratum, quotas, ids, seed).withColumnRenamed("_in", name)


def stratified_split(df: DataFrame, stratum: str, ids: list[str], test_share: float = 0.25, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test): exactly ``ceil(test_share * n)`` rows of every class go to the test side."""
    marked = mark_split(df, stratum, ids, "_in", test_share, seed)
    return marked.filter(~F.col("_in")).drop("_in"), marked.filter("_in").drop("_in")
