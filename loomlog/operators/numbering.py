"""Numbers for rows in an order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog.checkpoints import written

_IN_PARTITION = (1 << 33) - 1  # the bits in which a generated id counts the rows of its partition


def with_numbers(df: DataFrame, order: list[str], name: str = "number", start: int = 0) -> DataFrame:
    """Add 0, 1, 2, ... in the order of ``order``; rows that agree there are numbered in any order.

    Rows are dealt into ranges, sorted and counted in each; the counts of the ranges before are added to a row's place in
    its own. Only those counts, one for each partition, pass through the driver.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranged.withColumns({
        "_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))}), "numbered")
    return placed.withColumn(name, F.col("_place") + _rows_before(placed) + F.lit(start)).drop("_range", "_place")


def _rows_before(placed: DataFrame) -> Column:
    total, before = 0, []
    for r in placed.groupBy("_range").count().orderBy("_range").collect():  # one row for each partition
        before += F.lit(r["_range"]), F.lit(total)
        total += r["count"]
    return F.element_at(F.create_map(*before), F.col("_range")).cast("long") if before else F.lit(0).cast("long")
