"""Running windows over long series (W1-W3, W5, N11) without one task a group.

The plain windows of ``windows.py`` and ``nulls.ffill_bfill`` give a group's whole
series to one task, which a calendar bounds.  Where a group may hold most rows of
a large table, its series is cut instead: rows are range-partitioned by (group,
order), each task scans its own block, and what a block needs from others (row
count before it, last value before it, first value after it) comes from a slim
table of one row per group and block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from ..sizing import checked_broadcast

# Rows of a block of ``with_rolling``; each brings ``rows`` more of its neighbour.
BLOCK_ROWS = 4096


def blocked(df: DataFrame, group: str, order: str, blocks: int | None = None) -> DataFrame:
    """Rows dealt by (group, order) with their task as ``__block``; stored, so
    that a block's number stays the same.  Ties in ``order`` follow one another
    in an unspecified way."""
    n = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, F.col(group), F.col(order)).withColumn("__block", F.spark_partition_id()))


def with_fill(df: DataFrame, cols: list[str], group: str, order: str, blocks: int | None = None) -> DataFrame:
    """Forward, then backward fill of ``cols`` along each group.  A group
    without any value stays null; a null group is a group of its own."""
    rows = blocked(df, group, order, blocks)
    here = W.partitionBy("__block", group).orderBy(order)
    back, on = here.rowsBetween(W.unboundedPreceding, 0), here.rowsBetween(0, W.unboundedFollowing)
    ends = rows.groupBy(F.col(group).alias("__g"), F.col("__block").alias("__b")).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__last{i}") for i, c in enumerate(cols)],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__first{i}") for i, c in enumerate(cols)])
    chain = W.partitionBy("__g").orderBy("__b")
    before, after = chain.rowsBetween(W.unboundedPreceding, -1), chain.rowsBetween(1, W.unboundedFollowing)
    carried = ends.select("__g", "__b", *[F.last(f"__last{i}", True).over(before).alias(f"__before{i}") for i in range(len(cols))],
                          *[F.first(f"__first{i}", True).over(after).alias(f"__after{i}") for i in range(len(cols))])
    out = rows.select("*", *[F.last(c, True).over(back).alias(f"__fw{i}") for i, c in enumerate(cols)],
                      *[F.first(c, True).over(on).alias(f"__bw{i}") for i, c in enumerate(cols)])
    out = out.join(checked_broadcast(materialize(carried)), F.col("__b").eqNullSafe(F.col("__block")) & F.col("__g").eqNullSafe(F.col(group)))
    filled = {c: F.coalesce(f"__fw{i}", f"__before{i}", f"__bw{i}", f"__after{i}").alias(c) for i, c in enumerate(cols)}
    return out.select(*[filled.get(c, F.col(c)) for c in df.columns])


def with_time_index(df: DataFrame, group: str, order: str, name: str = "t", blocks: int | None = None) -> DataFrame:
    """``name`` = 0..n-1 along each group: the place in the block plus the
    rows of the group in earlier blocks."""
    rows = blocked(df, group, order, blocks)
    sizes = rows.groupBy(F.col(group).alias("__g"), F.col("__block").alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy("__g").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    starts = materialize(sizes.select("__g", "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")))
    place = F.row_number().over(W.partitionBy("__block", group).orderBy(order)) - 1
    out = rows.withColumn("__place", place).join(
        checked_broadcast(starts), F.col("__b").eqNullSafe(F.col("__block")) & F.col("__g").eqNullSafe(F.col(group)))
    return out.select(*df.columns, (F.col("__start") + F.col("__place")).alias(name))


def with_rolling(indexed: DataFrame, value: str, group: str, index: str = "t", rows: int = 7,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """W1 and W2 on rows with a time index: ``roll`` (mean of the last ``rows``
    values, this one included), ``roll_prev`` (of the ``rows`` before it) and
    ``next`` (the following row's value).

    A window holds ``block_rows`` rows of one group, and the ``rows`` before and
    the one behind them, which are copied in from the neighbours.
    """
    block = F.floor(F.col(index) / block_rows)
    at = F.col(index) % block_rows
    into = F.array_compact(F.array(block, F.when(at >= block_rows - rows, block + 1), F.when((at == 0) & (F.col(index) > 0), block - 1)))
    copies = indexed.withColumn("__own", block).withColumn("__blk", F.explode(into))
    w = W.partitionBy(group, "__blk").orderBy(index)
    out = copies.select("*", F.avg(value).over(w.rowsBetween(-(rows - 1), 0)).alias("roll"),
                        F.avg(value).over(w.rowsBetween(-rows, -1)).alias("roll_prev"), F.lead(value).over(w).alias("next"))
    return out.where(F.col("__own") == F.col("__blk")).drop("__own", "__blk")
