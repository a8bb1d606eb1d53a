"""Do two tables hold the same rows (A33, U3)?  Without a join of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fingerprints(df: DataFrame, cols: list[str], part: Column) -> DataFrame:
    """``(part, rows, hash_sum, hash_xor)``: count, sum and xor of the rows'
    64-bit hashes per key range.

    Neither depends on the order of rows, and a row that comes twice changes the
    count and the sum.  Tables that differ in a range agree in all three by
    chance only (about 1 in 2^64).  Doubles -0.0 and 0.0 count as equal.
    """
    h = F.xxhash64(*[F.when(F.col(c) == 0, F.lit(0).cast(k)).otherwise(F.col(c)) if k in ("double", "float") else F.col(c)
                     for c, k in [(c, dict(df.dtypes)[c]) for c in cols]])
    return df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("hash_sum"),
                                              F.bit_xor(h).alias("hash_xor"))


def differing_ranges(a: DataFrame, b: DataFrame, cols: list[str], part: Column) -> DataFrame:
    """``(part, rows_a, rows_b)`` of the key ranges in which two tables do not
    hold the same rows; empty when they are equal as multisets."""
    fa, fb = (fingerprints(x, cols, part).select(F.struct("part").alias(f"k{n}"), F.struct("rows", "hash_sum", "hash_xor").alias(n))
              for x, n in ((a, "a"), (b, "b")))
    both = fa.join(fb, fa.ka == fb.kb, "full")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select(
        F.coalesce("ka", "kb")["part"].alias("part"), F.coalesce("a.rows", F.lit(0)).alias("rows_a"), F.coalesce("b.rows", F.lit(0)).alias("rows_b"))
