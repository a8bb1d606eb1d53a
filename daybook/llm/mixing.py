"""Mixing sources to target weights by Efraimidis-Spirakis sampling
(DataFrame functions only).

Every source gets a word target.  Its documents are taken in whole epochs
first; the rest of the target is filled by a weighted sample without
replacement: document i has the exponential key -ln(u_i) / w_i, with u_i from
a hash of its id and w_i its quality weight, and documents are taken by
ascending key until the running sum of their sizes reaches the rest.

The running sum needs no task that holds a whole source: rows are
range-partitioned by (source, key), each (source, range) block sums its own
rows, and the blocks' totals, one row each, give every block its start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NON_SPACE_RUN, fresh, staged, text_of, unit_hash

# The weights that sources take in turn, by code point, null last.
SOURCE_WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
# Quality weight: falls with the share of symbol characters, never below FLOOR.
SYMBOLS = "[!#$%&*]+"
SYMBOL_COST, FLOOR = 5.0, 0.05


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(NON_SPACE_RUN)).cast("long")


def quality_weight(text: Column) -> Column:
    """max(FLOOR, 1 - SYMBOL_COST * share of symbol characters), at most 1."""
    n = F.length(text)
    symbols = n - F.length(F.regexp_replace(text, SYMBOLS, ""))
    return F.greatest(F.lit(FLOOR), 1 - F.lit(SYMBOL_COST) * symbols / F.greatest(n, F.lit(1)))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = SOURCE_WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same with ``target``.

    Sources share the total size by weight, none above ``max_epochs`` times its
    own size; what a capped source leaves is shared again by weight.  The fixed
    point is a water level: in order of cap / weight, sources are capped until
    the level (rest of the total over rest of the weights) lies below the next.
    ``sizes`` holds one row per source.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    turn = F.row_number().over(by_name) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn % len(weights) + 1).cast("int"))
    capped = sizes.withColumn("_w", w).withColumn("_cap", (F.col("source_size") * max_epochs).cast("double"))
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), F.asc_nulls_last("source"))
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = capped.select(
        "source", "source_size", "_w", "_cap", F.row_number().over(fill).alias("_rank"),
        ((F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
         / F.sum("_w").over(after)).alias("_level"))
    is_open = F.col("_cap") / F.col("_w") > F.col("_level")
    water = F.min_by(F.when(is_open, F.col("_level")), F.when(is_open, F.col("_rank"))).over(whole)
    return level.select("source", "source_size",
                        F.when(is_open, F.least(F.col("_cap"), water * F.col("_w")))
                        .otherwise(F.col("_cap")).alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = SOURCE_WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken (words).

    A source's ``taken`` words add up to its target rounded to a whole word;
    the document on the border is taken in part.  Null and empty texts have
    size 0 and are taken 0 times; a null source is a source of its own, last in
    order.  Ties in the key go by id, then size.  Extra columns are not read.
    An empty table gives an empty result.
    """
    text = text_of(text_col)
    u = unit_hash(F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    keyed = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"),
                        word_count(text).alias("size"), (-F.log(u) / quality_weight(text)).alias("_key"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc("_key"), F.asc_nulls_last("_id"), F.asc("size")]
    sorted_ = staged(keyed.repartitionByRange(parts, F.asc_nulls_last("_source"), *order)
                     .withColumn("_block", F.spark_partition_id()), "mixing")

    totals = sorted_.groupBy("_source", "_block").agg(F.sum("size").alias("_sum"))
    by_block = Window.partitionBy("_source").orderBy("_block")
    starts = totals.select(
        F.col("_source").alias("_s"), F.col("_block").alias("_b"),
        F.coalesce(F.sum("_sum").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    targets = source_targets(
        totals.groupBy(F.col("_source").alias("source")).agg(F.sum("_sum").alias("source_size")), weights, max_epochs)
    # one row per block, few blocks per source: left to the planner to broadcast by bytes
    blocks = starts.join(targets, F.col("_s").eqNullSafe(F.col("source"))).drop("source")

    in_block = Window.partitionBy("_source", "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = sorted_.withColumn("_before", F.coalesce(F.sum("size").over(in_block), F.lit(0)))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor(F.col("target") - epochs * F.col("source_size") + 0.5)
    part = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("_start") - F.col("_before")))
    return (summed.join(blocks, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")))
            .select(F.col("_id").alias(id_col), "size", F.col("source_size").cast("long").alias("source_size"), "target",
                    (epochs * F.col("size") + part).cast("long").alias("taken")))


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[int, ...] = SOURCE_WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The rows of the mix, all columns unchanged: every document as often as
    the mix takes it.  Texts stay whole: the document on a source's border is
    taken once more if at least half its words are.  A text without words costs
    nothing and stays once.  Rows are found again by id (rows that repeat an id
    fare alike), and rows with a null id stay once.
    """
    mix = mix_sources(docs, id_col, text_col, source_col, weights, max_epochs)
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.floor(F.col("taken") / F.col("size") + 0.5)).cast("int")
    key, number, turn = (fresh(docs, x) for x in ("_id", "_times", "_turn"))
    taken = mix.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias(key)).agg(F.max(times).alias(number)).filter(F.col(number) > 0)
    rows = docs.join(taken, F.col(id_col) == F.col(key))
    again = rows.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(number))).alias(turn)).drop(turn)
    return again.unionByName(docs.filter(F.col(id_col).isNull()))
