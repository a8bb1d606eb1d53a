"""Exact dedup by content sort (DataFrame functions only).

Texts are compared after deleting ASCII white space.  Sampled splitters
(``repartitionByRange``) deal the normalised texts out in order, every range is
sorted externally, equal texts then stand side by side, and the window operator
compares each whole text with its neighbour to find where a group ends.

Splitters are sampled in the driver, so they hold only the first ``HEAD`` code
points of a text; inside a range the whole text is the sort key.  A text (or a
head) with very many copies would fill one range.  The splitters therefore hold
a salt after the head: a group's copies form up to ``salts`` runs, each run
elects its keeper and its count, and a second, slim pass over one row per run
(text digest, keeper, count) settles the group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, fresh, staged, text_of

SALTS = 256
HEAD = 64


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 salts: int = SALTS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the one with the most code points stays, then the smallest
    id.  Null texts count as empty; all empty and all-blank texts form one
    group.  A null id sorts after all others.  Rows that repeat an id are rows
    of their own: of rows equal in length and id exactly one is ``kept``.
    Extra columns are not read.  An empty table gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"), F.regexp_replace(text_of(text_col), SPACE_CLASS + "+", "").alias("_norm"),
        F.length(text_of(text_col)).alias("_len"),
        F.pmod(F.xxhash64(F.col(id_col), F.length(text_of(text_col))), F.lit(salts)).cast("int").alias("_salt"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.withColumn("_head", F.substring("_norm", 1, HEAD)).repartitionByRange(parts, "_head", "_salt")
    order = [F.desc("_len"), F.asc_nulls_last("_id")]
    run = Window.partitionBy("_head", "_salt", "_norm")
    runs = staged(ranged.select(
        "_id", "_salt", "_len", F.sha2(F.col("_norm").cast("binary"), 256).alias("text_sha256"),
        F.row_number().over(run.orderBy(*order)).alias("_at"),
        F.count(F.lit(1)).over(run).alias("_run_size")), "content-sort")

    heads = runs.filter("_at = 1")
    group = Window.partitionBy("text_sha256")
    first = group.orderBy(*order, "_salt")
    settled = heads.select(
        F.col("text_sha256").alias("_sha"), F.col("_salt").alias("_s"),
        F.first("_id").over(first).alias("keep_id"),
        F.sum("_run_size").over(group).alias("group_size"),
        (F.row_number().over(first) == 1).alias("_wins"))
    return (runs.join(settled, (F.col("text_sha256") == F.col("_sha")) & (F.col("_salt") == F.col("_s")))
            .select(F.col("_id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"),
                    (F.col("_wins") & (F.col("_at") == 1)).alias("kept"), "text_sha256"))


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``content_sort`` keeps, all columns unchanged.

    Rows are found again by id, so ids must be unique here; rows with a null id
    cannot be found again and all stay.
    """
    key = fresh(docs, "_keep")
    kept = content_sort(docs, id_col, text_col).filter("kept").select(F.col(id_col).alias(key))
    found = docs.join(kept, F.col(id_col) == F.col(key), "left_semi")
    return found.unionByName(docs.filter(F.col(id_col).isNull()))
