"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


# Rows of links or labels that one task handles; the tables here are two or
# three numbers wide.
ROWS_PER_TASK = 200_000


def components(links: DataFrame, name: str, rounds: int | None = None) -> DataFrame:
    """(a, b) links -> (node, label): the smallest node each one can reach.

    Every round takes the smallest label among a node's neighbours (a map-side
    combined minimum, so a hub costs one row per task) and then its label's own
    label, so paths shorten by half; labels are written between rounds.  Nodes
    without links do not occur.  After ``rounds`` rounds (None: until nothing
    changes) a label is a node that is reached, if not yet the smallest one.
    """
    both = staged(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), name)
    tasks = both.count() // ROWS_PER_TASK + 1     # few links need few tasks, whatever the session's number
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m")).coalesce(tasks)
                    .select("node", F.least("node", "_m").alias("label")), name)
    both = both.coalesce(tasks)
    done = 0
    while done != rounds:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b").coalesce(tasks)
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_m")).coalesce(tasks))
        step = labels.join(near, "node").coalesce(tasks).select("node", F.least("label", "_m").alias("_to"), F.col("label").alias("_was"))
        jump = labels.select(F.col("node").alias("_to"), F.col("label").alias("_jump"))
        new = staged(step.join(jump, "_to").coalesce(tasks).select("node", F.least("_to", "_jump").alias("label"), "_was"), name)
        labels, done = new.select("node", "label"), done + 1
        if new.filter("label <> _was").isEmpty():
            break
    return labels
