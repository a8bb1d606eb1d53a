"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# The six ASCII white-space characters that word and copy rules share.
SPACE_CLASS = r"[\x20\x09-\x0D]"
NON_SPACE_RUN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; any path that Spark's own readers can open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh Parquet table below ``spark.checkpoint.dir`` and
    read it back.

    This cuts the lineage in the folder all executors share, computes the plan
    once, and lets later reads prune columns.  Hadoop removes the folder when
    the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/daybook-{name}-{uuid.uuid4().hex}"
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until ``docs`` has no such column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(col: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def crc_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds`` (a null id: "null")."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))) % folds


def unit_hash(col: Column) -> Column:
    """A uniform number in (0, 1) from the first 52 bits of an md5 digest; the
    same number in any engine that has md5."""
    return (F.conv(F.substring(F.md5(col), 1, 13), 16, 10).cast("double") + 0.5) / float(2 ** 52)


def hash_sample(df: DataFrame, id_col: str, share: float, salt: str = "") -> DataFrame:
    """Rows whose id hashes below ``share``; the same rows in every run."""
    return df.filter(unit_hash(F.concat(F.lit(salt), F.col(id_col).cast("string"))) < share)


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
           max_bytes: int = 4 << 20, max_rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one piece holds about ``max_bytes`` of text
    (one document at least), which bounds a task's memory whatever the lengths,
    and at most ``max_rows`` rows."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, base + max_bytes, "right"))
            stop = min(max(stop, start + 1), start + max_rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def space_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list]:
    """(doc index per word, word code per word, distinct words) of the texts'
    white-space words; null texts hold no words."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    words = pc.list_flatten(lists)
    doc = pc.list_parent_indices(lists).to_numpy(False).astype(np.int64)
    coded = words.dictionary_encode()
    code, kinds = coded.indices.to_numpy(False).astype(np.int64), coded.dictionary.to_pylist()
    if "" in kinds:                # what stands before or after white space at an end
        real = code != kinds.index("")
        doc, code = doc[real], code[real]
    return doc, code, kinds if len(code) else []


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, most: tuple[int, int],
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """(id, text, label) of a sample of the labelled rows outside the held-out
    fold, about ``most[y]`` rows of label y, and the number of labelled rows per
    label.

    The sample is drawn by id hash, so it is the same in every run, and its
    size, which does not grow with the tables, bounds the broadcast side of the
    join.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & (crc_fold(id_col, folds) != held))
    counts = {int(r[0]): int(r[1]) for r in known.groupBy(label).count().collect()}
    share = F.when(F.col(label) == 1, F.lit(most[1] / max(1, counts.get(1, 0)))).otherwise(F.lit(most[0] / max(1, counts.get(0, 0))))
    drawn = known.filter(unit_hash(F.concat(F.lit(label), F.col(id_col).cast("string"))) < share).select(
        F.col(id_col).alias("_id"), F.col(label).cast("int").alias("label"))
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.join(F.broadcast(drawn), F.col("id") == F.col("_id")).drop("_id"), counts


def scored(docs: DataFrame, score, fields: dict[str, str], id_col: str, text_col: str,
           max_bytes: int = 6 << 20) -> DataFrame:
    """Map ``score(texts: pa.Array) -> list of columns`` over the whole texts in
    bounded pieces; one row per input row with the id and the new columns."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = rows.select("id").schema
    for name, kind in fields.items():
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, max_bytes=max_bytes):
            found = score(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("id"), *map(pa.array, found)], names=schema.names)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
