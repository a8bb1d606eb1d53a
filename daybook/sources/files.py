"""File sources and sinks (S1-S8, S10-S16).  Every reader takes an explicit
schema (no inference); every writer goes through the DataFrame writer, so
paths can be any shared file system the cluster mounts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize


class MissingInputError(FileNotFoundError):
    """A required input is absent (the reference skipped such files
    silently, defect D13)."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on any file system that the session can read."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def require_inputs(spark: SparkSession, paths: list[str]) -> None:
    """Fail with a named error before any read."""
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise MissingInputError(f"missing inputs: {missing}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",",
             header: bool = True) -> DataFrame:
    """S1 (comma) / S2 (``sep=';'``) / S3 (``header=False`` with forced
    names in the schema).  Blank lines are skipped by the reader."""
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("mode", "PERMISSIVE").csv(path))


def read_short_header(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A header line naming fewer columns than the rows hold: skip it
    and force the schema's names (the header is not validated)."""
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", True)
            .csv(path))


def read_keyed_files(spark: SparkSession, pattern: str, schema: T.StructType | str,
                     key_regex: str, key: str = "key", sep: str = ",") -> DataFrame:
    """One glob read of many files; the key comes from each file's path
    (``_metadata.file_path``) by regex."""
    df = spark.read.schema(schema).option("header", True).option("sep", sep).csv(pattern)
    return df.select("*", F.regexp_extract(F.col("_metadata.file_path"), key_regex, 1).alias(key))


def parse_date(c: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """S7 (ISO) / S8 (``dd.MM.yyyy``): strict parse, null when it does not
    match."""
    return F.try_to_timestamp(c, F.lit(fmt)).cast("date")


def coerce_double(c: Column) -> Column:
    """Numeric cast that yields null instead of failing."""
    return c.try_cast("double")


# German month names, January first.
GERMAN_MONTHS = ["Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August",
                 "September", "Oktober", "November", "Dezember"]


def _word_date(text: Column, fallback_year: Column | None) -> Column:
    """``d. Monat [yyyy]`` to a date; a missing year takes ``fallback_year``."""
    m = F.regexp_extract(text, r"^(\d{1,2})\.\s*(\S+)(?:\s+(\d{4}))?$", 0)
    d = F.regexp_extract(text, r"^(\d{1,2})\.", 1).cast("int")
    name = F.regexp_extract(text, r"^\d{1,2}\.\s*(\S+)", 1)
    months = F.create_map(*[x for i, n in enumerate(GERMAN_MONTHS, 1) for x in (F.lit(n), F.lit(i))])
    mon = F.try_element_at(months, name)
    y = F.regexp_extract(text, r"(\d{4})$", 1)
    year = F.when(y != "", y.cast("int")).otherwise(fallback_year)
    iso = F.format_string("%04d-%02d-%02d", year, mon, d)
    return F.when((m != "") & mon.isNotNull() & year.isNotNull(),
                  F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date"))


class UnparsedSourceError(ValueError):
    """Lines of a source fit none of its formats."""


def read_sections_checked(spark: SparkSession, path: str) -> DataFrame:
    """The ranges of ``read_sectioned_markdown``, stored; one unparsed line
    raises ``UnparsedSourceError`` with the number of such lines and one of them.

    Both are observed while the ranges are written, so the source is read once.
    """
    entries = _section_entries(spark, path)
    seen = Observation(f"sections {uuid.uuid4().hex}")
    bad = F.col("start").isNull() | F.col("end").isNull()
    watched = entries.observe(seen, F.count(F.when(bad, 1)).alias("unparsed"), F.min(F.when(bad, F.col("line"))).alias("line"))
    ranges = materialize(watched.where(~bad).drop("line"))
    if seen.get["unparsed"]:
        raise UnparsedSourceError(f"{path}: {seen.get['unparsed']} lines, among them {seen.get['line']!r}")
    return ranges


def read_coerced(df: DataFrame, casts: dict[str, str]) -> tuple[DataFrame, dict[str, int]]:
    """Columns cast to the given types, what does not fit as null, stored;
    and how many values of each column were lost so, observed in the same job."""
    seen = Observation(f"casts {uuid.uuid4().hex}")
    out = df.select(*df.columns, *[F.col(c).try_cast(k).alias(f"__cast_{c}") for c, k in casts.items()])
    out = out.observe(seen, *[F.count(F.when(F.col(c).isNotNull() & F.col(f"__cast_{c}").isNull(), 1)).alias(c) for c in casts])
    stored = materialize(out.select(*[F.col(f"__cast_{c}").alias(c) if c in casts else F.col(c) for c in df.columns]))
    return stored, {c: int(seen.get[c]) for c in casts}


def read_sectioned_markdown(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``# ... yyyy`` year sections, ``## State`` (optionally ending in
    ``:``) subsections, ``- name: start - end`` entries in either
    ``dd.MM.yyyy`` or ``d. Monat [yyyy]`` form (a start without a year takes
    the end's year).

    Returns ``(ranges, unparsed)``: ranges ``(file, year, state, name,
    start, end)`` and the entry lines that matched neither format (the
    reference dropped those silently, defect D20; callers should fail when
    it is not empty).  Each file is read whole and split into numbered lines,
    so section headings carry forward by a window over the line number
    within the file (one file is one small partition).
    """
    out = _section_entries(spark, path)
    ok = F.col("start").isNotNull() & F.col("end").isNotNull()
    return out.where(ok).drop("line"), out.where(~ok).select("file", "line")


def _section_entries(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("wholetext", True).text(path).select(
        F.col("_metadata.file_path").alias("file"), "value")
    lines = raw.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("pos", "line"))
    w = W.partitionBy("file").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    year_h = F.when(F.col("line").rlike(r"^#\s"), F.regexp_extract("line", r"(\d{4})", 1).cast("int"))
    state_h = F.when(F.col("line").rlike(r"^##\s"),
                     F.trim(F.regexp_replace(F.regexp_extract("line", r"^##\s+(.+)$", 1), r":\s*$", "")))
    tagged = lines.select(
        "file", "pos", "line",
        F.last(year_h, ignorenulls=True).over(w).alias("year"),
        F.last(state_h, ignorenulls=True).over(w).alias("state"))
    entries = tagged.where(F.col("line").rlike(r"^\s*-\s"))
    body = F.regexp_extract("line", r"^\s*-\s*([^:]+):\s*(.+?)\s*$", 2)
    parts = F.split(body, r"\s+-\s+")
    a, b = F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))
    end_num = parse_date(b, "dd.MM.yyyy")
    start_num = parse_date(a, "dd.MM.yyyy")
    end_word = _word_date(b, None)
    end = F.coalesce(end_num, end_word)
    start = F.coalesce(start_num, _word_date(a, F.year(end)))
    return entries.select("file", "year", "state",
                          F.trim(F.regexp_extract("line", r"^\s*-\s*([^:]+):", 1)).alias("name"),
                          start.alias("start"), end.alias("end"), "line")


def write_table(df: DataFrame, path: str, fmt: str = "csv", sep: str = ",",
                partition_by: list[str] | None = None) -> None:
    """S12 (CSV / parquet) / S13 (JSON) / S14 (keyed submission): write with
    a header, overwrite."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("sep", sep).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.format(fmt).save(path)


def stats_report(df: DataFrame, section: str, keys: list[str] | None = None) -> DataFrame:
    """A statistics row (or rows per key) stacked as long
    ``(section, key, metric, value)`` rows, ready for a text / JSON sink."""
    keys = keys or []
    metrics = [c for c in df.columns if c not in keys]
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
    st = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                             for m in metrics]))
    return df.select(F.lit(section).alias("section"), key.alias("key"), st.alias("s")).select(
        "section", "key", "s.metric", "s.value")
