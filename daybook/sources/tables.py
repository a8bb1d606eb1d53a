"""Typed access to the parquet tables of a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return f"{sf_dir}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Read one table; selecting ``columns`` right away keeps the scan's
    ReadSchema to what the caller uses (Catalyst would prune anyway, this
    just makes the intent explicit)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
