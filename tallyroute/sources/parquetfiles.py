"""Parquet scans as views and as train / val / test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT_NAMES = ("train", "val", "test")


def open_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Register a Parquet folder under ``name`` for SQL and return it."""
    table = spark.read.parquet(path)
    table.createOrReplaceTempView(name)
    return table


def load_splits(
    spark: SparkSession, path: str, features: Sequence[str], target: str
) -> dict[str, DataFrame]:
    """The three splits of one table partitioned by ``split``; each reads only its own folder."""
    table = spark.read.parquet(path)
    return {
        name: table.filter(F.col("split") == name).select(*[F.col(f"`{c}`") for c in features], target)
        for name in SPLIT_NAMES
    }
