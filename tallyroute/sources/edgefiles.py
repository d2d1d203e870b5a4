"""Edge lists with three weights per edge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroute.functions.text import strip_space
from tallyroute.operators.ordering import file_position

DIRECTED_COLUMNS = ("Node From", "Node To", "D", "T", "F")
UNDIRECTED_COLUMNS = ("From Node", "To Node", "Distance (km)", "Time (mins)", "Fuel (Liters)")


def _read(spark: SparkSession, path: str, columns, metrics, as_node) -> DataFrame:
    # The CSV reader drops a UTF-8 byte order mark.
    raw = spark.read.csv(path, header=True, inferSchema=False)
    src, dst, *weights = [F.col(f"`{c}`") for c in columns]
    return raw.select(
        as_node(src).alias("src"),
        as_node(dst).alias("dst"),
        *[strip_space(w).cast("double").alias(m) for w, m in zip(weights, metrics)],
        file_position().alias("row"),
    )


def read_directed_edges(spark: SparkSession, path: str) -> DataFrame:
    """src int, dst int, D, T, F double, row (place in the file)."""
    return _read(
        spark, path, DIRECTED_COLUMNS, ("D", "T", "F"), lambda c: strip_space(c).cast("int")
    )


def read_undirected_edges(spark: SparkSession, path: str) -> DataFrame:
    """src string, dst string, distance, time, fuel double, row (place in the file)."""
    return _read(spark, path, UNDIRECTED_COLUMNS, ("distance", "time", "fuel"), strip_space)
