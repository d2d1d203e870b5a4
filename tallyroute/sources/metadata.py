"""JSON documents that travel beside a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_document(document: DataFrame, path: str) -> None:
    """Write a one-row nested frame as a JSON document, nulls included, in place of an older one."""
    document.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """Read one JSON object; anything else at the top level is an error."""
    document = spark.read.json(path, multiLine=True)
    if "_corrupt_record" in document.columns or len(document.take(2)) != 1:
        raise ValueError(f"{path} must hold one JSON object")
    return document
