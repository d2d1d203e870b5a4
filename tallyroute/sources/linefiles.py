"""Files with one integer per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroute.functions.text import strip_space


def read_integers(spark: SparkSession, path: str) -> DataFrame:
    """Column ``value``; blank lines are skipped, a line that is no integer fails the job."""
    line = strip_space(F.col("value"))
    return spark.read.text(path).filter(line != "").select(line.cast("long").alias("value"))
