"""Score CSV files as they arrive, with the same expressions as the batch job.

The work has no state: each row is checked, turned into features and scored by itself, so
there is no watermark and the file sink gives exactly-once output with its checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroute.operators.boosting import Boosted
from tallyroute.operators.model import LinearModel
from tallyroute.plans import student
from tallyroute.sources import csvfiles


def arriving_records(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """Text records of every CSV file that lands in ``folder``, with the file they came from."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    stream = spark.readStream.schema(text).options(**csvfiles.CELLS).option("header", True).csv(folder)
    return stream.withColumn("source_file", F.col("_metadata.file_path"))


def score_arrivals(
    spark: SparkSession, folder: str, out: str, checkpoint: str, fitted: LinearModel | Boosted, threshold: float
):
    """Start a query that scores what has arrived and stops; run it again for later files."""
    records = arriving_records(spark, folder, student.INPUTS)
    checked = student.check_records(records, keep=["source_file"])
    scored = student.score_records(checked, fitted, threshold, ["source_file"])
    return (
        scored.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
