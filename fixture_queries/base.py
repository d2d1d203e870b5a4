"""Registry and the derived tables that several queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroute.operators.model import LinearModel

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say the same, its SQL."""

    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lineitem_records(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with a 0/1 target, for the statistics that need one."""
    return table(spark, sf, "lineitem").withColumn("placed", (F.col("l_returnflag") == "R").cast("int"))


LINEITEM_SQL = """lineitem_records AS (
  SELECT *, CAST(l_returnflag = 'R' AS INTEGER) AS placed FROM lineitem
)"""

# A fixed logistic model over lineitem, so that scores do not depend on a fit.
MODEL = LinearModel(
    intercept=-0.9,
    weights={"l_quantity": 0.04, "l_discount": -4.0, "l_tax": 3.0},
    means={"l_quantity": 25.5, "l_discount": 0.05, "l_tax": 0.04},
)
ODDS_SQL = "(CAST(-0.9 AS DOUBLE) + CAST(0.04 AS DOUBLE) * l_quantity + CAST(-4.0 AS DOUBLE) * l_discount + CAST(3.0 AS DOUBLE) * l_tax)"
SCORE_SQL = f"(CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + exp(-{ODDS_SQL})))"
THRESHOLD = 0.5


def scored_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """label, score: scores rounded to six places so that both engines compare the same numbers."""
    return lineitem_records(spark, sf).select(
        F.col("placed").alias("label"), F.round(MODEL.probability(), 6).alias("score")
    )


def raw_scored_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """label, score: as many scores as prices, unrounded; one division gives the same double in both engines."""
    price = F.col("l_extendedprice").cast("double")
    return lineitem_records(spark, sf).select(F.col("placed").alias("label"), (price / (price + F.lit(25000.0))).alias("score"))


RAW_SCORED_SQL = """scored AS (
  SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label,
    CAST(l_extendedprice AS DOUBLE) / (CAST(l_extendedprice AS DOUBLE) + CAST(25000.0 AS DOUBLE)) AS score FROM lineitem
)"""

SCORED_SQL = f"""scored AS (
  SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, round({SCORE_SQL}, 6) AS score FROM lineitem
)"""
