"""Feature expressions and label codes over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixture_queries.base import lineitem_records, query, table
from tallyroute.functions import labels
from tallyroute.operators import features, schema
from tallyroute.operators.schema import col

LINE_FEATURES = {
    "avg_size": lambda: features.mean_of(["l_quantity", "l_linenumber", "l_extendedprice"]),
    "key_sum": lambda: features.sum_of(["l_linenumber", "l_partkey", "l_suppkey"]),
    "price_gap": lambda: features.difference("l_extendedprice", "l_quantity"),
    "scaled": lambda: features.scaled_mean({"l_quantity": 50, "l_extendedprice": 100000, "l_linenumber": 7}),
    "first_line": lambda: features.flag(col("l_linenumber") == 1),
    "bulk": lambda: features.flag(col("l_quantity") >= 25.0),
    "discounted": lambda: features.flag(col("l_discount") > 0),
    "pricey": lambda: features.flag(col("l_extendedprice") > 50000),
    "quantity_per_line": lambda: features.ratio_floor("l_quantity", "l_linenumber", offset=3, floor=1),
}
FLOATS = ("avg_size", "price_gap", "scaled", "quantity_per_line")
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_FEATURES_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round(CAST(CAST((l_quantity + l_linenumber + l_extendedprice) / 3.0 AS FLOAT) AS DOUBLE), 3) AS avg_size,
  CAST(l_linenumber + l_partkey + l_suppkey AS INTEGER) AS key_sum,
  round(CAST(CAST(l_extendedprice - l_quantity AS FLOAT) AS DOUBLE), 3) AS price_gap,
  round(CAST(CAST((l_quantity / 50 + l_extendedprice / 100000 + CAST(l_linenumber AS DOUBLE) / 7) / 3 AS FLOAT) AS DOUBLE), 3) AS scaled,
  CAST(l_linenumber = 1 AS INTEGER) AS first_line, CAST(l_quantity >= 25 AS INTEGER) AS bulk,
  CAST(l_discount > 0 AS INTEGER) AS discounted, CAST(l_extendedprice > 50000 AS INTEGER) AS pricey,
  round(CAST(CAST(l_quantity / greatest(l_linenumber - 3, 1) AS FLOAT) AS DOUBLE), 3) AS quantity_per_line
FROM lineitem"""


@query("engineered_features", LINE_FEATURES_SQL)
def engineered_features(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "*", *[make().alias(name) for name, make in LINE_FEATURES.items()]
    )
    return lines.select(
        *LINE_KEY,
        *[
            F.round(F.col(n).cast("double"), 3).alias(n) if n in FLOATS else F.col(n)
            for n in LINE_FEATURES
        ],
    )


SEGMENT_CODES = {"AUTO": 0, "BUILDING": 1, "MACHINERY": 2, "OTHER": 3}


@query(
    "encoded_segments",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2
  ELSE 3 END AS segment_code FROM customer""",
)
def encoded_segments(spark, sf):
    padded = F.concat(F.lit(" \t"), F.lower("c_mktsegment"), F.lit(" \n")).alias("c_mktsegment")
    customer = table(spark, sf, "customer").select("c_custkey", padded)
    code = features.encoded("c_mktsegment", SEGMENT_CODES, {"AUTOMOBILE": "AUTO"}, "OTHER")
    return customer.withColumn("segment_code", code).drop("c_mktsegment")


@query(
    "encoded_status",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS status_code FROM orders",
)
def encoded_status(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    code = features.encoded("o_orderstatus", {"O": 0, "F": 1, "P": 2})
    return orders.withColumn("status_code", code).drop("o_orderstatus")


@query(
    "canonical_priority",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '1-Urgent' WHEN '2-HIGH' THEN '2-High' END AS priority
FROM orders""",
)
def canonical_priority(spark, sf):
    priority = labels.canonical(F.col("o_orderpriority"), ["1-Urgent", "2-High"])
    return table(spark, sf, "orders").select("o_orderkey", priority.alias("priority"))


@query(
    "ordered_feature_matrix",
    "SELECT l_tax + 0.0 AS l_tax, l_quantity, l_linenumber FROM lineitem",
)
def ordered_feature_matrix(spark, sf):
    named = lineitem_records(spark, sf).select("l_linenumber", "l_quantity", F.col("l_tax").alias("tax"))
    renamed = schema.rename_aliases(named, {"tax": "l_tax"})
    ordered = schema.fitted(renamed, ["l_tax", "l_quantity", "l_linenumber"], exact=True)
    return ordered.withColumn("l_tax", F.col("l_tax") + 0.0)
