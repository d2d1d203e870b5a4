"""Reproducible shuffles and exact splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixture_queries.base import query, table
from tallyroute.operators import ordering, split


@query(
    "exact_split",
    """WITH ranked AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:' || o_orderkey)) AS r, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN r <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
  WHEN r <= floor(n * CAST(0.7 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split
FROM ranked""",
)
def exact_split(spark, sf):
    orders = table(spark, sf, "orders")
    return split.exact_split(orders, ["o_orderkey"]).select("o_orderkey", "split")


@query(
    "split_sizes_repeated_keys",
    """WITH c AS (SELECT count(*) AS n FROM lineitem), s AS (
  SELECT n, CAST(floor(n * CAST(0.7 AS DOUBLE)) AS BIGINT) AS a, CAST(floor(n * CAST(0.15 AS DOUBLE)) AS BIGINT) AS b FROM c)
SELECT 'train' AS split, a AS rows FROM s UNION ALL SELECT 'val', b FROM s UNION ALL SELECT 'test', n - a - b FROM s""",
)
def split_sizes_repeated_keys(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_linenumber", "l_quantity")
    return split.split_sizes(split.exact_split(lines, ["l_returnflag"]))


@query(
    "split_of_rows_that_read_alike",
    """WITH t AS (SELECT 'a' || chr(1) AS k, 'b' AS v FROM orders UNION ALL SELECT 'a', chr(1) || 'b' FROM orders),
s AS (SELECT count(*) AS n, CAST(floor(count(*) * CAST(0.7 AS DOUBLE)) AS BIGINT) AS a, CAST(floor(count(*) * CAST(0.15 AS DOUBLE)) AS BIGINT) AS b FROM t)
SELECT 'cells' AS part, md5(k) || md5(v) AS what, count(*) AS rows FROM t GROUP BY k, v
UNION ALL SELECT 'split', 'train', a FROM s UNION ALL SELECT 'split', 'val', b FROM s UNION ALL SELECT 'split', 'test', n - a - b FROM s""",
)
def split_of_rows_that_read_alike(spark, sf):
    """Two kinds of rows whose cells give one text when joined: all come back, cell by cell."""
    orders = table(spark, sf, "orders")
    both = orders.select(F.lit("a\u0001").alias("k"), F.lit("b").alias("v")).unionAll(orders.select(F.lit("a"), F.lit("\u0001b")))
    done = split.exact_split(both, ["k", "v"])
    cells = done.groupBy("k", "v").agg(F.count("*").alias("rows"))
    cells = cells.select(F.lit("cells").alias("part"), F.concat(F.md5("k"), F.md5("v")).alias("what"), "rows")
    return cells.unionAll(split.split_sizes(done).select(F.lit("split"), "split", "rows"))


@query(
    "seeded_shuffle",
    "SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:' || o_orderkey)) AS position FROM orders",
)
def seeded_shuffle(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return ordering.with_position(split.shuffle_rows(orders, ["o_orderkey"]))
