"""Statistics over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixture_queries.base import LINEITEM_SQL, lineitem_records, query, table
from tallyroute.operators import profile, schema

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
EXPECTED_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_clerk", "o_totalprice", "o_comment"]


@query(
    "overview_kpis",
    f"""WITH {LINEITEM_SQL}
SELECT count(*) AS total, round(avg(placed), 6) AS placement_rate,
  round(avg(l_quantity), 4) AS avg_l_quantity, round(avg(l_discount), 4) AS avg_l_discount
FROM lineitem_records""",
)
def overview_kpis(spark, sf):
    return profile.overview(lineitem_records(spark, sf), "placed", ["l_quantity", "l_discount"])


@query(
    "target_counts",
    f"""WITH {LINEITEM_SQL}
SELECT count(*) AS row_count, CAST(sum(placed) AS BIGINT) AS placed,
  CAST(count(*) - sum(placed) AS BIGINT) AS not_placed FROM lineitem_records""",
)
def target_counts(spark, sf):
    return profile.target_counts(lineitem_records(spark, sf), "placed")


@query(
    "class_balance",
    f"""WITH {LINEITEM_SQL}
SELECT CAST(sum(placed) AS BIGINT) AS placed, count(*) FILTER (WHERE placed = 0) AS not_placed,
  count(*) AS total FROM lineitem_records""",
)
def class_balance(spark, sf):
    return profile.class_balance(lineitem_records(spark, sf), "placed")


@query(
    "segment_distribution",
    """SELECT coalesce(c_mktsegment, 'Unknown') AS label, count(*) AS count
FROM customer GROUP BY c_mktsegment ORDER BY 2 DESC, 1""",
)
def segment_distribution(spark, sf):
    return profile.distribution(table(spark, sf, "customer"), "c_mktsegment")


@query(
    "quality_distribution",
    """SELECT coalesce(CAST(quality AS VARCHAR), 'Unknown') AS label, count(*) AS count
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality ORDER BY 2 DESC, 1""",
)
def quality_distribution(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id")
    judged = documents.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return profile.distribution(judged, "quality")


@query(
    "priority_distribution",
    """SELECT coalesce(o_orderpriority, 'Unknown') AS label, count(*) AS count
FROM orders GROUP BY o_orderpriority ORDER BY 2 DESC, 1""",
)
def priority_distribution(spark, sf):
    return profile.distribution(table(spark, sf, "orders"), "o_orderpriority")


@query(
    "status_percent",
    """SELECT o_orderstatus AS label, count(*) AS count,
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM orders) * 100, 2) AS percent
FROM orders GROUP BY o_orderstatus""",
)
def status_percent(spark, sf):
    return profile.distribution_percent(table(spark, sf, "orders"), "o_orderstatus")


def _correlation_sql(columns: list[str]) -> str:
    cells = [
        f"SELECT '{x}' AS column_x, '{y}' AS column_y, "
        + ("CAST(1.0 AS DOUBLE)" if x == y else f"round(corr({x}, {y}), 6)")
        + " AS correlation FROM lineitem_records"
        + (" LIMIT 1" if x == y else "")
        for x in columns
        for y in columns
    ]
    return f"WITH {LINEITEM_SQL} " + " UNION ALL ".join(f"({c})" for c in cells)


@query("correlation_matrix", _correlation_sql([*MEASURES, "placed"]))
def correlation_matrix(spark, sf):
    return profile.correlation_matrix(lineitem_records(spark, sf), [*MEASURES, "absent_column", "placed"])


def _stats_sql(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        f"round(CAST(min({c}) AS DOUBLE), 4) AS min, round(CAST(max({c}) AS DOUBLE), 4) AS max FROM {source}"
        for c in columns
    )


NUMERIC_LINEITEM = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
]


@query("column_stats", _stats_sql(NUMERIC_LINEITEM, "lineitem"))
def column_stats(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    return profile.column_stats(lineitem, schema.numeric_columns(lineitem, exclude=["l_discount", "l_tax"]))


@query(
    "field_ranges",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high FROM orders"
        for c in ("o_orderkey", "o_custkey", "o_totalprice")
    ),
)
def field_ranges(spark, sf):
    orders = table(spark, sf, "orders")
    return profile.field_ranges(orders, schema.numeric_columns(orders))


@query(
    "price_quantity_fit",
    """SELECT count(*) AS n, round(stddev_samp(l_quantity), 6) AS std_x,
  round(stddev_samp(l_extendedprice), 6) AS std_y,
  round(corr(l_extendedprice, l_quantity), 6) AS correlation,
  round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
  round(regr_r2(l_extendedprice, l_quantity), 6) AS r2
FROM lineitem WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL""",
)
def price_quantity_fit(spark, sf):
    return profile.linear_fit(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")


PROFILE_HEATMAP = ["l_quantity", "l_extendedprice", "placed"]
PROFILE_EXPECTED = ["l_orderkey", "l_quantity", "l_clerk"]
LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "placed",
]


def _profile_sql() -> str:
    parts = [
        "SELECT 'shape' AS section, 'row_count' AS item, '' AS detail, CAST(count(*) AS DOUBLE) AS value FROM lineitem_records",
        f"SELECT 'shape', 'column_count', '', CAST({len(LINEITEM_COLUMNS)} AS DOUBLE)",
        f"SELECT 'shape', 'expected_column_count', '', CAST({len(PROFILE_EXPECTED)} AS DOUBLE)",
        "SELECT 'missing_columns', 'l_clerk', '', CAST(0 AS DOUBLE)",
        "SELECT 'target', 'placed', '', CAST(sum(placed) AS DOUBLE) FROM lineitem_records",
        "SELECT 'target', 'not_placed', '', CAST(count(*) - sum(placed) AS DOUBLE) FROM lineitem_records",
    ]
    extra = [c for c in LINEITEM_COLUMNS if c not in PROFILE_EXPECTED]
    parts += [f"SELECT 'extra_columns', '{c}', '', CAST({i} AS DOUBLE)" for i, c in enumerate(extra)]
    for x in PROFILE_HEATMAP:
        for y in PROFILE_HEATMAP:
            value = "CAST(1.0 AS DOUBLE)" if x == y else f"(SELECT round(corr({x}, {y}), 6) FROM lineitem_records)"
            parts.append(f"SELECT 'correlation', '{x}', '{y}', {value}")
    for c in ("l_returnflag", "l_linestatus"):
        parts.append(
            f"SELECT 'distribution', '{c}', {c}, CAST(count(*) AS DOUBLE) FROM lineitem_records GROUP BY {c}"
        )
    return f"WITH {LINEITEM_SQL} " + " UNION ALL ".join(parts)


@query("dataset_profile", _profile_sql())
def dataset_profile(spark, sf):
    return profile.dataset_profile(
        lineitem_records(spark, sf), "placed", PROFILE_EXPECTED, ["l_returnflag", "l_linestatus"], PROFILE_HEATMAP
    )


@query(
    "describe_orders",
    """SELECT CAST(column_index - 1 AS INTEGER) AS position, column_name,
  CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
    ELSE 'timestamp' END AS column_type
FROM duckdb_columns() WHERE table_name = 'orders'""",
)
def describe_orders(spark, sf):
    described = schema.describe(table(spark, sf, "orders"))
    return described.withColumn(
        "column_type", F.regexp_replace("column_type", "^timestamp_ntz$", "timestamp")
    )


@query(
    "column_report",
    f"""WITH expected AS (SELECT unnest([{', '.join(f"'{c}'" for c in EXPECTED_ORDERS)}]) AS column_name,
    unnest(range({len(EXPECTED_ORDERS)})) AS position),
  actual AS (SELECT column_name, column_index - 1 AS position FROM duckdb_columns() WHERE table_name = 'orders')
SELECT 'missing' AS status, CAST(position AS INTEGER) AS position, column_name FROM expected
  WHERE column_name NOT IN (SELECT column_name FROM actual)
UNION ALL SELECT 'extra', CAST(position AS INTEGER), column_name FROM actual
  WHERE column_name NOT IN (SELECT column_name FROM expected)""",
)
def column_report(spark, sf):
    return schema.column_report(table(spark, sf, "orders"), EXPECTED_ORDERS)


@query(
    "column_difference",
    "SELECT 'o_clerk,o_comment' AS only_left, 'o_orderdate,o_orderpriority' AS only_right",
)
def column_difference(spark, sf):
    names = schema.column_difference(spark, EXPECTED_ORDERS, table(spark, sf, "orders").columns)
    return names.select(*[F.array_join(c, ",").alias(c) for c in names.columns])


@query(
    "kpi_cards",
    f"""WITH {LINEITEM_SQL}, o AS (SELECT count(*) AS n, avg(placed) AS r, avg(l_quantity) AS q FROM lineitem_records)
SELECT 'Total' AS label, format('{{:,}}', n) AS value FROM o
UNION ALL SELECT 'Placement Rate', printf('%.2f%%', round(r, 6) * 100) FROM o
UNION ALL SELECT 'Avg Quantity', printf('%.2f', round(q, 4)) FROM o""",
)
def kpi_cards(spark, sf):
    row = profile.overview(lineitem_records(spark, sf), "placed", ["l_quantity"])
    return profile.kpi_cards(row, "total", "placement_rate", {"Avg Quantity": "avg_l_quantity"})


@query(
    "narrative_insights",
    f"""WITH {LINEITEM_SQL}, o AS (
  SELECT count(*) AS n, round(avg(placed), 4) AS rate, round(corr(l_quantity, l_extendedprice), 4) AS r
  FROM lineitem_records)
SELECT 'target' AS topic, CASE WHEN rate >= 0.5 THEN 'At least half' ELSE 'Fewer than half' END
  || ' of the rows have placed set (' || printf('%.2f%%', rate * 100) || ').' AS text FROM o
UNION ALL SELECT 'relation', 'l_quantity and l_extendedprice show a '
  || CASE WHEN abs(r) >= 0.7 THEN 'strong' WHEN abs(r) >= 0.3 THEN 'moderate' WHEN abs(r) >= 0.1 THEN 'weak'
     ELSE 'no clear' END
  || CASE WHEN abs(r) < 0.1 THEN '' WHEN r > 0 THEN ' positive' ELSE ' negative' END
  || ' relation (r = ' || printf('%.4f', r) || ').' FROM o
UNION ALL SELECT 'size', 'The table holds ' || format('{{:,}}', n) || ' rows.' FROM o""",
)
def narrative_insights(spark, sf):
    return profile.insights(lineitem_records(spark, sf), "l_quantity", "l_extendedprice", "placed")


@query(
    "unlike_head_correlation",
    """WITH v AS (SELECT CASE WHEN l_orderkey < 500 THEN 0 ELSE 1000000000 + l_quantity END AS a,
  CASE WHEN l_orderkey < 500 THEN 0 ELSE 1000000000 - 2 * l_quantity + l_linenumber END AS b,
  CASE WHEN l_orderkey >= 500 THEN 1000000000 + l_quantity + l_linenumber END AS c FROM lineitem)
SELECT round(corr(a, b), 6) AS a_b, round(corr(b - 1000000000, c - 1000000000), 6) AS b_c FROM v""",
)
def unlike_head_correlation(spark, sf):
    """Rows sorted so that the first ones are unlike the rest, whose values are large beside their spread."""
    lines, head, base = table(spark, sf, "lineitem"), F.col("l_orderkey") < 500, F.lit(1e9)
    values = lines.select(
        "l_orderkey",
        F.when(head, F.lit(0.0)).otherwise(base + F.col("l_quantity")).alias("a"),
        F.when(head, F.lit(0.0)).otherwise(base - 2 * F.col("l_quantity") + F.col("l_linenumber")).alias("b"),
        F.when(~head, base + F.col("l_quantity") + F.col("l_linenumber")).alias("c"),
    )
    found = profile.correlation_matrix(values.orderBy("l_orderkey"), ["a", "b", "c"])
    pick = lambda x, y: F.max(F.when((F.col("column_x") == x) & (F.col("column_y") == y), F.col("correlation")))
    return found.agg(pick("a", "b").alias("a_b"), pick("b", "c").alias("b_c"))
