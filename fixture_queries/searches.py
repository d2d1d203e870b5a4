"""Search, paging, sorting and ranking over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixture_queries.base import query, table
from tallyroute.operators import ordering, search
from tallyroute.operators.search import SearchSpec

CUSTOMERS = SearchSpec(
    key=["c_custkey"],
    text="u%d",
    text_columns=["c_mktsegment", "c_name"],
    ranges={"c_acctbal": (0.0, 9000.0), "c_nationkey": (0, 20)},
    sort_by="c_acctbal",
    descending=True,
    page=2,
    limit=25,
)
WHERE_SQL = """(c_mktsegment ILIKE '%u%d%' OR c_name ILIKE '%u%d%')
  AND c_acctbal >= 0 AND c_acctbal <= 9000 AND c_nationkey >= 0 AND c_nationkey <= 20"""


@query(
    "customer_search_page",
    f"""SELECT * FROM customer WHERE {WHERE_SQL}
ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 25 OFFSET 25""",
)
def customer_search_page(spark, sf):
    return search.page(table(spark, sf, "customer"), CUSTOMERS)


@query(
    "customer_search_totals",
    f"""SELECT count(*) AS total, 2 AS page, 25 AS "limit", CAST(ceil(count(*) / 25.0) AS BIGINT) AS total_pages
FROM customer WHERE {WHERE_SQL}""",
)
def customer_search_totals(spark, sf):
    return search.totals(table(spark, sf, "customer"), CUSTOMERS)


@query(
    "customer_status_page",
    """SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'
ORDER BY c_name ASC NULLS LAST, c_custkey LIMIT 10""",
)
def customer_status_page(spark, sf):
    spec = SearchSpec(
        key=["c_custkey"], text="", text_columns=["c_name"], equals={"c_mktsegment": "BUILDING"},
        sort_by="c_name", columns=["c_custkey", "c_name", "c_mktsegment"],
    )
    return search.page(table(spark, sf, "customer"), spec)


@query(
    "orders_page_after",
    """SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice < 250000 OR (o_totalprice = 250000 AND o_orderkey > 0)
ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""",
)
def orders_page_after(spark, sf):
    spec = SearchSpec(
        key=["o_orderkey"], sort_by="o_totalprice", descending=True, limit=20, columns=["o_orderkey", "o_totalprice"]
    )
    return search.page_after(table(spark, sf, "orders"), spec, {"o_totalprice": 250000.0, "o_orderkey": 0})


@query(
    "orders_deep_page",
    """SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice ASC NULLS LAST, o_orderkey LIMIT 50 OFFSET 13950""",
)
def orders_deep_page(spark, sf):
    spec = SearchSpec(
        key=["o_orderkey"], sort_by="o_totalprice", page=280, limit=50, columns=["o_orderkey", "o_totalprice"], deep=True
    )
    return search.page(table(spark, sf, "orders"), spec)


@query(
    "page_top_scores",
    """SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM (
  SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 50 OFFSET 100)
QUALIFY rank <= 10""",
)
def page_top_scores(spark, sf):
    spec = SearchSpec(
        key=["o_orderkey"], equals={"o_orderstatus": "F"}, page=3, limit=50, columns=["o_orderkey", "o_totalprice"]
    )
    view = search.page(table(spark, sf, "orders"), spec)
    return ordering.first_ranked(view, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query(
    "parts_sorted_by_name",
    """SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_name DESC, p_partkey) AS position FROM part""",
)
def parts_sorted_by_name(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    ordered = ordering.sort_records(parts, "p_name", descending=True, tie=["p_partkey"])
    return ordering.with_position(ordered)


@query(
    "orders_sorted_by_key_text",
    """SELECT CAST(o_orderkey AS VARCHAR) AS "ID", o_orderpriority,
  row_number() OVER (ORDER BY o_orderkey) AS position FROM orders""",
)
def orders_sorted_by_key_text(spark, sf):
    records = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("ID"), "o_orderpriority")
    return ordering.with_position(ordering.sort_records(records, "ID", tie=["o_orderpriority"]))


@query(
    "quantities_descending",
    """SELECT CAST(l_quantity AS BIGINT) AS value,
  row_number() OVER (ORDER BY l_quantity DESC) AS position FROM lineitem""",
)
def quantities_descending(spark, sf):
    values = table(spark, sf, "lineitem").select(F.col("l_quantity").cast("long").alias("value"))
    return ordering.with_position(ordering.sorted_evenly(values, [F.desc("value")]))


@query(
    "top_orders_by_price",
    """SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank
FROM orders QUALIFY rank <= 10""",
)
def top_orders_by_price(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ordering.first_ranked(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query(
    "quantity_summary",
    """SELECT count(l_quantity) AS count, min(l_quantity) AS min, max(l_quantity) AS max,
  round(avg(l_quantity), 2) AS average, sum(l_quantity) AS sum FROM lineitem""",
)
def quantity_summary(spark, sf):
    return ordering.list_summary(table(spark, sf, "lineitem"), "l_quantity")
