"""Row checks on text records made from the tables, and batch scoring of what passes."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixture_queries.base import MODEL, SCORE_SQL, query, table
from tallyroute.operators import model, validate
from tallyroute.operators.schema import cast_strict
from tallyroute.operators.validate import FieldRule
from tallyroute.session import materialize

ORDER_RULES = [
    FieldRule("o_custkey", "int", 100, 1200),
    FieldRule("o_totalprice", "float", 20000, 400000),
    FieldRule("o_orderstatus", "string", domain=("O", "F")),
    FieldRule("o_orderpriority", "string", domain=("1-urgent", "2-High", "3-medium", "5-low"), ignore_case=True),
]
ORDER_ERRORS_SQL = """concat_ws('; ',
  CASE WHEN o_custkey < 100 THEN 'o_custkey: Input should be greater than or equal to 100'
    WHEN o_custkey > 1200 THEN 'o_custkey: Input should be less than or equal to 1200' END,
  CASE WHEN o_totalprice < 20000 THEN 'o_totalprice: Input should be greater than or equal to 20000'
    WHEN o_totalprice > 400000 THEN 'o_totalprice: Input should be less than or equal to 400000' END,
  CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'o_orderstatus: Value error, o_orderstatus must be one of: O, F' END,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED'
    THEN 'o_orderpriority: Value error, o_orderpriority must be one of: 1-urgent, 2-High, 3-medium, 5-low' END)"""


def order_records(spark, sf):
    """orders as an upload would bring them: text, with a row index."""
    orders = table(spark, sf, "orders")
    return orders.select(
        F.col("o_orderkey").alias("row_index"),
        *[
            F.concat(F.lit(" "), F.col(r.name).cast("string"), F.lit("\t")).alias(r.name)
            for r in ORDER_RULES
        ],
    )


@query(
    "order_row_errors",
    f"SELECT o_orderkey AS row_index, nullif({ORDER_ERRORS_SQL}, '') AS error FROM orders",
)
def order_row_errors(spark, sf):
    return validate.check(order_records(spark, sf), ORDER_RULES).select("row_index", "error")


@query(
    "valid_and_rejected_counts",
    f"""SELECT count(*) FILTER (WHERE e = '') AS valid, count(*) FILTER (WHERE e <> '') AS rejected
FROM (SELECT {ORDER_ERRORS_SQL} AS e FROM orders)""",
)
def valid_and_rejected_counts(spark, sf):
    valid, rejected = validate.split_valid(validate.check(order_records(spark, sf), ORDER_RULES))
    tagged = valid.select(F.lit(1).alias("ok")).unionAll(rejected.select(F.lit(0).alias("ok")))
    return tagged.agg(F.count_if(F.col("ok") == 1).alias("valid"), F.count_if(F.col("ok") == 0).alias("rejected"))


@query(
    "event_value_errors",
    """SELECT event_id, CASE
  WHEN value <> floor(value) THEN 'value: Input should be a valid integer, got a number with a fractional part'
  WHEN value < 5 THEN 'value: Input should be greater than or equal to 5' END AS error FROM events""",
)
def event_value_errors(spark, sf):
    records = table(spark, sf, "events").select("event_id", F.col("value").cast("string").alias("value"))
    return validate.check(records, [FieldRule("value", "int", low=5)]).select("event_id", "error")


@query(
    "text_as_number_errors",
    """SELECT c_custkey,
  'c_mktsegment: Input should be a valid number, unable to parse string as a number; missing_field: Field required; c_name: Extra inputs are not permitted' AS error
FROM customer""",
)
def text_as_number_errors(spark, sf):
    records = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    rules = [FieldRule("c_mktsegment", "float"), FieldRule("missing_field", "int")]
    return validate.check(records, rules, extras=["c_name"]).select("c_custkey", "error")


@query(
    "event_coercion_errors",
    """SELECT event_id, CASE WHEN value <> floor(value) THEN 'Field ''value'' must be an integer'
  ELSE 'Field ''event_type'' must be numeric' END AS error FROM events""",
)
def event_coercion_errors(spark, sf):
    records = table(spark, sf, "events").select(
        "event_id", F.col("value").cast("string").alias("value"), "event_type"
    )
    rules = [FieldRule("value", "int"), FieldRule("event_type", "float")]
    return validate.coercion_errors(records, rules).select("event_id", "error")


@query(
    "record_field_errors",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F'
  THEN 'Missing required fields: f; Unexpected fields: ' || lower(o_orderstatus) END AS error FROM orders""",
)
def record_field_errors(spark, sf):
    record = F.create_map(
        F.lit("key"), F.col("o_orderkey").cast("string"), F.lower("o_orderstatus"), F.col("o_orderpriority")
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", validate.field_errors(record, ["key", "f"]).alias("error")
    )


@query(
    "event_property_errors",
    "SELECT event_id, 'Missing required fields: source; Unexpected fields: k' AS error FROM events",
)
def event_property_errors(spark, sf):
    record = F.from_json("props", "map<string,string>")
    return table(spark, sf, "events").select(
        "event_id", validate.field_errors(record, ["source"]).alias("error")
    )


LINE_RULES = [
    FieldRule("l_quantity", "float", 3, 45),
    FieldRule("l_discount", "float", 0, 0.09),
    FieldRule("l_tax", "float", 0, 1),
    FieldRule("l_linenumber", "int", 1, 6),
    FieldRule("l_returnflag", "string", domain=("A", "N", "R")),
]
LINE_ERRORS_SQL = """concat_ws('; ',
  CASE WHEN l_quantity < 3 THEN 'l_quantity: Input should be greater than or equal to 3'
    WHEN l_quantity > 45 THEN 'l_quantity: Input should be less than or equal to 45' END,
  CASE WHEN l_discount > CAST(0.09 AS DOUBLE) THEN 'l_discount: Input should be less than or equal to 0.09' END,
  CASE WHEN l_linenumber > 6 THEN 'l_linenumber: Input should be less than or equal to 6' END)"""
LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey"]
LINE_THRESHOLD = 0.55
BATCH_SQL = f"""batch AS (SELECT l_orderkey, l_partkey, l_suppkey, nullif({LINE_ERRORS_SQL}, '') AS error, {SCORE_SQL} AS p FROM lineitem),
results AS (SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN error IS NULL THEN round(p, 6) END AS probability,
  CASE WHEN error IS NULL THEN CAST(p >= {LINE_THRESHOLD} AS INTEGER) END AS prediction, error FROM batch)"""


def batch_results(spark, sf):
    """Every line checked as text, typed, scored, and masked where it was rejected."""
    names = [r.name for r in LINE_RULES]
    records = table(spark, sf, "lineitem").select(*LINE_KEY, *[F.col(n).cast("string").alias(n) for n in names])
    types = {"l_quantity": "double", "l_discount": "double", "l_tax": "double", "l_linenumber": "int"}
    typed = validate.check(records, LINE_RULES, types)
    return model.score_rows(typed, MODEL.probability(), LINE_THRESHOLD, LINE_KEY)


@query("batch_scores", f"WITH {BATCH_SQL} SELECT * FROM results")
def batch_scores(spark, sf):
    return batch_results(spark, sf)


@query(
    "batch_summary",
    f"""WITH {BATCH_SQL}, s AS (SELECT count(*) AS total, count(*) FILTER (WHERE error IS NULL) AS processed,
  count(*) FILTER (WHERE prediction = 1) AS placed FROM results)
SELECT total, processed, total - processed AS failed, placed AS placed_count, processed - placed AS not_placed_count,
  CASE WHEN processed = 0 THEN 0 ELSE round(CAST(placed AS DOUBLE) / processed, 6) END AS placement_rate FROM s""",
)
def batch_summary(spark, sf):
    return model.summarize_batch(batch_results(spark, sf))


@query(
    "successful_scores",
    f"WITH {BATCH_SQL} SELECT l_orderkey, l_partkey, probability, prediction FROM results WHERE error IS NULL",
)
def successful_scores(spark, sf):
    results = materialize(batch_results(spark, sf), "results")
    return validate.successful(results).select("l_orderkey", "l_partkey", "probability", "prediction")


@query("contract_violations", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS violations FROM lineitem")
def contract_violations(spark, sf):
    results = materialize(batch_results(spark, sf), "results")
    rows = results.agg(F.count("*").alias("rows"))
    broken = validate.contract_violations(results).agg(F.count("*").alias("violations"))
    return rows.withColumn("violations", broken.scalar())


@query(
    "merged_results",
    f"""SELECT o_orderkey AS row_index, CASE WHEN e = '' AND o_orderstatus = 'F' THEN CAST(0.75 AS DOUBLE) END AS probability,
  CASE WHEN e = '' AND o_orderstatus = 'F' THEN 1 END AS prediction,
  CASE WHEN e <> '' THEN e WHEN o_orderstatus <> 'F' THEN 'Unknown batch prediction failure' END AS error
FROM (SELECT *, {ORDER_ERRORS_SQL} AS e FROM orders)""",
)
def merged_results(spark, sf):
    checked = validate.check(order_records(spark, sf), ORDER_RULES)
    valid, rejected = validate.split_valid(checked)
    nothing = [F.lit(None).cast("double").alias("probability"), F.lit(None).cast("int").alias("prediction")]
    refused = rejected.select("row_index", *nothing, "error")
    # Only finished orders come back from scoring; the rest of the valid rows are gaps.
    scored = valid.filter(F.trim("o_orderstatus").startswith("F")).select(
        "row_index", F.lit(0.75).alias("probability"), F.lit(1).alias("prediction"), F.lit(None).cast("string").alias("error")
    )
    return validate.merge_results(valid.select("row_index").unionAll(rejected.select("row_index")), scored, refused)


@query("strict_cast", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def strict_cast(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    text = customer.select(*[F.col(c).cast("string").alias(c) for c in customer.columns])
    return cast_strict(text, customer.schema)
