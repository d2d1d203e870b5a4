"""Sources and sinks: tables are written to a new shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixture_queries.base import LINEITEM_SQL, lineitem_records, query, table
from fixture_queries.graphs import TRADE_SQL, trade_edges
from tallyroute.functions import labels, numeric
from tallyroute.operators import ordering, profile, schema, split
from tallyroute.session import scratch_path
from tallyroute.sources import csvfiles, edgefiles, linefiles, metadata, parquetfiles


def _as_csv(df, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.option("header", True).csv(path)
    return path


@query("csv_strict_scan", "SELECT * FROM customer")
def csv_strict_scan(spark, sf):
    customer = table(spark, sf, "customer")
    return csvfiles.read_strict(spark, _as_csv(customer, "customer"), customer.schema, target="c_custkey")


@query(
    "csv_upload_scan",
    """SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS row_index, s_suppkey, s_acctbal FROM supplier""",
)
def csv_upload_scan(spark, sf):
    supplier = table(spark, sf, "supplier").orderBy("s_suppkey")
    records = ordering.with_row_index(csvfiles.read_upload(spark, _as_csv(supplier, "supplier")))
    return records.select(
        "row_index", F.col("s_suppkey").try_cast("long").alias("s_suppkey"),
        F.col("s_acctbal").try_cast("double").alias("s_acctbal"),
    )


@query(
    "record_head_then_sort",
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name,
  row_number() OVER (ORDER BY p_name DESC, p_partkey) AS position
FROM (SELECT * FROM part ORDER BY p_partkey LIMIT 500) AS head""",
)
def record_head_then_sort(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name").orderBy("p_partkey")
    records = ordering.with_row_index(csvfiles.read_records(spark, _as_csv(parts, "part")))
    head = ordering.first_rows(records, 500)
    ordered = ordering.sort_records(head, "p_name", descending=True, tie=["row_index"])
    return ordering.with_position(ordered).drop("row_index")


@query(
    "integer_lines_summary",
    """SELECT count(*) AS count, min(o_custkey) AS min, max(o_custkey) AS max,
  round(avg(o_custkey), 2) AS average, CAST(sum(o_custkey) AS BIGINT) AS sum FROM orders""",
)
def integer_lines_summary(spark, sf):
    path = scratch_path(spark, "integers")
    padded = F.concat(F.lit(" \t"), F.col("o_custkey").cast("string"), F.lit(" "))
    lines = F.explode(F.array(padded, F.lit(""), F.lit("  ")))
    table(spark, sf, "orders").select(lines.alias("value")).write.text(path)
    return ordering.list_summary(linefiles.read_integers(spark, path), "value")


@query(
    "parquet_view",
    "SELECT c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY c_mktsegment",
)
def parquet_view(spark, sf):
    parquetfiles.open_view(spark, f"{sf}/customer.parquet", "customer_view")
    return spark.sql(
        """SELECT c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
        FROM customer_view GROUP BY c_mktsegment"""
    )


@query(
    "split_tables",
    """WITH ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || o_orderkey)) AS r, count(*) OVER () AS n FROM orders)
SELECT CASE WHEN r <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train' WHEN r <= floor(n * CAST(0.7 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'val'
  ELSE 'test' END AS split, count(*) AS rows, CAST(sum(o_custkey) AS BIGINT) AS custkeys
FROM ranked GROUP BY 1""",
)
def split_tables(spark, sf):
    path = scratch_path(spark, "splits")
    csvfiles.write_snappy(split.exact_split(table(spark, sf, "orders"), ["o_orderkey"]), path, partition_by="split")
    loaded = parquetfiles.load_splits(spark, path, ["o_orderkey", "o_custkey"], "o_totalprice")
    sized = [
        df.agg(F.count("*").alias("rows"), F.sum("o_custkey").alias("custkeys")).select(
            F.lit(name).alias("split"), "rows", "custkeys"
        )
        for name, df in loaded.items()
    ]
    return sized[0].unionByName(sized[1]).unionByName(sized[2])


@query("csv_to_parquet", "SELECT count(*) AS rows, CAST(6 AS INTEGER) AS columns FROM part")
def csv_to_parquet(spark, sf):
    parts = table(spark, sf, "part")
    report = csvfiles.csv_to_parquet(spark, _as_csv(parts, "part"), scratch_path(spark, "part_parquet"), parts.schema)
    return spark.createDataFrame([(report.rows, report.columns)], "rows long, columns int")


@query("converted_parts", "SELECT * FROM part")
def converted_parts(spark, sf):
    parts = table(spark, sf, "part")
    target = scratch_path(spark, "part_parquet")
    csvfiles.csv_to_parquet(spark, _as_csv(parts, "part"), target, parts.schema)
    return spark.read.parquet(target)


@query(
    "reconcile_counts",
    "SELECT count(*) AS source_rows, count(*) AS target_rows, true AS match FROM nation",
)
def reconcile_counts(spark, sf):
    nation = table(spark, sf, "nation")
    source = spark.read.csv(_as_csv(nation, "nation"), header=True)
    return csvfiles.reconcile_counts(source, nation)


META_COLUMNS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]


@query(
    "feature_metadata",
    f"""WITH {LINEITEM_SQL}, m AS (SELECT count(*) AS total, sum(placed) AS placed, avg(l_quantity) AS mean,
  stddev_samp(l_extendedprice) AS std, min(l_linenumber) AS low, max(l_orderkey) AS high FROM lineitem_records)
SELECT 'placed' AS target, 'l_orderkey,l_linenumber,l_quantity,l_extendedprice' AS feature_columns,
  1 AS code_o, CAST(placed AS BIGINT) AS placed, CAST(total - placed AS BIGINT) AS not_placed, total,
  round(mean, 4) AS quantity_mean, round(std, 4) AS price_std, CAST(low AS DOUBLE) AS linenumber_min,
  CAST(high AS DOUBLE) AS orderkey_max FROM m""",
)
def feature_metadata(spark, sf):
    train = lineitem_records(spark, sf).select(*META_COLUMNS, "placed")
    document = profile.feature_document(
        train, "placed", [], {"status_encoding": {"F": 0, "O": 1}}, schema.numeric_columns(train, exclude=["placed"])
    )
    path = scratch_path(spark, "metadata")
    metadata.write_document(document, path)
    return metadata.read_document(spark, path).select(
        "target",
        F.array_join("feature_columns", ",").alias("feature_columns"),
        F.col("status_encoding.O").cast("int").alias("code_o"),
        "class_balance.placed",
        "class_balance.not_placed",
        "class_balance.total",
        F.col("train_stats.l_quantity.mean").alias("quantity_mean"),
        F.col("train_stats.l_extendedprice.std").alias("price_std"),
        F.col("train_stats.l_linenumber.min").alias("linenumber_min"),
        F.col("train_stats.l_orderkey.max").alias("orderkey_max"),
    )


@query("directed_edge_file", f"WITH {TRADE_SQL} SELECT src, dst, d AS \"D\", t AS \"T\", f AS \"F\" FROM trade")
def directed_edge_file(spark, sf):
    written = trade_edges(spark, sf).select(
        F.col("src").alias("Node From"), F.col("dst").alias("Node To"), F.col("d").alias("D"),
        F.col("t").alias("T"), F.col("f").alias("F"),
    )
    return edgefiles.read_directed_edges(spark, _as_csv(written, "directed")).drop("row")


@query(
    "undirected_edge_file",
    f"""WITH {TRADE_SQL} SELECT a.n_name AS src, b.n_name AS dst, d AS distance, t AS time, f AS fuel
FROM trade JOIN nation AS a ON a.n_nationkey = src JOIN nation AS b ON b.n_nationkey = dst""",
)
def undirected_edge_file(spark, sf):
    names = table(spark, sf, "nation").select("n_nationkey", F.concat(F.lit("  "), "n_name", F.lit("\t")).alias("name"))
    edges = (
        trade_edges(spark, sf)
        .join(names.withColumnsRenamed({"n_nationkey": "src", "name": "From Node"}), "src")
        .join(names.withColumnsRenamed({"n_nationkey": "dst", "name": "To Node"}), "dst")
    )
    written = edges.select(
        "From Node", "To Node", F.col("d").alias("Distance (km)"), F.col("t").alias("Time (mins)"),
        F.col("f").alias("Fuel (Liters)"),
    )
    path = scratch_path(spark, "undirected")
    written.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return edgefiles.read_undirected_edges(spark, path).drop("row")


@query(
    "csv_odd_cells",
    """SELECT o_orderkey AS row_index, o_orderkey, o_totalprice, o_orderpriority || chr(10) || 'second "line"' AS note, upper(o_orderstatus) AS status
FROM orders""",
)
def csv_odd_cells(spark, sf):
    """Cells with quoted line breaks, quotes, and no-break and other Unicode blanks around numbers and labels."""
    blank = F.lit("\u00a0\u2003\t")
    orders = table(spark, sf, "orders").orderBy("o_orderkey").select(
        F.concat(blank, F.col("o_orderkey").cast("string"), blank).alias("key"),
        F.concat(F.col("o_totalprice").cast("string"), blank).alias("price"),
        F.concat("o_orderpriority", F.lit('\nsecond "line"')).alias("note"),
        F.concat(blank, F.lower("o_orderstatus"), F.lit("\u3000")).alias("status"),
    )
    path = scratch_path(spark, "odd")
    orders.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    records = ordering.with_row_index(csvfiles.read_upload(spark, path))
    return records.select(
        "row_index",
        numeric.parse_whole(F.col("key")).cast("long").alias("o_orderkey"),
        numeric.parse_number(F.col("price")).alias("o_totalprice"),
        "note",
        labels.upper_label(F.col("status")).alias("status"),
    )


@query(
    "upload_types",
    r"""WITH cells AS (
  SELECT unnest(['o_orderkey', 'o_totalprice', 'o_orderdate', 'high', 'mixed', 'nothing', 'late']) AS "column",
    unnest([CAST(o_orderkey AS VARCHAR), CAST(o_totalprice AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS VARCHAR), CAST(o_totalprice > 1000 AS VARCHAR),
      CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE 'no. ' || o_orderkey END, NULL,
      CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'x' ELSE '7' END]) AS cell FROM orders)
SELECT "column", count(cell) AS values, count(*) - count(cell) AS missing,
  CASE WHEN count(cell) = 0 THEN 'string' WHEN bool_and(cell IN ('true', 'false')) THEN 'boolean' WHEN bool_and(regexp_full_match(cell, '-?[0-9]{1,18}')) THEN 'bigint'
    WHEN bool_and(TRY_CAST(cell AS DOUBLE) IS NOT NULL) THEN 'double' WHEN bool_and(TRY_CAST(cell AS DATE) IS NOT NULL) THEN 'date' ELSE 'string' END AS type
FROM cells GROUP BY cells."column" """,
)
def upload_types(spark, sf):
    """Types of an uploaded file's columns, from all of its rows: the last row alone makes a column text."""
    orders = table(spark, sf, "orders")
    last = orders.agg(F.max("o_orderkey").alias("last"))
    made = orders.join(F.broadcast(last)).select(  # one row
        "o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"), (F.col("o_totalprice") > 1000).alias("high"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).otherwise(F.concat(F.lit("no. "), F.col("o_orderkey"))).alias("mixed"),
        F.lit(None).cast("string").alias("nothing"), F.when(F.col("o_orderkey") == F.col("last"), "x").otherwise("7").alias("late"),
    )
    return schema.inferred_types(csvfiles.read_upload(spark, _as_csv(made, "orders")).drop(ordering.FILE_POSITION))
