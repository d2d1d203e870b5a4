"""Graphs derived from the trade between nations, and between parts and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixture_queries.base import query, table
from tallyroute.functions.text import path_text
from tallyroute.operators import graph
from tallyroute.session import materialize

UNITS = {"d": "km", "t": "min", "f": "units"}


def trade_edges(spark: SparkSession, sf: str) -> DataFrame:
    """One edge per order and supplying nation: src supplies dst; parallel edges are common.

    lineitem is reduced per (order, supplier) and then per (order, nation) before it meets the
    orders, so one order with very many lines sends at most one row per nation into the join.
    """
    lines = (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_suppkey")
        .agg(F.min("l_quantity").alias("d"), F.min("l_linenumber").alias("t"), F.count("*").alias("f"))
    )
    suppliers = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("src"))
    supplied = (
        lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("l_orderkey", "src")
        .agg(F.min("d").alias("d"), F.min("t").alias("t"), F.sum("f").alias("f"))
    )
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("dst"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    bought = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "dst")
    return supplied.join(bought, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "src",
        "dst",
        F.col("d").cast("double").alias("d"),
        F.col("t").cast("double").alias("t"),
        F.col("f").cast("double").alias("f"),
        (F.col("l_orderkey") * 100 + F.col("src")).alias("row"),
    )


TRADE_SQL = """trade AS (
  SELECT s_nationkey AS src, c_nationkey AS dst, CAST(min(l_quantity) AS DOUBLE) AS d,
    CAST(min(l_linenumber) AS DOUBLE) AS t, CAST(count(*) AS DOUBLE) AS f, l_orderkey * 100 + s_nationkey AS row
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY l_orderkey, s_nationkey, c_nationkey
)"""
DIRECTED_SQL = TRADE_SQL + """, directed AS (
  SELECT src, dst, arg_max(d, row) AS d, arg_max(t, row) AS t, arg_max(f, row) AS f, max(row) AS row
  FROM trade GROUP BY src, dst
)"""
CANONICAL_SQL = TRADE_SQL + """, canonical AS (
  SELECT least(src, dst) AS src, greatest(src, dst) AS dst, arg_min(d, row) AS d, arg_min(t, row) AS t,
    arg_min(f, row) AS f, min(row) AS row
  FROM trade GROUP BY 1, 2
), mirrored AS (
  SELECT src, dst, d, t, f, row FROM canonical UNION ALL SELECT dst, src, d, t, f, row FROM canonical
)"""


def distance_sql(edges: str, weight: str, name: str = "dist", doublings: int = 5) -> str:
    """All-pairs distances by min-plus doubling, which covers 2 ** doublings hops."""
    steps = [
        f"""{name}0 AS MATERIALIZED (SELECT a AS s, b AS n, min(w) AS c FROM (
  SELECT src AS a, dst AS b, {weight} AS w FROM {edges}
  UNION ALL SELECT src, src, CAST(0 AS DOUBLE) FROM {edges}
  UNION ALL SELECT dst, dst, CAST(0 AS DOUBLE) FROM {edges}) AS e GROUP BY a, b)"""
    ]
    for i in range(doublings):
        steps.append(
            f"""{name}{i + 1} AS MATERIALIZED (SELECT x.s, y.n, min(x.c + y.c) AS c
  FROM {name}{i} AS x JOIN {name}{i} AS y ON x.n = y.s GROUP BY x.s, y.n)"""
        )
    steps.append(f"{name} AS (SELECT s, n, c FROM {name}{doublings})")
    return ", ".join(steps)


def path_sql(edges: str, weight: str, start: int, name: str = "walk") -> str:
    """Smallest path, by node order, from ``start`` to every node along tight edges of ``dist``."""
    return f"""{name}_all AS (
  SELECT {start} AS n, [{start}] AS path, 0 AS hops
  UNION ALL
  SELECT e.dst, list_append(p.path, e.dst), p.hops + 1 FROM {name}_all AS p
  JOIN (SELECT src, dst, min({weight}) AS w FROM {edges} WHERE src <> dst GROUP BY src, dst) AS e ON e.src = p.n
  JOIN dist AS a ON a.s = {start} AND a.n = p.n JOIN dist AS b ON b.s = {start} AND b.n = e.dst
  WHERE a.c + e.w = b.c AND p.hops < 30
), {name} AS (SELECT n, min(path) AS path FROM {name}_all GROUP BY n)"""


def _text(column: str) -> str:
    return f"array_to_string({column}, ' › ')"


@query("directed_last_edge", f"WITH {DIRECTED_SQL} SELECT src, dst, d, t, f FROM directed")
def directed_last_edge(spark, sf):
    return graph.directed(trade_edges(spark, sf)).select("src", "dst", "d", "t", "f")


@query(
    "mirrored_edges",
    f"WITH {TRADE_SQL} SELECT src, dst, d, row FROM trade UNION ALL SELECT dst, src, d, row FROM trade",
)
def mirrored_edges(spark, sf):
    return graph.undirected(trade_edges(spark, sf)).select("src", "dst", "d", "row")


@query("canonical_edges", f"WITH {CANONICAL_SQL} SELECT src, dst, d, t, f FROM canonical")
def canonical_edges(spark, sf):
    return graph.canonical_edges(trade_edges(spark, sf)).select("src", "dst", "d", "t", "f")


@query("trade_nodes", f"WITH {TRADE_SQL} SELECT src AS node FROM trade UNION SELECT dst FROM trade ORDER BY 1")
def trade_nodes(spark, sf):
    return graph.nodes(trade_edges(spark, sf)).orderBy("node")


@query("trade_edge_count", f"WITH {TRADE_SQL} SELECT count(*) AS edges FROM trade")
def trade_edge_count(spark, sf):
    return graph.edge_count(trade_edges(spark, sf))


@query(
    "adjacency_lists",
    f"""WITH {CANONICAL_SQL} SELECT src, 0 AS part, string_agg(CAST(dst AS VARCHAR), ',' ORDER BY row, dst) AS neighbours
FROM mirrored GROUP BY src""",
)
def adjacency_lists(spark, sf):
    edges = graph.undirected(graph.canonical_edges(trade_edges(spark, sf)))
    lists = graph.adjacency(edges)
    return lists.select(
        "src",
        "part",
        F.array_join(F.transform("neighbours", lambda e: e["dst"].cast("string")), ",").alias("neighbours"),
    )


@query(
    "adjacency_parts",
    f"""WITH {CANONICAL_SQL} SELECT src, count(*) AS neighbours, CAST(sum(dst) AS BIGINT) AS total,
  CAST(ceil(count(*) / 3.0) AS INTEGER) AS parts FROM mirrored GROUP BY src""",
)
def adjacency_parts(spark, sf):
    """Lists cut into parts of about three: together they still hold every neighbour."""
    lists = graph.adjacency(graph.undirected(graph.canonical_edges(trade_edges(spark, sf))), chunk=3)
    return lists.groupBy("src").agg(
        F.sum(F.size("neighbours")).alias("neighbours"),
        F.sum(F.aggregate("neighbours", F.lit(0).cast("long"), lambda total, e: total + e["dst"])).alias("total"),
        F.max("parts").alias("parts"),
    )


@query(
    "all_pairs_distance",
    f"WITH {DIRECTED_SQL}, {distance_sql('directed', 'd')} SELECT s AS source, n AS node, c AS cost FROM dist",
)
def all_pairs_distance(spark, sf):
    return graph.all_pairs(graph.directed(trade_edges(spark, sf)), "d")


def _best_sql(weight: str) -> str:
    return f"""SELECT '{weight}' AS metric, s AS source, total FROM (
  SELECT s, count(*) AS reached, round(sum(CASE WHEN s <> n THEN c ELSE 0 END), 9) AS total FROM {weight}_dist GROUP BY s)
WHERE reached = (SELECT count(DISTINCT s) FROM {weight}_dist) ORDER BY total, s LIMIT 1"""


@query(
    "best_origin_per_metric",
    f"WITH {DIRECTED_SQL}, "
    + ", ".join(distance_sql("directed", w, f"{w}_dist") for w in ("d", "t", "f"))
    + " "
    + " UNION ALL ".join(f"({_best_sql(w)})" for w in ("d", "t", "f")),
)
def best_origin_per_metric(spark, sf):
    edges = graph.layered(graph.directed(trade_edges(spark, sf)), ["d", "t", "f"])
    return graph.cheapest_source(graph.source_totals(edges, "weight", layer="metric"), "metric")


@query(
    "origin_totals",
    f"""WITH {DIRECTED_SQL}, {distance_sql('directed', 'd')}
SELECT s AS source, round(sum(CASE WHEN s <> n THEN c ELSE 0 END), 9) AS total FROM dist
GROUP BY s HAVING count(*) = (SELECT count(DISTINCT s) FROM dist)""",
)
def origin_totals(spark, sf):
    return graph.origin_totals(graph.all_pairs(graph.directed(trade_edges(spark, sf)), "d"))


def _one_source(spark, node):
    return spark.range(1).select(F.lit(node).alias("node"))


@query(
    "paths_from_origin",
    f"""WITH RECURSIVE {DIRECTED_SQL}, {distance_sql('directed', 'd')}, {path_sql('directed', 'd', 0)}
SELECT 0 AS source, walk.n AS node, c AS cost, {_text('path')} AS path
FROM walk JOIN dist ON dist.s = 0 AND dist.n = walk.n""",
)
def paths_from_origin(spark, sf):
    edges = graph.directed(trade_edges(spark, sf))
    paths = graph.shortest_paths(edges, _one_source(spark, 0), "d")
    return paths.withColumn("path", path_text(F.col("path")))


@query(
    "destination_table",
    f"""WITH RECURSIVE {DIRECTED_SQL}, {distance_sql('directed', 'd')}, {path_sql('directed', 'd', 0)}
SELECT CAST(walk.n AS VARCHAR) AS dest, printf('%.1f km', c) AS cost, {_text('path')} AS path
FROM walk JOIN dist ON dist.s = 0 AND dist.n = walk.n WHERE walk.n <> 0
UNION ALL SELECT 'TOTAL', printf('%.1f km', coalesce(sum(c), 0)), '' FROM dist WHERE s = 0 AND n <> 0""",
)
def destination_table(spark, sf):
    edges = graph.directed(trade_edges(spark, sf))
    paths = graph.shortest_paths(edges, _one_source(spark, 0), "d")
    return graph.destination_table(paths, 0, "d", UNITS).drop("sort_order")


def _route(spark, sf, metric: str):
    edges = graph.undirected(materialize(graph.canonical_edges(trade_edges(spark, sf)), "canonical"))
    return edges, graph.route(edges, 3, 17, metric, ["d", "t", "f"])


def _route_sql(weight: str) -> str:
    return f"""WITH RECURSIVE {CANONICAL_SQL}, {distance_sql('mirrored', weight)}, {path_sql('mirrored', weight, 3)},
route AS (SELECT path, c FROM walk JOIN dist ON dist.s = 3 AND dist.n = walk.n WHERE walk.n = 17),
hops AS (SELECT unnest(path[:-2]) AS a, unnest(path[2:]) AS b FROM route),
firsts AS (SELECT src, dst, arg_min(d, row) AS d, arg_min(t, row) AS t, arg_min(f, row) AS f FROM mirrored GROUP BY src, dst)"""


@query(
    "route_by_distance",
    f"""{_route_sql('d')}
SELECT 3 AS start, 17 AS "end", c AS cost, {_text('path')} AS path, x.d AS total_d, x.t AS total_t, x.f AS total_f
FROM route, (SELECT sum(d) AS d, sum(t) AS t, sum(f) AS f FROM hops JOIN firsts ON src = a AND dst = b) AS x""",
)
def route_by_distance(spark, sf):
    _, found = _route(spark, sf, "d")
    return found.withColumn("path", path_text(F.col("path")))


@query(
    "route_nodes_tagged",
    f"""{_route_sql('d')}
SELECT node, list_contains((SELECT path FROM route), node) AS on_route, node IN (3, 17) AS is_end
FROM (SELECT src AS node FROM canonical UNION SELECT dst FROM canonical)""",
)
def route_nodes_tagged(spark, sf):
    edges, found = _route(spark, sf, "d")
    return graph.tag_nodes(graph.nodes(edges), found)


@query(
    "route_edges_tagged",
    f"""{_route_sql('d')}
SELECT src, dst, d, EXISTS (SELECT 1 FROM hops WHERE least(a, b) = src AND greatest(a, b) = dst) AS on_route
FROM canonical""",
)
def route_edges_tagged(spark, sf):
    canonical = materialize(graph.canonical_edges(trade_edges(spark, sf)), "canonical")
    found = graph.route(graph.undirected(canonical), 3, 17, "d", ["d"])
    return graph.tag_edges(canonical, found).select("src", "dst", "d", "on_route")


@query(
    "multigraph_route_totals",
    f"""WITH RECURSIVE {TRADE_SQL}, both_ways AS (
  SELECT src, dst, d, t, f, row FROM trade UNION ALL SELECT dst, src, d, t, f, row FROM trade),
{distance_sql('both_ways', 'd')}, {path_sql('both_ways', 'd', 5)},
hops AS (SELECT n, unnest(path[:-2]) AS a, unnest(path[2:]) AS b FROM walk WHERE n <> 5),
firsts AS (SELECT src, dst, arg_min(d, row) AS d, arg_min(t, row) AS t, arg_min(f, row) AS f FROM both_ways GROUP BY src, dst)
SELECT 5 AS source, n AS node, sum(d) AS total_d, sum(t) AS total_t, sum(f) AS total_f
FROM hops JOIN firsts ON src = a AND dst = b GROUP BY n""",
)
def multigraph_route_totals(spark, sf):
    edges = materialize(graph.undirected(trade_edges(spark, sf)), "both_ways")
    paths = graph.shortest_paths(edges, _one_source(spark, 5), "d")
    return graph.route_totals(paths, edges, ["d", "t", "f"])


@query(
    "shortest_path_edges",
    f"""WITH RECURSIVE {DIRECTED_SQL}, {distance_sql('directed', 'd')}, {path_sql('directed', 'd', 0)}
SELECT DISTINCT unnest(path[:-2]) AS src, unnest(path[2:]) AS dst FROM walk WHERE n <> 0""",
)
def shortest_path_edges(spark, sf):
    edges = graph.directed(trade_edges(spark, sf))
    return graph.path_edges(graph.shortest_paths(edges, _one_source(spark, 0), "d"))


@query(
    "background_edges",
    f"""WITH RECURSIVE {DIRECTED_SQL}, {distance_sql('directed', 'd')}, {path_sql('directed', 'd', 0)},
used AS (SELECT DISTINCT unnest(path[:-2]) AS a, unnest(path[2:]) AS b FROM walk WHERE n <> 0)
SELECT src, dst, d FROM directed WHERE NOT EXISTS (SELECT 1 FROM used WHERE a = src AND b = dst)""",
)
def background_edges(spark, sf):
    edges = materialize(graph.directed(trade_edges(spark, sf)), "directed")
    paths = graph.shortest_paths(edges, _one_source(spark, 0), "d")
    return graph.background_edges(edges, paths).select("src", "dst", "d")


def supply_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Part and supplier nodes joined by every line, both ways; weight is the quantity."""
    edges = table(spark, sf, "lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias("src"),
        F.concat(F.lit("S"), "l_suppkey").alias("dst"),
        F.col("l_quantity").alias("w"),
    )
    return graph.undirected(edges)


def _supply_sql(rounds: int = 24) -> str:
    steps = [
        """lines AS MATERIALIZED (SELECT 'P' || l_partkey AS p, 'S' || l_suppkey AS s, min(l_quantity) AS w
  FROM lineitem GROUP BY 1, 2),
edges AS MATERIALIZED (SELECT p AS src, s AS dst, w FROM lines UNION ALL SELECT s, p, w FROM lines),
r0 AS MATERIALIZED (SELECT 'S0' AS n, CAST(0 AS DOUBLE) AS c)"""
    ]
    for i in range(rounds):
        steps.append(
            f"""r{i + 1} AS MATERIALIZED (SELECT n, min(c) AS c FROM (
  SELECT n, c FROM r{i} UNION ALL SELECT dst, r{i}.c + w FROM r{i} JOIN edges ON src = n) AS u GROUP BY n)"""
        )
    return f"WITH {', '.join(steps)} SELECT 'S0' AS source, n AS node, c AS cost FROM r{rounds}"


@query("supply_distances", _supply_sql())
def supply_distances(spark, sf):
    return graph.distances(supply_edges(spark, sf), _one_source(spark, "S0"), "w")
