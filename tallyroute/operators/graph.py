"""Weighted graphs as edge tables (src, dst, weights..., row).

Shortest paths relax all frontier nodes at once: join the frontier with the edges, keep the
best candidate per (source, node), stop when nothing improves. Each round's improvements are
written as a table, so plans stay flat, a lost executor re-reads tables, and a small frontier
is broadcast by its true size instead of shuffling the edges. Weights must not be negative;
among equal costs the lexicographically smallest path wins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyroute.functions import formats
from tallyroute.functions.text import path_text
from tallyroute.session import discard, materialize, materialize_at, release, scratch_mark, scratch_path

# Rounds whose improvements are kept apart before they are merged into one table of distances.
MERGE_ROUNDS = 4
# Rows of distances that one block of sources may give when only their totals are kept.
BLOCK_ROWS = 100_000_000


class NegativeWeight(ValueError):
    """Shortest paths need weights of zero or more."""


def _one_per_pair(edges: DataFrame, row: str, pick) -> DataFrame:
    # Column by column, so that plain numbers stay in a hash aggregate; ``row`` is unique.
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    return edges.groupBy("src", "dst").agg(*[pick(c, row).alias(c) for c in rest])


def directed(edges: DataFrame, row: str = "row") -> DataFrame:
    """One edge per (src, dst): a later row overwrites an earlier one."""
    return _one_per_pair(edges, row, F.max_by)


def undirected(edges: DataFrame) -> DataFrame:
    """Every edge in both directions; parallel edges stay."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *rest)
    return edges.select("src", "dst", *rest).unionByName(back)


def first_edges(edges: DataFrame, row: str = "row") -> DataFrame:
    """The first of several parallel edges, by row."""
    return _one_per_pair(edges, row, F.min_by)


def canonical_edges(edges: DataFrame, row: str = "row") -> DataFrame:
    """One edge per unordered pair, smaller node first, first row wins."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    oriented = edges.select(
        F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), *rest
    ).withColumnsRenamed({"a": "src", "b": "dst"})
    return first_edges(oriented, row)


def nodes(edges: DataFrame, layers: Sequence[str] = ()) -> DataFrame:
    """Distinct endpoints, per layer if there are any."""
    ends = edges.select(*layers, F.col("src").alias("node")).unionAll(
        edges.select(*layers, F.col("dst").alias("node"))
    )
    return ends.distinct()


def edge_count(edges: DataFrame) -> DataFrame:
    """Edges of an undirected list before mirroring; parallel edges count."""
    return edges.agg(F.count("*").alias("edges"))


def adjacency(edges: DataFrame, chunk: int = 10_000) -> DataFrame:
    """Neighbour lists: src, part, parts, neighbours (structs in row order).

    A list longer than ``chunk`` comes in as many parts as its degree asks for, so no array and
    no group grows with a hub. The large nodes' degrees are a written table: Spark copies it to
    the edges if it is small and splits a hub's share of the join if it is not.
    """
    rest = [c for c in edges.columns if c not in ("src", "row")]
    degrees = edges.groupBy("src").agg(F.count("*").alias("n")).filter(F.col("n") > chunk)
    large = materialize(degrees.select("src", F.ceil(F.col("n") / F.lit(chunk)).cast("int").alias("_parts")), "degrees")
    parts = F.coalesce("_parts", F.lit(1))
    keyed = edges.join(large, "src", "left").withColumn("part", F.pmod(F.xxhash64("dst", "row"), parts).cast("int"))
    entries = F.array_sort(F.collect_list(F.struct("row", *rest)))
    return keyed.groupBy("src", "part").agg(F.max(parts).alias("parts"), entries.alias("neighbours"))


def layered(edges: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One copy of the graph per metric (metric, src, dst, weight), to be searched side by side."""
    copies = F.stack(F.lit(len(metrics)), *[v for m in metrics for v in (F.lit(m), F.col(m).cast("double"))])
    return edges.select("src", "dst", copies.alias("metric", "weight"))


def _prepared(edges: DataFrame, weight: str, layer: list[str]) -> DataFrame:
    """The cheapest edge per pair, checked and written once."""
    facts = Observation()
    best = (
        edges.select(*layer, "src", "dst", F.col(weight).cast("double").alias("w"))
        .filter(F.col("w").isNotNull())
        .groupBy(*layer, "src", "dst")
        .agg(F.min("w").alias("w"))
        .observe(facts, F.min("w").alias("low"))
    )
    table = materialize(best, "edges")
    if facts.get["low"] is not None and facts.get["low"] < 0:
        raise NegativeWeight(f"negative value in '{weight}'")
    return table


def shortest_paths(
    edges: DataFrame,
    sources: DataFrame | None,
    weight: str,
    *,
    with_path: bool = True,
    target=None,
    layer: str | None = None,
    prepared: bool = False,
) -> DataFrame:
    """source, node, cost and, on request, path, for every node that a source reaches.

    ``sources`` has one column ``node``; None takes every node of the graph. The result holds
    |sources| x |reached nodes| rows, so pass only the sources you need. With ``target`` the
    search drops branches that cost more than the best known way there; rows of other
    nodes may then be incomplete. ``layer`` names a column that keeps independent graphs apart;
    they are searched in the same rounds, and sources and results carry it too. ``prepared`` says that ``edges``
    is what an earlier search has made of them, to be read as it is.
    """
    if target is not None and layer:
        raise ValueError("a target needs a single graph")
    spark = edges.sparkSession
    layers = [layer] if layer else []
    start = scratch_mark()
    found = _relax(edges if prepared else _prepared(edges, weight, layers), sources, layers, with_path, target)
    path = scratch_path(spark, "paths")
    result = materialize_at(found, path)
    release(spark, start, keep=path)
    return result


def _relax(table: DataFrame, sources: DataFrame | None, layers: list[str], with_path: bool, target) -> DataFrame:
    """Rounds of relaxation that only move what changed.

    A round extends the rows improved by the last one, reduces the offers to the best per
    (source, node) and looks these up in the distances known so far. What is better is written
    as one more small table; a few of them are merged at a time. Offers are written before they
    are looked up, so Spark sees their size: few are copied to the known rows, which then
    aren't moved, and many are shuffled, where a hub's share is split.
    """
    node_type = table.schema["src"].dataType
    origin = F.col("node").cast(node_type)
    value = ["cost", "path"] if with_path else ["cost"]
    keys = [*layers, "source", "node"]
    start = (nodes(table, layers) if sources is None else sources).select(
        *layers,
        origin.alias("source"),
        origin.alias("node"),
        F.lit(0.0).alias("cost"),
        *([F.array(origin).alias("path")] if with_path else []),
    )

    def best(rows: DataFrame) -> DataFrame:
        offer = F.struct(*value) if with_path else F.col("cost")
        least = rows.groupBy(*keys).agg(F.min(offer).alias("_best"))
        return least.select(*keys, *[F.col(f"_best.{v}").alias(v) for v in value]) if with_path else least.withColumnRenamed("_best", "cost")

    def written(rows: DataFrame, label: str) -> tuple[DataFrame, str]:
        path = scratch_path(spark, label)
        return materialize_at(rows, path), path

    spark = table.sparkSession
    frontier, path = written(start.distinct(), "sources")
    known, bound = [(frontier, path, frontier.count())], None
    while True:
        moving = frontier if bound is None else frontier.filter(F.col("cost") <= F.lit(bound))
        ahead = moving.select(*layers, "source", F.col("node").alias("src"), *value)
        steps = table.join(ahead, [*layers, "src"])
        if with_path:
            steps = steps.filter(~F.array_contains("path", F.col("dst")))
        reached = steps.select(
            *layers,
            "source",
            F.col("dst").alias("node"),
            (F.col("cost") + F.col("w")).alias("cost"),
            *([F.concat("path", F.array("dst")).alias("path")] if with_path else []),
        )
        offers, offered = written(best(reached), "offers")
        everything = reduce(DataFrame.unionByName, [rows for rows, _, _ in known])
        met = best(everything.join(offers.select(*keys), keys))
        old, new = [F.struct(*[F.col(f"{side}.{v}") for v in value]) for side in ("old", "new")]
        joined = offers.alias("new").join(met.alias("old"), keys, "left")
        better = joined.filter(F.col("old.cost").isNull() | (new < old)).select(*keys, *[F.col(f"new.{v}").alias(v) for v in value])
        state = Observation()
        at_target = F.lit(False) if target is None else F.col("node") == F.lit(target)
        seen = better.observe(state, F.count("*").alias("changed"), F.min(F.when(at_target, F.col("cost"))).alias("reached"))
        frontier, path = written(seen, "better")
        discard(spark, offered.rsplit("/", 1)[0])
        if not state.get["changed"]:
            return best(everything)
        if state.get["reached"] is not None:
            bound = state.get["reached"]
        known.append((frontier, path, state.get["changed"]))
        if len(known) > MERGE_ROUNDS:
            # The large first table is only rewritten once the others have grown to half its size.
            late = sum(n for _, _, n in known[1:])
            kept = [] if 2 * late >= known[0][2] else known[:1]
            gone = known[len(kept) :]
            merged, merged_path = written(best(reduce(DataFrame.unionByName, [rows for rows, _, _ in gone])), "known")
            frontier, path = written(frontier, "frontier")
            for _, old_path, _ in gone:
                discard(spark, old_path.rsplit("/", 1)[0])
            known = [*kept, (merged, merged_path, sum(n for _, _, n in gone))]


def distances(edges: DataFrame, sources: DataFrame, weight: str) -> DataFrame:
    """source, node, cost, without carrying paths."""
    return shortest_paths(edges, sources, weight, with_path=False)


def all_pairs(edges: DataFrame, weight: str, *, with_path: bool = False, layer: str | None = None) -> DataFrame:
    """Distances between all reachable pairs; for graphs whose node count squared is affordable."""
    return shortest_paths(edges, None, weight, with_path=with_path, layer=layer)


def _total() -> Column:
    at_home = F.col("node") == F.col("source")
    return F.round(F.sum(F.when(at_home, F.lit(0.0)).otherwise(F.col("cost"))), 9)


def origin_totals(pairs: DataFrame, layer: str | None = None) -> DataFrame:
    """source, total: summed cost to the others, only for sources that reach every node.

    ``pairs`` must hold all sources; each reaches itself, which gives the number of nodes.
    """
    layers = [layer] if layer else []
    reached = pairs.groupBy(*layers, "source").agg(F.count("*").alias("reached"), _total().alias("total"))
    return _complete(reached, reached, layer)


def _complete(reached: DataFrame, every_node: DataFrame, layer: str | None) -> DataFrame:
    """Of ``reached`` the sources that reach as many nodes as ``every_node`` has rows."""
    if layer:
        everything = every_node.groupBy(layer).agg(F.count("*").alias("nodes"))
        whole = reached.join(everything, layer).filter(F.col("reached") == F.col("nodes"))
        return whole.select(layer, "source", "total")
    return reached.filter(F.col("reached") == every_node.agg(F.count("*")).scalar()).select("source", "total")


def source_totals(edges: DataFrame, weight: str, *, layer: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``origin_totals`` of all pairs, keeping one row per source.

    Sources are searched in blocks whose distances come to about ``block_rows`` rows; a block's
    distances are reduced to its totals and deleted before the next one starts.
    """
    spark = edges.sparkSession
    layers = [layer] if layer else []
    every_node = materialize(nodes(edges, layers), "nodes")
    cheapest = _prepared(edges, weight, layers)  # written once, read by every block
    n = every_node.count()
    blocks = max(1, -(-n * n // block_rows))
    totals = []
    for block in range(blocks):
        mark = scratch_mark()
        some = every_node.filter(F.pmod(F.xxhash64("node"), F.lit(blocks)) == block)
        pairs = shortest_paths(cheapest, some, weight, with_path=False, layer=layer, prepared=True)
        path = scratch_path(spark, "totals")
        totals.append(materialize_at(pairs.groupBy(*layers, "source").agg(F.count("*").alias("reached"), _total().alias("total")), path))
        release(spark, mark, keep=path)
    return _complete(reduce(DataFrame.unionByName, totals), every_node, layer)


def best_origin(pairs: DataFrame, layer: str | None = None) -> DataFrame:
    """source, total of the cheapest origin, lowest node on ties; no row if none reaches all."""
    return cheapest_source(origin_totals(pairs, layer), layer)


def cheapest_source(totals: DataFrame, layer: str | None = None) -> DataFrame:
    """The row of the smallest total, per layer if there are any; the lowest node on ties."""
    best = F.min(F.struct("total", "source")).alias("b")
    if layer:
        return totals.groupBy(layer).agg(best).select(layer, "b.source", "b.total")
    return totals.orderBy("total", "source").limit(1)


def route(edges: DataFrame, start, end, weight: str, metrics: Sequence[str]) -> DataFrame:
    """One row: start, end, cost, path, total_<metric> per metric over the chosen path.

    ``edges`` are directed (mirror an undirected list first). No way: null cost and an empty path.
    """
    if start == end:
        raise ValueError("start and end must differ")
    spark = edges.sparkSession
    # The search and the totals both read the edges.
    edges = materialize(edges.select(*dict.fromkeys(["src", "dst", "row", weight, *metrics])), "edges")
    node_type = edges.schema["src"].dataType
    origin = spark.range(1).select(F.lit(start).cast(node_type).alias("node"))
    found = shortest_paths(edges, origin, weight, target=end).filter(F.col("node") == F.lit(end))
    totals = [f"total_{m}" for m in metrics]
    rows = found.join(route_totals(found, edges, metrics), ["source", "node"], "left")
    # At most one row is found; the aggregate also gives one when there is none.
    best = rows.agg(F.max(F.struct("cost", "path", *totals)).alias("r"))
    nowhere = F.array().cast(found.schema["path"].dataType)
    return best.select(
        F.lit(start).cast(node_type).alias("start"),
        F.lit(end).cast(node_type).alias("end"),
        "r.cost",
        F.coalesce("r.path", nowhere).alias("path"),
        *[F.col(f"r.{t}").alias(t) for t in totals],
    )


def path_steps(paths: DataFrame) -> DataFrame:
    """Consecutive node pairs of each path: source, node, step (0-based), src, dst."""
    pairs = F.arrays_zip(
        F.slice("path", F.lit(1), F.greatest(F.size("path") - 1, F.lit(0))).alias("src"),
        F.slice("path", F.lit(2), F.greatest(F.size("path") - 1, F.lit(0))).alias("dst"),
    )
    exploded = paths.select("source", "node", F.posexplode(pairs).alias("step", "pair"))
    return exploded.select("source", "node", "step", F.col("pair.src").alias("src"), F.col("pair.dst").alias("dst"))


def route_totals(paths: DataFrame, edges: DataFrame, metrics: Sequence[str], row: str = "row") -> DataFrame:
    """Sum of every metric along each path; a step takes the first of its parallel edges.

    Only edges between nodes of some path take part in the reduction.
    """
    steps = path_steps(paths)
    used = edges.select("src", "dst", row, *metrics).join(
        steps.select("src", "dst").distinct(), ["src", "dst"], "left_semi"
    )
    hops = steps.join(first_edges(used, row), ["src", "dst"])
    return hops.groupBy("source", "node").agg(
        *[F.round(F.sum(m), 9).alias(f"total_{m}") for m in metrics]
    )


def path_edges(paths: DataFrame) -> DataFrame:
    """Distinct edges that lie on the given paths."""
    return path_steps(paths).select("src", "dst").distinct()


def background_edges(edges: DataFrame, paths: DataFrame) -> DataFrame:
    """Edges that lie on none of the given paths."""
    return edges.join(path_edges(paths), ["src", "dst"], "left_anti")


def tag_nodes(all_nodes: DataFrame, route_row: DataFrame) -> DataFrame:
    """node, on_route, is_end for a one-row route."""
    path = route_row.select("path").scalar()
    return all_nodes.select(
        "node",
        F.array_contains(path, F.col("node")).alias("on_route"),
        F.coalesce(
            F.col("node").isin(F.try_element_at(path, F.lit(1)), F.try_element_at(path, F.lit(-1))),
            F.lit(False),
        ).alias("is_end"),
    )


def tag_edges(canonical: DataFrame, route_row: DataFrame) -> DataFrame:
    """The canonical edges with on_route for a one-row route."""
    steps = path_steps(route_row.select(F.col("start").alias("source"), F.col("end").alias("node"), "path"))
    marked = steps.select(
        F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")
    ).distinct()
    return canonical.join(
        marked.withColumn("_hit", F.lit(True)), ["src", "dst"], "left"
    ).withColumn("on_route", F.coalesce("_hit", F.lit(False))).drop("_hit")


def destination_table(paths: DataFrame, origin, metric: str, units: Mapping[str, str]) -> DataFrame:
    """Report for one origin: dest, cost, path as text, and a TOTAL row; the origin is left out.

    ``sort_order`` puts destinations by node and the total last.
    """
    mine = paths.filter((F.col("source") == F.lit(origin)) & (F.col("node") != F.lit(origin)))
    last = mine.agg(F.coalesce(F.sum("cost"), F.lit(0.0)).alias("cost"))
    each = mine.select(
        F.col("node").cast("string").alias("dest"),
        "cost",
        path_text(F.col("path")).alias("path"),
        F.struct(F.lit(0).alias("last"), F.col("node").alias("node")).alias("sort_order"),
    )
    total = last.select(
        F.lit("TOTAL").alias("dest"),
        "cost",
        F.lit("").alias("path"),
        F.struct(F.lit(1).alias("last"), F.lit(None).cast(mine.schema["node"].dataType).alias("node")).alias("sort_order"),
    )
    rounded_cost = formats.cost_text(F.round("cost", 9), metric, units)
    return each.unionByName(total).withColumn("cost", rounded_cost).orderBy("sort_order")
