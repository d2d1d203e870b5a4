import random

import pytest
from pyspark.sql import functions as F

from tallyroute.operators import graph
from tallyroute.sources import edgefiles

ONE_WAY = [
    (10, 20, 3, 9, 0.5), (20, 30, 4, 1, 0.25), (30, 10, 2, 2, 2.0), (10, 40, 8, 3, 1.5), (40, 50, 1, 7, 0.75),
    (50, 10, 6, 4, 0.5), (30, 40, 1, 8, 0.125), (20, 50, 9, 2, 1.0), (50, 30, 3, 5, 3.0), (10, 20, 2, 6, 0.75),
]
# A pair of parallel roads, padded names (one with a no-break space), and two ways of equal length from Alder to Elm.
ROADS = [
    ("Alder", " Beech", 5, 8, 1.25), ("Beech", "Cedar", 4, 6, 0.5), ("Alder\u00a0", "Dogwood", 6, 3, 0.25), ("Cedar", "Elm", 7, 9, 2.0),
    ("Dogwood", "Elm ", 10, 2, 1.5), ("Beech", "Dogwood", 2, 5, 0.75), ("Cedar", "Beech", 3, 7, 1.75), ("Elm", "Fir", 1, 1, 0.125),
    ("Fir", "Cedar", 12, 4, 0.25),
]
METRICS = ["distance", "time", "fuel"]


def settled(edges, start):
    """Cost and smallest path per node: every edge is tried on every known path until nothing improves."""
    best = {start: (0.0, [start])}
    again = True
    while again:
        again = False
        for u, v, w in edges:
            if u in best and v not in best[u][1]:
                offer = (best[u][0] + w, best[u][1] + [v])
                if v not in best or offer < best[v]:
                    best[v], again = offer, True
    return best


def one_way(metric):
    """The last of parallel edges counts."""
    return [(u, v, float(w)) for (u, v), w in {(e[0], e[1]): e[2 + metric] for e in ONE_WAY}.items()]


def both_ways(metric):
    named = [(a.strip(), b.strip(), float(e[metric])) for a, b, *e in ROADS]
    return named + [(b, a, w) for a, b, w in named]


@pytest.fixture(scope="module")
def directed(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("d") / "edges.csv"
    path.write_text("Node From,Node To,D,T,F\n" + "".join(",".join(map(str, e)) + "\n" for e in ONE_WAY))
    return graph.directed(edgefiles.read_directed_edges(spark, str(path)))


@pytest.fixture(scope="module")
def raw_undirected(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("u") / "edges.csv"
    rows = "".join(",".join(map(str, e)) + "\n" for e in ROADS)
    path.write_text("\ufeffFrom Node,To Node,Distance (km),Time (mins),Fuel (Liters)\n" + rows, encoding="utf-8")
    return edgefiles.read_undirected_edges(spark, str(path))


def expected_origin(metric):
    totals = {}
    for node in {e[0] for e in ONE_WAY} | {e[1] for e in ONE_WAY}:
        found = settled(one_way(metric), node)
        if len(found) == 5:
            totals[node] = sum(cost for cost, _ in found.values())
    return min((round(total, 6), node) for node, total in totals.items())


@pytest.mark.parametrize("metric", [0, 1, 2])
def test_best_origin(directed, metric):
    best = graph.best_origin(graph.all_pairs(directed, "DTF"[metric])).first()
    assert (round(best["total"], 6), best["source"]) == expected_origin(metric)
    for block_rows in (13, 1_000):
        again = graph.cheapest_source(graph.source_totals(directed, "DTF"[metric], block_rows=block_rows)).first()
        assert again == best


def test_no_origin_when_nothing_reaches_all(spark):
    edges = spark.createDataFrame([(1, 2, 1.0), (3, 2, 1.0)], "src int, dst int, w double")
    assert graph.best_origin(graph.all_pairs(edges, "w")).count() == 0


@pytest.mark.parametrize("start, end", [("Alder", "Elm"), ("Fir", "Alder"), ("Cedar", "Dogwood")])
@pytest.mark.parametrize("metric", [0, 1, 2])
def test_routes(raw_undirected, start, end, metric):
    row = graph.route(graph.undirected(raw_undirected), start, end, METRICS[metric], METRICS).first()
    cost, path = settled(both_ways(metric), start)[end]
    assert row["cost"] == pytest.approx(cost) and row["path"] == path
    for m, name in enumerate(METRICS):
        first = {}
        for a, b, *e in ROADS:
            first.setdefault(frozenset((a.strip(), b.strip())), e[m])
        assert row[f"total_{name}"] == pytest.approx(sum(first[frozenset(step)] for step in zip(path, path[1:], strict=False)))


def test_equal_costs_take_the_smallest_path(raw_undirected, spark):
    row = graph.route(graph.undirected(raw_undirected), "Alder", "Elm", "distance", ["distance"]).first()
    assert (row["cost"], row["path"]) == (15.0, ["Alder", "Beech", "Cedar", "Elm"])
    # The way over an edge of weight zero is found after the target has been reached at the same cost.
    edges = spark.createDataFrame([(1, 3, 1.0, 0), (1, 2, 1.0, 1), (2, 3, 0.0, 2)], "src int, dst int, w double, row int")
    assert graph.route(edges, 1, 3, "w", ["w"]).first()["path"] == [1, 2, 3]


def test_route_without_a_way_and_same_ends(spark):
    edges = spark.createDataFrame([("a", "b", 1.0, 0), ("c", "d", 1.0, 1)], "src string, dst string, w double, row int")
    row = graph.route(edges, "a", "d", "w", ["w"]).first()
    assert (row["cost"], row["path"], row["total_w"]) == (None, [], None)
    with pytest.raises(ValueError):
        graph.route(edges, "a", "a", "w", ["w"])


def test_undirected_shapes(raw_undirected):
    assert graph.edge_count(raw_undirected).first()["edges"] == 9
    assert graph.undirected(raw_undirected).count() == 18
    assert graph.canonical_edges(raw_undirected).count() == 8
    assert graph.nodes(raw_undirected).count() == 6


def test_totals_take_the_first_parallel_edge(spark):
    rows = [("a", "b", 9.0, 1.0, 0), ("a", "b", 2.0, 7.0, 1), ("b", "c", 1.0, 1.0, 2)]
    edges = spark.createDataFrame(rows, "src string, dst string, w double, m double, row int")
    row = graph.route(edges, "a", "c", "w", ["w", "m"]).first()
    assert row["cost"] == 3.0 and (row["total_w"], row["total_m"]) == (10.0, 2.0)


def test_later_duplicate_overwrites(spark):
    edges = spark.createDataFrame([(1, 2, 5.0, 0), (1, 2, 3.0, 1), (1, 2, 8.0, 2)], "src int, dst int, w double, row int")
    assert graph.directed(edges).first()["w"] == 8.0


def test_destination_table(directed, spark):
    origin = spark.createDataFrame([(30,)], "node int")
    table = graph.destination_table(graph.shortest_paths(directed, origin, "D"), 30, "D", {"D": "km"}).collect()
    want = settled(one_way(0), 30)
    assert [r["dest"] for r in table] == ["10", "20", "40", "50", "TOTAL"]
    for r in table[:-1]:
        cost, path = want[int(r["dest"])]
        assert (r["cost"], r["path"]) == (f"{cost} km", " › ".join(map(str, path)))
    assert table[-1]["cost"] == f"{sum(c for c, _ in want.values())} km" and table[-1]["path"] == ""


def test_tags(raw_undirected):
    found = graph.route(graph.undirected(raw_undirected), "Alder", "Elm", "time", METRICS)
    tags = {r["node"]: (r["on_route"], r["is_end"]) for r in graph.tag_nodes(graph.nodes(raw_undirected), found).collect()}
    assert tags["Alder"] == (True, True) and tags["Dogwood"] == (True, False) and tags["Cedar"] == (False, False)
    edges = graph.tag_edges(graph.canonical_edges(raw_undirected), found)
    assert edges.filter("on_route").count() == 2 and edges.count() == 8


def test_path_and_background_edges(directed, spark):
    origin = spark.createDataFrame([(30,)], "node int")
    paths = graph.shortest_paths(directed, origin, "D")
    used, rest = graph.path_edges(paths).count(), graph.background_edges(directed, paths).count()
    assert used == 4 and used + rest == directed.count() == 9


@pytest.mark.parametrize("rounds", [1, 4])
def test_paths_match_a_fixed_point_with_a_hub(spark, monkeypatch, rounds):
    rng = random.Random(7)
    # A third of all edges leave or enter node 0.
    edges = [(rng.randrange(40), rng.randrange(40), float(rng.randint(1, 6))) for _ in range(260)]
    edges += [(0, rng.randrange(40), float(rng.randint(1, 6))) for _ in range(70)]
    edges += [(rng.randrange(40), 0, float(rng.randint(1, 6))) for _ in range(70)]
    monkeypatch.setattr(graph, "MERGE_ROUNDS", rounds)
    df = spark.createDataFrame(edges, "src int, dst int, w double")
    sources = spark.createDataFrame([(0,), (5,)], "node int")
    got = {
        (r["source"], r["node"]): (r["cost"], r["path"]) for r in graph.shortest_paths(df, sources, "w").collect()
    }
    expected = {(s, n): v for s in (0, 5) for n, v in settled(edges, s).items()}
    assert got == expected
    pairs = {(r["source"], r["node"]): r["cost"] for r in graph.distances(df, sources, "w").collect()}
    assert pairs == {k: c for k, (c, _) in expected.items()}
    bounded = graph.shortest_paths(df, spark.createDataFrame([(5,)], "node int"), "w", target=17)
    hit = bounded.filter("node = 17").first()
    assert (hit["cost"], hit["path"]) == expected[(5, 17)]


def test_zero_weight_cycles_end(spark):
    edges = spark.createDataFrame(
        [("a", "b", 0.0), ("b", "a", 0.0), ("a", "c", 1.0), ("b", "c", 1.0), ("c", "c", 0.0)],
        "src string, dst string, w double",
    )
    origin = spark.createDataFrame([("a",)], "node string")
    got = {r["node"]: (r["cost"], r["path"]) for r in graph.shortest_paths(edges, origin, "w").collect()}
    assert got == {"a": (0.0, ["a"]), "b": (0.0, ["a", "b"]), "c": (1.0, ["a", "b", "c"])}


def test_layers_are_searched_side_by_side(directed):
    edges = graph.layered(directed, ["D", "T", "F"])
    best = graph.best_origin(graph.all_pairs(edges, "weight", layer="metric"), "metric")
    got = {r["metric"]: (round(r["total"], 6), r["source"]) for r in best.collect()}
    assert got == {"DTF"[m]: expected_origin(m) for m in range(3)}
    blocks = graph.cheapest_source(graph.source_totals(edges, "weight", layer="metric", block_rows=9), "metric")
    assert sorted(blocks.collect()) == sorted(best.collect())


def test_triangle_inequality(directed):
    d = {(r["source"], r["node"]): r["cost"] for r in graph.all_pairs(directed, "T").collect()}
    assert all(d[a, c] <= d[a, b] + d[b, c] for a, b in d for c in {y for _, y in d})


def test_adjacency_parts_stay_small_and_whole(spark):
    rows = [(0, i, i) for i in range(1000)] + [(i, 0, 1000 + i) for i in range(1, 50)]
    edges = spark.createDataFrame(rows, "src int, dst int, row int")
    lists = graph.adjacency(edges, chunk=100)
    assert lists.agg(F.sum(F.size("neighbours"))).first()[0] == len(rows)
    hub = lists.filter("src = 0").agg(F.count("*"), F.max(F.size("neighbours"))).first()
    assert hub[0] == 10 and hub[1] < 200 and {r["parts"] for r in lists.filter("src = 0").collect()} == {10}
    small = graph.adjacency(edges).filter("src = 0").first()["neighbours"]
    assert [n["row"] for n in small] == list(range(1000))


def test_negative_weights_are_refused(spark):
    edges = spark.createDataFrame([(1, 2, -1.0)], "src int, dst int, w double")
    with pytest.raises(graph.NegativeWeight):
        graph.distances(edges, spark.createDataFrame([(1,)], "node int"), "w")


def test_a_round_only_writes_what_changed(spark, monkeypatch):
    """A long chain beside a settled crowd: rounds write their one new row, not the distances known before."""
    sizes = []
    kept = graph.materialize_at

    def counting(df, path):
        made = kept(df, path)
        if path.endswith("/better"):
            sizes.append(made.count())
        return made

    monkeypatch.setattr(graph, "materialize_at", counting)
    crowd = [(0, i, 1.0) for i in range(1, 200)]
    chain = [(199 + i, 200 + i, 1.0) for i in range(8)]
    edges = spark.createDataFrame(crowd + chain, "src int, dst int, w double")
    found = graph.distances(edges, spark.createDataFrame([(0,)], "node int"), "w")
    assert found.count() == 208 and sizes == [199] + [1] * 8 + [0]


def test_searches_leave_only_their_result(spark):
    from tallyroute.session import _held, scratch

    before = list(_held)
    edges = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0)], "src int, dst int, w double")
    with scratch(spark):
        assert graph.all_pairs(edges, "w").count() == 6
        assert len(_held) == len(before) + 1
    assert _held == before
