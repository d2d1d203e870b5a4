from itertools import product

import pytest
from pyspark.sql import functions as F

from tallyroute.llm import mixing


def flow_cost(patterns, sent, repeats):
    """(tokens, cost) of a flow, every pattern filling its repetitions one after another."""
    total = cost = 0
    for (_, size), flow in zip(patterns, sent, strict=True):
        amount = sum(flow.values())
        total += amount
        cost += sum(max(0, min(size, amount - k * size)) * k for k in range(repeats))
    return total, cost


@pytest.mark.parametrize(
    "patterns, quotas",
    [
        ([(("a",), 2), (("b",), 2), (("a", "b"), 2)], {"a": 4, "b": 2}),
        ([(("a", "b"), 3), (("b",), 1)], {"a": 2, "b": 4}),
        ([(("a",), 1), (("a", "b"), 2), (("b", "c"), 1)], {"a": 3, "b": 1, "c": 3}),
        ([(("a",), 0), (("b",), 2)], {"a": 3, "b": 9}),
        ([], {"a": 1}),
    ],
)
def test_flow_is_largest_and_cheapest(patterns, quotas):
    sent = mixing.cheapest_flow(patterns, quotas, 3)
    for (members, size), flow in zip(patterns, sent, strict=True):
        assert set(flow) <= set(members) and sum(flow.values()) <= 3 * size
    assert all(sum(f.get(s, 0) for f in sent) <= q for s, q in quotas.items())
    arcs = [(p, s) for p, (members, _) in enumerate(patterns) for s in members]
    best = (0, 0)
    for amounts in product(*(range(min(3 * patterns[p][1], quotas[s]) + 1) for p, s in arcs)):
        tried = [{} for _ in patterns]
        for (p, s), amount in zip(arcs, amounts, strict=True):
            tried[p][s] = amount
        fits = all(sum(f.values()) <= 3 * size for (_, size), f in zip(patterns, tried, strict=True))
        if fits and all(sum(f.get(s, 0) for f in tried) <= q for s, q in quotas.items()):
            total, cost = flow_cost(patterns, tried, 3)
            best = max(best, (total, -cost))
    total, cost = flow_cost(patterns, sent, 3)
    assert (total, -cost) == best


def test_targets_share_what_full_sources_leave():
    goal = mixing.targets({"a": 1, "b": 10, "c": 29}, {"a": 3, "b": 1, "c": 1}, 3)
    assert goal == {"a": 3.0, "b": 18.5, "c": 18.5}
    assert mixing.targets({}, {}, 3) == {}
    assert mixing.targets({"a": 0}, {"a": 1}, 3) == {"a": 0.0}


def rows_of(docs, membership, weigh, **options):
    rows, plan = mixing.mix(docs, membership, weigh, **options)
    return [(r.row, r["size"], {t.source: t.words for t in r.takes}) for r in rows.collect()], plan


def test_overlapping_sources_meet_their_quotas(spark):
    members = [["a"], ["b"], ["a", "b"], ["b", "c"], [], None, ["c", "c"], [None]]
    docs = spark.createDataFrame([(i, f"w{i} " * (1 + i % 7), members[i % 8]) for i in range(400)], "doc_id long, text string, sources array<string>")
    rows, plan = rows_of(docs, F.col("sources"), mixing.repeating([1, 2, 3]))
    for source, goal in plan.targets.items():
        assert sum(takes.get(source, 0) for _, _, takes in rows) == pytest.approx(goal, abs=1)
    for row, size, takes in rows:
        assert sum(takes.values()) <= 3 * size
        assert set(takes) <= set(row.sources or [])
    again, _ = rows_of(docs.repartition(7), F.col("sources"), mixing.repeating([1, 2, 3]))
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_odd_rows(nasty):
    rows, plan = rows_of(nasty, F.array("source"), mixing.repeating([1]))
    assert len(rows) == 9 and plan.targets == {"s": 60_000 + 2 + 8 + 5.0}
    assert sum(sum(t.values()) for _, _, t in rows) == plan.targets["s"]
    assert all(not t for r, size, t in rows if r.doc_id in (1, 2, 3))
    empty, plan = rows_of(nasty.limit(0), F.array("source"), mixing.repeating([1]))
    assert empty == [] and plan.targets == {}


def test_documents_are_repeated_whole(texts):
    docs = texts([(i, f"word{i} " * 10) for i in range(30)]).withColumn("source", F.when(F.col("doc_id") < 5, F.lit("a")).when(F.col("doc_id") < 20, F.lit("b")))
    made = mixing.mixed_documents(docs, F.array("source"), lambda names: dict(zip(names, (4, 1, 1), strict=True)))
    assert made.columns == docs.columns
    counts = {(r.source, r.doc_id): r["count"] for r in made.groupBy("source", "doc_id").count().collect()}
    assert all(counts[("a", i)] == 3 for i in range(5))  # the target of a is three times its size
    assert sum(n for (s, _), n in counts.items() if s == "b") == pytest.approx(7.5, abs=1)


@pytest.mark.parametrize("digits", [1, 3])
def test_borders_follow_the_order_of_ranks(spark, monkeypatch, digits):
    monkeypatch.setattr(mixing, "STEP_DIGITS", digits)
    docs = spark.createDataFrame([(i // 2 if i < 20 else i, f"w{i // 2 if i < 20 else i} " * (i // 2 % 5)) for i in range(300)], "doc_id long, text string")
    narrow = mixing.sized(docs, F.array(F.lit("s")), "doc_id", "text", "seed").select("pattern", "size", "rank")
    ordered = sorted((r["rank"], r["size"], r.pattern) for r in narrow.collect() if r["size"])
    holder = []
    for rank in sorted({rank for rank, _, _ in ordered}):
        sizes = [size for other, size, _ in ordered if other == rank]
        holder += [(rank, at // len(sizes)) for at in range(sum(sizes))]  # equal rows share the words up to the border
    pattern = ordered[0][2]
    wanted = list(range(0, len(holder), 7))
    found = mixing._borders(spark, narrow, [(pattern, at) for at in wanted])
    assert [found[pattern, at] for at in wanted] == [holder[at] for at in wanted]


def test_equal_rows_come_near_their_target(texts):
    """A thousand rows equal in key and text at a border: each gives an equal part of the words."""
    rows = [(1, "same " * 100)] * 1_000 + [(2, "other " * 50_000)]
    docs = texts(rows).withColumn("source", F.when(F.col("doc_id") == 1, F.lit("a")).otherwise(F.lit("b")))
    made, plan = mixing.mix(docs, F.array("source"), lambda names: dict(zip(names, (4, 5), strict=True)))
    taken = {r.doc_id: r.words for r in made.select("row.doc_id", F.explode("takes").alias("t")).groupBy("doc_id").agg(F.sum("t.words").alias("words")).collect()}
    assert abs(taken[1] - plan.targets["a"]) < 1_000 and abs(taken[2] - plan.targets["b"]) < 1
