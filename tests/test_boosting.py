"""Boosted trees and their explanations against plain Python of their own."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroute.operators import boosting as b
from tallyroute.operators import model, shapley

FEATURES = ["u", "v", "w"]


def rows_of(n=240, seed=1, missing=0.1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        values = [None if draw.random() < missing else float(draw.randrange(6)) for _ in FEATURES]
        u, v, w = (0 if x is None else x for x in values)
        rows.append((i, *values, int(u + (v > 2) * (2 if w > 3 else -2) + draw.gauss(0, 1.5) > 2)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, u double, v double, w double, y int")


def score(g, h, p):
    return max(abs(g) - p.reg_alpha, 0) ** 2 / (h + p.reg_lambda)


def leaf(g, h, p):
    return -math.copysign(max(abs(g) - p.reg_alpha, 0), g) / (h + p.reg_lambda)


def grow(rows, sums, p, depth):
    """One tree by trying every cut of every feature, missing values to either side; weak splits are taken back from the bottom."""
    g, h = (sum(s[i] for s in sums) for i in range(2))
    best = None
    if depth < p.max_depth:
        for f in range(len(FEATURES)):
            values = sorted({r[f + 1] for r in rows if r[f + 1] is not None})
            for k, cut in enumerate(values):
                for left_missing in (True, False):
                    side = [left_missing if r[f + 1] is None else r[f + 1] <= cut for r in rows]
                    if all(side) or not any(side) or (k == len(values) - 1 and left_missing):
                        continue
                    if not left_missing and not any(r[f + 1] is None for r in rows):
                        continue
                    gl, hl = (sum(s[i] for s, here in zip(sums, side) if here) for i in range(2))
                    if min(hl, h - hl) < p.min_child_weight:
                        continue
                    gain = score(gl, hl, p) + score(g - gl, h - hl, p) - score(g, h, p)
                    rank = (round(gain, 9), -f, -cut, left_missing)
                    if best is None or rank > best[0]:
                        best = (rank, f, cut, left_missing, side, gain)
    value = p.learning_rate * leaf(g, h, p)
    if best is None or best[5] <= b.SMALLEST_GAIN:
        return value
    _, f, cut, left_missing, side, gain = best
    children = [grow([r for r, s in zip(rows, side) if s == want], [x for x, s in zip(sums, side) if s == want], p, depth + 1) for want in (True, False)]
    if not any(isinstance(c, tuple) for c in children) and gain < p.gamma:
        return value
    return (f, cut, left_missing, *children)


def walk(tree, row):
    while isinstance(tree, tuple):
        f, cut, left_missing, left, right = tree
        x = row[f + 1]
        tree = left if (left_missing if x is None else x <= cut) else right
    return tree


def by_definition(rows, p):
    share = sum(r[-1] for r in rows) / len(rows)
    margins = [math.log(share / (1 - share))] * len(rows)
    for _ in range(p.n_estimators):
        chances = [1 / (1 + math.exp(-m)) for m in margins]
        tree = grow(rows, [(c - r[-1], c * (1 - c)) for c, r in zip(chances, rows)], p, 0)
        margins = [m + walk(tree, r) for m, r in zip(margins, rows)]
    return margins


@pytest.mark.parametrize(
    "params",
    [
        b.Params(max_depth=3, n_estimators=1, learning_rate=1.0, reg_lambda=0.5),
        b.Params(max_depth=3, n_estimators=4, learning_rate=0.3, reg_lambda=1.5, reg_alpha=0.4, gamma=0.8, min_child_weight=3),
        b.Params(max_depth=2, n_estimators=10, learning_rate=0.5, gamma=2.5, min_child_weight=6),
    ],
)
def test_trees_equal_brute_force(spark, params):
    rows = rows_of()
    fitted = b.fit(frame(spark, rows), None, FEATURES, "y", params)
    found = {r["id"]: r["m"] for r in frame(spark, rows).select("id", fitted.log_odds().alias("m")).collect()}
    want = by_definition(rows, params)
    assert len(set(map(lambda x: round(x, 6), want))) > 2
    assert max(abs(found[r[0]] - m) for r, m in zip(rows, want)) < 1e-9


def shapley_by_subsets(tree, row, edges):
    """Values of all sets of features by descent through the tree, then the definition over all subsets."""

    def value(node, known):
        if node not in tree.feature:
            return tree.value[node]
        f = tree.feature[node]
        if f in known:
            x = row[f + 1]
            at = edges[f][tree.bin[node]] if tree.bin[node] < len(edges[f]) else math.inf
            left = tree.missing_left[node] if x is None else x <= at
            return value(2 * node + (not left), known)
        shares = [tree.sums[2 * node + i][1] / tree.sums[node][1] for i in range(2)]
        return sum(s * value(2 * node + i, known) for i, s in enumerate(shares))

    n, found = len(FEATURES), []
    for f in range(n):
        others = [k for k in range(n) if k != f]
        total = 0.0
        for size in range(n):
            for known in itertools.combinations(others, size):
                part = math.factorial(size) * math.factorial(n - 1 - size) / math.factorial(n)
                total += part * (value(1, {*known, f}) - value(1, set(known)))
        found.append(total)
    return found


def test_contributions_equal_all_subsets(spark):
    rows = rows_of(seed=5) + [(999, None, None, None, 1), (998, -math.inf, math.inf, 3.0, 0)]
    df = frame(spark, rows)
    fitted = b.fit(df.where("id < 900"), None, FEATURES, "y", b.Params(max_depth=4, n_estimators=6, min_child_weight=0.5))
    made = {r["id"]: r for r in model.contributions(df, fitted, ["id"]).collect()}
    odds = {r["id"]: r["m"] for r in df.select("id", fitted.log_odds().alias("m")).collect()}
    base = shapley.expected(fitted)
    for row in rows[::7] + rows[-2:]:
        want = [sum(parts) for parts in zip(*(shapley_by_subsets(t, row, fitted.edges) for t in fitted.trees))]
        got = [made[row[0]][f] for f in FEATURES]
        assert max(abs(a - c) for a, c in zip(want, got)) < 1e-9
    assert max(abs(sum(made[i][f] for f in FEATURES) + base - odds[i]) for i in odds) < 1e-9
    ranked = model.importance(df, fitted).collect()
    assert [r["importance"] for r in ranked] == sorted((r["importance"] for r in ranked), reverse=True)
    first = model.explain(df, fitted, ["id", "u"]).where("id = 999").first()
    assert first["u"] is None and sorted(e["feature"] for e in first["explanation"]) == FEATURES


def test_stops_early_and_keeps_the_best_rounds(spark):
    rows = rows_of(400, 3)
    df = frame(spark, rows)
    train, val = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    fitted = b.fit(train, val, FEATURES, "y", b.Params(max_depth=4, n_estimators=60, min_child_weight=0.0, reg_lambda=0.01), stop_after=3)
    assert len(fitted.trees) < 60 and len(fitted.aucs) <= len(fitted.trees) + 4
    assert fitted.aucs.index(max(fitted.aucs)) == len(fitted.trees) - 1
    scored = val.select("y", F.round(fitted.probability(), b.AUC_PLACES).alias("p")).collect()
    pairs = [(a["p"], c["p"]) for a in scored for c in scored if a["y"] == 1 and c["y"] == 0]
    exact = sum((p > q) + (p == q) / 2 for p, q in pairs) / len(pairs)
    assert abs(exact - max(fitted.aucs)) < 1e-6


def test_odd_tables(spark):
    kind = "id long, u double, v double, w double, y int"
    one = spark.createDataFrame([(1, 1.0, None, 2.0, 1)] * 5, kind)
    for df in (one, spark.createDataFrame([(1, None, None, None, 0), (2, None, None, None, 1)], kind), spark.createDataFrame([(1, 1.0, 1.0, 1.0, None)], kind)):
        fitted = b.fit(df, None, FEATURES, "y", b.Params(n_estimators=2))
        assert all(0 <= r[0] <= 1 for r in df.select(fitted.probability()).collect())
        assert model.contributions(df, fitted).count() == df.count()
    nan = spark.createDataFrame([(i, float("nan") if i % 2 else 1.0, 0.0, float(i), i % 2) for i in range(40)], kind)
    fitted = b.fit(nan, None, ["u"], "y", b.Params(n_estimators=3, max_depth=2))
    assert {r["y"]: r["p"] > 0.5 for r in nan.select("y", fitted.probability().alias("p")).collect()} == {0: False, 1: True}


def test_saved_and_loaded(spark, tmp_path):
    df = frame(spark, rows_of(120))
    fitted = b.fit(df, None, FEATURES, "y", b.Params(max_depth=3, n_estimators=3))
    b.save(fitted, spark, str(tmp_path / "model"))
    assert b.load(spark, str(tmp_path / "model")) == fitted


def test_search_grows_all_trials_together(spark):
    space = {"max_depth": b.whole(1, 3), "n_estimators": b.whole(2, 6), "learning_rate": b.scaled(0.05, 0.5)}
    df = frame(spark, rows_of(300, 8))
    trials = b.search(df, FEATURES, "y", trials=5, folds=3, space=space, batch=3, first_rung=2, stop_after=2)
    assert [t.number for t in trials] == [0, 1, 2, 3, 4] and all(0.5 < t.auc <= 1 and 1 <= t.rounds <= 6 for t in trials)
    again = b.search(df, FEATURES, "y", trials=5, folds=3, space=space, batch=3, first_rung=2, stop_after=2)
    assert [(t.params, round(t.auc, 9), t.rounds) for t in again] == [(t.params, round(t.auc, 9), t.rounds) for t in trials]
    assert b.best_params(trials) == max(trials, key=lambda t: t.auc).params


def test_later_draws_follow_the_better_trials():
    generator = random.Random(0)
    done = [(b.Params(reg_lambda=0.5 + 1.5 * i / 40), -abs(i - 30)) for i in range(40)]
    drawn = [b.draw_params(done, generator, {"reg_lambda": b.even(0.5, 2.0)}).reg_lambda for _ in range(60)]
    assert abs(sum(drawn) / len(drawn) - (0.5 + 1.5 * 30 / 40)) < 0.25


def test_small_nodes_send_their_rows_and_give_the_same_trees(spark, monkeypatch):
    df, params = frame(spark, rows_of(300, 4)), b.Params(max_depth=4, n_estimators=3, subsample=0.8, colsample_bytree=0.7)
    passes, level = [], b.Grower.level
    monkeypatch.setattr(b.Grower, "level", lambda self, *a: passes.append(a) or level(self, *a))
    whole = b.fit(df, None, FEATURES, "y", params)
    assert len(passes) == 3  # a pass a tree, not one a level
    for limit in (0, 100):
        monkeypatch.setattr(b, "SUBTREE_ROWS", limit)
        by_level = b.fit(df, None, FEATURES, "y", params)
        assert [(t.feature, t.bin, t.missing_left) for t in by_level.trees] == [(t.feature, t.bin, t.missing_left) for t in whole.trees]
        assert all(abs(t.value[n] - u.value[n]) < 1e-9 for t, u in zip(by_level.trees, whole.trees) for n in u.value)
    assert len(passes) > 9


def test_folds_of_one_label_leave_the_others_to_decide(spark):
    rows = [(i, float(i % 7), None, 1.0, int(i in (3, 8))) for i in range(60)]
    (trial,) = b.search(frame(spark, rows), FEATURES, "y", trials=1, folds=5, space={"n_estimators": b.whole(2, 2), "max_depth": b.whole(2, 2)})
    assert 0 <= trial.auc <= 1 and 1 <= trial.rounds <= 2


def test_rows_that_agree_are_kept_once(spark, monkeypatch):
    rows = [(i, float(i % 2), float(i % 5), 1.0 if i % 3 else None, int(i % 2 + i % 5 > 2)) for i in range(4_000)]
    df = frame(spark, rows).coalesce(1)
    (block,) = b.binned(df, FEATURES, "y", b.bin_edges(df, FEATURES), F.pmod(F.col("rid"), F.lit(2))).collect()
    n = np.frombuffer(block.n, np.int32)
    assert n.sum() == 4_000 and len(n) == 20  # combinations of values
    assert sorted(np.frombuffer(block.rid, np.uint32, offset=8)) == list(range(4_000))
    fold, y = np.frombuffer(block.fold, np.int32), np.frombuffer(block.y, np.float64)
    assert n[fold == 1].sum() == 2_000 and (n * y).sum() == sum(r[-1] for r in rows)
    # Trees see the same rows as if each row were kept by itself.
    params = b.Params(max_depth=3, n_estimators=3, subsample=0.7)
    together = b.fit(df, None, FEATURES, "y", params)
    monkeypatch.setattr(b, "alike", lambda columns: (np.arange(len(columns[0])),) * 2)
    apart = b.fit(df, None, FEATURES, "y", params)
    assert [(t.feature, t.bin, t.missing_left) for t in together.trees] == [(t.feature, t.bin, t.missing_left) for t in apart.trees]
    assert all(abs(t.sums[k][0] - u.sums[k][0]) < 1e-6 for t, u in zip(together.trees, apart.trees) for k in u.sums)


def test_rows_are_grouped_whatever_the_number_of_columns():
    draw = np.random.default_rng(1)
    columns = list(draw.integers(-1, 60, (14, 300)))
    columns = [np.concatenate([c, c]) for c in columns]  # more combinations than a 64-bit number holds, each row twice
    order, begin = b.alike(columns)
    assert sorted(order) == list(range(600)) and len(begin) == 300
    groups = {frozenset(g) for g in np.split(order, begin[1:])}
    assert groups == {frozenset((i, i + 300)) for i in range(300)}
