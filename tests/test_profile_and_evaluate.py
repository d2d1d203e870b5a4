import math
import random

import pytest
from pyspark.sql import functions as F

from tallyroute.operators import evaluate, profile, schema


def test_empty_table_gives_zeros(spark):
    df = spark.createDataFrame([], "placed int, cgpa double, branch string")
    assert tuple(profile.overview(df, "placed", ["cgpa"]).first()) == (0, 0.0, 0.0)
    assert tuple(profile.target_counts(df, "placed").first()) == (0, 0, 0)
    assert tuple(profile.class_balance(df, "placed").first()) == (0, 0, 0)
    assert profile.distribution(df, "branch").count() == 0


def test_null_targets_count_differently(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "placed int")
    assert tuple(profile.target_counts(df, "placed").first()) == (3, 1, 2)
    assert tuple(profile.class_balance(df, "placed").first()) == (1, 1, 3)


def test_distribution_shows_null_and_breaks_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,)], "x string")
    assert [tuple(r) for r in profile.distribution(df, "x").collect()] == [("Unknown", 2), ("a", 1), ("b", 1)]
    assert [r["percent"] for r in profile.distribution_percent(df, "x").collect()] == [50.0, 25.0, 25.0]


def test_correlation_handles_constants_and_nulls(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 9.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    cells = {(r["column_x"], r["column_y"]): r["correlation"] for r in profile.correlation_matrix(df, ["a", "b", "c", "zz"]).collect()}
    xs, ys = [1, 2, 4], [2, 4, 9]
    mx, my = sum(xs) / 3, sum(ys) / 3
    r = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / math.sqrt(
        sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys)
    )
    assert len(cells) == 9 and cells["a", "b"] == cells["b", "a"] == round(r, 6)
    assert cells["a", "c"] == 0.0 and cells["c", "c"] == 1.0


def test_linear_fit_without_variation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    row = profile.linear_fit(df, "x", "y").first()
    assert row["n"] == 2 and row["slope"] is None and row["correlation"] is None


def test_column_stats_and_odd_names(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (3, 4.0, "b")], "`c++_skill` int, y double, s string")
    assert schema.numeric_columns(df) == ["c++_skill", "y"]
    stats = {r["column"]: tuple(r)[1:] for r in profile.column_stats(df, ["c++_skill", "y"]).collect()}
    assert stats["c++_skill"] == (2.0, 1.4142, 1.0, 3.0)


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    assert schema.fitted(df, ["a", "b"], exact=True).columns == ["a", "b"]
    assert schema.fitted(df, ["a"]).columns == ["b", "a"]
    for declared, exact, absent, surplus in [(["a", "b", "c"], True, ["c"], []), (["a"], True, [], ["b"]), (["z"], False, ["z"], ["a", "b"])]:
        with pytest.raises(schema.ColumnMismatch, match="differ from the declaration") as error:
            schema.fitted(df, declared, exact=exact)
        assert (error.value.absent, error.value.surplus) == (absent, surplus)


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_and_roc_against_all_pairs(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), round(rng.random(), 2)) for _ in range(400)]
    # One score holds a third of all rows.
    rows += [(rng.randint(0, 1), 0.37) for _ in range(200)]
    auc = evaluate.roc_auc(scored(spark, rows), "label", "score").first()["roc_auc"]
    assert auc == pytest.approx(brute_auc(rows), abs=1e-12)
    flipped = [(y, 1 - s) for y, s in rows]
    assert evaluate.roc_auc(scored(spark, flipped), "label", "score").first()["roc_auc"] == pytest.approx(1 - auc)

    points = evaluate.roc_points(scored(spark, rows), "label", "score").orderBy(F.desc("threshold")).collect()
    assert (points[0]["fpr"], points[0]["tpr"]) == (0.0, 0.0) and (points[-1]["fpr"], points[-1]["tpr"]) == (1.0, 1.0)
    area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(auc)


def test_auc_needs_both_classes(spark):
    assert evaluate.roc_auc(scored(spark, [(1, 0.2), (1, 0.3)]), "label", "score").first()["roc_auc"] is None


def test_sweep_against_a_loop(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 1), rng.random()) for _ in range(300)] + [(1, evaluate.THRESHOLDS[6]), (0, 0.36)]
    swept = evaluate.threshold_sweep(scored(spark, rows), "label", "score")
    got = {r["threshold"]: r for r in swept.collect()}
    assert len(got) == 45
    best = (0.0, 0.5)
    for t in evaluate.THRESHOLDS:
        tp = sum(y == 1 and s >= t for y, s in rows)
        fp = sum(y == 0 and s >= t for y, s in rows)
        fn = sum(y == 1 and s < t for y, s in rows)
        row = got[t]
        assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (tp, fp, fn, len(rows) - tp - fp - fn)
        f1 = 2 * tp / (2 * tp + fp + fn)
        assert row["f1"] == pytest.approx(f1)
        if f1 > best[0]:
            best = (f1, t)
    chosen = evaluate.best_threshold(swept).first()
    assert chosen["threshold"] == best[1]
    assert evaluate.THRESHOLDS[6] == 0.36000000000000004


def test_sweep_without_positives_falls_back(spark):
    swept = evaluate.threshold_sweep(scored(spark, [(0, 0.9), (1, 0.1)]), "label", "score")
    assert tuple(evaluate.best_threshold(swept).first()) == (0.5, 0.0)
    empty = evaluate.threshold_sweep(scored(spark, []), "label", "score")
    assert empty.count() == 45 and tuple(evaluate.best_threshold(empty).first()) == (0.5, 0.0)


def test_confusion_keeps_zero_cells_and_report_divides_by_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "y int, p int")
    assert [r["count"] for r in evaluate.confusion(df, "y", "p").collect()] == [1, 0, 1, 0]
    report = {r["line"]: r for r in evaluate.class_report(df, "y", "p").collect()}
    assert report["Placed"]["precision"] == 0.0 and report["Not Placed"]["recall"] == 1.0
    assert report["accuracy"]["f1"] == 0.5 and report["weighted avg"]["support"] == 2
