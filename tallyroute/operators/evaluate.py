"""Evaluation of a (label, score) table. Scores are compared as they are.

Everything is reduced to counts first: per threshold bin, per confusion cell, or per distinct
score. Nothing is joined or sorted row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroute.functions import numeric
from tallyroute.operators.ordering import partition_of, running_totals
from tallyroute.operators.schema import col
from tallyroute.session import materialize

# 45 thresholds from 0.30 in steps of (0.31 - 0.30), in binary arithmetic.
THRESHOLDS = tuple(0.3 + i * (0.31 - 0.3) for i in range(45))
DEFAULT_THRESHOLD = 0.5
CLASS_NAMES = ("Not Placed", "Placed")


def _positives(label: str) -> Column:
    return F.count_if(col(label) == 1)


def _negatives(label: str) -> Column:
    return F.count_if(col(label) == 0)


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return numeric.ratio(tp * F.lit(2), tp * F.lit(2) + fp + fn)


def threshold_sweep(
    df: DataFrame, label: str, score: str, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """threshold, tp, fp, fn, tn, f1 for each of the ascending thresholds.

    A row falls into the bin of the highest threshold it reaches; counts per bin, at most
    len(thresholds) + 1 rows, are then summed from above. No row meets more than its bin.
    """
    steps = list(thresholds)
    measured = df.groupBy(numeric.steps_reached(col(score), steps).alias("bin")).agg(
        _positives(label).alias("p"), _negatives(label).alias("n")
    )
    # Every bin gets a line, also one that no score falls into.
    zero = F.lit(0).cast("long")
    empty = df.sparkSession.range(len(steps) + 1).select(
        F.col("id").cast("int").alias("bin"), zero.alias("p"), zero.alias("n")
    )
    bins = measured.unionByName(empty).groupBy("bin").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    reached = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy()
    lines = bins.select(
        "bin",
        F.sum("p").over(reached).alias("tp"),
        F.sum("n").over(reached).alias("fp"),
        F.sum("p").over(every).alias("p"),
        F.sum("n").over(every).alias("n"),
    ).filter(F.col("bin") > 0)
    grid = F.array(*[F.lit(float(t)) for t in steps])
    swept = lines.select(
        F.element_at(grid, F.col("bin")).alias("threshold"),
        "tp",
        "fp",
        (F.col("p") - F.col("tp")).alias("fn"),
        (F.col("n") - F.col("fp")).alias("tn"),
    )
    return swept.withColumn("f1", _f1(F.col("tp"), F.col("fp"), F.col("fn")))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """One row: threshold, f1. The lowest of the best wins; 0.5 when every F1 is zero."""
    best = sweep.agg(F.max(F.struct("f1", (-F.col("threshold")).alias("low"))).alias("b"))
    f1 = F.coalesce(F.col("b.f1"), F.lit(0.0))
    return best.select(
        F.when(f1 > 0, -F.col("b.low")).otherwise(F.lit(DEFAULT_THRESHOLD)).alias("threshold"), f1.alias("f1")
    )


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """actual, predicted, count over the full 2 x 2 grid, zeros kept."""
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    row = df.agg(
        *[F.count_if((col(label) == a) & (col(prediction) == p)).alias(f"c{a}{p}") for a, p in cells]
    )
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{a}{p}").alias("count")
                    )
                    for a, p in cells
                ]
            )
        )
    )


def _cells(df: DataFrame, label: str, prediction: str) -> DataFrame:
    positive = col(prediction) == 1
    return df.filter(col(label).isin(0, 1) & col(prediction).isin(0, 1)).agg(
        F.count_if((col(label) == 1) & positive).alias("tp"),
        F.count_if((col(label) == 0) & positive).alias("fp"),
        F.count_if((col(label) == 1) & ~positive).alias("fn"),
        F.count_if((col(label) == 0) & ~positive).alias("tn"),
    )


def binary_metrics(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """One row: accuracy, f1 at a threshold; zero where undefined."""
    labelled = df.withColumn("_prediction", numeric.at_least(col(score), threshold))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return _cells(labelled, label, "_prediction").select(
        numeric.ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), _f1(tp, fp, fn).alias("f1")
    )


def class_report(
    df: DataFrame, label: str, prediction: str, names: Sequence[str] = CLASS_NAMES
) -> DataFrame:
    """line, precision, recall, f1, support per class, then accuracy, macro avg, weighted avg."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    zero = {"precision": numeric.ratio(tn, tn + fn), "recall": numeric.ratio(tn, tn + fp), "f1": _f1(tn, fn, fp)}
    one = {"precision": numeric.ratio(tp, tp + fp), "recall": numeric.ratio(tp, tp + fn), "f1": _f1(tp, fp, fn)}
    support = [tn + fp, tp + fn]
    total = tp + fp + fn + tn
    measures = ("precision", "recall", "f1")

    def line(title: str, values: dict, count: Column) -> Column:
        return F.struct(
            F.lit(title).alias("line"), *[values[m].cast("double").alias(m) for m in measures], count.alias("support")
        )

    accuracy = numeric.ratio(tp + tn, total)
    macro = {m: (zero[m] + one[m]) / 2 for m in measures}
    weighted = {m: numeric.ratio(zero[m] * support[0] + one[m] * support[1], total) for m in measures}
    lines = [
        line(names[0], zero, support[0]),
        line(names[1], one, support[1]),
        line("accuracy", {m: accuracy for m in measures}, total),
        line("macro avg", macro, total),
        line("weighted avg", weighted, total),
    ]
    return _cells(df, label, prediction).select(F.inline(F.array(*lines)))


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """score, pos, neg per distinct score, counted before the shuffle; unscored rows are left out."""
    usable = df.filter(numeric.is_finite(col(score)) & col(label).isin(0, 1))
    # Adding 0.0 folds the negative zero into the positive one.
    return usable.groupBy((col(score).cast("double") + F.lit(0.0)).alias("score")).agg(
        _positives(label).alias("pos"), _negatives(label).alias("neg")
    )


def _cumulative(df: DataFrame, label: str, score: str) -> DataFrame:
    """The counts with upto_pos and upto_neg, from the highest score down.

    They are range-partitioned by score and written in order; the partitions are the buckets of
    the running totals, so any number of distinct scores is spread over the tasks.
    """
    place = F.monotonically_increasing_id()
    counts = score_counts(df, label, score).orderBy(F.desc("score")).withColumn("_place", place)
    return running_totals(materialize(counts, "score_counts"), partition_of("_place"), F.col("_place").asc(), ["pos", "neg"])


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: roc_auc, exact with ties counted half; null when a class is missing."""
    runs = _cumulative(df, label, score)
    # Pairs won: positives of a score against all negatives below it, ties half, doubled to
    # stay whole. Decimal keeps the product of two large counts exact.
    wide = "decimal(20,0)"
    totals = runs.agg(
        F.sum("pos").cast("double").alias("p"),
        F.sum("neg").cast("double").alias("n"),
        F.sum(
            F.col("pos").cast(wide) * (F.col("upto_neg") * 2 - F.col("neg")).cast("decimal(18,0)")
        ).alias("lost2"),
    )
    pairs = F.col("p") * F.col("n")
    return totals.select(
        F.when(pairs > 0, F.lit(1.0) - F.try_divide(F.col("lost2").cast("double"), pairs * 2)).alias("roc_auc")
    )


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """threshold, fpr, tpr for every distinct score, from (0, 0) at threshold infinity."""
    runs = _cumulative(df, label, score)
    totals = runs.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    origin = totals.select(
        F.lit(float("inf")).alias("score"), F.lit(0).cast("long").alias("upto_pos"), F.lit(0).cast("long").alias("upto_neg")
    )
    p, n = totals.select("p").scalar(), totals.select("n").scalar()
    return origin.unionByName(runs.select(*origin.columns)).select(
        F.col("score").alias("threshold"),
        numeric.ratio(F.col("upto_neg"), n).alias("fpr"),
        numeric.ratio(F.col("upto_pos"), p).alias("tpr"),
    )


def metrics_record(df: DataFrame, label: str, score: str, threshold: float, split: str, digits: int = 4) -> DataFrame:
    """One row: split, threshold, accuracy, f1, roc_auc, rounded for the metadata record."""
    auc = roc_auc(df, label, score).scalar()
    return binary_metrics(df, label, score, threshold).select(
        F.lit(split).alias("split"),
        F.lit(float(threshold)).alias("threshold"),
        F.round("accuracy", digits).alias("accuracy"),
        F.round("f1", digits).alias("f1"),
        F.round(auc, digits).alias("roc_auc"),
    )
