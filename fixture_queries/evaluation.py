"""Evaluation of the fixed-coefficient scores over lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixture_queries.base import RAW_SCORED_SQL, SCORED_SQL, THRESHOLD, query, raw_scored_lineitem, scored_lineitem
from tallyroute.functions import numeric
from tallyroute.operators import evaluate

GRID_SQL = "grid AS (SELECT CAST(0.3 AS DOUBLE) + i * (CAST(0.31 AS DOUBLE) - CAST(0.3 AS DOUBLE)) AS threshold FROM range(45) AS r(i))"
SWEEP_SQL = f"""WITH {SCORED_SQL}, {GRID_SQL},
counts AS (SELECT score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM scored GROUP BY score),
sweep AS (SELECT threshold, CAST(coalesce(sum(p) FILTER (WHERE score >= threshold), 0) AS BIGINT) AS tp,
  CAST(coalesce(sum(n) FILTER (WHERE score >= threshold), 0) AS BIGINT) AS fp,
  CAST(coalesce(sum(p) FILTER (WHERE score < threshold), 0) AS BIGINT) AS fn,
  CAST(coalesce(sum(n) FILTER (WHERE score < threshold), 0) AS BIGINT) AS tn
  FROM grid, counts GROUP BY threshold),
f AS (SELECT *, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1 FROM sweep)"""
CELLS_SQL = f"""WITH {SCORED_SQL}, cells AS (
  SELECT CAST(count(*) FILTER (WHERE label = 1 AND score >= {THRESHOLD}) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (WHERE label = 0 AND score >= {THRESHOLD}) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (WHERE label = 1 AND score < {THRESHOLD}) AS DOUBLE) AS fn,
    CAST(count(*) FILTER (WHERE label = 0 AND score < {THRESHOLD}) AS DOUBLE) AS tn FROM scored)"""
RAW_CELLS_SQL = CELLS_SQL.replace(SCORED_SQL, RAW_SCORED_SQL)
AUC_SQL = """ranks AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scored),
auc AS (SELECT (sum(r) FILTER (WHERE label = 1) - CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) * (count(*) FILTER (WHERE label = 1) + 1) / 2)
  / (CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) * count(*) FILTER (WHERE label = 0)) AS a FROM ranks)"""


@query(
    "threshold_sweep",
    f"{SWEEP_SQL} SELECT round(threshold, 6) AS threshold, tp, fp, fn, tn, round(f1, 6) AS f1 FROM f",
)
def threshold_sweep(spark, sf):
    swept = evaluate.threshold_sweep(scored_lineitem(spark, sf), "label", "score")
    return swept.withColumns({"threshold": F.round("threshold", 6), "f1": F.round("f1", 6)})


@query(
    "best_threshold",
    f"{SWEEP_SQL} SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM f ORDER BY f.f1 DESC, f.threshold LIMIT 1",
)
def best_threshold(spark, sf):
    swept = evaluate.threshold_sweep(scored_lineitem(spark, sf), "label", "score")
    return evaluate.best_threshold(swept).select(F.round("threshold", 6).alias("threshold"), F.round("f1", 6).alias("f1"))


@query(
    "accuracy_and_f1",
    f"""{CELLS_SQL} SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
  round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM cells""",
)
def accuracy_and_f1(spark, sf):
    metrics = evaluate.binary_metrics(scored_lineitem(spark, sf), "label", "score", THRESHOLD)
    return metrics.select(F.round("accuracy", 6).alias("accuracy"), F.round("f1", 6).alias("f1"))


def _labelled(spark, sf):
    return scored_lineitem(spark, sf).withColumn("prediction", numeric.at_least(F.col("score"), THRESHOLD))


@query(
    "confusion_matrix",
    f"""{CELLS_SQL} SELECT 0 AS actual, 0 AS predicted, CAST(tn AS BIGINT) AS count FROM cells
UNION ALL SELECT 0, 1, CAST(fp AS BIGINT) FROM cells UNION ALL SELECT 1, 0, CAST(fn AS BIGINT) FROM cells
UNION ALL SELECT 1, 1, CAST(tp AS BIGINT) FROM cells""",
)
def confusion_matrix(spark, sf):
    return evaluate.confusion(_labelled(spark, sf), "label", "prediction")


@query(
    "class_report",
    f"""{CELLS_SQL}, c AS (SELECT tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fn + fp) AS f0,
  tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fp + fn) AS f1, tn + fp AS s0, tp + fn AS s1,
  (tp + tn) / (tp + tn + fp + fn) AS acc FROM cells),
lines AS (
SELECT 'Not Placed' AS line, p0 AS p, r0 AS r, f0 AS f, s0 AS s FROM c
UNION ALL SELECT 'Placed', p1, r1, f1, s1 FROM c
UNION ALL SELECT 'accuracy', acc, acc, acc, s0 + s1 FROM c
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM c
UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
  (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM c)
SELECT line, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(s AS BIGINT) AS support FROM lines""",
)
def class_report(spark, sf):
    report = evaluate.class_report(_labelled(spark, sf), "label", "prediction")
    return report.withColumns({m: F.round(m, 6) for m in ("precision", "recall", "f1")})


@query("roc_auc", f"WITH {RAW_SCORED_SQL}, {AUC_SQL} SELECT round(a, 9) AS roc_auc FROM auc")
def roc_auc(spark, sf):
    auc = evaluate.roc_auc(raw_scored_lineitem(spark, sf), "label", "score")
    return auc.select(F.round("roc_auc", 9).alias("roc_auc"))


@query(
    "roc_points",
    f"""WITH {RAW_SCORED_SQL}, counts AS (
  SELECT score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM scored GROUP BY score),
t AS (SELECT CAST(sum(p) AS DOUBLE) AS p, CAST(sum(n) AS DOUBLE) AS n FROM counts)
SELECT CAST(2 AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
UNION ALL SELECT score, round(sum(counts.n) OVER (ORDER BY score DESC) / t.n, 9),
  round(sum(counts.p) OVER (ORDER BY score DESC) / t.p, 9) FROM counts, t""",
)
def roc_points(spark, sf):
    points = evaluate.roc_points(raw_scored_lineitem(spark, sf), "label", "score")
    finite = F.when(F.col("threshold") == float("inf"), 2.0).otherwise(F.col("threshold"))
    return points.select(finite.alias("threshold"), F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


@query(
    "metrics_record",
    f"""{RAW_CELLS_SQL}, {AUC_SQL} SELECT 'val' AS split, CAST({THRESHOLD} AS DOUBLE) AS threshold,
  round((tp + tn) / (tp + tn + fp + fn), 4) AS accuracy, round(2 * tp / (2 * tp + fp + fn), 4) AS f1,
  round(a, 4) AS roc_auc FROM cells, auc""",
)
def metrics_record(spark, sf):
    return evaluate.metrics_record(raw_scored_lineitem(spark, sf), "label", "score", THRESHOLD, "val")
