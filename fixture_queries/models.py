"""Explanations with fixed coefficients, and fitted models (checked by closed forms and by properties)."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fixture_queries.base import MODEL, query, table
from tallyroute.operators import boosting, model, shapley, split
from tallyroute.plans import student
from tallyroute.session import materialize, scratch_path
from tallyroute.sources import csvfiles, metadata

PHI_SQL = """phi AS (SELECT l_orderkey, l_partkey, l_suppkey,
  CAST(0.04 AS DOUBLE) * (l_quantity - CAST(25.5 AS DOUBLE)) AS q,
  CAST(-4.0 AS DOUBLE) * (l_discount - CAST(0.05 AS DOUBLE)) AS d,
  CAST(3.0 AS DOUBLE) * (l_tax - CAST(0.04 AS DOUBLE)) AS t FROM lineitem)"""
LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey"]


@query(
    "contribution_columns",
    f"""WITH {PHI_SQL} SELECT l_orderkey, l_partkey, l_suppkey, round(q, 6) + 0.0 AS l_quantity,
  round(d, 6) + 0.0 AS l_discount, round(t, 6) + 0.0 AS l_tax FROM phi""",
)
def contribution_columns(spark, sf):
    wide = model.contributions(table(spark, sf, "lineitem"), MODEL, LINE_KEY)
    path = scratch_path(spark, "contributions")
    csvfiles.write_snappy(wide, path)
    stored = spark.read.parquet(path)
    return stored.select(*LINE_KEY, *[(F.round(f, 6) + F.lit(0.0)).alias(f) for f in MODEL.features])


@query(
    "ranked_explanations",
    f"""WITH {PHI_SQL}, long AS (
  SELECT l_orderkey, l_partkey, l_suppkey, q, d, t,
    unnest(['l_quantity', 'l_discount', 'l_tax']) AS feature, unnest([0, 1, 2]) AS place,
    unnest([round(q, 4), round(d, 4), round(t, 4)]) AS v FROM phi)
SELECT l_orderkey, l_partkey, l_suppkey,
  string_agg(feature || '=' || printf('%.4f', v + 0.0), ',' ORDER BY abs(v) DESC, place) AS explanation
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey, place ORDER BY q, d, t) AS copy FROM long)
GROUP BY l_orderkey, l_partkey, l_suppkey, copy""",
)
def ranked_explanations(spark, sf):
    explained = model.explain(table(spark, sf, "lineitem"), MODEL, LINE_KEY)
    shown = F.transform(
        "explanation", lambda e: F.concat(e["feature"], F.lit("="), e["value"].cast("decimal(12,4)").cast("string"))
    )
    return explained.select(*LINE_KEY, F.array_join(shown, ",").alias("explanation"))


@query(
    "feature_importance",
    f"""WITH {PHI_SQL} SELECT 'l_quantity' AS feature, round(avg(abs(q)), 9) AS importance FROM phi
UNION ALL SELECT 'l_discount', round(avg(abs(d)), 9) FROM phi UNION ALL SELECT 'l_tax', round(avg(abs(t)), 9) FROM phi""",
)
def feature_importance(spark, sf):
    ranked = model.importance(table(spark, sf, "lineitem"), MODEL)
    return ranked.withColumn("importance", F.round("importance", 9))


DOCUMENT_FEATURES = ["n_chars", "n_words", "n_lines", "digit_share", "upper_share", "lang_code"]


def measured_documents(spark, sf):
    """Whole-text measures of every document, written once."""
    text = F.col("text")
    size = F.greatest(F.length(text), F.lit(1))
    languages = {"en": 0, "de": 1, "fr": 2, "es": 3}
    measured = table(spark, sf, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(text, r"\s+")).cast("double").alias("n_words"),
        F.size(F.split(text, "\n")).cast("double").alias("n_lines"),
        (F.length(F.regexp_replace(text, r"[^0-9]", "")) / size).alias("digit_share"),
        (F.length(F.regexp_replace(text, r"[^\p{Lu}]", "")) / size).alias("upper_share"),
        F.create_map(*[F.lit(x) for pair in languages.items() for x in pair])[F.col("lang")]
        .cast("double")
        .alias("lang_code"),
    )
    return materialize(measured, "measured")


def judged_documents(spark, sf, measured=None):
    """The measured documents that have a quality label: the training rows."""
    rows = measured_documents(spark, sf) if measured is None else measured
    return rows.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")


def _document_splits(spark, sf, measured=None):
    table_ = materialize(split.exact_split(judged_documents(spark, sf, measured), ["doc_id"]), "judged")
    return {n: table_.filter(F.col("split") == n).drop("split") for n in ("train", "val", "test")}


@query(
    "boosted_scores",
    """SELECT doc_id, true AS score_in_range, true AS prediction_follows, true AS without_error FROM documents""",
)
def boosted_scores(spark, sf):
    """Every document scored by trees that were trained on the labelled ones: properties of each row."""
    measured = measured_documents(spark, sf)
    splits = _document_splits(spark, sf, measured)
    fitted = model.fit_boosted(splits["train"], splits["val"], DOCUMENT_FEATURES, "quality", maxIter=10, maxDepth=3)
    raw = model.positive_probability()
    scored = fitted.transform(measured).select("doc_id", *model.result_columns(raw, F.lit(None).cast("string"), 0.5))
    return scored.select(
        "doc_id",
        F.col("probability").between(0, 1).alias("score_in_range"),
        (((F.col("probability") > 0.5).cast("int") == F.col("prediction")) | (F.col("probability") == 0.5)).alias("prediction_follows"),
        F.col("error").isNull().alias("without_error"),
    )


STUMP_SQL = """WITH t AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, CAST(l_quantity > 25 AS INTEGER) AS x FROM lineitem),
m AS (SELECT x, avg(CAST(y AS DOUBLE)) AS p FROM t GROUP BY x)"""


def _one_feature(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.select((F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_quantity") > 25).cast("int").alias("x"))


@query("stump_probabilities", f"{STUMP_SQL} SELECT x, round(1 / (1 + exp(-2 * (2 * p - 1))), 6) AS probability FROM m")
def stump_probabilities(spark, sf):
    """One tree of depth 1 on a 0/1 feature: a leaf gives the mean of 2y - 1, the score its logistic of twice that."""
    rows = _one_feature(spark, sf)
    fitted = model.fit_boosted(rows, rows, ["x"], "y", maxIter=1, maxDepth=1)
    shown = fitted.transform(rows.select("x").distinct())
    return shown.select("x", F.round(model.positive_probability(), 6).alias("probability"))


@query(
    "one_feature_log_odds",
    f"""{STUMP_SQL}, o AS (SELECT max(ln(p / (1 - p))) FILTER (WHERE x = 1) AS one, max(ln(p / (1 - p))) FILTER (WHERE x = 0) AS zero FROM m)
SELECT round(one - zero, 3) AS weight, round(zero, 3) AS intercept, (SELECT round(avg(x), 6) FROM t) AS mean FROM o""",
)
def one_feature_log_odds(spark, sf):
    """Unpenalised logistic regression on a 0/1 feature has a closed form: log-odds and their difference."""
    fitted = model.fit_logistic(_one_feature(spark, sf), ["x"], "y", maxIter=100, tol=1e-10)
    row = (round(fitted.weights["x"], 3), round(fitted.intercept, 3), round(fitted.means["x"], 6))
    return spark.createDataFrame([row], "weight double, intercept double, mean double")


@query(
    "feature_vectors",
    """SELECT l_orderkey, l_partkey, l_suppkey, coalesce(CAST(l_quantity AS VARCHAR), 'NaN') IS NOT NULL AS complete,
  l_quantity AS v0, l_discount AS v1, l_tax AS v2 FROM lineitem""",
)
def feature_vectors(spark, sf):
    """Rows as vectors in the order of the features."""
    vectors = model.assembler(["l_quantity", "l_discount", "l_tax"]).transform(table(spark, sf, "lineitem"))
    values = vector_to_array(F.col("features"))
    return vectors.select(*LINE_KEY, (F.size(values) == 3).alias("complete"), *[values[i].alias(f"v{i}") for i in range(3)])


@query(
    "boosted_importance",
    "SELECT unnest(['n_chars', 'n_words', 'n_lines', 'digit_share', 'upper_share', 'lang_code']) AS feature, true AS in_range, true AS sums_to_one",
)
def boosted_importance(spark, sf):
    """Importance of every feature of boosted trees: each in range, one in all."""
    splits = _document_splits(spark, sf)
    fitted = model.fit_boosted(splits["train"], splits["val"], DOCUMENT_FEATURES, "quality", maxIter=20, maxDepth=5)
    shown = model.tree_importance(fitted, DOCUMENT_FEATURES, spark)
    total = shown.agg(F.sum("importance")).first()[0]
    return shown.select("feature", F.col("importance").between(0, 1).alias("in_range"), F.lit(abs(total - 1) < 1e-9).alias("sums_to_one"))


FLAGS = {"high_quantity": ("l_quantity", 25), "high_discount": ("l_discount", 0.05), "high_tax": ("l_tax", 0.04)}


@query(
    "stump_importance",
    """WITH t AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, l_quantity > 25 AS q, l_discount > 0.05 AS d, l_tax > 0.04 AS t FROM lineitem),
long AS (SELECT y, unnest(['high_quantity', 'high_discount', 'high_tax']) AS feature, unnest([q, d, t]) AS x FROM t),
gains AS (SELECT feature, avg(CAST(x AS INTEGER)) * avg(1 - CAST(x AS INTEGER)) * power(avg(y) FILTER (WHERE x) - avg(y) FILTER (WHERE NOT x), 2) AS gain
  FROM long GROUP BY feature)
SELECT feature, CASE WHEN gain = max(gain) OVER () THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS importance FROM gains""",
)
def stump_importance(spark, sf):
    """One split goes to the flag that parts the label's variance best, which then has all the importance."""
    flags = [(F.col(column) > bound).cast("int").alias(name) for name, (column, bound) in FLAGS.items()]
    rows = table(spark, sf, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y"), *flags)
    fitted = model.fit_boosted(rows, rows, list(FLAGS), "y", maxIter=1, maxDepth=1)
    return model.tree_importance(fitted, list(FLAGS), spark)


@query(
    "logistic_coefficients",
    """SELECT feature, true AS at_optimum, round(mean, 6) AS mean FROM (SELECT unnest(['l_quantity', 'l_discount', 'l_tax']) AS feature,
  unnest([avg(l_quantity), avg(l_discount), avg(l_tax)]) AS mean FROM lineitem)""",
)
def logistic_coefficients(spark, sf):
    """The loss is convex, so the coefficients are right where its slope over all rows is zero along every one of them."""
    lines = table(spark, sf, "lineitem").withColumn("placed", (F.col("l_returnflag") == "R").cast("int"))
    fitted = model.fit_logistic(lines, MODEL.features, "placed", maxIter=100, tol=1e-12)
    left = F.col("placed") - fitted.probability()
    slopes = [F.abs(F.avg(left * F.col(f))) + F.abs(F.avg(left)) for f in fitted.features]
    cells = [
        F.struct(F.lit(f).alias("feature"), (slope < 1e-4).alias("at_optimum"), F.round(F.lit(fitted.means[f]), 6).alias("mean"))
        for f, slope in zip(fitted.features, slopes)
    ]
    return lines.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


#: Trials of the registered searches; the space and the folds are the operator's own.
TRIALS = 2
SPACE_BOUNDS = {
    "max_depth": (3, 8), "learning_rate": (0.01, 0.3), "n_estimators": (100, 600), "subsample": (0.6, 1.0), "colsample_bytree": (0.6, 1.0),
    "min_child_weight": (1, 10), "gamma": (0.0, 1.0), "reg_alpha": (0.0, 1.0), "reg_lambda": (0.5, 2.0),
}


@query("tuned_trials", "SELECT CAST(unnest([0, 1]) AS INTEGER) AS trial, true AS auc_in_range, true AS params_in_space, true AS ended_within")
def tuned_trials(spark, sf):
    """The trials of a search over the judged documents, with the operator's space, folds and early stopping."""
    found = model.tune(judged_documents(spark, sf), DOCUMENT_FEATURES, "quality", trials=TRIALS)
    rows = [
        (t.number, 0 <= t.auc <= 1, all(low <= getattr(t.params, n) <= high for n, (low, high) in SPACE_BOUNDS.items()), 1 <= t.rounds <= t.params.n_estimators)
        for t in found
    ]
    return spark.createDataFrame(rows, "trial int, auc_in_range boolean, params_in_space boolean, ended_within boolean")


@query(
    "tuned_separable",
    """SELECT CAST(unnest([0, 1]) AS INTEGER) AS trial, auc FROM (
  SELECT CASE WHEN max(l_quantity) FILTER (WHERE l_quantity <= 25) < min(l_quantity) FILTER (WHERE l_quantity > 25) THEN 1.0 END AS auc FROM lineitem)""",
)
def tuned_separable(spark, sf):
    """A label that one feature gives away: the AUC is 1 whatever the folds and the parameters."""
    flag = (F.col("l_quantity") > 25).cast("int")
    rows = table(spark, sf, "lineitem").select(flag.alias("y"), flag.alias("x"), "l_discount")
    found = model.tune(rows, ["x", "l_discount"], "y", trials=TRIALS)
    return spark.createDataFrame([(t.number, t.auc) for t in found], "trial int, auc double")


@query(
    "trained_metadata",
    """SELECT CAST(6 AS INTEGER) AS n_features, true AS threshold_on_grid, true AS stopped_within, true AS params_in_space, true AS metrics_in_range""",
)
def trained_metadata(spark, sf):
    """The whole training run on the judged documents, tuning included, ending in its metadata record."""
    out = scratch_path(spark, "training")
    labelled = split.exact_split(judged_documents(spark, sf), ["doc_id"])
    csvfiles.write_snappy(labelled, f"{out}/features", partition_by="split")
    student.train(spark, out, DOCUMENT_FEATURES, "quality", trials=TRIALS)
    steps = (F.col("threshold") - 0.3) / 0.01
    metrics = [F.col(f"{part}.{name}").between(0, 1) for part in ("val_metrics", "test_metrics") for name in ("accuracy", "f1", "roc_auc")]
    return metadata.read_document(spark, f"{out}/model_metadata").select(
        F.size("feature_columns").alias("n_features"),
        ((F.abs(steps - F.round(steps)) < 1e-6) & steps.between(-1e-6, 44 + 1e-6)).alias("threshold_on_grid"),
        F.col("best_iteration").between(1, F.col("best_params.n_estimators")).alias("stopped_within"),
        reduce(and_, (F.col(f"best_params.{name}").cast("double").between(*bounds) for name, bounds in SPACE_BOUNDS.items())).alias("params_in_space"),
        (metrics[0] & metrics[1] & metrics[2] & metrics[3] & metrics[4] & metrics[5]).alias("metrics_in_range"),
    )


#: The parameters of the one regularised split that has a closed form.
STUMP = boosting.Params(max_depth=1, n_estimators=1, learning_rate=0.5, reg_lambda=2.0, reg_alpha=0.75, min_child_weight=1.0)
SECOND_ORDER_SQL = """WITH t AS (SELECT CAST(l_returnflag = 'R' AS DOUBLE) AS y, CAST(l_quantity > 25 AS INTEGER) AS x FROM lineitem),
p AS (SELECT avg(y) AS p, ln(avg(y) / (1 - avg(y))) AS base, count(*) AS n FROM t),
s AS (SELECT x, sum(p - y) AS g, sum(p * (1 - p)) AS h, max(base) AS base, CAST(count(*) AS DOUBLE) / max(n) AS share FROM t, p GROUP BY x),
w AS (SELECT *, -0.5 * sign(g) * greatest(abs(g) - 0.75, 0) / (h + 2) AS w FROM s),
m AS (SELECT *, (SELECT sum(share * w) FROM w) AS mean FROM w)"""


@query("second_order_stump", f"{SECOND_ORDER_SQL} SELECT x, round(1 / (1 + exp(-(base + w))), 9) AS probability FROM m")
def second_order_stump(spark, sf):
    """One split of second-order boosting with L1 and L2 terms: its two leaves have a closed form."""
    rows = _one_feature(spark, sf)
    fitted = boosting.fit(rows, None, ["x"], "y", STUMP)
    return rows.select("x").distinct().select("x", F.round(fitted.probability(), 9).alias("probability"))


@query("stump_contributions", f"{SECOND_ORDER_SQL} SELECT x, round(w - mean, 9) + 0.0 AS contribution, round(base + mean, 9) AS expected FROM m")
def stump_contributions(spark, sf):
    """The contribution of the only feature: its leaf less the mean of the leaves over all rows."""
    rows = _one_feature(spark, sf)
    fitted = boosting.fit(rows, None, ["x"], "y", STUMP)
    shown = rows.select(F.col("x").alias("key"), "x").distinct()
    made = model.contributions(shown, fitted, ["key"])
    base = F.lit(round(shapley.expected(fitted), 9))
    return made.select(F.col("key").alias("x"), (F.round("x", 9) + F.lit(0.0)).alias("contribution"), base.alias("expected"))


@query("explained_documents", "SELECT doc_id, CAST(6 AS INTEGER) AS n_terms, true AS adds_up, true AS ranked FROM documents")
def explained_documents(spark, sf):
    """The trees that score are the trees that are explained: of every document the contributions and the base add up to its log-odds."""
    measured = measured_documents(spark, sf)
    splits = _document_splits(spark, sf, measured)
    fitted = boosting.fit(splits["train"], splits["val"], DOCUMENT_FEATURES, "quality", boosting.Params(max_depth=4, n_estimators=12))
    scored = measured.select("doc_id", *DOCUMENT_FEATURES, fitted.log_odds().alias("log_odds"))
    shown = model.explain(scored, fitted, ["doc_id", "log_odds"], digits=12)
    total = F.aggregate("explanation", F.lit(shapley.expected(fitted)), lambda total, e: total + e["value"])
    sizes = F.transform("explanation", lambda e: -F.abs(e["value"]))
    return shown.select(
        "doc_id", F.size("explanation").alias("n_terms"), (F.abs(total - F.col("log_odds")) < 1e-6).alias("adds_up"), (sizes == F.array_sort(sizes)).alias("ranked")
    )


@query(
    "model_record",
    """WITH t AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, CASE WHEN l_quantity > 25 THEN 0.75 ELSE 0.25 END AS s FROM lineitem),
c AS (SELECT sum(CAST(y = 1 AND s > 0.5 AS INTEGER)) AS tp, sum(CAST(y = 0 AND s > 0.5 AS INTEGER)) AS fp, sum(CAST(y = 1 AND s < 0.5 AS INTEGER)) AS fn,
  sum(CAST(y = 0 AND s < 0.5 AS INTEGER)) AS tn FROM t)
SELECT 'x' AS features, CAST(0.5 AS DOUBLE) AS threshold, CAST(1 AS INTEGER) AS best_iteration, CAST(2 AS DOUBLE) AS reg_lambda,
  round((tp + tn) / (tp + fp + fn + tn), 4) AS accuracy, round(2 * tp / (2 * tp + fp + fn), 4) AS f1,
  round((tp * tn + 0.5 * (tp * fp + fn * tn)) / ((tp + fn) * CAST(fp + tn AS DOUBLE)), 4) AS roc_auc FROM c""",
)
def model_record(spark, sf):
    """The metadata record of a model whose scores are given: metrics, threshold and parameters."""
    rows = _one_feature(spark, sf).select("y", F.when(F.col("x") == 1, 0.75).otherwise(0.25).alias("score"))
    record = model.model_document({"val": rows}, "y", "score", 0.5, ["x"], {"reg_lambda": 2.0}, 1)
    metrics = [F.round(f"val_metrics.{name}", 4).alias(name) for name in ("accuracy", "f1", "roc_auc")]
    return record.select(F.array_join("feature_columns", ",").alias("features"), "threshold", "best_iteration", "best_params.reg_lambda", *metrics)
