"""Training, scoring and explaining a binary classifier on Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.functions import numeric
from tallyroute.operators import boosting, shapley
from tallyroute.operators.evaluate import metrics_record
from tallyroute.operators.schema import col
from tallyroute.operators.validate import ERROR, UNKNOWN_FAILURE

SEED = 42


def assembler(features: Sequence[str], invalid: str = "keep") -> VectorAssembler:
    """Features in the given order as one vector; ``keep`` turns nulls into NaN."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid=invalid)


@dataclass(frozen=True)
class LinearModel:
    """A logistic model as plain numbers: scoring and explaining are column arithmetic."""

    intercept: float
    weights: Mapping[str, float]
    means: Mapping[str, float]

    @property
    def features(self) -> list[str]:
        return list(self.weights)

    def log_odds(self) -> Column:
        total = F.lit(float(self.intercept))
        for name, weight in self.weights.items():
            total = total + F.lit(float(weight)) * col(name).cast("double")
        return total

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.log_odds()))

    def base_log_odds(self) -> float:
        return self.intercept + sum(w * self.means[f] for f, w in self.weights.items())

    def contribution(self, name: str) -> Column:
        """Exact Shapley value of the feature in log-odds, features taken as independent."""
        centred = col(name).cast("double") - F.lit(float(self.means[name]))
        return F.lit(float(self.weights[name])) * centred


def fit_logistic(train: DataFrame, features: Sequence[str], label: str, **params) -> LinearModel:
    """Logistic regression; the training means come from one aggregate."""
    vectors = assembler(features, "error").transform(train.select(*[col(f) for f in features], col(label)))
    fitted = LogisticRegression(featuresCol="features", labelCol=label, **params).fit(vectors)
    means = train.agg(*[F.avg(col(f).cast("double")).alias(f"m{i}") for i, f in enumerate(features)]).first()
    return LinearModel(
        float(fitted.intercept),
        dict(zip(features, map(float, fitted.coefficients))),
        {f: float(means[f"m{i}"]) for i, f in enumerate(features)},
    )


def fit_boosted(
    train: DataFrame, val: DataFrame, features: Sequence[str], label: str, **params
) -> PipelineModel:
    """Boosted trees that stop when the validation rows stop improving."""
    keep = [*[col(f) for f in features], col(label)]
    both = train.select(*keep, F.lit(False).alias("is_val")).unionByName(
        val.select(*keep, F.lit(True).alias("is_val"))
    )
    trees = GBTClassifier(
        featuresCol="features", labelCol=label, validationIndicatorCol="is_val", seed=SEED, **params
    )
    return Pipeline(stages=[assembler(features), trees]).fit(both)


SEARCH_SPACE = boosting.SPACE
TRIALS = boosting.TRIALS
FOLDS = boosting.FOLDS


def tune(train: DataFrame, features: Sequence[str], label: str, *, space=None, trials: int = TRIALS, folds: int = FOLDS) -> list[boosting.Trial]:
    """Cross-validated search for the parameters of boosted trees, by mean AUC; the trials in their order."""
    return boosting.search(train, features, label, space=space or SEARCH_SPACE, trials=trials, folds=folds)


def positive_probability(probability: str = "probability") -> Column:
    """Second entry of an ML probability vector."""
    return vector_to_array(F.col(probability))[1]


def result_columns(raw: Column, error: Column, threshold: float) -> list[Column]:
    """probability (6 places), prediction, error for a row; a row is either scored or has an error."""
    scored = error.isNull() & raw.isNotNull() & ~F.isnan(raw)
    return [
        F.when(scored, F.round(raw, 6)).alias("probability"),
        F.when(scored, numeric.at_least(raw, threshold)).alias("prediction"),
        F.when(error.isNotNull(), error).when(~scored, F.lit(UNKNOWN_FAILURE)).alias("error"),
    ]


def score_rows(df: DataFrame, probability: Column, threshold: float, keep: Sequence[str], error: str = ERROR) -> DataFrame:
    """Keep columns plus probability, prediction, error; rejected rows carry their errors.

    One narrow projection: a rejected row is masked, never separated and joined back.
    """
    staged = df.select(*[col(k) for k in keep], probability.alias("_raw"), col(error).alias("_error"))
    return staged.select(*[col(k) for k in keep], *result_columns(F.col("_raw"), F.col("_error"), threshold))


def summarize_batch(results: DataFrame) -> DataFrame:
    """One row: total, processed, failed, placed_count, not_placed_count, placement_rate."""
    ok = F.col("error").isNull()
    counted = results.agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("processed"),
        F.count_if(ok & (F.col("prediction") == 1)).alias("placed_count"),
    )
    return counted.select(
        "total",
        "processed",
        (F.col("total") - F.col("processed")).alias("failed"),
        "placed_count",
        (F.col("processed") - F.col("placed_count")).alias("not_placed_count"),
        F.round(numeric.ratio(F.col("placed_count"), F.col("processed")), 6).alias("placement_rate"),
    )


def contributions(df: DataFrame, model: LinearModel | boosting.Boosted, keep: Sequence[str] = ()) -> DataFrame:
    """Wide table: one column per feature with its contribution in log-odds."""
    if isinstance(model, boosting.Boosted):
        return shapley.contributions(df, model, keep)
    return df.select(*[col(k) for k in keep], *[model.contribution(f).alias(f) for f in model.features])


def explain(df: DataFrame, model: LinearModel | boosting.Boosted, keep: Sequence[str], digits: int = 4) -> DataFrame:
    """Keep columns plus ``explanation``: (feature, value) by absolute value, ties by feature order."""
    # Kept columns may bear the features' names, so they go by number meanwhile.
    numbered = df.select(*[col(k).alias(f"_keep{i}") for i, k in enumerate(keep)], *[col(f) for f in model.features])
    names = [f"_keep{i}" for i in range(len(keep))]
    # Each term is rounded once, in a projection of its own.
    made = contributions(numbered, model, names)
    terms = [(F.round(col(f), digits) + F.lit(0.0)).alias(f"_term{i}") for i, f in enumerate(model.features)]
    wide = made.select(*names, *terms)
    entries = [
        F.struct((-F.abs(F.col(f"_term{i}"))).alias("size"), F.lit(i).alias("place"), F.lit(f).alias("feature"), F.col(f"_term{i}").alias("value"))
        for i, f in enumerate(model.features)
    ]
    ranked = wide.select(*names, F.sort_array(F.array(*entries)).alias("_ranked"))
    pairs = F.arrays_zip(F.col("_ranked.feature").alias("feature"), F.col("_ranked.value").alias("value"))
    return ranked.select(*[F.col(n).alias(k) for n, k in zip(names, keep)], pairs.alias("explanation"))


def importance(df: DataFrame, model: LinearModel | boosting.Boosted, top: int = 20) -> DataFrame:
    """feature, importance: mean absolute contribution, the largest ``top``; one pass, no explode."""
    wide = contributions(df, model)
    row = wide.agg(*[F.avg(F.abs(col(f))).alias(f"i{i}") for i, f in enumerate(model.features)])
    cells = [
        F.struct(F.lit(f).alias("feature"), F.col(f"i{i}").alias("importance"), F.lit(i).alias("place"))
        for i, f in enumerate(model.features)
    ]
    table = row.select(F.inline(F.array(*cells)))
    return table.orderBy(F.desc("importance"), "place").limit(top).select("feature", "importance")


def tree_importance(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """feature, importance of the fitted trees."""
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(f, float(v)) for f, v in zip(features, values)], "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")


def model_document(
    evaluated: Mapping[str, DataFrame],
    label: str,
    score: str,
    threshold: float,
    features: Sequence[str],
    params: Mapping[str, object],
    rounds: int,
) -> DataFrame:
    """One nested row for the metadata record: features, threshold, parameters, metrics per split."""
    metrics = [
        metrics_record(frame, label, score, threshold, name)
        .select(F.struct("accuracy", "f1", "roc_auc"))
        .scalar()
        .alias(f"{name}_metrics")
        for name, frame in evaluated.items()
    ]
    spark = next(iter(evaluated.values())).sparkSession
    return spark.range(1).select(
        F.array(*[F.lit(f) for f in features]).alias("feature_columns"),
        F.lit(float(threshold)).alias("threshold"),
        F.struct(*[F.lit(v).alias(k) for k, v in params.items()]).alias("best_params"),
        F.lit(int(rounds)).alias("best_iteration"),
        *metrics,
    )
