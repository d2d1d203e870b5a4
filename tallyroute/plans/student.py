"""The student placement table: its schema, rules and encodings, and the jobs that use them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroute.operators import boosting, evaluate, features, model, ordering, profile, schema, split, validate
from tallyroute.operators.schema import col
from tallyroute.operators.validate import FieldRule
from tallyroute.session import materialize
from tallyroute.sources import csvfiles, metadata, parquetfiles

# The column names and types of the table, in its own order.
SCHEMA = T.StructType(
    [
        T.StructField("age", T.IntegerType()),
        T.StructField("cgpa", T.FloatType()),
        T.StructField("backlogs", T.IntegerType()),
        T.StructField("attendance", T.FloatType()),
        T.StructField("tenth_percentage", T.FloatType()),
        T.StructField("twelfth_percentage", T.FloatType()),
        T.StructField("branch", T.StringType()),
        T.StructField("college_tier", T.IntegerType()),
        T.StructField("python_skill", T.IntegerType()),
        T.StructField("c++_skill", T.IntegerType()),
        T.StructField("java_skill", T.IntegerType()),
        T.StructField("ml_skill", T.IntegerType()),
        T.StructField("web_dev_skill", T.IntegerType()),
        T.StructField("communication_skill", T.IntegerType()),
        T.StructField("aptitude_score", T.FloatType()),
        T.StructField("logical_reasoning", T.FloatType()),
        T.StructField("internships", T.IntegerType()),
        T.StructField("projects", T.IntegerType()),
        T.StructField("github_projects", T.IntegerType()),
        T.StructField("hackathons", T.IntegerType()),
        T.StructField("certifications", T.IntegerType()),
        T.StructField("coding_contest_rating", T.FloatType()),
        T.StructField("teamwork", T.IntegerType()),
        T.StructField("leadership", T.IntegerType()),
        T.StructField("problem_solving", T.IntegerType()),
        T.StructField("time_management", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("city_tier", T.IntegerType()),
        T.StructField("family_income", T.FloatType()),
        T.StructField("placed", T.IntegerType()),
    ]
)
TARGET = "placed"
INPUTS = [n for n in SCHEMA.fieldNames() if n != TARGET]

# Label codes and the short forms that stand for a longer code.
BRANCH_CODES = {
    "CSE": 0, "IT": 1, "ECE": 2, "EEE": 3, "MECH": 4, "CIVIL": 5, "CHEM": 6, "BIO": 7, "OTHER": 8,
    "CE": 9, "ME": 10, "EE": 11,
}
BRANCH_ALIASES = {"CE": "CIVIL", "ME": "MECH", "EE": "EEE"}
GENDER_CODES = {"Male": 0, "Female": 1, "Other": 2}
NAME_ALIASES = {"cpp_skill": "c++_skill"}

# Inclusive bounds per input field; None means open.
BOUNDS = {
    "age": (16, 100),
    "cgpa": (0, 10),
    "attendance": (0, 100),
    "tenth_percentage": (0, 100),
    "twelfth_percentage": (0, 100),
    "aptitude_score": (0, 100),
    "logical_reasoning": (0, 100),
    "college_tier": (1, 3),
    "city_tier": (1, 3),
    **{
        name: (0, 9)
        for name in (
            "python_skill", "c++_skill", "java_skill", "ml_skill", "web_dev_skill", "communication_skill",
            "teamwork", "leadership", "problem_solving", "time_management",
        )
    },
    **{
        name: (0, None)
        for name in (
            "backlogs", "internships", "projects", "github_projects", "hackathons", "certifications",
            "coding_contest_rating", "family_income",
        )
    },
}
# The columns a served table should have, in the order they are reported.
EXPECTED = [
    "age", "gender", "branch", "college_tier", "city_tier", "family_income", "cgpa", "tenth_percentage",
    "twelfth_percentage", "backlogs", "attendance", "python_skill", "c++_skill", "java_skill", "ml_skill",
    "web_dev_skill", "communication_skill", "aptitude_score", "logical_reasoning", "problem_solving", "teamwork",
    "leadership", "time_management", "internships", "projects", "github_projects", "hackathons", "certifications",
    "coding_contest_rating", "placed",
]
# The columns of the correlation matrix.
HEATMAP = [
    "age", "cgpa", "backlogs", "attendance", "tenth_percentage", "twelfth_percentage", "communication_skill",
    "aptitude_score", "logical_reasoning", "problem_solving", "internships", "projects", "placed",
]


def _rule(field: T.StructField) -> FieldRule:
    if field.name == "branch":
        return FieldRule("branch", "string", domain=tuple(BRANCH_CODES))
    if field.name == "gender":
        return FieldRule("gender", "string", domain=tuple(GENDER_CODES), ignore_case=True)
    kind = "int" if isinstance(field.dataType, T.IntegerType) else "float"
    return FieldRule(field.name, kind, *BOUNDS[field.name])


RULES = [_rule(f) for f in SCHEMA.fields if f.name != TARGET]
INPUT_TYPES = {f.name: f.dataType.simpleString() for f in SCHEMA.fields}


def _engineered() -> dict[str, Column]:
    """Feature name -> expression, in table order."""
    return {
        "avg_technical_skill": features.mean_of(
            ["python_skill", "c++_skill", "java_skill", "ml_skill", "web_dev_skill"]
        ),
        "avg_soft_skill": features.mean_of(
            ["communication_skill", "teamwork", "leadership", "time_management"]
        ),
        "avg_problem_solving": features.mean_of(["aptitude_score", "logical_reasoning", "problem_solving"]),
        "activity_score": features.sum_of(
            ["internships", "projects", "github_projects", "hackathons", "certifications"]
        ),
        "academic_growth": features.difference("twelfth_percentage", "tenth_percentage"),
        "academic_avg": features.scaled_mean(
            {"tenth_percentage": 100, "twelfth_percentage": 100, "cgpa": 10}
        ),
        "clean_record": features.flag(col("backlogs") == 0),
        "good_attendance": features.flag(col("attendance") >= 75.0),
        "has_internship": features.flag(col("internships") > 0),
        "competitive_coder": features.flag(col("coding_contest_rating") > 1000),
        "projects_per_year": features.ratio_floor("projects", "age", offset=17, floor=1),
    }


ENGINEERED = [
    "avg_technical_skill", "avg_soft_skill", "avg_problem_solving", "activity_score", "academic_growth",
    "academic_avg", "clean_record", "good_attendance", "has_internship", "competitive_coder",
    "projects_per_year",
]
FEATURES = [c for c in INPUTS if c not in ("branch", "gender")] + ENGINEERED + ["branch_encoded", "gender_encoded"]


def student_features(df: DataFrame) -> DataFrame:
    """Raw numeric columns, engineered features and codes; the raw labels are dropped.

    One encoder serves training and scoring, so a branch gets the same code in both.
    """
    made = [expression.alias(name) for name, expression in _engineered().items()]
    codes = [
        features.encoded("branch", BRANCH_CODES, BRANCH_ALIASES, "OTHER").alias("branch_encoded"),
        features.encoded("gender", GENDER_CODES).alias("gender_encoded"),
    ]
    return df.select(*[col(c) for c in df.columns if c not in ("branch", "gender")], *made, *codes)


def prepare(spark: SparkSession, csv_path: str, out: str, key: list[str] | None = None) -> DataFrame:
    """CSV to features, exact splits and metadata below ``out``; returns the written table."""
    # The split passes over its key a few times: it reads one column of this table, not the CSV.
    table = student_features(csvfiles.read_strict(spark, csv_path, SCHEMA, TARGET))
    hashed = table.withColumn("_row_hash", split.seeded_hash(key or table.columns, split.SEED))
    labelled = split.exact_split(materialize(hashed, "features"), ["_row_hash"]).drop("_row_hash")
    csvfiles.write_snappy(labelled, f"{out}/features", partition_by="split")
    written = spark.read.parquet(f"{out}/features")
    train = written.filter(F.col("split") == "train").drop("split")
    document = profile.feature_document(
        train,
        TARGET,
        ENGINEERED,
        {"branch_encoding": BRANCH_CODES, "gender_encoding": GENDER_CODES},
        schema.numeric_columns(train, exclude=[TARGET]),
    )
    metadata.write_document(document, f"{out}/feature_metadata")
    return written


@dataclass(frozen=True)
class Trained:
    """A fitted model with the threshold chosen on the validation split."""

    model: boosting.Boosted
    threshold: float
    document: DataFrame


def train(spark: SparkSession, out: str, feature_names: list[str], target: str = TARGET, trials: int = 0, space=None, folds: int = model.FOLDS, **params) -> Trained:
    """Tune (optional, ``trials`` draws from ``space``), fit with early stopping, choose the threshold, evaluate, save below ``out``."""
    splits = parquetfiles.load_splits(spark, f"{out}/features", feature_names, target)
    chosen = boosting.Params(**params)
    if trials:
        given = {} if space is None and folds == model.FOLDS else {"space": space, "folds": folds}
        chosen = replace(boosting.best_params(model.tune(splits["train"], feature_names, target, trials=trials, **given)), **params)
    fitted = boosting.fit(splits["train"], splits["val"], feature_names, target, chosen)

    # Scored once each; the sweep and the metrics then read two columns.
    scored = {name: materialize(splits[name].select(target, fitted.probability().alias("score")), "scored") for name in ("val", "test")}
    threshold = evaluate.best_threshold(evaluate.threshold_sweep(scored["val"], target, "score")).first()
    document = model.model_document(scored, target, "score", threshold["threshold"], feature_names, asdict(chosen), len(fitted.trees))
    boosting.save(fitted, spark, f"{out}/model")
    metadata.write_document(document, f"{out}/model_metadata")
    return Trained(fitted, threshold["threshold"], document)


def overview(df: DataFrame) -> DataFrame:
    return profile.overview(df, TARGET, ["cgpa", "internships"])


def dataset_profile(df: DataFrame) -> DataFrame:
    return profile.dataset_profile(df, TARGET, EXPECTED, ["branch", "gender"], HEATMAP)


def check_records(records: DataFrame, keep: Sequence[str] = ("row_index",)) -> DataFrame:
    """Text records with their errors and typed values under the same names.

    ``keep`` names columns that identify a row and are no input.
    """
    named = schema.rename_aliases(records, NAME_ALIASES)
    known = {*INPUTS, *keep, "include_explanation"}
    extras = [c for c in named.columns if c not in known]
    checked = validate.check(named, RULES, INPUT_TYPES, extras)
    absent = [F.lit(None).cast(INPUT_TYPES[n]).alias(n) for n in INPUTS if n not in named.columns]
    return checked.select("*", *absent)


def batch_score(spark: SparkSession, csv_path: str, fitted, threshold: float) -> DataFrame:
    """Score an uploaded CSV: row_index, probability, prediction, error for every input row."""
    records = ordering.with_row_index(csvfiles.read_upload(spark, csv_path))
    return score_records(check_records(records), fitted, threshold, ["row_index"])


def score_records(checked: DataFrame, fitted, threshold: float, keep: list[str]) -> DataFrame:
    """Score checked records with trees or with a linear model; rejected rows keep their errors."""
    table = student_features(checked)
    if isinstance(fitted, (model.LinearModel, boosting.Boosted)):
        return model.score_rows(table, fitted.probability(), threshold, keep)
    scored = fitted.transform(table)
    return model.score_rows(scored, model.positive_probability(), threshold, keep)
