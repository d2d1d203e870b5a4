"""The student configuration itself, over a student-shaped table computed from every lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixture_queries.base import query, table
from tallyroute.operators import profile
from tallyroute.operators.model import LinearModel
from tallyroute.operators.schema import col
from tallyroute.plans import student
from tallyroute.session import scratch_path

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
# What each student column is made of; the same text is valid in Spark and in the reference SQL.
COLUMNS = {
    "age": "18 + l_linenumber",
    "cgpa": "5.2 + l_quantity / 10",
    "backlogs": "l_linenumber - 1",
    "attendance": "50 + l_quantity",
    "tenth_percentage": "40 + l_quantity",
    "twelfth_percentage": "100 - l_quantity / 2",
    "branch": "CASE l_returnflag WHEN 'A' THEN 'cse' WHEN 'N' THEN ' me ' ELSE 'Civil' END",
    "college_tier": "l_suppkey % 3 + 1",
    "python_skill": "l_partkey % 11",
    "c++_skill": "l_partkey % 10",
    "java_skill": "l_partkey % 9",
    "ml_skill": "l_partkey % 8",
    "web_dev_skill": "l_partkey % 7",
    "communication_skill": "l_suppkey % 10",
    "aptitude_score": "l_quantity * 2",
    "logical_reasoning": "100 - l_quantity",
    "internships": "l_partkey % 3",
    "projects": "l_partkey % 13",
    "github_projects": "l_suppkey % 7",
    "hackathons": "l_suppkey % 4",
    "certifications": "l_partkey % 5",
    "coding_contest_rating": "l_quantity * 40",
    "teamwork": "l_suppkey % 9",
    "leadership": "l_suppkey % 8",
    "problem_solving": "l_partkey % 6",
    "time_management": "l_suppkey % 6",
    "gender": "CASE l_linestatus WHEN 'F' THEN 'Female' ELSE 'Male' END",
    "city_tier": "l_partkey % 3 + 1",
    "family_income": "1 + l_quantity / 4",
    "placed": "CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END",
}
_SQL_TYPES = {"int": "INTEGER", "float": "FLOAT", "string": "VARCHAR"}
STUDENTS_SQL = "students AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, " + ", ".join(
    f'CAST({text} AS {_SQL_TYPES[student.INPUT_TYPES[name]]}) AS "{name}"' for name, text in COLUMNS.items()
) + " FROM lineitem)"


def students(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        *LINE_KEY,
        *[F.expr(text).cast(student.INPUT_TYPES[name]).alias(name) for name, text in COLUMNS.items()],
    )


def student_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The inputs as an upload would hold them."""
    return students(spark, sf).select(*LINE_KEY, *[col(n).cast("string").alias(n) for n in student.INPUTS])


FLOATS = {
    "avg_technical_skill": '(python_skill + "c++_skill" + java_skill + ml_skill + web_dev_skill) / 5.0',
    "avg_soft_skill": "(communication_skill + teamwork + leadership + time_management) / 4.0",
    "avg_problem_solving": "(CAST(aptitude_score AS DOUBLE) + logical_reasoning + problem_solving) / 3.0",
    "academic_growth": "CAST(twelfth_percentage AS DOUBLE) - tenth_percentage",
    "academic_avg": "(CAST(tenth_percentage AS DOUBLE) / 100 + CAST(twelfth_percentage AS DOUBLE) / 100 + CAST(cgpa AS DOUBLE) / 10) / 3",
    "projects_per_year": "CAST(projects AS DOUBLE) / CASE WHEN age - 17 < 1 THEN 1 ELSE age - 17 END",
}
INTEGERS = {
    "activity_score": "internships + projects + github_projects + hackathons + certifications",
    "clean_record": "backlogs = 0",
    "good_attendance": "attendance >= 75",
    "has_internship": "internships > 0",
    "competitive_coder": "coding_contest_rating > 1000",
    "branch_encoded": "CASE upper(trim(branch)) WHEN 'CSE' THEN 0 WHEN 'ME' THEN 4 WHEN 'CIVIL' THEN 5 ELSE 8 END",
    "gender_encoded": "CASE gender WHEN 'Male' THEN 0 WHEN 'Female' THEN 1 END",
}
FEATURES_SQL = (
    f"WITH {STUDENTS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    + ", ".join(f"round(CAST(CAST({e} AS FLOAT) AS DOUBLE), 4) AS {n}" for n, e in FLOATS.items())
    + ", "
    + ", ".join(f"CAST({e} AS INTEGER) AS {n}" for n, e in INTEGERS.items())
    + " FROM students"
)


@query("student_features", FEATURES_SQL)
def student_features(spark, sf):
    made = student.student_features(students(spark, sf))
    return made.select(*LINE_KEY, *[F.round(col(n).cast("double"), 4).alias(n) for n in FLOATS], *INTEGERS)


def _heatmap_sql() -> str:
    cells = ", ".join(
        f"{{'column_x': '{x}', 'column_y': '{y}', 'correlation': "
        + ("CAST(1 AS DOUBLE)}" if x == y else f"round(corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)), 6)}}")
        for x in student.HEATMAP
        for y in student.HEATMAP
    )
    return f"WITH {STUDENTS_SQL} SELECT c.* FROM (SELECT unnest([{cells}]) AS c FROM students)"


@query("student_heatmap", _heatmap_sql())
def student_heatmap(spark, sf):
    return profile.correlation_matrix(students(spark, sf), student.HEATMAP)


MODEL = LinearModel(
    intercept=-2.0,
    weights={"cgpa": 0.25, "activity_score": 0.03, "good_attendance": 0.4, "branch_encoded": -0.05},
    means={"cgpa": 7.5, "activity_score": 11.0, "good_attendance": 0.5, "branch_encoded": 3.0},
)
THRESHOLD = 0.6
RESULTS_SQL = f"""{STUDENTS_SQL}, checked AS (SELECT *, nullif(concat_ws('; ',
  CASE WHEN cgpa > 10 THEN 'cgpa: Input should be less than or equal to 10' END,
  CASE WHEN python_skill > 9 THEN 'python_skill: Input should be less than or equal to 9' END), '') AS error,
  1 / (1 + exp(-(CAST(-2.0 AS DOUBLE) + CAST(0.25 AS DOUBLE) * CAST(cgpa AS DOUBLE)
    + CAST(0.03 AS DOUBLE) * ({INTEGERS['activity_score']})
    + CAST(0.4 AS DOUBLE) * CAST(attendance >= 75 AS INTEGER)
    + CAST(-0.05 AS DOUBLE) * ({INTEGERS['branch_encoded']})))) AS p FROM students),
results AS (SELECT *, CASE WHEN error IS NULL THEN round(p, 6) END AS probability,
  CASE WHEN error IS NULL THEN CAST(p >= {THRESHOLD} AS INTEGER) END AS prediction FROM checked)"""


@query(
    "student_scores",
    f"WITH {RESULTS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, probability, prediction, error FROM results",
)
def student_scores(spark, sf):
    texts = student_texts(spark, sf)
    keys = texts.select(F.struct(*LINE_KEY).alias("row_index"), *[col(n) for n in student.INPUTS])
    scored = student.score_records(student.check_records(keys), MODEL, THRESHOLD, ["row_index"])
    return scored.select("row_index.*", "probability", "prediction", "error")


@query(
    "csv_batch_scores",
    f"""WITH {RESULTS_SQL}, numbered AS (SELECT *, row_number() OVER (
  ORDER BY attendance, l_linenumber, l_partkey, l_suppkey, placed, branch, gender) - 1 AS row_index FROM results)
SELECT row_index, probability, prediction, error FROM numbered""",
)
def csv_batch_scores(spark, sf):
    """Upload to results: write the texts as CSV, read them back, number, check and score every row."""
    ordered = students(spark, sf).orderBy(
        "attendance", "l_linenumber", "l_partkey", "l_suppkey", "placed", "branch", "gender"
    )
    path = scratch_path(spark, "upload")
    ordered.select(*[col(n).cast("string").alias(n) for n in student.INPUTS]).write.option("header", True).csv(path)
    return student.batch_score(spark, path, MODEL, THRESHOLD)
