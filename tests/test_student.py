import random

import pytest
from pyspark.sql import functions as F

from tallyroute.operators import boosting, evaluate, model, ordering, validate
from tallyroute.plans import student
from tallyroute.sources import csvfiles, metadata, parquetfiles
from tallyroute.streaming import scoring

GOOD = {
    "age": "22", "cgpa": "7.5", "backlogs": "0", "attendance": "75.0", "tenth_percentage": "80",
    "twelfth_percentage": "70", "branch": " cse", "college_tier": "2", "python_skill": "5", "c++_skill": "4",
    "java_skill": "3", "ml_skill": "2", "web_dev_skill": "1", "communication_skill": "6", "aptitude_score": "60",
    "logical_reasoning": "63", "internships": "1", "projects": "3", "github_projects": "4", "hackathons": "1",
    "certifications": "2", "coding_contest_rating": "1001", "teamwork": "5", "leadership": "4",
    "problem_solving": "6", "time_management": "5", "gender": "male", "city_tier": "1", "family_income": "8.5",
}


def text_rows(spark, *changes, drop=(), extra=None):
    names = [n for n in student.INPUTS if n not in drop] + list(extra or {})
    rows = [(i, *[{**GOOD, **(extra or {}), **c}.get(n) for n in names]) for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, "row_index long, " + ", ".join(f"`{n}` string" for n in names))


def errors(spark, *changes, **kw):
    checked = student.check_records(text_rows(spark, *changes, **kw))
    return [r["error"] for r in checked.orderBy("row_index").collect()]


def test_features_of_one_student(spark):
    row = student.student_features(student.check_records(text_rows(spark, {}))).first().asDict()
    assert row["avg_technical_skill"] == 3.0 and row["avg_soft_skill"] == 5.0
    assert row["avg_problem_solving"] == 43.0 and row["activity_score"] == 11
    assert row["academic_growth"] == -10.0 and row["academic_avg"] == pytest.approx(0.75)
    assert [row[c] for c in ("clean_record", "good_attendance", "has_internship", "competitive_coder")] == [1, 1, 1, 1]
    assert row["projects_per_year"] == pytest.approx(0.6)
    assert row["branch_encoded"] == 0 and row["gender_encoded"] == 0
    assert "branch" not in row and "gender" not in row


def test_feature_list_has_forty_in_order(spark):
    assert len(student.FEATURES) == 40 and list(student._engineered()) == student.ENGINEERED
    made = student.student_features(student.check_records(text_rows(spark, {})))
    assert [c for c in made.columns if c in student.FEATURES] == student.FEATURES


def test_edges_of_features(spark):
    rows = [{"age": "17"}, {"age": "16"}, {"coding_contest_rating": "1000"}, {"attendance": "74.99"}, {"branch": "ME"}, {"branch": "CE"}]
    got = student.student_features(student.check_records(text_rows(spark, *rows))).orderBy("row_index").collect()
    assert got[0]["projects_per_year"] == 3.0 and got[1]["projects_per_year"] == 3.0
    assert got[2]["competitive_coder"] == 0 and got[3]["good_attendance"] == 0
    assert got[4]["branch_encoded"] == 4 and got[5]["branch_encoded"] == 5
    typed = spark.createDataFrame([(None, 3)], "age int, projects int")
    from tallyroute.operators import features

    assert typed.select(features.ratio_floor("projects", "age", 17)).first()[0] is None


def test_bounds_are_inclusive(spark):
    low = {n: str(b[0]) for n, b in student.BOUNDS.items()}
    high = {n: str(b[1]) for n, b in student.BOUNDS.items() if b[1] is not None}
    assert errors(spark, {}, low, high) == [None, None, None]


@pytest.mark.parametrize(
    "change, message",
    [
        ({"age": "15"}, "age: Input should be greater than or equal to 16"),
        ({"age": "101"}, "age: Input should be less than or equal to 100"),
        ({"age": "3.5"}, "age: Input should be a valid integer, got a number with a fractional part"),
        ({"age": None}, "age: Input should be a valid integer"),
        ({"age": "x"}, "age: Input should be a valid integer, unable to parse string as an integer"),
        ({"backlogs": "3000000000"}, "backlogs: Input should be a valid integer"),
        ({"cgpa": "3d"}, "cgpa: Input should be a valid number, unable to parse string as a number"),
        ({"cgpa": "inf"}, "cgpa: Input should be less than or equal to 10"),
        ({"family_income": "inf"}, "Field 'family_income' must be finite"),
        ({"coding_contest_rating": "nan"}, "Field 'coding_contest_rating' must be finite"),
        ({"gender": "x"}, "gender: Value error, gender must be one of: Female, Male, Other"),
        ({"gender": " "}, "gender: String should have at least 1 character"),
        ({"branch": None}, "branch: Input should be a valid string"),
        (
            {"age": "9", "branch": "ZZ"},
            "age: Input should be greater than or equal to 16; branch: Value error, branch must be one of: "
            "CSE, IT, ECE, EEE, MECH, CIVIL, CHEM, BIO, OTHER, CE, ME, EE",
        ),
    ],
)
def test_row_errors(spark, change, message):
    assert errors(spark, change) == [message]


def test_whole_numbers_may_have_a_point(spark):
    assert errors(spark, {"age": "22.0", "cgpa": " 7 "}) == [None]


def test_missing_and_extra_columns(spark):
    assert errors(spark, {}, drop=["age", "c++_skill"], extra={"cpp_skill": "4"}) == ["age: Field required"]
    assert errors(spark, {}, extra={"nickname": "x"}) == ["nickname: Extra inputs are not permitted"]


def test_coercion_messages(spark):
    rows = text_rows(spark, {"age": None}, {"age": " "}, {"age": "2.5"}, {"cgpa": "x"}, {"cgpa": "nan"}, {"gender": "q"}, {})
    got = validate.coercion_errors(rows, student.RULES).orderBy("row_index").collect()
    assert [r["error"] for r in got] == [
        "Field 'age' cannot be null", "Field 'age' cannot be empty", "Field 'age' must be an integer",
        "Field 'cgpa' must be numeric", "Field 'cgpa' must be finite",
        "Invalid gender 'q'. Allowed values: Female, Male, Other", None,
    ]


LINEAR = model.LinearModel(
    -4.0, {"cgpa": 0.5, "activity_score": 0.05, "good_attendance": 0.2}, {"cgpa": 7.5, "activity_score": 11.5, "good_attendance": 0.6}
)


def write_csv(path, rows):
    import csv

    with open(path, "w", newline="") as f:
        writer = csv.DictWriter(f, rows[0].keys())
        writer.writeheader()
        writer.writerows(rows)


def test_batch_scoring_keeps_every_row_in_order(spark, tmp_path):
    rows = [{**GOOD, "cgpa": str(5 + i % 5), **({"age": "7"} if i % 10 == 3 else {})} for i in range(200)]
    write_csv(tmp_path / "up.csv", rows)
    results = student.batch_score(spark, str(tmp_path / "up.csv"), LINEAR, 0.5)
    got = results.orderBy("row_index").collect()
    assert [r["row_index"] for r in got] == list(range(200))
    assert all((r["error"] is None) == (i % 10 != 3) for i, r in enumerate(got))
    summary = model.summarize_batch(results).first().asDict()
    assert summary["total"] == 200 and summary["failed"] == 20 and summary["processed"] == 180
    assert summary["placed_count"] + summary["not_placed_count"] == 180
    assert validate.contract_violations(results).count() == 0


def test_unusable_uploads_are_told_apart(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("a,b\n")
    with pytest.raises(csvfiles.EmptyUpload):
        csvfiles.read_upload(spark, str(tmp_path / "empty.csv"))
    with pytest.raises(csvfiles.NoDataRows):
        csvfiles.read_upload(spark, str(tmp_path / "header.csv"))
    with pytest.raises(csvfiles.UnreadableUpload):
        csvfiles.read_upload(spark, str(tmp_path / "absent.csv"))


def test_empty_batch_summary_is_zero(spark):
    none = spark.createDataFrame([], "row_index long, probability double, prediction int, error string")
    assert tuple(model.summarize_batch(none).first()) == (0, 0, 0, 0, 0, 0.0)


def test_merge_fills_gaps(spark):
    kind = "row_index long, probability double, prediction int, error string"
    merged = validate.merge_results(
        spark.range(3).withColumnRenamed("id", "row_index"),
        spark.createDataFrame([(0, 0.5, 1, None)], kind),
        spark.createDataFrame([(2, None, None, "bad")], kind),
    )
    assert [r["error"] for r in merged.orderBy("row_index").collect()] == [None, validate.UNKNOWN_FAILURE, "bad"]


def test_contributions_sum_to_score_minus_base(spark):
    table = student.student_features(student.check_records(text_rows(spark, {}, {"cgpa": "9"}, {"attendance": "10"})))
    wide = model.contributions(table.withColumn("odds", LINEAR.log_odds()), LINEAR, ["odds"])
    for r in wide.collect():
        assert r["odds"] - LINEAR.base_log_odds() == pytest.approx(sum(r[f] for f in LINEAR.features))
    explained = model.explain(table, LINEAR, ["row_index"]).orderBy("row_index").collect()
    for r in explained:
        sizes = [abs(e["value"]) for e in r["explanation"]]
        assert sizes == sorted(sizes, reverse=True) and len(sizes) == 3


def student_csv(path, n=400):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        cgpa = round(rng.uniform(5, 10), 2)
        row = {**GOOD, "age": rng.randint(20, 25), "cgpa": cgpa, "branch": rng.choice(["CSE", "IT", "CE", "ME", "xx"]),
               "gender": rng.choice(["Male", "Female"]), "projects": rng.randint(0, 9),
               "family_income": round(rng.uniform(1, 20), 3) + i / 1e5}
        row["placed"] = "" if i % 50 == 49 else int(rng.random() < (cgpa - 5) / 5)
        rows.append({c: row[c] for c in student.SCHEMA.fieldNames()})
    write_csv(path, rows)


def test_prepare_train_and_score(spark, tmp_path, monkeypatch):
    student_csv(tmp_path / "students.csv")
    out = str(tmp_path / "out")
    table = student.prepare(spark, str(tmp_path / "students.csv"), out)
    assert table.count() == 392  # rows without a target are gone
    parts = {r["split"]: r["count"] for r in table.groupBy("split").count().collect()}
    assert parts == {"train": int(392 * 0.70), "val": int(392 * 0.15), "test": 392 - int(392 * 0.70) - int(392 * 0.15)}
    splits = parquetfiles.load_splits(spark, f"{out}/features", student.FEATURES, "placed")
    assert splits["train"].columns == [*student.FEATURES, "placed"]

    document = metadata.read_document(spark, f"{out}/feature_metadata").first()
    assert list(document["feature_columns"]) == student.FEATURES
    assert document["class_balance"]["total"] == parts["train"]
    assert document["train_stats"]["c++_skill"]["mean"] == 4.0

    trained = student.train(spark, out, student.FEATURES, n_estimators=4, max_depth=2)
    assert 0.3 <= trained.threshold < 0.75
    record = metadata.read_document(spark, f"{out}/model_metadata").first()
    assert record["val_metrics"]["roc_auc"] > 0.6

    monkeypatch.setattr(model, "SEARCH_SPACE", {"max_depth": boosting.whole(1, 2), "n_estimators": boosting.whole(2, 3)})
    tuned = student.train(spark, out, student.FEATURES, trials=2)
    record = metadata.read_document(spark, f"{out}/model_metadata").first()
    assert record["best_params"]["max_depth"] in (1, 2) and 0.3 <= tuned.threshold < 0.75

    write_csv(tmp_path / "up.csv", [GOOD, {**GOOD, "age": "1"}])
    results = student.batch_score(spark, str(tmp_path / "up.csv"), trained.model, trained.threshold)
    got = results.orderBy("row_index").collect()
    assert got[0]["error"] is None and 0 <= got[0]["probability"] <= 1 and got[1]["probability"] is None


def test_strict_read_rejects_bad_values_and_missing_columns(spark, tmp_path):
    row = {**GOOD, "placed": "1"}
    write_csv(tmp_path / "a.csv", [{**row, "age": "old"}])
    with pytest.raises(Exception, match="column 'age' holds no number: old"):
        csvfiles.read_strict(spark, str(tmp_path / "a.csv"), student.SCHEMA, "placed").collect()
    write_csv(tmp_path / "c.csv", [{**row, "cgpa": "7d"}])
    with pytest.raises(Exception, match="column 'cgpa' holds no number: 7d"):
        csvfiles.read_strict(spark, str(tmp_path / "c.csv"), student.SCHEMA, "placed").collect()
    write_csv(tmp_path / "d.csv", [{**row, "age": "22.0", "backlogs": ""}, {**row, "placed": ""}])
    kept = csvfiles.read_strict(spark, str(tmp_path / "d.csv"), student.SCHEMA, "placed").collect()
    assert len(kept) == 1 and kept[0]["age"] == 22 and kept[0]["backlogs"] is None
    write_csv(tmp_path / "b.csv", [{k: v for k, v in row.items() if k != "cgpa"}])
    with pytest.raises(ValueError, match="cgpa"):
        csvfiles.read_strict(spark, str(tmp_path / "b.csv"), student.SCHEMA, "placed")


def test_logistic_fit_matches_its_own_scores(spark):
    rng = random.Random(2)
    rows = [(rng.random(), rng.random()) for _ in range(300)]
    df = spark.createDataFrame([(a, b, int(a + 0.2 * b > 0.6)) for a, b in rows], "a double, b double, y int")
    fitted = model.fit_logistic(df, ["a", "b"], "y", maxIter=30)
    scored = df.select(F.col("y").alias("label"), fitted.probability().alias("score"))
    assert evaluate.roc_auc(scored, "label", "score").first()["roc_auc"] > 0.95
    ranked = model.importance(df, fitted).collect()
    assert ranked[0]["feature"] == "a"


def test_drawn_parameters_are_seeded_and_in_bounds():
    def drawn():
        generator, done = random.Random(42), []
        for i in range(50):
            done.append((boosting.draw_params(done, generator), i / 50))
        return done

    assert drawn() == drawn()
    for trial, _ in drawn():
        assert 3 <= trial.max_depth <= 8 and 0.01 <= trial.learning_rate <= 0.3 and 100 <= trial.n_estimators <= 600
        assert 0.6 <= trial.subsample <= 1 and 0.6 <= trial.colsample_bytree <= 1 and 1 <= trial.min_child_weight <= 10
        assert 0 <= trial.gamma <= 1 and 0 <= trial.reg_alpha <= 1 and 0.5 <= trial.reg_lambda <= 2


def test_arriving_files_score_like_the_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        scoring.score_arrivals(spark, str(folder), out, state, LINEAR, 0.5).awaitTermination(120)

    write_csv(folder / "one.csv", [GOOD, {**GOOD, "age": "1"}])
    run()
    write_csv(folder / "two.csv", [{**GOOD, "cgpa": "9"}])
    run()
    got = spark.read.parquet(out)
    assert got.count() == 3 and got.filter("error is null").count() == 2
    batch = student.batch_score(spark, str(folder / "two.csv"), LINEAR, 0.5).first()["probability"]
    assert got.filter("source_file like '%two.csv'").first()["probability"] == batch


def test_student_profile_and_overview(spark):
    rows = spark.createDataFrame(
        [("CSE", "Male", 1, 8.0, 2), ("IT", None, 0, 6.0, 0), ("CSE", "Male", 1, 9.0, 1)],
        "branch string, gender string, placed int, cgpa double, internships int",
    )
    assert tuple(student.overview(rows).first()) == (3, 0.666667, 7.6667, 1.0)
    found = {(r["section"], r["item"], r["detail"]): r["value"] for r in student.dataset_profile(rows).collect()}
    assert found["shape", "row_count", ""] == 3 and found["target", "not_placed", ""] == 1
    assert found["distribution", "gender", "Unknown"] == 1 and found["distribution", "branch", "CSE"] == 2
    assert found["correlation", "cgpa", "placed"] == found["correlation", "placed", "cgpa"] > 0.9
    missing = [k[1] for k in sorted(found, key=lambda k: found[k]) if k[0] == "missing_columns"]
    assert missing[:3] == ["age", "college_tier", "city_tier"] and len(missing) == 25


def test_reconcile_and_row_index_in_records(spark, tmp_path):
    write_csv(tmp_path / "r.csv", [{"ID": str(i), "FirstName": "x"} for i in range(5)])
    records = csvfiles.read_records(spark, str(tmp_path / "r.csv"))
    assert csvfiles.reconcile_counts(records, spark.range(5)).first()["match"] is True
    assert csvfiles.reconcile_counts(records, spark.range(4)).first()["match"] is False
    assert ordering.with_row_index(records).columns == ["ID", "FirstName", "row_index"]
