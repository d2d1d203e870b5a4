import math

import pytest
from pyspark.sql import functions as F

from tallyroute.functions import formats, labels, numeric, text


def one(spark, expression, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression.alias("y")).first()["y"]


X = F.col("x")


@pytest.mark.parametrize(
    "raw, expected",
    [("3", 3.0), (" \t3.5\n", 3.5), ("-.5", -0.5), ("1e3", 1000.0), ("3.", 3.0), ("3d", None), ("0x1p3", None),
     ("1_000", None), ("", None), (None, None), ("abc", None), ("inf", math.inf), ("-Infinity", -math.inf)],
)
def test_parse_number(spark, raw, expected):
    assert one(spark, numeric.parse_number(X), raw) == expected


def test_parse_number_nan(spark):
    assert math.isnan(one(spark, numeric.parse_number(X), " NaN "))


@pytest.mark.parametrize("raw, expected", [("3", 3), ("3.0", 3), ("3.5", None), ("inf", None), ("nan", None)])
def test_parse_whole(spark, raw, expected):
    assert one(spark, numeric.parse_whole(X), raw) == expected


def test_strip_space_takes_tabs(spark):
    assert one(spark, text.strip_space(X), "\t a b \n") == "a b"


@pytest.mark.parametrize(
    "value, needle, found",
    [("Female", "male", True), ("a\\b", "\\", True), ("ab", "\\", False), ("axb", "a_b", True), ("a\x01", "\x01", True)],
)
def test_contains_ignoring_case(spark, value, needle, found):
    assert one(spark, text.contains_ignoring_case(X, needle), value) is found


def test_labels(spark):
    codes = {"CSE": 0, "CIVIL": 5, "OTHER": 8}
    encoded = labels.ordinal(
        labels.known_or_other(labels.aliased(labels.upper_label(X), {"CE": "CIVIL"}), list(codes)), codes
    )
    assert [one(spark, encoded, v) for v in ("\tcse ", "ce", "zz", None)] == [0, 5, 8, 8]
    assert one(spark, labels.canonical(X, ["Male", "Other"]), " mALE ") == "Male"
    assert one(spark, labels.canonical(X, ["Male"]), "x") is None


def test_strict_code_fails_on_unknown_label(spark):
    with pytest.raises(Exception, match="no code for label"):
        one(spark, labels.ordinal_strict(X, {"a": 1}), "b")
    assert one(spark, labels.ordinal_strict(X, {"a": 1}), None) is None


def test_steps_reached_counts_thresholds(spark):
    steps = [0.3 + i * (0.31 - 0.3) for i in range(45)]
    values = [0.0, 0.3, 0.36, steps[6], 0.7399, steps[-1], 1.0]
    for v in values:
        assert one(spark, numeric.steps_reached(X, steps), v, "double") == sum(s <= v for s in steps)
    assert one(spark, numeric.steps_reached(X, steps), float("nan"), "double") == 0


def test_formats(spark):
    assert one(spark, formats.thousands(X), 1234567, "long") == "1,234,567"
    assert one(spark, formats.thousands(X), None, "long") == "0"
    assert one(spark, formats.percent(X), 0.5, "double") == "50.00%"
    assert one(spark, formats.percent(X), 64.5, "double") == "64.50%"
    assert one(spark, formats.cost_text(X, "D", {"D": "km"}), 62.0, "double") == "62.0 km"


def test_ratio_and_rounded(spark):
    assert one(spark, numeric.ratio(X, F.lit(0)), 1, "int") == 0.0
    assert one(spark, numeric.rounded(X), None, "double") == 0.0


def test_plain_numbers_are_read_as_by_the_pattern(spark):
    texts = [None, "", "1", "-1.50", "+.5", ".", "1.", "1.e3", ".e3", "1e", "e5", "1E-3", "1e5.5", "--1", "+-1", "1-2", "1.2.3", "-", "E", "1e400", "-0", " 7 ", "3d", "1f", "0x1", "Inf", "nan", "1 2", "٣"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    by_pattern = F.regexp_extract("t", numeric.NUMBER_PATTERN, 1).try_cast("double")
    rows = df.select("t", numeric.parse_number(F.col("t")).alias("found"), by_pattern.alias("want")).collect()
    assert [(r["t"], str(r["found"])) for r in rows] == [(r["t"], str(r["want"])) for r in rows]
    assert numeric.PLAIN_CHARACTERS in str(numeric.parse_number(F.col("t")))  # plain texts don't go through the pattern
