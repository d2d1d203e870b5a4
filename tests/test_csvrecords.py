"""Quoted CSV in splits against one pass of Python's own reader, whatever the size of a split."""

import csv
import io
import random

import pytest

from tallyroute.operators.ordering import FILE_POSITION, with_row_index
from tallyroute.operators import schema
from tallyroute.sources import csvfiles, csvrecords


def written(path, seed, rows=300, end="\n"):
    draw = random.Random(seed)
    cells = ["plain", "", "a,b", 'say "so"', "two\nlines", "x\n\n\ny", '"', 'end"', "\n", "é漢", '""', "1", 'in "the\nmiddle", yes', "5\" pipe"]
    table = [[draw.choice(cells) for _ in range(3)] + [str(i)] for i in range(rows)]
    out = io.StringIO()
    maker = csv.writer(out, lineterminator=end)
    maker.writerow(["one", "two", "three", "id"])
    for row in table:
        maker.writerow(row)
        if draw.random() < 0.05:
            out.write(end)
    path.write_bytes(out.getvalue().encode())
    return table


@pytest.mark.parametrize("size", ["3k", "17k", "128m"])
def test_any_split_gives_the_same_rows(spark, tmp_path, size):
    want = written(tmp_path / "a.csv", 1, 2_000) + written(tmp_path / "b.csv", 2, 40, "\r\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = with_row_index(csvfiles.read_records(spark, str(tmp_path))).orderBy("row_index").collect()
        lines = spark.read.text(str(tmp_path), lineSep="\n")
        if size == "3k":
            assert lines.rdd.getNumPartitions() > 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.row_index for r in found] == list(range(len(want)))
    assert [[c or "" for c in r[:4]] for r in found] == want


def test_same_as_the_whole_file_reader(spark, tmp_path):
    rows = ['n,a,b', '1,x"y,z"', '2," lead", tail', '3,"open ""q"" here",""', '4,only', '5,a,b,c', '   ', '6,"line', 'break",v', "7,'q',5\" w"]
    (tmp_path / "odd.csv").write_text("\n".join(rows))
    whole = spark.read.csv(str(tmp_path / "odd.csv"), header=True, escape='"', multiLine=True).collect()
    made = csvfiles.read_records(spark, str(tmp_path / "odd.csv"))
    assert sorted(map(tuple, made.drop(FILE_POSITION).collect()), key=str) == sorted(map(tuple, whole), key=str)


def test_states_of_a_line():
    after = csvrecords.inside_after
    assert [after(x, False) for x in ("a,b", '"a', '"a"', 'a"b', 'a,"b', '"a""', '"a"",b', '"a","b', 'x",y', '""', '"""', "")] == [
        False, True, False, False, True, True, True, True, False, False, True, False,
    ]
    assert [after(x, True) for x in ("a,b", 'a"', 'a""', 'a","b', 'a",b"', '"', "")] == [True, False, True, True, False, False, True]


def test_empty_files(spark, tmp_path):
    (tmp_path / "h.csv").write_text("a,b\n")
    assert csvfiles.read_records(spark, str(tmp_path / "h.csv")).count() == 0


def test_types_come_from_all_rows(spark):
    names = ["whole", "real", "flag", "day", "late", "none", "spaced", "big"]
    rows = [("1", "1.5", "true", "2024-02-29", "7", None, " 5 ", "1")] * 50 + [("-2", "3", "FALSE", "1999-12-31", "x", " ", "", "9" * 30), ("+3", "-1e-3", None, "2024-01-01", "7", None, "6", "2")]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    found = {r["column"]: (r["type"], r["values"], r["missing"]) for r in schema.inferred_types(df).collect()}
    assert found == {
        "whole": ("bigint", 52, 0), "real": ("double", 52, 0), "flag": ("boolean", 51, 1), "day": ("date", 52, 0), "late": ("string", 52, 0),
        "none": ("string", 0, 52), "spaced": ("bigint", 51, 1), "big": ("double", 52, 0),
    }
    typed = csvfiles.typed_upload(df)
    assert [t for _, t in typed.dtypes] == ["bigint", "double", "boolean", "date", "string", "string", "bigint", "double"]
    assert typed.select("spaced").distinct().count() == 3
    wrong = spark.createDataFrame([("2023-02-30",), ("2023-02-01",)], "day string")
    assert schema.inferred_types(wrong).first()["type"] == "string" and schema.inferred_types(wrong.limit(0)).count() == 0
