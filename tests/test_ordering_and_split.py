import hashlib
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallyroute.operators import ordering, search, split
from tallyroute.operators.search import SearchSpec
from tallyroute.session import scratch_path
from tallyroute.sources import csvfiles, linefiles


def test_row_index_follows_file_order_over_many_files_and_splits(spark):
    path = scratch_path(spark, "rows")
    spark.range(20000).repartitionByRange(5, "id").sortWithinPartitions("id").write.option("header", True).csv(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        indexed = ordering.with_row_index(csvfiles.read_records(spark, path))
        wrong = indexed.filter(F.col("id").cast("long") != F.col("row_index"))
        assert indexed.count() == 20000 and wrong.count() == 0
        assert [r["id"] for r in ordering.first_rows(indexed, 3).orderBy("row_index").collect()] == ["0", "1", "2"]
        assert ordering.first_rows(indexed, 0).count() == 20000
        assert ordering.first_rows(indexed, None).count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_row_index_survives_another_cut_of_the_files(spark):
    """The split size changes between building the frame and reading it: every row still comes back."""
    path = scratch_path(spark, "rows")
    spark.range(40_000).coalesce(1).write.option("header", True).csv(path)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        indexed = ordering.with_row_index(csvfiles.read_records(spark, path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
        assert indexed.filter(F.col("id").cast("long") == F.col("row_index")).count() == 40_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,s,n\n1,"x\ny ""z""",2\n3,plain,4\n')
    rows = ordering.with_row_index(csvfiles.read_upload(spark, str(tmp_path))).orderBy("row_index").collect()
    assert [tuple(r) for r in rows] == [("1", 'x\ny "z"', "2", 0), ("3", "plain", "4", 1)]
    kinds = spark.createDataFrame([], "k int, s string, n int").schema
    whole = csvfiles.read_strict(spark, str(tmp_path), kinds, line_breaks=True).collect()
    assert [tuple(r) for r in whole] == [(1, 'x\ny "z"', 2), (3, "plain", 4)]
    with pytest.raises(Exception, match="MALFORMED"):
        csvfiles.read_strict(spark, str(tmp_path), kinds).collect()


def records(spark, rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "row_index long, ID string, FirstName string"
    )


def test_sort_is_stable_both_ways_and_ids_are_numbers(spark):
    df = records(spark, [("10", "b"), ("2", "B"), ("1", "b"), ("7", "a")])
    by_id = ordering.sort_records(df, "ID", tie=["row_index"])
    assert [r["ID"] for r in by_id.collect()] == ["1", "2", "7", "10"]
    up = ordering.sort_records(df, "FirstName", tie=["row_index"])
    assert [r["row_index"] for r in up.collect()] == [1, 3, 0, 2]
    down = ordering.sort_records(df, "FirstName", descending=True, tie=["row_index"])
    assert [r["row_index"] for r in down.collect()] == [0, 2, 3, 1]
    with pytest.raises(ValueError):
        ordering.sort_records(df, "Nope")


def test_position_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).orderBy(F.desc("v"))
        numbered = ordering.with_position(ordered)
        assert numbered.filter(F.col("position") + F.col("v") != 5000).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_running_totals_match_a_loop(spark):
    rng = random.Random(1)
    rows = [(float(i) / 100, rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "s double, n long")
    got = ordering.running_totals(df, F.floor("s"), F.col("s").asc(), ["n"]).orderBy("s").collect()
    total = 0
    for row, (_, n) in zip(got, rows):
        total += n
        assert row["upto_n"] == total


def test_deep_and_near_pages_are_the_same(spark):
    df = spark.range(300).select("id", (F.col("id") * 37 % 11).alias("k"))
    spec = SearchSpec(key=["id"], sort_by="k", descending=True, page=7, limit=20)
    near = [tuple(r) for r in search.page(df, spec).collect()]
    deep = sorted((tuple(r) for r in search.page(df, replace(spec, deep=True)).collect()), key=lambda r: (-r[1], r[0]))
    assert near == deep and len(near) == 20


def test_page_after_continues_a_page(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("k"))
    spec = SearchSpec(key=["id"], sort_by="k", descending=True, limit=10)
    first = search.page(df, spec).collect()
    second = search.page(df, SearchSpec(key=["id"], sort_by="k", descending=True, limit=10, page=2)).collect()
    after = search.page_after(df, spec, first[-1].asDict()).collect()
    assert after == second


@pytest.mark.parametrize("descending", [False, True])
def test_page_after_walks_through_nulls(spark, descending):
    rows = [(i, None if i % 3 == 0 else i % 5) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, k int")
    spec = SearchSpec(key=["id"], sort_by="k", descending=descending, limit=7)
    whole = df.orderBy(*search.order_of(df, spec)).collect()
    seen = search.page(df, spec).collect()
    while True:
        more = search.page_after(df, spec, seen[-1].asDict()).collect()
        if not more:
            break
        seen += more
    assert seen == whole


def test_search_conditions(spark):
    df = spark.createDataFrame(
        [(1, "CSE", "Female", 0, 8.0), (2, None, "Male", 2, 9.0), (3, "IT", None, None, None)],
        "id int, branch string, gender string, internships int, cgpa double",
    )

    def ids(**kw):
        return sorted(r["id"] for r in search.matching(df, SearchSpec(key=["id"], **kw)).collect())

    assert ids(text="male", text_columns=["branch", "gender"]) == [1, 2]
    assert ids(text="", text_columns=["branch"]) == [1, 2, 3]
    assert ids(ranges={"internships": (None, 0)}) == [1]
    assert ids(ranges={"cgpa": (8.0, 8.0)}) == [1]
    assert ids(equals={"internships": 0}) == [1]
    totals = search.totals(df, SearchSpec(key=["id"], equals={"id": 9})).first()
    assert (totals["total"], totals["total_pages"]) == (0, 0)
    with pytest.raises(ValueError):
        SearchSpec(key=["id"], limit=51)
    with pytest.raises(ValueError):
        search.page(df, SearchSpec(key=["id"], sort_by="1"))
    nulls_last = search.page(df, SearchSpec(key=["id"], sort_by="internships")).collect()
    assert [r["id"] for r in nulls_last] == [1, 2, 3]


def test_integer_lines(spark, tmp_path):
    (tmp_path / "n.txt").write_text("3\n\n -7 \n\t\n10\n")
    summary = ordering.list_summary(linefiles.read_integers(spark, str(tmp_path)), "value").first()
    assert tuple(summary) == (3, -7, 10, 2.0, 6)
    (tmp_path / "n.txt").write_text("3\nx\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        linefiles.read_integers(spark, str(tmp_path)).collect()


def sizes(df):
    return {r["split"]: r["rows"] for r in split.split_sizes(df).collect()}


@pytest.mark.parametrize("n", [1, 2, 7, 20, 1000])
def test_split_is_exact_and_follows_the_hash(spark, n):
    got = {r["id"]: r["split"] for r in split.exact_split(spark.range(n), ["id"]).collect()}
    ranked = sorted(range(n), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    a, b = int(n * 0.70), int(n * 0.15)
    expected = {i: "train" if r < a else "val" if r < a + b else "test" for r, i in enumerate(ranked)}
    assert got == expected


def test_split_does_not_depend_on_partitions(spark):
    one = split.exact_split(spark.range(500).repartition(1), ["id"])
    many = split.exact_split(spark.range(500).repartition(13), ["id"])
    assert one.exceptAll(many).count() == 0


def test_split_with_one_hot_key_and_identical_rows(spark):
    hot = spark.range(900).select(F.lit("hot").alias("k"), (F.col("id") % 450).alias("v"))
    rest = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1).cast("long").alias("v"))
    table = hot.unionAll(rest)
    done = split.exact_split(table, ["k"])
    assert sizes(done) == {"train": 700, "val": 150, "test": 150}
    assert done.drop("split").exceptAll(table).count() == 0

    same = spark.range(200).select(F.lit("x").alias("k"), F.lit(None).cast("int").alias("v"))
    done = split.exact_split(same, ["k"])
    assert sizes(done) == {"train": 140, "val": 30, "test": 30}
    assert done.count() == 200


def test_split_keeps_rows_that_read_alike(spark):
    """Keys and cells whose texts collide when joined, instants of one wall-clock time, and nested cells."""
    alike = [("a\u0001", "b", None), ("a", "\u0001b", None), ("n", None, 1), ("n", "\u0000", 1), ("n", "\u0000", 1)] * 40
    table = spark.createDataFrame(alike, "k string, v string, n int")
    for key in (["k", "v"], None):
        done = split.exact_split(table, key)
        assert sizes(done) == {"train": 140, "val": 30, "test": 30}
        assert done.drop("split").exceptAll(table).count() == 0 and table.exceptAll(done.drop("split")).count() == 0
    nested = table.select(F.struct("k", "n").alias("s"), F.create_map(F.lit("x"), "v").alias("m"), F.array("n").alias("a"))
    done = split.exact_split(nested).withColumn("text", F.concat(F.to_json("s"), F.to_json("m")))
    assert sizes(done) == {"train": 140, "val": 30, "test": 30}
    texts = nested.select(F.concat(F.to_json("s"), F.to_json("m")).alias("text"))
    assert done.select("text").exceptAll(texts).count() == 0


def test_shuffle_is_reproducible(spark):
    a = [r["id"] for r in split.shuffle_rows(spark.range(50).repartition(7), ["id"]).collect()]
    b = [r["id"] for r in split.shuffle_rows(spark.range(50), ["id"]).collect()]
    assert a == b != sorted(a) and sorted(a) == list(range(50))


def test_a_frequent_value_is_sorted_by_several_tasks(spark):
    rows = spark.range(0, 1000, 1, 4).select((F.col("id") % 997 > 900).cast("int").alias("value"), "id")
    ordered = ordering.sorted_evenly(rows, [F.desc("value")], rows_a_task=100)
    sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 400
    numbered = ordering.with_position(ordered).orderBy("position").collect()
    want = sorted(((int(i % 997 > 900), i) for i in range(1000)), key=lambda r: (-r[0], r[1]))
    assert [(r["value"], r["id"], r["position"]) for r in numbered] == [(*r, i + 1) for i, r in enumerate(want)]
