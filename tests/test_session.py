import pytest

from tallyroute.session import discard, materialize, scratch_path, shared_dir


def test_scratch_lies_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = shared_dir(spark)
    assert named is None or base == named.rstrip("/")
    assert scratch_path(spark, "x").startswith(f"{base}/tallyroute/") and scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_materialize_keeps_rows_and_odd_names(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "`c++_skill` int, s string")
    again = materialize(df)
    assert again.schema == df.schema and again.exceptAll(df).count() == 0 and again.count() == 2


def test_discard_refuses_other_folders(spark, tmp_path):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        discard(spark, str(tmp_path))
