"""Session construction and the shared folder used to cut long lineages."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "tallyroute", cpus: int | str = 8, memory: str = "16g") -> SparkSession:
    """A single-machine session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Generated methods above 8000 bytes are never compiled by the JVM; wide checks and feature
        # projections run faster through the split, non-fused code path.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is made only for a
    local session that names none; a cluster without the setting is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF)
    if named:
        return named.rstrip("/")
    already_set = context.getCheckpointDir()
    if already_set:
        return already_set.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyroute-"))
    return context.getCheckpointDir().rstrip("/")


#: Scratch folders not yet discarded, in the order they were named.
_held: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, never used before; the innermost ``scratch`` block releases it."""
    folder = f"{shared_dir(spark)}/tallyroute/{uuid.uuid4().hex}"
    _held.append(folder)
    return f"{folder}/{label}"


@contextmanager
def scratch(spark: SparkSession):
    """Tables written inside the block are deleted at its end: finish with their results before.

    Outside of any block they stay until ``release`` or until the Python process ends.
    """
    start = len(_held)
    try:
        yield
    finally:
        release(spark, start)


def scratch_mark() -> int:
    """A point in time for ``release``."""
    return len(_held)


def release(spark: SparkSession, start: int = 0, keep: str | None = None) -> None:
    """Delete the scratch folders named since ``start``, but for the one that holds ``keep``."""
    for folder in _held[start:]:
        if keep is None or not keep.startswith(f"{folder}/"):
            discard(spark, folder)


def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _held:
        release(spark)


atexit.register(_release_at_exit)


def materialize_at(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back.

    The result has a one-node plan and an exact size on disk, so the next join can choose
    its strategy from that size, and a lost executor costs a re-read instead of a recompute.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """``df`` as a new table in the shared folder."""
    return materialize_at(df, scratch_path(df.sparkSession, label))


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder named by ``scratch_path`` that nothing reads any more."""
    if not path.startswith(f"{shared_dir(spark)}/tallyroute/"):
        raise ValueError(f"{path} is not a scratch folder")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    folder = path.rstrip("/")
    _held[:] = [held for held in _held if held != folder and not folder.startswith(f"{held}/")]
