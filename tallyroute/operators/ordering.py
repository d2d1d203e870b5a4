"""Row order at scale: file order, dense row numbers, running totals, stable sorts, pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroute.operators.schema import col
from tallyroute.session import materialize

FILE_POSITION = "_position"
SORTED_ROWS_A_TASK = 1_000_000
# A monotonically increasing id holds the partition above this many bits of row counter.
_PARTITION_BITS = 33


def file_position() -> Column:
    """Sortable place of a row in a file scan: file, byte offset of the split, row within the task.

    Spark packs splits into tasks in any order, but reads each split front to back, so ordering
    by these three fields is the order of the rows in the files taken by path.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )


def with_row_index(df: DataFrame, position: str = FILE_POSITION, name: str = "row_index") -> DataFrame:
    """Turn a file position into a dense 0-based row number, without sorting the rows.

    The rows are written once with their positions, so that a second scan cannot cut the files
    elsewhere. Rows of one split are numbered by their distance from the split's first row; the
    splits' own offsets come from one small row per split, and Spark chooses how to join them by
    their size. A row whose split has no offset fails the job.
    """
    split = [F.col(f"{position}.file").alias("_file"), F.col(f"{position}.block").alias("_block")]
    written = materialize(df.select("*", *split), "rows")
    splits = written.groupBy("_file", "_block").agg(F.min(f"{position}.seq").alias("_first"), F.count("*").alias("_rows"))
    files = splits.groupBy("_file").agg(F.sum("_rows").alias("_file_rows"))
    before_file = F.sum("_file_rows").over(Window.orderBy("_file")) - F.col("_file_rows")
    in_file = Window.partitionBy("_file").orderBy("_block")
    offsets = (
        splits.withColumn("_before_block", F.sum("_rows").over(in_file) - F.col("_rows"))
        .join(files.select("_file", before_file.alias("_before_file")), "_file")
        .select(
            "_file",
            "_block",
            (F.col("_before_file") + F.col("_before_block") - F.col("_first")).alias("_shift"),
        )
    )
    keyed = written.join(materialize(offsets, "offsets"), ["_file", "_block"], "left")
    lost = F.raise_error(F.lit("a row belongs to no counted split")).cast("long")
    index = F.col(f"{position}.seq") + F.coalesce("_shift", lost)
    return keyed.withColumn(name, index).drop(position, "_file", "_block", "_shift")


def first_rows(indexed: DataFrame, n: int | None, index: str = "row_index") -> DataFrame:
    """The first ``n`` rows in file order; ``None`` or 0 keeps all."""
    return indexed.filter(F.col(index) < n) if n else indexed


def partition_of(row_id: str) -> Column:
    """The partition in which a monotonically increasing id was given."""
    return F.shiftright(row_id, _PARTITION_BITS)


def with_position(ordered: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows of an already globally sorted frame from 1, with no single-task window.

    The sort is written once; each row's number is its counter within the sorted partition
    plus the size of the partitions before it (one row per partition).
    """
    part, seq = partition_of("_id"), F.col("_id").bitwiseAND((1 << _PARTITION_BITS) - 1)
    written = materialize(ordered.withColumn("_id", F.monotonically_increasing_id()), "sorted")
    sizes = written.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    offsets = sizes.select("_part", before.alias("_before"))
    return (
        written.withColumn("_part", part)
        .join(materialize(offsets, "offsets"), "_part")
        .withColumn(name, seq + F.col("_before") + 1)
        .drop("_id", "_part", "_before")
    )


def sorted_evenly(df: DataFrame, order: Sequence[Column], rows_a_task: int = SORTED_ROWS_A_TASK) -> DataFrame:
    """Stable sort in tasks of about ``rows_a_task`` rows each, however many rows are equal in ``order``.

    Equal rows are told apart by their place in the input, so that a frequent value is cut over several tasks.
    """
    tasks = max(1, -(-df.count() // rows_a_task))
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    keys = [*order, F.col("_place").asc()]
    return placed.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).drop("_place")


def running_totals(
    df: DataFrame, bucket: Column, order: Column, sums: Sequence[str], prefix: str = "upto_"
) -> DataFrame:
    """Cumulative sums in ``order``, the row itself included, over buckets that follow the same order.

    ``bucket`` must rise along the order and split the rows into groups of bounded size. Only
    the bucket totals, one row each, go through a window without a partition.
    """
    bucketed = df.withColumn("_bucket", bucket)
    totals = bucketed.groupBy("_bucket").agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    across = Window.orderBy("_bucket")
    before = totals.select(
        "_bucket", *[(F.sum(f"_{c}").over(across) - F.col(f"_{c}")).alias(f"_before_{c}") for c in sums]
    )
    within = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = bucketed.select("*", *[F.sum(c).over(within).alias(f"_local_{c}") for c in sums])
    joined = local.join(before, "_bucket")
    return joined.select(
        *[col(c) for c in df.columns],
        *[(F.col(f"_before_{c}") + F.col(f"_local_{c}")).alias(f"{prefix}{c}") for c in sums],
    )


def sort_key(df: DataFrame, column: str, descending: bool = False) -> Column:
    """Sort expression with nulls last both ways; the name must be a column of the frame."""
    if column not in df.columns:
        raise ValueError(f"cannot sort by '{column}': not a column")
    return col(column).desc_nulls_last() if descending else col(column).asc_nulls_last()


def sort_records(
    df: DataFrame,
    column: str,
    *,
    descending: bool = False,
    tie: Sequence[str] = (FILE_POSITION,),
    integer_columns: Sequence[str] = ("ID",),
) -> DataFrame:
    """Stable sort of text records: ties keep input order in both directions.

    ``integer_columns`` compare as integers, everything else by code point.
    """
    if column not in df.columns:
        raise ValueError(f"cannot sort by '{column}': not a column")
    key = col(column).cast("long") if column in integer_columns else col(column)
    ordered = key.desc_nulls_last() if descending else key.asc_nulls_last()
    return df.orderBy(ordered, *[col(t).asc() for t in tie])


def first_ranked(ordered: DataFrame, order: Sequence[Column], n: int = 10, name: str = "rank") -> DataFrame:
    """The first ``n`` rows of an ordering, ranked from 1. ``n`` is a report size."""
    top = ordered.orderBy(*order).limit(n)
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def page_of(df: DataFrame, order: Sequence[Column], page: int, limit: int, deep: bool = False) -> DataFrame:
    """Rows of one page under a total order.

    A distributed top-k, which carries the whole offset through one task, or with ``deep`` a page
    cut out of the numbered sort, which writes the sorted table once. Both give the same rows.
    """
    offset = (page - 1) * limit
    if not deep:
        return df.orderBy(*order).offset(offset).limit(limit)
    numbered = with_position(df.orderBy(*order), "_rank")
    return numbered.filter(F.col("_rank").between(offset + 1, offset + limit)).drop("_rank")


def list_summary(df: DataFrame, column: str) -> DataFrame:
    """count, min, max, average to two places, sum; nulls for an empty list except the count."""
    value = col(column)
    return df.agg(
        F.count(value).alias("count"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.round(F.avg(value), 2).alias("average"),
        F.sum(value).alias("sum"),
    )
