"""CSV scans: strict typed, upload style, and plain string records; conversion and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroute.operators.ordering import FILE_POSITION, file_position
from tallyroute.operators.schema import cast_strict, col, fitted, inferred_types
from tallyroute.sources import csvrecords


#: How cells are read, by batch and stream alike: a quote inside a quoted cell is doubled, and such a cell may hold line breaks.
CELLS = {"escape": '"', "multiLine": "true"}


class EmptyUpload(ValueError):
    """The file has no content at all."""


class NoDataRows(ValueError):
    """The file has a header and nothing below it."""


class UnreadableUpload(ValueError):
    """The file cannot be read as CSV."""


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, plus the row's place in its file: file, split, and number in the split.

    Quoted cells may hold line breaks; files are split all the same (see ``csvrecords``).
    """
    named = spark.read.options(**CELLS).csv(path, header=True, inferSchema=False)  # only the header is read
    if not named.columns:  # files without any content
        return named.select(file_position().alias(FILE_POSITION))
    return csvrecords.table(spark, path, named.columns, FILE_POSITION)


def read_strict(
    spark: SparkSession, path: str, schema: T.StructType, target: str | None = None, line_breaks: bool = False
) -> DataFrame:
    """Typed scan: a value that does not fit its declared type fails the job, as does a missing column.

    Columns beyond the schema are kept as text. Rows without a target are left out. With ``line_breaks`` quoted cells may
    hold them; without, a row that such a cell has broken fails the job for its number of cells. Files are split either way.
    """
    if line_breaks:
        # Records broken over lines are read apart from the others: the sort brings them back to their places.
        raw = read_records(spark, path)
        raw = raw.orderBy(FILE_POSITION).drop(FILE_POSITION) if len(raw.columns) > 1 else raw.drop(FILE_POSITION)
    else:
        raw = spark.read.csv(path, header=True, inferSchema=False, escape='"', mode="FAILFAST")
    typed = cast_strict(fitted(raw, schema.fieldNames()), schema)
    return typed.filter(F.col(target).isNotNull()) if target else typed


def read_upload(spark: SparkSession, path: str) -> DataFrame:
    """Text records of an uploaded file, with the three unusable cases told apart."""
    try:
        records = read_records(spark, path)
    except Exception as exc:
        if "UNABLE_TO_INFER_SCHEMA" in str(exc) or "AMBIGUOUS" in str(exc):
            raise EmptyUpload("Uploaded file is empty") from exc
        raise UnreadableUpload("Invalid CSV file") from exc
    if records.columns == [FILE_POSITION]:
        raise EmptyUpload("Uploaded file is empty")
    if records.isEmpty():
        raise NoDataRows("CSV file contains no data rows")
    return records


def typed_upload(records: DataFrame, keep: Sequence[str] = (FILE_POSITION,)) -> DataFrame:
    """The records with each column as the narrowest type that all its values have (see ``schema.inferred_types``)."""
    columns = [c for c in records.columns if c not in keep]
    kinds = {r["column"]: r["type"] for r in inferred_types(records.select(*[col(c) for c in columns])).collect()}  # one row a column
    return records.select(*[col(c).try_cast(kinds[c]).alias(c) if c in kinds else col(c) for c in records.columns])


@dataclass(frozen=True)
class Conversion:
    """What a CSV to Parquet job wrote."""

    target: str
    rows: int
    columns: int


def csv_to_parquet(
    spark: SparkSession, source: str, target: str, schema: T.StructType, line_breaks: bool = False
) -> Conversion:
    """Convert and report. The row count comes from the written files' footers, not a second CSV scan."""
    write_snappy(read_strict(spark, source, schema, line_breaks=line_breaks), target)
    written = spark.read.parquet(target)
    return Conversion(target, written.count(), len(written.columns))


def write_snappy(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write Parquet in place of an older table; ``df`` must not read from ``path``."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def reconcile_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: source_rows, target_rows, match."""
    tagged = source.select(F.lit(1).alias("from_source")).unionAll(
        target.select(F.lit(0).alias("from_source"))
    )
    counts = tagged.agg(
        F.count_if(F.col("from_source") == 1).alias("source_rows"),
        F.count_if(F.col("from_source") == 0).alias("target_rows"),
    )
    return counts.withColumn("match", F.col("source_rows") == F.col("target_rows"))
