"""Column-level checks: types, presence, order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroute.functions import numeric

NUMERIC_TYPES = (T.FloatType, T.DoubleType, T.IntegerType, T.LongType)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str):
    """A column by its exact name, whatever characters it holds."""
    return F.col(quoted(name))


def cast_strict(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the declared columns that are present; a bad value fails the job.

    Text becomes a number only if all of it is one; an integer column may be written as ``3.0``.
    """
    declared = {f.name: f.dataType for f in schema.fields}

    def typed(field: T.StructField):
        target = declared.get(field.name)
        if target is None or target == field.dataType:
            return col(field.name)
        from_text = isinstance(field.dataType, T.StringType)
        if from_text and isinstance(target, (T.IntegerType, T.FloatType, T.DoubleType)):
            return numeric.strict_number(col(field.name), field.name).cast(target).alias(field.name)
        return col(field.name).cast(target).alias(field.name)

    return df.select(*[typed(f) for f in df.schema.fields])


class ColumnMismatch(ValueError):
    """A table's columns are not the declared ones; ``absent`` and ``surplus`` name them."""

    def __init__(self, absent: Sequence[str], surplus: Sequence[str]):
        self.absent, self.surplus = list(absent), list(surplus)
        super().__init__(f"columns differ from the declaration: {self.absent} are not there, {self.surplus} are not declared")


def fitted(df: DataFrame, declared: Sequence[str], *, exact: bool = False) -> DataFrame:
    """``df`` if it has every declared column; with ``exact`` just these, in the declared order.

    An undeclared column is accepted only without ``exact``.
    """
    either = set(declared) ^ set(df.columns)
    absent, surplus = [sorted(either & set(side)) for side in (declared, df.columns)]
    if absent or (exact and surplus):
        raise ColumnMismatch(absent, surplus)
    return df.select(*map(col, declared)) if exact else df


def describe(df: DataFrame) -> DataFrame:
    """One row per column: position (0-based), column_name, column_type."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, column_type string"
    )


def column_report(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Missing and extra columns against an expected list; each kind keeps its own list's order."""
    spark = df.sparkSession
    wanted = spark.createDataFrame(
        list(enumerate(expected)), "position int, column_name string"
    )
    actual = describe(df).select("position", "column_name")
    missing = wanted.join(actual, "column_name", "left_anti").withColumn("status", F.lit("missing"))
    extra = actual.join(wanted, "column_name", "left_anti").withColumn("status", F.lit("extra"))
    return missing.unionByName(extra).select("status", "position", "column_name")


def column_difference(spark: SparkSession, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """One row: the sorted names only on the left and only on the right."""
    pair = spark.createDataFrame(
        [(list(left), list(right))], "l array<string>, r array<string>"
    )
    return pair.select(
        F.array_sort(F.array_except("l", "r")).alias("only_left"),
        F.array_sort(F.array_except("r", "l")).alias("only_right"),
    )


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude
    ]


def rename_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Accept alternative input names: ``aliases`` maps the alias to the real name."""
    for alias, name in aliases.items():
        if alias in df.columns and name not in df.columns:
            df = df.withColumnRenamed(alias, name)
    return df


#: What a value must look like to count as of a type, narrowest first; every value is a string.
TYPE_PATTERNS = {
    "boolean": r"(?i)true|false",
    "bigint": r"[+-]?[0-9]{1,18}",
    "double": r"(?i)[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|[+-]?inf(inity)?|nan",
    "date": r"[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])",
}


def inferred_types(df: DataFrame) -> DataFrame:
    """column, type, values, missing: the narrowest type that every value of each text column has, blanks around it aside.

    All rows are looked at, in one aggregate: a row is of the types its cell matches, and a column of those that none of its cells
    rules out, so parts of a table can be looked at in any order. Null and blank cells are missing; a
    column without a value is of type string. Impossible days (such as 30 February) make a column text.
    """
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(c).alias("column"), F.trim(col(c).cast("string")).alias("cell")) for i, c in enumerate(df.columns)])).alias("x"))
    cell = F.when(F.col("x.cell") != "", F.col("x.cell"))
    fits = [
        F.bool_and(cell.rlike(rf"^(?:{pattern})\z") & (cell.try_cast("date").isNotNull() if kind == "date" else F.lit(True))).alias(kind)
        for kind, pattern in TYPE_PATTERNS.items()
    ]
    counted = cells.groupBy("x.place", "x.column").agg(F.count(cell).alias("values"), F.count_if(cell.isNull()).alias("missing"), *fits)
    kind = F.lit("string")
    for name in reversed(TYPE_PATTERNS):
        kind = F.when(F.col(name), F.lit(name)).otherwise(kind)
    return counted.orderBy("place").select("column", kind.alias("type"), "values", "missing")
