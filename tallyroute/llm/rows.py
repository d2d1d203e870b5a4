"""Helpers that the operators share: Arrow batches in, rows out, and wide rows kept apart."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Word of every contract here: a run of anything but these six ASCII blanks (``bytes.split()`` cuts at the same).
WORD = r"[^\x20\x09-\x0D]+"

FLUSH_ROWS = 4_096
FLUSH_BYTES = 16_000_000


def _weight(value) -> int:
    return len(value) if isinstance(value, (bytes, str, list)) else 8


def map_rows(df: DataFrame, schema: pa.Schema, ddl: str, each: Callable[..., Iterable[tuple]]) -> DataFrame:
    """Call ``each`` with the values of every row; the tuples it yields are the rows of the result.

    One row of the input is held as Python values at a time, and output is handed over every
    FLUSH_ROWS rows or FLUSH_BYTES bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                for made in each(*(value.as_py() for value in row)):
                    out.append(made)
                    held += sum(map(_weight, made))
                    if len(out) >= FLUSH_ROWS or held >= FLUSH_BYTES:
                        yield as_batch(out, schema)
                        out, held = [], 0
        if out:
            yield as_batch(out, schema)

    return df.mapInArrow(run, ddl)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(values, type=field.type) for field, values in zip(schema, zip(*rows, strict=True), strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def key_type(df: DataFrame, key: str) -> tuple[str, pa.DataType]:
    """The SQL and the Arrow type of a key column: whole numbers or text."""
    kind = df.schema[key].dataType.simpleString()
    return kind, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def utf8(name: str) -> Column:
    """A string column as its UTF-8 bytes; null stays null."""
    return F.col(f"`{name}`").cast("binary")


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` as one struct, so that an operator's own names can't clash with them."""
    return F.struct(*[F.col(f"`{column}`") for column in df.columns]).alias(name)


def unpacked(df: DataFrame, columns: list[str], name: str = "row") -> DataFrame:
    """The columns put away by ``packed``."""
    return df.select(*[F.col(name).getField(column).alias(column) for column in columns])
