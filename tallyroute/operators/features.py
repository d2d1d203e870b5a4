"""Feature expressions. Arithmetic runs in double and is stored as float, one projection in all."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroute.functions import labels
from tallyroute.operators.schema import col


def _double(name: str) -> Column:
    return col(name).cast("double")


def mean_of(names: Sequence[str]) -> Column:
    """Sum of the columns over their number; null if any is null."""
    return (reduce(add, map(_double, names)) / F.lit(float(len(names)))).cast("float")


def sum_of(names: Sequence[str]) -> Column:
    return reduce(add, map(col, names)).cast("int")


def difference(left: str, right: str) -> Column:
    return (_double(left) - _double(right)).cast("float")


def scaled_mean(scales: Mapping[str, float]) -> Column:
    """Mean of the columns after dividing each by its full scale."""
    parts = [_double(name) / F.lit(float(full)) for name, full in scales.items()]
    return (reduce(add, parts) / F.lit(float(len(parts)))).cast("float")


def flag(condition: Column) -> Column:
    """0/1, null where the condition is null."""
    return condition.cast("int")


def ratio_floor(numerator: str, denominator: str, offset: float, floor: float = 1.0) -> Column:
    """numerator / max(denominator - offset, floor); a null denominator stays null."""
    base = _double(denominator) - F.lit(float(offset))
    kept = F.when(base < floor, F.lit(float(floor))).otherwise(base)
    return (_double(numerator) / kept).cast("float")


def encoded(
    name: str, codes: Mapping[str, int], aliases: Mapping[str, str] | None = None, other: str | None = None
) -> Column:
    """Integer code of a label column.

    With ``other`` the label is upper-cased, aliased, and falls back to that bucket; without
    it the label must have a code.
    """
    if other is None:
        return labels.ordinal_strict(labels.strip_space(col(name)), codes)
    label = labels.aliased(labels.upper_label(col(name)), aliases or {})
    return labels.ordinal(labels.known_or_other(label, list(codes), other), codes)
