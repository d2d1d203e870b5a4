"""Numeric expressions."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroute.functions.text import BLANK

# What a number may look like: decimal notation, or a spelling of infinity or NaN. Spark's own
# cast would also take '3d' and hexadecimal forms.
NUMBER_PATTERN = (
    rf"(?U)^{BLANK}*([+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity)|(?i:nan))){BLANK}*\z"
)


# Of texts made of these characters alone Spark's cast takes just the decimal notation above.
PLAIN_CHARACTERS = "0123456789.+-eE"


def parse_number(text: Column) -> Column:
    """Text to double; null when it is not a number. Inf and NaN spellings are kept as such.

    Only texts with other characters (blanks, words) go through the pattern, which costs many times the cast.
    """
    plain = F.translate(text, PLAIN_CHARACTERS, "") == ""
    # A text that doesn't match gives an empty group, which no number is read from.
    return F.when(plain, text.try_cast("double")).otherwise(F.regexp_extract(text, NUMBER_PATTERN, 1).try_cast("double"))


def strict_number(text: Column, name: str) -> Column:
    """Text to double; a text that is not a number fails the job."""
    message = F.concat(F.lit(f"column '{name}' holds no number: "), text)
    return F.coalesce(parse_number(text), F.when(text.isNotNull(), F.raise_error(message).cast("double")))


def is_finite(col: Column) -> Column:
    """False for null, NaN (which Spark orders above every number) and both infinities."""
    return F.coalesce(F.abs(col) <= F.lit(sys.float_info.max), F.lit(False))


def parse_whole(text: Column) -> Column:
    """Text such as ``3`` or ``3.0`` to int; null for anything else."""
    number = parse_number(text)
    whole = is_finite(number) & (number == F.floor(number).cast("double"))
    return F.when(whole, number.try_cast("int"))


def ratio(numerator: Column, denominator: Column, otherwise: float = 0.0) -> Column:
    """Division that gives ``otherwise`` where the denominator is zero or null."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.coalesce(quotient, F.lit(float(otherwise)))


def rounded(col: Column, digits: int = 6) -> Column:
    """Rounded double with null shown as 0.0, as the statistics tables want it."""
    return F.coalesce(F.round(col.cast("double"), digits), F.lit(0.0))


def at_least(col: Column, threshold: float) -> Column:
    """0/1 label on the unrounded score; a NaN score is never a positive."""
    return ((col >= F.lit(float(threshold))) & ~F.isnan(col)).cast("int")


def steps_reached(col: Column, steps: Sequence[float]) -> Column:
    """How many of the ascending ``steps`` are ``<= col``, by nested comparison.

    The expression is a balanced tree, so a row costs log2(len(steps)) comparisons.
    """

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(col >= F.lit(float(steps[mid])), search(mid + 1, hi)).otherwise(search(lo, mid))

    return F.when(F.isnan(col), F.lit(0)).otherwise(search(0, len(steps)))
