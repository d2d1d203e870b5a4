"""Number formatting for report tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroute.functions.numeric import rounded


def thousands(col: Column) -> Column:
    return F.format_number(F.coalesce(col.cast("long"), F.lit(0).cast("long")), 0)


def two_places(col: Column) -> Column:
    return F.format_string("%.2f", rounded(col, 15))


def percent(col: Column) -> Column:
    """A share up to 1 is scaled by 100; a larger value is already a percentage."""
    value = F.coalesce(col.cast("double"), F.lit(0.0))
    return F.format_string("%.2f%%", F.when(value <= 1, value * 100).otherwise(value))


def cost_text(cost: Column, metric: str, units: Mapping[str, str]) -> Column:
    return F.format_string(f"%.1f {units[metric]}", cost)
