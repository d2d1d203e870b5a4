"""Filtered, sorted, paged search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.functions.text import contains_ignoring_case
from tallyroute.operators.ordering import page_of, sort_key
from tallyroute.operators.schema import col

MAX_PAGE_SIZE = 50


@dataclass(frozen=True)
class SearchSpec:
    """What to find and which page of it to show.

    ``key`` names the columns that make the order total; ``columns`` limits what is read. ``deep``
    cuts the page out of a numbered sort, for pages far from the start (see ``page_of``).
    """

    key: Sequence[str]
    text: str | None = None
    text_columns: Sequence[str] = ()
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    equals: Mapping[str, object] = field(default_factory=dict)
    sort_by: str | None = None
    descending: bool = False
    page: int = 1
    limit: int = 10
    columns: Sequence[str] | None = None
    deep: bool = False

    def __post_init__(self) -> None:
        if self.page < 1:
            raise ValueError("page must be at least 1")
        if not 1 <= self.limit <= MAX_PAGE_SIZE:
            raise ValueError(f"limit must be between 1 and {MAX_PAGE_SIZE}")

    def conditions(self) -> list[Column]:
        found: list[Column] = []
        if self.text:
            found.append(reduce(or_, [contains_ignoring_case(col(c), self.text) for c in self.text_columns]))
        for name, (low, high) in self.ranges.items():
            if low is not None:
                found.append(col(name) >= F.lit(low))
            if high is not None:
                found.append(col(name) <= F.lit(high))
        for name, value in self.equals.items():
            if value is not None:
                found.append(col(name) == F.lit(value))
        return found


def matching(df: DataFrame, spec: SearchSpec) -> DataFrame:
    """All conditions together; none means no filter."""
    conditions = spec.conditions()
    return df.filter(reduce(and_, conditions)) if conditions else df


def order_of(df: DataFrame, spec: SearchSpec) -> list[Column]:
    first = [sort_key(df, spec.sort_by, spec.descending)] if spec.sort_by else []
    return first + [col(k).asc() for k in spec.key if k != spec.sort_by]


def page(df: DataFrame, spec: SearchSpec) -> DataFrame:
    """The rows of the requested page, in order."""
    found = matching(df, spec)
    shown = found.select(*[col(c) for c in spec.columns]) if spec.columns else found
    return page_of(shown, order_of(df, spec), spec.page, spec.limit, spec.deep)


def page_after(df: DataFrame, spec: SearchSpec, last: Mapping[str, object]) -> DataFrame:
    """The page that follows the row whose order columns are ``last``, without an offset.

    Each call is a top-k of ``limit`` rows however deep it is. Nulls come last, as in ``page``.
    """
    names = ([spec.sort_by] if spec.sort_by else []) + [k for k in spec.key if k != spec.sort_by]
    beyond = F.lit(False)
    for i, name in enumerate(names):
        if last[name] is None:
            continue  # nothing follows a null in this column
        same = [col(n).eqNullSafe(F.lit(last[n])) for n in names[:i]]
        down = spec.descending and name == spec.sort_by
        step = col(name) < F.lit(last[name]) if down else col(name) > F.lit(last[name])
        beyond = beyond | reduce(and_, same + [step | col(name).isNull()])
    found = matching(df, spec).filter(F.coalesce(beyond, F.lit(False)))
    shown = found.select(*[col(c) for c in spec.columns]) if spec.columns else found
    return shown.orderBy(*order_of(df, spec)).limit(spec.limit)


def totals(df: DataFrame, spec: SearchSpec) -> DataFrame:
    """One row: total, page, limit, total_pages (0 when nothing matches)."""
    count = matching(df, spec).agg(F.count("*").alias("total"))
    return count.select(
        "total",
        F.lit(spec.page).alias("page"),
        F.lit(spec.limit).alias("limit"),
        F.ceil(F.col("total") / F.lit(spec.limit)).cast("long").alias("total_pages"),
    )


def search(df: DataFrame, spec: SearchSpec) -> tuple[DataFrame, DataFrame]:
    return page(df, spec), totals(df, spec)
