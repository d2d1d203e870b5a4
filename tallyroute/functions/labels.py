"""Categorical label expressions: aliases, unknown bucket, codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroute.functions.text import strip_space


def _literal_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def upper_label(col: Column) -> Column:
    return strip_space(F.upper(col))


def aliased(col: Column, aliases: Mapping[str, str]) -> Column:
    """Replace known short forms, keep everything else."""
    if not aliases:
        return col
    return F.coalesce(F.try_element_at(_literal_map(aliases), col), col)


def known_or_other(col: Column, domain: Sequence[str], other: str = "OTHER") -> Column:
    """Labels outside the domain, and null, become ``other``."""
    return F.when(col.isin(list(domain)), col).otherwise(F.lit(other))


def ordinal(col: Column, codes: Mapping[str, int]) -> Column:
    """Integer code of a label; null for a label without a code."""
    return F.try_element_at(_literal_map(codes), col).cast("int")


def ordinal_strict(col: Column, codes: Mapping[str, int]) -> Column:
    """Integer code of a label; a non-null label without a code fails the job."""
    message = F.concat(F.lit("no code for label "), col)
    return F.when(
        col.isNotNull() & ~col.isin(list(codes)), F.raise_error(message).cast("int")
    ).otherwise(ordinal(col, codes))


def canonical(col: Column, domain: Sequence[str]) -> Column:
    """The domain's own spelling of a label given in any case; null when it is not in the domain."""
    return F.try_element_at(
        _literal_map({label.lower(): label for label in domain}), F.lower(strip_space(col))
    )


def shown(col: Column, missing: str = "Unknown") -> Column:
    return F.coalesce(col.cast("string"), F.lit(missing))
