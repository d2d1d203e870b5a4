"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Unicode white space and the four information separators.
BLANK = r"[\s\x1c-\x1f]"


def strip_space(col: Column) -> Column:
    """Trim every kind of white space, no-break and other Unicode blanks included."""
    return F.regexp_replace(F.regexp_replace(col, rf"(?U)^{BLANK}+", ""), rf"(?U){BLANK}+\z", "")


def contains_ignoring_case(col: Column, needle: str) -> Column:
    """``col ILIKE '%needle%'`` where ``%`` and ``_`` in the needle stay wildcards.

    Backslash must be an ordinary character, so the escape character is one that the needle
    does not hold.
    """
    escape = next(c for c in map(chr, range(1, 0x110000)) if c not in needle and c not in "%_")
    return F.ilike(col, F.lit(f"%{needle}%"), F.lit(escape))


def path_text(path: Column, separator: str = " › ") -> Column:
    """Nodes of a path joined into one line."""
    return F.array_join(path.cast("array<string>"), separator)
