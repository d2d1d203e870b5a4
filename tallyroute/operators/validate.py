"""Row validation that marks bad rows instead of failing the job.

A row's problems are one text column, built from plain conditional expressions, so a single
narrow and fully code-generated projection both checks and keeps every row; nothing is split
off and joined back to report results in input order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.functions import labels, numeric, text
from tallyroute.operators.schema import col
from tallyroute.session import materialize

#: Text of white space only, Unicode blanks included.
EMPTY = rf"(?U)^{text.BLANK}*\z"

ERROR = "error"
# Integer fields are stored in 32 bits.
INT_LIMIT = 2**31 - 1
UNKNOWN_FAILURE = "Unknown batch prediction failure"


@dataclass(frozen=True)
class FieldRule:
    """What a text field must hold: its type, inclusive bounds, and for labels a domain.

    ``ignore_case`` turns a label into the domain's spelling; otherwise labels are upper-cased.
    """

    name: str
    type: str  # 'int', 'float' or 'string'
    low: float | None = None
    high: float | None = None
    domain: Sequence[str] = field(default=())
    ignore_case: bool = False

    def parsed(self) -> Column:
        """A double for numbers, the normalized label for text; null where there is none."""
        raw = col(self.name)
        if self.type != "string":
            return numeric.parse_number(raw)
        if self.ignore_case:
            return labels.canonical(raw, self.domain)
        return labels.upper_label(raw) if self.domain else text.strip_space(raw)

    def value(self, parsed: Column, type_name: str) -> Column:
        """The typed value made from ``parsed``; null where it does not fit."""
        if self.type == "string":
            return parsed
        if self.type == "int":
            whole = numeric.is_finite(parsed) & (parsed == F.floor(parsed).cast("double"))
            return F.when(whole, parsed.try_cast(type_name))
        return parsed.try_cast(type_name)

    def message(self, parsed: Column) -> Column:
        """``field: problem`` for the first thing wrong with type and bounds, null when it is fine."""
        raw = col(self.name)

        def said(problem: str) -> Column:
            return F.lit(f"{self.name}: {problem}")

        # Message texts.
        null_text = {
            "int": "Input should be a valid integer",
            "float": "Input should be a valid number",
            "string": "Input should be a valid string",
        }[self.type]
        check = F.when(raw.isNull(), said(null_text))
        if self.type == "string":
            check = check.when(raw.rlike(EMPTY), said("String should have at least 1 character"))
            if self.domain:
                allowed = sorted(self.domain) if self.ignore_case else self.domain
                known = parsed.isNotNull() if self.ignore_case else parsed.isin(list(self.domain))
                check = check.when(
                    ~known, said(f"Value error, {self.name} must be one of: {', '.join(allowed)}")
                )
            return check
        kind = "integer" if self.type == "int" else "number"
        article = "an integer" if self.type == "int" else "a number"
        check = check.when(
            parsed.isNull(), said(f"Input should be a valid {kind}, unable to parse string as {article}")
        )
        if self.type == "int":
            check = check.when(~numeric.is_finite(parsed), said("Input should be a finite number")).when(
                parsed != F.floor(parsed).cast("double"),
                said("Input should be a valid integer, got a number with a fractional part"),
            ).when(F.abs(parsed) > F.lit(float(INT_LIMIT)), said("Input should be a valid integer"))
        if self.low is not None:
            check = check.when(
                parsed < F.lit(float(self.low)), said(f"Input should be greater than or equal to {self.low:g}")
            )
        if self.high is not None:
            check = check.when(
                (parsed > F.lit(float(self.high))) & ~F.isnan(parsed),
                said(f"Input should be less than or equal to {self.high:g}"),
            )
        return check

    def coercion_message(self, parsed: Column) -> Column:
        """The plain type check: null, empty, not a number, not whole, not finite."""
        raw = col(self.name)
        name = f"Field '{self.name}'"
        check = F.when(raw.isNull(), F.lit(f"{name} cannot be null")).when(
            raw.rlike(EMPTY), F.lit(f"{name} cannot be empty")
        )
        if self.type == "int":
            whole = numeric.is_finite(parsed) & (parsed == F.floor(parsed).cast("double"))
            return check.when(~whole, F.lit(f"{name} must be an integer"))
        if self.type == "float":
            return check.when(parsed.isNull(), F.lit(f"{name} must be numeric")).when(
                ~numeric.is_finite(parsed), F.lit(f"{name} must be finite")
            )
        if self.ignore_case:
            allowed = ", ".join(sorted(self.domain))
            wrong = F.concat(
                F.lit(f"Invalid {self.name} '"), text.strip_space(raw), F.lit(f"'. Allowed values: {allowed}")
            )
            return check.when(parsed.isNull(), wrong)
        return check


def _with_parsed(df: DataFrame, rules: Sequence[FieldRule]) -> tuple[DataFrame, dict[str, Column]]:
    """Parse each field once, in a projection of its own, for the checks and values above it."""
    staged = df.select("*", *[r.parsed().alias(f"_p_{i}") for i, r in enumerate(rules)])
    return staged, {r.name: F.col(f"_p_{i}") for i, r in enumerate(rules)}


def check(
    df: DataFrame,
    rules: Sequence[FieldRule],
    types: dict[str, str] | None = None,
    extras: Sequence[str] = (),
    error: str = ERROR,
) -> DataFrame:
    """Add ``error``: ``field: message`` pairs in rule order joined by ``; ``, null for a good row.

    A rule whose column is absent counts as a missing required field; ``extras`` are columns
    that are not permitted. With ``types`` the text fields become typed values of those types.
    Rows that pass the rules must also be finite, which reports the first failure alone.
    """
    present = [r for r in rules if r.name in df.columns]
    staged, parsed = _with_parsed(df, present)

    found = [
        r.message(parsed[r.name]) if r.name in parsed else F.lit(f"{r.name}: Field required") for r in rules
    ]
    found += [F.lit(f"{e}: Extra inputs are not permitted") for e in extras]
    listed = F.concat_ws("; ", *found) if found else F.lit("")
    infinite = [
        F.when(~numeric.is_finite(parsed[r.name]), F.lit(f"Field '{r.name}' must be finite"))
        for r in present
        if r.type == "float"
    ]
    late = F.coalesce(*infinite, F.lit(None).cast("string"))
    values = {r.name: r.value(parsed[r.name], types.get(r.name, "string")) for r in present} if types else {}
    flagged = staged.withColumn("_listed", listed)
    return flagged.select(
        *[values[c].alias(c) if c in values else col(c) for c in df.columns],
        F.when(F.col("_listed") != "", F.col("_listed")).otherwise(late).alias(error),
    )


def coercion_errors(df: DataFrame, rules: Sequence[FieldRule], error: str = ERROR) -> DataFrame:
    """Add the first failure of the plain type checks, in rule order; null for a good row."""
    staged, parsed = _with_parsed(df, rules)
    first = F.coalesce(*[r.coercion_message(parsed[r.name]) for r in rules])
    return staged.select(*[col(c) for c in df.columns], first.alias(error))


def split_valid(checked: DataFrame, error: str = ERROR) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and rejected rows; each input row is in exactly one of them.

    The checked rows are written once, so the checks do not run again for each side.
    """
    written = materialize(checked, "checked")
    return written.filter(col(error).isNull()), written.filter(col(error).isNotNull())


def field_errors(record: Column, expected: Sequence[str]) -> Column:
    """Required and unexpected keys of a map record as one message, null when the keys fit."""
    wanted = F.array(*[F.lit(e) for e in expected])
    keys = F.map_keys(record)
    missing = F.array_sort(F.array_except(wanted, keys))
    extra = F.array_sort(F.array_except(keys, wanted))
    listed = F.concat_ws(
        "; ",
        F.when(F.size(missing) > 0, F.concat(F.lit("Missing required fields: "), F.array_join(missing, ", "))),
        F.when(F.size(extra) > 0, F.concat(F.lit("Unexpected fields: "), F.array_join(extra, ", "))),
    )
    return F.when(listed != "", listed)


def merge_results(base: DataFrame, scored: DataFrame, rejected: DataFrame, index: str = "row_index") -> DataFrame:
    """One result per input row from two partial results, gaps marked as failures.

    All three are keyed by ``index``; the partial results hold probability, prediction, error.
    """
    fields = [index, "probability", "prediction", "error"]
    results = scored.select(*fields).unionByName(rejected.select(*fields)).withColumn("_found", F.lit(True))
    joined = base.select(index).join(results, index, "left")
    return joined.select(
        index,
        "probability",
        "prediction",
        F.when(F.col("_found").isNull(), F.lit(UNKNOWN_FAILURE)).otherwise(F.col("error")).alias("error"),
    )


def contract_violations(results: DataFrame) -> DataFrame:
    """Successful results that break the output contract: probability in [0,1], prediction 0 or 1."""
    probability, prediction = F.col("probability"), F.col("prediction")
    kept = F.coalesce(probability.between(0.0, 1.0) & prediction.isin(0, 1), F.lit(False))
    return results.filter(F.col("error").isNull() & ~kept)


def successful(results: DataFrame) -> DataFrame:
    """Results without an error. Pass a written result table: a filter on results that are still
    to be computed would make Spark evaluate every check twice."""
    return results.filter(F.col("error").isNull())
