"""Dataset statistics: KPIs, distributions, correlations, column statistics, linear fit, insights."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.functions import formats, labels, numeric
from tallyroute.operators.schema import col

UNKNOWN = "Unknown"


def overview(df: DataFrame, target: str, means: Sequence[str]) -> DataFrame:
    """One row: total, placement_rate (6 places), avg_<column> (4 places); zeros when empty."""
    return df.agg(
        F.count("*").alias("total"),
        numeric.rounded(F.avg(col(target)), 6).alias("placement_rate"),
        *[numeric.rounded(F.avg(col(m)), 4).alias(f"avg_{m}") for m in means],
    )


def target_counts(df: DataFrame, target: str) -> DataFrame:
    """One row: row_count, placed, not_placed, where rows without a target count as not placed."""
    placed = F.coalesce(F.sum(col(target).cast("long")), F.lit(0).cast("long"))
    return df.agg(F.count("*").alias("row_count"), placed.alias("placed")).withColumn(
        "not_placed", F.greatest(F.lit(0).cast("long"), F.col("row_count") - F.col("placed"))
    )


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """One row: placed, not_placed (target is zero), total."""
    return df.agg(
        F.coalesce(F.sum(col(target).cast("long")), F.lit(0).cast("long")).alias("placed"),
        F.count_if(col(target) == 0).alias("not_placed"),
        F.count("*").alias("total"),
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """label, count, most frequent first; null is shown as Unknown, ties by label."""
    counts = df.groupBy(col(column).alias("_label")).agg(F.count("*").alias("count"))
    return counts.select(labels.shown(F.col("_label"), UNKNOWN).alias("label"), "count").orderBy(
        F.desc("count"), "label"
    )


def distribution_percent(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """label, count, percent of all rows; the total is a scalar subquery over the label counts."""
    counts = distribution(df, column)
    total = counts.agg(F.sum("count").alias("total")).scalar()
    share = F.round(numeric.ratio(F.col("count"), total) * 100, digits)
    return counts.select("label", "count", share.alias("percent")).orderBy(F.desc("count"), "label")


def _pair_correlation(left: str, right: str) -> Column:
    x, y = col(left).cast("double"), col(right).cast("double")
    # The three sums run over the rows where both values are present.
    spread = F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x))
    return F.try_divide(F.regr_sxy(y, x), spread)


def _means(row, names: Sequence[str]) -> list[float]:
    return [v if (v := row[name]) is not None and math.isfinite(v) else 0.0 for name in names]


def _centres(df: DataFrame, columns: Sequence[str]) -> tuple[list[float], bool]:
    """Mean of each column's finite values over all rows, and whether every row has them all."""
    values = [(f"c{i}", col(c).cast("double")) for i, c in enumerate(columns)]
    row = df.agg(
        F.count("*").alias("rows"),
        F.least(*[F.count(v) for _, v in values], F.count("*")).alias("least"),
        *[F.avg(F.when(numeric.is_finite(v), v)).alias(name) for name, v in values],
    ).first()
    return _means(row, [name for name, _ in values]), row["rows"] == row["least"]


def _correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """a, b, r for each pair of column numbers a < b that occur together.

    One pass for the means, one for the sums, and one between where values are missing. Each row is stacked once per column, and the copy of column x adds up n, sum y,
    sum xy and sum yy for every y: a few dozen plain sums that stay in one generated loop, where
    an aggregate per pair would not. They are reduced before the shuffle to one row per column.
    """
    size = range(len(columns))
    centres, complete = _centres(df, columns)
    shifted = df.select(*[(col(c).cast("double") - F.lit(m)).alias(f"z{i}") for i, (c, m) in enumerate(zip(columns, centres))])
    copies = shifted.select(
        "*", F.stack(F.lit(len(columns)), *[v for i in size for v in (F.lit(i), F.col(f"z{i}"))]).alias("x", "zx")
    ).filter(F.col("zx").isNotNull())
    y, x = {j: F.col(f"z{j}") for j in size}, {j: F.col("zx") for j in size}
    if not complete:
        # The rows of a pair may lie far from a column's mean: shift once more, by the means of each pair's own rows.
        own = {r["x"]: _means(r, [f"m{j}" for j in size]) for r in copies.groupBy("x").agg(*[F.avg(f"z{j}").alias(f"m{j}") for j in size]).collect()}
        beside = [own.get(i, [0.0] * len(columns)) for i in size]
        at_x = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("x") + 1)
        y = {j: y[j] - at_x([beside[i][j] for i in size]) for j in size}
        x = {j: x[j] - at_x(beside[j]) for j in size}
    sums = copies.groupBy("x").agg(
        *[F.count(f"z{j}").alias(f"n{j}") for j in size],
        *[F.sum(y[j]).alias(f"s{j}") for j in size],
        *[F.sum(y[j] * x[j]).alias(f"p{j}") for j in size],
        *[F.sum(y[j] * y[j]).alias(f"q{j}") for j in size],
    )
    # From here on there are len(columns) ** 2 rows. Of a pair a < b, the copy of a holds the sums
    # of b and the copy of b those of a, each over the rows where both are present.
    cells = [F.struct(F.lit(j).alias("y"), *[F.col(f"{k}{j}").cast("double").alias(k) for k in "nspq"]) for j in size]
    matrix = sums.select("x", F.inline(F.array(*cells))).filter("x <> y")
    of_a, of_b = F.col("x") > F.col("y"), F.col("x") < F.col("y")
    pairs = matrix.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(
        F.max("n").alias("n"),
        F.max("p").alias("p"),
        *[F.max(F.when(of_a, F.col(k))).alias(f"{k}a") for k in "sq"],
        *[F.max(F.when(of_b, F.col(k))).alias(f"{k}b") for k in "sq"],
    )
    n, zero = F.col("n"), F.lit(0.0)
    spread_a = F.greatest(n * F.col("qa") - F.col("sa") * F.col("sa"), zero)
    spread_b = F.greatest(n * F.col("qb") - F.col("sb") * F.col("sb"), zero)
    cross = n * F.col("p") - F.col("sa") * F.col("sb")
    return pairs.select("a", "b", F.try_divide(cross, F.sqrt(spread_a) * F.sqrt(spread_b)).alias("r"))


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlations as column_x, column_y, correlation for every ordered pair.

    Each pair uses the rows where both values are present. Columns the frame does not have are
    left out; the diagonal is 1 and an undefined correlation is 0.
    """
    present = [c for c in columns if c in df.columns]
    names = [(min(i, j), max(i, j), x, y) for i, x in enumerate(present) for j, y in enumerate(present)]
    grid = df.sparkSession.createDataFrame(names, "a int, b int, column_x string, column_y string")
    if not present:
        return grid.select("column_x", "column_y", F.lit(1.0).alias("correlation"))
    found = grid.join(_correlations(df, present), ["a", "b"], "left")
    value = F.when(F.col("a") == F.col("b"), F.lit(1.0)).otherwise(numeric.rounded(F.col("r"), digits))
    return found.select("column_x", "column_y", value.alias("correlation"))


_STATS = ("mean", "std", "min", "max")


def column_stats(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """column, mean, std (sample), min, max: one pass, one output row per column.

    The columns are stacked and reduced by four aggregates however many there are.
    """
    names = F.array(*[F.lit(c) for c in columns])
    stacked = df.select(
        F.stack(
            F.lit(len(columns)), *[v for i, c in enumerate(columns) for v in (F.lit(i), col(c).cast("double"))]
        ).alias("i", "v")
    )
    aggregates = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    reduced = stacked.groupBy("i").agg(*[F.round(aggregates[s]("v"), digits).alias(s) for s in _STATS])
    return reduced.select(F.element_at(names, F.col("i") + 1).alias("column"), *_STATS)


def field_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, low, high over the numeric columns named."""
    row = df.agg(
        *[F.min(col(c).cast("double")).alias(f"low_{i}") for i, c in enumerate(columns)],
        *[F.max(col(c).cast("double")).alias(f"high_{i}") for i, c in enumerate(columns)],
    )
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"low_{i}").alias("low"), F.col(f"high_{i}").alias("high"))
        for i, c in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*cells)))


def feature_document(
    train: DataFrame,
    target: str,
    engineered: Sequence[str],
    encodings: Mapping[str, Mapping[str, int]],
    numeric_features: Sequence[str],
    digits: int = 4,
) -> DataFrame:
    """One nested row that describes the training table, ready to be written as JSON."""
    balance = class_balance(train, target).select(F.struct("placed", "not_placed", "total")).scalar()

    def names(values: Sequence[str]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    # One row per feature becomes one struct with a field per feature.
    stats = column_stats(train, numeric_features, digits).agg(
        *[
            F.max(F.when(F.col("column") == c, F.struct(*_STATS))).alias(f"f{i}")
            for i, c in enumerate(numeric_features)
        ]
    )
    codes = [
        F.struct(*[F.lit(code).alias(label) for label, code in mapping.items()]).alias(name)
        for name, mapping in encodings.items()
    ]
    return stats.select(
        F.lit(target).alias("target"),
        names([c for c in train.columns if c != target]).alias("feature_columns"),
        names(numeric_features).alias("numeric_features"),
        names(engineered).alias("engineered_features"),
        *codes,
        F.struct(*[F.col(f"f{i}").alias(c) for i, c in enumerate(numeric_features)]).alias("train_stats"),
        balance.alias("class_balance"),
    )


def linear_fit(df: DataFrame, x: str, y: str, digits: int = 6) -> DataFrame:
    """One row: n, std_x, std_y, correlation, slope, intercept, r2; nulls where x does not vary."""
    xs, ys = col(x).cast("double"), col(y).cast("double")
    both = xs.isNotNull() & ys.isNotNull()
    slope = F.try_divide(F.regr_sxy(ys, xs), F.regr_sxx(ys, xs))
    correlation = _pair_correlation(x, y)
    row = df.agg(
        F.count_if(both).alias("n"),
        F.stddev_samp(F.when(both, xs)).alias("sx"),
        F.stddev_samp(F.when(both, ys)).alias("sy"),
        correlation.alias("r"),
        slope.alias("m"),
        (F.regr_avgy(ys, xs) - slope * F.regr_avgx(ys, xs)).alias("b"),
    )
    return row.select(
        "n",
        F.round("sx", digits).alias("std_x"),
        F.round("sy", digits).alias("std_y"),
        F.round("r", digits).alias("correlation"),
        F.round("m", digits).alias("slope"),
        F.round("b", digits).alias("intercept"),
        F.round(F.col("r") * F.col("r"), digits).alias("r2"),
    )


def dataset_profile(
    df: DataFrame,
    target: str,
    expected: Sequence[str],
    categories: Sequence[str],
    heatmap: Sequence[str],
) -> DataFrame:
    """The whole profile as section, item, detail, value rows.

    Counts read the target column, correlations the heatmap columns in one pass, and each
    distribution its own column.
    """
    row = target_counts(df, target)

    def cell(section: str, item: str, value: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"),
            F.lit(item).alias("item"),
            F.lit("").alias("detail"),
            value.cast("double").alias("value"),
        )

    missing = [c for c in expected if c not in df.columns]
    extra = [c for c in df.columns if c not in expected]
    cells = [
        cell("shape", "row_count", F.col("row_count")),
        cell("shape", "column_count", F.lit(len(df.columns))),
        cell("shape", "expected_column_count", F.lit(len(expected))),
        *[cell("missing_columns", c, F.lit(i)) for i, c in enumerate(missing)],
        *[cell("extra_columns", c, F.lit(i)) for i, c in enumerate(extra)],
        cell("target", "placed", F.col("placed")),
        cell("target", "not_placed", F.col("not_placed")),
    ]
    parts = [
        row.select(F.inline(F.array(*cells))),
        correlation_matrix(df, heatmap).select(
            F.lit("correlation").alias("section"),
            F.col("column_x").alias("item"),
            F.col("column_y").alias("detail"),
            F.col("correlation").alias("value"),
        ),
    ]
    for name in categories:
        counts = distribution(df, name)
        parts.append(
            counts.select(
                F.lit("distribution").alias("section"),
                F.lit(name).alias("item"),
                F.col("label").alias("detail"),
                F.col("count").cast("double").alias("value"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def kpi_cards(overview_row: DataFrame, total: str, rate: str, averages: Mapping[str, str]) -> DataFrame:
    """label, value text: a count with thousands marks, a percentage, averages to two places."""
    cells = [
        F.struct(F.lit("Total").alias("label"), formats.thousands(F.col(total)).alias("value")),
        F.struct(F.lit("Placement Rate").alias("label"), formats.percent(F.col(rate)).alias("value")),
        *[
            F.struct(F.lit(label).alias("label"), formats.two_places(F.col(name)).alias("value"))
            for label, name in averages.items()
        ],
    ]
    return overview_row.select(F.inline(F.array(*cells)))


def insights(df: DataFrame, x: str, y: str, target: str) -> DataFrame:
    """topic, text: plain sentences about the target rate and the relation of two columns."""
    xs, ys = col(x).cast("double"), col(y).cast("double")
    row = df.agg(
        F.count("*").alias("n"),
        numeric.rounded(F.avg(col(target)), 4).alias("rate"),
        numeric.rounded(_pair_correlation(x, y), 4).alias("r"),
        F.coalesce(F.try_divide(F.regr_sxy(ys, xs), F.regr_sxx(ys, xs)), F.lit(0.0)).alias("m"),
    )
    strength = (
        F.when(F.abs("r") >= 0.7, "strong").when(F.abs("r") >= 0.3, "moderate").when(F.abs("r") >= 0.1, "weak")
    ).otherwise("no clear")
    direction = F.when(F.abs("r") < 0.1, "").when(F.col("r") > 0, " positive").otherwise(" negative")
    balance = F.when(F.col("rate") >= 0.5, "At least half").otherwise("Fewer than half")
    sentences = [
        F.struct(
            F.lit("target").alias("topic"),
            F.concat(
                balance, F.lit(f" of the rows have {target} set ("), formats.percent(F.col("rate")), F.lit(").")
            ).alias("text"),
        ),
        F.struct(
            F.lit("relation").alias("topic"),
            F.concat(
                F.lit(f"{x} and {y} show a "), strength, direction, F.lit(" relation (r = "),
                F.format_string("%.4f", "r"), F.lit(")."),
            ).alias("text"),
        ),
        F.struct(
            F.lit("size").alias("topic"),
            F.concat(F.lit("The table holds "), formats.thousands(F.col("n")), F.lit(" rows.")).alias("text"),
        ),
    ]
    return row.select(F.inline(F.array(*sentences)))
