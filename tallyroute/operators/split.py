"""Reproducible shuffle and exact-size train / val / test split.

Rows are ordered by a seeded hash of their key. The split needs only the two rows where that
order is cut, so it never sorts or moves the table: it selects the cut hashes digit by digit
(each step counts rows per next hex digits, a bounded result) and then labels every row by
comparing its own hash with them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroute.operators.ordering import partition_of
from tallyroute.operators.schema import col
from tallyroute.session import materialize
from tallyroute.sources.parquetfiles import SPLIT_NAMES

SEED = 42
# Hex digits settled per step: at most 16 ** 3 counts come back.
_DIGITS = 3
# Hex digits that fit a long; two longs cover what is left of a hash after the first step.
_LONG_DIGITS = 15


def _spans(depth: int, width: int) -> list[tuple[int, int]]:
    """Start and size of the next up to two groups of digits."""
    starts = [depth, depth + _LONG_DIGITS]
    return [(s, min(_LONG_DIGITS, width - s)) for s in starts if s < width]


def seeded_hash(key: Sequence[str], seed: int) -> Column:
    """32 hex digits from the seed and the key columns. Keys that read alike tie and are told apart by their rows."""
    parts = [F.coalesce(col(k).cast("string"), F.lit("\u0000")) for k in key]
    return F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws("\u0001", *parts)))


def _cell_text(df: DataFrame, name: str) -> Column:
    """A cell as text that no other value of its column has; instants as microseconds."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.StructType, T.MapType, T.ArrayType, T.VariantType)):
        return F.to_json(F.struct(col(name)), {"ignoreNullFields": "false"})
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col(name)).cast("string")
    return F.hex(col(name)) if isinstance(kind, T.BinaryType) else col(name).cast("string")


def row_hash(df: DataFrame, seed: int) -> Column:
    """32 hex digits over all cells. Each is written with its length, so no two rows read alike."""
    texts = [_cell_text(df, name) for name in df.columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat(F.lit(f"{seed}:"), *parts))


def shuffle_rows(df: DataFrame, key: Sequence[str], seed: int = SEED) -> DataFrame:
    """All rows in a seeded pseudo-random order."""
    return df.orderBy(seeded_hash(key, seed), *[col(k) for k in key])


@dataclass(frozen=True)
class _Cut:
    """Rows ordered before ``prefix`` come first, and ``inside`` of those that start with it."""

    prefix: str
    inside: int
    size: int


def _descend(hashed: DataFrame, wanted: dict[str, _Cut], width: int) -> dict[str, _Cut]:
    """Extend each cut's prefix by the next digits, all cuts in one pass.

    After the first step a group also tells whether its rows agree on the digits that follow.
    If so these are settled at once: copies of one key cost a few steps however many there
    are. The digits are compared as numbers, which keeps the counting in a hash aggregate.
    """
    depth = len(next(iter(wanted.values())).prefix)
    prefixes = sorted({cut.prefix for cut in wanted.values()})
    rows = hashed if depth == 0 else hashed.filter(F.substring("_h", 1, depth).isin(prefixes))
    spans = _spans(depth, width) if depth else []
    numbers = [F.conv(F.substring("_h", start + 1, size), 16, 10).cast("long") for start, size in spans]
    counts = rows.groupBy(F.substring("_h", 1, depth + _DIGITS).alias("p")).agg(
        F.count("*").alias("n"),
        F.array(*[F.min(x) for x in numbers]).alias("low"),
        F.array(*[F.max(x) for x in numbers]).alias("high"),
    )
    found = sorted(map(tuple, counts.collect()))  # at most 2 * 16 ** 3 rows
    result = {}
    for name, cut in wanted.items():
        left = cut.inside
        for prefix, n, low, high in found:
            if not prefix.startswith(cut.prefix):
                continue
            if left < n:
                if spans and low == high:
                    prefix = cut.prefix + "".join(f"{x:0{size}x}" for x, (_, size) in zip(low, spans))
                result[name] = _Cut(prefix, left, n)
                break
            left -= n
        else:
            result[name] = _Cut(cut.prefix + "g", 0, 0)  # above every hex digit: all rows first
    return result


def _find(hashed: DataFrame, open_cuts: dict[str, _Cut], width: int) -> dict[str, _Cut]:
    """Narrow the cuts until each falls between two hashes of ``width`` digits or inside one."""
    settled = {k: c for k, c in open_cuts.items() if c.inside == 0 and c.prefix}
    open_cuts = {k: c for k, c in open_cuts.items() if k not in settled}
    while open_cuts:
        depth = min(len(c.prefix) for c in open_cuts.values())
        step = _descend(hashed, {k: c for k, c in open_cuts.items() if len(c.prefix) == depth}, width)
        open_cuts.update(step)
        done = {k: c for k, c in open_cuts.items() if c.prefix and (c.inside == 0 or len(c.prefix) >= width)}
        settled.update(done)
        open_cuts = {k: c for k, c in open_cuts.items() if k not in done}
    return settled


def exact_split(
    df: DataFrame,
    key: Sequence[str] | None = None,
    *,
    train: float = 0.70,
    val: float = 0.15,
    seed: int = SEED,
    name: str = "split",
) -> DataFrame:
    """Add the split label: int(n * train) rows, int(n * val) rows, and the rest as test.

    ``key`` should tell rows apart; without one all columns are the key. Copies of a key that
    fall on a cut are told apart by their other columns, and rows equal in every column are
    handed out by number. ``df`` must give the same rows each time it is read.
    """
    columns = df.columns
    hashed = seeded_hash(list(key), seed) if key else row_hash(df, seed)
    n = df.count()
    ranks = {"val": int(n * train), "test": int(n * train) + int(n * val)}
    whole = {k: _Cut("", rank, n) for k, rank in ranks.items()}

    hashed = df.withColumn("_h", hashed)
    cuts = _find(hashed.select("_h"), whole, 32)
    if any(c.inside for c in cuts.values()):
        # A repeated key sits on a cut: its copies, and only they, get a hash over the whole row.
        tied = sorted({c.prefix for c in cuts.values() if c.inside})
        rest = F.when(F.col("_h").isin(tied), row_hash(df, seed)).otherwise(F.lit(""))
        hashed = hashed.withColumn("_h", F.concat("_h", rest))
        cuts = _find(hashed.select("_h"), cuts, 64)

    label = (
        F.when(F.col("_h") < cuts["val"].prefix, SPLIT_NAMES[0])
        .when(F.col("_h") < cuts["test"].prefix, SPLIT_NAMES[1])
        .otherwise(SPLIT_NAMES[2])
    )
    labelled = hashed.withColumn(name, label)
    shared = sorted({c.prefix for c in cuts.values() if c.inside})
    if not shared:
        return labelled.drop("_h")

    # Rows equal in every column straddle a cut: these rows are written once and numbered where they are.
    part = partition_of("_id")
    tied = labelled.filter(F.col("_h").isin(shared)).withColumn("_id", F.monotonically_increasing_id())
    written = materialize(tied.withColumn("_part", part), "tied")
    sizes = written.groupBy("_h", "_part").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy("_h").orderBy("_part")) - F.col("_rows")
    inside = F.row_number().over(Window.partitionBy("_h", "_part").orderBy("_id"))
    numbered = written.withColumn("_n", inside).join(
        materialize(sizes.select("_h", "_part", before.alias("_before")), "offsets"), ["_h", "_part"]
    )
    number = F.col("_before") + F.col("_n")
    dealt = F.lit(None).cast("string")
    for prefix in shared:
        of = {k: c.inside for k, c in cuts.items() if c.prefix == prefix}
        first, second = of.get("val", 0), of.get("test", next(c.size for c in cuts.values() if c.prefix == prefix))
        here = F.when(number <= first, SPLIT_NAMES[0]).when(number <= second, SPLIT_NAMES[1]).otherwise(SPLIT_NAMES[2])
        dealt = F.when(F.col("_h") == prefix, here).otherwise(dealt)
    rest = labelled.filter(~F.col("_h").isin(shared))
    return rest.drop("_h").unionByName(numbered.withColumn(name, dealt).select(*map(col, [*columns, name])))


def split_sizes(split: DataFrame, name: str = "split") -> DataFrame:
    return split.groupBy(name).agg(F.count("*").alias("rows"))
