"""CSV records whose quoted cells may hold line breaks, read by as many tasks as the file has splits.

Whether a line begins inside a quoted cell depends on all text before it, which a split does not see. So a task notes for
each line of its split what holds if the split began outside a quoted cell, and what if inside. A split then is a map from the
state before it to the state behind it: one row per split, combined in order, tells each split its state, and every line
which record it belongs to. Only the lines of records that are broken over several lines are brought together.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyroute.session import materialize

OPTIONS = {"escape": '"', "mode": "PERMISSIVE"}
EMPTY = ("", "\r")
LINES_DDL = "file string, block long, seq long, line string, starts array<boolean>, ends array<boolean>, record array<long>, at array<long>"
LINES = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("line", pa.string()), ("starts", pa.list_(pa.bool_())),
     ("ends", pa.list_(pa.bool_())), ("record", pa.list_(pa.int64())), ("at", pa.list_(pa.int64()))]
)


def inside_after(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open behind a line, given whether one was open before it.

    A quote opens a cell only as its first character; two quotes in an open cell stand for one.
    """
    at = 0
    while True:
        if not inside:
            if line[at : at + 1] == '"':
                at += 1
            else:
                at = line.find(',"', at) + 2
                if at == 1:
                    return False
        inside = False
        while True:
            at = line.find('"', at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] != '"':
                break
            at += 2
        at += 1


def _noted(batches):
    """Every line with both of its possible states; ``record`` and ``at``: line number and ordinal of its record in the split."""
    split, rows = None, []
    for batch in batches:
        for file, block, line in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
            if (file, block) != split:
                split, seq = (file, block), 0
                now, record, ordinal = [False, True], [None, None], [-1, -1]
            before, quoted = list(now), '"' in line
            for i in range(2):
                if not before[i] and line not in EMPTY:
                    record[i], ordinal[i] = seq, ordinal[i] + 1
                if quoted:
                    now[i] = inside_after(line, before[i])
            rows.append((file, block, seq, line, before, list(now), list(record), list(ordinal)))
            seq += 1
            if len(rows) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), LINES)], schema=LINES)
                rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), LINES)], schema=LINES)


def _states(lines: DataFrame) -> DataFrame:
    """file, block, state (0 outside, 1 inside a cell, before the split), open_block, open_record, open_at: the record open then."""
    last = F.max(F.struct("seq", "ends", "record", "at")).alias("last")
    splits = lines.groupBy("file", "block").agg(last).select(
        "file", "block", F.col("last.ends").cast("array<int>").alias("ends"), F.col("last.record").alias("record"), F.col("last.at").alias("at")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # A split either ends in one state whatever the state before it, or keeps it, or turns it over.
    fixed = F.col("ends")[0] == F.col("ends")[1]
    turned = splits.withColumn("turns", F.sum((F.col("ends")[0] > F.col("ends")[1]).cast("int")).over(before.rowsBetween(Window.unboundedPreceding, 0)))
    known = turned.withColumn("fixed", F.last(F.when(fixed, F.struct(F.col("ends")[0].alias("to"), "turns")), True).over(before))
    known = known.withColumn("before", F.coalesce(F.lag("turns").over(Window.partitionBy("file").orderBy("block")), F.lit(0)))
    state = F.pmod(F.coalesce("fixed.to", F.lit(0)) + F.col("before") - F.coalesce("fixed.turns", F.lit(0)), F.lit(2)).cast("int")
    stated = known.withColumn("state", state)
    own = F.get("record", F.col("state"))
    opened = F.when(own.isNotNull(), F.struct("block", own.alias("record"), F.get("at", F.col("state")).alias("at")))
    held = stated.withColumn("open", F.last(opened, True).over(before))
    return held.select("file", "block", "state", *[F.col(f"open.{n}").alias(f"open_{n}") for n in ("block", "record", "at")])


def records(spark: SparkSession, path: str) -> DataFrame:
    """position (file, block, seq: dense in each split), record: the text of every record, the files' headers included.

    Empty lines between records are no records. A line ends with a line feed; a carriage return before it is part of a
    cell's text inside a cell, and no part of a record at its end.
    """
    text = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value")
    )
    lines = materialize(text.mapInArrow(_noted, LINES_DDL), "lines")
    known = lines.join(materialize(_states(lines), "states"), ["file", "block"])
    pick = lambda name: F.get(name, F.col("state"))
    own = pick("record").isNotNull()
    placed = known.select(
        "file", F.col("block").alias("line_block"), "seq", "line", pick("starts").alias("inside"), pick("ends").alias("open"),
        F.when(own, F.col("block")).otherwise(F.col("open_block")).alias("block"),
        F.when(own, pick("record")).otherwise(F.col("open_record")).alias("record"), F.when(own, pick("at")).otherwise(F.col("open_at")).alias("at"),
    ).where(F.col("inside") | ~F.col("line").isin(*EMPTY))

    def whole(text: Column) -> Column:
        return F.regexp_replace(text, "\r\\z", "")

    position = F.struct("file", "block", F.col("at").alias("seq")).alias("position")
    single = placed.where("not inside and not open").select(position, whole(F.col("line")).alias("record"))
    parts = placed.where("inside or open").groupBy("file", "block", "record", "at").agg(F.array_sort(F.collect_list(F.struct("line_block", "seq", "line"))).alias("lines"))
    return single.unionByName(parts.select(position, whole(F.array_join("lines.line", "\n")).alias("record")))


def table(spark: SparkSession, path: str, columns: list[str], position: str) -> DataFrame:
    """The records below each file's header, every cell as text, plus each one's place in its file."""
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    below = records(spark, path).where("position.block > 0 or position.seq > 0")
    parsed = below.select("position", F.from_csv("record", F.lit(schema), OPTIONS).alias("cells"))
    return parsed.select(*[F.col(f"cells.c{i}").alias(name) for i, name in enumerate(columns)], F.col("position").alias(position))
