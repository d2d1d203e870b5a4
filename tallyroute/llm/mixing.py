"""Mixing sources to target weights by min-cost flow.

A document may belong to several sources. Documents are aggregated by membership pattern; tokens flow
from patterns to the quotas of their sources, where the k-th repetition of a token costs k - 1, so
capacity is used evenly before anything is repeated again. The flow is a table of one row per
pattern. Each pattern's documents stand in seeded order on a ring, and every source takes a stretch
of it; the borders of the stretches are found digit by digit in sums over ranks, so no pattern, however
large, is sorted or held in one task.
"""

from __future__ import annotations

import json
import math
from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroute.llm.rows import WORD, packed, unpacked
from tallyroute.session import materialize

MAX_PATTERNS = 100_000  # rows of the pattern table that the driver may hold; more are refused, never cut
STEP_DIGITS = 3  # hex digits of a border that one pass finds, from at most 16 ** 3 sums
#: Name, first digit and number of digits of the parts of a rank (32 hex digits), each below 2^63.
RANK_PARTS = [("high", 1, 15), ("middle", 16, 15), ("low", 31, 2)]
SEED = "mix-1"


def targets(sizes: dict, weights: dict, max_repeats: int) -> dict:
    """Share of the total size per source by weight, at most ``max_repeats`` times the source's own size.

    What a full source can't take is shared again among the others by weight, until none is above.
    """
    found: dict = {}
    left, active = sum(sizes.values()), [s for s in sizes if weights[s] > 0]
    while active:
        whole = sum(weights[s] for s in active)
        full = [s for s in active if left * weights[s] > max_repeats * sizes[s] * whole]
        if not full:
            return found | {s: left * weights[s] / whole for s in active} | {s: 0.0 for s in sizes if weights[s] <= 0}
        for s in full:
            found[s] = float(max_repeats * sizes[s])
            left -= max_repeats * sizes[s]
            active.remove(s)
    return found | {s: 0.0 for s in sizes if s not in found}


def cheapest_flow(patterns: list[tuple[tuple, int]], quotas: dict, max_repeats: int) -> list[dict]:
    """Per pattern, tokens routed to each of its sources: the largest flow, at the least repetition cost.

    Repetition k of a pattern costs k - 1 a token and may carry the pattern's size. As cost sits on the
    arcs out of the origin alone, an augmenting path costs what its first arc costs: augmenting with
    the first repetition until nothing moves, then with the second and so on, is successive shortest
    paths, hence cheapest for the amount that flows.
    """
    places = {s: i for i, s in enumerate(quotas)}
    room = list(quotas.values())
    sent: list[dict] = [{} for _ in patterns]
    users: list[set] = [set() for _ in places]
    names = list(quotas)
    for _ in range(max_repeats):
        supply = [size for _, size in patterns]
        while True:
            # Breadth first from all patterns that still have supply to any source with room.
            came: dict = {("p", p): None for p, left in enumerate(supply) if left > 0}
            queue, end = deque(came), None
            while queue and end is None:
                kind, at = queue.popleft()
                if kind == "p":
                    steps = [("s", places[s]) for s in patterns[at][0] if s in places]
                else:
                    steps = [("p", p) for p in users[at]]
                for step in steps:
                    if step not in came:
                        came[step] = (kind, at)
                        if step[0] == "s" and room[step[1]] > 0:
                            end = step
                            break
                        queue.append(step)
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()  # pattern, source, pattern, ..., source
            amount = min(supply[path[0][1]], room[path[-1][1]])
            for i in range(1, len(path) - 1, 2):
                amount = min(amount, sent[path[i + 1][1]][names[path[i][1]]])
            for i in range(0, len(path) - 1, 2):
                p, s = path[i][1], names[path[i + 1][1]]
                sent[p][s] = sent[p].get(s, 0) + amount
                users[path[i + 1][1]].add(p)
                if i + 2 < len(path):
                    q = path[i + 2][1]
                    sent[q][s] -= amount
                    if not sent[q][s]:
                        del sent[q][s]
                        users[path[i + 1][1]].discard(q)
            supply[path[0][1]] -= amount
            room[path[-1][1]] -= amount
    return sent


@dataclass
class Plan:
    """sizes and targets by source; flows: one row (pattern, stretches) per pattern."""

    sizes: dict
    targets: dict
    flows: DataFrame


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")


def seeded_rank(seed: str, key: str, text: str) -> Column:
    """Seeded order of documents: hex MD5 over the seed, the key and the text's MD5. Only rows equal in both tie."""
    shown = [F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), F.coalesce(F.md5(F.col(f"`{text}`").cast("binary")), F.lit(""))]
    return F.md5(F.concat_ws(":", F.lit(seed), *shown).cast("binary"))


def pattern_of(membership: Column) -> Column:
    """Membership arrays as text; order and repeats don't matter, null sources count as one source."""
    return F.coalesce(F.to_json(F.array_sort(F.array_distinct(membership))), F.lit("[]"))


def sized(docs: DataFrame, membership: Column, key: str, text: str, seed: str) -> DataFrame:
    """row (all columns), pattern, size and rank of every document."""
    return docs.select(
        packed(docs), pattern_of(membership).alias("pattern"), word_count(text).alias("size"), seeded_rank(seed, key, text).alias("rank")
    )


def _null_last(source) -> tuple:
    return (source is None, source or "")


def plan(narrow: DataFrame, weigh, max_repeats: int) -> Plan:
    """``narrow``: pattern, size, rank, written. ``weigh``: source names in order -> weight by name."""
    spark = narrow.sparkSession
    totals = narrow.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(totals) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns; group rare sources first")
    patterns = sorted(((tuple(json.loads(r.pattern)), r.size, r.pattern) for r in totals), key=lambda x: x[2])
    names = sorted({s for members, _, _ in patterns for s in members}, key=_null_last)
    # A document of several sources counts in each of them; what is to be shared is every word once.
    sizes = {s: sum(size for members, size, _ in patterns if s in members) for s in names}
    goal = targets(sizes, weigh(names), max_repeats)
    spare = sum(size for _, size, _ in patterns) / max(1, sum(sizes.values()))
    if spare < 1:
        goal = {s: t * spare for s, t in goal.items()}
    sent = cheapest_flow([(m, size) for m, size, _ in patterns], {s: math.floor(t) for s, t in goal.items()}, max_repeats)

    stretches, borders = [], []
    for (_, size, pattern), flow in zip(patterns, sent, strict=True):
        end = 0
        for source in sorted(flow, key=_null_last):
            start, end = end, end + flow[source]
            stretches.append((pattern, source, start, end, size))
            borders += [(pattern, x % size) for x in (start, end) if x % size]
    found = _borders(spark, narrow, sorted(set(borders)))

    def border(pattern: str, x: int, size: int) -> tuple[int, str, int]:
        times, rest = divmod(x, size)
        return (times, *found[pattern, rest]) if rest else (times, "", 0)

    rows: dict[str, list] = {}
    for pattern, source, start, end, size in stretches:
        rows.setdefault(pattern, []).append((source, *border(pattern, start, size), *border(pattern, end, size)))
    kind = "pattern string, stretches array<struct<source string, t0 long, rank0 string, part0 long, t1 long, rank1 string, part1 long>>"
    return Plan(sizes, goal, spark.createDataFrame(sorted(rows.items()), kind))


def _borders(spark, narrow: DataFrame, wanted: list[tuple[str, int]]) -> dict:
    """(pattern, position) -> (rank of the document that holds it, words of that document before it).

    A pass adds up the words of the ranks that share a position's first digits, by their next digits, and
    goes on in the sum that holds the position until that sum is of a single rank. Rows of one rank are
    equal in text, and each gives an equal part of the words up to the border.
    """
    found: dict = {}
    asked = [(pattern, at, "", at) for pattern, at in wanted]  # at most two per flow of the plan
    # As whole numbers, whose least and greatest values a hash aggregate can keep.
    parts = [F.conv(F.substring("rank", start, digits), 16, 10).cast("long").alias(name) for name, start, digits in RANK_PARTS]
    rows = narrow.where("size > 0").select("pattern", "size", "rank", *parts)
    ends = [f(name).alias(f"{f.__name__}_{name}") for name, _, _ in RANK_PARTS for f in (F.min, F.max)]
    running = Window.partitionBy("pattern", "prefix").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    depth = 0
    while asked:
        known = spark.createDataFrame(sorted({(pattern, prefix) for pattern, _, prefix, _ in asked}), "pattern string, prefix string")
        sums = (
            rows.withColumn("prefix", F.substring("rank", 1, depth))
            .join(F.broadcast(known), ["pattern", "prefix"])
            .groupBy("pattern", "prefix", F.substring("rank", depth + 1, STEP_DIGITS).alias("bucket"))
            .agg(F.sum("size").alias("held"), F.count(F.lit(1)).alias("n"), *ends)
            .withColumn("before", F.coalesce(F.sum("held").over(running), F.lit(0)))
        )
        places = F.broadcast(spark.createDataFrame(asked, "pattern string, at long, prefix string, rest long"))
        holders = sums.join(places, ["pattern", "prefix"]).where("rest >= before and rest < before + held").collect()
        asked = []
        for r in holders:
            if all(r[f"min_{name}"] == r[f"max_{name}"] for name, _, _ in RANK_PARTS):
                rank = "".join(f"{r[f'min_{name}']:0{digits}x}" for name, _, digits in RANK_PARTS)
                found[r.pattern, r.at] = rank, (r.rest - r.before) // r.n  # equal rows share the words up to the border
            else:
                asked.append((r.pattern, r.at, r.prefix + r.bucket, r.rest - r.before))
        depth += STEP_DIGITS
    return found


def assigned(rows: DataFrame, flows: DataFrame) -> DataFrame:
    """``rows`` (pattern, size, rank, ...) with takes: array of (source, words), sources without words left out."""

    def upto(times: Column, rank: Column, part: Column) -> Column:
        held = F.when(F.col("rank") < rank, F.col("size")).when(F.col("rank") == rank, F.least("size", part)).otherwise(F.lit(0))
        return times * F.col("size") + held

    takes = F.transform(
        "stretches",
        lambda s: F.struct(
            s.source.alias("source"),
            (upto(s.t1, s.rank1, s.part1) - upto(s.t0, s.rank0, s.part0)).alias("words"),
        ),
    )
    joined = rows.join(F.broadcast(flows), "pattern", "left")  # one row per pattern, at most MAX_PATTERNS
    return joined.withColumn("takes", F.coalesce(F.filter(takes, lambda t: t.words > 0), F.array().cast("array<struct<source:string,words:bigint>>"))).drop(
        "stretches"
    )


def repeating(weights: list[int]):
    """Weigh sources in order: ``weights``, repeating."""
    return lambda names: {name: weights[i % len(weights)] for i, name in enumerate(names)}


def mix(docs: DataFrame, membership: Column, weigh, key: str = "doc_id", text: str = "text", max_repeats: int = 3, seed: str = SEED):
    """(rows, plan): rows holds row (all columns of ``docs``), size and takes for every document.

    Null and empty texts have size zero and are never taken; a null source is a source of its own; a
    document without any source is never taken; rows equal in key and text share their place in the
    order and are each taken like the others. The words a source takes differ from its target by less than
    one word, and by less than a word a copy where copies of one row lie at the border of a stretch.
    """
    whole = sized(docs, membership, key, text, seed)
    made = plan(materialize(whole.select("pattern", "size", "rank"), "sizes"), weigh, max_repeats)
    return assigned(whole, made.flows).select("row", "size", "takes"), made


def mixed_documents(docs: DataFrame, membership: Column, weigh, key: str = "doc_id", text: str = "text", max_repeats: int = 3):
    """The rows of ``docs``, each as often as it is taken: the document at a border counts as whole if half of it is."""
    rows, _ = mix(docs, membership, weigh, key, text, max_repeats)
    words = F.aggregate("takes", F.lit(0).cast("long"), lambda total, take: total + take.words)
    copies = F.floor((2 * words + F.col("size")) / F.greatest(2 * F.col("size"), F.lit(1))).cast("int")
    taken = rows.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0)).where("copies > 0")
    return unpacked(taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))), docs.columns)
