"""URL rules, and a Bloom filter cascade that gives exact membership without joins.

Level 1 encodes the listed keys, level 2 the unlisted keys of the corpus that level 1 takes for listed,
level 3 the listed keys that level 2 takes for unlisted, and so on until a level has no false positive. A
key is listed if the first level that denies it is an even one. The corpus's complete key universe is
known, so the answer is exact for every key in it. DataFrame and SQL functions throughout.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroute.session import materialize

NAME_LENGTH = 253  # longest host name that can be listed
BITS_PER_KEY = 10
HASHES = 4
BYTE_BITS = 7  # bits kept in one byte of a filter: every byte is then one ASCII character
MAX_FILTER_BYTES = 64_000_000  # of all levels together; larger lists are refused, never cut
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for a URL without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule], field: str) -> Column:
    """``field`` of the longest rule that fits, null if none does."""
    found = None
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.lit(getattr(rule, field))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return F.lit(None).cast("string") if found is None else found


def keys_of(host: Column) -> Column:
    """The host and every parent domain that is short enough to be listed, longest first."""
    tail = F.when(F.length(host) > NAME_LENGTH, F.regexp_extract(F.right(host, F.lit(NAME_LENGTH + 1)), r"(?s)^[^.]*\.(.*)$", 1))
    parts = F.split(tail.otherwise(host), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    return F.array_distinct(F.filter(suffixes, lambda key: key != ""))


@dataclass(frozen=True)
class Level:
    """``cells`` bytes of BYTE_BITS bits each."""

    number: int
    cells: bytes

    def position(self, key: Column, turn: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(self.number * HASHES + turn), key), F.lit(len(self.cells) * BYTE_BITS))

    def holds(self, key: Column) -> Column:
        """Whether all bits of the key are set: always so for an encoded key."""
        tests = []
        for turn in range(HASHES):
            at = self.position(key, turn)
            cell = F.ascii(F.substring(F.lit(self.cells), (F.floor(at / BYTE_BITS) + 1).cast("int"), F.lit(1)).cast("string"))
            tests.append(F.getbit(cell.cast("long"), F.pmod(at, F.lit(BYTE_BITS)).cast("int")) == 1)
        return tests[0] & tests[1] & tests[2] & tests[3]


def cells_of(count: int, others: int) -> int:
    """Bytes of a level that encodes ``count`` keys and lets through about as many of the ``others``, or one in eighty if that is fewer.

    With HASHES bits a key, a key that isn't encoded passes with the HASHES-th power of the share of set bits.
    """
    bits = float(BITS_PER_KEY)
    if others > count:
        bits = max(bits, -HASHES / math.log1p(-((count / others) ** (1 / HASHES))))
    return max(8, math.ceil(count * bits / BYTE_BITS))


def encode(keys: DataFrame, size: int, number: int) -> Level:
    """A Bloom filter of the keys in ``size`` cells: bits are set by an aggregate, one row per cell comes back."""
    level = Level(number, bytes(size))
    at = F.explode(F.array(*[level.position(F.col("key"), turn) for turn in range(HASHES)])).alias("at")
    cells = (
        keys.select(at)
        .groupBy(F.floor(F.col("at") / BYTE_BITS).cast("int").alias("cell"))
        .agg(F.bit_or(F.expr(f"shiftleft(1, cast(pmod(at, {BYTE_BITS}) as int))")).alias("bits"))
    )
    held = bytearray(size)
    for row in cells.collect():  # at most ``size`` rows
        held[row.cell] = row.bits
    return Level(number, bytes(held))


def universe(keys: DataFrame, listed: DataFrame) -> DataFrame:
    """Every distinct key of the corpus (key), and whether it is listed: one aggregate over both, no join."""
    names = listed.select(F.translate(F.col("key"), UPPER, LOWER).alias("key")).where("key is not null")
    both = keys.select("key", F.lit(True).alias("present"), F.lit(False).alias("listed")).unionByName(
        names.select("key", F.lit(False).alias("present"), F.lit(True).alias("listed"))
    )
    return both.groupBy("key").agg(F.bool_or("present").alias("present"), F.bool_or("listed").alias("listed")).where("present").drop("present")


def cascade(keys: DataFrame, listed: DataFrame) -> list[Level]:
    """Levels that tell the listed ones of ``keys`` (key, repeats allowed) from the others; no level if none is listed.

    Each level encodes what the one before got wrong. The first is so large that no more than about as many unlisted keys pass as
    there are listed ones, however many keys the corpus has; so all levels, and what comes to the driver, are
    bounded by the list. Of the later ones ten bits and four hashes a key let about one key in eighty through.
    """
    marked = materialize(universe(keys, listed), "keys")
    levels: list[Level] = []
    wrong, kind = marked, True
    while True:
        wanted = wrong.where(F.col("listed") == kind)
        counts = {row.listed: row["count"] for row in wrong.groupBy("listed").count().collect()}
        if kind not in counts:
            return levels
        size = cells_of(counts[kind], counts.get(not kind, 0))
        total = size + sum(len(level.cells) for level in levels)
        if total > MAX_FILTER_BYTES:
            raise ValueError(f"levels of {total} bytes are above {MAX_FILTER_BYTES}; split the list by key")
        levels.append(encode(wanted, size, len(levels) + 1))
        others = wrong.where(F.col("listed") != kind)
        # The next level encodes the keys that this one wrongly holds, and is asked about those it rightly holds.
        wrong = materialize(others.where(levels[-1].holds(F.col("key"))).unionByName(wanted), "level")
        kind = not kind


def is_listed(key: Column, levels: list[Level]) -> Column:
    """Exact for every key of the universe the cascade was made for."""
    if not levels:
        return F.lit(False)
    answer = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        answer = F.when(~level.holds(key), F.lit(level.number % 2 == 0)).otherwise(answer)
    return answer


def judge(pages: DataFrame, rules: list[Rule], listed: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule and verdict of every row.

    The longest rule that fits decides. Elsewhere a URL is blocked if its host or a parent domain is in
    ``listed`` (key), allowed if not; null URLs and those without a host are allowed. Repeated rows each
    get a row. ``listed`` may hold names that no page has; they are not part of the universe and cost nothing.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    parts = pages.select(F.col(f"`{key}`").alias("id"), host.alias("host"), path.alias("path"))
    hosts = parts.select("host").distinct()
    levels = cascade(hosts.select(F.explode(keys_of(F.col("host"))).alias("key")), listed)
    blocked = F.exists(keys_of(F.col("host")), lambda k: is_listed(k, levels))
    ruled = rule_of(F.col("host"), F.col("path"), rules, "verdict")
    return parts.select(
        F.col("id").alias(key),
        "host",
        "path",
        rule_of(F.col("host"), F.col("path"), rules, "name").alias("rule"),
        F.coalesce(ruled, F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )


def names(spark: SparkSession, hosts: list[str]) -> DataFrame:
    return spark.createDataFrame([(host,) for host in hosts], "key string")
