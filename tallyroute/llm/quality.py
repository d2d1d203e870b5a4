"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed
rule; policies are masks over those bits, so a new policy version or an ablation never reads a text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.llm.rows import key_type, map_rows, utf8

SYMBOLS = b"#*$%&|<>"
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
#: Bytes that start no visible character: the blanks and the continuation bytes of UTF-8.
UNCOUNTED = BLANKS + bytes(range(0x80, 0xC0))
WINDOW = 5
#: Odd multipliers that combine the hashes of a window's words.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes]) -> int:
    """Words inside a five-word window that occurs at least twice, its first occurrence included."""
    n = len(words)
    if n <= WINDOW:
        return 0
    hashed = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    last = n - WINDOW + 1
    windows = sum(hashed[i : i + last] * MIX[i] for i in range(WINDOW))
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    starts = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    if not len(starts):
        return 0
    return int(np.minimum(np.diff(starts, append=n), WINDOW).sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    """The values of MEASURES for one whole text; null counts as no text."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.split()
    lines = [line for line in text.split(b"\n") if not line.isspace() and line]
    return (
        len(words),
        len(text.translate(None, UNCOUNTED)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL over MEASURES, whole numbers only


#: The bit of a rule is its place in this list. Append only: stored ledgers and policies refer to places.
RULES = [
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("many_symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("few_words_strict", "n_words < 50"),
    Rule("some_symbols", "10 * n_symbols > n_words"),
]


def bit(name: str) -> int:
    return 1 << next(place for place, rule in enumerate(RULES) if rule.name == name)


@dataclass(frozen=True)
class Policy:
    """A document passes if it fails at most ``tolerated`` of the policy's rules."""

    version: str
    rules: tuple[str, ...]
    tolerated: int = 0

    @property
    def mask(self) -> int:
        return sum(map(bit, self.rules))


BASE = Policy("base", ("few_words", "repeated_words"))
PRODUCTION = Policy("v1", ("few_words", "repeated_words", "many_symbols", "repeated_lines", "short_words", "long_words"))
STRICT = Policy("v2", PRODUCTION.rules + ("few_words_strict", "some_symbols"))


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, MEASURES and failed_bits for every row: null and empty texts measure zero, repeated rows each get a row."""
    kind, arrow_kind = key_type(docs, key)
    source = docs.select(F.col(f"`{key}`").alias("key"), utf8(text).alias("text"))
    arrow = pa.schema([("key", arrow_kind)] + [(name, pa.int64()) for name in MEASURES])
    measured = map_rows(
        source, arrow, f"key {kind}, " + ", ".join(f"{name} long" for name in MEASURES), lambda key, text: [(key, *measure(text))]
    )
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(bit(rule.name)).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.select(F.col("key").alias(key), *MEASURES, bits.alias("failed_bits"))


def _broken(bits: Column, mask: int) -> Column:
    return F.bit_count(bits.bitwiseAND(F.lit(mask).cast("long")))


def passes(policy: Policy, bits: Column | None = None) -> Column:
    return _broken(F.col("failed_bits") if bits is None else bits, policy.mask) <= policy.tolerated


def ablation(book: DataFrame, policies: list[Policy]) -> DataFrame:
    """version, rule, kept, kept_without, recovered: what each rule alone costs a policy.

    The ledger is reduced to one count per bit pattern first (at most 2^rules rows, whatever the
    number of documents); masks do the rest.
    """
    patterns = book.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    cases = [
        F.struct(
            F.lit(policy.version).alias("version"),
            F.lit(name).alias("rule"),
            passes(policy).alias("kept"),
            (_broken(F.col("failed_bits"), policy.mask & ~bit(name)) <= policy.tolerated).alias("without"),
        )
        for policy in policies
        for name in policy.rules
    ]
    return (
        patterns.select("n", F.explode(F.array(*cases)).alias("case"))
        .groupBy("case.version", "case.rule")
        .agg(
            F.sum(F.when(F.col("case.kept"), F.col("n")).otherwise(0)).alias("kept"),
            F.sum(F.when(F.col("case.without"), F.col("n")).otherwise(0)).alias("kept_without"),
        )
        .withColumn("recovered", F.col("kept_without") - F.col("kept"))
    )
