"""Spelling variants: words one edit apart, found by neighbourhoods over a reduced alphabet.

Every letter is hashed to one of a few symbols. Words one edit apart have reduced words at most one edit apart,
so the full one-edit neighbourhood of each distinct reduced word (the word itself, every deletion, replacement
and insertion of a symbol), joined with the reduced vocabulary, meets all of them; the edit distance of the words
themselves then decides. Neighbours are made as hashes from prefix and suffix sums, so that a word of any
length costs a fixed number of hashes a letter.

A reduced word that more than CROWD words share makes no neighbourhood: its words go on to the next, larger
alphabet, the last of which keeps every letter apart. Each word so meets its near words from one alphabet, with
at most CROWD words on its side of a match, and no pair of words of one reduced word is formed but by way of
a neighbourhood that at most CROWD words make.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroute.llm.rows import as_batch
from tallyroute.session import materialize, release, scratch_mark

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MIN_LENGTH = 5
MIN_COUNT = 3
DROP_EVERY = 97
#: Symbols of the alphabets in turn; the last has one for every letter.
ALPHABETS = (6, 24, len(LETTERS))
CROWD = 64
HELD_WORDS = 200_000
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd: sums of symbols times its powers, modulo 2^64
BLOCK = 4_096  # places of a word whose neighbours are made at once
HELD_NEIGHBOURS = 100_000
COUNT_SCHEMA = pa.schema([("word", pa.string()), ("n", pa.int64())])
CODED_SCHEMA = pa.schema([("word", pa.string()), ("n", pa.int64()), ("key", pa.int64()), ("twin", pa.int64())])
NEAR_SCHEMA = pa.schema([("key", pa.int64()), ("from_key", pa.int64()), ("from_twin", pa.int64())])


def lowered(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(LOWER)


def words_of(key, text: str) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one document, as counted: some runs lose a letter by the hash of document and run."""
    start = zlib.crc32(f"{'' if key is None else key}:".encode())
    for run, n in Counter(RUN.findall(text)).items():
        run = lowered(run)
        h = zlib.crc32(run.encode(), start)
        if h % DROP_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= MIN_LENGTH:
            yield run, n


def vocabulary(docs: DataFrame, key: str, text: str) -> DataFrame:
    """word, n: the words of at least MIN_LENGTH letters that occur MIN_COUNT times or more in all documents."""

    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            for key, text in zip(*batch.columns, strict=True):
                if text := text.as_py():
                    for word, n in words_of(key.as_py(), text):
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield as_batch(list(held.items()), COUNT_SCHEMA)
                    held.clear()
        if held:
            yield as_batch(list(held.items()), COUNT_SCHEMA)

    found = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def symbols(alphabet: int) -> np.ndarray:
    """Symbol of every code point that a word can hold."""
    table = np.zeros(0x100, np.int64)
    for place, letter in enumerate(LETTERS):
        table[ord(letter)] = place if alphabet >= len(LETTERS) else zlib.crc32(letter.encode()) % alphabet
    return table


def values(alphabet: int) -> np.ndarray:
    """A 64-bit value for every symbol."""
    return np.fromiter((xxhash.xxh3_64_intdigest(f"symbol {i}") for i in range(alphabet)), np.uint64, alphabet)


def reduced(word: str, table: np.ndarray) -> np.ndarray:
    return table[np.frombuffer(word.encode("latin-1"), np.uint8)]


def powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, BASE)]))


def sums(own: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Sum of value times power of the place over the places before each one."""
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * power[: len(own)])])


def neighbourhood(code: np.ndarray, value: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the reduced word and of its one-edit neighbours, each once, in blocks of places.

    The hash of a word is the sum of its symbols' values times BASE to their places. Of the edits that give the
    same word, the deletion of the last of equal letters and the insertion behind them are made.
    """
    n, power = len(code), powers(len(code) + 1)
    own, every = value[code], np.arange(len(value))
    before = sums(own, power)
    # The same for every letter but the first, one place lower than it stands.
    lower = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own[1:] * power[: n - 1])])
    following = np.append(code, -1)
    yield before[n:]
    for start in range(0, n + 1, BLOCK):
        at = np.arange(start, min(start + BLOCK, n + 1))
        inner = at[at < n]
        deleted = inner[following[inner] != following[inner + 1]]
        yield before[deleted] + lower[n - 1] - lower[deleted]
        other = (before[n] - own[inner] * power[inner])[:, None] + value * power[inner][:, None]
        yield other[code[inner][:, None] != every]
        longer = (before[at] + (before[n] - before[at]) * BASE)[:, None] + value * power[at][:, None]
        yield longer[following[at][:, None] != every]


def coded(words: DataFrame, alphabet: int) -> DataFrame:
    """word, n, key and twin: two hashes of the reduced word."""

    def code(batches):
        table, value = symbols(alphabet), values(alphabet)
        for batch in batches:
            rows = []
            for word, n in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                low = reduced(word, table)
                key = sums(value[low], powers(len(low)))[-1]
                rows.append((word, n, int(key.astype(np.int64)), int(np.uint64(xxhash.xxh3_64_intdigest(low.astype(np.uint8))).astype(np.int64))))
            if rows:
                yield as_batch(rows, CODED_SCHEMA)

    return words.select("word", "n").mapInArrow(code, "word string, n long, key long, twin long")


def neighbours(buckets: DataFrame, alphabet: int) -> DataFrame:
    """key (a neighbour's hash), from_key, from_twin: the neighbourhood of every reduced word; ``sample`` is a word of it."""

    def expand(batches):
        table, value = symbols(alphabet), values(alphabet)
        held, rows = [], 0
        for batch in batches:
            for sample, key, twin in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                for made in neighbourhood(reduced(sample, table), value):
                    held.append((made.astype(np.int64), np.full(len(made), key), np.full(len(made), twin)))
                    rows += len(made)
                    if rows >= HELD_NEIGHBOURS:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], schema=NEAR_SCHEMA)
                        held, rows = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], schema=NEAR_SCHEMA)

    return buckets.select("sample", "key", "twin").mapInArrow(expand, "key long, from_key long, from_twin long")


def meeting(buckets: DataFrame, known: DataFrame, alphabet: int) -> DataFrame:
    """from_key, from_twin, other, other_n: the words of ``known`` that the neighbourhoods of the reduced words meet.

    Neighbours are over a hundred a reduced word, but Spark sizes them like the reduced words they are made from: it would
    send them to the driver and to every executor where those are a small table. So the join is a sorted one.
    """
    others = known.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    return neighbours(buckets, alphabet).hint("merge").join(others, "key").drop("key")


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """word, n_near, best (n and word of its near word of largest n): the words of ``words`` that have a near word.

    ``words`` is a written table of distinct words and their counts n.
    """
    found, left = None, None
    for turn, alphabet in enumerate(ALPHABETS):
        known = materialize(coded(words, alphabet), "coded")
        own = known if left is None else known.join(left, "word", "left_semi")
        size = F.count(F.lit(1)).alias("size")
        buckets = known.groupBy("key", "twin").agg(size, F.min("word").alias("sample"))
        if left is not None:
            buckets = buckets.join(own.select("key", "twin").distinct(), ["key", "twin"], "left_semi")
        buckets = materialize(buckets, "buckets")
        last = turn == len(ALPHABETS) - 1
        making = buckets if last else buckets.where(F.col("size") <= crowd)
        met = materialize(meeting(making, known, alphabet), "met")
        sources = own.select(F.col("key").alias("from_key"), F.col("twin").alias("from_twin"), "word")
        near = met.join(sources, ["from_key", "from_twin"]).where(F.levenshtein("word", "other", 1) == 1)
        best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("word")))
        each = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
        found = each if found is None else found.unionByName(each)
        if last:
            break
        left = own.join(buckets.where(F.col("size") > crowd), ["key", "twin"], "left_semi").select("word")
        left = materialize(left, "crowded")
        if left.isEmpty():
            break
    return found.select("word", "n_near", F.col("best.word").alias("near"), (-F.col("best.less")).alias("near_n"))


def roots(links: DataFrame) -> DataFrame:
    """word, root: where the forms of each word of ``links`` (written: word, form) end.

    Every step halves the ways left, by following each word's link to its own link's end.
    """
    at = links.select("word", F.col("form").alias("root"))
    while True:
        mark = scratch_mark()
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not moved.where("moved").limit(1).count():
            release(links.sparkSession, mark)
            return at
        at = moved.drop("moved")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """word, form, root, n, n_near, form_n: every word of all documents, and the commoner spelling it stands for.

    A word's form is its near word (one letter inserted, deleted or replaced) of largest n, of equal ones the first in
    code-point order, if that n is at least twice its own; its root is where the forms end.

    Null and empty texts have no word, an empty table gives no row. A null key counts as empty text in the hash. Rows
    equal in key and text count each for itself. Words of any length are compared whole.
    """
    words = materialize(vocabulary(docs, key, text), "words")
    near = near_words(words, crowd)
    far = F.col("near_n") >= 2 * F.col("n")
    known = materialize(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(far, F.col("near")).alias("form"), F.when(far, F.col("near_n")).alias("form_n")
        ),
        "forms",
    )
    links = materialize(known.where("form is not null").select("word", "form"), "links")
    return known.join(roots(links), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
