"""Benchmark decontamination by SimHash windows.

Every benchmark item is compared with windows of its own number of words. A window can only reach the
similarity if enough of its five-word shingles occur in items of that length, so other windows need no
fingerprint. The rest get a SimHash; a multi-index over its bytes finds every item of that length within
the radius, and the exact weighted Jaccard similarity of the shingles decides. Documents are read where
they are, one benchmark block of bounded size at a time, and never shuffled. What a block finds is
written before the next one is read, so the driver, the plan and a task hold one block.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.llm.rows import map_rows, utf8
from tallyroute.session import discard, materialize, materialize_at, scratch_path

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 23  # bits; with eight bytes, one of them differs in at most RADIUS // 8 = 2
BLOCK_BYTES = 4_000_000  # benchmark text that is sent to the executors at once
FILTER_BITS = 22
#: ASCII letters are lower-cased, other ASCII signs than letters and digits part words, all else belongs to words.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A or 0x30 <= b <= 0x39 else 0x20 for b in range(256)
)
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)
#: Byte values at most two bits from each byte value.
NEAR = [[v for v in range(256) if (v ^ b).bit_count() <= RADIUS // 8] for b in range(256)]


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def shingles_of(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of every run of WIDTH words."""
    n = len(words) - WIDTH + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    mixed = sum(hashed[i : i + n] * MIX[i] for i in range(WIDTH))
    mixed ^= mixed >> np.uint64(32)
    mixed *= MIX[0]
    return mixed ^ (mixed >> np.uint64(29))


def simhashes(hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """SimHash of ``length`` shingles from each start, from running sums of their bits."""
    low, high = int(starts.min()), int(starts.max()) + length
    bits = np.unpackbits(hashes[low:high].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((high - low + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    counts = sums[starts - low + length] - sums[starts - low]
    return np.packbits(2 * counts > length, axis=1, bitorder="little").view("<u8").ravel()


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity: the shingles' numbers are their weights."""
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def shingle_counts(words: list[bytes]) -> Counter:
    return Counter(zip(*(words[i:] for i in range(WIDTH)), strict=False))


@dataclass
class Items:
    """One block of the benchmark, ready to be searched."""

    items: list[tuple[int, list[bytes], Counter]]  # item id, words, shingles
    lengths: np.ndarray
    known: np.ndarray  # sorted shingle hashes
    owners: list[list[int]]  # item lengths that each of them occurs in
    maybe: np.ndarray  # filter over the top bits of the hashes
    prints: np.ndarray
    index: list[dict[int, list[int]]]  # per byte: value -> items whose byte is near it


def prepare(block: list[tuple[int, bytes]]) -> Items:
    """Items of fewer than WIDTH words have no shingle and can't be told from ordinary speech: they match nothing."""
    items = [(item, words, shingle_counts(words)) for item, words in ((i, words_of(t)) for i, t in block) if len(words) >= WIDTH]
    owners: dict[int, set[int]] = defaultdict(set)
    prints = []
    for _, words, _ in items:
        hashes = shingles_of(words)
        for h in hashes.tolist():
            owners[h].add(len(words))
        prints.append(simhashes(hashes, np.zeros(1, np.int64), len(hashes))[0])
    known = np.array(sorted(owners), np.uint64)
    maybe = np.zeros(1 << FILTER_BITS, bool)
    maybe[(known >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    index: list[dict[int, list[int]]] = [defaultdict(list) for _ in range(8)]
    for place, value in enumerate(prints):
        for part in range(8):
            for near in NEAR[int(value) >> (8 * part) & 255]:
                index[part][near].append(place)
    lengths = np.array([len(words) for _, words, _ in items])
    return Items(items, lengths, known, [sorted(owners[h]) for h in known.tolist()], maybe, np.array(prints, np.uint64), index)


def possible_starts(hits: np.ndarray, total: int, length: int, least: int) -> np.ndarray:
    """Starts of runs of ``length`` out of ``total`` shingles that hold at least ``least`` of the places in ``hits``."""
    if least > len(hits):
        return np.zeros(0, np.int64)
    first = hits[: len(hits) - least + 1]
    crowded = hits[least - 1 :] - first < length
    starts = (first[crowded][:, None] - np.arange(length - least + 1)[None, :]).ravel()
    starts = np.unique(starts[(starts >= 0) & (starts <= total - length)])
    inside = np.searchsorted(hits, starts + length) - np.searchsorted(hits, starts)
    return starts[inside >= least]


def search(text: bytes | None, items: Items) -> list[tuple[int, int, int, int, float]]:
    """(item, first word, words, differing bits, similarity): for each item found, its best window, the first of equals.

    A document shorter than the item is one window.
    """
    words = words_of(text)
    if len(words) < WIDTH or not len(items.known):
        return []
    hashes = shingles_of(words)
    hits = np.nonzero(items.maybe[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])[0]
    if not len(hits):
        return []
    at = np.minimum(np.searchsorted(items.known, hashes[hits]), len(items.known) - 1)
    exact = items.known[at] == hashes[hits]
    hits, at = hits[exact], at[exact]
    by_length: dict[int, list[int]] = defaultdict(list)
    for place, shingle in zip(hits.tolist(), at.tolist(), strict=True):
        for length in items.owners[shingle]:
            by_length[length].append(place)
    best: dict[int, tuple] = {}
    for length, places in by_length.items():
        full = length - WIDTH + 1
        own = min(full, len(hashes))
        least = math.ceil(SIMILARITY / (1 + SIMILARITY) * (full + own) - 1e-9)
        starts = possible_starts(np.array(places), len(hashes), own, least)
        if not len(starts):
            continue
        for start, value in zip(starts.tolist(), simhashes(hashes, starts, own), strict=True):
            near = {i for part in range(8) for i in items.index[part].get(int(value) >> (8 * part) & 255, ())}
            counts = None
            for i in sorted(near):
                bits = int(np.bitwise_count(items.prints[i] ^ value))
                if items.lengths[i] != length or bits > RADIUS:
                    continue
                counts = counts or shingle_counts(words[start : start + own + WIDTH - 1])
                found = similarity(counts, items.items[i][2])
                if found >= SIMILARITY and (i not in best or found > best[i][4]):
                    best[i] = (items.items[i][0], start, own + WIDTH - 1, bits, found)
    return [best[i] for i in sorted(best)]


def blocks_of(benchmark: DataFrame, key: str, text: str) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark in blocks of about BLOCK_BYTES, each read when it is asked for; null texts hold nothing to find."""
    items = benchmark.select(F.col(f"`{key}`").cast("long").alias("item"), utf8(text).alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = -(-total // BLOCK_BYTES)
    share = F.pmod(F.xxhash64("item", "text"), F.lit(max(1, number)))
    for i in range(number):
        yield [(r.item, bytes(r.text)) for r in items.where(share == i).collect()]


SCHEMA = pa.schema(
    [
        ("key", pa.int64()),
        ("item_id", pa.int64()),
        ("first_word", pa.int32()),
        ("n_words", pa.int32()),
        ("distance", pa.int32()),
        ("similarity", pa.float64()),
    ]
)
DDL = "key long, item_id long, first_word int, n_words int, distance int, similarity double"


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """key, item_id, first_word, n_words, distance, similarity: one row per document and item it holds.

    Documents that hold no item have no row; null and empty texts hold none. Repeated documents or
    items each count for themselves.
    """
    source = docs.select(F.col(f"`{key}`").cast("long"), utf8(text))
    found = docs.sparkSession.createDataFrame([], DDL)
    for block in blocks_of(benchmark, item, item_text):

        def each(doc, text, block=block, ready=[]):  # noqa: B006  (made once a task)
            if not ready:
                ready.append(prepare(block))
            return [(doc, *match) for match in search(text, ready[0])]

        found = found.unionByName(materialize(map_rows(source, SCHEMA, DDL, each), "leaks"))
    return found.withColumnRenamed("key", key)


def _clean(block: list[tuple[int, bytes]]) -> Callable[[Column], Column]:
    """Whether a text holds no item of the block; only texts go to Python, and only verdicts come back."""

    @F.arrow_udf("boolean")
    def clean(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ready = prepare(block)
        for column in columns:
            yield pa.array([not search(value.as_py(), ready) for value in column], pa.bool_())

    return clean


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item. Between two blocks the rows left are written."""
    spark, left, written = docs.sparkSession, docs, None
    for block in blocks_of(benchmark, item, item_text):
        if left is not docs:
            before, written = written, scratch_path(spark, "left")
            left = materialize_at(left, written)
            if before:
                discard(spark, before)

        left = left.where(_clean(block)(utf8(text)))
    return left
