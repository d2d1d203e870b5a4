"""Token ids packed into fixed-length rows by best fit decreasing.

Tokenising and packing happen where the rows are read: no text is shuffled. Pieces are collected in
windows of a bounded number of tokens, sorted by length and placed into the row with the least room
that still fits, which a segment tree over remaining capacities finds in log2(length) steps.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroute.llm.rows import as_batch

LENGTH = 2048
WINDOW_TOKENS = 4_000_000
CACHED_WORDS = 200_000
#: The published pattern that cuts text before the merges of these rank files (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

DDL = (
    "shard int, row long, doc_ids array<long>, doc_offsets array<long>, cu_seqlens array<int>, "
    "position_resets array<int>, n_tokens int, input_ids binary"
)
SCHEMA = pa.schema(
    [
        ("shard", pa.int32()),
        ("row", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_offsets", pa.list_(pa.int64())),
        ("cu_seqlens", pa.list_(pa.int32())),
        ("position_resets", pa.list_(pa.int32())),
        ("n_tokens", pa.int32()),
        ("input_ids", pa.binary()),
    ]
)


class CapacityTree:
    """Rows by remaining capacity; ``take(need)`` gives a row of the least capacity that is at least ``need``."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(self.width)]

    def add(self, row: int, capacity: int) -> None:
        self.rows[capacity].append(row)
        self._change(capacity, 1)

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.width
        while node:
            self.count[node] += by
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(row, its capacity), taken out of the tree; None if no row has the room."""
        node = need + self.width
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node *= 2
                if not self.count[node]:
                    node += 1
        capacity = node - self.width
        self._change(capacity, -1)
        return self.rows[capacity].pop(), capacity


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Places of the pieces in each row: longest piece first, each into the fullest row that has room."""
    tree, rows = CapacityTree(capacity), []
    for place in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[place])
        if found is None:
            rows.append([])
            found = len(rows) - 1, capacity
        row, room = found
        rows[row].append(place)
        tree.add(row, room - lengths[place])
    return rows


def rank_file_encoder(path: str) -> Callable[[str], list[int]]:
    """Encoder of a byte-level BPE rank file; what it gives is what the tokenizer gives for the whole text.

    The pattern never lets a piece cross a single blank between two other characters, so texts without
    double white space are encoded word by word, and frequent words once per task.
    """
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    doubled = re.compile(r"\s\s")
    known: dict[str, list[int]] = {}

    def of(text: str) -> list[int]:
        if doubled.search(text):
            return encode(text)
        ids: list[int] = []
        for i, word in enumerate(text.split(" ")):
            word = " " + word if i else word
            found = known.get(word)
            if found is None:
                found = encode(word)
                if len(known) < CACHED_WORDS and len(word) < 64:
                    known[word] = found
            ids += found
        return ids

    return of


def pack(
    docs: DataFrame,
    encoder: Callable[[], Callable[[str], list[int]]],
    end_id: int,
    length: int = LENGTH,
    key: str = "doc_id",
    text: str = "text",
    dtype: str = "<u2",
) -> DataFrame:
    """One row of ids per result row (DDL): shard and row name the place in the id matrix of a task.

    Every non-null text becomes its ids and ``end_id``; an empty text is ``end_id`` alone, a null text
    gives nothing. A text longer than a row is cut into whole rows and a rest, none of its ids is lost:
    piece i of a row holds ids ``doc_offsets[i]`` onwards of ``doc_ids[i]``, between ``cu_seqlens[i]`` and
    ``cu_seqlens[i + 1]``, and positions start at 0 at each of ``position_resets``. ``input_ids`` holds
    ``length`` little-endian ids, filled up with ``end_id`` after ``n_tokens``. Repeated rows are packed
    each for itself; a null key stays a null in ``doc_ids``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, row = encoder(), TaskContext.get().partitionId(), 0
        pieces: list[tuple[int | None, int, np.ndarray]] = []
        held = 0

        def as_row(members: list[tuple[int | None, int, np.ndarray]]) -> tuple:
            nonlocal row
            ids = np.full(length, end_id, dtype)
            starts = [0]
            for _, _, tokens in members:
                ids[starts[-1] : starts[-1] + len(tokens)] = tokens
                starts.append(starts[-1] + len(tokens))
            row += 1
            return shard, row - 1, [m[0] for m in members], [m[1] for m in members], starts, starts[:-1], starts[-1], ids.tobytes()

        def flush() -> Iterator[pa.RecordBatch]:
            made = [as_row([pieces[i] for i in places]) for places in best_fit([len(p[2]) for p in pieces], length)]
            for at in range(0, len(made), 2_000):
                yield as_batch(made[at : at + 2_000], SCHEMA)

        for batch in batches:
            whole: list[tuple] = []
            for doc, value in zip(*batch.columns, strict=True):
                doc, value = doc.as_py(), value.as_py()
                if value is None:
                    continue
                tokens = np.array([*encode(value), end_id], dtype)
                rest = len(tokens) - len(tokens) % length
                for at in range(0, rest, length):
                    whole.append(as_row([(doc, at, tokens[at : at + length])]))
                if rest < len(tokens):
                    pieces.append((doc, rest, tokens[rest:].copy()))
                    held += len(tokens) - rest
                if len(whole) >= 2_000:
                    yield as_batch(whole, SCHEMA)
                    whole = []
                if held >= WINDOW_TOKENS:
                    yield from flush()
                    pieces, held = [], 0
            if whole:
                yield as_batch(whole, SCHEMA)
        yield from flush()

    return docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`").cast("string")).mapInArrow(run, DDL)


def pieces_of(packed_rows: DataFrame, dtype: str = "<u2") -> DataFrame:
    """(doc_id, doc_offset, ids binary): every piece of every row, for reading a packing back."""
    width = np.dtype(dtype).itemsize
    numbered = packed_rows.select(
        "input_ids", "cu_seqlens", F.posexplode(F.arrays_zip("doc_ids", "doc_offsets")).alias("i", "piece")
    )
    start, end = F.get("cu_seqlens", F.col("i")), F.get("cu_seqlens", F.col("i") + 1)
    return numbered.select(
        F.col("piece.doc_ids").alias("doc_id"),
        F.col("piece.doc_offsets").alias("doc_offset"),
        F.substring("input_ids", start * width + 1, (end - start) * width).alias("ids"),
    )
