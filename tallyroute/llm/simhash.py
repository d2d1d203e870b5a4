"""SimHash near-duplicates through vantage-point trees.

Distinct fingerprints only are compared. A tree of vantage points, fitted on a bounded sample, deals
them into shards: at each node a fingerprint goes inside the median ball or outside it, and one that
lies inside within ``max_distance`` of the border is also copied outside. Two fingerprints that are
at most ``max_distance`` apart differ by no more than that in their distance to any vantage point, so
by the triangle inequality they meet in at least one shard; no pair is lost, whatever the sample. A
shard is searched by the same rule in memory and hands on a spanning forest of its links, never all
pairs. Components of the forests are the components of all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroute.llm.rows import key_type, map_rows, packed, unpacked, utf8
from tallyroute.session import materialize

HASH_SEED = 42
SAMPLE = 20_000  # fingerprints the tree is fitted on; every fingerprint is dealt out and searched
SHARD = 2_000  # fingerprints aimed at in a shard
LEAF = 512  # fingerprints compared each with each inside a shard
BATCH_HASHES = 1 << 16


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """XXH64 of every run of ``width`` words, repeats included; fewer words make one run, none makes none."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    width = min(width, len(words))
    runs = map(b" ".join, zip(*(islice(words, i, None) for i in range(width)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(HASH_SEED)), np.uint64, len(words) - width + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit by bit, 1 where over half of the hashes have 1; 0 for none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BATCH_HASHES):
        part = hashes[at : at + BATCH_HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def distances(fingerprints: np.ndarray, point: int) -> np.ndarray:
    return np.bitwise_count(fingerprints ^ np.uint64(point)).astype(np.int16)


def best_vantage(points: np.ndarray, reach: int, tries: int = 8) -> tuple[int, int, float]:
    """(vantage point, radius, rows after the split per row before): the candidate that copies least."""
    best = (0, 0, 2.0)
    for at in np.linspace(0, len(points) - 1, tries).astype(int):
        away = distances(points, points[at])
        radius = int(np.median(away))
        inside = int((away <= radius).sum())
        border = int(((away <= radius) & (away > radius - reach)).sum())
        if 0 < inside < len(points) and max(inside, len(points) - inside + border) <= 0.8 * len(points):
            best = min(best, (int(points[at]), radius, 1 + border / len(points)), key=lambda x: x[2])
    return best


def split(points: np.ndarray, index: np.ndarray, vantage: int, radius: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """The inside and the outside of a ball; what lies inside near the border is in both."""
    away = distances(points[index], vantage)
    return index[away <= radius], index[away > radius - reach]


def fit_tree(sample: np.ndarray, leaves: int, reach: int) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage point, radius, inside node, outside node); a negative child -k-1 is shard k."""
    nodes: list[tuple[int, int, int, int]] = []
    shards = 0

    def grow(points: np.ndarray, wanted: int) -> int:
        nonlocal shards
        vantage, radius, cost = best_vantage(points, reach) if wanted > 1 and len(points) >= 16 else (0, 0, 2.0)
        if cost >= 1.9:
            shards += 1
            return -shards
        at = len(nodes)
        nodes.append((0, 0, 0, 0))
        away = distances(points, vantage)
        inside = grow(points[away <= radius], wanted // 2)
        nodes[at] = (vantage, radius, inside, grow(points[away > radius], wanted // 2))
        return at

    grow(sample, leaves)
    return nodes


def route(points: np.ndarray, nodes: list[tuple[int, int, int, int]], reach: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places of the points that belong to it or lie near its border)."""
    stack = [(0 if nodes else -1, np.arange(len(points)))]
    while stack:
        node, index = stack.pop()
        if not len(index):
            continue
        if node < 0:
            yield -node - 1, index
            continue
        vantage, radius, inside, outside = nodes[node]
        near, far = split(points, index, vantage, radius, reach)
        stack += [(inside, near), (outside, far)]


def close_pairs(points: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs at most ``reach`` bits apart, in batches; a pair may come more than once.

    ``points`` are distinct and sorted. Where no vantage point divides a crowd well (nearly all of it
    lies within a few bits), every point of its ball is looked up instead, which stays linear.
    """
    stack = [np.arange(len(points))]
    while stack:
        index = stack.pop()
        if len(index) <= LEAF:
            some = points[index]
            a, b = np.nonzero(np.triu(np.bitwise_count(some[:, None] ^ some[None, :]) <= reach, 1))
            yield index[a], index[b]
            continue
        vantage, radius, cost = best_vantage(points[index], reach)
        if cost < 1.6:
            stack += split(points, index, vantage, radius, reach)
            continue
        some = points[index]
        for size in range(1, reach + 1):
            for bits in combinations(range(64), size):
                sought = some ^ np.uint64(sum(1 << b for b in bits))
                at = np.minimum(np.searchsorted(some, sought), len(some) - 1)
                hit = some[at] == sought
                yield index[hit], index[at[hit]]


def forest(points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member of its component) for every point that has a link and isn't the smallest."""
    points = np.unique(points)
    parent = list(range(len(points)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for left, right in close_pairs(points, reach):
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            a, b = top(a), top(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    roots = np.array([top(x) for x in range(len(points))], dtype=np.int64)
    linked = np.nonzero(roots != np.arange(len(points)))[0]
    return points[linked], points[roots[linked]] if len(linked) else points[:0]


def links(classes: DataFrame, max_distance: int) -> DataFrame:
    """(a, b) long: links whose components are those of all pairs of ``classes.fp`` within ``max_distance``."""
    total = classes.count()
    sample = classes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    points = np.array([row.fp for row in sample], dtype=np.int64).view(np.uint64)
    nodes = fit_tree(points, max(1, 1 << int(np.ceil(np.log2(max(1, total / SHARD))))), max_distance)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.asarray(batch.column(0)).view(np.uint64)
            for shard, index in route(own, nodes, max_distance):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(index), shard, np.int32)), pa.array(own[index].view(np.int64))], names=["shard", "fp"]
                )

    def search(table: pa.Table) -> pa.Table:
        a, b = forest(np.asarray(table.column("fp").combine_chunks()).view(np.uint64), max_distance)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = classes.select("fp").mapInArrow(deal, "shard int, fp long")
    return dealt.groupBy("shard").applyInArrow(search, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): stars by alternating large and small star steps, one written table a round.

    Each step points the neighbours of a node to the smallest of them; the minimum is an aggregate
    that combines before the shuffle, so a node with very many neighbours is no single group.
    """

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not larger:
            both = both.where("b < a")
        # Written, so that its join with the edges of a node that very many link to can be split.
        least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("m")), "least")
        moved = both.join(least, "a")
        moved = moved.where("b > a") if larger else moved.select("b", "m").union(least.select(F.col("a").alias("b"), "m"))
        return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()

    def state(pairs: DataFrame):
        return pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    current = materialize(edges.where("a != b").distinct(), "links")
    before = state(current)
    while before[0]:
        current = materialize(star(star(current, True), False), "stars")
        after = state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def fingerprints(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    kind, arrow_kind = key_type(docs, key)
    arrow = pa.schema([("key", arrow_kind), ("fp", pa.int64())])
    source = docs.select(F.col(f"`{key}`").alias("key"), utf8(text).alias("text"))
    return map_rows(source, arrow, f"key {kind}, fp long", lambda key, text: [(key, fingerprint(shingle_hashes(text, width)))])


def grouped(marked: DataFrame, max_distance: int) -> DataFrame:
    """(fp, root, first_key) for every distinct fingerprint of (key, fp); root names the component."""
    classes = materialize(marked.groupBy("fp").agg(F.min("key").alias("first_key")), "classes")
    stars = components(links(classes, max_distance))
    rooted = materialize(classes.join(stars, classes.fp == stars.node, "left").select("fp", "first_key", F.coalesce("root", "fp").alias("root")), "rooted")
    # Written, so that the join of a component with very many fingerprints can be split.
    first = materialize(rooted.groupBy("root").agg(F.min("first_key").alias("first_key")), "firsts")
    return materialize(rooted.select("fp", "root").join(first, "root"), "groups")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, max_distance: int = 2) -> DataFrame:
    """key, fingerprint (16 hex digits) and component_id (smallest key of the component) for every row.

    Null and empty texts, and texts without words, have fingerprint zero and link like any other.
    Repeated rows each get a row. A null key is never the smallest unless all of a component are null.
    """
    marked = materialize(fingerprints(docs, key, text, width), "fingerprints")
    groups = grouped(marked, max_distance)
    return marked.join(groups, "fp").select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first_key").alias("component_id"),
    )


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, max_distance: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay: in each component the one with the smallest key.

    Of several rows with that key, or of rows without any key, the one whose text sorts first by
    SHA-256 stays, and of equal rows one. Rows are told apart by (key, fingerprint, SHA-256 of the text).
    """
    source = docs.select(packed(docs), F.col(f"`{key}`").alias("key"), utf8(text).alias("text"), F.sha2(utf8(text), 256).alias("sha"))
    kind, arrow_kind = key_type(docs, key)
    arrow = pa.schema([("key", arrow_kind), ("sha", pa.string()), ("fp", pa.int64())])
    marked = materialize(
        map_rows(
            source.select("key", "text", "sha"),
            arrow,
            f"key {kind}, sha string, fp long",
            lambda key, text, sha: [(key, sha, fingerprint(shingle_hashes(text, width)))],
        ),
        "fingerprints",
    )
    groups = grouped(marked.select("key", "fp"), max_distance)
    named = marked.join(groups, "fp")
    kept = (
        named.groupBy("root")
        .agg(F.min(F.struct(F.col("key").isNull().alias("last"), "key", "sha")).alias("first"))
        .select(F.col("first.key").alias("kept_key"), F.col("first.sha").alias("kept_sha"))
    )
    chosen = source.drop("text").join(
        kept, F.col("key").eqNullSafe(F.col("kept_key")) & F.col("sha").eqNullSafe(F.col("kept_sha")), "left_semi"
    )
    return unpacked(chosen.dropDuplicates(["key", "sha"]), docs.columns)
