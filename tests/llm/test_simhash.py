import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyroute.llm import simhash as s


def plain_fingerprint(text, width=3):
    words = text.encode().lower().split() if text else []
    runs = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(points, reach):
    """Smallest member of each point's component, by comparing all pairs."""
    root = list(range(len(points)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(points):
            for j, b in enumerate(points):
                if (a ^ b).bit_count() <= reach and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


def crowd(draw, size, centres=20, flips=3):
    """Random fingerprints and others near them, some in chains."""
    base = [draw.getrandbits(64) for _ in range(centres)]
    points = set(base)
    while len(points) < size:
        near = draw.choice(list(points)) if draw.random() < 0.3 else draw.choice(base)
        for _ in range(draw.randint(0, flips)):
            near ^= 1 << draw.randrange(64)
        points.add(near if draw.random() < 0.7 else draw.getrandbits(64))
    return sorted(points)


@pytest.mark.parametrize("leaf, size", [(4, 300), (16, 700), (512, 300)])
def test_forest_has_the_components_of_all_pairs(monkeypatch, leaf, size):
    monkeypatch.setattr(s, "LEAF", leaf)
    points = crowd(random.Random(leaf), size)
    members, roots = s.forest(np.array(points, np.uint64), 2)
    found = dict(zip(members.tolist(), roots.tolist(), strict=True))
    assert [found.get(p, p) for p in points] == [points[i] for i in plain_components(points, 2)]
    assert len(members) < len(points)


def test_dense_ball_without_a_good_split(monkeypatch):
    """A centre with all its neighbours: no vantage point divides it."""
    monkeypatch.setattr(s, "LEAF", 32)
    centre = 0x123456789ABCDEF0
    points = [centre] + [centre ^ (1 << a) for a in range(64)] + [centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)]
    members, roots = s.forest(np.array(points, np.uint64), 2)
    assert len(members) == len(points) - 1 and set(roots.tolist()) == {min(points)}


def test_close_points_meet_in_a_shard():
    draw = random.Random(9)
    points = np.array(crowd(draw, 4_000, centres=300), np.uint64)
    nodes = s.fit_tree(points[::3], 64, 2)
    shards: dict[int, list[int]] = {}
    for shard, index in s.route(points, nodes, 2):
        shards.setdefault(shard, []).extend(index.tolist())
    assert len(shards) > 32 and len(set().union(*shards.values())) == len(points)
    held = [set() for _ in points]
    for shard, index in shards.items():
        for i in index:
            held[i].add(shard)
    for i, p in enumerate(points):
        for j in np.nonzero(s.distances(points, p) <= 2)[0]:
            assert held[i] & held[j]
    assert sum(map(len, held)) < 4 * len(points)


def documents():
    draw = random.Random(11)
    base = [" ".join(draw.choices([f"w{i}" for i in range(300)], k=draw.randint(1, 400))) for _ in range(60)]
    texts = list(base)
    for _ in range(140):
        words = draw.choice(texts).split()
        for _ in range(draw.choice([0, 0, 1, 2])):
            words[draw.randrange(len(words))] = f"x{draw.randrange(999)}"
        texts.append(" ".join(words))
    return [(500 - i, t) for i, t in enumerate(texts)] + [(1, None), (2, ""), (3, " \n"), (4, "one"), (4, "ONE"), (6, "two words"), (None, base[0])]


@pytest.mark.parametrize("small", [False, True])
def test_same_as_all_pairs(texts, monkeypatch, small):
    if small:
        monkeypatch.setattr(s, "SHARD", 8)
        monkeypatch.setattr(s, "LEAF", 4)
    rows = documents()
    points = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(points, 2)
    least = {}
    for (key, _), root in zip(rows, roots, strict=True):
        least[root] = min((k for k in (least.get(root), key) if k is not None), default=None)
    expected = sorted((key, f"{p:016x}", least[root]) for (key, _), p, root in zip(rows, points, roots, strict=True) if key is not None)
    found = s.near_duplicates(texts(rows)).collect()
    assert sorted(tuple(r) for r in found if r.doc_id is not None) == expected
    assert [r.component_id for r in found if r.doc_id is None] == [least[roots[-1]]]
    kept = s.keep_first(texts(rows))
    assert "size" in kept.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def test_odd_rows(nasty):
    found = s.near_duplicates(nasty)
    assert found.count() == 9
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found.where("doc_id < 4").collect()} == {(i, "0" * 16, 1) for i in (1, 2, 3)}
    assert s.keep_first(nasty).count() == 5  # no text, "one", no key, 5 and 6
    assert s.near_duplicates(nasty.limit(0)).count() == 0 and s.keep_first(nasty.limit(0)).count() == 0


def test_long_chain_of_links(spark):
    """Stars need few rounds, whatever the distance from end to end."""
    edges = spark.range(0, 700).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(900, 800), (5, 5)], "a long, b long"))
    found = {r.node: r.root for r in s.components(edges).collect()}
    assert found == {i: 0 for i in range(1, 701)} | {900: 800}
