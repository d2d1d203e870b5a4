import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tallyroute.llm import conversations as c

KIND = "conv_id long, turn long, role string, text string, depth int, path string, r1 string, n long"


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "p", "q", 1) for r in rows], KIND)


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:30]
            own[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {conv: [t for _, t in sorted(found)] for conv, found in own.items()}
    made = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        made[conv] = own.get(conv - conv % 5 if conv >= 0 else conv + -conv % 5, [])[:h] + turns[h:]
    return made


def by_definition(rows):
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in sorted(rebuilt(rows).items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    found = []
    total = {}
    for node in sorted(members, key=len, reverse=True):
        leaves = 1 if not children[node] else sum(total[k][0] for k in children[node])
        saved = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0) + sum(total[k][1] for k in children[node])
        total[node] = (leaves, saved)
        parent = members[node[:-1]][0] if node else None
        sha = hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
        found.append((members[node][0], len(node), parent, len(members[node]), len(children[node]), leaves, saved, sha))
    return sorted(found, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(n=60, depth=9, seed=1):
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(2 * n), n):
        for turn in range(draw.randint(1, depth)):
            rows.append((conv, turn, draw.choice(["user", "assistant"]), draw.choice(["", "a", "bé", "ccc " * 5])))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("band", [2, 3, 32])
def test_same_as_definition(spark, band):
    rows = corpus()
    assert result(c.trie(table(spark, rows), band=band)) == by_definition(rows)


def test_long_conversations_over_many_parts(spark):
    """One conversation with most of the turns is scanned by several tasks; the bands nest three deep."""
    draw = random.Random(4)
    rows = corpus(30, 6, 2) + [(7, i, "user", draw.choice("ab")) for i in range(700)] + [(5, i, "user", draw.choice("ab")) for i in range(60)]
    many = table(spark, rows).repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert result(c.trie(many, band=4)) == by_definition(rows)
        turns = c.turns_of(many, "conv_id", "turn", "role", "text")
        ends = [r.i for r in c.placed(turns).where("conv_id = 7").collect()]
        assert sorted(ends) == list(range(700))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "nobody's"), (1, None, None, None), (1, None, "user", "x"), (1, 3, "user", ""), (1, 3, "user", ""), (2, 5, "user", "tie"), (2, 5, "user", "other"),
        (3, 0, "user", "long " * 50_000), (0, 0, None, "é漢"), (0, 1, "", "é漢"), (-7, 0, "user", "minus"), (9, 0, "user", "alone"), (9, 0, "user", "alone"),
    ]
    assert result(c.trie(table(spark, rows))) == by_definition(rows)
    assert result(c.trie(table(spark, rows).limit(0))) == []
    assert result(c.trie(table(spark, rows[:1]))) == []


def test_turnless_conversations_are_members_of_the_root(spark):
    """A conversation whose own turns all fall to its shared beginning, which is absent, has no turn."""
    conv = next(k for k in range(1, 500, 5) if zlib.crc32(str(k).encode()) % 9 >= 2)
    rows = [(conv, 0, "user", "gone")]
    (only,) = c.trie(table(spark, rows)).collect()
    assert (only.conv_id, only.depth, only.n_convs, only.n_leaves) == (conv, 0, 1, 1)
    assert only.ends_sha256 == hashlib.sha256(str(conv).encode()).hexdigest()


def test_long_lists_of_ends(spark, monkeypatch):
    rows = [(5 * k, 0, "user", "same") for k in range(3_000)]
    monkeypatch.setattr(c, "CHUNK", 64)
    assert result(c.trie(table(spark, rows))) == by_definition(rows)
