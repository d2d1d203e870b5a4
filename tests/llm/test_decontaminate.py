import random
from collections import Counter

import numpy as np
import pytest

from tallyroute.llm import decontaminate as d


def brute(text, items):
    """All windows of each item's number of words, compared as multisets of five-word runs."""
    words, found = d.words_of(text), {}
    for item, own in items:
        target = d.words_of(own)
        if len(target) < 5 or len(words) < 5:
            continue
        size = min(len(target), len(words))
        goal = Counter(tuple(target[i : i + 5]) for i in range(len(target) - 4))
        for start in range(len(words) - size + 1):
            window = words[start : start + size]
            own_runs = Counter(tuple(window[i : i + 5]) for i in range(size - 4))
            union = sum((goal | own_runs).values())
            value = sum((goal & own_runs).values()) / union
            if value >= 0.8 and value > found.get(item, (0, 0))[1]:
                found[item] = (start, value)
    return found


def corpus():
    draw = random.Random(5)
    words = [f"w{i}".encode() for i in range(60)]
    items = [(n, b" ".join(draw.choices(words, k=draw.randint(3, 60)))) for n in range(40)]
    texts = []
    for n in range(120):
        filler = draw.choices(words, k=draw.randint(0, 80))
        passage = draw.choice(items)[1].split()
        for _ in range(draw.choice([0, 0, 1, 1, 2])):
            passage[draw.randrange(len(passage))] = draw.choice(words)
        at = draw.randint(0, len(filler))
        texts.append(b" ".join(filler[:at] + passage + filler[at:]) if n % 3 else b" ".join(filler))
    texts += [items[8][1].upper(), b"(" + items[9][1].replace(b" ", b",\n ") + b")!", b" ".join(items[10][1].split()[:-2]), items[11][1] * 2]
    return items, texts


def test_same_as_all_windows():
    items, texts = corpus()
    ready = d.prepare(items)
    held = 0
    for text in texts:
        found = {m[0]: (m[1], pytest.approx(m[4])) for m in d.search(text, ready)}
        assert found == brute(text, items)
        held += bool(found)
    assert held > 40


def test_index_misses_nothing_within_the_radius():
    draw = np.random.default_rng(3)
    for _ in range(500):
        value, flips = int(draw.integers(0, 2**63)), draw.choice(64, d.RADIUS, replace=False)
        other = value ^ sum(1 << int(b) for b in flips)
        assert any((other >> 8 * k & 255) in d.NEAR[value >> 8 * k & 255] for k in range(8))


def test_blocks_give_the_same_rows(spark, texts, monkeypatch):
    items, found = corpus()
    docs = texts([(i, t.decode()) for i, t in enumerate(found)])
    bench = spark.createDataFrame([(i, t.decode(), "x") for i, t in items] + [(99, None, "x"), (98, "", "x")], "item_id long, text string, key string")
    whole = sorted(map(tuple, d.leaks(docs, bench).collect()))
    monkeypatch.setattr(d, "BLOCK_BYTES", 1_000)
    assert sorted(map(tuple, d.leaks(docs, bench).collect())) == whole
    expected = {(i, item) for i, t in enumerate(found) for item in brute(t, items)}
    assert {(r[0], r[1]) for r in whole} == expected
    clean = d.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == set(range(len(found))) - {i for i, _ in expected}


def test_odd_rows(spark, nasty):
    bench = spark.createDataFrame([(1, "one two three four five six seven"), (2, "one")], "item_id long, text string")
    assert d.leaks(nasty, bench).collect() == []
    assert d.without_leaks(nasty, bench).count() == 9
    assert d.leaks(nasty, bench.limit(0)).collect() == [] and d.leaks(nasty.limit(0), bench).collect() == []
    item = bench.selectExpr("100 + item_id as item_id", "'word word word word word word word' as text").limit(1)
    assert [(r.doc_id, r.similarity) for r in d.leaks(nasty, item).collect()] == [(6, 1.0)]
