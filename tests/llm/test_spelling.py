import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroute.llm import spelling as s
from tallyroute.session import materialize


def counted(rows):
    """Words and their counts, letter by letter as the contract says."""
    found = Counter()
    for key, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
                found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
                run = ""
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def by_definition(rows):
    words = counted(rows)
    others = {w: [o for o in words if near(w, o)] for w in words}
    form = {}
    for w, found in others.items():
        best = min(found, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    made = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        made[w] = (form[w], root, words[w], len(others[w]), words[form[w]] if form[w] else None)
    return made


def result(df):
    rows = df.collect()
    assert len(rows) == len({r.word for r in rows})
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def corpus(letters="abcé", n=400):
    draw = random.Random(3)
    words = ["".join(draw.choices(letters, k=draw.choice([4, 5, 5, 6, 7, 12]))) for _ in range(n)]
    words += [w.capitalize() for w in words[:30]] + ["È" + w for w in words[:10]]
    weight = [draw.choice([1, 1, 2, 5, 20]) for _ in words]
    return [(key, draw.choice([" ", "-", "3"]).join(draw.choices(words, weight, k=draw.randint(0, 120)))) for key in range(150)]


@pytest.mark.parametrize("alphabet", [3, 6, len(s.LETTERS)])
def test_neighbourhood_is_full_and_each_once(alphabet):
    value = s.values(alphabet)

    def hashed(code):
        return int(s.sums(value[np.array(code, int)], s.powers(len(code)))[-1]) if code else 0

    draw = random.Random(alphabet)
    for _ in range(100):
        code = [draw.randrange(min(alphabet, 4)) for _ in range(draw.randint(1, 7))]
        n = len(code)
        want = {tuple(code)} | {tuple(code[:i] + code[i + 1 :]) for i in range(n)}
        want |= {tuple(code[:i] + [x] + code[i + 1 :]) for i in range(n) for x in range(alphabet)}
        want |= {tuple(code[:i] + [x] + code[i:]) for i in range(n + 1) for x in range(alphabet)}
        got = [int(x) for block in s.neighbourhood(np.array(code), value) for x in block]
        assert sorted(got) == sorted(hashed(list(w)) for w in want)


def test_blocks_of_a_long_word(monkeypatch):
    code, value = np.array([random.Random(1).randrange(3) for _ in range(50)]), s.values(6)
    whole = sorted(int(x) for block in s.neighbourhood(code, value) for x in block)
    monkeypatch.setattr(s, "BLOCK", 7)
    assert sorted(int(x) for block in s.neighbourhood(code, value) for x in block) == whole


@pytest.mark.parametrize("crowd", [s.CROWD, 1])
def test_same_as_all_pairs(texts, crowd):
    """Also where every crowded reduced word goes on to the next alphabet."""
    rows = corpus()
    want = by_definition(rows)
    assert len(want) > 100 and any(v[1] != (v[0] or k) for k, v in want.items())
    assert result(s.variants(texts(rows), crowd=crowd)) == want


def test_neighbours_are_never_broadcast(spark):
    """Spark knows the size of the reduced words, not that each makes over a hundred neighbours."""
    words = materialize(spark.createDataFrame([("apple", 9), ("aple", 3), ("other", 4)], "word string, n long"))
    known = materialize(s.coded(words, 6))
    met = s.meeting(known.withColumn("sample", F.col("word")), known, 6)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {r.other for r in met.collect()} == {"apple", "aple", "other"}


def test_many_words_of_few_letters(texts):
    """More than CROWD words to one reduced word."""
    table = s.symbols(s.ALPHABETS[0])
    alike = [c for c in s.LETTERS if table[ord(c)] == table[ord("a")]]
    draw = random.Random(9)
    words = ["".join(draw.choices(alike, k=5)) for _ in range(150)]
    words += [w[:2] + draw.choice(alike) + w[3:] for w in words]
    rows = [(i, " ".join(words)) for i in range(3)] + [(9, " ".join(words[:200])), (10, " ".join(words[:100])), (11, " ".join(words[:100]))]
    want = by_definition(rows)
    assert len(want) > 2 * s.CROWD and any(v[3] for v in want.values())
    assert result(s.variants(texts(rows))) == want


def test_odd_rows(nasty, texts):
    assert result(s.variants(nasty)) == by_definition([(6, "word " * 60_000)]) == {}
    assert s.variants(nasty.limit(0)).collect() == []
    long = "".join(random.Random(2).choices("abcdefgh", k=9_000))
    rows = [(1, f"{long} {long}x Apple apple aple"), (1, f"{long} {long}x Apple apple aple"), (None, f"{long} {long}x apple. aple"), (3, None), (4, "")]
    rows += [(5, f"{long} {long}x {long} {long} {long}")]
    assert result(s.variants(texts(rows))) == by_definition(rows)


def test_equally_common_forms(texts):
    """Of near words that occur as often, the first in code-point order."""
    rows = [(i, "zebra " * 2 + "zebrá zebru zebrb ") for i in range(40)] + [(100 + i, "zebr zebrz") for i in range(4)]
    want = by_definition(rows)
    assert result(s.variants(texts(rows))) == want
