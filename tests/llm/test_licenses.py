import random
import re

from tallyroute.llm import licenses as li
from tallyroute.llm.signatures import Rule, rules

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def by_definition(text, signatures):
    """Every rule on every text, matches found by position in the plain words, all detections compared with all."""
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    plain, at, starts = "", 0, {}
    for i, word in enumerate(words):
        starts[at] = i
        plain += f"[{word}]"
        at = len(plain)
    found = []
    for place, rule in enumerate(signatures):
        if rule.keyword not in words:
            continue
        pattern = re.escape("[") + rule.pattern.replace(" ", r"\]\[").replace(r"[^\]\[\x01]", r"[^\[\]]") + re.escape("]")
        for m in re.finditer(pattern.replace("[^\\]\\[\x01]", r"[^\[\]]"), plain):
            first = starts[m.start()]
            found.append((first, first + m[0].count("[") - 1, rule.priority, place, rule.label))

    def beaten(d):
        for e in found:
            within = (e[0] >= d[0] and e[1] <= d[1]) or (e[0] <= d[0] and e[1] >= d[1])
            if within and (e[2], e[0] - e[1], e[3]) < (d[2], d[0] - d[1], d[3]):
                return True
        return False

    kept = [d for d in found if not beaten(d)]
    base = [(i, label) for phrase, label in BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    own = {label for _, label in base}
    score = max([0.0] + [li.SCORES[d[2]] for d in kept] + [li.BASE_SCORE] * bool(base))
    spots = [i for i, _ in base]
    return (
        len(words), len(base), min(spots, default=None), max(spots, default=None),
        ",".join(sorted(own)), ",".join(sorted(own | {d[4] for d in kept})), score,
    )


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def check(texts, rows, signatures=None):
    used = rules() if signatures is None else signatures
    want = sorted(((key, *by_definition(text, used)) for key, text in rows), key=str)
    assert result(li.scan(texts(rows), signatures=signatures)) == want
    return want


def test_every_rule_can_be_reached():
    """The keyword of each rule is a word that a text matching it can hold, and no rule is there twice."""
    for rule in rules():
        assert re.fullmatch("[^ A-Z]+", rule.keyword)
        re.compile(li.over_words(rule.pattern))
    assert len(rules()) == len(set(rules())) > 200 and {r.priority for r in rules()} <= set(li.SCORES)


def test_named_licenses(texts):
    said = {
        "Released under the MIT License.": "mit",
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "GNU General Public License v3": "gpl,gpl-3",
        "the GNU Lesser General Public License version 2.1 or (at your option) any later version": "gpl,lgpl-2.1-or-later",
        "BSD 3-Clause License": "bsd-3-clause",
        "(CC BY-SA 4.0)": "cc-by,cc-by-sa-4.0",
        "Creative Commons Attribution-ShareAlike 4.0 International": "cc-by-sa-4.0",
        "see creativecommons.org/licenses/by-nc/4.0/": "cc-by-nc-4.0",
        "All rights reserved.": "reserved",
        "Dual MIT License / GPLv2": "gpl-2,mit",
        "Tous droits réservés": "reserved",
        "This permits limits and smite licenses": "",
    }
    rows = list(enumerate(said))
    found = {r.doc_id: r.labels for r in li.scan(texts(rows)).collect()}
    assert {said_text: found[i] for i, said_text in rows} == said
    check(texts, rows)


def test_same_as_definition(texts):
    draw = random.Random(5)
    phrases = [re.sub(r"\(\?:([^()|]*)[^()]*\)\??", r"\1", r.pattern) for r in rules()]
    phrases = [re.sub(r"[^a-z0-9éç ]+", " ", p) for p in phrases] + ["all rights reserved", "cc by", "general public license", "version 2 0", "or later", "é"]
    rows = []
    for key in range(120):
        parts = [draw.choice(phrases) if draw.random() < 0.6 else draw.choice(["the", "bread", "License", "gnu", "under"]) for _ in range(draw.randint(0, 25))]
        rows.append((key, draw.choice([" ", ", ", "\n"]).join(parts).title() if key % 3 else " ".join(parts)))
    want = check(texts, rows)
    assert len({w[6] for w in want}) > 60


def test_rank_and_containment(texts):
    own = [
        Rule("long", 2, "b", "a b c"), Rule("short", 1, "b", "b"), Rule("other", 2, "c", "c d"), Rule("same", 2, "c", "c d"), Rule("wide", 2, "d", "a b c d"),
    ]
    rows = [(1, "a b c"), (2, "a B c d"), (3, "c d"), (4, "a b c a b c c d"), (5, "b" * 3), (6, "d c b a")]
    check(texts, rows, own)
    found = {r.doc_id: r.labels for r in li.scan(texts(rows), signatures=own).collect()}
    assert found == {1: "short", 2: "short", 3: "other", 4: "other,short", 5: "", 6: "short"}


def test_odd_rows(nasty, texts):
    found = li.scan(nasty).collect()
    assert len(found) == 9 and all(r.labels == r.base_labels == "" and r.score == 0 and r.first_word is None for r in found)
    assert max(r.n_words for r in found) == 60_000
    assert li.scan(nasty.limit(0)).collect() == []
    rows = [(1, "cc by"), (1, "cc by"), (None, "cc by cc by"), (2, None), (3, "All  RIGHTS\nreserved all rights"), (4, "cc by ccé by"), (5, "by cc")]
    check(texts, rows)
    many = [(1, "Released under the MIT License. " * 4_000 + "GPL")]
    (row,) = li.scan(texts(many)).collect()
    assert row.n_words == 20_001 and row.labels == "gpl,mit"
