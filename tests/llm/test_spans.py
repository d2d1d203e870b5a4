import random
from collections import defaultdict

import pyarrow as pa

from tallyroute.llm import spans as s


def removed_by_definition(rows):
    """Sentences that go, per row: all runs of the operator, grouped by their text instead of a hash."""
    places = defaultdict(list)
    pieces = {}
    for key, text in rows:
        data = (text or "").encode()
        own = pieces[key] = [data[a:b] for a, b in s.sentences(data)]
        for first, last in s.runs([len(p.split()) for p in own]):
            places[tuple(own[first : last + 1])].append((key, first, last))
    gone = defaultdict(set)
    for found in places.values():
        for key, first, last in sorted(found)[1:]:
            gone[key] |= set(range(first, last + 1))
    return {k: sorted(v) for k, v in gone.items()}, pieces


def corpus():
    draw = random.Random(7)

    def sentence():
        return " ".join(draw.choices([f"w{i}" for i in range(500)], k=draw.choice([1, 2, 5, 9, 14]))) + draw.choice([".", "!", "?!"])

    passages = [" ".join(sentence() for _ in range(draw.randint(5, 12))) for _ in range(12)]
    rows = []
    for key in range(150):
        parts = [sentence() for _ in range(draw.randint(0, 12))]
        for _ in range(draw.choice([0, 0, 1, 2])):
            parts.insert(draw.randint(0, len(parts)), draw.choice(passages))
        rows.append((key, draw.choice([" ", "\n", "  "]).join(parts)))
    return passages, rows + [(900, "The same. " * 40), (901, rows[3][1]), (902, rows[3][1])]


def test_runs_cover_every_shared_passage():
    """Whatever stands around it, a passage of enough words is covered to its last sentence by runs inside it."""
    draw = random.Random(1)
    for _ in range(400):
        words = [draw.choice([1, 1, 2, 6, 15, 30]) for _ in range(draw.randint(2, 14))]
        first, last = 0, len(words) - 1
        around = [draw.randint(1, 20) for _ in range(3)]
        inside = [r for r in s.runs(around + words + around) if r[0] >= 3 and r[1] < 3 + len(words)]
        covered = {i - 3 for a, b in inside for i in range(a, b + 1)}
        assert covered == (set(range(first, last + 1)) if sum(words) >= s.MIN_WORDS else set())
        assert all(sum((around + words + around)[a : b + 1]) >= s.MIN_WORDS and b > a for a, b in inside)


def test_same_as_grouping_by_text(texts):
    passages, rows = corpus()
    gone, pieces = removed_by_definition(rows)
    found = {r.doc_id: r for r in s.repeats(texts(rows)).collect()}
    assert {k: r.removed_sentences for k, r in found.items()} == gone
    for key, r in found.items():
        left = [p for i, p in enumerate(pieces[key]) if i not in gone[key]]
        assert [r.text.encode()[a:b] for a, b in s.sentences(r.text.encode())] == left
        assert r.n_removed == len(gone[key]) and all(f <= key for f in r.first_keys)
    whole = s.without_repeats(texts(rows))
    assert whole.columns == texts(rows).columns
    kept = {r.doc_id: r.text for r in whole.collect()}
    assert kept == {k: found[k].text if k in found else t for k, t in rows}
    assert found[902].text == "" and found[901].first_keys[0] <= 3


def test_odd_rows(nasty, texts):
    assert s.repeats(nasty).collect() == []
    assert s.without_repeats(nasty).count() == 9 and s.without_repeats(nasty.limit(0)).count() == 0
    text = " ".join(f"Word{i} stands here." for i in range(12))
    rows = [(1, text), (1, text), (2, "Other. " + text), (None, text + " More."), (3, None), (3, text), (4, "Word1 stands here.")]
    found = {r.doc_id: r for r in s.repeats(texts(rows)).collect()}
    assert set(found) == {2, 3, None}
    assert found[2].text == "Other." and found[3].text == "" and found[None].text == "More."
    assert all(r.first_keys == [1] for r in found.values())
    assert s.repeats(nasty.limit(0)).collect() == []


def test_sentences():
    text = " One two.  Three!? Four\n\n five.six \x0b. ".encode()
    assert [text[a:b] for a, b in s.sentences(text)] == [b"One two.", b"Three!?", b"Four", b"five.six \x0b."]
    assert s.sentences(b"") == [] and s.sentences(b" \n ") == []


def test_passages_without_sentence_ends():
    """Whatever words stand around it, a passage of over 50 words in which no sentence ends shares a run with its other place."""
    draw = random.Random(5)

    def words(n):
        return [f"w{draw.randrange(3000)}" for _ in range(n)]

    for _ in range(300):
        passage = words(51)
        one, two = (" ".join(words(draw.randrange(30)) + passage + words(draw.randrange(30))).encode() for _ in range(2))
        assert {r[:2] for r in s.hashed_runs(one)} & {r[:2] for r in s.hashed_runs(two)}
        assert all(n <= s.LONG_WORDS for _, _, n in s.counted_sentences(one))


def test_copies_of_one_sentence(texts):
    plain = " ".join(f"item{i}" for i in range(60))
    wide = "".join(chr(0x4E00 + 7 * i) for i in range(120))
    rows = [(1, plain), (2, plain), (3, wide), (4, wide), (5, "Before " + plain + " after"), (6, plain[:100]), (7, "w " * 40), (8, "w " * 40)]
    found = {r.doc_id: r.text for r in s.repeats(texts(rows)).collect()}
    assert set(found) == {2, 4, 5, 8} and found[2] == found[4] == found[8] == ""
    assert found[5].startswith("Before") and found[5].endswith("after") and len(found[5].split()) <= 30


def test_sentence_ends_of_other_scripts():
    text = 'He said "go." Then. هل هذا؟ نعم۔ 一二。三「四！」五 यह है। वह'
    data = text.encode()
    assert [data[a:b].decode() for a, b in s.sentences(data)] == ['He said "go."', "Then.", "هل هذا؟", "نعم۔", "一二。", "三「四！」", "五 यह है।", "वह"]


def test_passages_of_sentences_are_found_wherever_they_stand():
    """Sentences of up to 15 words, over 50 in all: a run is shared even if words before or behind run into them."""
    draw = random.Random(6)

    def words(n):
        return [f"w{draw.randrange(3000)}" for _ in range(n)]

    def said(lengths):
        return " ".join(" ".join(words(n)) + "." for n in lengths)

    for _ in range(300):
        lengths = []
        while sum(lengths) <= 50:
            lengths.append(draw.randint(1, 15))
        passage = said(lengths)
        one, two = (f"{said([draw.randint(1, 30)])} {' '.join(words(draw.randrange(40)))} {passage} {' '.join(words(draw.randrange(40)))}".encode() for _ in range(2))
        assert {r[:2] for r in s.hashed_runs(one)} & {r[:2] for r in s.hashed_runs(two)}


def across_documents(rows):
    """Sentences within any run of enough words, of whatever length, that a document of smaller key holds too."""
    held = {}
    for key, said in rows:
        held[key] = {tuple(said[a:b]) for a in range(len(said)) for b in range(a + 1, len(said) + 1)}
    gone = {}
    for key, said in rows:
        out = set()
        for a in range(len(said)):
            for b in range(a + 1, len(said) + 1):
                if sum(len(x.split()) for x in said[a:b]) >= s.MIN_WORDS and any(tuple(said[a:b]) in held[k] for k, _ in rows if k < key):
                    out |= set(range(a, b))
        if out:
            gone[key] = sorted(out)
    return gone


def test_same_as_all_runs_of_all_documents(texts):
    """Brute force of its own: sentences come as lists, every run of every length is compared with every earlier document."""
    draw = random.Random(11)
    pool = [" ".join(draw.choices([f"w{i}" for i in range(40)], k=draw.choice([1, 3, 6, 12, 22]))) + draw.choice(".!?") for _ in range(60)]
    passages = [draw.choices(pool, k=draw.randint(3, 8)) for _ in range(6)]
    rows = []
    for key in range(40):
        said = []
        for _ in range(draw.randint(1, 4)):
            said += draw.choice(passages) if draw.random() < 0.4 else [f"own{key}x{draw.randrange(99)} word."] * draw.choice([1, 3])
        rows.append((key, said))
    want = across_documents(rows)
    assert 10 < len(want) < 40
    found = s.repeats(texts([(key, " ".join(said)) for key, said in rows]), within=False).collect()
    assert {r.doc_id: r.removed_sentences for r in found} == want


def test_repeats_within_one_document(texts):
    poem = "The rose is red and blooms all day and night for you and me. The violet is blue and blooms as long as any rose. "
    rows = [(1, poem * 3 + "End."), (2, "Own words here.")]
    assert s.repeats(texts(rows), within=False).collect() == []
    assert [r.doc_id for r in s.repeats(texts(rows)).collect()] == [1]
    (copy,) = s.repeats(texts([*rows, (3, "Before. " + poem * 2)]), within=False).collect()
    assert copy.doc_id == 3 and copy.text == "Before." and copy.first_keys == [1]


def windows_of_earlier_documents(rows):
    """Brute force of its own: the words of every text that lie in a window of 51 words which a document of smaller key holds."""
    held, gone = set(), {}
    for key, text in sorted(rows):
        words = text.split()
        own = [tuple(words[i : i + 51]) for i in range(len(words) - 50)]
        gone[key] = {i + j for i, window in enumerate(own) if window in held for j in range(51)}
        held.update(own)
    return gone


def test_passages_inside_sentences_and_of_one_word(texts):
    draw = random.Random(9)
    number = iter(range(10**9))

    def said(n, end=0.06):
        return [f"w{next(number)}" + ("." if draw.random() < end else "") for _ in range(n)]

    shared = [said(draw.randint(51, 90)) for _ in range(8)]
    rows = [(i, " ".join(said(draw.randint(0, 40)) + draw.choice(shared)[draw.randrange(3) :] + said(draw.randint(0, 40)))) for i in range(40)]
    half = said(25, 0), said(26, 0)  # a passage of two halves: no whole sentence and no piece of one is shared
    rows += [(100 + i, f"{' '.join(said(20, 0))} {' '.join(half[0])}. {' '.join(half[1])} {' '.join(said(20, 0))}.") for i in range(2)]
    rows += [(200, "own " + "w " * 60 + "one two"), (201, "w\n" * 70 + "three four"), (300, rows[0][1].replace(" ", "\n") + "\nmore")]
    found = {r.doc_id: r for r in s.repeats(texts(rows), within=False).collect()}
    gone = windows_of_earlier_documents(rows)
    assert {101, 201, 300} <= set(found) and all(key in found for key, words in gone.items() if words)
    for key, text in rows:
        if key in found and key != 201:
            left, words = found[key].text.split(), text.split()
            assert all(word in words for word in left)
            still = [i for i in gone[key] if words[i] in left]
            assert len(still) <= 2 * (s.CUT_WORDS - 1) and len(gone[key]) - len(still) >= min(len(gone[key]), s.MIN_WORDS)
    assert found[101].first_keys == [100] and found[101].text.split() == rows[41][1].split()[:20] + rows[41][1].split()[71:]
    assert found[201].text == "three four" and found[201].n_removed == len(found[201].removed_sentences) > 0
    assert found[300].text == "more" and found[300].first_keys[0] == 0


def test_windows_of_scripts_without_blanks_and_of_copies(texts):
    draw = random.Random(4)
    wide = "".join(chr(0x4E00 + draw.randrange(3000)) for _ in range(60))
    mixed = " ".join(f"é{draw.randrange(900)}！x" for _ in range(60))
    own = [" ".join(f"own{k}x{i}" for i in range(22)) for k in range(8)]
    rows = [(1, wide[:30] + "。" + wide[30:]), (2, own[0] + " " + wide[:30] + "。" + wide[30:]), (3, f"{own[1]} {mixed}"), (4, f"{mixed} {own[2]}")]
    rows += [(5, f"{own[3]} {mixed[5:]}"), (None, f"{own[3]} {mixed[5:]}"), (6, None), (7, own[4])]
    found = {r.doc_id: r for r in s.repeats(texts(rows), within=False).collect()}
    assert set(found) == {2, 4, 5, None} and found[None].text == ""
    for key, kept in ((2, own[0]), (4, own[2]), (5, own[3])):
        words = kept.split()
        assert set(words) <= set(found[key].text.split()) and len(found[key].text.split()) <= len(words) + 2 * (s.CUT_WORDS - 1)
    assert 3 in found[4].first_keys and 3 in found[5].first_keys
    assert s.repeats(texts([(1, "word " * 200), (2, "other words " * 9)])).collect() == []


def test_texts_are_worked_on_together(monkeypatch):
    """Many short texts are measured by few calls, and their runs and windows are those of every text for itself."""
    draw = random.Random(12)
    stops = [" ", " ", " ", " ", " ", " ", " ", ". ", "! ", "\n", "。", "… ", ".» "]

    def text(n, stops):
        return "".join(f"w{draw.randrange(300)}" + draw.choice(stops) for _ in range(n)).encode()

    texts = [text(draw.choice([1, 5, 60, 150]), stops if i % 50 == 0 else [e for e in stops if e != "。"]) for i in range(600)]
    texts += [b"no stop " * 40, b"one two " + text(120, [" "]), b" ", b"end.", b"(end.)"]

    def found(of, batches):
        return sorted(tuple(row.values()) for batch in of(batches) for row in batch.to_pylist())

    def batch(numbers, *more):
        columns = [pa.array(numbers, pa.int64()), *more[:1], pa.array([texts[i] for i in numbers], pa.binary()), *more[1:]]
        return pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])

    calls, measured = [], s.measured
    monkeypatch.setattr(s, "measured", lambda text: calls.append(len(text)) or measured(text))
    together = found(s._spans, [batch(range(len(texts)))])
    odd = sum(map(s.without_blanks, texts))
    assert 5 <= odd <= 12 and len(calls) <= odd + 1 + sum(map(len, texts)) // s.HELD_BYTES
    assert together == sorted(row for i in range(len(texts)) for row in found(s._spans, [batch([i])]))
    wanted = {i: [row[2] for row in together if row[0] == i and row[4] < 0 and row[2] % 2 == 0] for i in range(len(texts))}
    numbers = [i for i in wanted if wanted[i]]

    def windows(numbers):
        return found(s._windows, [batch(numbers, pa.array(numbers, pa.int64()), pa.array([wanted[i] for i in numbers], pa.list_(pa.int64())))])

    both = windows(numbers)
    assert len(both) > len(numbers) > 200 and both == sorted(row for i in numbers for row in windows([i]))
    assert all(last - first + 1 == s.PASSAGE_WORDS for *_, first, last in both)
