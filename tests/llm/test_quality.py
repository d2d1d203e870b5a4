from tallyroute.llm import quality as q


def repeated_by_sets(words):
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    return len({i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)})


def test_repeated_words_as_by_definition():
    cases = ["a", "a a a a a", "a a a a a a", "a b c d e a b c d e", "a b c d e f a b c d e", "x a b c d e y a b c d e z", "a b a b a b a b"]
    for text in cases + [" ".join(c * 3 for c in cases)]:
        words = text.encode().split()
        assert q.repeated_words(words) == repeated_by_sets(words), text


def test_measures(nasty):
    found = {r.doc_id: r for r in q.ledger(nasty).collect() if r.doc_id is not None}
    zero = (0,) * len(q.MEASURES)
    assert [tuple(found[i])[1:-1] for i in (1, 2, 3)] == [zero] * 3
    assert tuple(found[4])[1:-1] == (1, 3, 0, 1, 0, 0)
    assert tuple(found[5])[1:-1] == (5, 13, 3, 1, 0, 0)  # the no-break space belongs to its word
    assert (found[6].n_words, found[6].n_repeat_words) == (60_000, 60_000)
    assert q.ledger(nasty).count() == 9 and q.ledger(nasty.limit(0)).count() == 0
    assert q.measure(b"a\n\nb\na\n \na\nb") == (5, 5, 0, 5, 3, 0)


def test_each_rule_has_its_bit(texts):
    rows = [(1, "word " * 3), (2, "alpha beta gamma delta " * 20), (3, " ".join(f"w{i}x ##" for i in range(60)))]
    bits = {r.doc_id: {rule.name for i, rule in enumerate(q.RULES) if r.failed_bits >> i & 1} for r in q.ledger(texts(rows)).collect()}
    assert bits == {1: {"few_words", "few_words_strict"}, 2: {"repeated_words"}, 3: {"many_symbols", "some_symbols"}}


def test_policies_and_ablation(texts):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(n))) for i, n in enumerate([5, 5, 20, 60])] + [(9, None)]
    book = q.ledger(texts(rows)).cache()
    assert [book.where(q.passes(p)).count() for p in (q.BASE, q.PRODUCTION, q.STRICT)] == [2, 2, 1]
    found = {(r.version, r.rule): (r.kept, r.kept_without, r.recovered) for r in q.ablation(book, [q.BASE, q.STRICT]).collect()}
    assert found["base", "few_words"] == (2, 5, 3)
    assert found["v2", "few_words_strict"] == (1, 2, 1)
    assert found["v2", "few_words"] == (1, 1, 0)  # the stricter rule still holds them
    lenient = q.Policy("v3", q.STRICT.rules, tolerated=1)
    assert book.where(q.passes(lenient)).count() == 2
