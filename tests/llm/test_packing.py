import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroute.llm import packing
from tallyroute.llm.queries import END_OF_TEXT, TOKENIZER, packed_tokens


def test_capacity_tree_takes_the_least_that_fits():
    draw = random.Random(1)
    tree, held = packing.CapacityTree(37), []
    for step in range(3_000):
        if draw.random() < 0.5:
            capacity = draw.randint(0, 37)
            tree.add(step, capacity)
            held.append((capacity, step))
        else:
            need = draw.randint(1, 37)
            fits = [c for c, _ in held if c >= need]
            found = tree.take(need)
            assert (found is None) == (not fits)
            if found:
                assert found[1] == min(fits)
                held.remove((found[1], found[0]))


def test_best_fit_decreasing():
    draw = random.Random(2)
    for capacity in (1, 8, 100):
        lengths = [draw.randint(1, capacity) for _ in range(300)]
        rows = packing.best_fit(lengths, capacity)
        assert sorted(i for r in rows for i in r) == list(range(300))
        assert all(sum(lengths[i] for i in r) <= capacity for r in rows)
        plain = []  # the same rule, searched linearly
        for n in sorted(lengths, reverse=True):
            fits = [i for i, room in enumerate(plain) if room >= n]
            at = min(fits, key=lambda i: plain[i]) if fits else len(plain)
            plain[at:at + 1] = [(plain[at] if fits else capacity) - n]
        assert len(rows) == len(plain)
    assert packing.best_fit([], 5) == []


def test_words_encode_as_the_whole_text():
    of = packing.rank_file_encoder(TOKENIZER)
    draw = random.Random(3)
    signs = ["a", "it's", "É", "漢字", "12", "#", ".\nB", " ", "\n", "\t", " ", "　", "\x1c", "\U0001f600", "we'll", "''s"]
    for _ in range(3_000):
        text = " ".join("".join(draw.choices(signs, k=draw.randint(0, 4))) for _ in range(draw.randint(0, 6)))
        assert of(text) == encoder()(text), repr(text)
    assert of("") == []


def encoder(made=[]):  # noqa: B006
    if not made:
        import base64

        import tiktoken

        with open(TOKENIZER, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        made.append(tiktoken.Encoding("t", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary)
    return made[0]


@pytest.mark.parametrize("length", [16, 2048])
def test_lossless_round_trip(texts, nasty, length):
    draw = random.Random(4)
    rows = [(100 + i, " ".join(draw.choices(["alpha", "Beta", "γ", "x1"], k=draw.randint(0, 300)))) for i in range(200)]
    docs = nasty.unionByName(texts(rows))
    made = packed_tokens(docs, length=length).cache()
    pieces = {}
    for r in packing.pieces_of(made).collect():
        pieces.setdefault(r.doc_id, []).append((r.doc_offset, np.frombuffer(r.ids, "<u2").tolist()))
    counted = {r.doc_id: r["count"] for r in docs.where("text is not null").groupBy("doc_id").count().collect()}
    for key, text in {(r.doc_id, r.text) for r in docs.where("text is not null").collect()}:
        ids = [*encoder()(text), END_OF_TEXT]
        cut = [(at, ids[at : at + length]) for at in range(0, len(ids), length)]
        assert sorted(pieces[key]) == sorted(cut * counted[key])
    assert set(pieces) == set(counted)
    for r in made.collect():
        assert len(r.input_ids) == 2 * length and r.cu_seqlens[-1] == r.n_tokens <= length and r.position_resets == r.cu_seqlens[:-1]
        assert set(np.frombuffer(r.input_ids, "<u2")[r.n_tokens :].tolist()) <= {END_OF_TEXT}
    assert made.groupBy("shard", "row").count().where("count > 1").count() == 0


def test_rows_are_well_filled(texts):
    docs = texts([(i, "some words and more " * (1 + i * 7 % 90)) for i in range(3_000)]).coalesce(1)
    used, rows = packed_tokens(docs).agg(F.sum("n_tokens"), F.count(F.lit(1))).first()
    assert used / rows / packing.LENGTH > 0.99


def test_no_rows(texts):
    assert packed_tokens(texts([])).collect() == [] and packed_tokens(texts([(1, None)])).collect() == []
