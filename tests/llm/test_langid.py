import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyroute.llm import langid as g
from tallyroute.llm.queries import table


def phrases_by_search(text, reference):
    """Longest matches by substring search."""
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in reference:
            size += 1
        if text[at] not in reference:
            size = 1
        at, count = at + size, count + 1
    return count


def test_automaton_parses_as_substring_search():
    draw = random.Random(4)
    for _ in range(30):
        reference = "".join(draw.choices("abcd", k=draw.randint(1, 60)))
        table_ = g.parsing_table(g.suffix_automaton([ord(c) - 97 for c in reference]), 8)
        texts = ["".join(draw.choices("abcde", k=draw.randint(1, 500))) for _ in range(20)]
        model = g.Model(["x"], np.zeros(0), np.zeros(0), 8, [table_], [1.0])
        found = g.phrases(model, [np.array([ord(c) - 97 for c in t], np.uint8) for t in texts])
        assert found[:, 0].tolist() == [phrases_by_search(t, reference) for t in texts]


def test_tables_are_as_large_as_the_moves_are_many():
    draw = random.Random(7)
    moves = g.suffix_automaton([int(60 * draw.random() ** 2) for _ in range(5_000)])
    assert sum(part.nbytes for part in g.parsing_table(moves, 61)) <= 16 * sum(map(len, moves))


def test_only_texts_go_to_python(texts):
    kept = g.keep_known(texts([(1, "one two"), (2, "1 2"), (3, None)]), g.fit([("en", "one two three")]))
    assert [r.doc_id for r in kept.collect()] == [1]
    assert "MapInArrow" not in kept._jdf.queryExecution().executedPlan().toString()


def test_stretches_add_up():
    model = g.fit([("a", "lorem ipsum dolor"), ("b", "xyz zyx")])
    symbols = g.symbols_of("lorem xyz " * 200, model.symbols)
    whole = g.phrases(model, [symbols])[0]
    cut = sum(g.phrases(model, [symbols[i : i + g.STRETCH]])[0] for i in range(0, len(symbols), g.STRETCH))
    assert whole.tolist() == cut.tolist()


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = g.identify(docs, g.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where("held_out")
    right, total = held.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert total > 200 and right / total >= 0.98
    assert found.where("score < 0 or score > 1 or score is null").count() == 0
    assert {r.doc_id for r in held.collect()} == {i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 == 2}


def test_prediction_needs_text_only(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = g.learn(docs)
    shown = {r.doc_id: (r.lang_pred, r.score) for r in g.identify(docs, model).collect()}
    blind = docs.select((F.col("doc_id") + 5_000).alias("doc_id"), "text")
    assert {r.doc_id - 5_000: (r.lang_pred, r.score) for r in g.identify(blind.repartition(5), model).collect()} == shown


def test_odd_rows(nasty):
    model = g.fit([("en", "one two words no key at all end"), ("xx", "漢字 漢字"), ("yy", "123")])
    found = g.identify(nasty, model).collect()
    by = {r.doc_id: (r.lang_pred, r.held_out) for r in found}
    assert len(found) == 9 and by[1][0] == by[2][0] == by[3][0] == "und" and by[4][0] == by[6][0] == "en"
    assert all(r.score == 0 for r in found if r.lang_pred == "und") and by[None] == ("en", False)
    kept = g.keep_known(nasty, model)
    assert kept.columns == nasty.columns and kept.count() == 6
    assert g.identify(nasty.limit(0), model).collect() == []
    nothing = g.learn(nasty.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in g.identify(nasty, nothing).collect()} == {"und"}
    assert g.learn(nasty.limit(0)).languages == []
    assert g.judge(g.fit([("only", "a b")]), ["b a"]) == [("only", 1.0)]


def test_ties_go_to_the_common_language(texts):
    docs = texts([(i, "same words here") for i in range(40)])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 4 == 0, "aa").otherwise("zz"))
    assert g.learn(docs).languages == ["zz", "aa"]
    assert g.judge(g.fit([("aa", "same words"), ("zz", "same words")], ["zz", "aa"]), ["words", "same"]) == [("zz", 0.0)] * 2
