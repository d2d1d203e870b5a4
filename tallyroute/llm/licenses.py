"""License scan: ordered signature rules over the words of a text, by DataFrame functions alone.

The words of a text are compared once with the keywords of all rules; only the rules whose keyword occurs are
tried, over a form of the text in which every word carries its number, so that what a pattern matches tells from
which word to which. Of two detections of which one lies within the other, the one of lower rank goes: rank is
priority, then length in words, then the rules' order. Detections that merely overlap both stay. Everything happens within
the row: there is no shuffle, and one pass over a text's detections keeps only those that still overlap.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.llm.signatures import Rule, rules

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Phrases that are always looked for, by label.
BASE = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
#: How sure a detection of each priority makes; a base phrase counts as BASE_SCORE.
SCORES = {1: 1.0, 2: 0.9, 3: 0.6, 4: 0.3}
BASE_SCORE = 0.5
NO_RANK = 9
DETECTION = "struct<start:int,end:int,priority:int,place:int,label:string>"


def over_words(pattern: str) -> str:
    """A rule's pattern over the numbered form: every word as a blank, the word, character 1, its number, a blank."""
    return " " + pattern.replace(" ", "\x01[0-9]+  ").replace("[^\x01[0-9]+  \x01]", "[^ \x01]") + "\x01[0-9]+ "


def numbered(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w, i: F.concat(F.lit(" "), w, F.lit("\x01"), i.cast("string"), F.lit(" "))), "")


def found_by(form: Column, rule: Column) -> Column:
    """Every place where a rule matches. Matches are set apart by character 2 and cut out, which takes one pass however many they are."""
    apart = F.split(F.regexp_replace(form, rule["pattern"], F.lit("\x02$0\x02")), "\x02", -1)
    return F.transform(
        F.filter(apart, lambda _, i: i % 2 == 1),
        lambda m: F.struct(
            F.regexp_extract(m, "\x01([0-9]+)", 1).cast("int").alias("start"), F.regexp_extract(m, "\x01([0-9]+) $", 1).cast("int").alias("end"),
            rule["priority"].alias("priority"), rule["place"].alias("place"), rule["label"].alias("label"),
        ),
    )


def outranks(a: Column, b: Column) -> Column:
    """Whether detection a lies within b or around it, and has the higher rank."""
    within = ((a["start"] >= b["start"]) & (a["end"] <= b["end"])) | ((a["start"] <= b["start"]) & (a["end"] >= b["end"]))
    longer, shorter = a["end"] - a["start"], b["end"] - b["start"]
    tied = (longer > shorter) | ((longer == shorter) & (a["place"] < b["place"]))
    return within & ((a["priority"] < b["priority"]) | ((a["priority"] == b["priority"]) & tied))


def resolved(detections: Column) -> Column:
    """labels and best (least priority) of the detections that none outranks.

    Detections come sorted by place, and are held as long as they overlap: those of one stretch are compared
    with each other, what is left of it adds to the labels.
    """

    def settled(state: Column) -> tuple[Column, Column]:
        held = state["held"]
        kept = F.filter(held, lambda d: ~F.exists(held, lambda e: outranks(e, d)))
        labels = F.array_union(state["labels"], F.transform(kept, lambda d: d["label"]))
        return labels, F.least(state["best"], F.coalesce(F.array_min(F.transform(kept, lambda d: d["priority"])), F.lit(NO_RANK)))

    def state(labels, best, held, reach):
        made = F.struct(labels.alias("labels"), best.alias("best"), held.alias("held"), reach.alias("reach"))
        return made.cast(f"struct<labels:array<string>,best:int,held:array<{DETECTION}>,reach:int>")

    def step(now: Column, d: Column) -> Column:
        more = state(now["labels"], now["best"], F.concat(now["held"], F.array(d)), F.greatest(now["reach"], d["end"]))
        return F.when(d["start"] > now["reach"], state(*settled(now), F.array(d), d["end"])).otherwise(more)

    def last(now: Column) -> Column:
        labels, best = settled(now)
        return F.struct(labels.alias("labels"), best.alias("best"))

    none = state(F.array().cast("array<string>"), F.lit(NO_RANK), F.array().cast(f"array<{DETECTION}>"), F.lit(-1))
    return F.aggregate(detections, none, step, last)


def places(words: Column, n: Column, present: Column, phrase: list[str]) -> Column:
    """Numbers of the words at which a phrase begins."""
    def here(i):
        same = F.lit(True)
        for k, word in enumerate(phrase):
            same = same & (F.get(words, i + k) == word)
        return same

    there = F.array_contains(present, phrase[-1]) & (n >= len(phrase))
    return F.when(there, F.filter(F.sequence(F.lit(0), n - len(phrase)), here)).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, text: str = "text", signatures: list[Rule] | None = None, key: str = "doc_id") -> DataFrame:
    """key, n_words, n_base, first_word, last_word, base_labels, labels, score: the licenses that each text names.

    n_base counts the places of the base phrases, first_word and last_word are the least and greatest of them (null if
    none). labels are those of the base phrases and of the detections that no other outranks; score is that of the surest of all.

    One row per row, whatever the key; null and empty texts have no word and score 0. Only A-Z are lower-cased. Other columns
    are not read.
    """
    signatures = rules() if signatures is None else signatures
    listed = [dict(r._asdict(), pattern=over_words(r.pattern), place=i) for i, r in enumerate(signatures)]
    table = F.from_json(F.lit(json.dumps(listed)), "array<struct<pattern:string,keyword:string,priority:int,place:int,label:string>>")
    keywords = F.split(F.lit(" ".join(sorted({r.keyword for r in signatures} | {phrase[-1] for phrase in BASE.values()}))), " ")
    plain = F.translate(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), UPPER, LOWER)
    split = docs.select(F.col(f"`{key}`").alias("key"), F.array_remove(F.split(plain, BETWEEN_WORDS, -1), "").alias("words"))
    held = split.select("key", "words", F.size("words").alias("n"), F.array_intersect("words", keywords).alias("present"))
    tried = F.filter(table, lambda r: F.array_contains("present", r["keyword"]))
    spots = [places(F.col("words"), F.col("n"), F.col("present"), phrase).alias(f"base_{i}") for i, phrase in enumerate(BASE.values())]
    # Each of these is read more than once below: Spark then keeps the steps apart instead of repeating their work.
    tried = held.select("key", "words", "n", F.when(F.size("present") > 0, tried).alias("tried"), *spots)
    form = F.when(F.size("tried") > 0, numbered(F.col("words")))
    formed = tried.select("key", "n", "tried", form.alias("form"), *[f"base_{i}" for i in range(len(BASE))])
    detections = F.flatten(F.transform("tried", lambda r: found_by(F.col("form"), r)))
    detected = formed.select(
        "key", "n", F.when(F.col("form").isNotNull(), F.array_sort(detections)).alias("detections"),
        F.concat(*[f"base_{i}" for i in range(len(BASE))]).alias("at"),
        F.filter(F.array(*[F.when(F.size(f"base_{i}") > 0, F.lit(label)) for i, label in enumerate(BASE)]), lambda x: x.isNotNull()).alias("own"),
    )
    method = F.when(F.size("detections") > 0, resolved(F.col("detections")))
    judged = detected.select("key", "n", "at", "own", method.alias("method"))
    labels = F.array_union("own", F.coalesce("method.labels", F.array().cast("array<string>")))
    scores = F.create_map(*[F.lit(x) for pair in SCORES.items() for x in pair])
    sure = F.greatest(F.coalesce(F.try_element_at(scores, "method.best"), F.lit(0.0)), F.when(F.size("own") > 0, BASE_SCORE).otherwise(0.0))
    return judged.select(
        F.col("key").alias(key), F.col("n").cast("long").alias("n_words"), F.size("at").cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"), F.array_max("at").cast("long").alias("last_word"),
        F.array_join(F.array_sort("own"), ",").alias("base_labels"), F.array_join(F.array_sort(labels), ",").alias("labels"), sure.alias("score"),
    )
