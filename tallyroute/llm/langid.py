"""Language identification by cross-parsing.

A bounded sample of labelled text per language becomes a suffix automaton. A text is cut into the fewest
phrases that each occur in a language's sample by always taking the longest match; the number of
phrases, times the bits that name a place in the sample, measures how foreign the text is. The
language that needs least wins. The automata are arrays about as long as they have moves, so a task holds
them in a few megabytes and walks thousands of stretches of text through each at once, one symbol a step.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UNKNOWN = "und"
SAMPLE_ROWS = 96  # labelled rows a language is learned from
SAMPLE_CHARS = 1_000  # characters used of each of these rows
SYMBOLS_OF_ALL = 160_000  # symbols in all automata together, shared evenly by the languages
SYMBOLS_OF_ONE = 40_000
LETTERS = 60  # letters that are one symbol each; all others are spelt out, so none is lost
RARE_DIGITS = 5  # a rare letter is that many symbols: its code point's last digits to base 16
STRETCH = 512  # symbols parsed in one go; every phrase ends with it
GROUP_SYMBOLS = 2_000_000
BLANK, RARE, FIRST_LETTER = 0, 1, 17  # symbols: anything but letters, from RARE the 16 digits of rare letters, then letters


@dataclass
class Model:
    """Symbol of each code point, and per language the arrays of ``parsing_table``."""

    languages: list[str]
    symbols: np.ndarray
    letters: np.ndarray
    width: int
    tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    bits: list[float]


def symbols_of(text: str, table: np.ndarray) -> np.ndarray:
    """The symbols of a text; a run of blanks counts once, a rare letter is several symbols."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    found = table[points]
    rare = np.flatnonzero(found == RARE)
    if len(rare):
        times = np.where(found == RARE, RARE_DIGITS, 1)
        first = (np.cumsum(times) - times)[rare]
        found = np.repeat(found, times)
        for digit in range(RARE_DIGITS):
            found[first + digit] = RARE + (points[rare] >> (4 * (RARE_DIGITS - 1 - digit)) & 15)
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != BLANK) | (found[:-1] != BLANK)
    return found[keep]


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring of ``text``; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for symbol in text:
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        new, state = len(moves) - 1, last
        while state >= 0 and symbol not in moves[state]:
            moves[state][symbol] = new
            state = link[state]
        if state >= 0:
            target = moves[state][symbol]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                moves.append(dict(moves[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                clone = len(moves) - 1
                while state >= 0 and moves[state].get(symbol) == target:
                    moves[state][symbol] = clone
                    state = link[state]
                link[target] = link[new] = clone
        last = new
    return moves


def parsing_table(moves: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The automaton with restarts as arrays (owner, next, start); a state is a number of its own, 0 is the start.

    A move of ``state`` by ``symbol`` is there if owner[state + symbol] is the state, and leads to
    next[state + symbol]. Any other symbol ends a match and starts the next phrase in start[symbol]. The
    states with most moves are numbered first, each with the least number whose places are free. The last
    symbol is filling and never moves.
    """
    numbers, used, taken = [0] * len(moves), 1, 0  # used numbers and taken places as bits
    ordered = sorted(range(1, len(moves)), key=lambda state: -len(moves[state]))
    single = next((i for i, state in enumerate(ordered) if len(moves[state]) < 2), len(ordered))
    for state in ordered[:single]:
        places, clash = 0, used
        for symbol in moves[state]:
            places |= 1 << symbol
            clash |= taken >> symbol
        numbers[state] = number = (~clash & (clash + 1)).bit_length() - 1
        used |= 1 << number
        taken |= places << number
    # All others have one move at most: what was not free for a symbol before is not free for it later.
    room = max(used.bit_length(), taken.bit_length()) + len(ordered) + 2 * width
    used, taken = (bytearray(map(int, bin(bits)[:1:-1].ljust(room, "0"))) for bits in (used, taken))
    least = [0] * width
    for state in ordered[single:]:
        symbol = next(iter(moves[state]), width - 1)
        number = least[symbol]
        while used[number] or taken[number + symbol]:
            number += 1
        numbers[state] = least[symbol] = number
        used[number] = taken[number + symbol] = 1
    owner = np.full(max(numbers) + width, -1, np.int32)
    following = np.zeros(len(owner), np.int32)
    for state, row in enumerate(moves[1:], 1):
        for symbol, target in row.items():
            owner[numbers[state] + symbol] = numbers[state]
            following[numbers[state] + symbol] = numbers[target]
    start = np.zeros(width, np.int32)
    for symbol, target in moves[0].items():
        start[symbol] = numbers[target]
    return owner, following, start


def fit(samples: list[tuple[str, str]], common_first: list[str] | None = None) -> Model:
    """``samples``: (language, text), in an order that doesn't vary. ``common_first``: languages, by name if not given."""
    letters = np.fromiter(map(str.isalpha, map(chr, range(sys.maxunicode + 1))), bool, sys.maxunicode + 1)
    counted = Counter(c for _, text in samples for c in text.lower() if c.isalpha())
    table = np.where(letters, RARE, BLANK).astype(np.uint8)
    common = sorted(counted, key=lambda c: (-counted[c], c))[:LETTERS]
    for symbol, letter in enumerate(common, FIRST_LETTER):
        table[ord(letter)] = symbol
        if len(letter.upper()) == 1:
            table[ord(letter.upper())] = symbol
    width = FIRST_LETTER + len(common) + 1
    languages = common_first or sorted({language for language, _ in samples})
    limit = min(SYMBOLS_OF_ONE, SYMBOLS_OF_ALL // max(1, len(languages)))
    tables, bits, known = [], [], []
    for language in languages:
        parts, total = [], 0
        for name, text in samples:
            if name == language and total < limit:
                own = symbols_of(" " + text + " ", table)[: limit - total]
                parts.append(own)
                total += len(own)
        if total:
            known.append(language)
            tables.append(parsing_table(suffix_automaton(np.concatenate(parts).tolist()), width))
            bits.append(float(np.log2(total + width)))  # a phrase is a place in the sample or a single symbol
    return Model(known, table, letters, width, tables, bits)


def phrases(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Phrases per text and language; a stretch of a text is parsed for itself."""
    sizes = np.array([len(t) for t in texts])
    counts = -(-sizes // STRETCH)
    grid = np.full((int(counts.sum()), STRETCH), model.width - 1, np.uint8)
    row = 0
    for text, rows in zip(texts, counts, strict=True):
        grid[row : row + rows].reshape(-1)[: len(text)] = text
        row += rows
    steps = np.ascontiguousarray(grid.T)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    found = np.zeros((len(texts), len(model.languages)), np.int64)
    for place, (owner, following, start) in enumerate(model.tables):
        state = np.zeros(grid.shape[0], np.int32)
        inside = np.zeros(grid.shape[0], np.int32)
        for symbols in steps:
            at = state + symbols
            moved = owner.take(at, mode="clip") == state  # never outside; clipping is the fastest mode
            state = start.take(symbols, mode="clip")
            np.copyto(state, following.take(at, mode="clip"), where=moved)
            inside += moved
        found[:, place] = sizes - np.add.reduceat(inside, starts)  # a symbol that isn't inside a phrase starts one
    return found


def decide(model: Model, found: np.ndarray) -> tuple[str, float]:
    """(language of the fewest normalised phrases, 1 - its number / that of the next); ties go to the first of the model."""
    cost = found * np.array(model.bits)
    order = np.argsort(cost, kind="stable")
    if len(order) == 1:
        return model.languages[0], 1.0
    return model.languages[order[0]], float(min(1.0, max(0.0, 1 - cost[order[0]] / cost[order[1]])))


def judge(model: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, score) of each text; null, no letter, or nothing learned: unknown, with score 0."""
    result, wanted, places = [(UNKNOWN, 0.0)] * len(texts), [], []
    for place, text in enumerate(texts):
        if text and model.languages and model.letters[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")].any():
            wanted.append(symbols_of(text, model.symbols))
            places.append(place)
    if wanted:
        for place, found in zip(places, phrases(model, wanted), strict=True):
            result[place] = decide(model, found)
    return result


def remainder(key: str) -> Column:
    """crc32 of the key as text, modulo 4; -1 for a null key."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")), F.lit(4)).cast("int"), F.lit(-1))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fit on a sample: per language the SAMPLE_ROWS rows that come first by a hash of their key.

    Rows whose remainder is 2 are held out; null texts, null languages and texts without letters are never
    learned from. Languages are ordered by their number of labelled rows. The limit is kept in each task before anything is shuffled, so a frequent language is no hot group.
    """
    usable = docs.where(
        (remainder(key) != 2) & F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").rlike(r"\p{L}")
    ).select(
        F.col(f"`{lang}`").alias("lang"),
        F.substring(F.col(f"`{text}`"), 1, SAMPLE_CHARS).alias("text"),
        F.xxhash64(F.lit("language sample"), F.col(f"`{key}`").cast("string")).alias("rank"),
    )
    order = Window.partitionBy("lang").orderBy("rank", "text")
    rows = usable.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_ROWS).collect()
    common = sorted(usable.groupBy("lang").count().collect(), key=lambda r: (-r["count"], r.lang))
    return fit([(r.lang, r.text) for r in sorted(rows, key=lambda r: (r.lang, r.n))], [r.lang for r in common])


def _in_groups(column: pa.Array) -> Iterator[list[str | None]]:
    """The texts in groups of about GROUP_SYMBOLS characters, or one longer text."""
    texts, held = [], 0
    for value in column:
        texts.append(value.as_py())
        held += len(texts[-1] or "")
        if held >= GROUP_SYMBOLS:
            yield texts
            texts, held = [], 0
    if texts:
        yield texts


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, lang_pred and score of every row; repeated rows each get a row, a null key is not held out."""
    kind = docs.schema[key].dataType.simpleString()
    # At most SYMBOLS_OF_ALL * 3 moves; plain values, as a broadcast class would be looked up in a package that executors may lack.
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))

    def run(batches):
        for batch in batches:
            found = [one for texts in _in_groups(batch.column(2)) for one in judge(Model(*shared.value), texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                names=["id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col(f"`{key}`").alias("id"), (remainder(key) == 2).alias("held_out"), F.col(f"`{text}`").alias("text"))
    made = rows.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double")
    return made.withColumnRenamed("id", key)


def keep_known(docs: DataFrame, model: Model, text: str = "text", least_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose language is known with at least ``least_score``; unknown ones go.

    Only the texts go to Python, and only the verdicts come back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))

    @F.arrow_udf("boolean")
    def known(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            found = [one for texts in _in_groups(column) for one in judge(Model(*shared.value), texts)]
            yield pa.array([name != UNKNOWN and score >= least_score for name, score in found], pa.bool_())

    return docs.where(known(F.col(f"`{text}`")))
