"""Removal of repeated passages, by hashed runs of consecutive sentences and of words.

From every sentence the shortest run forwards, and to every sentence the shortest run backwards, that
has at least two sentences and MIN_WORDS words is hashed, and so is a single sentence of that many words. Any passage of
whole sentences and MIN_WORDS words that two places share is thereby covered to its last sentence by runs they share. Runs
are counted by hash over the whole corpus; of a repeated one the first place, by document and sentence,
stays, and sentences covered by any other place go. On request only runs that several documents hold count: then all places of
the first document stay, such as the lines of a poem or a table that one text says twice.

Runs are hashed by sums of sentence hashes times powers of an odd number, so each sentence is hashed once and a run
costs one subtraction, for all runs of a text at once. Only run hashes and places are shuffled, never texts.

A sentence of over LONG_WORDS words counts as several: it is cut before each word whose hash is the least
of some CUT_WORDS consecutive words of it, so the cuts move with the text, no piece is longer than CUT_WORDS
words, and cuts that are CUT_WORDS words away from the ends of a shared passage are the same wherever it
stands. One word said over and over is not cut: such a piece is hashed whole.

A passage of PASSAGE_WORDS words that two documents share goes wherever sentences end in it: its words are compared one by
one, the blanks between them are not. Less than CUT_WORDS words of a sentence at an end of it stay, if whole sentences of
MIN_WORDS words go. Of every such window the least hash of its runs of ANCHOR_WORDS words is noted, a few for each text. Equal
windows have equal least hashes, so only windows whose least hash another text has are hashed whole, and these are
counted like the runs of sentences. Of texts that are the same only the first document's windows are compared: the others go whole by their sentences.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroute.llm.rows import as_batch, map_rows, packed, unpacked, utf8
from tallyroute.session import discard, materialize, materialize_at, scratch_path

MIN_SENTENCES = 2
MIN_WORDS = 20
TEXT_SEED = 42
LONG_WORDS = 50  # longer sentences are cut; 2 * (2 * CUT_WORDS - 1) + MIN_WORDS words are no more than that
CUT_WORDS = 8
PASSAGE_WORDS = 51  # words of a passage that counts wherever sentences end
ANCHOR_WORDS = 20  # words of the runs whose least hash tells which windows may be repeated
#: Odd numbers whose powers weigh the sentences of a run, for the two halves of its hash, and their inverses modulo 2^64.
WEIGHTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(w, -1, 1 << 64) for w in WEIGHTS)
HELD_RUNS = 20_000
HELD_BYTES = 1 << 17  # of texts that are worked on together
#: A sentence ends after closing marks before a blank, at a line end, or with the text. Arabic, Armenian, Indic and Ethiopic
#: stops end one too; wide, Khmer and Burmese ones need no blank. The set of first bytes lets the search leap over all others.
SENTENCE_END = re.compile(
    rb"[\n.!?\xd6\xd8\xdb\xe0-\xe3\xef](?:(?<=\n)"
    rb"|(?:(?<=[.!?])|(?<=\xd8)\x9f|(?<=\xdb)\x94|(?<=\xd6)\x89|(?<=\xe0)\xa5[\xa4\xa5]|(?<=\xe1)\x8d\xa2|(?<=\xe2)\x80\xa6)"
    rb"(?:[.!?]|\xd8\x9f|\xdb\x94|\xd6\x89|\xe0\xa5[\xa4\xa5]|\xe1\x8d\xa2|\xe2\x80\xa6)*"
    rb"(?:[\"')\]}]|\xc2\xbb|\xe2\x80[\x98\x99\x9c\x9d\xba])*(?=[\x20\x09-\x0D])"
    rb"|(?:(?<=\xe3)\x80\x82|(?<=\xef)(?:\xbc[\x81\x8e\x9f]|\xbd\xa1)|(?<=\xe1)(?:\x9f\x94|\x81\x8b))"
    rb"(?:\xe3\x80\x82|\xef\xbc[\x81\x8e\x9f]|\xef\xbd\xa1|\xe1\x9f\x94|\xe1\x81\x8b)*"
    rb"(?:[\"')\]}]|\xe2\x80[\x99\x9d]|\xe3\x80[\x89\x8b\x8d\x8f\x91]|\xef\xbc\x89)*)"
)
#: A character of a script that is written without blanks (Thai, Lao, Burmese, Khmer, kana, ideographs) is a word.
UNSPACED = rb"(?:\xe0[\xb8-\xbb]|\xe1[\x80-\x82\x9e\x9f]|[\xe3-\xe9][\x80-\xbf]|\xf0[\xa0-\xb3][\x80-\xbf])[\x80-\xbf]"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
WORD_UTF8 = re.compile(rb"%b|(?:(?!%b)[^\x20\x09-\x0D])+" % (UNSPACED, UNSPACED))
UNSPACED = re.compile(UNSPACED)
#: Such a character, or a stop that needs no blank: where none is, words and sentences begin and end at blanks.
NO_BLANK = re.compile(
    rb"[\xe0\xe1\xe3-\xe9\xef\xf0](?:(?:(?<=\xe0)[\xb8-\xbb]|(?<=\xe1)[\x80-\x82\x9e\x9f]|(?<=[\xe3-\xe9])[\x80-\xbf]"
    rb"|(?<=\xf0)[\xa0-\xb3][\x80-\xbf])[\x80-\xbf]|(?<=\xef)(?:\xbc[\x81\x8e\x9f]|\xbd\xa1))"
)
#: 0 for blanks, 1 for other bytes.
FILLED = bytes(byte not in b" \t\n\v\f\r" for byte in range(256))
#: A random number for every byte, for the two hashes of words.
BYTES = np.random.default_rng(6).integers(0, 1 << 64, (2, 256), dtype=np.uint64)


def cuts(words: list[bytes], piece: np.ndarray) -> np.ndarray:
    """Numbers of the words that begin a piece: the first ones of long sentences, and the last least hash of every CUT_WORDS words.

    ``piece`` says which words are of one sentence. A word that is the same as the one before it begins none.
    """
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    never = np.iinfo(np.uint64).max
    follows = piece[1:] == piece[:-1]
    own[1:][(own[1:] == own[:-1]) & follows] = never
    least, at, width = own, np.arange(len(own)), 1
    while width < CUT_WORDS:
        step = min(width, CUT_WORDS - width)
        at = np.where(least[step:] <= least[:-step], at[step:], at[:-step])
        least = np.minimum(least[:-step], least[step:])
        width += step
    whole = piece[: len(least)] == piece[CUT_WORDS - 1 :]
    return np.union1d(np.flatnonzero(~np.append(False, follows)), at[whole & (least != never)])


def blank_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where what stands between blanks starts and ends."""
    filled = np.frombuffer(b"\0" + text.translate(FILLED) + b"\0", np.uint8)
    bounds = np.flatnonzero(filled[1:] != filled[:-1])
    return bounds[::2], bounds[1::2]


def measured(text: bytes) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Start, end and words of every sentence, and of every piece of a long one; where all words start and end."""
    if without_blanks(text):
        pieces = pieces_without_blanks(text)
        return tuple(np.array(pieces, np.int64).reshape(-1, 3).T), word_bounds(text, pieces)
    starts, ends = blank_bounds(text)
    stops = [m.end() for m in SENTENCE_END.finditer(text)]
    firsts = np.searchsorted(starts, [0, *stops])  # the first word after each end
    firsts = np.append(firsts, len(starts))
    firsts = firsts[:-1][firsts[1:] > firsts[:-1]]
    counts = np.append(firsts[1:], len(starts)) - firsts
    if len(long := np.flatnonzero(counts > LONG_WORDS)):
        piece = np.repeat(long, counts[long])
        number = np.flatnonzero(np.repeat(counts > LONG_WORDS, counts))
        words = [text[a:b] for a, b in zip(starts[number].tolist(), ends[number].tolist(), strict=True)]
        firsts = np.union1d(firsts, number[cuts(words, piece)])
        counts = np.append(firsts[1:], len(starts)) - firsts
    return (starts[firsts], ends[firsts + counts - 1], counts), (starts, ends)


def without_blanks(text: bytes) -> bool:
    """Whether words or sentences of the text may end without a blank."""
    return not text.isascii() and NO_BLANK.search(text) is not None


def pieces_without_blanks(text: bytes) -> list[tuple[int, int, int]]:
    """The same of a text whose sentences or words may end without a blank."""
    spaced = not UNSPACED.search(text)
    found, start = [], 0
    for end in [m.end() for m in SENTENCE_END.finditer(text)] + [len(text)]:
        if piece := text[start:end].lstrip():
            at, piece = end - len(piece), piece.rstrip()
            stop = at + len(piece)
            n = len(piece.split()) if spaced else sum(1 for _ in WORD_UTF8.finditer(piece))
            if n <= LONG_WORDS:
                found.append((at, stop, n))
            else:
                words = list((WORD if spaced else WORD_UTF8).finditer(text, at, stop))
                bounds = [*cuts([m[0] for m in words], np.zeros(n, np.int64)).tolist(), n]
                found += [(words[a].start(), words[b - 1].end(), b - a) for a, b in zip(bounds, bounds[1:])]
        start = end
    return found


def counted_sentences(text: bytes) -> list[tuple[int, int, int]]:
    """(start, end, words) of every sentence, and of every piece of a long one."""
    return list(zip(*(side.tolist() for side in measured(text)[0]), strict=True))


def sentences(text: bytes) -> list[tuple[int, int]]:
    """(start, end) in bytes of every sentence, or piece of a long one, that has a word; between them lie only blanks."""
    return [(start, end) for start, end, _ in counted_sentences(text)]


def bounds_of_runs(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last sentence of each run that is hashed, given the sentences' numbers of words and of the document."""
    n = len(words)
    upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(words)])
    at = np.arange(n)
    # For each last sentence the latest first one that leaves enough words, for each first one the earliest last.
    first = np.minimum(np.searchsorted(upto, upto[1:] - MIN_WORDS, side="right") - 1, at - MIN_SENTENCES + 1)
    last = np.maximum(np.searchsorted(upto, upto[:-1] + MIN_WORDS) - 1, at + MIN_SENTENCES - 1)
    backwards, forwards = np.flatnonzero(first >= 0), np.flatnonzero(last < n)
    backwards = backwards[doc[first[backwards]] == doc[backwards]]
    forwards = forwards[(doc[last[forwards]] == doc[forwards]) & (first[last[forwards]] != forwards)]  # those that aren't runs backwards too
    return np.concatenate([first[backwards], forwards]), np.concatenate([backwards, last[forwards]])


def runs(words: list[int]) -> set[tuple[int, int]]:
    """(first, last) sentence of each run of several sentences that is hashed."""
    found = bounds_of_runs(np.array(words, np.int64), np.zeros(len(words), np.int64))
    return set(zip(*(side.tolist() for side in found), strict=True))


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


@functools.cache
def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of ``base``, modulo 2^64."""
    made = np.full(n, base, np.uint64)
    made[:1] = 1
    return np.cumprod(made)


def weighed(own: np.ndarray, first: np.ndarray, last: np.ndarray, weight: int, inverse: int) -> np.ndarray:
    """Sum of the hashes (of sentences, words, bytes) from first to last, times powers of ``weight`` from the run's start."""
    n = 1 << len(own).bit_length()  # tables of few lengths
    upto = np.zeros(len(own) + 1, np.uint64)
    np.cumsum(own * powers(weight, n)[: len(own)], out=upto[1:])
    return ((upto[last + 1] - upto[first]) * powers(inverse, n)[first]).view(np.int64)


def digests(parts: Iterable[bytes]) -> np.ndarray:
    """Two words of hash (columns) of every part."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), "<u8").reshape(-1, 2).astype(np.uint64)


def halves(own: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    return [weighed(own[:, i], first, last, WEIGHTS[i], INVERSES[i]) for i in range(2)]


def arrays_of_runs(
    text: bytes, pieces: tuple[np.ndarray, np.ndarray, np.ndarray], doc: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, second hash, first and last sentence of every run; sentences are compared byte by byte, trimmed."""
    starts, ends, words = pieces
    first, last = bounds_of_runs(words, doc)
    alone = np.flatnonzero(words >= MIN_WORDS)
    first, last = np.concatenate([first, alone]), np.concatenate([last, alone])
    return *halves(digests(text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), first, last), first, last


def word_bounds(text: bytes, pieces: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of all sentences start and end."""
    starts, ends = blank_bounds(text)
    if len(starts) < sum(n for _, _, n in pieces):  # some of what stands between blanks is several words
        pattern = WORD_UTF8 if UNSPACED.search(text) else WORD
        bounds = np.array([word.span() for a, b, _ in pieces for word in pattern.finditer(text, a, b)], np.int64)
        starts, ends = bounds[:, 0], bounds[:, 1]
    return starts, ends


def hashed_words(text: bytes, starts: np.ndarray, ends: np.ndarray, half: int) -> np.ndarray:
    """A word of hash of every word: its bytes' numbers times powers of an odd number, stirred."""
    made = weighed(BYTES[half].take(np.frombuffer(text, np.uint8)), starts, ends - 1, WEIGHTS[half], INVERSES[half]).view(np.uint64)
    made ^= made >> np.uint64(32)
    made *= np.uint64(WEIGHTS[1 - half])
    return made ^ (made >> np.uint64(29))


def least_hashes(own: np.ndarray) -> np.ndarray:
    """The least hash of the runs of ANCHOR_WORDS words, for every window of PASSAGE_WORDS words, from the words' first hashes."""
    at = np.arange(len(own) - ANCHOR_WORDS + 1)
    least = weighed(own, at, at + ANCHOR_WORDS - 1, WEIGHTS[0], INVERSES[0])
    width, wanted = 1, PASSAGE_WORDS - ANCHOR_WORDS + 1
    while width < wanted:
        step = min(width, wanted - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return least


def anchors(text: bytes, bounds: tuple[np.ndarray, np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least hashes of the documents' windows, given the words' bounds and documents: none twice in a row. And the documents."""
    if len(doc) < PASSAGE_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = least_hashes(hashed_words(text, *bounds, 0))
    inside = doc[: len(least)] == doc[PASSAGE_WORDS - 1 :]
    least, own = least[inside], doc[: len(least)][inside]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (own[1:] != own[:-1])
    return least[new], own[new]


def arrays_of_windows(
    text: bytes, bounds: tuple[np.ndarray, np.ndarray], doc: np.ndarray, wanted: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, second hash, first and last word of every window whose least hash is ``wanted``."""
    if len(doc) < PASSAGE_WORDS:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    own = np.stack([hashed_words(text, *bounds, half) for half in range(2)], axis=1)
    first = np.flatnonzero((doc[: 1 - PASSAGE_WORDS] == doc[PASSAGE_WORDS - 1 :]) & np.isin(least_hashes(own[:, 0]), wanted))
    last = first + PASSAGE_WORDS - 1
    return *halves(own, first, last), first, last


def hashed_runs(text: bytes | None) -> list[tuple[int, int, int, int]]:
    """(hash, second hash, first sentence, last sentence) of every run."""
    if not text:
        return []
    pieces, _ = measured(text)
    return list(zip(*(side.tolist() for side in arrays_of_runs(text, pieces, np.zeros(len(pieces[0]), np.int64))), strict=True))


WINDOWS_DDL = "array<struct<first_key: bigint, firsts: array<int>>>"
SPAN_DDL = "key long, twin long, h1 long, h2 long, first int, last int"
SPAN_SCHEMA = pa.schema(
    [("key", pa.int64()), ("twin", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]
)


def _batches(found: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Arrays of places, given with the keys and twins of some documents and the document of every place, in larger batches."""
    held, rows = [], 0

    def together():
        sides = [np.concatenate(side) for side in zip(*(sides for _, sides in held), strict=True)]
        kinds = (np.int64, np.int64, np.int64, np.int32, np.int32)
        columns = [pa.array(side.astype(kind)) for side, kind in zip(sides, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([pa.concat_arrays([key for key, _ in held]), *columns], schema=SPAN_SCHEMA)

    for keys, twins, doc, sides in found:
        if n := len(doc):
            held.append((pa.array(keys, pa.int64()).take(pa.array(doc)), (np.array(twins, np.int64)[doc], *sides)))
            rows += n
            if rows >= HELD_RUNS:
                yield together()
                held, rows = [], 0
    if held:
        yield together()


def _some(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    """Rows of (text, more), as many at a time as are worked on together; a text that needs no blanks comes alone."""
    held, size = [], 0
    for row in rows:
        if without_blanks(row[0]):
            yield [row]
            continue
        held.append(row)
        size += len(row[0])
        if size >= HELD_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _joined_texts(rows: list[tuple]) -> tuple[bytes, tuple, tuple, np.ndarray, np.ndarray]:
    """The texts of some rows, a line end between them: the whole, its pieces, its words' bounds, the documents of both.

    A line end ends a sentence and a word, so the pieces and words are those of every text for itself.
    """
    text = b"\n".join(row[0] for row in rows)
    pieces, bounds = measured(text)
    begins = np.cumsum([0, *(len(row[0]) + 1 for row in rows[:-1])])
    return text, pieces, bounds, *(np.searchsorted(begins, side[0], side="right") - 1 for side in (pieces, bounds))


def _in_document(number: np.ndarray, doc: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Numbers of sentences or words, counted from their document's first one, given the document of each and of all."""
    return number - np.searchsorted(docs, doc)


def _spans(batches):
    """Of (key, text) the runs of every document, and its windows' least hashes, whose first and last are -1."""

    def texts():
        for batch in batches:
            for key, text in zip(*batch.columns, strict=True):
                if text := text.as_py():
                    yield text, key.as_py(), signed(xxhash.xxh64_intdigest(text, TEXT_SEED))

    def places():
        for rows in _some(texts()):
            _, keys, twins = zip(*rows, strict=True)
            text, pieces, bounds, docs, word_docs = _joined_texts(rows)
            h1, h2, first, last = arrays_of_runs(text, pieces, docs)
            doc = docs[first]
            yield keys, twins, doc, (h1, h2, _in_document(first, doc, docs), _in_document(last, doc, docs))
            least, doc = anchors(text, bounds, word_docs)
            none = np.full(len(least), -1)
            yield keys, twins, doc, (least, np.zeros(len(least), np.int64), none, none)

    return _batches(places())


def _windows(batches):
    """Of (key, twin, text, wanted) the windows whose least hash is wanted; first and last count words.

    A least hash that one document wants is wanted by all that have it, so documents worked on together may share their lists.
    """

    def texts():
        for batch in batches:
            for key, twin, text, wanted in zip(*batch.columns, strict=True):
                yield text.as_py(), key.as_py(), twin.as_py(), wanted.values.to_numpy()

    def places():
        for rows in _some(texts()):
            _, keys, twins, wanted = zip(*rows, strict=True)
            text, _, bounds, _, docs = _joined_texts(rows)
            h1, h2, first, last = arrays_of_windows(text, bounds, docs, np.concatenate(wanted))
            doc = docs[first]
            yield keys, twins, doc, (h1, h2, _in_document(first, doc, docs), _in_document(last, doc, docs))

    return _batches(places())


def _whole(docs: DataFrame, key: str, text: str, *more) -> DataFrame:
    """key, text and twin of all documents."""
    rows = docs.select(*more, F.col(f"`{key}`").cast("long").alias("key"), utf8(text).alias("text"))
    return rows.withColumn("twin", F.xxhash64(F.col("text").cast("string")))  # the same hash and seed as TEXT_SEED


def _later(copies: DataFrame, path: str, within: bool) -> DataFrame:
    """All places but the first of every hash in ``copies``, a written table, each with ``start``, the first."""
    place = F.struct(F.col("key").isNull().alias("last_key"), "key", "twin", *(["first"] if within else []))
    # Both sides of the join are written tables: a passage that very many places share can then be split.
    start = copies.groupBy("h1", "h2").agg(F.min(place).alias("start"), F.max(place).alias("end")).where("start < end").drop("end")
    start = materialize_at(start, path)
    same = F.col("key").eqNullSafe(F.col("start.key")) & (F.col("twin") == F.col("start.twin"))
    return copies.join(start, ["h1", "h2"]).where(~(same & (F.col("first") == F.col("start.first")) if within else same))


def repeated(docs: DataFrame, key: str, text: str, within: bool = False) -> DataFrame:
    """key, twin (hash of the text), spans: array of (first, last, first_key), sorted, and windows: array of
    (first_key, firsts): the sentences that go in each document, and the first words of the windows that do.
    """
    spark = docs.sparkSession
    paths = {name: scratch_path(spark, name) for name in ("spans", "often", "copies", "starts", "wanted", "windows", "window_starts")}
    spans = materialize_at(docs.select(F.col(f"`{key}`").cast("long"), utf8(text)).mapInArrow(_spans, SPAN_DDL), paths["spans"])
    # One word of the hash is enough to leave out what stands in one document; the whole hash decides below.
    by_hash = spans.groupBy("h1")
    if within:
        often = by_hash.agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    else:
        doc = F.when(F.col("first") < 0, F.col("twin")).otherwise(F.xxhash64("key", "twin"))
        often = by_hash.agg(F.min(doc).alias("least"), F.max(doc).alias("greatest")).where("least < greatest")
    often = materialize_at(often.select("h1"), paths["often"])
    copies = materialize_at(spans.join(often, "h1", "left_semi"), paths["copies"])
    discard(spark, paths["spans"])
    discard(spark, paths["often"])
    owner = F.min(F.struct(F.col("key").isNull().alias("last_key"), "key"))
    wanted = copies.where("first < 0").groupBy(F.col("twin").alias("own_twin")).agg(owner.alias("owner"), F.collect_set("h1").alias("wanted"))
    wanted = materialize_at(wanted, paths["wanted"])
    texts = _whole(docs, key, text).join(wanted, F.col("key").eqNullSafe(F.col("owner.key")) & (F.col("twin") == F.col("own_twin")))
    windows = materialize_at(texts.select("key", "twin", "text", "wanted").mapInArrow(_windows, SPAN_DDL), paths["windows"])
    first_key = F.col("start.key").alias("first_key")
    # Rows equal in key and text say the same: each of their places counts once.
    runs = _later(copies.where("first >= 0"), paths["starts"], within).groupBy("key", "twin")
    runs = runs.agg(F.array_sort(F.collect_set(F.struct("first", "last", first_key))).alias("spans"), F.lit(None).cast(WINDOWS_DDL).alias("windows"))
    passages = _later(windows, paths["window_starts"], False).groupBy("key", "twin", first_key).agg(F.collect_set("first").alias("firsts"))
    passages = passages.groupBy("key", "twin").agg(F.collect_list(F.struct("first_key", "firsts")).alias("windows"))
    both = runs.unionByName(passages.withColumn("spans", F.lit(None).cast(runs.schema["spans"].dataType))).groupBy("key", "twin")
    return both.agg(F.first("spans", ignorenulls=True).alias("spans"), F.first("windows", ignorenulls=True).alias("windows"))


def covered_words(windows: list[dict], upto: np.ndarray) -> np.ndarray:
    """Which words go with windows; sentence i holds words ``upto[i]`` to ``upto[i + 1]``. Short ends of passages stay."""
    edges = np.zeros(upto[-1] + 1, np.int64)
    firsts = np.array([first for window in windows for first in window["firsts"]], np.int64)
    np.add.at(edges, firsts, 1)
    np.add.at(edges, firsts + PASSAGE_WORDS, -1)
    covered = np.cumsum(edges) > 0
    bounds = np.flatnonzero(np.diff(covered, prepend=False))
    for start, stop in zip(bounds[::2].tolist(), bounds[1::2].tolist(), strict=True):
        inner = upto[np.searchsorted(upto, start)], upto[np.searchsorted(upto, stop, side="right") - 1]
        if inner[1] - inner[0] >= MIN_WORDS:
            covered[start : inner[0]] &= inner[0] - start >= CUT_WORDS
            covered[inner[1] : stop] &= stop - inner[1] >= CUT_WORDS
    return covered[:-1]


def cut(text: bytes, spans: list[dict] | None, windows: list[dict] | None) -> tuple[bytes, list[int]]:
    """The text without the covered sentences and words and the blanks that followed them, and which sentences went, whole or in part."""
    (begins, _, words), bounds = measured(text)
    begins = begins.tolist()
    gone = {i for span in spans or [] for i in range(span["first"], span["last"] + 1)}
    parts, units = set(), [(start, i in gone) for i, start in enumerate(begins)]  # where sentences begin, and whether they go
    if windows and len(gone) < len(begins):
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(words)])
        covered = covered_words(windows, upto)
        some = np.add.reduceat(covered.astype(np.int64), upto[:-1]).tolist()
        starts, edges, covered = bounds[0].tolist(), upto.tolist(), covered.tolist()
        units = []  # the words of those that go in part count one by one
        for i, (start, n) in enumerate(zip(begins, words.tolist(), strict=True)):
            if some[i] == n:
                gone.add(i)
            if i in gone or not some[i]:
                units.append((start, i in gone))
            else:
                parts.add(i)
                units += zip(starts[edges[i] : edges[i + 1]], covered[edges[i] : edges[i + 1]], strict=True)
    kept, at = [], 0
    for (start, goes), (after, _) in zip(units, [*units[1:], (len(text), False)], strict=True):
        if goes:
            kept.append(text[at:start])
            at = after
    left = b"".join([*kept, text[at:]])
    return left.rstrip() if units and units[-1][1] else left, sorted(gone | parts)


def _joined(docs: DataFrame, key: str, text: str, how: str, within: bool) -> DataFrame:
    found = materialize(repeated(docs, key, text, within).select(F.col("key").alias("own_key"), F.col("twin").alias("own_twin"), "spans", "windows"), "repeats")
    whole = _whole(docs, key, text, packed(docs))
    return whole.join(found, F.col("key").eqNullSafe(F.col("own_key")) & (F.col("twin") == F.col("own_twin")), how).drop("own_key", "own_twin")


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", within: bool = True) -> DataFrame:
    """One row per document that loses sentences: key, first_keys (documents whose passages it repeats),
    removed_sentences (places of those that go, whole or in part), n_removed, text (what is left).

    Without ``within`` a passage counts as repeated only if several documents hold it: the first document keeps all its places.
    Documents that keep every sentence have no row. Null and empty texts have no sentence. Rows equal in key
    and text are one document with several rows: none of them is a copy of another, each gets the same row.
    """
    schema = pa.schema(
        [("key", pa.int64()), ("first_keys", pa.list_(pa.int64())), ("removed_sentences", pa.list_(pa.int32())), ("n_removed", pa.int32()), ("text", pa.string())]
    )
    ddl = "key long, first_keys array<long>, removed_sentences array<int>, n_removed int, text string"

    def each(key, text, spans, windows):
        left, gone = cut(text, spans, windows)
        firsts = sorted({s["first_key"] for s in [*(spans or []), *(windows or [])]} - {None})
        return [(key, firsts, gone, len(gone), left.decode("utf-8", "replace"))]

    rows = _joined(docs, key, text, "inner", within).select("key", "text", "spans", "windows")
    return map_rows(rows, schema, ddl, each).withColumnRenamed("key", key)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", within: bool = True) -> DataFrame:
    """All rows of ``docs``, the texts without repeated passages; other columns stay as they are."""

    def run(batches):
        for batch in batches:
            made = [
                (cut(value, spans, windows)[0] if value is not None and (spans or windows) else value,)
                for value, spans, windows in zip(*(batch.column(i).to_pylist() for i in range(1, 4)), strict=True)
            ]
            left = as_batch(made, pa.schema([("left", pa.binary())])).column(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), left], names=["row", "left"])

    joined = _joined(docs, key, text, "left", within).select("row", "text", "spans", "windows")
    kind = joined.schema["row"].dataType.simpleString()
    made = joined.mapInArrow(run, f"row {kind}, left binary")
    return unpacked(made.withColumn("row", F.col("row").withField(text, F.col("left").cast("string"))), docs.columns)
