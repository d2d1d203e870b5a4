"""The dealt operators applied to the given tables, beside SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroute.llm import conversations, decontaminate, htmltext, langid, licenses, mixing, packing, quality, signatures, simhash, spans, spelling, urlfilter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SOURCE_WEIGHTS = [1, 2, 3]
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
END_OF_TEXT = 50_256
URL_RULES = [
    urlfilter.Rule("block", "net", "/"),
    urlfilter.Rule("allow", "example.net", "/en/"),
    urlfilter.Rule("block", "example.com", "/de/"),
    urlfilter.Rule("allow", "org", "/fr/"),
]
#: Domains that the URL filter lists. Any list will do; this one stands for a published feed.
LISTED_HOSTS = ["adult-x.example.net", "ads-track.example.org", "casino-win.example.org", "cheap-pills.example.com", "free-bets.example.com", "spam-farm.example.org"]


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mixing_weights(names: list) -> dict:
    return mixing.repeating(SOURCE_WEIGHTS)(names)


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')) AS place,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
  FROM sized GROUP BY source
), filling AS (
  SELECT *, row_number() OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST) AS n,
    sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    sum(weight) OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM sources
), opening AS (
  SELECT min(n) AS n FROM filling WHERE NOT remaining * weight > 3 * source_size * weights
), goals AS (
  SELECT f.source, f.source_size,
    CASE WHEN o.n IS NULL OR f.n < o.n THEN CAST(3 * f.source_size AS DOUBLE)
         ELSE CAST(g.remaining * f.weight AS DOUBLE) / CAST(g.weights AS DOUBLE) END AS target
  FROM filling f CROSS JOIN opening o LEFT JOIN filling g ON g.n = o.n
), placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, CAST(floor(g.target) AS BIGINT) AS quota,
    CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size = 0 THEN 0
       ELSE CAST(quota // source_size * size + greatest(0, least(size, quota % source_size - before)) AS BIGINT) END AS taken
FROM placed
"""


@query("op1_mix_sources", MIX_SQL)
def op1_mix_sources(spark, sf_dir):
    """The mix of all documents by source: what each source should give, and what each document gives."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows, plan = mixing.mix(docs, F.array("source"), mixing_weights)
    goals = [(s, size, plan.targets[s]) for s, size in plan.sizes.items()]
    known = F.broadcast(spark.createDataFrame(goals, "name string, source_size long, target double"))  # one row per source
    words = F.aggregate("takes", F.lit(0).cast("long"), lambda total, take: total + take.words)
    return rows.join(known, F.col("row.source").eqNullSafe(F.col("name"))).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", words.alias("taken")
    )


WARC_SQL = """
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest,
         CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS bytes
  FROM pages
), firsts AS (
  SELECT *, CASE WHEN bytes >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first_id FROM rows
)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM firsts
"""


@query("op2_warc_segments", WARC_SQL)
def op2_warc_segments(spark, sf_dir):
    """All pages written as WARC archives and read back: what the archives hold of each."""
    found = warc.archived(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    checked = F.when(F.col("fault").isNull(), F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("WARC: "), "fault")))
    return found.select(
        warc.page_of(F.col("record_id")).cast("long").alias("page_id"), "payload_bytes", checked.alias("payload_digest"), "record_type",
        warc.page_of(F.col("refers_to")).cast("long").alias("refers_to"),
    )


@query("op3_decontaminate")
def op3_decontaminate(spark, sf_dir):
    """Every benchmark item that a document holds, with the window that holds it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


QUALITY_SQL = r"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS n, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT n, i, array_to_string(words[i:i + 4], ' ') AS w FROM (SELECT n, words, unnest(range(1, len(words) - 3)) AS i FROM split WHERE len(words) > 4)
), twice AS (
  SELECT n, i, count(*) OVER (PARTITION BY n, w) AS times FROM windows
), covered AS (
  SELECT n, count(DISTINCT i + j) AS n_repeat_words FROM twice CROSS JOIN range(5) AS r(j) WHERE times > 1 GROUP BY n
), measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN covered USING (n)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > 3 * n_words OR 10 * n_dup_lines > 3 * n_lines
       OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM measured
"""


@query("op4_quality_ledger", QUALITY_SQL)
def op4_quality_ledger(spark, sf_dir):
    """The rule ledger of all documents, judged by the base rules and the production policy."""
    book = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes(quality.BASE)).alias("base_failed"),
        (quality.passes(quality.BASE) & quality.passes(quality.PRODUCTION)).alias("kept"),
    )


def packed_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = packing.LENGTH) -> DataFrame:
    return packing.pack(docs, lambda: packing.rank_file_encoder(tokenizer), END_OF_TEXT, length)


@query("op5_pack_tokens")
def op5_pack_tokens(spark, sf_dir):
    """All documents as packed rows of token ids."""
    return packed_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_repeated_spans")
def op6_repeated_spans(spark, sf_dir):
    """Documents that repeat a passage of an earlier document, and what is left of them."""
    return spans.repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), within=False)


@query("op7_simhash_components")
def op7_simhash_components(spark, sf_dir):
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


URL_SQL = """
WITH parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)
), ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches('.' || host, '\\.(adult-x\\.example\\.net|ads-track\\.example\\.org|casino-win\\.example\\.org|cheap-pills\\.example\\.com|free-bets\\.example\\.com|spam-farm\\.example\\.org)$') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""


@query("op8_url_cascade", URL_SQL)
def op8_url_cascade(spark, sf_dir):
    """Rules and listed hosts, applied to the URL of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, URL_RULES, urlfilter.names(spark, LISTED_HOSTS))


@query("op9_language")
def op9_language(spark, sf_dir):
    """The language of every document, learned from those that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs.drop("lang"), langid.learn(docs))


@query("op10_main_text")
def op10_main_text(spark, sf_dir):
    """The main text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


#: CRC-32 of a list of bytes, from the table of its 256 remainders; ``bytes`` and ``remainders`` are columns.
CRC_TABLE = """SELECT list(v ORDER BY i) AS remainders FROM (
    SELECT i, list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) AS t(i))"""
CRC = "xor(list_reduce(bytes, lambda c, b: xor(c >> 8, remainders[CAST(xor(c, b) & 255 AS INTEGER) + 1]), 4294967295), 4294967295)"

SPELLING_SQL = rf"""
WITH RECURSIVE table_of AS MATERIALIZED ({CRC_TABLE}),
runs AS (
  SELECT key, run, CAST(count(*) AS BIGINT) AS n FROM (
    SELECT doc_id AS key, unnest(list_transform(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS run FROM documents)
  GROUP BY key, run
), spelt AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(key AS VARCHAR), '') || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) AS BIGINT) - 64] END)) AS bytes FROM runs
), hashed AS (
  SELECT run, n, {CRC} AS h FROM spelt, table_of
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), shorter AS MATERIALIZED (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS most FROM near GROUP BY word
), forms AS MATERIALIZED (
  SELECT w.word, w.n, CAST(coalesce(b.n_near, 0) AS BIGINT) AS n_near,
    CASE WHEN most >= 2 * w.n THEN (SELECT min(other) FROM near x WHERE x.word = w.word AND x.other_n = most) END AS form,
    CASE WHEN most >= 2 * w.n THEN CAST(most AS BIGINT) END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), ways AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT w.word, f.form FROM ways w JOIN forms f ON f.word = w.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN ways w ON w.word = f.word JOIN forms e ON e.word = w.at WHERE e.form IS NULL
"""


@query("op11_spelling_variants", SPELLING_SQL)
def op11_spelling_variants(spark, sf_dir):
    """Every word of all documents, and the commoner spelling that it stands for."""
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


TRIE_SQL = f"""
WITH table_of AS MATERIALIZED ({CRC_TABLE}),
own AS MATERIALIZED (
  SELECT conv_id, list(struct_pack(t := turn_key, b := bytes) ORDER BY turn NULLS FIRST, turn_key) AS turns FROM (
    SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS bytes,
      substr(md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 30) AS turn_key
    FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id
), skips AS (
  SELECT conv_id, turns, {CRC} % 9 AS h FROM (
    SELECT *, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(unicode(c) AS BIGINT)) AS bytes FROM own), table_of
), rebuilt AS MATERIALIZED (
  SELECT s.conv_id, list_concat(coalesce(o.turns, [])[1:s.h], s.turns[s.h + 1:]) AS turns
  FROM skips s LEFT JOIN own o ON o.conv_id = s.conv_id - s.conv_id % 5
), prefixes AS MATERIALIZED (
  SELECT conv_id, d AS depth, array_to_string(list_transform(turns[1:d], lambda x: x.t), '') AS node,
    array_to_string(list_transform(turns[1:d - 1], lambda x: x.t), '') AS up, CASE WHEN d = 0 THEN 0 ELSE turns[d].b END AS bytes, d = len(turns) AS ends
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS MATERIALIZED (
  SELECT node, depth, min(up) AS up, min(conv_id) AS conv_id, CAST(count(*) AS BIGINT) AS n_convs, min(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node, depth
), counted AS MATERIALIZED (
  SELECT n.*, p.conv_id AS parent_conv_id, coalesce(c.n, 0) AS n_children
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.up
  LEFT JOIN (SELECT up, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up, depth) c ON c.up = n.node AND c.depth = n.depth
), totals AS (
  SELECT p.node, p.depth, CAST(sum(CASE WHEN c.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum((c.n_convs - 1) * c.bytes) AS BIGINT) AS saved_tokens
  FROM counted c JOIN prefixes p ON p.conv_id = c.conv_id AND p.depth <= c.depth GROUP BY p.node, p.depth
)
SELECT conv_id, CAST(c.depth AS BIGINT) AS depth, parent_conv_id, n_convs, CAST(n_children AS BIGINT) AS n_children, n_leaves, saved_tokens, ends_sha256
FROM counted c JOIN totals t ON t.node = c.node AND t.depth = c.depth
"""


@query("op12_conversation_trie", TRIE_SQL)
def op12_conversation_trie(spark, sf_dir):
    """Every node of the prefix trie of the rebuilt conversations."""
    return conversations.trie(table(spark, sf_dir, "conversations"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _rule_rows() -> str:
    listed = enumerate(signatures.rules())
    return ", ".join(f"({i}, {_quoted(r.label)}, {r.priority}, {_quoted(r.keyword)}, {_quoted(licenses.over_words(r.pattern))})" for i, r in listed)


LICENSE_SQL = rf"""
WITH rules(place, label, priority, keyword, pattern) AS (VALUES {_rule_rows()}),
scores(priority, score) AS (VALUES {", ".join(f"({p}, CAST({s} AS DOUBLE))" for p, s in licenses.SCORES.items())}),
split AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), formed AS (
  SELECT row, words, array_to_string(list_transform(words, lambda w, i: ' ' || w || chr(1) || (i - 1) || ' '), '') AS form FROM split
), matched AS (
  SELECT row, place, label, priority, unnest(regexp_extract_all(form, pattern)) AS m FROM formed JOIN rules ON list_contains(words, keyword)
), detections AS MATERIALIZED (
  SELECT *, CAST(regexp_extract(m, chr(1) || '([0-9]+)', 1) AS INTEGER) AS first, CAST(regexp_extract(m, chr(1) || '([0-9]+) $', 1) AS INTEGER) AS last FROM matched
), kept AS (
  SELECT * FROM detections d WHERE NOT EXISTS (
    SELECT 1 FROM detections e WHERE e.row = d.row
      AND ((e.first >= d.first AND e.last <= d.last) OR (e.first <= d.first AND e.last >= d.last))
      AND (e.priority < d.priority OR (e.priority = d.priority AND (e.last - e.first > d.last - d.first OR (e.last - e.first = d.last - d.first AND e.place < d.place)))))
), spots AS (
  SELECT row, i - 1 AS spot, CASE WHEN words[i] = 'cc' AND words[i + 1] = 'by' THEN 'cc-by'
      WHEN words[i] = 'general' AND words[i + 1] = 'public' AND words[i + 2] = 'license' THEN 'gpl'
      WHEN words[i] = 'all' AND words[i + 1] = 'rights' AND words[i + 2] = 'reserved' THEN 'reserved' END AS label
  FROM (SELECT row, words, unnest(range(1, len(words) + 1)) AS i FROM split)
), base AS (
  SELECT row, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, list_sort(list_distinct(list(label))) AS own FROM spots WHERE label IS NOT NULL GROUP BY row
), method AS (
  SELECT row, list(DISTINCT label) AS found, max(score) AS score FROM kept JOIN scores USING (priority) GROUP BY row
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  array_to_string(coalesce(own, []), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(found, [])))), ',') AS labels,
  greatest(coalesce(method.score, 0), CASE WHEN n_base > 0 THEN CAST({licenses.BASE_SCORE} AS DOUBLE) ELSE 0 END) AS score
FROM split LEFT JOIN base USING (row) LEFT JOIN method USING (row)
"""


@query("op13_license_scan", LICENSE_SQL)
def op13_license_scan(spark, sf_dir):
    """Licenses and license phrases that every document names."""
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
