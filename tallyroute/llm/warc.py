"""WARC archives: writing with segmented records, and reading back with reassembly.

A page becomes a record whose block is an HTTP response with a chunked body. Blocks above a size are cut
into a first segment and ``continuation`` records. Reading groups continuations by the identifier of
their origin, orders them by segment number, checks that none is missing and that their total length
is the stated one, and only then decodes the chunk framing. Records that fail a check are reported with
what is wrong, never dropped. Records of one piece take no part in the grouping and are not shuffled.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroute.llm.rows import map_rows, utf8
from tallyroute.session import materialize, scratch_path

CRLF = "\r\n"
VERSION = "WARC/1.1"
WRITTEN = "1970-01-01T00:00:00Z"  # pages come without the time of their capture, and equal input makes equal archives
SEGMENT_BYTES = 3_072  # longest block of one record; about a third of web pages have longer ones
FILE_RECORDS = 2_000  # records in one file, so no file holds over FILE_RECORDS * (SEGMENT_BYTES + headers)
CHUNK_BYTES = 8_192
REVISIT_BYTES = 100  # shorter payloads are always stored

RECORD_DDL = (
    "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, "
    "segment int, origin string, total_length long, block binary, fault string"
)
RECORD_SCHEMA = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("target_uri", pa.string()),
        ("refers_to", pa.string()),
        ("payload_digest", pa.string()),
        ("segment", pa.int32()),
        ("origin", pa.string()),
        ("total_length", pa.int64()),
        ("block", pa.binary()),
        ("fault", pa.string()),
    ]
)


def chunked(payload: bytes) -> bytes:
    """HTTP/1.1 chunked framing."""
    parts = []
    for at in range(0, len(payload), CHUNK_BYTES):
        piece = payload[at : at + CHUNK_BYTES]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are allowed, a cut body is an error."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size line is cut")
        size = int(body[at:end].split(b";", 1)[0].strip(), 16)
        if size < 0:
            raise ValueError("chunk size is negative")
        at = end + 2
        if not size:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut")
        parts.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The body of an HTTP response, freed of chunk framing if its headers say so."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no end of the HTTP headers")
    fields = [line.split(b":", 1) for line in head.split(b"\r\n")[1:] if b":" in line]
    coding = [value.strip().lower() for name, value in fields if name.strip().lower() == b"transfer-encoding"]
    return unchunked(body) if b"chunked" in b",".join(coding).split(b",") else body


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record up to the last CRLF of its two closing ones, which the text writer adds."""
    head = CRLF.join([VERSION, *(f"{name}: {value}" for name, value in fields), f"Content-Length: {len(block)}", "", ""])
    return head.encode() + block + b"\r\n"


def _line(value: str | None) -> str:
    """A header value can't hold line breaks."""
    return re.sub(r"[\r\n\t ]+", " ", value or "").strip()


def records_of(record_id: str, uri: str | None, payload: bytes, digest: str, refers_to: str | None, segment_bytes: int) -> Iterator[bytes]:
    """The records of one page: a revisit, a whole response, or a first segment and its continuations."""
    named = [("WARC-Record-ID", f"<{record_id}>"), ("WARC-Target-URI", _line(uri)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Date", WRITTEN)]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields = [("WARC-Type", "revisit"), *named, ("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", profile)]
        yield record(fields, http + b"\r\n")
        return
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    cuts = list(range(0, len(block), segment_bytes))
    first = [("WARC-Type", "response"), *named, ("Content-Type", "application/http; msgtype=response")]
    if len(cuts) == 1:
        yield record(first, block)
        return
    for number, at in enumerate(cuts, 1):
        if number == 1:
            fields = [*first, ("WARC-Segment-Number", "1")]
        else:
            fields = [
                ("WARC-Type", "continuation"),
                ("WARC-Record-ID", f"<{record_id}:segment:{number}>"),
                named[1],
                named[3],
                ("WARC-Segment-Origin-ID", f"<{record_id}>"),
                ("WARC-Segment-Number", str(number)),
            ]
            if number == len(cuts):
                fields.append(("WARC-Segment-Total-Length", str(len(block))))
        yield record(fields, block[at : at + segment_bytes])


def page_name(key: Column) -> Column:
    """What a reference calls a page. A record's identifier is this name and a number that tells repeated keys apart."""
    return F.concat(F.lit("urn:page:"), F.coalesce(key.cast("string"), F.lit("")))


def page_of(name: Column) -> Column:
    """The key in a page's name or in a record's identifier, as text; null for a null key."""
    key = F.regexp_extract(name, r"(?s)^urn:page:(.*?)(?::\d+)?$", 1)
    return F.when(key != "", key)


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", segment_bytes: int = SEGMENT_BYTES) -> None:
    """Archives of all rows at ``path``, gzip-compressed, each file of at most FILE_RECORDS records.

    Null and empty html are empty payloads. Of rows with equal payloads of at least REVISIT_BYTES the
    one with the smallest key is the response and others are revisits of it; null keys count last, and
    rows that repeat the smallest key are all responses. Only digests that occur under several keys are
    joined with the rows; that table is written first, so its size decides how.
    """
    payload = F.coalesce(utf8(html), F.lit(b""))
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    shared = (
        rows.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("key").alias("first_key"), F.max("key").alias("last_key"), F.max(F.col("key").isNull()).alias("nameless"))
        .where("first_key < last_key or (nameless and first_key is not null)")
        .select("digest", "first_key")
    )
    decided = rows.join(materialize(shared, "shared"), "digest", "left")
    refers = F.when(F.col("first_key").isNotNull() & ~F.col("key").eqNullSafe(F.col("first_key")), page_name(F.col("first_key")))
    ready = decided.select(F.concat_ws(":", page_name(F.col("key")), F.monotonically_increasing_id()).alias("id"), "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), "digest", refers.alias("refers"))

    def each(record_id, uri, payload, digest, refers):
        for value in records_of(record_id, uri, payload or b"", digest, refers, segment_bytes):
            yield (value,)

    made = map_rows(ready, pa.schema([("record", pa.binary())]), "record binary", each)
    writer = made.select(F.col("record").cast("string").alias("value")).write
    writer.option("lineSep", CRLF).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def _plain(content: bytes) -> Iterator[bytes]:
    """The content in pieces, decompressed if it is gzip (one member or one per record)."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    while content[:2] == b"\x1f\x8b":
        stream = zlib.decompressobj(wbits=31)
        while not stream.eof:
            piece = stream.decompress(content, 1 << 20)
            content = stream.unconsumed_tail
            yield piece
            if not piece and not content and not stream.eof:
                raise ValueError("gzip member is cut")
        content = stream.unused_data


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by lower-case name, block) of every record of one archive file; ``type`` null marks a broken rest."""
    held, pieces = bytearray(), _plain(content)

    def more() -> bool:
        piece = next(pieces, None)
        if piece is not None:
            held.extend(piece)
        return piece is not None

    while True:
        while held[:2] == b"\r\n":
            del held[:2]
        end = held.find(b"\r\n\r\n")
        if end < 0:
            if more():
                continue
            if held.strip():
                raise ValueError("record header is cut")
            return
        lines = bytes(held[:end]).decode("utf-8", "replace").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record where one should start")
        fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
        length = int(fields["content-length"])
        while len(held) < end + 4 + length:
            if not more():
                raise ValueError("record block is cut")
        yield fields, bytes(held[end + 4 : end + 4 + length])
        del held[: end + 4 + length]


def _bare(name: str | None) -> str | None:
    return name.strip("<>") if name else None


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """RECORD_DDL: every record of the archives at ``path``; a broken file gives one row with its ``fault``."""

    def each(name, content):
        try:
            for fields, block in parse(content):
                yield (
                    _bare(fields.get("warc-record-id")),
                    fields.get("warc-type"),
                    fields.get("warc-target-uri"),
                    _bare(fields.get("warc-refers-to")),
                    (fields.get("warc-payload-digest") or "").removeprefix("sha256:") or None,
                    int(fields["warc-segment-number"]) if "warc-segment-number" in fields else None,
                    _bare(fields.get("warc-segment-origin-id")),
                    int(fields["warc-segment-total-length"]) if "warc-segment-total-length" in fields else None,
                    block,
                    None,
                )
        except (ValueError, KeyError, zlib.error) as problem:
            yield (*(None,) * 9, f"{name}: {problem}")

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where("length > 0")
    return map_rows(files.select("path", "content"), RECORD_SCHEMA, RECORD_DDL, each)


def reassembled(records: DataFrame) -> DataFrame:
    """One row per record that isn't a continuation, its segments joined: the columns of ``read_records``.

    A group is the segments of one record, which is as large as that record. ``fault`` says when a segment
    is missing or repeated, when the last one doesn't state a total length or when that length is wrong.
    """
    columns = records.columns
    whole = records.where("segment is null")
    parts = records.where("segment is not null").withColumn("origin", F.coalesce("origin", "record_id"))
    first = {c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in ("record_id", "record_type", "target_uri", "refers_to", "payload_digest")}
    joined = parts.groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"), F.max("total_length").alias("total_length"), *first.values()
    )
    numbers = F.transform("parts", lambda p: p.segment)
    size = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p.block))
    fault = (
        F.when(numbers != F.sequence(F.lit(1), F.size("parts")), F.lit("segments are missing or repeated"))
        .when(F.col("total_length").isNull(), F.lit("no total length"))
        .when(size != F.col("total_length"), F.lit("total length is wrong"))
    )

    def each(record_id, kind, uri, refers, digest, origin, total, blocks, fault):
        yield record_id, kind, uri, refers, digest, None, origin, total, b"".join(blocks), fault

    blocks = F.transform("parts", lambda p: p.block).alias("blocks")
    picked = joined.select("record_id", "record_type", "target_uri", "refers_to", "payload_digest", "origin", "total_length", blocks, fault.alias("fault"))
    return whole.unionByName(map_rows(picked, RECORD_SCHEMA, RECORD_DDL, each).select(*columns))


def payloads(records: DataFrame) -> DataFrame:
    """record_id, record_type, target_uri, refers_to, payload, payload_bytes, payload_digest, fault of whole records.

    The digest is recomputed from the decoded payload and must equal the stated one. A revisit has no
    payload of its own: length and digest are those of the response it refers to, null with a fault if there is none.
    """
    schema = pa.schema(
        [
            ("record_id", pa.string()),
            ("record_type", pa.string()),
            ("target_uri", pa.string()),
            ("refers_to", pa.string()),
            ("payload", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("fault", pa.string()),
        ]
    )
    ddl = "record_id string, record_type string, target_uri string, refers_to string, payload binary, payload_bytes long, payload_digest string, fault string"

    def each(record_id, kind, uri, refers, stated, block, fault):
        payload = found = None
        if fault is None and kind == "response":
            try:
                payload = http_payload(block)
                found = hashlib.sha256(payload).hexdigest()
                fault = None if stated in (None, found) else "payload digest is wrong"
            except ValueError as problem:
                fault = str(problem)
        if kind == "revisit":
            found = stated
        yield record_id, kind, uri, refers, payload, None if payload is None else len(payload), found, fault

    picked = records.select("record_id", "record_type", "target_uri", "refers_to", "payload_digest", "block", "fault")
    return map_rows(picked, schema, ddl, each)


def catalogue(decoded: DataFrame) -> DataFrame:
    """``payloads`` without the payload, revisits completed from the responses they refer to."""
    rows = materialize(decoded.drop("payload"), "catalogue").select(
        "record_id", "record_type", "target_uri", "refers_to", "payload_bytes", "payload_digest", "fault"
    )
    name = page_name(page_of(F.col("record_id"))).alias("refers_to")
    # Written, so that its join with a response that very many records revisit can be split.
    stored = materialize(
        rows.where("record_type = 'response' and fault is null").groupBy(name, "payload_digest").agg(F.max("payload_bytes").alias("stored_bytes")), "stored"
    )
    missing = F.when(F.col("stored_bytes").isNull(), F.lit("no such response"))
    # Only revisits take part in the join: a null reference would gather all other records in one task.
    revisits = rows.where("record_type = 'revisit'").join(stored, ["refers_to", "payload_digest"], "left").select(
        "record_id", "record_type", "target_uri", "refers_to", F.col("stored_bytes").alias("payload_bytes"), "payload_digest",
        F.coalesce("fault", missing).alias("fault"),
    )
    return rows.where("not record_type <=> 'revisit'").unionByName(revisits)


def archived(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write archives of ``pages`` to the shared folder and give what reading them back finds, one row per row."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, key, url, html, segment_bytes)
    return catalogue(payloads(reassembled(read_records(pages.sparkSession, path))))
