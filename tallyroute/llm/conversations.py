"""The prefix trie of rebuilt conversations, and totals over its subtrees.

Turns are numbered, and the hash of every prefix of a conversation is made, by one scan of the sorted turns: each
task works from the start of what it holds, and one row a task carries count and hash on to the next. The hash is
a polynomial, so the prefixes of a conversation whose first turns are another's follow from the two conversations'
own ones. A node is the hash of a prefix and its depth.

Totals over subtrees are summed in bands of BAND depths. Every node adds itself to those of its ancestors that lie in
its band. The totals of the bands' topmost nodes, a tree that is BAND times less deep, are completed in the same
way, and are then added once to the ancestors in the band above. So no node is exploded to more than BAND others a
time, and the number of rounds is the logarithm of the depth.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.llm.rows import as_batch
from tallyroute.session import materialize

GRAFTED = 5  # conversations that share the first turns of the one whose id they are rounded down to
MOST_SHARED = 8
BAND = 32
PRIME = (1 << 61) - 1
BASES = (0x0F1E2D3C4B5A6978, 0x13579BDF02468ACE)
INVERSES = tuple(pow(b, -1, PRIME) for b in BASES)
CHUNK = 65_536  # characters of a node's list of ends that are joined at once
NODE = ["depth", "r1", "r2"]
SCAN_DDL = "conv_id long, part int, i long, p1 long, p2 long, t1 long, t2 long, bytes long"
SCAN_SCHEMA = pa.schema([(n, pa.int32() if n == "part" else pa.int64()) for n in ("conv_id", "part", "i", "p1", "p2", "t1", "t2", "bytes")])


def turns_of(conversations: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, turn, t1 and t2 (120 bits of the MD5 of role and text), bytes of the text; rows without an id go."""
    role, text = (F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in (role, text))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    return conversations.where(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), half(1).alias("t1"), half(16).alias("t2"),
        F.octet_length(text).cast("long").alias("bytes"),
    )


def _scan(batches):
    """Place and prefix hash of every turn, from the first turn of its conversation that this task holds."""
    part, conv, i, p1, p2 = TaskContext.get().partitionId(), None, 0, 0, 0
    for batch in batches:
        rows = []
        for own, t1, t2, size in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
            if own != conv:
                conv, i, p1, p2 = own, 0, 0, 0
            p1, p2 = (p1 * BASES[0] + t1) % PRIME, (p2 * BASES[1] + t2) % PRIME
            rows.append((conv, part, i, p1, p2, t1, t2, size))
            i += 1
        if rows:
            yield as_batch(rows, SCAN_SCHEMA)


def carried(ends: list) -> dict[int, tuple[int, int, int, int]]:
    """Per part that begins inside a conversation: its id, and how many turns with which hashes went before.

    ``ends`` has one row a part, in order: part, the first conversation, and the last one with its last turn.
    """
    found, conv, n, p1, p2 = {}, None, 0, 0, 0
    for row in ends:
        last = row.last
        if row.first == conv:
            found[row.part] = (conv, n, p1, p2)
        else:
            n, p1, p2 = 0, 0, 0
        if last.conv_id != row.first:
            n, p1, p2 = 0, 0, 0
        more = last.i + 1
        p1, p2 = (p1 * pow(BASES[0], more, PRIME) + last.p1) % PRIME, (p2 * pow(BASES[1], more, PRIME) + last.p2) % PRIME
        conv, n = last.conv_id, n + more
    return found


def placed(turns: DataFrame) -> DataFrame:
    """conv_id, i (place from 0), p1 and p2 (hash of the turns up to this one), t1, t2, bytes."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "t1", "t2"]
    sorted_turns = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "t1", "t2", "bytes")
    scanned = materialize(sorted_turns.mapInArrow(_scan, SCAN_DDL), "scanned")
    last = F.max(F.struct("conv_id", "i", "p1", "p2")).alias("last")
    before = carried(scanned.groupBy("part").agg(F.min("conv_id").alias("first"), last).orderBy("part").collect())  # one row a task

    def shift(batches):
        for batch in batches:
            rows = []
            for conv, part, i, p1, p2, t1, t2, size in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                carry = before.get(part)
                if carry is not None and carry[0] == conv:
                    p1 = (carry[2] * pow(BASES[0], i + 1, PRIME) + p1) % PRIME
                    p2 = (carry[3] * pow(BASES[1], i + 1, PRIME) + p2) % PRIME
                    i += carry[1]
                rows.append((conv, part, i, p1, p2, t1, t2, size))
            if rows:
                yield as_batch(rows, SCAN_SCHEMA)

    return materialize(scanned.mapInArrow(shift, SCAN_DDL), "placed")


ROW_DDL = "conv_id long, depth long, r1 long, r2 long, up1 long, up2 long, bytes long"
ROW_SCHEMA = pa.schema([(n, pa.int64()) for n in ("conv_id", "depth", "r1", "r2", "up1", "up2", "bytes")])


def _regraft(batches):
    """Turns of a conversation behind its shared ones: hash of the rebuilt prefix, and of the one before."""
    for batch in batches:
        rows = []
        for conv, i, p1, p2, t1, t2, size, skip, graft, g1, g2, o1, o2 in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
            more = i + 1 - skip
            r1 = (p1 + (g1 - o1) * pow(BASES[0], more, PRIME)) % PRIME
            r2 = (p2 + (g2 - o2) * pow(BASES[1], more, PRIME)) % PRIME
            rows.append((conv, graft + more, r1, r2, (r1 - t1) * INVERSES[0] % PRIME, (r2 - t2) * INVERSES[1] % PRIME, size))
        if rows:
            yield as_batch(rows, ROW_SCHEMA)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every prefix of every rebuilt conversation (conv_id, depth, r1, r2, up1, up2, bytes), and conversations with their depth."""
    at = placed(turns)
    head = F.when(F.col("i") < MOST_SHARED, F.struct("i", "p1", "p2", "t1", "t2", "bytes"))
    heads = materialize(at.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(head)).alias("head")), "heads")
    base = heads.select(F.col("conv_id").alias("base"), F.col("head").alias("shared"))
    skip = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")
    of = heads.withColumn("skip", skip).withColumn("base", F.col("conv_id") - F.col("conv_id") % GRAFTED).join(base, "base", "left")
    end = lambda turns, n, p: F.when(n > 0, F.try_element_at(turns, n).getField(p)).otherwise(F.lit(0)).cast("long")
    of = of.withColumn("shared", F.coalesce(F.expr("slice(shared, 1, skip)"), F.expr("slice(head, 1, 0)")))
    of = of.withColumn("graft", F.size("shared")).withColumn("depth", F.col("graft") + F.greatest(F.lit(0), F.col("n") - F.col("skip")))
    shape = materialize(
        of.select(
            "conv_id", "depth", "n", "skip", "graft", "shared", end(F.col("shared"), F.col("graft"), "p1").alias("g1"), end(F.col("shared"), F.col("graft"), "p2").alias("g2"),
            F.coalesce(end(F.col("head"), F.col("skip"), "p1"), F.lit(0)).alias("o1"), F.coalesce(end(F.col("head"), F.col("skip"), "p2"), F.lit(0)).alias("o2"),
        ),
        "shape",
    )
    longer = shape.where("n > skip").select("conv_id", "skip", "graft", "g1", "g2", "o1", "o2")
    own = at.join(longer, "conv_id").where("i >= skip").select("conv_id", "i", "p1", "p2", "t1", "t2", "bytes", "skip", "graft", "g1", "g2", "o1", "o2")
    first = shape.select("conv_id", "shared", F.posexplode("shared").alias("k", "own"))
    before = lambda p: F.when(F.col("k") > 0, F.try_element_at("shared", F.col("k")).getField(p)).otherwise(F.lit(0))
    first = first.select(
        "conv_id", (F.col("k") + 1).cast("long").alias("depth"), F.col("own.p1").alias("r1"), F.col("own.p2").alias("r2"),
        before("p1").alias("up1"), before("p2").alias("up2"), "own.bytes",
    )
    zero = F.lit(0).cast("long")
    roots = shape.select("conv_id", *[zero.alias(n) for n in ("depth", "r1", "r2", "up1", "up2", "bytes")])
    return materialize(own.mapInArrow(_regraft, ROW_DDL).unionByName(first).unionByName(roots), "prefixes"), shape.select("conv_id", "depth")


def added(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*NODE).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def to_ancestors(nodes: DataFrame, paths: DataFrame, band: Column, which: Column) -> DataFrame:
    """The sums of ``nodes`` on the nodes of their path in ``band`` that ``which`` asks for (x is one of the path)."""
    met = nodes.withColumn("band", band).join(paths, ["conv_id", "band"])
    up = met.select(F.explode(F.filter("path", lambda x: x["depth"] <= which)).alias("x"), "n_leaves", "saved_tokens")
    return up.select(*[F.col(f"x.{name}") for name in NODE], "n_leaves", "saved_tokens")


def subtree_totals(nodes: DataFrame, prefixes: DataFrame, deepest: int, band: int = BAND, level: int = 0) -> DataFrame:
    """depth, r1, r2, n_leaves, saved_tokens summed over the subtree of each of ``nodes`` (which have them for themselves).

    ``nodes`` holds one conversation of each node, and all nodes whose depth is a multiple of band ** level.
    """
    step = band**level
    wide = step * band
    of_band = F.floor(F.col("depth") / wide)
    paths = prefixes.where(F.col("depth") % step == 0).groupBy("conv_id", of_band.alias("band"))
    paths = materialize(paths.agg(F.collect_list(F.struct(*NODE)).alias("path")), "paths")
    inside = added(to_ancestors(nodes, paths, of_band, F.col("depth")))
    if deepest < wide:
        return inside
    inside = materialize(inside, "inside")
    tops = nodes.where(F.col("depth") % wide == 0).select("conv_id", *NODE)
    tops = materialize(tops.join(inside, NODE), "tops")
    whole = subtree_totals(tops, prefixes, deepest, band, level + 1)
    whole = tops.select("conv_id", *NODE).join(whole, NODE).where("depth > 0")
    return added(inside.unionByName(to_ancestors(whole, paths, of_band - 1, F.col("depth"))))


def _listed(batches):
    """Ids of sorted (node, id) rows joined by commas, in chunks of one node."""
    schema = pa.schema([(n, pa.int64()) for n in (*NODE, "first")] + [("ids", pa.string())])
    node, held, size, rows = None, [], 0, []
    for batch in batches:
        for *own, conv in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
            if held and (own != node or size >= CHUNK):
                rows.append((*node, held[0], ",".join(map(str, held))))
                held, size = [], 0
                if len(rows) >= 64:
                    yield as_batch(rows, schema)
                    rows = []
            node = own
            held.append(conv)
            size += 8
    if held:
        rows.append((*node, held[0], ",".join(map(str, held))))
    if rows:
        yield as_batch(rows, schema)


def _digested(batches):
    """SHA-256 of the chunks of every node, which come sorted."""
    schema = pa.schema([(n, pa.int64()) for n in NODE] + [("ends_sha256", pa.string())])
    node, state, rows = None, None, []
    for batch in batches:
        for *own, ids in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
            if own == node:
                state.update(b",")
            else:
                if state is not None:
                    rows.append((*node, state.hexdigest()))
                node, state = own, hashlib.sha256()
            state.update(ids.encode())
        if len(rows) >= 4_096:
            yield as_batch(rows, schema)
            rows = []
    if state is not None:
        rows.append((*node, state.hexdigest()))
    if rows:
        yield as_batch(rows, schema)


def ends(prefixes: DataFrame, lengths: DataFrame) -> DataFrame:
    """depth, r1, r2, ends_sha256 of the nodes where a conversation ends; lists are joined in pieces, whatever their length."""
    last = prefixes.join(lengths, ["conv_id", "depth"]).select(*NODE, "conv_id")
    order = [*NODE, "conv_id"]
    listed = last.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_listed, "depth long, r1 long, r2 long, first long, ids string")
    chunks = materialize(listed, "ends")
    dealt = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first").select(*NODE, "ids")
    return dealt.mapInArrow(_digested, "depth long, r1 long, r2 long, ends_sha256 string")


def trie(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", band: int = BAND) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversation c begins with the first h turns of conversation c - c % 5 and goes on with its own after its
    first h, h being CRC-32 of the id in digits, modulo 9. Null role and text count as empty. Turns go by number, null first;
    equal numbers by the MD5 of role and text; repeated rows are turns of their own. Rows without an id belong to no
    conversation. An empty table has no node. Other columns are not read.
    """
    turns = materialize(turns_of(conversations, key, turn, role, text), "turns")
    prefixes, lengths = rebuilt(turns)
    same = [F.min(name).alias(name) for name in ("up1", "up2", "bytes")]
    nodes = materialize(prefixes.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *same), "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("r1"), F.col("up2").alias("r2"))
    known = nodes.join(children.agg(F.count(F.lit(1)).alias("n_children")), NODE, "left")
    known = materialize(known.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "known")
    alone = known.select(
        "conv_id", *NODE, (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens")
    )
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    totals = subtree_totals(alone, prefixes, deepest, band)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("r1").alias("up1"), F.col("r2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    found = known.join(parents, ["depth", "up1", "up2"], "left").join(totals, NODE).join(ends(prefixes, lengths), NODE, "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256")
    )
