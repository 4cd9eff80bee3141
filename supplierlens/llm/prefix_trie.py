"""The trie of conversations by their turns, from bitmaps of conversations per (position, turn)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supplierlens.llm.common import written

#: A shard has the conversations of one range of ids of this length, cut further where it has
#: over SHARD_ROWS turns. Bitmaps have one bit per conversation of a shard.
SHARD_IDS = 512
SHARD_ROWS = 1 << 18
_ROOT = bytes(16)

_FOUND = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()),
                    ("n_convs", pa.int64()), ("n_words", pa.int64()), ("inner", pa.bool_()), ("ends", pa.list_(pa.int64()))])
_FOUND_SQL = ("conv_id long, depth long, node binary, parent binary, n_convs long, n_words long, inner boolean, "
              "ends array<long>")


def keyed_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per turn: conv_id, pos (from 1), key (16 bytes that stand for role and text),
    n_words. Turns are ordered by turn, null first, then by key; null role or text is empty.
    Rows without a conversation's id belong to none and are left out. Texts go no further."""
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    named = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.unhex(F.substring(F.sha2(named, 256), 1, 32)).alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "key")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "key", "n_words")


def with_shared_openings(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations rebuilt on shared openings, as keyed turns with one row at pos 0 for each.

    Conversation c begins with the first h turns of conversation ``c - c % every`` (all if it
    has fewer, none if there is no such conversation) and goes on with its own turns after its
    first h; h is the crc32 of c's decimal digits modulo ``most``.
    """
    turns = written(turns, "keyed-turns")
    heads = turns.where(F.col("pos") < most).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "key", "n_words"))).alias("head"))
    convs = turns.select("conv_id").distinct().select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int").alias("h"))
    convs = written(convs.join(heads, "base", "left").select(
        "conv_id", "h", F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,key:binary,n_words:bigint>>")),
                                F.lit(1), F.col("h")).alias("head")), "openings")
    opened = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.key", "t.n_words")
    own = turns.join(convs.select("conv_id", "h", F.size("head").alias("n")), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("n")).alias("pos"), "key", "n_words")
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("key"),
                         F.lit(0).cast("long").alias("n_words"))
    return opened.unionByName(own).unionByName(roots)


def _nodes(ids: list[int], turns: list[list[bytes]], words: dict[tuple[int, bytes], int]) -> Iterator[tuple]:
    """Rows of _FOUND for one shard, whose conversations ascend by id.

    ``postings`` are the vertical bitmaps. A node's children come from its own bitmap: the
    lowest conversation not placed yet names the next turn, and one intersection with that
    turn's posting gives the child. Depth first, so ``trail`` holds the nodes above.
    """
    postings: dict[tuple[int, bytes], int] = {}
    ends: dict[int, int] = {}
    for i, sequence in enumerate(turns):
        bit = 1 << i
        for pos, key in enumerate(sequence):
            postings[pos, key] = postings.get((pos, key), 0) | bit
        ends[len(sequence)] = ends.get(len(sequence), 0) | bit
    trail: list[bytes] = []
    stack = [((1 << len(ids)) - 1, 0, _ROOT, None, 0, -1)]
    while stack:
        members, depth, node, parent, n_words, above = stack.pop()
        del trail[depth:]
        first = _lowest(members)
        if first != above:  # the smallest member changes here: it needs the path from the root
            for d, x in enumerate(trail):
                yield ids[first], d, x, None, None, None, None, None
        trail.append(node)
        ended = members & ends.get(depth, 0)
        rest = members ^ ended
        yield ids[first], depth, node, parent, members.bit_count(), n_words, rest != 0, _members(ended, ids)
        while rest:
            turn = (depth, turns[_lowest(rest)][depth])
            child = rest & postings[turn]
            rest ^= child
            stack.append((child, depth + 1, hashlib.blake2b(node + turn[1], digest_size=16).digest(), node, words[turn], first))


def _lowest(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


def _members(bits: int, ids: list[int]) -> list[int] | None:
    out = []
    while bits:
        out.append(ids[_lowest(bits)])
        bits &= bits - 1
    return out or None


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of each shard, from (shard, conv_id, pos, key, n_words) in this order of rows."""
    ids: list[int] = []
    turns: list[list[bytes]] = []
    words: dict[tuple[int, bytes], int] = {}
    shard, size = None, 0

    def flushed() -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for row in _nodes(ids, turns, words) if ids else ():
            rows.append(row)
            if len(rows) == 1 << 14:
                yield _batch(rows)
                rows.clear()
        if rows:
            yield _batch(rows)

    for batch in batches:
        for of, conv, pos, key, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if not ids or conv != ids[-1] or of != shard:
                if of != shard or size >= SHARD_ROWS:
                    yield from flushed()
                    ids, turns, words, shard, size = [], [], {}, of, 0
                ids.append(conv)
                turns.append([])
            if pos > 0:
                words[len(turns[-1]), key] = n
                turns[-1].append(key)
                size += 1
    yield from flushed()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FOUND, strict=True)], schema=_FOUND)


def found_nodes(turns: DataFrame) -> DataFrame:
    """Nodes as each shard of ids found them (n_convs not null, ends ascending), and for each
    smallest member of a shard's node the nodes above it (n_convs null). Written once."""
    rows = turns.select(F.expr(f"conv_id div {SHARD_IDS}").alias("shard"), "conv_id", "pos", "key", "n_words")
    rows = rows.repartition("shard").sortWithinPartitions("shard", "conv_id", "pos")
    return written(rows.mapInArrow(_shards, _FOUND_SQL), "trie-shards")


def end_lists(found: DataFrame) -> DataFrame:
    """(node, conv_ids): conversations that end at a node, in pieces of one shard each; the
    pieces of a node follow each other in ascending order of their first id."""
    return found.where("ends IS NOT NULL").select("node", F.col("ends").alias("conv_ids"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node, from (node, first, conv_ids) sorted by node and first."""
    last, digest = None, None
    for batch in batches:
        nodes, shas = [], []
        for node, conv_ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            piece = ",".join(map(str, conv_ids))
            if node == last:
                digest.update(b"," + piece.encode())
                continue
            if last is not None:
                nodes.append(last)
                shas.append(digest.hexdigest())
            last, digest = node, hashlib.sha256(piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(shas, pa.string())], names=["node", "ends_sha256"])
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of conversations: node (16 bytes for its sequence of turns),
    conv_id (smallest member), depth, parent, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``turns`` are keyed turns (``keyed_turns``); a row at pos 0 stands for a conversation that
    may have no turns. A node is a distinct sequence of first turns, its members the
    conversations that begin with it. n_leaves counts childless nodes of its subtree;
    saved_tokens adds up (n_convs - 1) times the words of a node's last turn over the subtree;
    ends_sha256 digests the members that end there, ascending and joined by commas. Subtrees
    include their top. An empty table has no root.

    Conversations are cut into shards by ranges of ids, each read depth first over bitmaps
    (``_nodes``), so copies and common openings are summed up inside a shard before anything
    is shuffled. Sums over subtrees need no walk over the tree: a node's value is kept with
    its smallest member, and each such conversation adds its own nodes' values to the nodes on
    its path, one row per turn. Digests are made piece by piece in order, so a task holds one
    shard's part of a node's list.
    """
    found = found_nodes(turns)
    nodes = found.where("n_convs IS NOT NULL").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"),
        F.sum("n_convs").alias("n_convs"), F.max("n_words").alias("n_words"), F.max("inner").alias("inner"))
    nodes = written(nodes, "trie-nodes")
    value = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved_tokens"),
                         (~F.col("inner")).cast("long").alias("n_leaves"))
    up = Window.partitionBy("conv_id").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = found.select("conv_id", "depth", "node").join(value, ["conv_id", "depth"], "left").select(
        "node", *[F.sum(F.coalesce(c, F.lit(0))).over(up).alias(c) for c in ("saved_tokens", "n_leaves")])
    sums = sums.where("saved_tokens > 0 OR n_leaves > 0")
    ends = end_lists(found).select("node", F.col("conv_ids")[0].alias("first"), "conv_ids")
    ends = ends.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_digests, "node binary, ends_sha256 string")
    children = nodes.where("parent IS NOT NULL").select(F.col("parent").alias("node"), F.lit(1).cast("long").alias("n_children"))
    rows = nodes.select("node", "conv_id", "depth", "parent", "n_convs")
    for more in (children, sums, ends):
        rows = rows.unionByName(more, allowMissingColumns=True)
    out = rows.groupBy("node").agg(
        *[F.max(c).alias(c) for c in ("conv_id", "depth", "parent", "n_convs")],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")],
        F.coalesce(F.max("ends_sha256"), F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return out.join(above, "parent", "left").select(
        "node", "conv_id", "depth", "parent", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
