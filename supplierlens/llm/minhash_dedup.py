"""MinHash near-dedup through an inverted index of signature coordinates."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplierlens.llm import text_hash
from supplierlens.llm.common import written
from supplierlens.llm.components import components


@dataclass(frozen=True)
class Settings:
    """``coordinates`` per signature, of which a pair must share ``matches``.

    A pair of similarity 0.8 shares 38 of 48 coordinates on average and under 27 with a
    probability of about 4.8e-5. By the prefix principle two signatures that share 27
    coordinates share one of the 22 (= 48 - 27 + 1) rarest of either, so postings of the
    other 26 are never merged.
    """

    words: int = 5
    percent: int = 80
    coordinates: int = 48
    matches: int = 27
    hub_rounds: int = 2
    block: int = 256


def _sets(part: text_hash.Texts, k: int) -> Iterator[np.ndarray]:
    w = text_hash.words(part)
    for i in range(len(part)):
        yield text_hash.shingles(w.hashes[w.bounds[i]:w.bounds[i + 1]], k)


def described(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, n_shingles, fp (hash of the whole set), signature (one int per coordinate)."""
    factors = text_hash.constants(s.coordinates, 4)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, fp, signature = [], [], []
            for part in text_hash.texts(batch.column(1)):
                for runs in _sets(part, s.words):
                    if not len(runs):
                        n.append(0)
                        fp.append(None)
                        signature.append(None)
                        continue
                    runs = np.unique(runs)
                    low = np.full(s.coordinates, np.iinfo(np.uint64).max, np.uint64)
                    for at in range(0, len(runs), 4096):
                        block = runs[at:at + 4096, None] * factors
                        np.minimum(low, block.min(axis=0), out=low)
                    n.append(len(runs))
                    fp.append(hashlib.blake2b(runs.tobytes(), digest_size=16).digest())
                    signature.append((low >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(fp, pa.binary()),
                 pa.array(signature, pa.list_(pa.int32()))], ["doc_id", "n_shingles", "fp", "signature"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        describe, f"doc_id {id_type}, n_shingles long, fp binary, signature array<int>")


def _postings(nodes: DataFrame, s: Settings) -> DataFrame:
    """(key, node) for the rarest coordinate-value pairs of each node that other nodes share.

    Posting lists are counted first; a list of one merges with nothing. Of a node's pairs,
    ordered by list length and key, the first ``coordinates - matches + 1`` form its prefix;
    its pairs that nobody shares are the rarest and use up places of the prefix.
    """
    posted = nodes.select("node", F.posexplode("signature").alias("c", "v")).select(
        "node", (F.col("c").cast("long") * F.lit(1 << 32) + F.col("v")).alias("key"))
    lengths = written(posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
                      "minhash-lengths")
    shared = (posted.join(lengths, "key").groupBy("node")
              .agg(F.sort_array(F.collect_set(F.struct("n", "key"))).alias("pairs"))
              .where(F.size("pairs") >= s.matches))
    places = F.lit(s.coordinates - s.matches + 1) - (F.lit(s.coordinates) - F.size("pairs"))
    return shared.select("node", F.explode(F.slice("pairs", F.lit(1), places)).alias("pair")).select(
        F.col("pair.key").alias("key"), "node")


def _collisions(a: str, b: str) -> Column:
    return F.size(F.filter(F.zip_with(F.col(a), F.col(b), lambda x, y: x == y), lambda x: x))


def _confirmed(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The ``pairs`` (a, b) whose whole shingle sets are similar enough."""
    k, percent = s.words, s.percent

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            keep = []
            right = batch.column("b").to_pylist()
            at = 0
            for part in text_hash.texts(batch.column("text_a")):
                for left in _sets(part, k):
                    if last[0] != right[at]:
                        own = next(text_hash.texts(batch.column("text_b").slice(at, 1)))
                        last = (right[at], np.unique(next(_sets(own, k))))
                    left, other = np.unique(left), last[1]
                    both = len(np.intersect1d(left, other, assume_unique=True))
                    keep.append(100 * both >= percent * (len(left) + len(other) - both))
                    at += 1
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    whole = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return whole.select("a", "b", "text_a", "text_b").mapInArrow(confirm, f"a {kind}, b {kind}")


def _hub_pairs(held: DataFrame, signatures: DataFrame, s: Settings, turn: int) -> DataFrame:
    """For each node at most one hub of another component that its signature matches best.

    Each posting list has one hub, the member first in an order that every list shares, so
    that the lists of one group of copies agree on it. ``held``: key, node, root.
    """
    order = F.xxhash64(F.lit(turn), F.col("node"))
    first = F.min(F.struct(order.alias("at"), F.col("node").alias("hub"), F.col("root").alias("hub_root")))
    hubs = written(
        held.groupBy("key").agg(first.alias("h"), F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low <> high").select("key", "h.hub", "h.hub_root"), "minhash-hubs")
    offers = held.join(hubs, "key").where("root <> hub_root").groupBy("node", "hub").agg(
        F.count(F.lit(1)).alias("lists"))
    return (_matching(offers, signatures, s, "node", "hub")
            .groupBy("node").agg(F.max_by("hub", F.struct("same", "hub")).alias("hub"))
            .select(F.col("node").alias("a"), F.col("hub").alias("b")))


def _matching(pairs: DataFrame, signatures: DataFrame, s: Settings, a: str, b: str) -> DataFrame:
    """``pairs`` whose sizes allow the similarity and whose signatures collide often enough."""
    left = signatures.select(F.col("node").alias(a), F.col("signature").alias("sig_a"), F.col("n").alias("n_a"))
    right = signatures.select(F.col("node").alias(b), F.col("signature").alias("sig_b"), F.col("n").alias("n_b"))
    return (pairs.join(left, a).join(right, b)
            .where((100 * F.least("n_a", "n_b") >= s.percent * F.greatest("n_a", "n_b")))
            .withColumn("same", _collisions("sig_a", "sig_b")).where(F.col("same") >= s.matches)
            .select(a, b, "same"))


def _open_links(held: DataFrame, signatures: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Every link (a, b) between components that share a posting list, one per node and component.

    Lists that span components are gathered by hub, the member that comes first in one order
    of all nodes, so that the many lists of a group of copies are one group. Of a group's
    components the largest is its main one; members of others, the outsiders, meet all
    members, in blocks. Signatures tell which blocks hold pairs that may be links, and
    which of their documents; the texts of these come together block by block, where sizes
    of all intersections are one matrix product. No pair leaves a task unless it is a link.
    """
    order = F.xxhash64(F.lit(s.hub_rounds), F.col("node"))
    lists = written(
        held.groupBy("key").agg(F.min_by("node", order).alias("hub"), F.min("root").alias("low"),
                                F.max("root").alias("high")).where("low <> high").select("key", "hub"), "minhash-open")
    group = held.join(lists, "key").select("hub", "node", "root").distinct()
    group = written(group.join(signatures, "node"), "minhash-groups")
    sizes = group.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("n_root")).groupBy("hub").agg(
        F.max_by("root", F.struct("n_root", "root")).alias("main"), F.sum("n_root").alias("n_all"),
        F.max("n_root").alias("n_main")).where("n_all > n_main")
    group = written(group.join(written(sizes, "minhash-sizes"), "hub"), "minhash-members")
    member = F.struct("node", "root", "n", "signature")

    def blocks(rows: DataFrame, n: Column, name: str) -> DataFrame:
        at = F.pmod(F.xxhash64("node"), F.ceil(n / s.block))
        return written(rows.withColumn("at", at).groupBy("hub", "at").agg(F.collect_list(member).alias(name))
                       .withColumnRenamed("at", f"at_{name}"), "minhash-blocks")

    outsiders = blocks(group.where("root <> main"), F.col("n_all") - F.col("n_main"), "outsiders")
    members = blocks(group, F.col("n_all"), "members")
    percent, matches, words = s.percent, s.matches, s.words

    def arrays(rows: pa.StructArray) -> tuple[np.ndarray, ...]:
        return (np.asarray(rows.field("node")), np.asarray(rows.field("root")), np.asarray(rows.field("n")),
                np.asarray(rows.field("signature").flatten()).reshape(len(rows), -1))

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                mine, theirs = batch.column(3)[i].values, batch.column(4)[i].values
                node, root, n, sig = arrays(mine)
                node_b, root_b, n_b, sig_b = arrays(theirs)
                pass_a, pass_b = np.zeros(len(node), bool), np.zeros(len(node_b), bool)
                for k in range(len(node)):
                    fits = (100 * np.minimum(n_b, n[k]) >= percent * np.maximum(n_b, n[k])) & (root_b != root[k])
                    fits[fits] = (sig_b[fits] == sig[k]).sum(axis=1) >= matches
                    pass_a[k] = fits.any()
                    pass_b |= fits
                side = [True] * int(pass_a.sum()) + [False] * int(pass_b.sum())
                out = [pa.array([batch.column(c)[i].as_py()] * len(side), batch.schema.field(c).type) for c in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*out, pa.array(side, pa.bool_()), pa.array(np.concatenate([node[pass_a], node_b[pass_b]])),
                     pa.array(np.concatenate([root[pass_a], root_b[pass_b]]))],
                    ["hub", "at_outsiders", "at_members", "outside", "node", "root"])

    kind = held.schema["node"].dataType.simpleString()
    met = outsiders.join(members, "hub").select("hub", "at_outsiders", "at_members", "outsiders", "members")
    # Blocks are large rows: few at a time, dealt evenly.
    found = written(met.repartition("hub", "at_outsiders", "at_members").mapInArrow(
        promising, f"hub {kind}, at_outsiders long, at_members long, outside boolean, node {kind}, root {kind}"),
        "minhash-promising")
    together = (found.join(texts, "node").groupBy("hub", "at_outsiders", "at_members")
                .agg(F.collect_list(F.struct("outside", "node", "root", "text")).alias("rows")).select("rows"))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                rows = batch.column(0)[i].values
                outside = np.asarray(rows.field("outside"))
                node, root = np.asarray(rows.field("node")), np.asarray(rows.field("root"))
                sets = [np.unique(x) for part in text_hash.texts(rows.field("text")) for x in _sets(part, words)]
                ours, theirs = np.flatnonzero(outside), np.flatnonzero(~outside)
                both = _intersections([sets[k] for k in ours], [sets[k] for k in theirs])
                n = np.array([len(x) for x in sets])
                link = 100 * both >= percent * (n[ours][:, None] + n[theirs][None, :] - both)
                link &= root[ours][:, None] != root[theirs][None, :]
                a, b = np.nonzero(link)
                # One link per outsider and component is enough to join them.
                _, first = np.unique(np.stack([a, root[theirs][b]]), axis=1, return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(node[ours][a[first]]), pa.array(node[theirs][b[first]])],
                                                 ["a", "b"])

    return together.mapInArrow(linked, f"a {kind}, b {kind}")


def _intersections(ours: list[np.ndarray], theirs: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of the other."""
    out = np.zeros((len(ours), len(theirs)), np.int64)
    if not ours or not theirs:
        return out
    common = np.intersect1d(np.concatenate(ours), np.concatenate(theirs))

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        value = np.concatenate(sets)
        at = np.searchsorted(common, value)
        real = at < len(common)
        real[real] = common[at[real]] == value[real]
        return row[real], at[real]

    (row_a, at_a), (row_b, at_b) = places(ours), places(theirs)
    for low in range(0, len(common), width):  # some columns at a time bound the memory
        grid_a, grid_b = np.zeros((len(ours), width), np.float32), np.zeros((len(theirs), width), np.float32)
        for grid, row, at in ((grid_a, row_a, at_a), (grid_b, row_b, at_b)):
            here = (at >= low) & (at < low + width)
            grid[row[here], at[here] - low] = 1
        out += (grid_a @ grid_b.T).astype(np.int64)
    return out


def minhash_dedup(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    Documents are linked when 100 * shared shingles >= percent * all shingles of both, on
    their sets of distinct runs of ``words`` words (A-Z as a-z; fewer words are one run).
    component_id is the smallest id reachable by links, kept says that it is the row's own.
    A null or blank text has no shingles and no links. Rows repeated under one id are one
    document. A row without an id has no component and is kept. Other columns are not looked
    at; an empty table gives an empty one.

    Equal sets are one node. Nodes are posted under their rarest signature coordinates; in
    each posting list members are compared with a hub, and confirmed links are contracted to
    components (``hub_rounds`` times), so that a group of copies costs one comparison a
    member instead of one for each pair. What is left then are lists that span components:
    there all pairs across components are compared in blocks, so no link is lost to the hubs.
    Links are confirmed on the whole sets, made anew from the texts.
    """
    s = settings
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = written(described(base, s), "minhash-described")
    classes = rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("fp").agg(
        F.min(F.struct("doc_id", "n_shingles", "signature")).alias("first"))
    nodes = written(classes.select("fp", F.col("first.doc_id").alias("node"),
                                   F.col("first.n_shingles").alias("n"), "first.signature"), "minhash-nodes")
    postings = written(_postings(nodes, s), "minhash-postings")
    posted = postings.select("node").distinct()
    signatures = written(nodes.join(posted, "node", "left_semi").select("node", "n", "signature"), "minhash-signatures")
    texts = written(base.join(posted, base["doc_id"] == posted["node"], "left_semi")
                    .select(F.col("doc_id").alias("node"), "text")
                    .groupBy("node").agg(F.max("text").alias("text")), "minhash-texts")

    roots = None
    links = None
    for turn in range(s.hub_rounds + 1):
        held = postings.withColumn("root", F.col("node")) if roots is None else (
            postings.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
        held = held if roots is None else written(held, "minhash-held")
        found = written(_confirmed(_hub_pairs(held, signatures, s, turn), texts, s) if turn < s.hub_rounds
                        else _open_links(held, signatures, texts, s), "minhash-links")
        links = found if links is None else links.union(found)
        roots = components(links)

    member = nodes.join(roots, "node", "left").select(
        F.col("fp").alias("node_fp"), F.coalesce("root", "node").alias("component"))
    out = rows.join(member, (F.col("fp") == F.col("node_fp")) & F.col("doc_id").isNotNull(), "left")
    own = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", own.alias("component_id"),
                      F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"))
