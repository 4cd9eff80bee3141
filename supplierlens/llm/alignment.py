"""Alignment of two tokenizers over the same bytes: groups of tokens, and how often id pairs meet."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplierlens.llm import text_hash
from supplierlens.llm.common import written
from supplierlens.llm.tokens import BYTE_LETTERS, has_even_blanks, ranked

#: Bytes of text whose links share one list of distinct pairs. Larger blocks have fewer pairs in
#: all; the arrays of a block take about as much memory as twice its texts.
BLOCK_BYTES = 8 << 20
#: Bytes that a worker's table of aligned units may take before it is begun anew.
TABLE_BYTES = 96 << 20
#: Characters that are encoded at once.
CHUNK_CHARS = 1 << 14

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
# Characters whose class in the byte tokenizer's pattern no edition of Unicode changes.
_PLAIN = re.compile("[\n -~À-ÖØ-öø-ɏ]+").fullmatch
_SPACE_MARK = "▁"
_ALONE = "\n\n"
#: An id pair is ``a << PAIR_SHIFT | b``; neither id takes more bits.
PAIR_SHIFT = 20


def _unit_keys(text: str) -> list[str]:
    """A text's units: without the blank they begin with, or as they are from a line feed on.

    A unit that begins or ends with blanks of its own cannot stand beside others; its key is
    _ALONE and the unit.
    """
    if has_even_blanks(text):
        return text.replace("\n", " \n").split(" ")
    return [_ALONE + u if u[1:2].isspace() or u[-1].isspace() else u if u[0] == "\n" else u[1:]
            for u in _CUT.split(" " + text)]


def component_of(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For each token, A's first and then B's, the B token at which its component ends.

    ``ends_a`` and ``ends_b`` are the ascending byte ends of two segmentations of the same
    bytes. Every token points to its farthest-right overlapping token, which for a token of one
    side is the other side's token over its last byte; a B token with no farther one points to
    itself. Successors are doubled until none changes, in as many rounds as the logarithm of
    the longest chain.
    """
    n = len(ends_a)
    over_b = np.searchsorted(ends_a, ends_b)
    succ = np.concatenate([
        n + np.searchsorted(ends_b, ends_a),
        np.where(ends_a[over_b] > ends_b, over_b, n + np.arange(len(ends_b)))])
    while not np.array_equal(far := succ[succ], succ):
        succ = far
    return succ - n


class Aligner:
    """Aligned units of text, kept per worker.

    A text, with the blank before it, is cut before each single blank or line feed that stands
    between two other characters. Both tokenizers end a token there whatever stands around it:
    the byte tokenizer's pattern begins a word, and no piece of the other vocabulary goes on
    over a space mark or a line feed (``__init__`` looks at every piece). So groups never cross
    a cut and a unit has the same tokens everywhere; each is encoded and aligned once in a while.
    """

    def __init__(self, byte_path: str, piece_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(byte_path)
        self._library.no_truncation()
        self._library.no_padding()
        self._library.encode_special_tokens = True
        with open(byte_path, encoding="utf-8") as f:
            file = json.load(f)
        byte_of = {c: b for b, c in BYTE_LETTERS.items()}
        added = {x["content"]: x["id"] for x in file["added_tokens"]}
        names = {i: t for t, i in file["model"]["vocab"].items() if t not in added}
        a_bytes = {i: bytes(byte_of[c] for c in t) for i, t in names.items()}
        a_bytes |= {i: t.encode() for t, i in added.items()}
        self._ranked = ranked(file)
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        b_bytes, crossing = {}, []
        for i in range(self._pieces.get_piece_size()):
            piece = self._pieces.id_to_piece(i)
            if self._pieces.is_byte(i):
                b_bytes[i] = bytes([int(piece[3:5], 16)])
            else:
                b_bytes[i] = piece.replace(_SPACE_MARK, " ").encode()
                if "\n" in piece or re.search(f"[^{_SPACE_MARK}]{_SPACE_MARK}", piece):
                    crossing.append(piece)
        if crossing:
            raise ValueError(f"pieces go on over a space mark or line feed: {crossing[:5]}")
        self.n_a, self.n_b = max(a_bytes) + 1, max(b_bytes) + 1
        if max(self.n_a, self.n_b) > 1 << PAIR_SHIFT:
            raise ValueError(f"ids must fit {PAIR_SHIFT} bits")
        self._b_bytes = [b_bytes.get(i, b"") for i in range(self.n_b)]
        self._len_a = np.array([len(a_bytes.get(i, b"")) for i in range(self.n_a)], np.int64)
        self._len_b = np.array([len(x) for x in self._b_bytes], np.int64)
        # Names with what follows them: , and | behind an A id; , and ; and \n behind a B id.
        self._written = np.array([f"{i}{c}" for n, marks in ((self.n_a, ",|"), (self.n_b, ",;\n"))
                                  for c in marks for i in range(n)], object)
        self._clear()

    def _clear(self) -> None:
        self._number: dict[str, int] = {}  # of units by their keys
        self._groups: list[str | None] = []  # null: the bytes differ
        self._sizes = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups, links
        self._first = np.zeros(1, np.int64)
        self._pairs = np.zeros(0, np.int64)
        self._bytes = 0

    def _encode_a(self, text: str) -> Sequence[int]:
        if self._ranked is not None and _PLAIN(text):
            return self._ranked.encode_ordinary(text)
        return self._library.encode(text, add_special_tokens=False).ids

    def _encode_b(self, text: str) -> list[int]:
        """Of a text that begins with a blank, which the library adds, or a line feed."""
        return self._pieces.encode(text[1:], num_threads=1) if text[0] == " " else self._pieces.encode(text, num_threads=1)[1:]

    def _add(self, keys: list[str], units: list[str], joined: bool) -> None:
        """Align new units; ``joined``: they stand for themselves beside any others."""
        if joined and len(units) > 1:
            chunks, part, size = [], [], 0
            for u in units:
                part.append(u)
                size += len(u)
                if size >= CHUNK_CHARS:
                    chunks.append("".join(part))
                    part, size = [], 0
            if part:
                chunks.append("".join(part))
        else:
            chunks = ["".join(units)]
        ids_b = [self._encode_b(x) for x in chunks]
        if any(b"".join(map(self._b_bytes.__getitem__, ids)) != x.encode() for ids, x in zip(ids_b, chunks, strict=True)):
            if len(units) > 1:
                half = len(units) // 2
                self._add(keys[:half], units[:half], joined)
                self._add(keys[half:], units[half:], joined)
            else:
                self._keep(keys, [None], np.zeros((1, 4), np.int64), np.zeros(0, np.int64))
            return
        ids_a = [self._encode_a(x) for x in chunks]
        a, b = (np.concatenate([np.array(x, np.int64) for x in ids]) for ids in (ids_a, ids_b))
        ends_a, ends_b = np.cumsum(self._len_a[a]), np.cumsum(self._len_b[b])
        unit_ends = np.cumsum([len(x.encode()) for x in units])
        if ends_a[-1] != unit_ends[-1]:
            raise ValueError("the byte tokenizer does not keep all bytes")

        last = component_of(ends_a, ends_b)
        closes = last[len(a):] == np.arange(len(b))  # the B tokens at which components end
        rank = np.cumsum(closes) - closes
        group_a, group_b = rank[last[:len(a)]], rank[last[len(a):]]
        n_groups = int(closes.sum())
        unit_of_group = np.searchsorted(unit_ends, ends_b[closes])
        unit_a, unit_b = unit_of_group[group_a], unit_of_group[group_b]

        # Ids in order of groups, A's before B's, each with the mark that follows it.
        before_a = np.searchsorted(group_b, np.arange(n_groups))
        after_a = np.searchsorted(group_a, np.arange(n_groups), "right")
        text = np.empty(len(a) + len(b), np.int64)
        ends_group_a = np.append(group_a[1:] != group_a[:-1], True)
        text[np.arange(len(a)) + before_a[group_a]] = a + self.n_a * ends_group_a
        ends_unit = np.append(unit_b[1:] != unit_b[:-1], True)
        text[np.arange(len(b)) + after_a[group_b]] = 2 * self.n_a + b + self.n_b * (closes + (closes & ends_unit).astype(np.int64))
        groups = "".join(self._written[text].tolist()).split("\n")[:-1]

        # An A token is linked to the B tokens from its first byte to its last.
        first = np.searchsorted(ends_b, ends_a - self._len_a[a], "right")
        links = np.searchsorted(ends_b, ends_a) - first + 1
        of_a = np.repeat(np.arange(len(a)), links)
        of_b = first[of_a] + np.arange(len(of_a)) - (np.cumsum(links) - links)[of_a]
        n = len(units)
        sizes = np.stack([np.bincount(unit_a, minlength=n), np.bincount(unit_b, minlength=n),
                          np.bincount(unit_of_group, minlength=n),
                          np.bincount(unit_a[of_a], minlength=n)], axis=1)
        self._keep(keys, groups, sizes, (a[of_a] << PAIR_SHIFT) | b[of_b])

    def _keep(self, keys: list[str], groups: list[str | None], sizes: np.ndarray, pairs: np.ndarray) -> None:
        self._number.update(zip(keys, range(len(self._groups), len(self._groups) + len(keys)), strict=True))
        self._groups += groups
        self._new.append((sizes, pairs))
        self._bytes += sum(map(len, keys)) + sum(len(g or "") for g in groups) + 250 * len(keys) + 8 * len(pairs)

    def over(self, texts: list[str]) -> tuple[list[np.ndarray | None], list[str]]:
        """Each text's unit numbers, none where its bytes differ or are none, and its groups."""
        if self._bytes > TABLE_BYTES:
            self._clear()
        units = [_unit_keys(t) if t and _SPACE_MARK not in t else None for t in texts]
        new = set().union(*[x for x in units if x]).difference(self._number)
        self._new: list[tuple[np.ndarray, np.ndarray]] = []
        plain, odd = [], []
        for k in new:
            if k.startswith(_ALONE):
                self._add([k], [k[len(_ALONE):]], False)
            else:
                (plain if _PLAIN(k) else odd).append(k)
        for keys in (plain, odd):
            if keys:
                self._add(keys, [k if k[0] == "\n" else " " + k for k in keys], True)
        if self._new:
            self._sizes = np.concatenate([self._sizes, *[x[0] for x in self._new]])
            self._pairs = np.concatenate([self._pairs, *[x[1] for x in self._new]])
            self._first = np.concatenate([[0], np.cumsum(self._sizes[:, 3])])
        numbers, written_groups = [], []
        for x in units:
            found = [self._number[u] for u in x] if x else []
            names = [self._groups[u] for u in found]
            if not found or None in names:
                numbers.append(None)
                written_groups.append("")
            else:
                numbers.append(np.array(found, np.int64))
                written_groups.append(";".join(names))
        return numbers, written_groups

    def measured(self, numbers: list[np.ndarray | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sizes of each text, and its distinct pairs with their links: (sizes, text, pair, links)."""
        n = len(numbers)
        doc = np.repeat(np.arange(n), [0 if x is None else len(x) for x in numbers])
        unit = np.concatenate([np.zeros(0, np.int64), *[x for x in numbers if x is not None]])
        sizes = np.stack([np.bincount(doc, self._sizes[unit, k], n) for k in range(4)], axis=1).astype(np.int64)
        key, times = np.unique((doc << 32) | unit, return_counts=True)
        doc, unit = key >> 32, key & 0xFFFFFFFF
        links = self._sizes[unit, 3]
        row = np.repeat(np.arange(len(unit)), links)
        pair = self._pairs[self._first[unit][row] + np.arange(len(row)) - (np.cumsum(links) - links)[row]]
        key = (doc[row] << 2 * PAIR_SHIFT) | pair
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[row[order]]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        weight = np.add.reduceat(times, starts) if len(key) else np.zeros(0, np.int64)
        return sizes, key[starts] >> 2 * PAIR_SHIFT, key[starts] & ((1 << 2 * PAIR_SHIFT) - 1), weight


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One per pair of files and Python worker."""
    key = (byte_path, piece_path)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


#: A row of a text has its sizes, digest and links by slot of its block's list; a row of a
#: block has that list: its distinct pairs in ascending order and the number of texts of each.
_ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, "
            "block long, slots binary, links binary, pairs binary, texts binary")


def _align(byte_path: str, piece_path: str, with_groups: bool):
    schema = pa.schema([(x.split(" ")[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split(" ")[1]])
                        for x in _ALIGNED.split(", ")])

    def batch(columns: dict) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def flushed(block: int, parts: list) -> Iterator[pa.RecordBatch]:
        every = np.concatenate([p["pair"] for p in parts])
        pairs, slot = np.unique(every, return_inverse=True)
        at = 0
        for p in parts:
            slots = slot[at:at + len(p["pair"])]
            at += len(slots)
            # Ascending slots of a text are kept as steps, which compress well.
            cut = np.searchsorted(p["text"], np.arange(len(p["ids"]) + 1))
            step = np.diff(slots, prepend=0)
            heads = cut[:-1][cut[:-1] < cut[1:]]
            step[heads] = slots[heads]
            step, weight = step.astype("<u4"), p["weight"].astype("<u4")
            yield batch({
                "doc_id": p["ids"], "n_a": p["sizes"][:, 0], "n_b": p["sizes"][:, 1], "n_groups": p["sizes"][:, 2],
                "n_links": p["sizes"][:, 3], "groups": p["groups"], "groups_sha256": p["sha"], "block": [block] * len(p["ids"]),
                "slots": [step[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)],
                "links": [weight[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]})
        yield batch({"block": [block], "pairs": [pairs.astype("<i8").tobytes()],
                     "texts": [np.bincount(slot, minlength=len(pairs)).astype("<u4").tobytes()]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, block = aligner(byte_path, piece_path), TaskContext.get().partitionId() << 32
        parts, size = [], 0
        for rows in batches:
            ids, column = rows.column(0), rows.column(1)
            for piece in text_hash.texts(column):
                texts = [x or "" for x in column.slice(piece.first, len(piece)).to_pylist()]
                numbers, groups = own.over(texts)
                sizes, text, pair, weight = own.measured(numbers)
                parts.append({
                    "ids": ids.slice(piece.first, len(piece)).to_pylist(), "sizes": sizes, "text": text, "pair": pair, "weight": weight,
                    "groups": groups if with_groups else [None] * len(texts),
                    "sha": [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]})
                size += len(piece.data) + 64 * len(piece)
                if size >= BLOCK_BYTES:
                    yield from flushed(block, parts)
                    parts, size, block = [], 0, block + 1
        if parts:
            yield from flushed(block, parts)

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block and pair, from (block, pairs, texts)."""
    for rows in batches:
        for block, pairs, texts in zip(*[c.to_pylist() for c in rows.columns], strict=True):
            pair, text = np.frombuffer(pairs, "<i8"), np.frombuffer(texts, "<u4").astype(np.int64)
            for at in range(0, len(pair), 1 << 16):
                n = len(pair[at:at + (1 << 16)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block, np.int64)), pa.array(np.arange(at, at + n, dtype=np.int32)),
                     pa.array(pair[at:at + n]), pa.array(text[at:at + n])], names=["block", "slot", "pair", "texts"])


def _scored(rows: pa.Table, looked: pa.Table) -> pa.Table:
    """Texts of one block with the counts of their pairs."""
    slot, n = looked["slot"].to_numpy(), looked["n"].to_numpy()
    count = np.zeros(len(slot), np.int64)
    best = np.zeros(len(slot), bool)
    count[slot], best[slot] = n, looked["best"].to_numpy()
    sums, bests = [], []
    for steps, links in zip(rows["slots"].to_pylist(), rows["links"].to_pylist(), strict=True):
        at, weight = np.cumsum(np.frombuffer(steps, "<u4").astype(np.int64)), np.frombuffer(links, "<u4").astype(np.int64)
        sums.append(int(count[at] @ weight))
        bests.append(int(weight[best[at]].sum()))
    kept = rows.drop_columns(["block", "slots", "links"])
    return kept.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))


def align(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
          with_groups: bool = True) -> DataFrame:
    """One row per row of ``docs``: how the tokens of a byte-level tokenizer (A) and a piece
    tokenizer (B) cover the same bytes, the text with a blank before it.

    Columns: doc_id, n_a, n_b (tokens), n_groups (runs of bytes between places where tokens of
    both end), n_links (overlapping A-B token pairs), groups (``a1,a2|b1;a3|b2,b3``, null unless
    ``with_groups``), groups_sha256, n_best (links whose id pair is in as many texts as any pair
    of its A id) and count_sum (texts that hold a link's id pair, added up over links).

    A text that is null or empty, or that either tokenizer does not give back byte by byte
    (B's space mark itself in a text), has no tokens: zeros and an empty digest; it counts for
    no pair. Strings of special tokens inside texts are plain text. Repeated rows and null ids
    are rows of their own, and each counts as a text. Other columns are not looked at. An
    empty table gives an empty one.

    Groups come from pointer jumping (``component_of``). The texts of each pair are counted in
    two steps: blocks of about BLOCK_BYTES list their distinct pairs, and only those lists are
    shuffled by pair and back by block, so a pair has one row per block however many texts
    hold it. The lists and the aligned texts are written once.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    aligned = written(base.mapInArrow(_align(byte_path, piece_path, with_groups), _ALIGNED), "aligned")
    listed = aligned.where("pairs IS NOT NULL").select("block", "pairs", "texts").mapInArrow(
        _listed, "block long, slot int, pair long, texts long")
    counts = written(listed.groupBy("pair").agg(F.sum("texts").alias("n")), "pair-counts")
    # At most one row per id of A's vocabulary, which bounds what is broadcast.
    most = counts.groupBy(F.shiftright("pair", PAIR_SHIFT).alias("a")).agg(F.max("n").alias("most"))
    counts = counts.join(F.broadcast(most), F.shiftright("pair", PAIR_SHIFT) == F.col("a")).select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))
    looked = listed.join(counts, "pair").select("block", "slot", "n", "best")
    rows = aligned.where("pairs IS NULL").drop("pairs", "texts")
    out = rows.groupBy("block").cogroup(looked.groupBy("block")).applyInArrow(
        _scored, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, "
                 "n_best long, count_sum long")
    return out if with_groups else out.drop("groups")
