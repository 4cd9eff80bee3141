"""Hierarchical packing of documents into sequences of several context sizes."""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from supplierlens.llm import tokens

#: Context sizes. A sequence of exactly such a size needs no padding.
TIERS = (256, 512, 1024, 2048)
#: Rests of documents held back at a time, at most 4 KB of ids each.
POOL = 4096
#: Tokens of one step group; its sequences are all of one tier.
STEP_TOKENS = 1 << 16
END_ID = 1


@dataclass(frozen=True)
class Piece:
    """Ids ``start`` to ``start + length`` of the document numbered ``doc``."""

    doc: int
    start: int
    length: int


@dataclass
class Packer:
    """Packs documents as they come; ``done`` has (tier, pieces) of full sequences.

    A document gives full windows of the largest tier; its rest is routed to the smallest
    tier that holds it. A window opens with the longest rest of its tier; its gap takes the
    longest rests that fit, whichever shorter tier they belong to, and when none fits, the
    head of the shortest rest that is left. So every window is full while rests last.
    """

    tiers: tuple[int, ...] = TIERS
    pool: int = POOL
    rests: list[tuple[int, int, int]] = field(default_factory=list)  # (length, doc, start), sorted
    done: list[tuple[int, list[Piece]]] = field(default_factory=list)

    def add(self, doc: int, length: int) -> None:
        window, at = self.tiers[-1], 0
        while length - at >= window:
            self.done.append((window, [Piece(doc, at, window)]))
            at += window
        if length > at:
            insort(self.rests, (length - at, doc, at))
        if len(self.rests) >= self.pool:
            self.pack()

    def _take(self, most: int) -> tuple[int, int, int] | None:
        """The longest rest of at most ``most`` ids."""
        k = bisect_right(self.rests, (most, float("inf"), 0))
        return self.rests.pop(k - 1) if k else None

    def _fill(self, tier: int, pieces: list[Piece]) -> bool:
        gap = tier - sum(p.length for p in pieces)
        while gap:
            rest = self._take(gap)
            if rest is None:
                if not self.rests:
                    return False
                length, doc, start = self.rests.pop(0)
                rest = (gap, doc, start)
                insort(self.rests, (length - gap, doc, start + gap))
            pieces.append(Piece(rest[1], rest[2], rest[0]))
            gap -= rest[0]
        self.done.append((tier, pieces))
        return True

    def pack(self) -> None:
        """Packs tier by tier, long ones first; what can't fill a window stays as rests."""
        for tier in reversed(self.tiers):
            while (k := bisect_right(self.rests, (tier, float("inf"), 0))) and self.rests[k - 1][0] > tier // 2:
                if not self._open(tier):
                    return
        while self.rests and sum(r[0] for r in self.rests) >= self.tiers[-1]:
            if not self._open(self.tiers[-1]):
                return

    def _open(self, tier: int) -> bool:
        length, doc, start = self._take(tier)
        pieces = [Piece(doc, start, length)]
        if self._fill(tier, pieces):
            return True
        for p in pieces:
            insort(self.rests, (p.length, p.doc, p.start))
        return False

    def finish(self) -> None:
        """The last rests: full windows, then the largest tiers that they fill, then one short sequence."""
        self.pack()
        while self.rests:
            left = sum(r[0] for r in self.rests)
            tier = max((t for t in self.tiers if t <= left), default=left)
            pieces: list[Piece] = []
            self._fill(tier, pieces)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
         tiers: tuple[int, ...] = TIERS, pool: int = POOL, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    tier, step_group, and with ``with_ids`` the ids as little-endian 16-bit numbers.

    A document's ids are those of its whole text by the tokenizers library from ``path``, then
    END_ID; a null or empty text has END_ID alone. Each id lies in one piece. A row, repeated
    or without an id, is a document of its own. Other columns are not looked at; an empty
    table gives an empty one. tier is the context size of the sequence, 0 for the one
    sequence of a task that fills none.

    Documents are encoded and packed in the task that reads them: nothing is shuffled, and a
    sequence never spans tasks. Memory is bounded by ``pool`` rests and one Arrow batch.
    sequence_id carries the task's partition number, so it is unique, and the same when a
    lost task is run again over the same rows.
    """
    for t in tiers:
        if t & (t - 1) or t < 1:
            raise ValueError("tiers must be powers of two")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path).encode
        packer = Packer(tuple(sorted(tiers)), pool)
        # By document with ids to come: its id, ids from a place on, that place, number of ids.
        held: dict[int, tuple[object, np.ndarray, int, int]] = {}
        whole: dict[int, int] = {}
        task = TaskContext.get().partitionId() << 33
        made = 0
        per_tier: dict[int, int] = {}
        n = 0
        id_type = None

        def emit() -> pa.RecordBatch:
            nonlocal made
            out: dict[str, list] = {k: [] for k in (
                "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier",
                "step_group", "ids")}
            for tier, pieces in packer.done:
                tier = tier if tier in packer.tiers else 0
                nth = per_tier.get(tier, 0)
                per_tier[tier] = nth + 1
                group = nth // max(1, STEP_TOKENS // max(tier, 1))
                offset = 0
                for p in pieces:
                    doc_id, ids, base, total = held[p.doc]
                    part = ids[p.start - base:p.start - base + p.length]
                    out["doc_id"].append(doc_id)
                    out["start"].append(p.start)
                    out["length"].append(p.length)
                    out["ids_crc32"].append(zlib.crc32(part.astype("<u4").tobytes()))
                    out["doc_tokens"].append(total)
                    out["sequence_id"].append(task + made)
                    out["offset"].append(offset)
                    out["tier"].append(tier)
                    out["step_group"].append(task + (group << 12) + tier)
                    out["ids"].append(part.tobytes() if with_ids else None)
                    offset += p.length
                    whole[p.doc] -= p.length
                    if not whole[p.doc]:
                        del held[p.doc], whole[p.doc]
                made += 1
            packer.done.clear()
            arrays = [pa.array(out["doc_id"], id_type), *(pa.array(out[k], pa.int64()) for k in (
                "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")),
                pa.array(out["tier"], pa.int32()), pa.array(out["step_group"], pa.int64())]
            names = [k for k in out if k != "ids"]
            if with_ids:
                arrays.append(pa.array(out["ids"], pa.binary()))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            keys = batch.column(0).to_pylist()
            for first, texts in tokens.in_pieces(batch.column(1).to_pylist()):
                for i, ids in enumerate(encode(texts)):
                    ids += END_ID.to_bytes(2, "little")
                    total = len(ids) >> 1
                    held[n] = (keys[first + i], np.frombuffer(ids, "<u2"), 0, total)
                    whole[n] = total
                    packer.add(n, total)
                    n += 1
                yield emit()
                for doc in range(n - len(texts), n):  # windows are out: only the rest is kept
                    if doc in held and held[doc][3] >= packer.tiers[-1]:
                        doc_id, ids, _, total = held[doc]
                        rest = total % packer.tiers[-1]
                        held[doc] = (doc_id, ids[-rest:].copy(), total - rest, total)
        if id_type is not None:
            packer.finish()
            yield emit()

    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long, tier int, step_group long" + (", ids binary" if with_ids else ""))
    return docs.select(id_col, text_col).mapInArrow(run, schema)
