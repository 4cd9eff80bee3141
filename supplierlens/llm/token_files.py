"""Token files: one array of ids in document order, with Elias-Fano coded boundaries."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from supplierlens.llm import tokens

END_ID = 1
#: A block of a file closes with the document that brings it to this many ids.
BLOCK_IDS = 1 << 20
#: One in so many set bits has its place stored.
SELECT_EVERY = 256


@dataclass(frozen=True)
class EliasFano:
    """A sequence of n numbers that never falls, 0 to ``top``, in about n * (2 + log2(top / n)) bits.

    The low bits of each number stand side by side; of the high parts, number i sets bit
    high(i) + i. The place of every SELECT_EVERY-th set bit is stored, so number i is found
    by reading the bits between two such places.
    """

    n: int
    low_bits: int
    low: bytes
    high: bytes
    select: bytes

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        values = values.astype(np.uint64)
        bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1, np.uint8)
        high[places] = 1
        low = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        return cls(n, bits, np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes(),
                   np.packbits(high, bitorder="little").tobytes(),
                   places[::SELECT_EVERY].astype("<u4").tobytes())

    def __getitem__(self, i: int) -> int:
        select = np.frombuffer(self.select, "<u4")
        nth, rest = divmod(i, SELECT_EVERY)
        at = int(select[nth])
        end = int(select[nth + 1]) if nth + 1 < len(select) else 8 * len(self.high) - 1
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8)[at >> 3:(end >> 3) + 1], bitorder="little")
        place = at + int(np.flatnonzero(bits[at & 7:])[rest])
        low = 0
        for j in range(self.low_bits):
            k = i * self.low_bits + j
            low |= (self.low[k >> 3] >> (k & 7) & 1) << j
        return ((place - i) << self.low_bits) | low

    def find(self, value: int) -> int:
        """Place of the first number of at least ``value``, by halving; n if there is none."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            if self[middle] < value:
                low = middle + 1
            else:
                high = middle
        return low

    def all(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.int64)
        places = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        out = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            low = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little", count=self.n * self.low_bits)
            out |= low.reshape(self.n, -1).astype(np.uint64) @ (
                np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))
        return out.astype(np.int64)


_CODED = ("n int", "low_bits int", "low binary", "high binary", "select binary")
_FANO = "struct<" + ", ".join(x.replace(" ", ": ") for x in _CODED) + ">"
FILE_SCHEMA = (f"shard int, block int, n_ids long, without_id int, first_id long, last_id long, ids binary, "
               f"ends {_FANO}, doc_ids {_FANO}")


def _fano_type() -> pa.DataType:
    return pa.struct([("n", pa.int32()), ("low_bits", pa.int32()), ("low", pa.binary()), ("high", pa.binary()),
                      ("select", pa.binary())])


def write_token_files(docs: DataFrame, folder: str, path: str, id_col: str = "doc_id",
                      text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Writes the ids of ``docs`` below ``folder``, in ascending order of the id column.

    A document's ids are those of its whole text by the tokenizers library from ``path``,
    then END_ID; a null or empty text has END_ID alone. Documents without an id come first.
    Rows repeated under one id follow each other in no set order. Other columns are not
    written; an empty table gives no blocks.

    Texts are dealt out by ranges of ids and encoded after that, so ids are made once and
    never shuffled. Rows under one id, or without one, are dealt out by a hash of their text.
    Each task writes one shard: blocks of about ``block_ids`` ids, whole
    documents each, as 16-bit little-endian numbers, with Elias-Fano codes for where the
    documents end in the block and for their ids less the first one. The files are Parquet,
    whose committer leaves out what a lost task wrote.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    dealt = base.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path).encode
        shard, block = TaskContext.get().partitionId(), 0
        ids: list[bytes] = []
        keys: list[int | None] = []
        size = 0

        def closed() -> pa.RecordBatch:
            named = np.array([k for k in keys if k is not None], np.int64)
            first = int(named[0]) if len(named) else 0
            ends = EliasFano.of(np.cumsum([len(x) >> 1 for x in ids]))
            row = {"shard": shard, "block": block, "n_ids": size, "without_id": len(keys) - len(named),
                   "first_id": first, "last_id": int(named[-1]) if len(named) else None,
                   "ids": b"".join(ids), "ends": vars(ends),
                   "doc_ids": vars(EliasFano.of(named.view(np.uint64) - np.uint64(first % (1 << 64))))}
            return pa.RecordBatch.from_pylist([row], pa.schema([
                ("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("without_id", pa.int32()),
                ("first_id", pa.int64()), ("last_id", pa.int64()), ("ids", pa.binary()), ("ends", _fano_type()),
                ("doc_ids", _fano_type())]))

        for batch in batches:
            own = batch.column(0).to_pylist()
            for at, texts in tokens.in_pieces(batch.column(1).to_pylist()):
                for i, got in enumerate(encode(texts)):
                    ids.append(got + END_ID.to_bytes(2, "little"))
                    keys.append(own[at + i])
                    size += len(ids[-1]) >> 1
                    if size >= block_ids:
                        yield closed()
                        ids, keys, size, block = [], [], 0, block + 1
        if keys:
            yield closed()

    dealt.mapInArrow(run, FILE_SCHEMA).write.parquet(folder)


def _block_starts(files: DataFrame) -> DataFrame:
    """(of_shard, of_block, block_start): ids before each block."""
    sizes = files.select("shard", "block", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("shard_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("shard_ids").over(before), F.lit(0)).alias("shard_start"))
    return (sizes.join(shards, "shard")
            .select(F.col("shard").alias("of_shard"), F.col("block").alias("of_block"),
                    (F.col("shard_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("block_start")))


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (of its ids as 32-bit little-endian numbers), and with ``with_ids`` its ids.

    Blocks are decoded where they lie. Where a block starts is a running sum over one short
    row per block of a shard, then over one row per shard.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    starts = _block_starts(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for i in range(len(batch)) for r in batch.slice(i, 1).to_pylist()):
                ends = EliasFano(**row["ends"]).all()
                begins = np.concatenate([[0], ends[:-1]])
                named = EliasFano(**row["doc_ids"]).all().view(np.uint64) + np.uint64(row["first_id"] % (1 << 64))
                keys = [None] * row["without_id"] + named.view(np.int64).tolist()
                ids = np.frombuffer(row["ids"], "<u2")
                parts = [ids[a:b] for a, b in zip(begins, ends, strict=True)]
                n = len(keys)
                arrays = [pa.array([row["shard"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32()),
                          pa.array(keys, pa.int64()), pa.array(begins, pa.int64()), pa.array(ends - begins, pa.int64()),
                          pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in parts], pa.int64())]
                names = ["shard", "block", "doc_id", "place", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([p.tobytes() for p in parts], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    extra = ["ids"] if with_ids else []
    docs = files.mapInArrow(run, "shard int, block int, doc_id long, place long, n_tokens long, ids_crc32 long"
                            + (", ids binary" if with_ids else ""))
    return (docs.join(starts, (F.col("shard") == F.col("of_shard")) & (F.col("block") == F.col("of_block")))
            .select("doc_id", (F.col("block_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *extra))


def look_up(spark: SparkSession, folder: str, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents of ``wanted`` alone: doc_id, start, n_tokens, ids_crc32, ids.

    A document that is wanted twice is returned once, one whose id has several rows with each
    of them; null and unknown ids return nothing. Wanted ids are dealt to the shards that may
    hold them (the driver knows two numbers per shard, and there are no more shards than tasks
    that wrote), then joined to blocks by their ranges of ids. In a block the place of an
    id and the ends of its documents are read through the select structures, so nothing of
    the block is decoded but the documents asked for.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    named = files.where("last_id IS NOT NULL").select("shard", "block", "first_id", "last_id")
    bounds = sorted(tuple(r) for r in named.groupBy("shard").agg(F.min("first_id"), F.max("last_id")).collect())
    shards, firsts, lasts = (np.array(x, np.int64) for x in (zip(*bounds, strict=True) if bounds else ([], [], [])))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            # Shards are in order of their ids: those from the first that ends at or after an id
            # to the last that begins at or before it.
            low, high = np.searchsorted(lasts, ids, "left"), np.searchsorted(firsts, ids, "right")
            times = np.maximum(high - low, 0)
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, times), pa.int64()),
                                              pa.array(shards[np.repeat(low, times) + nth], pa.int32())], ["wanted", "shard"])

    asked = wanted.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    by_block = (asked.mapInArrow(deal, "wanted long, shard int").join(named, "shard")
                .where("wanted BETWEEN first_id AND last_id")
                .groupBy(F.col("shard").alias("in_shard"), F.col("block").alias("in_block"))
                .agg(F.collect_list("wanted").alias("wanted")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for i in range(len(batch)) for r in batch.slice(i, 1).to_pylist()):
                ends, doc_ids = EliasFano(**row["ends"]), EliasFano(**row["doc_ids"])
                ids = np.frombuffer(row["ids"], "<u2")
                out = []
                for key in sorted(row["wanted"]):
                    i = doc_ids.find(key - row["first_id"])
                    while i < doc_ids.n and doc_ids[i] == key - row["first_id"]:
                        k = i + row["without_id"]
                        begin, end = ends[k - 1] if k else 0, ends[k]
                        own = ids[begin:end]
                        out.append((key, row["block_start"] + begin, end - begin,
                                    zlib.crc32(own.astype("<u4").tobytes()), own.tobytes()))
                        i += 1
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("doc_id", "start", "n_tokens", "ids_crc32", "ids"), x, strict=True)) for x in out],
                    pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                               ("ids_crc32", pa.int64()), ("ids", pa.binary())]))

    held = (files.join(by_block, (F.col("shard") == F.col("in_shard")) & (F.col("block") == F.col("in_block")))
            .join(_block_starts(files), (F.col("shard") == F.col("of_shard")) & (F.col("block") == F.col("of_block")))
            .select("first_id", "without_id", "ids", "ends", "doc_ids", "wanted", "block_start"))
    return held.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
