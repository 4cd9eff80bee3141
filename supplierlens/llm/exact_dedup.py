"""Exact dedup by progressive refinement: length, then hash of the beginning, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplierlens.llm.common import BLANKS, without, written

HEAD_CHARS = 64
#: Size of the bit set that marks the surviving (length, beginning) groups in the last scan:
#: 2^22 bits are at most 129 rows of 4 KB, whatever the corpus holds, so it may be broadcast.
#: Two groups that fall on one bit cost a needless hash, never a wrong result.
MARK_BITS = 1 << 22


def normalised(text: Column) -> Column:
    """The text without blanks; texts are equal when this is."""
    return without(F.coalesce(text, F.lit("")), BLANKS)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the longest original stays, then the smallest id, a null id last. A null
    text is an empty one, and empty texts are equal. Rows repeated under one id count in
    group_size and stand or fall together. Other columns of ``docs`` are not looked at. An
    empty table gives an empty one. text_sha256 is null where neither length nor beginning
    is shared, unless ``hash_all``: such a text is never hashed.

    The first scan measures; the groups that share a length, and of these the ones that
    share a beginning, are found on ids and numbers alone. The second scan hashes whole
    texts of the survivors. No text is shuffled, and counts combine before each shuffle, so
    a text that a third of all rows hold is one row of a partial aggregate.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    norm = base.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("chars"),
                       normalised(F.col("text")).alias("norm"))
    keyed = norm.withColumn("size", F.octet_length("norm")).withColumn(
        "head", F.xxhash64("size", F.substring("norm", 1, HEAD_CHARS)))

    measured = written(keyed.select("size", "head"), "exact-dedup-measures")
    lengths = measured.groupBy("size").count().where("count > 1").select("size")
    heads = (measured.join(lengths, "size", "left_semi")
             .groupBy("head").count().where("count > 1").select("head"))

    slot = F.pmod("head", F.lit(MARK_BITS))
    marks = (heads.select(slot.alias("slot"))
             .select(F.bitmap_bucket_number("slot").alias("bucket"),
                     F.bitmap_bit_position("slot").alias("bit"))
             .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))
    bit = F.bitmap_bit_position("slot")
    byte = F.conv(F.hex(F.substring("bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = (keyed.withColumn("slot", slot)
              .withColumn("bucket", F.bitmap_bucket_number("slot"))
              .join(F.broadcast(marks), "bucket", "left")
              .withColumn("shared", F.coalesce(
                  byte.bitwiseAND(
                      F.call_function("shiftleft", F.lit(1), (bit % 8).cast("int"))) != 0,
                  F.lit(False))))
    digest = F.sha2(F.col("norm"), 256)
    hashed = marked.select("doc_id", "chars", "shared",
                           (digest if hash_all else F.when(F.col("shared"), digest)).alias("text_sha256"))

    best = F.min(F.struct((-F.col("chars")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"),
                          F.col("doc_id").alias("keep_id")))
    hashed = written(hashed, "exact-dedup-hashes")
    groups = written(
        hashed.where("shared").groupBy("text_sha256")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select(F.col("text_sha256").alias("group_sha"), F.col("best.keep_id").alias("best_id"), "n"),
        "exact-dedup-groups")
    joined = hashed.join(groups, F.col("text_sha256") == F.col("group_sha"), "left")
    in_group = F.col("n").isNotNull()
    keep = F.when(in_group, F.col("best_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256")
