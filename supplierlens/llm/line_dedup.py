"""Line dedup: lines that many documents share go, except from one of these documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplierlens.llm.common import BLANKS, written

MIN_CHARS = 20
MIN_DOCUMENTS = 3


def line_key(line: str) -> str:
    """The line without blanks at its ends and with A-Z in lower case."""
    line = line.strip(BLANKS)
    return line.lower() if line.isascii() else line.encode().lower().decode()


def _hash(key: str) -> bytes:
    return hashlib.blake2b(key.encode(), digest_size=16).digest()


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """One row per row of ``docs``: id, text (what is left of it), n_lines, n_dropped.

    A key of ``min_chars`` code points or more that ``min_documents`` ids hold loses all its
    lines, but for those under the largest of these ids. The lines that stay keep their
    order, joined by a line feed. Null and empty texts are one empty line. Rows repeated
    under one id count as one document and are treated alike; a null id counts as a document
    and is never the largest. Other columns are not looked at; an empty table gives an empty
    one.

    Only 16-byte hashes of keys and ids are exploded. They are reduced to one row per key and
    id, then per key, each time combined before the shuffle, so a line that every document
    holds reaches a task as one row per map task. What a document loses comes back as a list
    of its own keys, never longer than the document.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                own = {line_key(x) for x in (text or "").split("\n") if len(x) >= min_chars}
                found.append([_hash(k) for k in own if len(k) >= min_chars])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.binary()))], ["doc_id", "keys"])

    id_type = base.schema["doc_id"].dataType.simpleString()
    held = (base.mapInArrow(keys, f"doc_id {id_type}, keys array<binary>")
            .select("doc_id", F.explode("keys").alias("key")).distinct())
    shared = written(held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("stays"))
                     .where(F.col("n") >= min_documents).select("key", "stays"), "line-shared")
    lost = (held.join(shared, "key").where(~F.col("doc_id").eqNullSafe(F.col("stays")))
            .groupBy(F.col("doc_id").alias("lost_id")).agg(F.collect_list("key").alias("lost")))

    def remaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, dropped = [], [], []
            for text, lost_keys in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                parts = (text or "").split("\n")
                stay = parts
                if lost_keys:
                    gone = set(lost_keys)
                    stay = [x for x in parts
                            if len(x) < min_chars or _hash(line_key(x)) not in gone]
                texts.append("\n".join(stay))
                lines.append(len(parts))
                dropped.append(len(parts) - len(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(lines, pa.int64()),
                 pa.array(dropped, pa.int64())], ["doc_id", "text", "n_lines", "n_dropped"])

    return (base.join(lost, base["doc_id"].eqNullSafe(lost["lost_id"]), "left")
            .select("doc_id", "text", "lost")
            .mapInArrow(remaining, f"doc_id {id_type}, text string, n_lines long, n_dropped long"))
