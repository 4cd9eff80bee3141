"""From raw documents to packed sequences: five stages, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplierlens.llm import exact_dedup, minhash_dedup, packing, quality_rules, substring_dedup
from supplierlens.llm.common import documents, written
from supplierlens.llm.tokens import tokenizer_path


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the ids of ``dropped``; a row without an id stays."""
    gone = written(dropped.select(F.col("doc_id").alias("_gone")).distinct(), "dropped-ids")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.passing(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, with the operator's verdict on the row's own text.

    An id, or no id, may be on several texts: rows are dropped by id and hash of the text. Of
    rows alike in both, which the operator treats as one, the longest original stays.
    """
    verdicts = exact_dedup.exact_dedup(docs, hash_all=True).where("NOT kept")
    gone = written(verdicts.select(F.col("doc_id").alias("_gone"), F.col("text_sha256").alias("_gone_sha"))
                   .distinct(), "dropped-texts")
    hashed = docs.withColumn("_sha", F.sha2(exact_dedup.normalised(F.col("text")), 256))
    kept = hashed.join(gone, (F.col("_sha") == F.col("_gone_sha")) & F.col("doc_id").eqNullSafe(F.col("_gone")),
                       "left_anti")
    longest = F.struct(F.char_length("text"), F.xxhash64("text"))
    return (kept.groupBy(F.col("doc_id").alias("_id"), "_sha")
            .agg(F.max_by(F.struct(*docs.columns), longest).alias("_row")).select("_row.*"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return _without(docs, minhash_dedup.minhash_dedup(docs).where("NOT kept"))


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without words that a non-first place of a repeated span covers.

    n_chars follows the text; a document may become empty, and stays.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = substring_dedup.substring_dedup(docs, carry=others)
    columns = {c: F.col(f"carried.{c}") for c in others}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences of at most 2048."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near-duplicate dedup", near),
          ("substring dedup", substring), ("packing", packed)]

#: Shingle hashes, content-picked sentence cuts and tokens have no SQL form; the tests hold
#: the stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet and read again for the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
