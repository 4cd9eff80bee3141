"""Inputs, written tables and column helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplierlens.session import work_folder

#: The characters that separate words: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    This cuts the lineage at a place all executors see: a lost executor costs the tasks it
    was running, never the stages that made the table. An aggregate that is joined back to
    its rows is written too: the join then shuffles both sides for itself, and adaptive
    execution can split the rows of a key that a large part of the table shares.
    """
    spark = df.sparkSession
    folder = work_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def without(text: Column, characters: str) -> Column:
    """``text`` with every one of ``characters`` deleted."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, and only where the whole is computed."""
    return F.transform(F.array(value), body)[0]
