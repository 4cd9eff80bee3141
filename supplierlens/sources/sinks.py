"""Writing result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from supplierlens.functions.digest import row_digest


def write_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Write each table below ``folder`` and return its path."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}"
        writer = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.save(paths[name])
    return paths


def write_result_set(tables: dict[str, DataFrame], folder: str) -> None:
    """Write tables as one set: a manifest with each table's rows and digest follows when all
    of them are complete, so a set without one was never finished."""
    spark = next(iter(tables.values())).sparkSession
    paths = write_tables(tables, folder)
    measured(spark, paths).coalesce(1).write.mode("overwrite").parquet(f"{folder}/_manifest_of_tables")


def measured(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows and digest of written tables, as they are read back."""
    out = None
    for name, path in paths.items():
        df = spark.read.parquet(path)
        one = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"), row_digest(df).alias("value_digest"))
        out = one if out is None else out.unionByName(one)
    return out


def read_result_set(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a complete set; fails where the manifest is missing or a table is not
    what the manifest says."""
    try:
        listed = {r["table_name"]: r for r in spark.read.parquet(f"{folder}/_manifest_of_tables").collect()}
    except AnalysisException:
        raise IncompleteSet(f"{folder} has no manifest") from None
    found = {r["table_name"]: r for r in measured(spark, {n: f"{folder}/{n}" for n in listed}).collect()}
    wrong = [n for n in listed if found[n] != listed[n]]
    if wrong:
        raise IncompleteSet(f"{folder}: other rows than in the manifest: {wrong}")
    return {n: spark.read.parquet(f"{folder}/{n}") for n in listed}


class IncompleteSet(ValueError):
    """Tables that were not written as a whole."""


def read_row_counts(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """What was written, read back: one row per table."""
    out = None
    for name, path in paths.items():
        reader = spark.read.format(fmt)
        if fmt == "csv":
            reader = reader.option("header", True)
        one = reader.load(path).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        out = one if out is None else out.unionByName(one)
    return out
