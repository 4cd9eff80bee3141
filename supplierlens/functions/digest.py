"""Order-free digests of columns, the same in any engine with MD5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Digests are whole numbers below this.
MODULUS = 1 << 61


def plain_text(df: DataFrame, name: str) -> Column:
    """A value as text that does not depend on an engine's number or date formats: numbers to
    three digits, timestamps to the second; null for null."""
    kind, x = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.round(x.cast("double") * 1000).cast("long").cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(x, "yyyyMMddHHmmss")
    return x.cast("string")


def digest(text: Column) -> Column:
    """Sum of 32 bits of each text's MD5, modulo MODULUS: rows in any order give the same, and
    a row that is lost, doubled, cut or shifted to another column gives another."""
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("decimal(20,0)")
    return F.coalesce(F.sum(bits) % F.lit(MODULUS).cast("decimal(20,0)"), F.lit(0)).cast("long")


def row_digest(df: DataFrame) -> Column:
    """Digest of whole rows, columns by name."""
    return digest(F.concat_ws("|", *[F.coalesce(plain_text(df, c), F.lit("~")) for c in sorted(df.columns)]))


def column_digests(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One row per column: rows, filled rows and the digest of the values."""
    sums = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(f"`{c}`").alias(f"{c}_n") for c in columns],
                  *[digest(plain_text(df, c)).alias(f"{c}_d") for c in columns])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col("_rows").alias("rows_total"),
                 F.col(f"{c}_n").alias("rows_populated"), F.col(f"{c}_d").alias("value_digest")) for c in columns])))
