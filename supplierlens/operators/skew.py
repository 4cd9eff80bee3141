"""Joins on keys of which a few hold a large part of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that one task is given; a key with more is dealt out over several.
HEAVY_ROWS = 500_000
#: Salts of rows with a null key.
NULL_SALTS = 1 << 16


def heavy_keys(counts: DataFrame, keys: list[str], count: str, rows: int = HEAVY_ROWS) -> DataFrame:
    """Keys of over ``rows`` rows and the salts they get, from one row per key with its count.

    There are fewer such keys than rows in all divided by ``rows``, which is why the result may
    be broadcast.
    """
    return counts.where(F.col(count) > rows).select(*keys, F.ceil(F.col(count) / rows).cast("int").alias("_salts"))


def salted_join(many: DataFrame, few: DataFrame, keys: list[str], heavy: DataFrame, deal_by: Column,
                how: str = "inner", keep_salt: bool = False) -> DataFrame:
    """``many`` joined to ``few`` on ``keys``, each heavy key spread over its salts.

    Rows of ``many`` take a salt by the hash of ``deal_by``; rows of ``few`` are repeated once
    per salt. Other keys have one salt, so they are joined as ever. No row meets a row of
    ``few`` twice. A null key meets nothing; its rows are dealt out too, since a shuffle would
    bring all of them into one task. With ``keep_salt`` the result has ``_salt``, so that a
    later step by the keys, the salt and more needs no shuffle of its own.
    """
    spread = F.broadcast(heavy)
    salts = F.coalesce("_salts", F.when(reduce(or_, [F.col(k).isNull() for k in keys]), NULL_SALTS), F.lit(1))
    left = many.join(spread, keys, "left").withColumn(
        "_salt", F.when(salts > 1, F.pmod(F.xxhash64(deal_by), salts)).otherwise(0).cast("int")).drop("_salts")
    right = few.join(spread, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    out = left.join(right, [*keys, "_salt"], how)
    return out if keep_salt else out.drop("_salt")


def looked_up(many: DataFrame, few: DataFrame, keys: list[str], deal_by: list[str],
              rows: int = HEAVY_ROWS, keep_salt: bool = False) -> DataFrame:
    """``many`` left-joined to ``few``, which has one row per key; heavy keys are measured first.

    Counting the keys reads only the columns that they are made of, and combines before its
    shuffle, so a key that a third of the rows share costs one count per task. Rows are dealt
    by those of ``deal_by`` that they have; these should tell rows apart.
    """
    counted = many.where(reduce(and_, [F.col(k).isNotNull() for k in keys])).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"))
    own = [c for c in deal_by if c in many.columns]
    return salted_join(many, few, keys, heavy_keys(counted, keys, "_rows", rows), F.xxhash64(*own), "left", keep_salt)
