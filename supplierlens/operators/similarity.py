"""Look-alike vendors: INCOMPLETE records against COMPLETE ones in the same city and state.

Listing every pair of a city is quadratic in the city's size, so pairs are found through
shared character tokens and only those that reach ``min_similarity`` come out. No pair at
or above the threshold is missed:

* A ratio r of two strings with T characters in total means M = r*T/2 matched ones, in
  blocks with at least one unmatched character between neighbours, so at most
  T - 2M + 1 blocks. The strings then share at least M single characters and
  3M - T - 1 neighbouring pairs, counted with repetition.
* Two token sets that share k tokens meet within the first n - k + 1 tokens of each,
  under any one ordering of all tokens. Tokens rare in the city are put first, so few
  strangers meet.
* A token at places i and j of the two orderings leaves room for min(i, j) shared tokens
  before it and for no more after it than the shorter rest; pairs without room are dropped.
"""

from __future__ import annotations

import difflib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from supplierlens.functions.text import upper_key
from supplierlens.operators.skew import HEAVY_ROWS, heavy_keys, salted_join
from supplierlens.session import written

BLOCK = ["city_key", "state_key"]


@F.pandas_udf(DoubleType())
def similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Ratcliff/Obershelp ratio times 100; argument order matters, NULL gives NULL.

    Spark has no built-in with this definition. Only surviving pairs get here, in Arrow
    batches, and the matcher keeps its index of the second text between equal neighbours.
    """
    for left, right in batches:
        matcher, current = difflib.SequenceMatcher(None), None
        out = []
        for a, b in zip(left, right):
            if a is None or b is None or pd.isna(a) or pd.isna(b):
                out.append(None)
                continue
            if b != current:
                matcher.set_seq2(b)
                current = b
            matcher.set_seq1(a)
            out.append(matcher.ratio() * 100)
        yield pd.Series(out, dtype="float64")


def _located(vendors: DataFrame) -> DataFrame:
    keyed = vendors.withColumns({"city_key": upper_key(F.col("city")),
                                 "state_key": upper_key(F.col("state_province"))})
    return keyed.where((F.col("city_key") != "") & (F.col("state_key") != ""))


def location_candidate_counts(vendors: DataFrame) -> DataFrame:
    """Per located INCOMPLETE vendor, how many COMPLETE vendors share city and state."""
    located = _located(vendors)
    sizes = located.where("vendor_quality_status = 'COMPLETE'").groupBy(*BLOCK).agg(
        F.count(F.lit(1)).alias("location_candidates"))
    return (
        located.where("vendor_quality_status = 'INCOMPLETE'").join(sizes, BLOCK, "left")
        .withColumn("location_candidates", F.coalesce("location_candidates", F.lit(0)))
    )


def _tokens(text: Column) -> Column:
    """Characters and neighbouring pairs, repeats numbered so that sets count repetition."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.size(chars)
    pairs = F.when(
        n > 1,
        F.zip_with(F.slice(chars, F.lit(1), F.greatest(n - 1, F.lit(1))),
                   F.slice(chars, F.lit(2), F.greatest(n - 1, F.lit(1))),
                   lambda a, b: F.concat(a, b)),
    ).otherwise(F.array().cast("array<string>"))

    def numbered(parts: Column) -> Column:
        # The k-th occurrence of a part is its own token.
        return F.transform(parts, lambda p, i: F.concat(
            p, F.lit("\u0001"),
            F.size(F.filter(F.slice(parts, F.lit(1), i + 1), lambda q: q == p)).cast("string")))

    return F.concat(numbered(chars), numbered(pairs))


def _shared(characters: Column, ratio: float) -> Column:
    """Tokens that two texts of so many characters together share at ``ratio``, at least."""
    matched = F.ceil(characters * (ratio / 2.0) - 1e-9)
    return F.greatest(matched + F.greatest(3 * matched - F.ceil(characters) - 1, F.lit(0)), F.lit(1))


def _prefix_length(length: Column, ratio: float) -> Column:
    """How many of a text's first tokens must be looked at; whole number, never too few."""
    total = length * (2.0 / (2.0 - ratio))
    matched = F.ceil(total * (ratio / 2.0) - 1e-9)
    shared = matched + F.greatest(F.ceil(total * (1.5 * ratio - 1.0) - 1.0 - 1e-9), F.lit(0))
    tokens = length * 2 - 1
    return F.greatest(tokens - F.greatest(shared, F.lit(1)) + 1, F.lit(1)).cast("int")


def _prefixes(named: DataFrame, ratio: float, heavy_rows: int) -> DataFrame:
    """Each vendor's first tokens with their positions, those rare in its own city first.

    A token that most vendors of a large city have is a heavy key of the join with the counts;
    the counts themselves tell which these are.
    """
    key = [*BLOCK, "token"]
    listed = named.select("company_id", "vendor_quality_status", *BLOCK, "name_length",
                          F.explode(_tokens(F.col("vendor_name_key"))).alias("token"))
    rarity = written(listed.groupBy(*key).agg(F.count(F.lit(1)).alias("uses")), "token-uses")
    ranked = salted_join(listed, rarity, key, heavy_keys(rarity, key, "uses", heavy_rows), F.col("company_id"))
    # Each vendor gathers only its own tokens, twice its name length at most.
    ranked = ranked.groupBy("company_id", "vendor_quality_status", *BLOCK, "name_length").agg(
        F.array_sort(F.collect_list(F.struct("uses", "token"))).alias("ranked"))
    return ranked.select(
        "company_id", "vendor_quality_status", *BLOCK, "name_length",
        F.posexplode(F.slice("ranked", F.lit(1), _prefix_length(F.col("name_length"), ratio))).alias("position", "entry")
    ).select("company_id", "vendor_quality_status", *BLOCK, "name_length", "position", "entry.token")


def candidate_pairs(named: DataFrame, ratio: float, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """(incomplete, complete) vendors of a city that share a prefix token, have lengths that
    allow ``ratio``, and whose token positions leave room for enough shared tokens.

    Lengths are in steps of the largest quotient that two look-alikes can have, so a partner's
    step is the same or the next on either side, and the step is part of the join key.
    """
    step = F.floor(F.log(F.col("name_length").cast("double")) / math.log((2.0 - ratio) / ratio) + 1e-9).cast("int") \
        if ratio < 1 else F.col("name_length")
    first = written(_prefixes(named, ratio, heavy_rows).withColumn("step", step), "name-prefixes")

    def side(status: str, tag: str, steps: Column) -> DataFrame:
        return first.where(F.col("vendor_quality_status") == status).select(
            *BLOCK, "token", steps.alias("step"), F.col("company_id").alias(f"company_id_{tag}"),
            F.col("name_length").alias(f"length_{tag}"), F.col("position").alias(f"position_{tag}"))

    near = F.explode(F.array(F.col("step") - 1, F.col("step"), F.col("step") + 1)) if ratio < 1 else F.col("step")
    incomplete, complete = side("INCOMPLETE", "incomplete", near), side("COMPLETE", "complete", F.col("step"))
    key = [*BLOCK, "token", "step"]
    heavy = heavy_keys(complete.groupBy(*key).agg(F.count(F.lit(1)).alias("n")), key, "n", heavy_rows)
    met = salted_join(complete, incomplete, key, heavy, F.col("company_id_complete"))
    shorter, both = F.least("length_incomplete", "length_complete"), F.col("length_incomplete") + F.col("length_complete")
    before = F.least("position_incomplete", "position_complete")
    after = F.least(2 * F.col("length_incomplete") - 2 - F.col("position_incomplete"),
                    2 * F.col("length_complete") - 2 - F.col("position_complete"))
    return met.where((shorter * 2 >= both * ratio - 1e-9) & (before + 1 + after >= _shared(both, ratio))).select(
        "company_id_incomplete", "company_id_complete").distinct()


def look_alikes(vendors: DataFrame, min_similarity: float = 85.0, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Pairs whose name similarity is at least ``min_similarity`` (above 0, up to 100)."""
    if not 0 < min_similarity <= 100:
        raise ValueError("min_similarity must be above 0 and at most 100")
    named = _located(vendors).where(F.col("vendor_name_key") != "").select(
        "company_id", "vendor_quality_status", *BLOCK, "vendor_name_key", "address_key",
        F.length("vendor_name_key").alias("name_length"))
    pairs = candidate_pairs(named, min_similarity / 100.0, heavy_rows)

    def details(tag: str) -> DataFrame:
        return named.select(F.col("company_id").alias(f"company_id_{tag}"),
                            F.col("vendor_name_key").alias(f"vendor_name_key_{tag}"),
                            F.col("address_key").alias(f"address_key_{tag}"),
                            *(BLOCK if tag == "incomplete" else []))

    scored = (
        pairs.join(details("incomplete"), "company_id_incomplete")
        .join(details("complete"), "company_id_complete")
        .withColumn("name_similarity",
                    similarity(F.col("vendor_name_key_incomplete"), F.col("vendor_name_key_complete")))
        .where(F.col("name_similarity") >= min_similarity)
    )
    return scored.withColumn(
        "address_similarity",
        similarity(F.col("address_key_incomplete"), F.col("address_key_complete")))
