"""Quality of the vendor master: completeness, duplicates, review list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplierlens.functions.text import is_blank, upper_key

# Required field -> label, in reporting order.
REQUIRED_FIELDS = {"vendor_name": "VENDOR NAME", "address_line_1": "ADDRESS",
                   "postal_code": "POSTAL CODE"}
DUPLICATE_KEY = ["vendor_name_key", "address_key", "postal_code_key"]


def with_completeness(vendors: DataFrame) -> DataFrame:
    labels = [F.when(is_blank(F.col(c)), label) for c, label in REQUIRED_FIELDS.items()]
    listed = F.concat_ws(", ", *labels)
    return vendors.withColumns({
        "vendor_quality_status": F.when(listed == "", "COMPLETE").otherwise("INCOMPLETE"),
        "missing_components": F.when(listed != "", listed),
    })


def with_keys(vendors: DataFrame) -> DataFrame:
    return vendors.withColumns({
        "vendor_name_key": upper_key(F.col("vendor_name")),
        "address_key": upper_key(F.col("address_line_1")),
        "postal_code_key": upper_key(F.col("postal_code")),
    })


def duplicate_groups(vendors: DataFrame) -> DataFrame:
    """Keys held by several COMPLETE vendors, with the number of holders.

    An aggregation instead of a window over the key: it combines map-side, so a key
    shared by a third of all vendors never gathers in one task. COMPLETE rows have no
    missing key part and INCOMPLETE rows always do, so the two never share a key.
    """
    return (
        vendors.where("vendor_quality_status = 'COMPLETE'").groupBy(*DUPLICATE_KEY)
        .agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    )


def with_exact_duplicates(vendors: DataFrame) -> DataFrame:
    vendors = with_keys(vendors)
    groups = duplicate_groups(vendors)
    return (
        vendors.join(groups, DUPLICATE_KEY, "left")
        .withColumn("exact_duplicate_flag", F.col("copies").isNotNull()).drop("copies")
    )


def candidate_counts(vendors: DataFrame, keys: list[str], name: str) -> DataFrame:
    """INCOMPLETE vendors with the number of COMPLETE vendors sharing ``keys``."""
    known = vendors.where("vendor_quality_status = 'COMPLETE'")
    for c in keys:
        known = known.where(F.col(c).isNotNull())
    known = known.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return (
        vendors.where("vendor_quality_status = 'INCOMPLETE'").join(known, keys, "left")
        .withColumn(name, F.coalesce(F.col(name), F.lit(0)))
    )


def with_review_status(vendors: DataFrame) -> DataFrame:
    incomplete = F.col("vendor_quality_status") == "INCOMPLETE"
    return vendors.withColumns({
        "review_required": incomplete | F.col("exact_duplicate_flag"),
        "review_reason": F.when(F.col("exact_duplicate_flag"), "EXACT DUPLICATE")
        .when(incomplete, F.concat(F.lit("MISSING: "), F.col("missing_components"))),
    })


def assess(vendors: DataFrame) -> DataFrame:
    return with_review_status(with_exact_duplicates(with_completeness(vendors)))


def missing_field_counts(vendors: DataFrame) -> DataFrame:
    """Blank values per required field among INCOMPLETE vendors."""
    rows = [F.struct(F.lit(c).alias("field"), F.col(c).alias("missing")) for c in REQUIRED_FIELDS]
    return (
        vendors.where("vendor_quality_status = 'INCOMPLETE'")
        .agg(*[F.count_if(is_blank(F.col(c))).alias(c) for c in REQUIRED_FIELDS])
        .select(F.inline(F.array(*rows)))
    )


def duplicate_totals(vendors: DataFrame) -> DataFrame:
    return duplicate_groups(vendors).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("duplicate_records"),
        F.count(F.lit(1)).alias("duplicate_groups"),
    )


def quality_summary(vendors: DataFrame) -> DataFrame:
    """Rows by status, by review reason, and in total (one pass over the vendors)."""
    counted = vendors.groupBy("vendor_quality_status", "review_reason", "review_required").agg(
        F.count(F.lit(1)).alias("n"))
    rows = F.array(
        F.struct(F.lit("quality status").alias("section"),
                 F.col("vendor_quality_status").alias("value")),
        F.struct(F.lit("review reason").alias("section"), F.col("review_reason").alias("value")),
        F.struct(F.lit("total").alias("section"),
                 F.when(F.col("review_required"), "review required").alias("value")),
        F.struct(F.lit("total").alias("section"), F.lit("vendor records").alias("value")),
    )
    return (
        counted.select("n", F.inline(rows)).where(F.col("value").isNotNull())
        .groupBy("section", "value").agg(F.sum("n").alias("vendors"))
    )
