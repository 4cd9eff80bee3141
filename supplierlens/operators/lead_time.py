"""Lead-time adherence against the item master."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplierlens.functions.dates import days_floor
from supplierlens.functions.numeric import flag, lead_time_days, part_key
from supplierlens.functions.text import upper_key
from supplierlens.operators.skew import HEAVY_ROWS, looked_up

#: Columns that tell order lines apart.
LINE_KEY = ["po_number", "line_no", "order_date", "last_receipt_date"]


def _keyed(items: DataFrame) -> DataFrame:
    return items.select(
        part_key(items).alias("part_number_match_key"),
        lead_time_days(items).alias("item_lead_time_days"),
    ).where(F.col("part_number_match_key").isNotNull())


def _variants(items: DataFrame) -> DataFrame:
    # min and max tell "more than one distinct value" without a distinct count, so the
    # whole step is one map-side-combined aggregation.
    return _keyed(items).groupBy("part_number_match_key").agg(
        F.min("item_lead_time_days").alias("lowest"), F.max("item_lead_time_days").alias("highest")
    )


def lead_time_reference(items: DataFrame) -> DataFrame:
    """One row per part; parts with contradicting lead times are left out altogether."""
    return (
        _variants(items).where(~flag(F.col("lowest") != F.col("highest")))
        .select("part_number_match_key", F.col("highest").alias("item_lead_time_days"))
    )


def lead_time_conflicts(items: DataFrame) -> DataFrame:
    return (
        _keyed(items).groupBy("part_number_match_key")
        .agg(F.count_distinct("item_lead_time_days").alias("lead_time_variants"))
        .where(F.col("lead_time_variants") > 1)
    )


def with_lead_time(po: DataFrame, items: DataFrame, heavy_rows: int = HEAVY_ROWS,
                   deal_by: Sequence[str] = LINE_KEY) -> DataFrame:
    """Adds the benchmark and the adherence measures; the row count never changes.

    Lines of a part with over ``heavy_rows`` lines, and lines without a part, are dealt out
    by ``deal_by``.
    """
    po = po.withColumn("part_number_match_key", part_key(po))
    po = looked_up(po, lead_time_reference(items), ["part_number_match_key"], list(deal_by), heavy_rows)
    return lead_time_measures(po.withColumn("actual_lead_time_days", actual_days()))


def actual_days() -> Column:
    return days_floor(F.col("last_receipt_date"), F.col("order_date"))


def lead_time_measures(po: DataFrame) -> DataFrame:
    """The adherence measures of lines that have benchmark and actual days."""
    bench, actual = F.col("item_lead_time_days"), F.col("actual_lead_time_days")
    po = po.withColumn("lead_time_eligible",
                       flag(F.col("fully_received") & (bench >= 0) & (actual >= 0)))
    eligible = F.col("lead_time_eligible")
    return po.withColumns({
        "lead_time_variance_days": F.when(eligible, actual - bench),
        "lead_time_adherent": flag(eligible & (actual <= bench)),
        "eligible_actual_lead_time_days": F.when(eligible, actual),
    })


def lead_time_coverage(items: DataFrame) -> DataFrame:
    return items.agg(
        F.count(F.lit(1)).alias("items"),
        F.count("lead_time").alias("with_lead_time"),
        F.count_distinct(F.when(F.col("lead_time").isNotNull(), F.col("part_number")))
        .alias("parts_with_lead_time"),
    )


def part_match_totals(po: DataFrame, items: DataFrame) -> DataFrame:
    """How far the item master reaches the PO lines (``po`` already carries lead times)."""
    known = items.select(upper_key(F.col("part_number")).alias("plain_key")).where(
        F.col("plain_key").isNotNull()).distinct().withColumn("known", F.lit(True))
    return (
        po.withColumn("plain_key", upper_key(F.col("part_number")))
        .join(known, "plain_key", "left")
        .agg(
            F.count(F.lit(1)).alias("po_rows"),
            F.count("known").alias("part_in_item_master"),
            F.count("item_lead_time_days").alias("with_usable_lead_time"),
            F.count_if("lead_time_eligible").alias("lead_time_eligible"),
            F.count_if("lead_time_adherent").alias("lead_time_adherent"),
            F.count_if(F.col("lead_time_eligible") & ~F.col("lead_time_adherent"))
            .alias("lead_time_non_adherent"),
        )
    )
