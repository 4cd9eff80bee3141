"""On-time delivery per PO line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplierlens.functions.dates import days_floor
from supplierlens.functions.numeric import flag


def fully_received(ordered: Column, received: Column) -> Column:
    return flag((ordered > 0) & (received >= ordered))


def with_delivery(po: DataFrame) -> DataFrame:
    receipt, target = F.col("last_receipt_date"), F.col("target_date")
    po = po.withColumns({
        "target_date": F.coalesce("revised_date", "required_date"),
        "fully_received": fully_received(F.col("ordered_qty"), F.col("received_qty")),
    })
    po = po.withColumn(
        "delivery_eligible", F.col("fully_received") & target.isNotNull() & receipt.isNotNull()
    )
    eligible = F.col("delivery_eligible")
    # Full timestamps decide on time or late; days late counts whole days only, so a
    # line can be late by zero days.
    po = po.withColumns({
        "on_time": flag(eligible & (receipt <= target)),
        "late": flag(eligible & (receipt > target)),
        "days_late": F.when(eligible, F.greatest(days_floor(receipt, target), F.lit(0))),
    })
    return po.withColumn("late_days_only", F.when(F.col("late"), F.col("days_late")))


def delivery_totals(po: DataFrame) -> DataFrame:
    return po.agg(
        F.count_if("delivery_eligible").alias("delivery_eligible"),
        F.count_if(~F.col("delivery_eligible")).alias("delivery_ineligible"),
        F.count(F.lit(1)).alias("po_rows"),
        F.count_if("on_time").alias("on_time"),
        F.count_if("late").alias("late"),
        F.count_if(F.col("on_time") | F.col("late")).alias("represented"),
    )
