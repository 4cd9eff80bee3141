"""Non-conformance measures per record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplierlens.functions.numeric import flag, to_double
from supplierlens.operators.identity import with_vendor_identity


def with_ncr_measures(ncrs: DataFrame) -> DataFrame:
    """``resolved`` must already be a boolean (see ``ingest.clean_ncrs``)."""
    ncrs = with_vendor_identity(ncrs).withColumns({
        "supplier_linked": F.col("vendor_name").isNotNull(),
        "quantity": to_double(ncrs, "quantity"),
        "quantity_rejected": to_double(ncrs, "quantity_rejected"),
    })
    qty, bad, linked = F.col("quantity"), F.col("quantity_rejected"), F.col("supplier_linked")
    ncrs = ncrs.withColumns({
        "ncr_quantity_anomaly": flag(bad > qty),
        "quality_eligible": flag(linked & (qty > 0) & (bad >= 0) & (bad <= qty)),
        "responsiveness_eligible": linked & F.col("resolved").isNotNull(),
    })
    usable, known = F.col("quality_eligible"), F.col("responsiveness_eligible")
    return ncrs.withColumns({
        "quality_quantity": F.when(usable, qty),
        "quality_rejected_quantity": F.when(usable, bad),
        "resolved_flag": flag(known & F.col("resolved")),
        "unresolved_flag": flag(known & ~F.col("resolved")),
    })


def ncr_totals(ncrs: DataFrame) -> DataFrame:
    linked = F.col("supplier_linked")
    city = F.col("vendor_match_city")
    return ncrs.agg(
        F.count(F.lit(1)).alias("ncr_rows"),
        F.count_if(linked).alias("supplier_linked"),
        F.count_if(~linked).alias("without_supplier"),
        F.count_if(linked & city.isNotNull()).alias("linked_with_location"),
        F.count_if(linked & city.isNull()).alias("linked_without_location"),
        F.count_if(linked & F.col("quality_eligible")).alias("quality_eligible"),
        F.count_if(linked & F.col("ncr_quantity_anomaly")).alias("quantity_anomalies"),
        F.count_if(linked & F.col("responsiveness_eligible")).alias("responsiveness_eligible"),
        F.count_if(linked & F.col("resolved_flag")).alias("resolved"),
        F.count_if(linked & F.col("unresolved_flag")).alias("unresolved"),
    )
