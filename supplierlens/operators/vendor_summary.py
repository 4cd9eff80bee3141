"""Aggregation to one row per vendor name and city, and matching of NCRs to it.

NCRs are aggregated before they meet the vendors: the join then works on vendor-grain
rows, and a vendor with a third of all NCRs is already one row when it is shuffled.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplierlens.functions.numeric import part_key, pct
from supplierlens.operators.identity import VENDOR_KEY
from supplierlens.operators.lead_time import actual_days, lead_time_measures, lead_time_reference
from supplierlens.operators.pricing import (
    PART_ROWS,
    previous_prices,
    price_columns,
    price_measures,
    with_parts,
)
from supplierlens.operators.skew import HEAVY_ROWS, looked_up
from supplierlens.session import written

NCR_COUNTS = ["supplier_linked_ncr_count", "quality_eligible_ncr_count",
              "ncr_quantity_anomaly_count", "responsiveness_eligible_ncr_count",
              "resolved_ncr_count", "unresolved_ncr_count"]
NCR_SUMS = ["total_rejected_qty", "total_ncr_quantity", "quality_rejected_qty"]


#: Line columns that the measures of an order summary are made from, price aside.
MEASURED = ["po_number", "part_number", "ordered_qty", "received_qty", "fully_received", "delivery_eligible", "on_time",
            "late", "late_days_only", "last_receipt_date"]


#: What a price group has beside its part.
TERMS = [*VENDOR_KEY, "commercial_currency_key", "commercial_uom_key"]


def _code(columns: list[str], seed: int) -> Column:
    """64 bits for the values of ``columns``; a null is not passed over."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def coded_terms(store: DataFrame) -> tuple[DataFrame, int]:
    """The terms that lines name, with a code each and one of the vendor, and the codes' seed.

    Lines can go by these codes in place of four texts: that no two terms and no two vendors
    share one is counted, and another seed taken until it is so.
    """
    named = written(store.select(*TERMS).distinct(), "terms", "zstd")
    for seed in count():
        terms = named.withColumns({"_terms": _code(TERMS, seed), "_vendor": _code(VENDOR_KEY, seed)})
        found = terms.agg(F.count(F.lit(1)), F.count_distinct("_terms"),
                          F.count_distinct(F.struct(*VENDOR_KEY)), F.count_distinct("_vendor")).first()
        if found[0] == found[1] and found[2] == found[3]:
            return terms, seed


def summarize_orders(store: DataFrame, items: DataFrame, totals: bool = False, heavy_rows: int = HEAVY_ROWS,
                     part_rows: int = PART_ROWS) -> DataFrame:
    """18 measures per vendor and city; a missing city is a group of its own.

    ``store`` is a written price store with the MEASURED columns. Quantities and delivery are
    summed up as they are read. Only what lead times and prices need is shuffled, once for
    both: by part, a heavy one dealt out by its price groups, so that the window finds each
    group in one place. Orders are counted on distinct pairs of vendor and order. Shuffled lines
    have codes in place of vendor, currency and unit (``coded_terms``); the texts meet the sums.
    With ``totals`` a row with ``is_total`` has the measures of all lines, made in the same
    passes as the vendors'.
    """
    def zero_if_none(c: str):
        return F.coalesce(F.sum(c), F.lit(0.0))

    def grouped(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
        columns = [x.alias(c) for c, x in measures.items()]
        if not totals:
            return df.groupBy(*VENDOR_KEY).agg(*columns)
        sets = df.groupingSets([[F.col(c) for c in VENDOR_KEY], []], *VENDOR_KEY)
        return sets.agg((F.grouping(VENDOR_KEY[0]) == 1).alias("is_total"), *columns)

    of_lines = {
        "po_transaction_count": F.count(F.lit(1)),
        "total_ordered_qty": zero_if_none("ordered_qty"),
        "total_received_qty": zero_if_none("received_qty"),
        "received_transaction_count": F.count_if(F.col("received_qty") > 0),
        "fully_received_count": F.count_if("fully_received"),
        "delivery_eligible_count": F.count_if("delivery_eligible"),
        "on_time_count": F.count_if("on_time"),
        "late_count": F.count_if("late"),
        "average_days_late": F.avg("late_days_only"),
    }
    flags = {"lead_time_eligible_count": "lead_time_eligible", "lead_time_adherent_count": "lead_time_adherent",
             "price_comparison_count": "price_comparison_eligible", "price_stable_count": "price_stable",
             "price_increase_count": "price_increased"}
    averages = {"average_actual_lead_time_days": "eligible_actual_lead_time_days",
                "average_lead_time_variance_days": "lead_time_variance_days",
                "average_price_change_pct": "price_change_pct"}
    of_terms = {c: F.sum(c) for c in flags} | {
        c: F.sum(f"_sum_{c}") / F.nullif(F.sum(f"_count_{c}"), F.lit(0)) for c in averages}
    terms, seed = coded_terms(store)
    # A part known by text is joined by its commercial key, which is the match key but for ''.
    text = isinstance(store.schema["part_number"].dataType, T.StringType)
    part, group = "commercial_part_key" if text else "part_number_match_key", ["_terms", "commercial_part_key"]
    lines = store.select(
        _code(TERMS, seed).alias("_terms"), *([] if text else [part_key(store).alias(part)]),
        *[c for c in price_columns(store, ["fully_received"]) if c not in TERMS],
        F.when(F.col("fully_received"), actual_days()).alias("actual_lead_time_days"))
    parted, carried = with_parts(lines, part_rows=part_rows, group=group)
    known = lead_time_reference(items).withColumnRenamed("part_number_match_key", part)
    timed = lead_time_measures(looked_up(parted, known, [part], [*group, "_part"], heavy_rows, keep_salt=True))
    priced = price_measures(previous_prices(timed, carried, within=[part, "_salt"], group=group)).groupBy("_terms").agg(
        *[F.count_if(x).alias(c) for c, x in flags.items()],
        *[x.alias(f"_{n}_{c}") for c, v in averages.items() for n, x in (("sum", F.sum(v)), ("count", F.count(v)))])
    priced = priced.join(terms.drop("_vendor"), "_terms")
    pairs = store.select(_code(VENDOR_KEY, seed).alias("_vendor"), "po_number").distinct()
    counted = pairs.groupBy("_vendor").agg(F.count("po_number").alias("distinct_po_count")).join(
        terms.select("_vendor", *VENDOR_KEY).distinct(), "_vendor").drop("_vendor")
    if totals:
        counted = counted.withColumn("is_total", F.lit(False)).unionByName(
            pairs.agg(F.count_distinct("po_number").alias("distinct_po_count"), F.lit(True).alias("is_total")),
            allowMissingColumns=True)
    # All have every vendor, also those without a city, in one row each.
    both = grouped(store, of_lines).unionByName(grouped(priced, of_terms), allowMissingColumns=True).unionByName(
        counted, allowMissingColumns=True)
    ordered = [*list(of_lines)[:3], "distinct_po_count", *list(of_lines)[3:], *list(flags)[:2], *list(averages)[:2],
               *list(flags)[2:], *list(averages)[2:]]
    out = both.groupBy(*VENDOR_KEY, *(["is_total"] if totals else [])).agg(*[F.max(c).alias(c) for c in ordered])
    return out.withColumns({
        "on_time_delivery_pct": pct(F.col("on_time_count"), F.col("delivery_eligible_count")),
        "lead_time_adherence_pct": pct(F.col("lead_time_adherent_count"),
                                       F.col("lead_time_eligible_count")),
        "price_stability_pct": pct(F.col("price_stable_count"), F.col("price_comparison_count")),
    })


def summarize_ncrs(ncrs: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Supplier-linked NCRs per vendor name and city, matched or not."""
    out = ncrs.where("supplier_linked").groupBy(*VENDOR_KEY, *extra_keys).agg(
        F.count(F.lit(1)).alias("supplier_linked_ncr_count"),
        F.sum("quantity_rejected").alias("total_rejected_qty"),
        F.count_if("quality_eligible").alias("quality_eligible_ncr_count"),
        F.sum("quality_quantity").alias("total_ncr_quantity"),
        F.sum("quality_rejected_quantity").alias("quality_rejected_qty"),
        F.count_if("ncr_quantity_anomaly").alias("ncr_quantity_anomaly_count"),
        F.count_if("responsiveness_eligible").alias("responsiveness_eligible_ncr_count"),
        F.count_if("resolved_flag").alias("resolved_ncr_count"),
        F.count_if("unresolved_flag").alias("unresolved_ncr_count"),
    )
    return out.withColumns({
        "ncr_rejected_pct": pct(F.col("quality_rejected_qty"), F.col("total_ncr_quantity")),
        "responsiveness_proxy_pct": pct(F.col("resolved_ncr_count"),
                                        F.col("responsiveness_eligible_ncr_count")),
    })


def vendor_keys(po: DataFrame) -> DataFrame:
    """The vendors an NCR can match: name and city both known."""
    return po.select(*VENDOR_KEY).where(
        F.col("vendor_match_name").isNotNull() & F.col("vendor_match_city").isNotNull()
    ).distinct()


def name_locations(keys: DataFrame) -> DataFrame:
    """Distinct known cities per vendor name; ``keys`` holds distinct names and cities."""
    return keys.groupBy("vendor_match_name").agg(
        F.count_distinct("vendor_match_city").alias("po_location_count"))


def with_match_status(ncrs: DataFrame, keys: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """MATCHED, UNMATCHED or MISSING LOCATION for every supplier-linked NCR.

    NCRs of a vendor with over ``heavy_rows`` of them, and those without a city, are dealt out.
    """
    known = keys.withColumn("_known", F.lit(True))
    linked = ncrs.where("supplier_linked")
    return looked_up(linked, known, VENDOR_KEY, ["ncr_number"], heavy_rows).withColumn(
        "match_status",
        F.when(F.col("vendor_match_city").isNull(), "MISSING LOCATION")
        .when(F.col("_known"), "MATCHED").otherwise("UNMATCHED"),
    ).drop("_known")


def unmatched_ncrs(ncrs: DataFrame, po: DataFrame) -> DataFrame:
    """NCRs outside the scorecard, with the number of cities their vendor name has."""
    pairs = po.select(*VENDOR_KEY).distinct()
    status = with_match_status(ncrs, pairs.where(
        F.col("vendor_match_name").isNotNull() & F.col("vendor_match_city").isNotNull()))
    return looked_up(status.where("match_status <> 'MATCHED'"), name_locations(pairs), ["vendor_match_name"],
                     ["ncr_number"])


def match_totals(orders: DataFrame, ncrs: DataFrame) -> DataFrame:
    """Matched + unmatched + without location = linked, computed on vendor-grain rows."""
    keys = orders.select(*VENDOR_KEY).withColumn("_known", F.lit(True))
    n, city = F.col("supplier_linked_ncr_count"), F.col("vendor_match_city")
    known = F.col("_known").isNotNull()

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    return ncrs.join(keys, VENDOR_KEY, "left").agg(
        total(known).alias("matched"),
        total(~known & city.isNotNull()).alias("unmatched_with_location"),
        total(city.isNull()).alias("missing_location"),
        total(F.lit(True)).alias("accounted_for"),
    )


def join_ncrs(orders: DataFrame, ncrs: DataFrame, how: str = "left",
              extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """NCR measures onto vendors. Without any NCR the sums are 0; with NCRs but no valid
    quantity they stay missing. ``how="full_outer"`` keeps NCR groups without a vendor."""
    out = orders.join(ncrs, [*VENDOR_KEY, *extra_keys], how)
    none = F.col("supplier_linked_ncr_count").isNull()
    fixed = {c: F.when(none, F.lit(0.0)).otherwise(F.col(c)) for c in NCR_SUMS}
    fixed |= {c: F.coalesce(F.col(c), F.lit(0)) for c in NCR_COUNTS}
    return out.withColumns(fixed)
