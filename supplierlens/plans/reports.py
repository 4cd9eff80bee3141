"""Reporting tables over the scorecard, the vendor master and the unmatched NCRs."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from supplierlens.functions.text import vendor_label
from supplierlens.operators import vendor_quality
from supplierlens.operators.identity import VENDOR_KEY
from supplierlens.operators.scoring import (
    COMPONENTS,
    load_rules,
    rules_table,
    score_vendors,
    thresholds,
    thresholds_table,
)
from supplierlens.operators.vendor_summary import join_ncrs, summarize_ncrs
from supplierlens.plans.scorecard import Datasets, order_summary, prepare_ncrs
from supplierlens.sources import sinks

NAME, CITY = VENDOR_KEY

# Scorecard column -> heading, in report order.
SCORECARD_HEADINGS = {
    "vendor_key": "Vendor Key", "vendor_match_name": "Vendor", "vendor_match_city": "Location",
    "prototype_overall_score": "Prototype Overall Score",
    "prototype_overall_grade": "Prototype Overall Grade",
    "prototype_weight_coverage_pct": "Weight Coverage %",
    "prototype_scored_component_count": "Scored Components",
    "prototype_overall_status": "Overall Status",
    "po_transaction_count": "PO Transactions", "distinct_po_count": "Distinct POs",
    "total_ordered_qty": "Total Ordered Qty", "total_received_qty": "Total Received Qty",
    "delivery_eligible_count": "Delivery Eligible", "on_time_count": "On-Time",
    "late_count": "Late", "on_time_delivery_pct": "OTD %",
    "average_days_late": "Average Days Late", "delivery_prototype_score": "Delivery Score",
    "delivery_prototype_grade": "Delivery Grade", "delivery_score_status": "Delivery Status",
    "supplier_linked_ncr_count": "Supplier-Linked NCRs",
    "supplier_linked_ncr_rate_pct": "Supplier-Linked NCR Rate %",
    "quality_eligible_ncr_count": "Quality-Eligible NCRs",
    "total_ncr_quantity": "Valid NCR Quantity", "quality_rejected_qty": "Valid Rejected Qty",
    "ncr_rejected_pct": "NCR Rejected %", "ncr_quantity_anomaly_count": "NCR Qty Anomalies",
    "quality_prototype_score": "Quality Score", "quality_prototype_grade": "Quality Grade",
    "quality_score_status": "Quality Status",
    "lead_time_eligible_count": "Lead-Time Eligible",
    "lead_time_adherent_count": "Lead-Time Adherent",
    "average_actual_lead_time_days": "Average Actual Lead Time",
    "average_lead_time_variance_days": "Average Lead-Time Variance",
    "lead_time_adherence_pct": "Lead-Time Adherence %",
    "lead_time_prototype_score": "Lead-Time Score",
    "lead_time_prototype_grade": "Lead-Time Grade", "lead_time_score_status": "Lead-Time Status",
    "responsiveness_eligible_ncr_count": "Responsiveness-Eligible NCRs",
    "resolved_ncr_count": "Resolved NCRs", "unresolved_ncr_count": "Unresolved NCRs",
    "responsiveness_proxy_pct": "Responsiveness Proxy - NCR Resolution %",
    "responsiveness_prototype_score": "Responsiveness Score",
    "responsiveness_prototype_grade": "Responsiveness Grade",
    "responsiveness_score_status": "Responsiveness Status",
    "price_comparison_count": "Price Comparisons",
    "price_stable_count": "Price Stable / Decreased", "price_increase_count": "Price Increased",
    "average_price_change_pct": "Average Price Change %",
    "price_stability_pct": "Price Stability %", "commercial_prototype_score": "Commercial Score",
    "commercial_prototype_grade": "Commercial Grade", "commercial_score_status": "Commercial Status",
}

# Supporting metrics per section of the vendor detail.
SUPPORTING_METRICS = {
    "Delivery": ["delivery_eligible_count", "on_time_count", "late_count",
                 "on_time_delivery_pct", "average_days_late"],
    "Quality / NCR": ["supplier_linked_ncr_count", "supplier_linked_ncr_rate_pct",
                      "quality_eligible_ncr_count", "ncr_rejected_pct",
                      "ncr_quantity_anomaly_count"],
    "Lead-Time Performance": ["lead_time_eligible_count", "lead_time_adherent_count",
                              "lead_time_adherence_pct", "average_actual_lead_time_days",
                              "average_lead_time_variance_days"],
    "Responsiveness Proxy": ["responsiveness_eligible_ncr_count", "resolved_ncr_count",
                             "unresolved_ncr_count", "responsiveness_proxy_pct"],
    "Commercial Performance": ["price_comparison_count", "price_stable_count",
                               "price_increase_count", "average_price_change_pct",
                               "price_stability_pct"],
}

# Columns of the console preview.
PREVIEW_COLUMNS = [
    *VENDOR_KEY, "po_transaction_count",
    "delivery_eligible_count", "on_time_delivery_pct", "delivery_prototype_score",
    "delivery_prototype_grade", "delivery_score_status",
    "supplier_linked_ncr_count", "quality_eligible_ncr_count", "ncr_rejected_pct",
    "quality_prototype_score", "quality_prototype_grade", "quality_score_status",
    "lead_time_eligible_count", "lead_time_adherence_pct", "lead_time_prototype_score",
    "lead_time_prototype_grade", "lead_time_score_status",
    "responsiveness_eligible_ncr_count", "responsiveness_proxy_pct",
    "responsiveness_prototype_score", "responsiveness_prototype_grade",
    "responsiveness_score_status",
    "price_comparison_count", "price_stability_pct", "commercial_prototype_score",
    "commercial_prototype_grade", "commercial_score_status",
    "prototype_scored_component_count", "prototype_weight_coverage_pct",
    "prototype_overall_score", "prototype_overall_grade", "prototype_overall_status",
]

# What the notes say about each component.
COMPONENT_NOTES = {
    "on_time_delivery": "On-time share of fully received PO rows with a target and a receipt date; "
                        "the target is the revised date, else the required date.",
    "quality": "100 minus the supplier-linked NCR rate % times the penalty factor; a linked "
               "supplier is not necessarily the responsible one.",
    "lead_time": "Share of rows whose days from PO date to last receipt stay within the item "
                 "master lead time.",
    "responsiveness": "Resolved share of NCRs with a known resolution; a proxy for response time.",
    "commercial": "Share of repeat purchases (same vendor, location, part, currency, unit) at or "
                  "below the previous price.",
}


def existing(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted columns that exist, else all there are."""
    return [c for c in wanted if c in df.columns] or df.columns


def with_vendor_label(card: DataFrame) -> DataFrame:
    return card.withColumn("vendor_key", vendor_label(F.col(NAME), F.col(CITY)))


def by_vendor() -> list[Column]:
    return [F.col(NAME).asc_nulls_last(), F.col(CITY).asc_nulls_last()]


def long_form(row: DataFrame, name: str = "measure", value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Each row's columns as (measure, value) rows, beside the ``keep`` columns."""
    return row.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(c).alias(name), F.col(f"`{c}`").alias(value)) for c in row.columns if c not in keep])))


# --- dashboard -----------------------------------------------------------------------

def _cards_and_strays(data: Datasets, rules: dict | None) -> DataFrame:
    """Scored vendors plus the NCR groups without a vendor, told apart by ``is_vendor``.

    One full outer join at vendor grain gives totals of both sides; lines are read once.
    """
    orders = order_summary(data).withColumn("is_vendor", F.lit(True))
    joined = join_ncrs(orders, summarize_ncrs(prepare_ncrs(data)), "full_outer")
    joined = joined.withColumn("is_vendor", F.coalesce("is_vendor", F.lit(False)))
    return score_vendors(joined, rules or load_rules())


def _scored_vendors() -> Column:
    return F.count(F.when(F.col("is_vendor"), F.col("prototype_overall_score")))


def _ncr_count(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("supplier_linked_ncr_count"))), F.lit(0))


def dashboard_counts(data: Datasets, rules: dict | None = None) -> DataFrame:
    vendors = vendor_quality.assess(data.vendors).agg(
        F.count(F.lit(1)).alias("total_vendors"),
        F.count_if("review_required").alias("vendor_review_count"))
    cards = _cards_and_strays(data, rules).agg(
        _scored_vendors().alias("scored_vendors"),
        F.count_if("is_vendor").alias("total_scorecard_rows"),
        _ncr_count(~F.col("is_vendor")).alias("unmatched_ncr_count"))
    return long_form(vendors).unionByName(long_form(cards))


def grade_distribution(card: DataFrame, rules: dict) -> DataFrame:
    """Overall grades of the ladder, zero-filled; N/A is not a grade."""
    counts = [F.count_if(F.col("prototype_overall_grade") == g).alias(g) for g, _ in thresholds(rules)]
    return long_form(card.agg(*counts), "grade", "vendors")


def component_coverage(card: DataFrame, rules: dict) -> DataFrame:
    """Scored and unscored vendors per component."""
    counts = card.agg(F.count(F.lit(1)).alias("n"),
                      *[F.count(c.score).alias(c.score) for c in COMPONENTS])
    rows = [F.struct(F.lit(rules["components"][c.rule]["label"]).alias("component"),
                     F.col(c.score).alias("scored")) for c in COMPONENTS]
    return counts.select("n", F.inline(F.array(*rows))).select(
        "component", "scored", (F.col("n") - F.col("scored")).alias("not_scored"),
        # Half-to-even like the published figures.
        F.when(F.col("n") > 0, F.bround(F.col("scored") / F.col("n") * 100, 1))
        .otherwise(0.0).alias("coverage_pct"))


# --- vendor pages --------------------------------------------------------------------

LIST_COLUMNS = [*VENDOR_KEY, "po_transaction_count", *[c.grade for c in COMPONENTS],
                "prototype_overall_score", "prototype_overall_grade", "prototype_overall_status"]


def vendor_list(card: DataFrame, search: str = "") -> DataFrame:
    """Vendors whose name or city contains the text, whatever its case."""
    text = search.strip().upper()
    if text:
        card = card.where(
            F.upper(F.coalesce(NAME, F.lit(""))).contains(text)
            | F.upper(F.coalesce(CITY, F.lit(""))).contains(text))
    return card.select(*LIST_COLUMNS).orderBy(*by_vendor())


def vendor_detail(card: DataFrame, name: str, city: str = "") -> DataFrame:
    """The row of a vendor and city; a missing city is addressed as ''."""
    return card.where((F.coalesce(NAME, F.lit("")) == name) & (F.coalesce(CITY, F.lit("")) == city))


def review_vendors(vendors: DataFrame) -> DataFrame:
    found = vendors.where("review_required")
    return found.select(*existing(found, ["vendor_name", "city", "address_line_1", "postal_code",
                                          "missing_components", "review_reason"]))


def review_ncrs(strays: DataFrame) -> DataFrame:
    return strays.select(*existing(strays, ["ncr_number", NAME, CITY, "supplier", "part_number",
                                            "status", "po_location_count"]))


# --- export tables -------------------------------------------------------------------

def scorecard_export(card: DataFrame) -> DataFrame:
    card = with_vendor_label(card)
    kept = {c: heading for c, heading in SCORECARD_HEADINGS.items() if c in card.columns}
    return card.select(*[F.col(c).alias(h) for c, h in kept.items()]).orderBy(
        F.col("Vendor").asc_nulls_last(), F.col("Location").asc_nulls_last())


def component_detail(card: DataFrame, rules: dict) -> DataFrame:
    """Five rows per vendor: metric, sample, score, grade and status of each component."""
    rows = [
        F.struct(
            F.lit(rules["components"][c.rule]["label"]).alias("component"),
            F.lit(float(rules["components"][c.rule]["weight"])).alias("weight"),
            F.col(c.metric).alias("metric"),
            F.col(c.sample).alias("sample"),
            F.col(c.score).alias("score"),
            F.col(c.grade).alias("grade"),
            F.col(c.status).alias("status"),
        )
        for c in COMPONENTS
    ]
    return with_vendor_label(card).select("vendor_key", F.inline(F.array(*rows)))


def supporting_detail(card: DataFrame) -> DataFrame:
    rows = [
        F.struct(F.lit(section).alias("section"),
                 F.lit(SCORECARD_HEADINGS[c]).alias("metric"),
                 F.col(c).cast("double").alias("value"))
        for section, columns in SUPPORTING_METRICS.items() for c in columns
    ]
    return with_vendor_label(card).select("vendor_key", F.inline(F.array(*rows)))


def top_scored_vendor(card: DataFrame) -> DataFrame:
    score = F.col("prototype_overall_score")
    return with_vendor_label(card).where(score.isNotNull()).orderBy(score.desc(), *by_vendor()).limit(1)


def vendor_picker(card: DataFrame) -> DataFrame:
    """Labels in the order of the scorecard: name, then city, missing ones last."""
    labels = with_vendor_label(card).select("vendor_key", NAME, CITY).distinct()
    return labels.orderBy(*by_vendor()).select("vendor_key")


def rules_notes(spark: SparkSession, rules: dict) -> DataFrame:
    """Thresholds, component definitions and the overall rule as one table."""
    ladder = thresholds_table(spark, rules).select(
        F.lit("grade threshold").alias("section"), F.col("grade").alias("name"),
        F.col("minimum_score").alias("value"), F.lit(None).cast("string").alias("note"))
    notes = F.create_map(*[F.lit(x) for pair in COMPONENT_NOTES.items() for x in pair])
    parts = rules_table(spark, rules).select(
        F.lit("component weight").alias("section"), F.col("label").alias("name"),
        F.col("weight").alias("value"), notes[F.col("component")].alias("note"))
    overall = spark.createDataFrame(
        [("overall", "minimum scored components",
          float(rules["overall"]["minimum_available_components"]),
          "Missing components are left out and the remaining weights normalised.")],
        "section string, name string, value double, note string")
    return ladder.unionByName(parts).unionByName(overall)


def vendor_review_export(vendors: DataFrame) -> DataFrame:
    headings = {"company_id": "Company ID", "vendor_name": "Vendor Name",
                "address_line_1": "Address", "city": "City", "state_province": "Province / State",
                "postal_code": "Postal Code", "vendor_quality_status": "Vendor Data Status",
                "exact_duplicate_flag": "Exact Duplicate", "review_reason": "Review Reason",
                "missing_components": "Missing Component / Issue"}
    return vendors.where("review_required").select(
        *[F.col(c).alias(h) for c, h in headings.items() if c in vendors.columns])


# --- distributions -------------------------------------------------------------------

def component_grades(card: DataFrame, rules: dict) -> DataFrame:
    rows = [F.struct(F.lit(rules["components"][c.rule]["label"]).alias("component"),
                     F.col(c.grade).alias("grade")) for c in COMPONENTS]
    return card.select(F.inline(F.array(*rows))).groupBy("component", "grade").agg(
        F.count(F.lit(1)).alias("vendors"))


def quality_crosstab(card: DataFrame) -> DataFrame:
    """Quality status by quality grade with row, column and grand totals as 'All'."""
    status, letter = "quality_score_status", "quality_prototype_grade"
    return card.cube(status, letter).agg(
        F.count(F.lit(1)).alias("vendors"), F.grouping(status).alias("_s"),
        F.grouping(letter).alias("_g"),
    ).select(F.when(F.col("_s") == 1, "All").otherwise(F.col(status)).alias(status),
             F.when(F.col("_g") == 1, "All").otherwise(F.col(letter)).alias(letter), "vendors")


def overall_coverage(card: DataFrame) -> DataFrame:
    """Scored, unscored and all vendors, then vendors per overall grade including N/A."""
    rows = F.array(
        F.struct(F.lit("coverage").alias("section"),
                 F.when(F.col("prototype_overall_score").isNotNull(), "scored")
                 .otherwise("not scored").alias("value")),
        F.struct(F.lit("coverage").alias("section"), F.lit("total").alias("value")),
        F.struct(F.lit("grade").alias("section"), F.col("prototype_overall_grade").alias("value")),
    )
    return card.select(F.inline(rows)).groupBy("section", "value").agg(
        F.count(F.lit(1)).alias("vendors"))


def scored_component_distribution(card: DataFrame) -> DataFrame:
    return card.groupBy("prototype_scored_component_count").agg(
        F.count(F.lit(1)).alias("vendors")).orderBy("prototype_scored_component_count")


def weight_coverage_distribution(card: DataFrame) -> DataFrame:
    return card.groupBy(F.bround("prototype_weight_coverage_pct", 2).alias("weight_coverage_pct")).agg(
        F.count(F.lit(1)).alias("vendors")).orderBy("weight_coverage_pct")


def preview(card: DataFrame, rows: int = 20) -> DataFrame:
    return card.select(*PREVIEW_COLUMNS).orderBy(*by_vendor()).limit(rows)


def final_controls(data: Datasets, rules: dict | None = None) -> DataFrame:
    everything = _cards_and_strays(data, rules)
    vendor = F.col("is_vendor")

    def total(c: str) -> Column:
        return F.coalesce(F.sum(F.when(vendor, F.col(c))), F.lit(0)).alias(c)

    return long_form(everything.agg(
        total("po_transaction_count"), F.count_if(vendor).alias("vendor_location_rows"),
        total("delivery_eligible_count"), total("lead_time_eligible_count"),
        total("price_comparison_count"),
        _ncr_count(vendor).alias("matched_ncrs"), _ncr_count(~vendor).alias("unmatched_ncrs"),
        _ncr_count(F.lit(True)).alias("ncrs_accounted_for"),
        _scored_vendors().alias("scored_vendors")))


def aggregation_controls(orders: DataFrame) -> DataFrame:
    """Totals of the lines beside totals re-added from the vendor rows.

    ``orders`` is an order summary with totals: the row of all lines comes from the same
    passes that made the vendor rows, so nothing is read for the control alone.
    """
    pairs = {"po_transactions": "po_transaction_count", "delivery_eligible": "delivery_eligible_count",
             "lead_time_eligible": "lead_time_eligible_count", "price_comparisons": "price_comparison_count"}
    sums = orders.groupBy("is_total").agg(*[F.sum(c).alias(m) for m, c in pairs.items()])
    out = long_form(sums, keep=("is_total",)).groupBy("measure").agg(
        F.max(F.when(F.col("is_total"), F.col("value"))).alias("line_total"),
        F.max(F.when(~F.col("is_total"), F.col("value"))).alias("vendor_total"))
    return out.withColumn("agrees", F.col("line_total") == F.col("vendor_total"))


# --- written results -----------------------------------------------------------------

def write_result_tables(spark: SparkSession, card: DataFrame, strays: DataFrame, vendors: DataFrame,
                        rules: dict, folder: str) -> None:
    """The five result tables as one set with a manifest. Vendor detail is read from the written
    scorecard, so the scorecard is computed once and survives the loss of any executor."""
    kept = sinks.write_tables({"scorecard_rows": card}, folder)
    card = spark.read.parquet(kept["scorecard_rows"])
    sinks.write_result_set({
        "vendor_scorecard": scorecard_export(card),
        "vendor_detail": component_detail(card, rules),
        "prototype_notes": rules_notes(spark, rules),
        "unmatched_ncrs": strays,
        "vendor_review": vendor_review_export(vendors),
    }, folder)


def _current_snapshot(spark: SparkSession, path: str) -> tuple[str, dt.datetime] | None:
    """Folder and time of the newest snapshot below ``path``."""
    try:
        newest = spark.read.parquet(f"{path}/pointer").agg(
            F.max(F.struct("refreshed_at", "folder")).alias("newest")).first()[0]
    except AnalysisException:
        return None
    return newest and (newest["folder"], newest["refreshed_at"])


def snapshot_is_fresh(spark: SparkSession, path: str, now: dt.datetime, max_age_minutes: int = 15) -> bool:
    """Whether a snapshot below ``path`` exists and is younger than the limit."""
    if max_age_minutes <= 0:
        raise ValueError("max_age_minutes must be greater than zero")
    newest = _current_snapshot(spark, path)
    return newest is not None and (now - newest[1]) < dt.timedelta(minutes=max_age_minutes)


def refresh_snapshot(spark: SparkSession, card: DataFrame, path: str, now: dt.datetime,
                     max_age_minutes: int = 15, force: bool = False) -> DataFrame:
    """The stored scorecard, rebuilt when it is missing, too old, or on demand.

    Each snapshot has a folder of its own, and a row is appended to the pointer table when it
    is complete: readers keep the one they have open, and a failed write changes nothing.
    """
    if force or not snapshot_is_fresh(spark, path, now, max_age_minutes):
        folder = f"{path}/version-{uuid.uuid4().hex}"
        card.withColumn("refreshed_at", F.lit(now).cast("timestamp_ntz")).write.parquet(folder)
        spark.range(1).select(F.lit(now).cast("timestamp_ntz").alias("refreshed_at"),
                              F.lit(folder).alias("folder")).write.mode("append").parquet(f"{path}/pointer")
    return spark.read.parquet(_current_snapshot(spark, path)[0])
