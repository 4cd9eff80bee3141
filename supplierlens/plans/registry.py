"""Every query by name: ``(spark, folder) -> DataFrame`` over the sample tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplierlens.functions.dates import text_to_timestamp
from supplierlens.functions.digest import column_digests
from supplierlens.functions.numeric import part_key, rounded
from supplierlens.functions.text import display_name, vendor_label
from supplierlens.operators import (
    delivery,
    lead_time,
    ncr,
    pricing,
    similarity,
    vendor_quality,
    vendor_summary,
)
from supplierlens.operators.identity import VENDOR_KEY, with_vendor_identity
from supplierlens.operators.scoring import COMPONENTS, load_rules
from supplierlens.plans import census, reconcile, reports
from supplierlens.plans import scorecard as cards
from supplierlens.session import work_folder, written
from supplierlens.sources import contracts, extracts, ingest, sinks
from supplierlens.sources import sampledata as sample

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LINE = ["po_number", "line_no", "part_id", "supplier_company_id"]
RULES = load_rules()


# Values as the sources hold them; everything else that is a double is derived.
STORED = frozenset(c for c, kind in contracts.NULL_TYPES.items() if kind == "double") | {
    "previous_unit_price", "line_received_qty", "log_received_qty"}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, folder: rounded(build(spark, folder), STORED)
        return build

    return register


def _tables(spark: SparkSession, folder: str) -> sample.SampleTables:
    return sample.SampleTables(spark, folder)


def _identified(spark: SparkSession, folder: str) -> DataFrame:
    """Valid lines with vendor identity."""
    raw = sample.purchase_orders_raw(_tables(spark, folder))
    return with_vendor_identity(ingest.clean_purchase_orders(raw))


def _vendor_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct vendor names and cities; the patterns run once per raw name, not per line."""
    raw = sample.purchase_orders_raw(_tables(spark, folder))
    names = ingest.clean_purchase_orders(raw).select("vendor_name").distinct()
    return with_vendor_identity(names).select(*VENDOR_KEY).distinct()


def _ncr_facts(spark: SparkSession, folder: str) -> DataFrame:
    t = _tables(spark, folder)
    return extracts.ncr_extract(sample.ncrs_raw(t), sample.order_lines(t), sample.companies(t),
                                sample.display_names(t), reconcile.EVERYTHING)


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.clean_items(sample.items_raw(_tables(spark, folder)))


# --- sources and contracts -----------------------------------------------------------

def _raw_frames(t):
    return {"purchase_orders": sample.purchase_orders_raw(t), "ncrs": sample.ncrs_raw(t),
            "items": sample.items_raw(t), "vendors": sample.vendors_raw(t)}


@query("src_load_contract")
def _(spark, folder):
    # Files as they are delivered, with source headers, read back by the loader.
    paths = {}
    for dataset, df in _raw_frames(_tables(spark, folder)).items():
        headers = {v: k for k, v in contracts.SOURCE_COLUMNS[dataset].items()}
        paths[dataset] = work_folder(spark, f"delivered-{dataset}")
        contracts.to_contract(df, dataset).withColumnsRenamed(headers).write.option("header", True).option(
            "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(paths[dataset])
    data, rejected = cards.load_files(spark, paths)
    rejected = ingest.coerce_timestamps(ingest.coerce_numeric(rejected, contracts.PO_NUMERIC), contracts.PO_TIMESTAMPS)
    loaded = {"purchase_orders": data.purchase_orders, "rejected_lines": rejected, "ncrs": data.ncrs,
              "items": data.items, "vendors": data.vendors}
    out = None
    for name, df in loaded.items():
        columns = contracts.contract("purchase_orders" if name == "rejected_lines" else name)
        part = column_digests(df, name, list(columns))
        out = part if out is None else out.unionByName(part)
    return out


@query("po_header_strip")
def _(spark, folder):
    raw = sample.purchase_orders_raw(_tables(spark, folder))
    return ingest.strip_header_rows(raw).select(*LINE, "part_number", "vendor_name")


@query("po_required_split")
def _(spark, folder):
    raw = sample.purchase_orders_raw(_tables(spark, folder))
    return ingest.with_row_status(ingest.strip_header_rows(raw)).select(*LINE, "row_status")


@query("po_type_contract")
def _(spark, folder):
    return contracts.po_type_report(sample.purchase_orders_raw(_tables(spark, folder)))


@query("coerce_numeric")
def _(spark, folder):
    raw = sample.items_raw(_tables(spark, folder)).withColumn("lead_time_text", F.col("lead_time"))
    return ingest.coerce_numeric(raw, contracts.ITEM_NUMERIC).select(
        "part_number", "lead_time_text", "lead_time", "list_price")


@query("coerce_datetime")
def _(spark, folder):
    # Timestamps as text, every third status with an unusable value.
    text = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("week "), F.month("o_orderdate"))) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    raw = _tables(spark, folder).orders.select(F.col("o_orderkey").alias("po_number"),
                                               text.alias("order_date_text"))
    return raw.withColumn("order_date", text_to_timestamp(F.col("order_date_text")))


@query("coerce_boolean")
def _(spark, folder):
    raw = sample.ncrs_raw(_tables(spark, folder)).withColumn("resolved_text", F.col("resolved"))
    watch = ingest.TruthWatch(raw, ("resolved",))
    kept = written(watch.df.select("ncr_number", "resolved_text", "resolved"), "truth-values")
    watch.check()
    return kept


@query("po_receipt_fill")
def _(spark, folder):
    raw = ingest.valid_lines(ingest.strip_header_rows(
        sample.purchase_orders_raw(_tables(spark, folder))))
    return ingest.fill_receipts(raw).select(*LINE, "received_qty")


@query("typed_null_projection")
def _(spark, folder):
    return contracts.to_contract(sample.ncrs_raw(_tables(spark, folder)), "ncrs",
                                 ("supplier_company_id",))


@query("contract_gaps")
def _(spark, folder):
    out = None
    for dataset, df in _raw_frames(_tables(spark, folder)).items():
        part = contracts.gap_report(df, dataset)
        out = part if out is None else out.unionByName(part)
    return out


def _extract(spark, folder, scope, basis="log"):
    t = _tables(spark, folder)
    return extracts.po_extract(sample.order_lines(t), sample.receipts(t), sample.companies(t),
                               sample.display_names(t), sample.projects(t), scope, basis)


@query("po_extract")
def _(spark, folder):
    return _extract(spark, folder, reconcile.EVERYTHING).select(
        *LINE, "part_number", "vendor_name", "project_number", "project_name", "ordered_qty",
        "received_qty", "line_received_qty", "last_receipt_date", "in_supplier_table")


@query("receipt_basis")
def _(spark, folder):
    def taken(basis):
        return _extract(spark, folder, reconcile.EVERYTHING, basis).select(
            F.lit(basis).alias("basis"), *LINE, "received_qty", "last_receipt_date")

    return taken("log").unionByName(taken("line"))


@query("po_scope")
def _(spark, folder):
    scope = extracts.Scope(months_back=36, as_of=census.AS_OF)
    lines = sample.order_lines(_tables(spark, folder))
    return lines.where(extracts.scope_predicate(scope)).select(*LINE, "order_date", "buyer")


@query("ncr_extract")
def _(spark, folder):
    t = _tables(spark, folder)
    scope = extracts.Scope(months_back=36, as_of=census.AS_OF)
    return extracts.ncr_extract(
        sample.ncrs_raw(t), sample.order_lines(t), sample.companies(t), sample.display_names(t), scope
    ).select("ncr_number", "vendor_name", "po_vendor_name", "supplier_display_name", "created_date")


@query("item_extract")
def _(spark, folder):
    t = _tables(spark, folder)
    return extracts.item_extract(sample.items_raw(t), sample.inventory(t)).select(
        "item_id", "part_number", "lead_time", "quantity_on_hand")


@query("lead_time_zero_null")
def _(spark, folder):
    return _items(spark, folder).select(
        "part_number", "lead_time",
        extracts.lead_time_or_unset(F.col("lead_time")).alias("usable_lead_time"))


@query("vendor_scope")
def _(spark, folder):
    t = _tables(spark, folder)
    bought = t.lineitem.select(F.col("l_suppkey").alias("company_id"))
    out = None
    for scope in extracts.VENDOR_SCOPES:
        part = extracts.vendor_extract(sample.companies(t), sample.supplier_records(t), bought, scope).select(
            F.lit(scope).alias("scope"), "company_id", "company_name", "city")
        out = part if out is None else out.unionByName(part)
    return out


@query("supplier_display_name")
def _(spark, folder):
    t = _tables(spark, folder)
    return sample.companies(t).select("company_id", "company_name", "city").join(
        sample.display_names(t).withColumnRenamed("display_name", "looked_up"), "company_id", "left"
    ).select("company_id", "looked_up",
             display_name(F.col("looked_up"), F.col("company_name"), F.col("city")).alias("display_name"))


@query("receipt_rollup")
def _(spark, folder):
    return extracts.receipt_rollup(sample.receipts(_tables(spark, folder)))


@query("sink_scorecard_tables")
def _(spark, folder):
    data = cards.load_sample(spark, folder)
    folder = work_folder(spark, "result-tables")
    reports.write_result_tables(spark, rounded(cards.scorecard(data, RULES), STORED), cards.unmatched(data),
                                cards.assessed_vendors(data), RULES, folder)
    tables = sinks.read_result_set(spark, folder)
    out = sinks.measured(spark, {name: f"{folder}/{name}" for name in tables})
    # The notes are made of the rules alone; their text is no result.
    return out.withColumn("value_digest", F.when(F.col("table_name") != "prototype_notes", F.col("value_digest")))


@query("sink_recon_csv")
def _(spark, folder):
    paths = sinks.write_tables({"vendor_diff": _vendor_diff(spark, folder).orderBy(
        *reconcile.by_difference())}, work_folder(spark, "reconcile"), "csv")
    return spark.read.option("header", True).csv(paths["vendor_diff"]).select(
        *VENDOR_KEY, "side", F.col("abs_diff").cast("long").alias("abs_diff"))


# --- vendor identity -----------------------------------------------------------------

@query("vendor_identity")
def _(spark, folder):
    return _identified(spark, folder).select(*LINE, "vendor_name", *VENDOR_KEY)


@query("vendor_key_label")
def _(spark, folder):
    names = _vendor_keys(spark, folder)
    return names.select(*VENDOR_KEY, vendor_label(F.col(VENDOR_KEY[0]), F.col(VENDOR_KEY[1]))
                        .alias("vendor_key"))


# --- vendor master -------------------------------------------------------------------

def _vendors(spark, folder):
    return sample.vendors_raw(_tables(spark, folder))


def _assessed(spark, folder):
    return vendor_quality.assess(_vendors(spark, folder))


@query("vendor_completeness")
def _(spark, folder):
    return vendor_quality.with_completeness(_vendors(spark, folder))


@query("vendor_exact_duplicates")
def _(spark, folder):
    return vendor_quality.with_exact_duplicates(
        vendor_quality.with_completeness(_vendors(spark, folder))).select(
        "company_id", *vendor_quality.DUPLICATE_KEY, "exact_duplicate_flag")


def _keyed_vendors(spark, folder):
    return vendor_quality.with_keys(vendor_quality.with_completeness(_vendors(spark, folder)))


@query("vendor_partial_name_candidates")
def _(spark, folder):
    return vendor_quality.candidate_counts(
        _keyed_vendors(spark, folder), ["vendor_name_key"], "complete_name_candidate_count"
    ).select("company_id", "vendor_name_key", "complete_name_candidate_count")


@query("vendor_partial_name_addr_candidates")
def _(spark, folder):
    return vendor_quality.candidate_counts(
        _keyed_vendors(spark, folder), ["vendor_name_key", "address_key"], "complete_candidate_count"
    ).select("company_id", "vendor_name_key", "address_key", "complete_candidate_count")


@query("vendor_fuzzy_candidates")
def _(spark, folder):
    return similarity.look_alikes(_keyed_vendors(spark, folder))


@query("vendor_location_candidates")
def _(spark, folder):
    return similarity.location_candidate_counts(_keyed_vendors(spark, folder)).select(
        "company_id", "city_key", "state_key", "location_candidates")


@query("vendor_review_status")
def _(spark, folder):
    return _assessed(spark, folder).select("company_id", "vendor_quality_status",
                                           "review_required", "review_reason")


@query("vendor_missing_field_counts")
def _(spark, folder):
    return vendor_quality.missing_field_counts(
        vendor_quality.with_completeness(_vendors(spark, folder)))


@query("vendor_duplicate_groups")
def _(spark, folder):
    return vendor_quality.duplicate_totals(_keyed_vendors(spark, folder))


@query("vendor_quality_summary")
def _(spark, folder):
    return vendor_quality.quality_summary(_assessed(spark, folder))


# --- line measures -------------------------------------------------------------------

def _delivered(spark, folder):
    return delivery.with_delivery(_identified(spark, folder))


@query("delivery_metrics")
def _(spark, folder):
    return _delivered(spark, folder).select(
        *LINE, "target_date", "fully_received", "delivery_eligible", "on_time", "late", "days_late",
        "late_days_only")


@query("delivery_controls")
def _(spark, folder):
    return delivery.delivery_totals(_delivered(spark, folder))


@query("part_match_key")
def _(spark, folder):
    t = _tables(spark, folder)
    items = sample.items_raw(t)
    # The same key from text and from a decimal number column.
    numbers = t.part.select(F.col("p_partkey").cast("string").alias("part_number"),
                            F.col("p_partkey").cast("double").alias("part_value"))
    return items.select("part_number", part_key(items).alias("part_key")).unionByName(
        numbers.select("part_number", part_key(numbers, "part_value").alias("part_key")))


@query("item_lead_time_reference")
def _(spark, folder):
    return lead_time.lead_time_reference(_items(spark, folder))


@query("item_lead_time_conflicts")
def _(spark, folder):
    return lead_time.lead_time_conflicts(_items(spark, folder))


def _timed(spark, folder):
    return lead_time.with_lead_time(_delivered(spark, folder), _items(spark, folder))


@query("lead_time_metrics")
def _(spark, folder):
    return _timed(spark, folder).select(
        *LINE, "item_lead_time_days", "actual_lead_time_days", "lead_time_eligible",
        "lead_time_variance_days", "lead_time_adherent", "eligible_actual_lead_time_days")


@query("item_lead_time_coverage")
def _(spark, folder):
    return lead_time.lead_time_coverage(_items(spark, folder))


@query("part_match_coverage")
def _(spark, folder):
    return lead_time.part_match_totals(_timed(spark, folder), _items(spark, folder))


def _priced(spark, folder):
    return pricing.with_price_history(pricing.price_store(_identified(spark, folder), LINE))


@query("price_history")
def _(spark, folder):
    return _priced(spark, folder).select(
        *LINE, "unit_price", "commercial_part_key", "commercial_currency_key", "commercial_uom_key",
        "commercial_base_eligible", "previous_unit_price", "price_comparison_eligible",
        "price_change_pct", "price_stable", "price_increased")


@query("commercial_controls")
def _(spark, folder):
    return pricing.price_totals(_priced(spark, folder))


def _ncrs(spark, folder):
    return ncr.with_ncr_measures(ingest.clean_ncrs(sample.ncrs_raw(_tables(spark, folder))))


@query("ncr_metrics")
def _(spark, folder):
    return _ncrs(spark, folder).select(
        "ncr_number", *VENDOR_KEY, "supplier_linked", "ncr_quantity_anomaly", "quality_eligible",
        "quality_quantity", "quality_rejected_quantity", "responsiveness_eligible", "resolved_flag",
        "unresolved_flag")


@query("ncr_controls")
def _(spark, folder):
    return ncr.ncr_totals(_ncrs(spark, folder))


# --- vendor grain --------------------------------------------------------------------

@query("vendor_po_summary")
def _(spark, folder):
    return cards.order_summary(cards.load_sample(spark, folder))


@query("vendor_ncr_summary")
def _(spark, folder):
    keys = vendor_summary.vendor_keys(_vendor_keys(spark, folder))
    return vendor_summary.summarize_ncrs(_ncrs(spark, folder)).join(keys, VENDOR_KEY, "left_semi")


@query("aggregation_controls")
def _(spark, folder):
    data = cards.load_sample(spark, folder)
    return reports.aggregation_controls(vendor_summary.summarize_orders(cards.order_store(data), data.items, totals=True))


@query("ncr_vendor_match")
def _(spark, folder):
    keys = vendor_summary.vendor_keys(_vendor_keys(spark, folder))
    return vendor_summary.with_match_status(_ncrs(spark, folder), keys).select(
        "ncr_number", *VENDOR_KEY, "match_status")


def _unmatched(spark, folder):
    return cards.unmatched(cards.load_sample(spark, folder))


@query("unmatched_ncrs")
def _(spark, folder):
    return _unmatched(spark, folder).select("ncr_number", *VENDOR_KEY, "match_status",
                                            "po_location_count")


@query("vendor_name_locations")
def _(spark, folder):
    return vendor_summary.name_locations(_vendor_keys(spark, folder))


@query("vendor_summary")
def _(spark, folder):
    return cards.vendor_summary(cards.load_sample(spark, folder))


@query("ncr_match_controls")
def _(spark, folder):
    vendors = vendor_summary.vendor_keys(_vendor_keys(spark, folder))
    return vendor_summary.match_totals(vendors, vendor_summary.summarize_ncrs(_ncrs(spark, folder)))


# --- scoring -------------------------------------------------------------------------

def _card(spark, folder):
    return cards.scorecard(cards.load_sample(spark, folder), RULES)


# Other thresholds and letters, so that rarely reached grades and N/A occur too.
ALTERNATIVE_RULES = {**RULES, "grade_thresholds": {"GOLD": 75, "SILVER": 55, "BRONZE": 45},
                     "overall": {"minimum_available_components": 5}}


@query("vendor_scores")
def _(spark, folder):
    columns = [x for c in COMPONENTS for x in (c.score, c.status, c.grade)]
    return _card(spark, folder).select(*VENDOR_KEY, "supplier_linked_ncr_rate_pct", *columns)


@query("vendor_overall")
def _(spark, folder):
    return _card(spark, folder).select(
        *VENDOR_KEY, "prototype_scored_component_count", "prototype_weight_coverage_pct",
        "prototype_overall_score", "prototype_overall_status", "prototype_overall_grade")


@query("vendor_scores_alternative_rules")
def _(spark, folder):
    card = cards.scorecard(cards.load_sample(spark, folder), ALTERNATIVE_RULES)
    return card.select(*VENDOR_KEY, *[c.grade for c in COMPONENTS], "prototype_overall_score",
                       "prototype_overall_status", "prototype_overall_grade")


@query("scorecard")
def _(spark, folder):
    return _card(spark, folder)


# --- reports -------------------------------------------------------------------------

@query("dashboard_counts")
def _(spark, folder):
    return reports.dashboard_counts(cards.load_sample(spark, folder), RULES)


CARD_REPORTS = {
    "grade_distribution": lambda card: reports.grade_distribution(card, RULES),
    "component_coverage": lambda card: reports.component_coverage(card, RULES),
    "vendor_list_search": lambda card: reports.vendor_list(card, "nation_1"),
    "vendor_detail": lambda card: reports.vendor_detail(card, "SUPPLIER#000000000 (APPROVED)", ""),
    "scorecard_export": reports.scorecard_export,
    "vendor_component_detail": lambda card: reports.component_detail(card, RULES),
    "vendor_supporting_detail": reports.supporting_detail,
    "top_scored_vendor": reports.top_scored_vendor,
    "vendor_picker": reports.vendor_picker,
    "component_grade_distribution": lambda card: reports.component_grades(card, RULES),
    "quality_status_grade_crosstab": reports.quality_crosstab,
    "overall_coverage": reports.overall_coverage,
    "scored_component_distribution": reports.scored_component_distribution,
    "weight_coverage_distribution": reports.weight_coverage_distribution,
    "scorecard_preview": reports.preview,
}


def _card_report(report):
    return lambda spark, folder: report(_card(spark, folder))


for _name, _report in CARD_REPORTS.items():
    query(_name)(_card_report(_report))


@query("data_review_vendors")
def _(spark, folder):
    return reports.review_vendors(_assessed(spark, folder))


@query("data_review_ncrs")
def _(spark, folder):
    return reports.review_ncrs(_unmatched(spark, folder))


@query("unmatched_ncr_export")
def _(spark, folder):
    return _unmatched(spark, folder)


@query("vendor_review_export")
def _(spark, folder):
    return reports.vendor_review_export(_assessed(spark, folder))


@query("final_controls")
def _(spark, folder):
    return reports.final_controls(cards.load_sample(spark, folder), RULES)


@query("snapshot_refresh")
def _(spark, folder):
    path = work_folder(spark, "snapshot")
    card = _card(spark, folder)
    reports.refresh_snapshot(spark, card, path, census.AS_OF)
    # Five minutes later the stored one is still fresh and is served as it is.
    stored = reports.refresh_snapshot(spark, card, path, census.AS_OF + dt.timedelta(minutes=5))
    return stored.select(*VENDOR_KEY, "prototype_overall_score", "prototype_overall_grade",
                         "refreshed_at")


# --- reconciliation ------------------------------------------------------------------

@query("recon_stage_totals")
def _(spark, folder):
    return reconcile.stage_totals({"left": cards.load_sample(spark, folder)}).drop("source")


def _both_sources(spark, folder):
    t = _tables(spark, folder).keep_lines()
    return {"left": cards.load_sample(spark, folder, t), "right": reconcile.load_system(spark, folder, tables=t)}


@query("recon_stage_diff")
def _(spark, folder):
    return reconcile.totals_difference(reconcile.stage_totals(_both_sources(spark, folder)))


def _vendor_diff(spark, folder):
    return reconcile.vendor_difference(_both_sources(spark, folder))


@query("recon_vendor_diff")
def _(spark, folder):
    return _vendor_diff(spark, folder).orderBy(*reconcile.by_difference())


@query("recon_vendor_summary")
def _(spark, folder):
    return reconcile.difference_summary(_vendor_diff(spark, folder))


@query("recon_top_diffs")
def _(spark, folder):
    return reconcile.top_differences(_vendor_diff(spark, folder))


PARITY_KEYS = {"purchase_orders": LINE, "ncrs": ["ncr_number"], "items": ["part_number"],
               "vendors": ["company_id"]}
# The extract takes these from the directory and the receipt log, everything else from the line.
PARITY_APART = {"purchase_orders": ("vendor_name", "last_receipt_date", "received_qty")}


@query("dataset_parity")
def _(spark, folder):
    t = _tables(spark, folder).keep_lines()
    raw, system = _raw_frames(t), reconcile.load_system(spark, folder, tables=t)
    pairs = {"purchase_orders": (ingest.clean_purchase_orders(raw["purchase_orders"], fill=False),
                                 system.purchase_orders),
             "ncrs": (ingest.clean_ncrs(raw["ncrs"]), system.ncrs),
             "items": (ingest.clean_items(raw["items"]), system.items),
             "vendors": (raw["vendors"], system.vendors)}
    out = None
    for dataset, (left, right) in pairs.items():
        key = PARITY_KEYS[dataset]
        columns = [c for c in contracts.contract(dataset)
                   if c in left.columns and c in right.columns and c not in key]
        apart = PARITY_APART.get(dataset, ())
        if not apart:
            # The joins of the extract run for this write and not for each reading. With columns
            # apart, each reading runs only the joins that its columns need.
            right = written(right.select(*key, *columns), f"parity-{dataset}", "zstd")
        part = reconcile.dataset_parity(dataset, left, right, key, columns, apart=apart)
        out = part if out is None else out.unionByName(part)
    return out


@query("downstream_controls")
def _(spark, folder):
    return reconcile.totals_difference(reconcile.downstream_totals(_both_sources(spark, folder), RULES))


# --- census --------------------------------------------------------------------------

def _over(source, report):
    return lambda spark, folder: report(source(spark, folder))


def _facts(spark, folder):
    return census.line_facts(_tables(spark, folder))


def _lines(spark, folder):
    return sample.order_lines(_tables(spark, folder))


def _raw_ncrs(spark, folder):
    return sample.ncrs_raw(_tables(spark, folder))


def _companies(spark, folder):
    return census.company_facts(_tables(spark, folder))


def _names(spark, folder):
    return sample.display_names(_tables(spark, folder))


CENSUS = {
    "scope_census": (_facts, census.scope_census),
    "scope_fingerprint": (_facts, lambda lines: census.scope_fingerprint(lines, target="everything")),
    "scope_distinct_suppliers": (_facts, census.scope_suppliers),
    "date_basis_sensitivity": (_facts, census.date_basis),
    "date_basis_by_scope": (_facts, census.date_basis_by_scope),
    "date_agreement": (_lines, census.date_agreement),
    "delivery_by_year": (_facts, census.delivery_by_year),
    "delivery_by_window": (_facts, census.delivery_by_window),
    "receipt_qty_agreement": (_facts, census.receipt_agreement),
    "fullness_basis": (_facts, census.fullness_basis),
    "receipt_state": (_facts, census.receipt_state),
    "need_by_coverage": (_facts, census.need_by_coverage),
    "lines_per_project": (_lines, census.lines_per_project),
    "project_running_total": (_lines, census.project_running_total),
    "lines_per_buyer": (_lines, census.lines_per_buyer),
    "rolling_window_counts": (_lines, census.rolling_windows),
    "distinct_po_supplier": (_lines, census.distinct_orders_and_suppliers),
    "lines_by_year": (_lines, census.issued_lines_by_year),
    "ncr_supplier_path": (_ncr_facts, census.supplier_paths),
    "ncr_cumulative_by_year": (_raw_ncrs, census.ncrs_to_date),
    "ncr_by_year_running": (_raw_ncrs, census.ncrs_newest_first),
    "ncr_subpopulations": (_raw_ncrs, census.ncr_subpopulations),
    "name_rebuild_match": (_ncr_facts, census.name_agreement),
    "name_rebuild_mismatches": (_ncr_facts, census.name_mismatches),
    "ncr_po_supplier_disagreement": (_ncr_facts, census.po_supplier_disagreement),
    "vendor_population_scopes": (_companies, census.vendor_populations),
    "vendor_scope_fingerprint": (_companies, census.vendor_scope_fingerprint),
    "incomplete_by_field": (_companies, census.incomplete_by_field),
    "key_uniqueness": (_names, lambda df: census.key_uniqueness(df, "company_id")),
    "name_suffix_distribution": (_names, census.suffix_distribution),
    "bracket_names": (_names, census.bracket_names),
    "duplicate_key_groups": (_vendors, census.duplicate_vendor_groups),
    "lead_time_bands": (_items, census.lead_time_bands),
    "lead_time_population": (_items, census.lead_time_population),
}
for _name, (_source, _report) in CENSUS.items():
    query(_name)(_over(_source, _report))


@query("ncr_scope_counts")
def _(spark, folder):
    t = _tables(spark, folder)
    kinds = sample.projects(t).select("project_number", "project_type")
    return census.ncr_scopes(sample.ncrs_raw(t),
                             sample.order_lines(t).join(kinds, "project_number", "left"))


@query("lookup_coverage")
def _(spark, folder):
    t = _tables(spark, folder)
    return census.lookup_coverage(sample.supplier_records(t), sample.display_names(t), "company_id")


@query("lead_time_line_coverage")
def _(spark, folder):
    return census.lead_time_lines(_lines(spark, folder), _items(spark, folder))


@query("receipts_per_line")
def _(spark, folder):
    return census.receipts_per_line(sample.receipts(_tables(spark, folder)))


@query("column_population")
def _(spark, folder):
    out = None
    for table, df in _raw_frames(_tables(spark, folder)).items():
        part = census.column_population(df, table)
        out = part if out is None else out.unionByName(part)
    return out


@query("column_candidates")
def _(spark, folder):
    return census.column_candidates(_raw_frames(_tables(spark, folder)))
