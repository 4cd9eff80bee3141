"""One SQL text per registered query; shared steps are named o_..."""

from oracle.base import _LADDER

SQL: dict[str, str] = {}

KEY = "vendor_match_name, vendor_match_city"
LINE = "po_number, line_no, part_id, supplier_company_id"


def r(*columns: str) -> str:
    """Columns rounded to six digits under their own names."""
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def longs(pairs: dict[str, str], source: str, name: str = "measure", value: str = "value") -> str:
    return " UNION ALL ".join(
        f"SELECT '{k}' AS {name}, CAST(({e}) AS BIGINT) AS {value} FROM {source}" for k, e in pairs.items())


# --- sources and contracts ---
_HEADER = "part_number IS NULL AND vendor_name IS NULL AND ordered_qty IS NULL AND order_date IS NULL"
_BAD = ("po_number IS NULL OR vendor_name IS NULL OR part_number IS NULL OR ordered_qty IS NULL "
        "OR order_date IS NULL")
SQL["po_header_strip"] = f"SELECT {LINE}, part_number, vendor_name FROM o_sheet WHERE NOT ({_HEADER})"
SQL["po_required_split"] = f"""
SELECT {LINE}, CASE WHEN {_BAD} THEN 'REJECTED' ELSE 'VALID' END AS row_status FROM o_sheet WHERE NOT ({_HEADER})"""
SQL["po_type_contract"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{k}' AS expected, '{k}' AS actual, TRUE AS ok, count({c}) AS rows_populated FROM o_sheet"
    for k, cs in (("numeric", ("ordered_qty", "received_qty", "unit_price", "extended_value")),
                  ("datetime", ("order_date", "required_date", "revised_date", "last_receipt_date")))
    for c in cs)
SQL["coerce_numeric"] = "SELECT part_number, lead_time_text, lead_time, list_price FROM o_items"
SQL["coerce_datetime"] = """
SELECT o_orderkey AS po_number,
       CASE WHEN o_orderstatus = 'P' THEN 'week ' || month(o_orderdate)
            ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_date_text,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS order_date FROM orders"""
SQL["coerce_boolean"] = "SELECT ncr_number, resolved_text, resolved FROM o_ncr"
SQL["po_receipt_fill"] = f"SELECT {LINE}, coalesce(received_qty, 0) AS received_qty FROM o_a_po"
SQL["typed_null_projection"] = """
SELECT ncr_number, CAST(NULL AS VARCHAR) AS project_number, CAST(NULL AS VARCHAR) AS machine_code,
       CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS origin, CAST(NULL AS INTEGER) AS total_tasks,
       CAST(NULL AS INTEGER) AS outstanding_tasks, resolved_text AS resolved, released,
       CAST(NULL AS VARCHAR) AS source_info, po_number, part_number, quantity, quantity_rejected,
       CAST(NULL AS VARCHAR) AS interim_action, CAST(NULL AS VARCHAR) AS root_cause,
       CAST(NULL AS VARCHAR) AS corrective_pre_action, CAST(NULL AS DOUBLE) AS ncr_costs,
       CAST(NULL AS DOUBLE) AS ncr_hours, CAST(NULL AS TIMESTAMP) AS target_date,
       CAST(NULL AS TIMESTAMP) AS date_follow_up, created_date, vendor_name,
       CAST(NULL AS VARCHAR) AS item_id, supplier_company_id FROM o_ncr_source"""

_CONTRACTS = {
    "purchase_orders": ("o_sheet", """po_number project_number ordered_qty part_number vendor_name unit_price
        required_date revised_date last_receipt_date uom received_qty order_date extended_value currency_code""",
        "machine_code po_part_number currency_rate supplier_number order_number receiving_date"),
    "ncrs": ("(SELECT *, resolved_text AS resolved FROM o_ncr_source)",
        "ncr_number resolved released po_number part_number quantity quantity_rejected created_date vendor_name",
        """project_number machine_code title origin total_tasks outstanding_tasks source_info interim_action
        root_cause corrective_pre_action ncr_costs ncr_hours target_date date_follow_up item_id"""),
    "items": ("(SELECT * REPLACE (lead_time_text AS lead_time) FROM o_items)",
        "part_number description category list_price lead_time",
        """uom revision lpp quantity_on_hand preferred_supplier supplier_part_number last_supplier manufacturer
        manuf_part_number quantity_reserved"""),
    "vendors": ("o_vendors", "company_id vendor_name address_line_1 city state_province postal_code",
        "address_line_2 country"),
}
_NUMBERS = """ordered_qty received_qty unit_price extended_value quantity quantity_rejected list_price lead_time""".split()


def _plain_text(c: str) -> str:
    if c in _NUMBERS:
        return f"CAST(CAST(round({c} * 1000) AS BIGINT) AS VARCHAR)"
    if c == "released" or c.endswith("_date"):
        return f"strftime({c}, '%Y%m%d%H%M%S')"
    return f"CAST({c} AS VARCHAR)"


def _digest(text: str) -> str:
    return f"CAST(coalesce(sum(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)) % {1 << 61}, 0) AS BIGINT)"


_PO_NAMES = _CONTRACTS["purchase_orders"][1:]
_LOADED = {
    "purchase_orders": ("(SELECT * REPLACE (coalesce(received_qty, 0) AS received_qty) FROM o_a_po)", *_PO_NAMES),
    "rejected_lines": (f"(SELECT * FROM o_sheet WHERE NOT ({_HEADER}) AND ({_BAD}))", *_PO_NAMES),
    "ncrs": ("o_ncr", *_CONTRACTS["ncrs"][1:]),
    "items": ("o_items", *_CONTRACTS["items"][1:]),
    "vendors": _CONTRACTS["vendors"],
}
SQL["src_load_contract"] = " UNION ALL ".join(
    f"SELECT '{d}' AS table_name, '{c}' AS column_name, count(*) AS rows_total, "
    f"count({c if have else 'NULL'}) AS rows_populated, {_digest(_plain_text(c)) if have else 0} AS value_digest FROM {src}"
    for d, (src, present, absent) in _LOADED.items()
    for have, names in ((True, present), (False, absent)) for c in names.split())
SQL["contract_gaps"] = " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, '{c}' AS column_name, {have} AS resolved, FALSE AS blocking, "
    + f"count({c if have else 'NULL'})" + f" AS rows_populated FROM {src}"
    for d, (src, present, absent) in _CONTRACTS.items()
    for have, names in ((True, present), (False, absent)) for c in names.split())
SQL["po_extract"] = f"""
SELECT {LINE}, s.part_number, s.vendor_name, project_number, c_name AS project_name, ordered_qty,
       s.received_qty, l.received_qty AS line_received_qty, s.last_receipt_date, k.supplier_record AS in_supplier_table
FROM o_system s JOIN (SELECT {LINE}, received_qty FROM o_lines) l USING ({LINE})
LEFT JOIN customer ON c_custkey = project_number
LEFT JOIN o_companies k ON k.company_id = supplier_company_id"""
SQL["receipt_basis"] = f"""
SELECT 'log' AS basis, {LINE}, log_received_qty AS received_qty, log_last_receipt AS last_receipt_date FROM o_facts
UNION ALL SELECT 'line', {LINE}, received_qty, last_receipt_date FROM o_facts"""
_SCOPE = "header_active AND coalesce(archived, 0) = 0 AND (printed OR emailed)"
SQL["po_scope"] = f"""
SELECT {LINE}, order_date, buyer FROM o_lines
WHERE {_SCOPE} AND order_date >= TIMESTAMP '2001-08-01' - INTERVAL 36 MONTH"""
SQL["ncr_extract"] = """
SELECT ncr_number, vendor_name, po_vendor_name, supplier_display_name, created_date FROM o_ncr_facts
WHERE ncr_active AND created_date >= TIMESTAMP '2001-08-01' - INTERVAL 36 MONTH"""
SQL["item_extract"] = """
SELECT item_id, part_number, lead_time_text AS lead_time, quantity_on_hand FROM o_items LEFT JOIN (
  SELECT l_partkey AS item_id, sum(l_quantity) AS quantity_on_hand FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1)
USING (item_id)"""
SQL["lead_time_zero_null"] = """
SELECT part_number, lead_time, nullif(lead_time, 0) AS usable_lead_time FROM o_items"""


def scopes(pairs: dict[str, str], source: str, value: str, label: str = "scope") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, count(*) AS {value} FROM {source} WHERE {cond}"
        for name, cond in pairs.items())


SQL["vendor_scope"] = " UNION ALL ".join(
    f"SELECT '{n}' AS scope, company_id, company_name, city FROM o_company_facts WHERE {w}"
    for n, w in (("active_with_address", "active AND located"), ("supplier_table", "supplier_record"),
                 ("active_suppliers", "supplier_record AND active"), ("purchased_from", "bought"),
                 ("all_companies", "TRUE")))
SQL["supplier_display_name"] = "SELECT company_id, looked_up, display_name FROM o_shown"
SQL["receipt_rollup"] = "SELECT * FROM o_rollup"
# --- identity and vendor master ---
SQL["vendor_identity"] = f"SELECT {LINE}, vendor_name, {KEY} FROM o_a_po"
SQL["vendor_key_label"] = f"""
SELECT DISTINCT {KEY}, coalesce(vendor_match_name, 'UNKNOWN VENDOR') || ' | '
       || coalesce(vendor_match_city, 'NO LOCATION') AS vendor_key FROM o_a_po"""
SQL["vendor_completeness"] = """
SELECT company_id, vendor_name, address_line_1, city, state_province, postal_code, vendor_quality_status,
       missing_components FROM o_vendor_quality"""
SQL["vendor_exact_duplicates"] = """
SELECT company_id, vendor_name_key, address_key, postal_code_key, exact_duplicate_flag FROM o_vendor_review"""
SQL["vendor_partial_name_candidates"] = """
SELECT company_id, vendor_name_key, (SELECT count(*) FROM o_vendor_quality c
       WHERE c.vendor_quality_status = 'COMPLETE' AND c.vendor_name_key = v.vendor_name_key) AS complete_name_candidate_count
FROM o_vendor_quality v WHERE vendor_quality_status = 'INCOMPLETE'"""
SQL["vendor_partial_name_addr_candidates"] = """
SELECT company_id, vendor_name_key, address_key, (SELECT count(*) FROM o_vendor_quality c
       WHERE c.vendor_quality_status = 'COMPLETE' AND c.vendor_name_key = v.vendor_name_key
         AND c.address_key = v.address_key) AS complete_candidate_count
FROM o_vendor_quality v WHERE vendor_quality_status = 'INCOMPLETE'"""
SQL["vendor_location_candidates"] = """
SELECT company_id, upper(trim(city)) AS city_key, upper(trim(state_province)) AS state_key,
       (SELECT count(*) FROM o_vendor_quality c WHERE c.vendor_quality_status = 'COMPLETE'
        AND upper(trim(c.city)) = upper(trim(v.city))
        AND upper(trim(c.state_province)) = upper(trim(v.state_province))) AS location_candidates
FROM o_vendor_quality v WHERE vendor_quality_status = 'INCOMPLETE' AND trim(city) <> '' AND trim(state_province) <> ''"""
# The longest common block of two texts, then of what lies before and after it, and so on:
# twice the characters in blocks over all characters is the similarity.
SQL["vendor_fuzzy_candidates"] = """
WITH RECURSIVE located AS (
  SELECT *, upper(trim(city)) AS city_key, upper(trim(state_province)) AS state_key FROM o_vendor_quality
  WHERE trim(city) <> '' AND trim(state_province) <> '' AND vendor_name_key <> ''),
p AS (
  SELECT i.company_id AS company_id_incomplete, i.vendor_name_key AS vendor_name_key_incomplete,
         i.address_key AS address_key_incomplete, i.city_key, i.state_key, c.company_id AS company_id_complete,
         c.vendor_name_key AS vendor_name_key_complete, c.address_key AS address_key_complete
  FROM located i JOIN located c ON i.city_key = c.city_key AND i.state_key = c.state_key
  WHERE i.vendor_quality_status = 'INCOMPLETE' AND c.vendor_quality_status = 'COMPLETE'),
t AS (
  SELECT DISTINCT * FROM (
    SELECT vendor_name_key_incomplete AS a, vendor_name_key_complete AS b FROM p
    UNION ALL SELECT address_key_incomplete, address_key_complete FROM p)
  WHERE a IS NOT NULL AND b IS NOT NULL),
starts AS (
  SELECT a, b, unnest(range(length(a))) AS i FROM t),
cells AS (
  SELECT a, b, i, unnest(range(length(b))) AS j FROM starts),
runs AS (
  SELECT a, b, i, j, list_max(list_filter(range(1, least(length(a) - i, length(b) - j) + 1),
                     lambda k: substr(a, i + 1, k) = substr(b, j + 1, k))) AS n
  FROM cells WHERE substr(a, i + 1, 1) = substr(b, j + 1, 1)),
blocks AS (
  SELECT a, b, list({'n': n, 'i': i, 'j': j}) AS cell FROM runs GROUP BY a, b),
walk AS (
  SELECT a, b, 0 AS ia, length(a) AS ea, 0 AS ib, length(b) AS eb, 0 AS n FROM t
  UNION ALL
  SELECT a, b, part.ia, part.ea, part.ib, part.eb, part.n FROM (
    SELECT a, b, unnest([{'ia': ia, 'ea': -best.i, 'ib': ib, 'eb': -best.j, 'n': best.n},
                         {'ia': -best.i + best.n, 'ea': ea, 'ib': -best.j + best.n, 'eb': eb, 'n': 0}]) AS part
    FROM (SELECT w.*, list_max(list_transform(list_filter(cell,
                     lambda x: x.i >= w.ia AND x.i < w.ea AND x.j >= w.ib AND x.j < w.eb),
                     lambda x: {'n': least(x.n, w.ea - x.i, w.eb - x.j), 'i': -x.i, 'j': -x.j})) AS best
          FROM walk w JOIN blocks USING (a, b) WHERE w.ea > w.ia AND w.eb > w.ib)
    WHERE best IS NOT NULL)),
ratio AS (
  SELECT a, b, 200.0 * sum(n) / nullif(length(a) + length(b), 0) AS similarity FROM walk GROUP BY a, b)
SELECT p.*, round(n.similarity, 6) AS name_similarity, round(d.similarity, 6) AS address_similarity
FROM p JOIN ratio n ON n.a = vendor_name_key_incomplete AND n.b = vendor_name_key_complete
LEFT JOIN ratio d ON d.a = address_key_incomplete AND d.b = address_key_complete
WHERE n.similarity >= 85"""
SQL["vendor_review_status"] = """
SELECT company_id, vendor_quality_status, review_required, review_reason FROM o_vendor_review"""
SQL["vendor_missing_field_counts"] = " UNION ALL ".join(
    f"SELECT '{f}' AS field, count(*) FILTER ({c}) AS missing FROM o_vendor_quality WHERE vendor_quality_status = 'INCOMPLETE'"
    for f, c in (("vendor_name", "no_name"), ("address_line_1", "no_street"), ("postal_code", "no_code")))
SQL["vendor_duplicate_groups"] = """
SELECT count(*) AS duplicate_records, count(DISTINCT (vendor_name_key, address_key, postal_code_key)) AS duplicate_groups
FROM o_vendor_review WHERE exact_duplicate_flag"""
SQL["vendor_quality_summary"] = """
SELECT 'quality status' AS section, vendor_quality_status AS value, count(*) AS vendors FROM o_vendor_review GROUP BY 2
UNION ALL SELECT 'review reason', review_reason, count(*) FROM o_vendor_review WHERE review_reason IS NOT NULL GROUP BY 2
UNION ALL SELECT 'total', 'review required', count(*) FROM o_vendor_review WHERE review_required
UNION ALL SELECT 'total', 'vendor records', count(*) FROM o_vendor_review"""

# --- line measures ---
SQL["delivery_metrics"] = f"""
SELECT {LINE}, target_date, fully_received, delivery_eligible, on_time, late, days_late, late_days_only
FROM o_a_delivery"""
SQL["delivery_controls"] = """
SELECT count(*) FILTER (delivery_eligible) AS delivery_eligible, count(*) FILTER (NOT delivery_eligible) AS delivery_ineligible,
       count(*) AS po_rows, count(*) FILTER (on_time) AS on_time, count(*) FILTER (late) AS late,
       count(*) FILTER (on_time OR late) AS represented FROM o_a_delivery"""
SQL["part_match_key"] = """
SELECT part_number, nullif(upper(trim(part_number)), '') AS part_key FROM o_items
UNION ALL SELECT CAST(p_partkey AS VARCHAR), CAST(p_partkey AS VARCHAR) FROM part"""
SQL["item_lead_time_reference"] = "SELECT * FROM o_a_reference"
SQL["item_lead_time_conflicts"] = """
SELECT upper(trim(part_number)) AS part_number_match_key, count(DISTINCT lead_time) AS lead_time_variants
FROM o_items GROUP BY 1 HAVING count(DISTINCT lead_time) > 1"""
SQL["lead_time_metrics"] = f"""
SELECT {LINE}, item_lead_time_days, actual_lead_time_days, lead_time_eligible, lead_time_variance_days,
       lead_time_adherent, eligible_actual_lead_time_days FROM o_a_lead"""
SQL["item_lead_time_coverage"] = """
SELECT count(*) AS items, count(lead_time) AS with_lead_time,
       count(DISTINCT CASE WHEN lead_time IS NOT NULL THEN part_number END) AS parts_with_lead_time FROM o_items"""
SQL["part_match_coverage"] = """
SELECT count(*) AS po_rows,
       count(*) FILTER (upper(trim(part_number)) IN (SELECT upper(trim(part_number)) FROM o_items)) AS part_in_item_master,
       count(item_lead_time_days) AS with_usable_lead_time, count(*) FILTER (lead_time_eligible) AS lead_time_eligible,
       count(*) FILTER (lead_time_adherent) AS lead_time_adherent,
       count(*) FILTER (lead_time_eligible AND NOT lead_time_adherent) AS lead_time_non_adherent FROM o_a_lead"""
SQL["price_history"] = f"""
SELECT {LINE}, unit_price, commercial_part_key, commercial_currency_key, commercial_uom_key,
       commercial_base_eligible, previous_unit_price, price_comparison_eligible, {r('price_change_pct')},
       price_stable, price_increased FROM o_a_price"""
SQL["commercial_controls"] = """
SELECT count(*) AS po_rows, count(*) FILTER (commercial_base_eligible) AS commercial_base_eligible,
       count(*) FILTER (price_comparison_eligible) AS price_comparisons, count(*) FILTER (price_stable) AS price_stable,
       count(*) FILTER (price_increased) AS price_increased,
       count(*) FILTER (price_stable OR price_increased) AS represented FROM o_a_price"""
SQL["ncr_metrics"] = f"""
SELECT ncr_number, {KEY}, supplier_linked, ncr_quantity_anomaly, quality_eligible, quality_quantity,
       quality_rejected_quantity, responsiveness_eligible, resolved_flag, unresolved_flag FROM o_ncr"""
SQL["ncr_controls"] = """
SELECT count(*) AS ncr_rows, count(*) FILTER (supplier_linked) AS supplier_linked,
       count(*) FILTER (NOT supplier_linked) AS without_supplier,
       count(*) FILTER (supplier_linked AND vendor_match_city IS NOT NULL) AS linked_with_location,
       count(*) FILTER (supplier_linked AND vendor_match_city IS NULL) AS linked_without_location,
       count(*) FILTER (quality_eligible) AS quality_eligible,
       count(*) FILTER (supplier_linked AND ncr_quantity_anomaly) AS quantity_anomalies,
       count(*) FILTER (responsiveness_eligible) AS responsiveness_eligible,
       count(*) FILTER (resolved_flag) AS resolved, count(*) FILTER (unresolved_flag) AS unresolved FROM o_ncr"""

# --- vendor grain ---
ORDER_COUNTS = """po_transaction_count, distinct_po_count, received_transaction_count, fully_received_count,
    delivery_eligible_count, on_time_count, late_count, lead_time_eligible_count, lead_time_adherent_count,
    price_comparison_count, price_stable_count, price_increase_count"""
ORDER_DOUBLES = ("total_ordered_qty", "total_received_qty", "average_days_late", "average_actual_lead_time_days",
                 "average_lead_time_variance_days", "average_price_change_pct", "on_time_delivery_pct",
                 "lead_time_adherence_pct", "price_stability_pct")
NCR_COUNTS = """supplier_linked_ncr_count, quality_eligible_ncr_count, ncr_quantity_anomaly_count,
    responsiveness_eligible_ncr_count, resolved_ncr_count, unresolved_ncr_count"""
NCR_DOUBLES = ("total_rejected_qty", "total_ncr_quantity", "quality_rejected_qty", "ncr_rejected_pct",
               "responsiveness_proxy_pct")
PARTS = ("delivery", "quality", "lead_time", "responsiveness", "commercial")
SCORES = tuple(f"{p}_prototype_score" for p in PARTS)
GRADES = ", ".join(f"{p}_prototype_grade" for p in PARTS)
STATUSES = ", ".join(f"{p}_score_status" for p in PARTS)
SUMMARY = f"{KEY}, {ORDER_COUNTS}, {r(*ORDER_DOUBLES)}, {NCR_COUNTS}, {r(*NCR_DOUBLES)}"
CARD = f"""{SUMMARY}, {r('supplier_linked_ncr_rate_pct', *SCORES)}, {GRADES}, {STATUSES},
    prototype_scored_component_count, {r('prototype_weight_coverage_pct', 'prototype_overall_score')},
    prototype_overall_status, prototype_overall_grade"""

SQL["vendor_po_summary"] = f"SELECT {KEY}, {ORDER_COUNTS}, {r(*ORDER_DOUBLES)} FROM o_a_orders"
SQL["vendor_ncr_summary"] = f"""
SELECT {KEY}, {NCR_COUNTS}, {r(*NCR_DOUBLES)} FROM o_ncr_groups SEMI JOIN o_keys USING ({KEY})"""
_CONTROLS = {"po_transactions": ("count(*)", "po_transaction_count"),
             "delivery_eligible": ("count(*) FILTER (delivery_eligible)", "delivery_eligible_count"),
             "lead_time_eligible": ("count(*) FILTER (lead_time_eligible)", "lead_time_eligible_count"),
             "price_comparisons": ("count(*) FILTER (price_comparison_eligible)", "price_comparison_count")}
SQL["aggregation_controls"] = "SELECT *, line_total = vendor_total AS agrees FROM (" + " UNION ALL ".join(
    f"SELECT '{m}' AS measure, (SELECT {a} FROM o_a_price) AS line_total, "
    f"CAST((SELECT sum({c}) FROM o_a_orders) AS BIGINT) AS vendor_total"
    for m, (a, c) in _CONTROLS.items()) + ")"
SQL["ncr_vendor_match"] = f"SELECT ncr_number, {KEY}, match_status FROM o_matched"
SQL["unmatched_ncrs"] = f"SELECT ncr_number, {KEY}, match_status, po_location_count FROM o_stray"
SQL["vendor_name_locations"] = """
SELECT vendor_match_name, count(DISTINCT vendor_match_city) AS po_location_count FROM o_a_po GROUP BY 1"""
SQL["vendor_summary"] = f"SELECT {SUMMARY} FROM o_summary"
SQL["ncr_match_controls"] = """
SELECT count(*) FILTER (match_status = 'MATCHED') AS matched,
       count(*) FILTER (match_status = 'UNMATCHED') AS unmatched_with_location,
       count(*) FILTER (match_status = 'MISSING LOCATION') AS missing_location, count(*) AS accounted_for FROM o_matched"""

# --- scoring ---
SQL["vendor_scores"] = f"SELECT {KEY}, {r('supplier_linked_ncr_rate_pct', *SCORES)}, {STATUSES}, {GRADES} FROM o_card"
SQL["vendor_overall"] = f"""
SELECT {KEY}, prototype_scored_component_count, {r('prototype_weight_coverage_pct', 'prototype_overall_score')},
       prototype_overall_status, prototype_overall_grade FROM o_card"""
SQL["vendor_scores_alternative_rules"] = f"""
SELECT {KEY}, {GRADES}, {r('prototype_overall_score')}, prototype_overall_status, prototype_overall_grade
FROM o_card_other"""
SQL["scorecard"] = f"SELECT {CARD} FROM o_card"

# --- reports ---
SQL["dashboard_counts"] = """
SELECT 'total_vendors' AS measure, count(*) AS value FROM o_vendor_review
UNION ALL SELECT 'vendor_review_count', count(*) FROM o_vendor_review WHERE review_required
UNION ALL SELECT 'scored_vendors', count(prototype_overall_score) FROM o_card
UNION ALL SELECT 'total_scorecard_rows', count(*) FROM o_card
UNION ALL SELECT 'unmatched_ncr_count', count(*) FROM o_stray"""
SQL["grade_distribution"] = " UNION ALL ".join(
    f"SELECT '{g}' AS grade, count(*) AS vendors FROM o_card WHERE prototype_overall_grade = '{g}'" for g, _ in _LADDER)
LABELS = dict(zip(PARTS, ("On-Time Delivery", "Quality / NCR", "Lead-Time Performance", "Responsiveness Proxy",
                          "Commercial Performance")))
SQL["component_coverage"] = " UNION ALL ".join(
    f"SELECT '{LABELS[p]}' AS component, count({p}_prototype_score) AS scored, "
    f"count(*) - count({p}_prototype_score) AS not_scored, "
    f"round_even(count({p}_prototype_score) / count(*) * 100, 1) AS coverage_pct FROM o_card" for p in PARTS)
SQL["vendor_list_search"] = f"""
SELECT {KEY}, po_transaction_count, {GRADES}, {r('prototype_overall_score')}, prototype_overall_grade,
       prototype_overall_status FROM o_card
WHERE contains(upper(coalesce(vendor_match_name, '')), 'NATION_1')
   OR contains(upper(coalesce(vendor_match_city, '')), 'NATION_1')"""
SQL["vendor_detail"] = f"""
SELECT {CARD} FROM o_card WHERE vendor_match_name = 'SUPPLIER#000000000 (APPROVED)' AND coalesce(vendor_match_city, '') = ''"""
SQL["data_review_vendors"] = """
SELECT vendor_name, city, address_line_1, postal_code, missing_components, review_reason FROM o_vendor_review
WHERE review_required"""
SQL["data_review_ncrs"] = f"SELECT ncr_number, {KEY}, part_number, po_location_count FROM o_stray"

HEADINGS = """vendor_key=Vendor Key;vendor_match_name=Vendor;vendor_match_city=Location;
prototype_overall_score=Prototype Overall Score;prototype_overall_grade=Prototype Overall Grade;
prototype_weight_coverage_pct=Weight Coverage %;prototype_scored_component_count=Scored Components;
prototype_overall_status=Overall Status;po_transaction_count=PO Transactions;distinct_po_count=Distinct POs;
total_ordered_qty=Total Ordered Qty;total_received_qty=Total Received Qty;delivery_eligible_count=Delivery Eligible;
on_time_count=On-Time;late_count=Late;on_time_delivery_pct=OTD %;average_days_late=Average Days Late;
delivery_prototype_score=Delivery Score;delivery_prototype_grade=Delivery Grade;delivery_score_status=Delivery Status;
supplier_linked_ncr_count=Supplier-Linked NCRs;supplier_linked_ncr_rate_pct=Supplier-Linked NCR Rate %;
quality_eligible_ncr_count=Quality-Eligible NCRs;total_ncr_quantity=Valid NCR Quantity;
quality_rejected_qty=Valid Rejected Qty;ncr_rejected_pct=NCR Rejected %;ncr_quantity_anomaly_count=NCR Qty Anomalies;
quality_prototype_score=Quality Score;quality_prototype_grade=Quality Grade;quality_score_status=Quality Status;
lead_time_eligible_count=Lead-Time Eligible;lead_time_adherent_count=Lead-Time Adherent;
average_actual_lead_time_days=Average Actual Lead Time;average_lead_time_variance_days=Average Lead-Time Variance;
lead_time_adherence_pct=Lead-Time Adherence %;lead_time_prototype_score=Lead-Time Score;
lead_time_prototype_grade=Lead-Time Grade;lead_time_score_status=Lead-Time Status;
responsiveness_eligible_ncr_count=Responsiveness-Eligible NCRs;resolved_ncr_count=Resolved NCRs;
unresolved_ncr_count=Unresolved NCRs;responsiveness_proxy_pct=Responsiveness Proxy - NCR Resolution %;
responsiveness_prototype_score=Responsiveness Score;responsiveness_prototype_grade=Responsiveness Grade;
responsiveness_score_status=Responsiveness Status;price_comparison_count=Price Comparisons;
price_stable_count=Price Stable / Decreased;price_increase_count=Price Increased;
average_price_change_pct=Average Price Change %;price_stability_pct=Price Stability %;
commercial_prototype_score=Commercial Score;commercial_prototype_grade=Commercial Grade;
commercial_score_status=Commercial Status"""
HEADING = dict(x.strip().split("=") for x in HEADINGS.split(";"))
DOUBLES = {*ORDER_DOUBLES, *NCR_DOUBLES, *SCORES, "supplier_linked_ncr_rate_pct", "prototype_weight_coverage_pct",
           "prototype_overall_score"}
SQL["scorecard_export"] = "SELECT " + ", ".join(
    (f"round({c}, 6)" if c in DOUBLES else c) + f' AS "{h}"' for c, h in HEADING.items()) + " FROM o_labelled"
_DETAIL = {"delivery": ("on_time_delivery_pct", "delivery_eligible_count", 25),
           "quality": ("supplier_linked_ncr_rate_pct", "po_transaction_count", 25),
           "lead_time": ("lead_time_adherence_pct", "lead_time_eligible_count", 15),
           "responsiveness": ("responsiveness_proxy_pct", "responsiveness_eligible_ncr_count", 15),
           "commercial": ("price_stability_pct", "price_comparison_count", 20)}
SQL["vendor_component_detail"] = " UNION ALL ".join(
    f"SELECT vendor_key, '{LABELS[p]}' AS component, CAST({w} AS DOUBLE) AS weight, round({m}, 6) AS metric, "
    f"{s} AS sample, round({p}_prototype_score, 6) AS score, {p}_prototype_grade AS grade, "
    f"{p}_score_status AS status FROM o_labelled" for p, (m, s, w) in _DETAIL.items())
_SECTIONS = {
    "Delivery": "delivery_eligible_count on_time_count late_count on_time_delivery_pct average_days_late",
    "Quality / NCR": """supplier_linked_ncr_count supplier_linked_ncr_rate_pct quality_eligible_ncr_count
        ncr_rejected_pct ncr_quantity_anomaly_count""",
    "Lead-Time Performance": """lead_time_eligible_count lead_time_adherent_count lead_time_adherence_pct
        average_actual_lead_time_days average_lead_time_variance_days""",
    "Responsiveness Proxy": """responsiveness_eligible_ncr_count resolved_ncr_count unresolved_ncr_count
        responsiveness_proxy_pct""",
    "Commercial Performance": """price_comparison_count price_stable_count price_increase_count
        average_price_change_pct price_stability_pct"""}
SQL["vendor_supporting_detail"] = " UNION ALL ".join(
    f"SELECT vendor_key, '{s}' AS section, '{HEADING[c]}' AS metric, round(CAST({c} AS DOUBLE), 6) AS value FROM o_labelled"
    for s, cs in _SECTIONS.items() for c in cs.split())
SQL["top_scored_vendor"] = f"""
SELECT vendor_key, {CARD} FROM (SELECT * FROM o_labelled WHERE prototype_overall_score IS NOT NULL
ORDER BY prototype_overall_score DESC, vendor_match_name NULLS LAST, vendor_match_city NULLS LAST LIMIT 1)"""
SQL["vendor_picker"] = """
SELECT vendor_key FROM (SELECT DISTINCT vendor_key, vendor_match_name, vendor_match_city FROM o_labelled)
ORDER BY vendor_match_name NULLS LAST, vendor_match_city NULLS LAST"""
SQL["unmatched_ncr_export"] = f"""
SELECT {KEY}, ncr_number, po_number, line_no, part_id, supplier_company_id, part_number, vendor_name, quantity,
       quantity_rejected, resolved, released, created_date, ncr_active, supplier_linked, ncr_quantity_anomaly,
       quality_eligible, responsiveness_eligible, quality_quantity, quality_rejected_quantity, resolved_flag,
       unresolved_flag, match_status, po_location_count FROM o_stray"""
SQL["vendor_review_export"] = """
SELECT company_id AS "Company ID", vendor_name AS "Vendor Name", address_line_1 AS "Address", city AS "City",
       state_province AS "Province / State", postal_code AS "Postal Code", vendor_quality_status AS "Vendor Data Status",
       exact_duplicate_flag AS "Exact Duplicate", review_reason AS "Review Reason",
       missing_components AS "Missing Component / Issue" FROM o_vendor_review WHERE review_required"""
SQL["component_grade_distribution"] = " UNION ALL ".join(
    f"SELECT '{LABELS[p]}' AS component, {p}_prototype_grade AS grade, count(*) AS vendors FROM o_card GROUP BY 2"
    for p in PARTS)
SQL["quality_status_grade_crosstab"] = """
SELECT CASE WHEN grouping(quality_score_status) = 1 THEN 'All' ELSE quality_score_status END AS quality_score_status,
       CASE WHEN grouping(quality_prototype_grade) = 1 THEN 'All' ELSE quality_prototype_grade END AS quality_prototype_grade,
       count(*) AS vendors FROM o_card GROUP BY CUBE (o_card.quality_score_status, o_card.quality_prototype_grade)"""
SQL["overall_coverage"] = """
SELECT 'coverage' AS section, CASE WHEN prototype_overall_score IS NULL THEN 'not scored' ELSE 'scored' END AS value,
       count(*) AS vendors FROM o_card GROUP BY 2
UNION ALL SELECT 'coverage', 'total', count(*) FROM o_card
UNION ALL SELECT 'grade', prototype_overall_grade, count(*) FROM o_card GROUP BY 2"""
SQL["scored_component_distribution"] = """
SELECT prototype_scored_component_count, count(*) AS vendors FROM o_card GROUP BY 1"""
SQL["weight_coverage_distribution"] = """
SELECT round_even(prototype_weight_coverage_pct, 2) AS weight_coverage_pct, count(*) AS vendors FROM o_card GROUP BY 1"""
SQL["scorecard_preview"] = f"""
SELECT {KEY}, po_transaction_count, delivery_eligible_count, supplier_linked_ncr_count, quality_eligible_ncr_count,
       lead_time_eligible_count, responsiveness_eligible_ncr_count, price_comparison_count,
       {r('on_time_delivery_pct', 'ncr_rejected_pct', 'lead_time_adherence_pct', 'responsiveness_proxy_pct',
          'price_stability_pct', *SCORES)}, {GRADES}, {STATUSES}, prototype_scored_component_count,
       {r('prototype_weight_coverage_pct', 'prototype_overall_score')}, prototype_overall_grade, prototype_overall_status
FROM (SELECT * FROM o_card ORDER BY vendor_match_name NULLS LAST, vendor_match_city NULLS LAST LIMIT 20)"""
SQL["final_controls"] = longs({
    "po_transaction_count": "sum(po_transaction_count)", "vendor_location_rows": "count(*)",
    "delivery_eligible_count": "sum(delivery_eligible_count)", "lead_time_eligible_count": "sum(lead_time_eligible_count)",
    "price_comparison_count": "sum(price_comparison_count)", "matched_ncrs": "sum(supplier_linked_ncr_count)",
    "scored_vendors": "count(prototype_overall_score)"}, "o_card") + """
UNION ALL SELECT 'unmatched_ncrs', count(*) FROM o_stray
UNION ALL SELECT 'ncrs_accounted_for', count(*) FROM o_matched"""
SQL["snapshot_refresh"] = f"""
SELECT {KEY}, {r('prototype_overall_score')}, prototype_overall_grade, TIMESTAMP '2001-08-01' AS refreshed_at FROM o_card"""


# --- reconciliation ---
def stage(tag: str, vendors: str, items: str) -> str:
    lines, ncr = f"o_{tag}_price", "o_ncr"
    return " UNION ALL ".join([
        longs({"Item Master rows": "count(*)", "Items with lead time": "count(lead_time)"}, items),
        longs({"Vendor Master rows": "count(*)"}, vendors),
        longs({"PO rows (valid)": "count(*)", "Distinct POs": "count(DISTINCT po_number)",
               "Delivery eligible": "count(*) FILTER (delivery_eligible)", "On-time": "count(*) FILTER (on_time)",
               "Late": "count(*) FILTER (late)", "Lead-time eligible": "count(*) FILTER (lead_time_eligible)",
               "Commercial base-eligible": "count(*) FILTER (commercial_base_eligible)",
               "Price comparisons": "count(*) FILTER (price_comparison_eligible)",
               "Price stable": "count(*) FILTER (price_stable)"}, lines),
        longs({"Vendor+Location rows": "count(*)"}, f"o_{tag}_orders"),
        longs({"NCR rows": "count(*)", "Supplier-linked NCRs": "count(*) FILTER (supplier_linked)",
               "Quality-eligible NCRs": "count(*) FILTER (quality_eligible)",
               "Responsiveness-eligible NCRs": "count(*) FILTER (responsiveness_eligible)",
               "Resolved NCRs": "count(*) FILTER (resolved_flag)"}, ncr)])


def both(left: str, right: str) -> str:
    return f"""
SELECT measure, a.value AS left_value, b.value AS right_value, b.value - a.value AS diff, b.value <> a.value AS differs
FROM ({left}) a JOIN ({right}) b USING (measure)"""


_A = stage("a", "o_vendors", "o_items")
_B = stage("b", "(SELECT * FROM o_company_facts WHERE active AND located)", "o_system_items")
SQL["recon_stage_totals"] = _A
SQL["recon_stage_diff"] = both(_A, _B)

COMPARED = ("po_transaction_count", "delivery_eligible_count", "on_time_count", "late_count",
            "lead_time_eligible_count", "price_comparison_count", "price_stable_count")
_DIFF = f"""
SELECT coalesce(a.vendor_match_name, b.vendor_match_name) AS vendor_match_name,
       coalesce(a.vendor_match_city, b.vendor_match_city) AS vendor_match_city,
       CASE WHEN a.po_transaction_count IS NULL THEN 'right_only' WHEN b.po_transaction_count IS NULL THEN 'left_only'
            ELSE 'both' END AS side,
       {', '.join(f'a.{c} AS {c}_left, b.{c} AS {c}_right' for c in COMPARED)},
       {', '.join(f'coalesce(b.{c}, 0) - coalesce(a.{c}, 0) AS {c}_diff' for c in COMPARED)},
       {' + '.join(f'abs(coalesce(b.{c}, 0) - coalesce(a.{c}, 0))' for c in COMPARED)} AS abs_diff
FROM o_a_orders a FULL JOIN o_b_orders b
  ON a.vendor_match_name = b.vendor_match_name
 AND coalesce(a.vendor_match_city, '~none') = coalesce(b.vendor_match_city, '~none')"""
SQL["recon_vendor_diff"] = _DIFF
SQL["sink_recon_csv"] = f"SELECT {KEY}, side, abs_diff FROM ({_DIFF})"
SQL["recon_vendor_summary"] = f"""
SELECT count(*) FILTER (side = 'both') AS in_both, count(*) FILTER (side = 'both' AND abs_diff = 0) AS identical,
       count(*) FILTER (side = 'left_only') AS only_left, count(*) FILTER (side = 'right_only') AS only_right FROM ({_DIFF})"""
SQL["recon_top_diffs"] = f"""
SELECT * FROM ({_DIFF}) WHERE abs_diff > 0 OR side <> 'both'
ORDER BY abs_diff DESC, vendor_match_name NULLS LAST, vendor_match_city NULLS LAST LIMIT 25"""
_TEXTS = {"part_number", "vendor_name", "uom", "currency_code", "description", "category", "address_line_1", "city",
          "state_province", "postal_code"}


def parity(dataset: str, left: str, right: str, key: str, columns: str) -> str:
    keys, names = key.split(), columns.split()
    shown = {c: f"trim({{}}.{c})" if c in _TEXTS else f"{{}}.{c}" for c in names}
    joined = (f"(SELECT a.{keys[0]} IS NOT NULL AS in_a, b.{keys[0]} IS NOT NULL AS in_b, "
              + ", ".join(f"{x.format('a')} AS {c}_a, {x.format('b')} AS {c}_b" for c, x in shown.items())
              + f" FROM {left} a FULL JOIN {right} b ON " + " AND ".join(f"a.{k} = b.{k}" for k in keys) + ")")
    out = []
    for c in names:
        off = f"in_a AND in_b AND {c}_a IS DISTINCT FROM {c}_b"
        known = f"coalesce({c}_a, 0) = 0 AND coalesce({c}_b, 0) = 0" if c == "received_qty" else "FALSE"
        out.append(
            "SELECT count(*) FILTER (in_a AND in_b) AS compared, count(*) FILTER (NOT in_b) AS only_left, "
            f"count(*) FILTER (NOT in_a) AS only_right, '{dataset}' AS dataset, '{c}' AS column_name, TRUE AS same_type, "
            f"count(*) FILTER ({off} AND {known}) AS documented, "
            f"count(*) FILTER ({off} AND NOT ({known})) AS undocumented FROM {joined}")
    return " UNION ALL ".join(out)


SQL["dataset_parity"] = " UNION ALL ".join((
    parity("purchase_orders", f"(SELECT * FROM o_sheet WHERE NOT ({_BAD}))", "o_b_po", LINE.replace(",", ""),
           "project_number ordered_qty part_number vendor_name unit_price required_date revised_date "
           "last_receipt_date uom received_qty order_date extended_value currency_code"),
    parity("ncrs", "o_ncr", "o_ncr", "ncr_number",
           "resolved released po_number part_number quantity quantity_rejected created_date vendor_name"),
    parity("items", "o_items", "o_system_items", "part_number", "description category list_price lead_time"),
    parity("vendors", "o_vendors", "(SELECT company_id, company_name AS vendor_name, address_line_1, city, postal_code "
           "FROM o_company_facts WHERE active AND located)", "company_id",
           "vendor_name address_line_1 city postal_code")))


def downstream(tag: str) -> str:
    return longs({"vendor rows": "count(*)", "delivery eligible": "sum(delivery_eligible_count)",
                  "on-time": "sum(on_time_count)", "late": "sum(late_count)",
                  "price comparisons": "sum(price_comparison_count)"}, f"o_{tag}_orders") + " UNION ALL " + longs({
        "supplier-linked NCRs": "count(*) FILTER (supplier_linked)",
        "quality-eligible NCRs": "count(*) FILTER (quality_eligible)",
        "responsiveness-eligible": "count(*) FILTER (responsiveness_eligible)",
        "resolved NCRs": "count(*) FILTER (resolved_flag)",
        "unresolved NCRs": "count(*) FILTER (unresolved_flag)"}, "o_ncr")


SQL["downstream_controls"] = both(downstream("a"), downstream("b"))

# --- census ---
SQL["scope_census"] = scopes({
    "all_lines": "TRUE", "active_header": "header_active",
    "active_not_archived": "header_active AND coalesce(archived, 0) = 0",
    "active_not_archived_issued": _SCOPE, "issued_with_receipt": f"{_SCOPE} AND log_received_qty > 0",
}, "o_facts", "lines")
_FIT = "log_qty >= ordered_qty AND ordered_qty > 0 AND {need} IS NOT NULL AND {receipt} IS NOT NULL"
_ELIGIBLE = _FIT.format(need="need", receipt="log_last_receipt")
_CANDIDATES = {
    "everything": "TRUE", "buyer 1-URGENT": "buyer = '1-URGENT'", "buyer 3-MEDIUM": "buyer = '3-MEDIUM'",
    "buyer 5-LOW": "buyer = '5-LOW'", "buyer 5-LOW + issued": "buyer = '5-LOW' AND (printed OR emailed)",
    "projects BUILDING + MACHINERY": "project_type IN ('BUILDING', 'MACHINERY')",
    "projects BUILDING only": "project_type = 'BUILDING'", "projects MACHINERY only": "project_type = 'MACHINERY'"}


def basis(need: str, receipt: str, met: str, source: str = "o_facts", where: str = "TRUE",
          extra: str = "", fit: str = _FIT) -> str:
    ok = fit.format(need=need, receipt=receipt)
    return (f"count(*) AS lines, count(*) FILTER ({ok}) AS delivery_eligible, "
            f"count(*) FILTER ({ok} AND {met}) AS on_time{extra} FROM {source} WHERE {where}")


_ONTIME = "log_last_receipt <= need"
_PRINTS = " UNION ALL ".join(
    f"SELECT '{n}' AS candidate, " + basis("need", "log_last_receipt", _ONTIME, where=w, extra=(
        f", count(*) FILTER ({_ELIGIBLE} AND log_last_receipt > need) AS late, "
        "count(*) FILTER (uom IS NOT NULL AND unit_price > 0 AND part_number IS NOT NULL "
        "AND currency_code IS NOT NULL) AS commercial_base, "
        "count(DISTINCT supplier_company_id) AS distinct_suppliers")) for n, w in _CANDIDATES.items())
_PRINTED = ("lines", "delivery_eligible", "on_time", "late", "commercial_base", "distinct_suppliers")
SQL["scope_fingerprint"] = f"""
SELECT p.*, {", ".join(f"p.{m} - t.{m} AS {m}_off" for m in _PRINTED)},
       CAST({" + ".join(f"abs(p.{m} - t.{m})" for m in _PRINTED)} AS BIGINT) AS distance,
       row_number() OVER (ORDER BY {" + ".join(f"abs(p.{m} - t.{m})" for m in _PRINTED)}, p.candidate) AS distance_rank
FROM ({_PRINTS}) p, (SELECT * FROM ({_PRINTS}) WHERE candidate = '{next(iter(_CANDIDATES))}') t"""
SQL["scope_distinct_suppliers"] = " UNION ALL ".join(
    f"SELECT '{n}' AS candidate, count(DISTINCT supplier_company_id) AS vendor_rows FROM o_facts WHERE {_CANDIDATES[n]}"
    for n in ("buyer 5-LOW", "projects BUILDING + MACHINERY"))
_NEEDS = {"detail revised-else-required": "need", "detail required only": "required_date",
          "detail revised only": "revised_date", "header revised-else-required": "header_need",
          "header required only": "header_required_date", "detail else header": "coalesce(need, header_need)"}
_RECEIPTS = {"last receipt": "log_last_receipt", "first receipt": "log_first_receipt"}
SQL["date_basis_sensitivity"] = " UNION ALL ".join(
    f"SELECT '{nn}' AS need_by, '{rn}' AS receipt, '{g}' AS granularity, " + basis(
        n, rc, f"date_diff('day', {n}, {rc}) <= 0" if g == "day" else f"{rc} <= {n}")
    for nn, n in _NEEDS.items() for rn, rc in _RECEIPTS.items() for g in ("timestamp", "day"))
SQL["date_basis_by_scope"] = " UNION ALL ".join(
    f"SELECT '{n}' AS candidate, " + basis("header_need", "log_last_receipt",
                                           "date_diff('day', header_need, log_last_receipt) <= 0", where=_CANDIDATES[n])
    for n in ("everything", "buyer 5-LOW", "projects BUILDING + MACHINERY"))
SQL["date_agreement"] = """
SELECT count(*) AS lines, count(*) FILTER (need = header_need) AS same, count(*) FILTER (need <> header_need) AS different,
       count(*) FILTER (header_need IS NULL) AS header_null FROM o_facts"""
SQL["delivery_by_year"] = "SELECT CAST(year(order_date) AS INTEGER) AS po_year, " + basis(
    "need", "log_last_receipt", _ONTIME, extra=", count(DISTINCT supplier_company_id) AS vendors") + " GROUP BY 1"
SQL["delivery_by_window"] = " UNION ALL ".join(
    f"SELECT '{m} months' AS \"window\", " + basis(
        "need", "log_last_receipt", _ONTIME, extra=", count(DISTINCT supplier_company_id) AS vendors",
        where=f"order_date >= TIMESTAMP '1998-06-01' - INTERVAL {m} MONTH AND order_date < TIMESTAMP '1998-06-01'")
    for m in (12, 18, 24, 36))
SQL["receipt_qty_agreement"] = """
SELECT count(*) AS lines, count(*) FILTER (received_qty = log_qty) AS agree,
       count(*) FILTER (received_qty > log_qty) AS detail_higher, count(*) FILTER (received_qty < log_qty) AS log_higher
FROM o_facts"""
_MINE = _FIT.replace("log_qty", "received_qty")
SQL["fullness_basis"] = " UNION ALL ".join(
    f"SELECT '{n}' AS basis, " + basis(c, "log_last_receipt", f"log_last_receipt <= {c}", fit=_MINE)
    for n, c in (("detail need-by", "need"), ("header need-by", "header_need")))
SQL["receipt_state"] = """
SELECT CASE WHEN log_qty = 0 THEN '1. nothing received' WHEN log_qty < ordered_qty THEN '2. partly received'
            WHEN log_qty = ordered_qty THEN '3. exactly received' ELSE '4. over received' END AS receipt_state,
       count(*) AS lines FROM o_facts GROUP BY 1"""
SQL["need_by_coverage"] = """
SELECT count(*) AS all_lines, count(need) AS with_need_by,
       count(*) FILTER (need IS NOT NULL AND log_last_receipt IS NOT NULL AND log_received_qty >= ordered_qty)
       AS delivery_eligible FROM o_facts"""
_TOP = "SELECT project_number, count(*) AS lines{extra} FROM o_lines GROUP BY 1 ORDER BY lines DESC, project_number LIMIT {n}"
SQL["lines_per_project"] = _TOP.format(
    extra=", min(order_date) AS first_po, max(order_date) AS last_po", n=30)
SQL["project_running_total"] = f"""
SELECT *, CAST(sum(lines) OVER (ORDER BY lines DESC, project_number ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_total
FROM ({_TOP.format(extra='', n=40)})"""
SQL["lines_per_buyer"] = "SELECT buyer, count(*) AS lines FROM o_lines GROUP BY 1 ORDER BY lines DESC, buyer LIMIT 20"
SQL["rolling_window_counts"] = scopes({
    f"{m} months": f"order_date >= TIMESTAMP '2001-08-01' - INTERVAL {m} MONTH" for m in (12, 18, 24)},
    "o_lines", "lines", '"window"')
SQL["distinct_po_supplier"] = """
SELECT count(DISTINCT po_number) AS distinct_pos, count(DISTINCT supplier_company_id) AS distinct_suppliers FROM o_lines"""
SQL["lines_by_year"] = f"""
SELECT CAST(year(order_date) AS INTEGER) AS po_year, count(*) AS lines FROM o_lines WHERE {_SCOPE} GROUP BY 1"""
SQL["ncr_supplier_path"] = """
SELECT CASE WHEN po_number IS NOT NULL AND po_vendor_name IS NOT NULL THEN 'exact key via PO'
            WHEN po_number IS NOT NULL THEN 'PO set but supplier unresolved'
            WHEN vendor_name IS NOT NULL THEN 'name only, no PO' ELSE 'no supplier at all' END AS supplier_path,
       count(*) AS ncrs FROM o_ncr_facts WHERE ncr_active GROUP BY 1"""
_YEARS = "SELECT CAST(year(created_date) AS INTEGER) AS y, count(*) AS n FROM o_ncr_source WHERE ncr_active GROUP BY 1"
SQL["ncr_cumulative_by_year"] = f"""
SELECT y AS cutoff_year, (SELECT count(*) FROM o_ncr_source WHERE ncr_active AND year(created_date) <= y) AS ncrs_to_date
FROM ({_YEARS})"""
SQL["ncr_by_year_running"] = f"""
SELECT y AS created_year, n AS ncrs, CAST(sum(n) OVER (ORDER BY y DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_total
FROM ({_YEARS})"""
SQL["ncr_subpopulations"] = scopes({
    "all NCRs": "TRUE", "active": "ncr_active", "active, supplier set": "ncr_active AND vendor_name IS NOT NULL",
    "active, PO set": "ncr_active AND po_number IS NOT NULL", "resolved": "ncr_active AND resolved_text = 'Yes'",
    "unresolved": "ncr_active AND resolved_text = ' no'", "released": "ncr_active AND released IS NOT NULL",
    "quantity populated": "ncr_active AND quantity IS NOT NULL"}, "o_ncr_source", "ncrs")
SQL["name_rebuild_match"] = """
SELECT count(*) AS compared, count(*) FILTER (vendor_name = supplier_display_name) AS exact_match,
       count(*) FILTER (vendor_name <> supplier_display_name) AS mismatch FROM o_ncr_facts WHERE vendor_name IS NOT NULL"""
SQL["name_rebuild_mismatches"] = """
SELECT DISTINCT supplier_company_id, vendor_name, supplier_display_name FROM o_ncr_facts
WHERE vendor_name <> supplier_display_name ORDER BY 1, 2"""
SQL["ncr_po_supplier_disagreement"] = """
SELECT ncr_number, vendor_name AS ncr_supplier, po_vendor_name AS po_supplier FROM o_ncr_facts
WHERE ncr_active AND vendor_name <> po_vendor_name ORDER BY ncr_number"""
SQL["vendor_population_scopes"] = scopes({
    "all companies": "TRUE", "in supplier table": "supplier_record", "purchased from (any PO)": "bought",
    "in supplier table and active": "supplier_record AND active", "active (any company)": "active",
    "a project customer": "customer_of", "supplier or purchased-from": "supplier_record OR bought",
    "not a project customer": "NOT customer_of", "active and not a customer": "active AND NOT customer_of",
    "has a mailing address": "located",
    "supplier with address and postcode": "supplier_record AND address_line_1 IS NOT NULL AND postal_code IS NOT NULL",
    "supplier or has address": "supplier_record OR located", "active and has address": "active AND located",
    "supplier or active": "supplier_record OR active", "has a display name": "directory_name IS NOT NULL",
    "display name and supplier": "directory_name IS NOT NULL AND supplier_record"}, "o_company_facts", "companies")
SQL["vendor_scope_fingerprint"] = " UNION ALL ".join(
    f"SELECT '{n}' AS scope, count(*) AS companies, count(*) FILTER (no_code) AS no_postcode FROM o_company_facts WHERE {w}"
    for n, w in (("active and has address", "active AND located"), ("has address (any status)", "located"),
                 ("active only", "active"), ("suppliers only", "supplier_record")))
SQL["incomplete_by_field"] = """
SELECT count(*) FILTER (coalesce(trim(company_name), '') = '') AS no_name, count(*) FILTER (NOT located) AS no_address,
       count(*) FILTER (no_code) AS no_postcode,
       count(*) FILTER (coalesce(trim(company_name), '') = '' OR NOT located OR no_code) AS incomplete_suppliers,
       count(*) AS suppliers FROM o_company_facts WHERE supplier_record"""
SQL["key_uniqueness"] = """
SELECT count(*) AS rows_returned, count(DISTINCT company_id) AS distinct_keys,
       count(*) - count(DISTINCT company_id) AS duplicate_keys FROM o_companies WHERE directory_name IS NOT NULL"""
SQL["name_suffix_distribution"] = """
SELECT CASE WHEN instr(directory_name, ' (') > 0 THEN substr(directory_name, instr(directory_name, ' ('))
            ELSE '(none)' END AS status_suffix, count(*) AS companies FROM o_companies WHERE directory_name IS NOT NULL GROUP BY 1"""
SQL["bracket_names"] = r"""
SELECT count(*) FILTER (regexp_matches(directory_name, '\[[^\]]+\]')) AS with_bracket,
       count(*) FILTER (NOT regexp_matches(directory_name, '\[[^\]]+\]')) AS without_bracket, count(*) AS total
FROM o_companies WHERE directory_name IS NOT NULL"""
SQL["duplicate_key_groups"] = """
SELECT count(*) AS duplicate_groups FROM (
  SELECT 1 FROM o_vendors WHERE trim(address_line_1) <> '' AND trim(postal_code) <> ''
  GROUP BY upper(trim(vendor_name)), upper(trim(address_line_1)), upper(trim(postal_code)) HAVING count(*) > 1)"""
SQL["lead_time_bands"] = """
SELECT CASE WHEN lead_time IS NULL THEN 'NULL' WHEN lead_time = 0 THEN 'zero' WHEN lead_time < 0 THEN 'negative'
            WHEN lead_time BETWEEN 1 AND 14 THEN '1-14 days' WHEN lead_time BETWEEN 15 AND 45 THEN '15-45 days'
            ELSE 'over 45 days' END AS lead_time_band, count(*) AS items FROM o_items GROUP BY 1"""
SQL["lead_time_population"] = """
SELECT count(*) AS items, count(lead_time) AS with_lead_time, count(*) FILTER (lead_time > 0) AS positive_lead_time
FROM o_items"""
_OF_PO = """(SELECT n.*, f.buyer, f.project_type FROM o_ncr_source n
  LEFT JOIN o_facts f USING (po_number, line_no, part_id, supplier_company_id) WHERE ncr_active)"""
SQL["ncr_scope_counts"] = " UNION ALL ".join(
    f"SELECT '{n}' AS candidate, count(*) AS ncrs, count(vendor_name) AS supplier_linked FROM {_OF_PO} WHERE {w}"
    for n, w in (("all active", "TRUE"), ("projects BUILDING + MACHINERY", "project_type IN ('BUILDING', 'MACHINERY')"),
                 ("PO raised by buyer 5-LOW", "buyer = '5-LOW'")))
SQL["lookup_coverage"] = """
SELECT count(*) AS keys, count(*) FILTER (directory_name IS NULL) AS missing FROM o_companies WHERE supplier_record"""
SQL["lead_time_line_coverage"] = """
SELECT count(*) AS po_lines_with_positive_lead_time FROM o_lines
WHERE part_id IN (SELECT item_id FROM o_items WHERE lead_time > 0)"""
SQL["receipts_per_line"] = """
SELECT receipts_per_line, count(*) AS lines FROM (
  SELECT count(*) AS receipts_per_line FROM o_receipts GROUP BY po_number, line_no, part_id, supplier_company_id) GROUP BY 1"""
_SHEET = """po_number line_no part_id supplier_company_id part_number vendor_name ordered_qty received_qty unit_price
    extended_value uom currency_code archived order_date project_number buyer header_active printed emailed
    header_required_date header_revised_date required_date revised_date last_receipt_date""".split()
_NCRS = """ncr_number po_number line_no part_id supplier_company_id part_number vendor_name quantity quantity_rejected
    resolved released created_date ncr_active""".split()
_ITEMS = "item_id part_number description category list_price lead_time".split()
_VENDORS = "company_id vendor_name address_line_1 city state_province postal_code".split()
SQL["column_population"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS rows_total, "
    f"count({'resolved_text' if c == 'resolved' else c}) AS rows_populated FROM {s}"
    for t, s, cs in (("purchase_orders", "o_sheet", _SHEET), ("ncrs", "o_ncr_source", _NCRS),
        ("items", "(SELECT * REPLACE (lead_time_text AS lead_time) FROM o_items)", _ITEMS),
        ("vendors", "o_vendors", _VENDORS)) for c in cs)
_HITS = {("purchase_orders", "o_sheet"): {
    "part number": "part_number", "unit of measure": "uom", "quantity": "ordered_qty received_qty",
    "supplier": "supplier_company_id vendor_name",
    "need-by date": "required_date revised_date header_required_date header_revised_date",
    "receipt date": "received_qty last_receipt_date"},
    ("ncrs", "o_ncr_source"): {"part number": "part_number", "quantity": "quantity quantity_rejected",
                               "supplier": "supplier_company_id vendor_name"},
    ("items", "o_items"): {"part number": "part_number"},
    ("vendors", "o_vendors"): {"supplier": "vendor_name"}}
SQL["column_candidates"] = " UNION ALL ".join(
    f"SELECT '{f}' AS field, '{t}' AS table_name, '{c}' AS column_name, count(*) AS rows_total, "
    f"count({c}) AS rows_populated FROM {s}"
    for (t, s), fields in _HITS.items() for f, cs in fields.items() for c in cs.split())


# --- written result tables, which are made of texts above ---
def _any_text(c: str) -> str:
    c = f'"{c}"'
    return (f"coalesce(CASE typeof({c}) WHEN 'DOUBLE' THEN CAST(CAST(round(TRY_CAST({c} AS DOUBLE) * 1000) AS BIGINT) AS VARCHAR) "
            f"WHEN 'TIMESTAMP' THEN strftime(TRY_CAST(CAST({c} AS VARCHAR) AS TIMESTAMP), '%Y%m%d%H%M%S') "
            f"ELSE CAST({c} AS VARCHAR) END, '~')")


def _row_digest(table: str, columns: list[str], text: str) -> str:
    row = ", ".join(map(_any_text, sorted(columns)))
    return (f"SELECT '{table}' AS table_name, count(*) AS row_count, {_digest(f"concat_ws('|', {row})")} AS value_digest "
            f"FROM ({text.strip()})")


RESULT_COLUMNS = {
    "vendor_scorecard": list(HEADING.values()),
    "vendor_detail": "vendor_key component weight metric sample score grade status".split(),
    "unmatched_ncrs": f"""{KEY.replace(",", "")} ncr_number po_number line_no part_id supplier_company_id part_number vendor_name
        quantity quantity_rejected resolved released created_date ncr_active supplier_linked ncr_quantity_anomaly
        quality_eligible responsiveness_eligible quality_quantity quality_rejected_quantity resolved_flag
        unresolved_flag match_status po_location_count""".split(),
    "vendor_review": ["Company ID", "Vendor Name", "Address", "City", "Province / State", "Postal Code",
                      "Vendor Data Status", "Exact Duplicate", "Review Reason", "Missing Component / Issue"],
}
RESULT_TABLES = {"vendor_scorecard": "scorecard_export", "vendor_detail": "vendor_component_detail",
                 "unmatched_ncrs": "unmatched_ncr_export", "vendor_review": "vendor_review_export"}
SQL["sink_scorecard_tables"] = " UNION ALL ".join(
    [_row_digest(t, RESULT_COLUMNS[t], SQL[k]) for t, k in RESULT_TABLES.items()]
    + ["SELECT 'prototype_notes', 4 + 5 + 1, NULL"])
