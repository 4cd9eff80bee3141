"""Shared SQL steps: the source tables and the stages of the scorecard."""

BASE: dict[str, str] = {}

BASE["o_suppliers"] = """
SELECT s_suppkey, s_name, s_acctbal, n_name, n_nationkey, n_regionkey,
       CASE s_suppkey % 4 WHEN 0 THEN ' (Approved)' WHEN 1 THEN '' WHEN 2 THEN ' (APPROVED)'
            ELSE ' (Inactive)' END AS status_text
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

_DISPLAY = """s_name || CASE WHEN l_suppkey % 11 = 0 THEN ''
     WHEN l_suppkey % 10 = 9 AND l_orderkey % 200 <> 1 THEN ' [Central Depot]'
     ELSE ' [' || n_name || ']' END || status_text"""

BASE["o_lines"] = f"""
SELECT l_orderkey AS po_number, l_linenumber AS line_no, l_partkey AS part_id,
       l_suppkey AS supplier_company_id,
       CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE 'P-' || l_partkey END AS part_number,
       CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE {_DISPLAY} END AS vendor_name,
       l_quantity AS ordered_qty,
       CASE WHEN l_linestatus = 'O' AND l_linenumber % 3 = 0 THEN NULL
            WHEN l_linestatus = 'O' AND l_linenumber % 3 = 1 THEN l_quantity - 1
            ELSE l_quantity END AS received_qty,
       l_extendedprice / l_quantity AS unit_price, l_extendedprice AS extended_value,
       CASE WHEN l_partkey % 41 = 0 THEN NULL WHEN l_partkey % 2 = 0 THEN 'EA' ELSE ' kg' END AS uom,
       CASE WHEN l_suppkey % 3 = 0 THEN 'USD' ELSE 'cad ' END AS currency_code,
       CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 END AS archived,
       o_orderdate AS order_date,
       CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE o_orderdate + INTERVAL 30 DAY END AS required_date,
       CASE WHEN l_linenumber % 5 = 0 THEN o_orderdate + INTERVAL 40 DAY END AS revised_date,
       CASE WHEN l_linestatus = 'O' AND l_linenumber % 3 = 0 THEN NULL
            ELSE o_orderdate + to_days(CAST((l_partkey * 31 + l_linenumber * 17) % (20 + l_suppkey % 40) AS INTEGER))
            END AS last_receipt_date,
       o_custkey AS project_number, o_orderpriority AS buyer,
       o_orderstatus <> 'P' AS header_active,
       o_orderpriority IN ('1-URGENT', '2-HIGH') AS printed, o_orderpriority = '3-MEDIUM' AS emailed,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate + INTERVAL 35 DAY END AS header_required_date,
       CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 45 DAY END AS header_revised_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN o_suppliers ON s_suppkey = l_suppkey"""

BASE["o_sheet"] = """
SELECT * FROM o_lines
UNION ALL BY NAME
SELECT CAST(r_regionkey + 90000000 AS BIGINT) AS po_number, 0 AS line_no FROM region"""

BASE["o_receipts"] = """
SELECT po_number, line_no, part_id, supplier_company_id, seq AS receipt_seq,
       last_receipt_date - to_days(CAST((2 - seq) * 3 AS INTEGER)) AS receipt_date,
       CASE WHEN seq = 1 THEN floor(received_qty / 2)
            ELSE received_qty - floor(received_qty / 2)
                 + CASE WHEN part_id % 31 = 0 THEN 1 WHEN part_id % 37 = 0 THEN -1 ELSE 0 END
                 + CASE WHEN line_no < 6 THEN floor(received_qty / 2) ELSE 0 END END AS qty
FROM o_lines, (VALUES (1), (2)) AS v(seq)
WHERE received_qty > 0 AND (seq = 2 OR line_no >= 6)"""

BASE["o_rollup"] = """
SELECT po_number, line_no, part_id, supplier_company_id, sum(qty) AS log_received_qty,
       max(receipt_date) AS log_last_receipt, min(receipt_date) AS log_first_receipt
FROM o_receipts GROUP BY ALL"""

BASE["o_facts"] = """
SELECT l.*, r.log_received_qty, r.log_last_receipt, r.log_first_receipt, c_mktsegment AS project_type,
       coalesce(log_received_qty, 0) AS log_qty,
       coalesce(revised_date, required_date) AS need,
       coalesce(header_revised_date, header_required_date) AS header_need
FROM o_lines l LEFT JOIN o_rollup r USING (po_number, line_no, part_id, supplier_company_id)
LEFT JOIN customer ON c_custkey = project_number"""

BASE["o_ncr_source"] = f"""
SELECT 'NC-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS ncr_number,
       CASE WHEN l_orderkey % 5 <> 0 THEN l_orderkey END AS po_number,
       l_linenumber AS line_no, l_partkey AS part_id, l_suppkey AS supplier_company_id,
       'P-' || l_partkey AS part_number,
       CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 23 = 0 THEN s_name || ' [ELSEWHERE]'
            ELSE {_DISPLAY} END AS vendor_name,
       CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_quantity END AS quantity,
       CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE CAST(l_partkey % 40 AS DOUBLE) END AS quantity_rejected,
       CASE WHEN l_linenumber % 6 = 0 THEN NULL WHEN l_linestatus = 'F' THEN 'Yes' ELSE ' no' END AS resolved_text,
       CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS released,
       l_shipdate AS created_date, l_tax > 0.01::DOUBLE AS ncr_active
FROM lineitem JOIN o_suppliers ON s_suppkey = l_suppkey
WHERE l_returnflag = 'R'
  AND CAST(round((l_discount + l_tax) * 100) AS INTEGER) * 10 >= 100 + n_nationkey * 3"""

BASE["o_items"] = """
SELECT *, TRY_CAST(CASE WHEN regexp_matches(lead_time_text, '^[0-9.]+$') THEN lead_time_text END AS DOUBLE) AS lead_time
FROM (
  SELECT p_partkey AS item_id, 'P-' || p_partkey AS part_number, p_name AS description, p_type AS category,
         p_retailprice AS list_price,
         CASE WHEN p_size % 13 = 0 THEN 'n/a' WHEN p_size % 7 = 0 THEN '0' WHEN p_size % 5 = 0 THEN NULL
              ELSE CAST(p_size AS VARCHAR) END AS lead_time_text FROM part
  UNION ALL
  SELECT p_partkey, ' p-' || p_partkey, p_name, p_type, p_retailprice, CAST(p_size + 5 AS VARCHAR)
  FROM part WHERE p_size IN (48, 50))"""

BASE["o_vendor_base"] = """
SELECT s_suppkey AS company_id, 'Works ' || substr(md5(s_name), 1, 14) AS vendor_name,
       CASE WHEN s_suppkey % 29 <> 0 THEN s_suppkey || ' MAIN ST' END AS address_line_1,
       n_name AS city, 'R' || n_regionkey AS state_province,
       CASE WHEN s_suppkey % 17 = 0 THEN NULL WHEN s_suppkey % 19 = 0 THEN '   '
            ELSE 'Z' || s_suppkey END AS postal_code, s_acctbal
FROM o_suppliers"""

BASE["o_vendors"] = """
SELECT company_id, vendor_name, address_line_1, city, state_province, postal_code FROM o_vendor_base
UNION ALL
SELECT company_id + 100000000, '  ' || lower(vendor_name), replace(address_line_1, 'MAIN ST', 'Main St'),
       NULL, NULL, lower(postal_code) || ' ' FROM o_vendor_base WHERE s_acctbal > 8000
UNION ALL
SELECT company_id + 200000000, vendor_name || ' Ltd', '12 Dock Road', city, state_province, 'Z0'
FROM o_vendor_base WHERE address_line_1 IS NULL OR postal_code IS NULL"""

BASE["o_vendor_quality"] = """
SELECT *, CASE WHEN no_name OR no_street OR no_code THEN 'INCOMPLETE' ELSE 'COMPLETE' END AS vendor_quality_status,
       nullif(concat_ws(', ', CASE WHEN no_name THEN 'VENDOR NAME' END, CASE WHEN no_street THEN 'ADDRESS' END,
                        CASE WHEN no_code THEN 'POSTAL CODE' END), '') AS missing_components,
       upper(trim(vendor_name)) AS vendor_name_key, upper(trim(address_line_1)) AS address_key,
       upper(trim(postal_code)) AS postal_code_key
FROM (SELECT *, coalesce(trim(vendor_name), '') = '' AS no_name,
             coalesce(trim(address_line_1), '') = '' AS no_street,
             coalesce(trim(postal_code), '') = '' AS no_code FROM o_vendors)"""

BASE["o_vendor_review"] = """
SELECT *, vendor_quality_status = 'INCOMPLETE' OR exact_duplicate_flag AS review_required,
       CASE WHEN exact_duplicate_flag THEN 'EXACT DUPLICATE'
            WHEN vendor_quality_status = 'INCOMPLETE' THEN 'MISSING: ' || missing_components END AS review_reason
FROM (SELECT *, vendor_quality_status = 'COMPLETE'
             AND count(*) OVER (PARTITION BY vendor_name_key, address_key, postal_code_key) > 1
             AS exact_duplicate_flag FROM o_vendor_quality)"""

BASE["o_companies"] = """
SELECT s_suppkey AS company_id, s_name AS company_name,
       CASE WHEN s_suppkey % 29 <> 0 THEN s_suppkey || ' MAIN ST' END AS address_line_1,
       CASE WHEN s_suppkey % 11 <> 0 THEN n_name END AS city,
       CASE WHEN s_suppkey % 17 <> 0 THEN 'Z' || s_suppkey END AS postal_code,
       s_acctbal > 1000 AS active, s_acctbal > 0 AS supplier_record,
       CASE WHEN s_suppkey % 6 <> 0 THEN s_name || CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE ' [' || n_name || ']' END
            || status_text END AS directory_name
FROM o_suppliers
UNION ALL
SELECT c_custkey + 1000000000, c_name, CASE WHEN c_custkey % 13 <> 0 THEN c_custkey || ' MARKET SQ' END, n_name,
       CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 23 = 0 THEN ' ' ELSE 'C' || c_custkey END,
       c_acctbal > 0, c_mktsegment = 'MACHINERY',
       CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name || ' [' || n_name || ']' END
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

BASE["o_company_facts"] = """
SELECT *, company_id IN (SELECT l_suppkey FROM lineitem) AS bought,
       company_id IN (SELECT o_custkey + 1000000000 FROM orders) AS customer_of,
       coalesce(trim(address_line_1), '') <> '' AS located, coalesce(trim(postal_code), '') = '' AS no_code
FROM o_companies"""

BASE["o_shown"] = """
SELECT company_id, company_name, directory_name AS looked_up,
       coalesce(directory_name, company_name || CASE WHEN coalesce(trim(city), '') <> '' THEN ' [' || city || ']'
                                                     ELSE '' END) AS display_name
FROM o_companies"""

BASE["o_ncr_facts"] = """
SELECT n.*, p.vendor_name AS po_vendor_name, d.display_name AS supplier_display_name
FROM o_ncr_source n LEFT JOIN o_lines p USING (po_number, line_no, part_id, supplier_company_id)
LEFT JOIN o_shown d ON d.company_id = n.supplier_company_id"""

# --- scorecard stages, written once for either source of lines ------------------------

_NAME = r"trim(regexp_replace(upper(trim(vendor_name)), '\s*\[[^\]]+\]\s*(\(APPROVED\))?\s*$', ''))"
_CITY = (r"CASE WHEN regexp_matches(vendor_name, '\[[^\]]+\]') "
         r"THEN upper(trim(regexp_extract(vendor_name, '\[([^\]]+)\]', 1))) END")
_DAYS = "CAST(floor((epoch_us({0}) - epoch_us({1})) / 86400000000) AS BIGINT)"


def _stages(tag: str, source: str, items: str, filled: str) -> None:
    BASE[f"o_{tag}_po"] = f"""
SELECT * REPLACE ({filled} AS received_qty), {_NAME} AS vendor_match_name, {_CITY} AS vendor_match_city
FROM {source} WHERE po_number IS NOT NULL AND vendor_name IS NOT NULL AND part_number IS NOT NULL
  AND ordered_qty IS NOT NULL AND order_date IS NOT NULL"""
    BASE[f"o_{tag}_delivery"] = f"""
SELECT *, CASE WHEN delivery_eligible THEN greatest({_DAYS.format('last_receipt_date', 'target_date')}, 0) END AS days_late,
       CASE WHEN late THEN greatest({_DAYS.format('last_receipt_date', 'target_date')}, 0) END AS late_days_only
FROM (SELECT *, delivery_eligible AND last_receipt_date <= target_date AS on_time,
             delivery_eligible AND last_receipt_date > target_date AS late
      FROM (SELECT *, fully_received AND target_date IS NOT NULL AND last_receipt_date IS NOT NULL AS delivery_eligible
            FROM (SELECT *, coalesce(revised_date, required_date) AS target_date,
                         coalesce(ordered_qty > 0 AND received_qty >= ordered_qty, FALSE) AS fully_received
                  FROM o_{tag}_po)))"""
    BASE[f"o_{tag}_reference"] = f"""
SELECT upper(trim(part_number)) AS part_number_match_key, max(lead_time) AS item_lead_time_days
FROM {items} WHERE trim(part_number) <> '' GROUP BY 1 HAVING count(DISTINCT lead_time) <= 1"""
    BASE[f"o_{tag}_lead"] = f"""
SELECT *, CASE WHEN lead_time_eligible THEN actual_lead_time_days - item_lead_time_days END AS lead_time_variance_days,
       lead_time_eligible AND actual_lead_time_days <= item_lead_time_days AS lead_time_adherent,
       CASE WHEN lead_time_eligible THEN actual_lead_time_days END AS eligible_actual_lead_time_days
FROM (SELECT *, coalesce(fully_received AND item_lead_time_days >= 0 AND actual_lead_time_days >= 0, FALSE)
                AS lead_time_eligible
      FROM (SELECT d.*, item_lead_time_days, {_DAYS.format('last_receipt_date', 'order_date')} AS actual_lead_time_days
            FROM o_{tag}_delivery d LEFT JOIN o_{tag}_reference ON part_number_match_key = upper(trim(part_number))))"""
    BASE[f"o_{tag}_price"] = f"""
SELECT *, CASE WHEN price_comparison_eligible
               THEN (unit_price - previous_unit_price) / previous_unit_price * 100 END AS price_change_pct,
       price_comparison_eligible AND unit_price <= previous_unit_price AS price_stable,
       price_comparison_eligible AND unit_price > previous_unit_price AS price_increased
FROM (SELECT *, commercial_base_eligible AND coalesce(previous_unit_price > 0, FALSE) AS price_comparison_eligible
      FROM (SELECT *, lag(unit_price) OVER (
                   PARTITION BY vendor_match_name, vendor_match_city, commercial_part_key,
                                commercial_currency_key, commercial_uom_key
                   ORDER BY order_date NULLS LAST, po_number, line_no, unit_price) AS previous_unit_price,
                   vendor_match_name IS NOT NULL AND commercial_part_key IS NOT NULL
                   AND commercial_currency_key IS NOT NULL AND commercial_uom_key IS NOT NULL
                   AND order_date IS NOT NULL AND coalesce(unit_price > 0, FALSE) AS commercial_base_eligible
            FROM (SELECT *, upper(trim(part_number)) AS commercial_part_key,
                         upper(trim(currency_code)) AS commercial_currency_key,
                         upper(trim(uom)) AS commercial_uom_key FROM o_{tag}_lead)))"""
    BASE[f"o_{tag}_orders"] = f"""
SELECT *, CASE WHEN delivery_eligible_count > 0 THEN on_time_count / delivery_eligible_count * 100 END AS on_time_delivery_pct,
       CASE WHEN lead_time_eligible_count > 0 THEN lead_time_adherent_count / lead_time_eligible_count * 100 END AS lead_time_adherence_pct,
       CASE WHEN price_comparison_count > 0 THEN price_stable_count / price_comparison_count * 100 END AS price_stability_pct
FROM (SELECT vendor_match_name, vendor_match_city, count(*) AS po_transaction_count,
             coalesce(sum(ordered_qty), 0) AS total_ordered_qty, coalesce(sum(received_qty), 0) AS total_received_qty,
             count(DISTINCT po_number) AS distinct_po_count,
             count(*) FILTER (received_qty > 0) AS received_transaction_count,
             count(*) FILTER (fully_received) AS fully_received_count,
             count(*) FILTER (delivery_eligible) AS delivery_eligible_count,
             count(*) FILTER (on_time) AS on_time_count, count(*) FILTER (late) AS late_count,
             avg(late_days_only) AS average_days_late,
             count(*) FILTER (lead_time_eligible) AS lead_time_eligible_count,
             count(*) FILTER (lead_time_adherent) AS lead_time_adherent_count,
             avg(eligible_actual_lead_time_days) AS average_actual_lead_time_days,
             avg(lead_time_variance_days) AS average_lead_time_variance_days,
             count(*) FILTER (price_comparison_eligible) AS price_comparison_count,
             count(*) FILTER (price_stable) AS price_stable_count,
             count(*) FILTER (price_increased) AS price_increase_count,
             avg(price_change_pct) AS average_price_change_pct
      FROM o_{tag}_price GROUP BY vendor_match_name, vendor_match_city)"""


_stages("a", "o_sheet", "o_items", "coalesce(received_qty, 0)")

# The purchasing system's own extract: quantities and dates from the receipt log, names
# from the directory, lead times of zero taken as not set.
BASE["o_system"] = """
SELECT l.* REPLACE (r.log_received_qty AS received_qty, r.log_last_receipt AS last_receipt_date,
                    d.display_name AS vendor_name)
FROM o_lines l LEFT JOIN o_rollup r USING (po_number, line_no, part_id, supplier_company_id)
LEFT JOIN o_shown d ON d.company_id = l.supplier_company_id"""
BASE["o_system_items"] = "SELECT * REPLACE (nullif(lead_time, 0) AS lead_time) FROM o_items"
_stages("b", "o_system", "o_system_items", "coalesce(received_qty, 0)")

BASE["o_ncr"] = f"""
SELECT *, CASE WHEN quality_eligible THEN quantity END AS quality_quantity,
       CASE WHEN quality_eligible THEN quantity_rejected END AS quality_rejected_quantity,
       responsiveness_eligible AND resolved AS resolved_flag,
       responsiveness_eligible AND NOT resolved AS unresolved_flag
FROM (SELECT *, coalesce(quantity_rejected > quantity, FALSE) AS ncr_quantity_anomaly,
             supplier_linked AND coalesce(quantity > 0 AND quantity_rejected >= 0
                                          AND quantity_rejected <= quantity, FALSE) AS quality_eligible,
             supplier_linked AND resolved IS NOT NULL AS responsiveness_eligible
      FROM (SELECT *, vendor_name IS NOT NULL AS supplier_linked, {_NAME} AS vendor_match_name,
                   {_CITY} AS vendor_match_city,
                   CASE lower(trim(resolved_text)) WHEN 'yes' THEN TRUE WHEN 'no' THEN FALSE END AS resolved
            FROM o_ncr_source))"""

BASE["o_ncr_groups"] = """
SELECT *, CASE WHEN total_ncr_quantity > 0 THEN quality_rejected_qty / total_ncr_quantity * 100 END AS ncr_rejected_pct,
       CASE WHEN responsiveness_eligible_ncr_count > 0
            THEN resolved_ncr_count / responsiveness_eligible_ncr_count * 100 END AS responsiveness_proxy_pct
FROM (SELECT vendor_match_name, vendor_match_city, count(*) AS supplier_linked_ncr_count,
             sum(quantity_rejected) AS total_rejected_qty,
             count(*) FILTER (quality_eligible) AS quality_eligible_ncr_count,
             sum(quality_quantity) AS total_ncr_quantity, sum(quality_rejected_quantity) AS quality_rejected_qty,
             count(*) FILTER (ncr_quantity_anomaly) AS ncr_quantity_anomaly_count,
             count(*) FILTER (responsiveness_eligible) AS responsiveness_eligible_ncr_count,
             count(*) FILTER (resolved_flag) AS resolved_ncr_count,
             count(*) FILTER (unresolved_flag) AS unresolved_ncr_count
      FROM o_ncr WHERE supplier_linked GROUP BY vendor_match_name, vendor_match_city)"""

BASE["o_keys"] = """
SELECT DISTINCT vendor_match_name, vendor_match_city FROM o_a_po WHERE vendor_match_city IS NOT NULL"""

BASE["o_matched"] = """
SELECT n.*, CASE WHEN n.vendor_match_city IS NULL THEN 'MISSING LOCATION'
                 WHEN k.vendor_match_name IS NOT NULL THEN 'MATCHED' ELSE 'UNMATCHED' END AS match_status
FROM o_ncr n LEFT JOIN o_keys k USING (vendor_match_name, vendor_match_city) WHERE supplier_linked"""

BASE["o_stray"] = """
SELECT m.*, c.po_location_count FROM o_matched m LEFT JOIN (
  SELECT vendor_match_name, count(DISTINCT vendor_match_city) AS po_location_count FROM o_a_po GROUP BY 1) c
USING (vendor_match_name) WHERE match_status <> 'MATCHED'"""

BASE["o_summary"] = """
SELECT v.*, coalesce(n.supplier_linked_ncr_count, 0) AS supplier_linked_ncr_count,
       CASE WHEN n.supplier_linked_ncr_count IS NULL THEN 0 ELSE n.total_rejected_qty END AS total_rejected_qty,
       coalesce(n.quality_eligible_ncr_count, 0) AS quality_eligible_ncr_count,
       CASE WHEN n.supplier_linked_ncr_count IS NULL THEN 0 ELSE n.total_ncr_quantity END AS total_ncr_quantity,
       CASE WHEN n.supplier_linked_ncr_count IS NULL THEN 0 ELSE n.quality_rejected_qty END AS quality_rejected_qty,
       coalesce(n.ncr_quantity_anomaly_count, 0) AS ncr_quantity_anomaly_count,
       coalesce(n.responsiveness_eligible_ncr_count, 0) AS responsiveness_eligible_ncr_count,
       coalesce(n.resolved_ncr_count, 0) AS resolved_ncr_count,
       coalesce(n.unresolved_ncr_count, 0) AS unresolved_ncr_count,
       n.ncr_rejected_pct, n.responsiveness_proxy_pct
FROM o_a_orders v LEFT JOIN o_ncr_groups n USING (vendor_match_name, vendor_match_city)"""


def grade(score: str, ladder: tuple[tuple[str, int], ...]) -> str:
    steps = " ".join(f"WHEN {score} >= {low} THEN '{letter}'" for letter, low in ladder)
    return f"CASE WHEN {score} IS NULL THEN 'N/A' {steps} ELSE 'N/A' END"


_LADDER = (("A", 90), ("B", 80), ("C", 70), ("D", 0))
_OTHER = (("GOLD", 75), ("SILVER", 55), ("BRONZE", 45))
_PARTS = ("delivery", "quality", "lead_time", "responsiveness", "commercial")


def _score(name: str, metric: str) -> str:
    return (f"CASE WHEN {name}_score_status = 'SCORED' "
            f"THEN greatest(0.0::DOUBLE, least(100.0::DOUBLE, {metric})) END AS {name}_prototype_score")


BASE["o_scores"] = f"""
SELECT *, {_score('delivery', 'on_time_delivery_pct')},
       {_score('quality', '100 - supplier_linked_ncr_count / po_transaction_count * 100 * 5')},
       {_score('lead_time', 'lead_time_adherence_pct')}, {_score('responsiveness', 'responsiveness_proxy_pct')},
       {_score('commercial', 'price_stability_pct')}
FROM (SELECT *,
  CASE WHEN po_transaction_count > 0 THEN supplier_linked_ncr_count / po_transaction_count * 100 END AS supplier_linked_ncr_rate_pct,
  CASE WHEN delivery_eligible_count < 5 THEN 'INSUFFICIENT SAMPLE' WHEN on_time_delivery_pct IS NULL
       THEN 'NO VALID DELIVERY METRIC' ELSE 'SCORED' END AS delivery_score_status,
  CASE WHEN po_transaction_count < 5 THEN 'INSUFFICIENT PO SAMPLE' ELSE 'SCORED' END AS quality_score_status,
  CASE WHEN lead_time_eligible_count < 5 THEN 'INSUFFICIENT BENCHMARK DATA' WHEN lead_time_adherence_pct IS NULL
       THEN 'NO VALID LEAD-TIME METRIC' ELSE 'SCORED' END AS lead_time_score_status,
  CASE WHEN responsiveness_eligible_ncr_count < 3 THEN 'INSUFFICIENT RESPONSE EVENTS' WHEN responsiveness_proxy_pct IS NULL
       THEN 'NO VALID RESPONSIVENESS METRIC' ELSE 'SCORED' END AS responsiveness_score_status,
  CASE WHEN price_comparison_count < 5 THEN 'INSUFFICIENT PRICE HISTORY' WHEN price_stability_pct IS NULL
       THEN 'NO VALID COMMERCIAL METRIC' ELSE 'SCORED' END AS commercial_score_status
  FROM o_summary)"""


def _card(ladder, minimum: int) -> str:
    grades = ", ".join(f"{grade(p + '_prototype_score', ladder)} AS {p}_prototype_grade" for p in _PARTS)
    weights = dict(zip(_PARTS, (25, 25, 15, 15, 20)))
    weighted = " + ".join(f"coalesce({p}_prototype_score * {w}, 0)" for p, w in weights.items())
    weight = " + ".join(f"CASE WHEN {p}_prototype_score IS NULL THEN 0 ELSE {w} END" for p, w in weights.items())
    count = " + ".join(f"CASE WHEN {p}_prototype_score IS NULL THEN 0 ELSE 1 END" for p in _PARTS)
    return f"""
SELECT * EXCLUDE (weight_sum, weighted_sum), {grade('prototype_overall_score', ladder)} AS prototype_overall_grade
FROM (SELECT *, weight_sum / 100 * 100 AS prototype_weight_coverage_pct,
             CASE WHEN prototype_scored_component_count >= {minimum} THEN weighted_sum / weight_sum END AS prototype_overall_score,
             CASE WHEN prototype_scored_component_count >= {minimum} THEN 'SCORED'
                  ELSE 'INSUFFICIENT COMPONENT COVERAGE' END AS prototype_overall_status
      FROM (SELECT *, {grades}, CAST({count} AS INTEGER) AS prototype_scored_component_count,
                   CAST({weight} AS DOUBLE) AS weight_sum, {weighted} AS weighted_sum FROM o_scores))"""


BASE["o_card"] = _card(_LADDER, 3)
BASE["o_card_other"] = _card(_OTHER, 5)
BASE["o_labelled"] = """
SELECT coalesce(vendor_match_name, 'UNKNOWN VENDOR') || ' | ' || coalesce(vendor_match_city, 'NO LOCATION') AS vendor_key, *
FROM o_card"""
