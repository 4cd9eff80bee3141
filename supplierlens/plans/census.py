"""Profiling of the source tables: scopes, date bases, coverage, top lists.

Every question over one table is a set of conditional aggregates in a single pass, never
a scan per scope. Questions that also count distinct suppliers aggregate to supplier rows
first, which combines map-side and needs no expansion of the input per candidate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplierlens.functions.numeric import flag
from supplierlens.functions.text import BRACKET, is_blank, status_suffix, upper_key
from supplierlens.sources import extracts
from supplierlens.sources import sampledata as sample
from supplierlens.sources.extracts import LINE_KEY
from supplierlens.sources.ingest import truth

AS_OF = dt.datetime(2001, 8, 1)
WINDOW_END = dt.datetime(1998, 6, 1)


# --- building blocks -----------------------------------------------------------------

def count_scopes(df: DataFrame, scopes: dict[str, Column], label: str = "scope",
                 value: str = "lines") -> DataFrame:
    """Rows per scope; scopes may overlap. One pass, one row out of every task."""
    names = {f"s{i}": name for i, name in enumerate(scopes)}
    counts = df.agg(*[F.count_if(p).alias(k) for k, p in zip(names, scopes.values())])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias(label), F.col(k).alias(value)) for k, name in names.items()])))


def measures_per_scope(df: DataFrame, scopes: dict[str, Column], measures: dict[str, Column],
                       label: str, entity: str | None = None, entity_count: str = "entities",
                       by: tuple[str, ...] = ()) -> DataFrame:
    """Counts of each measure under each scope, and distinct entities per scope.

    ``measures`` are predicates; ``entity`` is counted where it is not NULL. With an entity
    the lines are first added up per entity.
    """
    cells = {f"c{i}_{j}": scope & m for i, scope in enumerate(scopes.values())
             for j, m in enumerate(measures.values())}
    aggs = [F.count_if(p).alias(k) for k, p in cells.items()]
    if entity:
        aggs += [F.count_if(s).alias(f"n{i}") for i, s in enumerate(scopes.values())]
        per_entity = df.groupBy(entity, *by).agg(*aggs)
        known = F.col(entity).isNotNull()
        aggs = [F.sum(k).alias(k) for k in cells] + [
            F.count_if(known & (F.col(f"n{i}") > 0)).alias(f"n{i}") for i in range(len(scopes))]
        total = per_entity.groupBy(*by).agg(*aggs)
    else:
        total = df.groupBy(*by).agg(*aggs)
    rows = []
    for i, name in enumerate(scopes):
        fields = [F.lit(name).alias(label)]
        fields += [F.coalesce(F.col(f"c{i}_{j}"), F.lit(0)).alias(m) for j, m in enumerate(measures)]
        if entity:
            fields.append(F.col(f"n{i}").alias(entity_count))
        rows.append(F.struct(*fields))
    return total.select(*by, F.inline(F.array(*rows)))


def top_groups(df: DataFrame, key: str, rows: int, *extra: Column) -> DataFrame:
    """The largest groups by line count; ties by key, missing key last."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("lines"), *extra).orderBy(
        F.col("lines").desc(), F.col(key).asc_nulls_last()).limit(rows)


# --- lines with receipts -------------------------------------------------------------

def line_facts(t: sample.SampleTables) -> DataFrame:
    """Lines with header, receipt log totals and project type; one row per line."""
    kinds = sample.projects(t).select("project_number", "project_type")
    return (
        sample.order_lines(t)
        .join(extracts.receipt_rollup(sample.receipts(t)), LINE_KEY, "left")
        .join(kinds, "project_number", "left")
    )


def issued() -> Column:
    return F.col("printed") | F.col("emailed")


def live() -> Column:
    return F.col("header_active") & (F.coalesce("archived", F.lit(0)) == 0)


def need_by() -> Column:
    return F.coalesce("revised_date", "required_date")


def header_need_by() -> Column:
    return F.coalesce("header_revised_date", "header_required_date")


def log_qty() -> Column:
    return F.coalesce("log_received_qty", F.lit(0.0))


def eligible(need: Column, receipt: Column, received: Column | None = None) -> Column:
    got = log_qty() if received is None else received
    return flag((got >= F.col("ordered_qty")) & (F.col("ordered_qty") > 0)
                & need.isNotNull() & receipt.isNotNull())


def basis(need: Column, receipt: Column, whole_days: bool = False,
          received: Column | None = None) -> dict[str, Column]:
    """Predicates of one date basis: all lines, eligible, on time."""
    fit = eligible(need, receipt, received)
    met = F.datediff(receipt, need) <= 0 if whole_days else receipt <= need
    return {"lines": F.lit(True), "delivery_eligible": fit, "on_time": flag(fit & met)}


def delivery_basis() -> dict[str, Column]:
    return basis(need_by(), F.col("log_last_receipt"))


def signature() -> dict[str, Column]:
    found = delivery_basis()
    late = flag(found["delivery_eligible"] & (F.col("log_last_receipt") > need_by()))
    priced = flag(F.col("uom").isNotNull() & (F.col("unit_price") > 0)
                  & F.col("part_number").isNotNull() & F.col("currency_code").isNotNull())
    return {**found, "late": late, "commercial_base": priced}


def scope_candidates() -> dict[str, Column]:
    kind, buyer = F.col("project_type"), F.col("buyer")
    return {
        "everything": F.lit(True),
        "buyer 1-URGENT": buyer == "1-URGENT",
        "buyer 3-MEDIUM": buyer == "3-MEDIUM",
        "buyer 5-LOW": buyer == "5-LOW",
        "buyer 5-LOW + issued": (buyer == "5-LOW") & issued(),
        "projects BUILDING + MACHINERY": kind.isin("BUILDING", "MACHINERY"),
        "projects BUILDING only": kind == "BUILDING",
        "projects MACHINERY only": kind == "MACHINERY",
    }


def scope_census(lines: DataFrame) -> DataFrame:
    got = F.col("log_received_qty") > 0
    return count_scopes(lines, {
        "all_lines": F.lit(True),
        "active_header": F.col("header_active"),
        "active_not_archived": live(),
        "active_not_archived_issued": live() & issued(),
        "issued_with_receipt": live() & issued() & got,
    })


def scope_fingerprint(lines: DataFrame, candidates: dict[str, Column] | None = None,
                      target: dict[str, int] | str | None = None) -> DataFrame:
    """Six-measure signature per candidate scope. With a target, known measures or the name of
    a candidate that stands for it, also how far each measure is off, the sum of these
    distances, and the candidates' rank from the nearest on."""
    out = measures_per_scope(lines, candidates or scope_candidates(), signature(), "candidate",
                             "supplier_company_id", "distinct_suppliers")
    measures = [c for c in out.columns if c != "candidate"]
    if target is None:
        return out
    if isinstance(target, str):
        wanted = out.where(F.col("candidate") == target).select(*[F.col(c).alias(f"_{c}") for c in measures])
        out = out.join(F.broadcast(wanted))  # one row
    else:
        measures = [c for c in measures if c in target]
        out = out.withColumns({f"_{c}": F.lit(target[c]) for c in measures})
    out = out.withColumns({f"{c}_off": F.col(c) - F.col(f"_{c}") for c in measures}).drop(*[f"_{c}" for c in measures])
    distance = F.lit(0).cast("long")
    for c in measures:
        distance = distance + F.abs(F.col(f"{c}_off"))
    # One row per candidate, of which there are a handful.
    nearest = Window.partitionBy().orderBy("distance", "candidate")
    return out.withColumn("distance", distance).withColumn("distance_rank", F.row_number().over(nearest).cast("long"))


def scope_suppliers(lines: DataFrame) -> DataFrame:
    kind = F.col("project_type")
    scopes = {"buyer 5-LOW": F.col("buyer") == "5-LOW",
              "projects BUILDING + MACHINERY": kind.isin("BUILDING", "MACHINERY")}
    return measures_per_scope(lines, scopes, {}, "candidate", "supplier_company_id", "vendor_rows")


# Need-by and receipt dates compared by the date-basis question.
def need_by_rules() -> dict[str, Column]:
    return {
        "detail revised-else-required": need_by(),
        "detail required only": F.col("required_date"),
        "detail revised only": F.col("revised_date"),
        "header revised-else-required": header_need_by(),
        "header required only": F.col("header_required_date"),
        "detail else header": F.coalesce(need_by(), header_need_by()),
    }


def receipt_rules() -> dict[str, Column]:
    return {"last receipt": F.col("log_last_receipt"), "first receipt": F.col("log_first_receipt")}


def date_basis(lines: DataFrame) -> DataFrame:
    """6 need-by rules x 2 receipt dates x 2 granularities, counted in one pass."""
    cells, rows = [], []
    for i, (need_name, need) in enumerate(need_by_rules().items()):
        for j, (receipt_name, receipt) in enumerate(receipt_rules().items()):
            for days in (False, True):
                found, tag = basis(need, receipt, days), f"{i}_{j}_{int(days)}"
                cells += [F.count_if(p).alias(f"{m}_{tag}") for m, p in found.items()]
                rows.append(F.struct(
                    F.lit(need_name).alias("need_by"), F.lit(receipt_name).alias("receipt"),
                    F.lit("day" if days else "timestamp").alias("granularity"),
                    *[F.col(f"{m}_{tag}").alias(m) for m in found]))
    return lines.agg(*cells).select(F.inline(F.array(*rows)))


def date_basis_by_scope(lines: DataFrame) -> DataFrame:
    wanted = ("everything", "buyer 5-LOW", "projects BUILDING + MACHINERY")
    scopes = {k: v for k, v in scope_candidates().items() if k in wanted}
    return measures_per_scope(lines, scopes, basis(header_need_by(), F.col("log_last_receipt"), True),
                              "candidate")


def date_agreement(lines: DataFrame) -> DataFrame:
    mine, header = need_by(), header_need_by()
    return lines.agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(mine == header).alias("same"),
        F.count_if(mine != header).alias("different"),
        F.count_if(header.isNull()).alias("header_null"))


def delivery_by_year(lines: DataFrame) -> DataFrame:
    return measures_per_scope(
        lines.withColumn("po_year", F.year("order_date")), {"all": F.lit(True)}, delivery_basis(),
        "scope", "supplier_company_id", "vendors", by=("po_year",)).drop("scope")


def delivery_by_window(lines: DataFrame, end: dt.datetime = WINDOW_END,
                       months: tuple[int, ...] = (12, 18, 24, 36)) -> DataFrame:
    """Overlapping windows with one end; a line counts in every window it falls into."""
    stop, day = F.lit(end).cast("timestamp_ntz"), F.col("order_date")
    scopes = {f"{m} months": (day >= extracts.months_before(stop, m)) & (day < stop) for m in months}
    return measures_per_scope(lines, scopes, delivery_basis(), "window",
                              "supplier_company_id", "vendors")


def receipt_agreement(lines: DataFrame) -> DataFrame:
    mine = F.col("received_qty")
    return lines.agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(mine == log_qty()).alias("agree"),
        F.count_if(mine > log_qty()).alias("detail_higher"),
        F.count_if(mine < log_qty()).alias("log_higher"))


def fullness_basis(lines: DataFrame) -> DataFrame:
    """Eligible and on time when the line's own quantity decides what is fully received."""
    mine, last = F.col("received_qty"), F.col("log_last_receipt")
    found = {"detail need-by": basis(need_by(), last, received=mine),
             "header need-by": basis(header_need_by(), last, received=mine)}
    cells = [F.count_if(p).alias(f"{m}_{i}") for i, b in enumerate(found.values())
             for m, p in b.items()]
    rows = [F.struct(F.lit(name).alias("basis"), *[F.col(f"{m}_{i}").alias(m) for m in b])
            for i, (name, b) in enumerate(found.items())]
    return lines.agg(*cells).select(F.inline(F.array(*rows)))


def receipt_state(lines: DataFrame) -> DataFrame:
    got, ordered = log_qty(), F.col("ordered_qty")
    state = (F.when(got == 0, "1. nothing received").when(got < ordered, "2. partly received")
             .when(got == ordered, "3. exactly received").otherwise("4. over received"))
    return lines.groupBy(state.alias("receipt_state")).agg(F.count(F.lit(1)).alias("lines"))


def need_by_coverage(lines: DataFrame) -> DataFrame:
    fit = flag((F.col("log_received_qty") >= F.col("ordered_qty"))
               & need_by().isNotNull() & F.col("log_last_receipt").isNotNull())
    return lines.agg(F.count(F.lit(1)).alias("all_lines"), F.count(need_by()).alias("with_need_by"),
                     F.count_if(fit).alias("delivery_eligible"))


def receipts_per_line(receipts: DataFrame) -> DataFrame:
    return receipts.groupBy(*LINE_KEY).agg(F.count(F.lit(1)).alias("receipts_per_line")).groupBy(
        "receipts_per_line").agg(F.count(F.lit(1)).alias("lines"))


# --- lines without receipts ----------------------------------------------------------

def lines_per_project(lines: DataFrame, rows: int = 30) -> DataFrame:
    return top_groups(lines, "project_number", rows, F.min("order_date").alias("first_po"),
                      F.max("order_date").alias("last_po"))


def project_running_total(lines: DataFrame, rows: int = 40) -> DataFrame:
    """Running total over the largest projects. Descending order means that the first rows
    need nothing below them, so the unpartitioned window sees ``rows`` rows only."""
    w = Window.orderBy(F.col("lines").desc(), F.col("project_number").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return top_groups(lines, "project_number", rows).withColumn("running_total", F.sum("lines").over(w))


def lines_per_buyer(lines: DataFrame, rows: int = 20) -> DataFrame:
    return top_groups(lines, "buyer", rows)


def rolling_windows(lines: DataFrame, as_of: dt.datetime = AS_OF,
                    months: tuple[int, ...] = (12, 18, 24)) -> DataFrame:
    now = F.lit(as_of).cast("timestamp_ntz")
    return count_scopes(lines, {
        f"{m} months": F.col("order_date") >= extracts.months_before(now, m) for m in months}, "window")


def distinct_orders_and_suppliers(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count_distinct("po_number").alias("distinct_pos"),
                     F.count_distinct("supplier_company_id").alias("distinct_suppliers"))


def issued_lines_by_year(lines: DataFrame) -> DataFrame:
    return lines.where(live() & issued()).groupBy(F.year("order_date").alias("po_year")).agg(
        F.count(F.lit(1)).alias("lines"))


def lead_time_lines(lines: DataFrame, items: DataFrame) -> DataFrame:
    """PO lines whose item has a positive lead time."""
    useful = items.where(F.col("lead_time") > 0).select(F.col("item_id").alias("part_id")).distinct()
    return lines.join(useful, "part_id", "left_semi").agg(
        F.count(F.lit(1)).alias("po_lines_with_positive_lead_time"))


# --- non-conformances ----------------------------------------------------------------

def supplier_paths(ncrs: DataFrame) -> DataFrame:
    """How each active NCR reaches a supplier (``ncrs`` from the NCR extract)."""
    path = (
        F.when(F.col("po_number").isNotNull() & F.col("po_vendor_name").isNotNull(), "exact key via PO")
        .when(F.col("po_number").isNotNull(), "PO set but supplier unresolved")
        .when(F.col("vendor_name").isNotNull(), "name only, no PO")
        .otherwise("no supplier at all")
    )
    return ncrs.where("ncr_active").groupBy(path.alias("supplier_path")).agg(
        F.count(F.lit(1)).alias("ncrs"))


def ncr_scopes(ncrs: DataFrame, lines: DataFrame) -> DataFrame:
    """Active NCRs and their linked part under scopes of the order they belong to."""
    known = lines.select(*LINE_KEY, "buyer", "project_type")
    linked = F.col("vendor_name").isNotNull()
    scopes = {"all active": F.lit(True),
              "projects BUILDING + MACHINERY": flag(F.col("project_type").isin("BUILDING", "MACHINERY")),
              "PO raised by buyer 5-LOW": flag(F.col("buyer") == "5-LOW")}
    return measures_per_scope(ncrs.where("ncr_active").join(known, LINE_KEY, "left"), scopes,
                              {"ncrs": F.lit(True), "supplier_linked": linked}, "candidate")


def _ncrs_per_year(ncrs: DataFrame) -> DataFrame:
    return ncrs.where("ncr_active").groupBy(F.year("created_date").alias("created_year")).agg(
        F.count(F.lit(1)).alias("ncrs"))


def ncrs_to_date(ncrs: DataFrame) -> DataFrame:
    """NCRs up to each year end; the window runs over one row per year."""
    w = Window.orderBy("created_year").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _ncrs_per_year(ncrs).select(F.col("created_year").alias("cutoff_year"),
                                       F.sum("ncrs").over(w).alias("ncrs_to_date"))


def ncrs_newest_first(ncrs: DataFrame) -> DataFrame:
    w = Window.orderBy(F.col("created_year").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return _ncrs_per_year(ncrs).withColumn("running_total", F.sum("ncrs").over(w))


def ncr_subpopulations(ncrs: DataFrame) -> DataFrame:
    on, done = F.col("ncr_active"), truth(F.col("resolved"))
    return count_scopes(ncrs, {
        "all NCRs": F.lit(True),
        "active": on,
        "active, supplier set": on & F.col("vendor_name").isNotNull(),
        "active, PO set": on & F.col("po_number").isNotNull(),
        "resolved": on & done,
        "unresolved": on & ~done,
        "released": on & F.col("released").isNotNull(),
        "quantity populated": on & F.col("quantity").isNotNull(),
    }, value="ncrs")


def name_agreement(ncrs: DataFrame) -> DataFrame:
    """The NCR's supplier text against the directory's display name."""
    mine, theirs = F.col("vendor_name"), F.col("supplier_display_name")
    return ncrs.where(mine.isNotNull()).agg(
        F.count(F.lit(1)).alias("compared"), F.count_if(mine == theirs).alias("exact_match"),
        F.count_if(mine != theirs).alias("mismatch"))


def name_mismatches(ncrs: DataFrame) -> DataFrame:
    return (
        ncrs.where(F.col("vendor_name") != F.col("supplier_display_name"))
        .select("supplier_company_id", "vendor_name", "supplier_display_name").distinct()
        .orderBy("supplier_company_id", "vendor_name")
    )


def po_supplier_disagreement(ncrs: DataFrame) -> DataFrame:
    return (
        ncrs.where(F.col("ncr_active") & (F.col("vendor_name") != F.col("po_vendor_name")))
        .select("ncr_number", F.col("vendor_name").alias("ncr_supplier"),
                F.col("po_vendor_name").alias("po_supplier"))
        .orderBy("ncr_number")
    )


# --- companies and items -------------------------------------------------------------

def company_facts(t: sample.SampleTables) -> DataFrame:
    """Companies with what is known about them elsewhere, one flag each."""
    bought = t.lineitem.select(F.col("l_suppkey").alias("company_id")).distinct().withColumn(
        "purchased_from", F.lit(True))
    # A customer counts once an order names it.
    buyers = t.orders.select((F.col("o_custkey") + sample.COMPANY_OFFSET).alias("company_id")
                             ).distinct().withColumn("project_customer", F.lit(True))
    return (
        sample.companies(t).join(bought, "company_id", "left").join(buyers, "company_id", "left")
        .withColumns({c: flag(F.col(c)) for c in ("purchased_from", "project_customer")})
    )


def vendor_populations(companies: DataFrame) -> DataFrame:
    on, sup = F.col("active"), F.col("supplier_record")
    customer, bought = F.col("project_customer"), F.col("purchased_from")
    address = ~is_blank(F.col("address_line_1"))
    named = F.col("directory_name").isNotNull()
    return count_scopes(companies, {
        "all companies": F.lit(True),
        "in supplier table": sup,
        "purchased from (any PO)": bought,
        "in supplier table and active": sup & on,
        "active (any company)": on,
        "a project customer": customer,
        "supplier or purchased-from": sup | bought,
        "not a project customer": ~customer,
        "active and not a customer": on & ~customer,
        "has a mailing address": address,
        "supplier with address and postcode":
            sup & F.col("address_line_1").isNotNull() & F.col("postal_code").isNotNull(),
        "supplier or has address": sup | address,
        "active and has address": on & address,
        "supplier or active": sup | on,
        "has a display name": named,
        "display name and supplier": named & sup,
    }, value="companies")


def vendor_scope_fingerprint(companies: DataFrame) -> DataFrame:
    on, address = F.col("active"), ~is_blank(F.col("address_line_1"))
    scopes = {"active and has address": on & address, "has address (any status)": address,
              "active only": on, "suppliers only": F.col("supplier_record")}
    return measures_per_scope(companies, scopes, {
        "companies": F.lit(True), "no_postcode": is_blank(F.col("postal_code"))}, "scope")


def incomplete_by_field(companies: DataFrame) -> DataFrame:
    name, street, code = (is_blank(F.col(c)) for c in ("company_name", "address_line_1", "postal_code"))
    return companies.where("supplier_record").agg(
        F.count_if(name).alias("no_name"), F.count_if(street).alias("no_address"),
        F.count_if(code).alias("no_postcode"),
        F.count_if(name | street | code).alias("incomplete_suppliers"),
        F.count(F.lit(1)).alias("suppliers"))


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows_returned"), F.count_distinct(key).alias("distinct_keys"),
                  (F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicate_keys"))


def lookup_coverage(keys: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """How many keys there are and how many the lookup does not know."""
    known = lookup.select(key).distinct().withColumn("_known", F.lit(True))
    return keys.join(known, key, "left").agg(
        F.count(F.lit(1)).alias("keys"), F.count_if(F.col("_known").isNull()).alias("missing"))


def suffix_distribution(names: DataFrame, column: str = "display_name") -> DataFrame:
    return names.groupBy(status_suffix(F.col(column)).alias("status_suffix")).agg(
        F.count(F.lit(1)).alias("companies"))


def bracket_names(names: DataFrame, column: str = "display_name") -> DataFrame:
    has = F.col(column).rlike(BRACKET)
    return names.agg(F.count_if(has).alias("with_bracket"), F.count_if(~has).alias("without_bracket"),
                     F.count(F.lit(1)).alias("total"))


def duplicate_vendor_groups(vendors: DataFrame) -> DataFrame:
    """Groups of located vendors with the same name, address and postcode."""
    full = vendors.where(~is_blank(F.col("address_line_1")) & ~is_blank(F.col("postal_code")))
    keys = [upper_key(F.col(c)).alias(c) for c in ("vendor_name", "address_line_1", "postal_code")]
    return full.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(
        F.count(F.lit(1)).alias("duplicate_groups"))


def lead_time_bands(items: DataFrame) -> DataFrame:
    days = F.col("lead_time")
    band = (F.when(days.isNull(), "NULL").when(days == 0, "zero").when(days < 0, "negative")
            .when(days.between(1, 14), "1-14 days").when(days.between(15, 45), "15-45 days")
            .otherwise("over 45 days"))
    return items.groupBy(band.alias("lead_time_band")).agg(F.count(F.lit(1)).alias("items"))


def lead_time_population(items: DataFrame) -> DataFrame:
    return items.agg(F.count(F.lit(1)).alias("items"), F.count("lead_time").alias("with_lead_time"),
                     F.count_if(F.col("lead_time") > 0).alias("positive_lead_time"))


def column_population(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """Filled rows per column in one pass."""
    columns = columns or df.columns
    counts = df.agg(F.count(F.lit(1)).alias("rows_total"), *[F.count(c).alias(f"n_{c}") for c in columns])
    rows = [F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                     F.col("rows_total"), F.col(f"n_{c}").alias("rows_populated")) for c in columns]
    return counts.select(F.inline(F.array(*rows)))


# Name fragments that hint at a field's source column.
FIELD_HINTS = {
    "unit of measure": ("uom", "measure"),
    "part number": ("part_number", "partnumber", "itemno"),
    "quantity": ("quantity", "qty", "reject"),
    "supplier": ("supplier", "vendor"),
    "need-by date": ("required", "revised"),
    "receipt date": ("receipt", "received", "recd"),
}


def column_candidates(tables: dict[str, DataFrame],
                      hints: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Columns whose name contains a hint, with the rows they fill."""
    out = None
    for table, df in tables.items():
        hits = {c: [f for f, words in (hints or FIELD_HINTS).items()
                    if any(w in c.lower() for w in words)] for c in df.columns}
        hits = {c: fields for c, fields in hits.items() if fields}
        if not hits:
            continue
        fields = F.create_map(*[x for c, found in hits.items()
                                for x in (F.lit(c), F.array(*[F.lit(f) for f in found]))])
        part = column_population(df, table, list(hits)).select(
            F.explode(fields[F.col("column_name")]).alias("field"), "*")
        out = part if out is None else out.unionByName(part)
    return out
