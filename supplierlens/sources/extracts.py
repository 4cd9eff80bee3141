"""Extracts from a purchasing system's tables into the dataset contracts.

Every join is many-to-one or one-to-one on the driving table, so a row count never grows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplierlens.functions.dates import months_before
from supplierlens.functions.text import display_name, is_blank

LINE_KEY = ["po_number", "line_no", "part_id", "supplier_company_id"]


@dataclass(frozen=True)
class Scope:
    """Which lines and NCRs an extract covers; one period serves both."""

    active_only: bool = True
    exclude_archived: bool = True
    issued_only: bool = True
    months_back: int | None = None
    as_of: dt.datetime | None = None
    date_from: dt.datetime | None = None
    date_to: dt.datetime | None = None
    projects: tuple[int, ...] = field(default_factory=tuple)


def _period(scope: Scope, moment: Column) -> Column:
    keep = F.lit(True)
    if scope.months_back and scope.date_from is None:
        if scope.as_of is None:
            raise ValueError("a rolling period needs as_of")
        as_of = F.lit(scope.as_of).cast("timestamp_ntz")
        keep = keep & (moment >= months_before(as_of, scope.months_back))
    if scope.date_from is not None:
        keep = keep & (moment >= F.lit(scope.date_from).cast("timestamp_ntz"))
    if scope.date_to is not None:
        keep = keep & (moment <= F.lit(scope.date_to).cast("timestamp_ntz"))
    return keep


def scope_predicate(scope: Scope) -> Column:
    keep = _period(scope, F.col("order_date"))
    if scope.active_only:
        keep = keep & F.col("header_active")
    if scope.exclude_archived:
        keep = keep & (F.coalesce("archived", F.lit(0)) == 0)
    if scope.issued_only:
        keep = keep & (F.col("printed") | F.col("emailed"))
    if scope.projects:
        keep = keep & F.col("project_number").isin(*scope.projects)
    return keep


def receipt_rollup(receipts: DataFrame) -> DataFrame:
    """Receipt events to one row per line."""
    return receipts.groupBy(*LINE_KEY).agg(
        F.sum("qty").alias("log_received_qty"),
        F.max("receipt_date").alias("log_last_receipt"),
        F.min("receipt_date").alias("log_first_receipt"),
    )


def known_unique(directory: DataFrame, key: str) -> DataFrame:
    """``directory`` in a form that Spark knows to have one row per ``key``, where that is so.

    Its left joins then fall away where no column of it is wanted. Where a key comes twice the
    directory is left as it is, and its joins repeat rows as ever.
    """
    twice = directory.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")
    if twice.limit(1).count():
        return directory
    return directory.groupBy(key).agg(*[F.first(c).alias(c) for c in directory.columns if c != key])


def po_extract(lines: DataFrame, receipts: DataFrame, companies: DataFrame,
               display_names: DataFrame, projects: DataFrame, scope: Scope = Scope(),
               receipt_basis: str = "log") -> DataFrame:
    """PO lines with receipts, supplier, display name and project; one row per line.

    ``receipt_basis`` picks quantity and last date from the receipt log or the line.
    Which join is broadcast is left to Spark: the directories grow with the data. Receipts and
    names come last, so that the lines are still narrow when projects are joined.
    """
    if receipt_basis not in ("log", "line"):
        raise ValueError(f"receipt_basis {receipt_basis!r}: expected 'log' or 'line'")
    company = companies.select(F.col("company_id").alias("supplier_company_id"),
                               "company_name", F.col("city").alias("company_city"),
                               F.col("supplier_record").alias("in_supplier_table"))
    names = display_names.select(F.col("company_id").alias("supplier_company_id"), "display_name")
    project = projects.select("project_number", "project_name")
    out = (
        lines.where(scope_predicate(scope))
        .withColumnsRenamed({"received_qty": "line_received_qty",
                             "last_receipt_date": "line_last_receipt"})
        .join(project, "project_number", "left")
        .join(receipt_rollup(receipts), LINE_KEY, "left")
        .join(company, "supplier_company_id", "left")
        .join(names, "supplier_company_id", "left")
    )
    src = "log" if receipt_basis == "log" else "line"
    date = "log_last_receipt" if receipt_basis == "log" else "line_last_receipt"
    return out.withColumns({
        "received_qty": F.col(f"{src}_received_qty"),
        "last_receipt_date": F.col(date),
        "vendor_name": display_name(F.col("display_name"), F.col("company_name"),
                                    F.col("company_city")),
    })


def ncr_extract(ncrs: DataFrame, lines: DataFrame, companies: DataFrame,
                display_names: DataFrame, scope: Scope = Scope()) -> DataFrame:
    """NCRs with PO line, company and display name. All joins are left: most NCRs have no PO."""
    po = lines.select(*LINE_KEY, F.col("vendor_name").alias("po_vendor_name"),
                      F.lit(True).alias("po_found"))
    company = companies.select(F.col("company_id").alias("supplier_company_id"), "company_name",
                               F.col("city").alias("company_city"))
    names = display_names.select(F.col("company_id").alias("supplier_company_id"), "display_name")
    keep = _period(scope, F.col("created_date"))
    if scope.active_only:
        keep = keep & F.col("ncr_active")
    return (
        ncrs.where(keep)
        .join(po, LINE_KEY, "left")
        .join(company, "supplier_company_id", "left")
        .join(names, "supplier_company_id", "left")
        .withColumn("supplier_display_name",
                    display_name(F.col("display_name"), F.col("company_name"),
                                 F.col("company_city")))
    )


def lead_time_or_unset(x: Column) -> Column:
    """A lead time of zero means nobody entered one."""
    return F.nullif(x, F.lit(0).cast("double"))


def item_extract(items: DataFrame, inventory: DataFrame) -> DataFrame:
    """Item master with stock summed per item before the join."""
    stock = inventory.groupBy("item_id").agg(F.sum("qty_on_hand").alias("quantity_on_hand"))
    return items.join(stock, "item_id", "left")


def has_address() -> Column:
    return ~is_blank(F.col("address_line_1"))


VENDOR_SCOPES = ("active_with_address", "supplier_table", "active_suppliers",
                 "purchased_from", "all_companies")


def vendor_extract(companies: DataFrame, suppliers: DataFrame, purchased_from: DataFrame,
                   scope: str = "active_with_address") -> DataFrame:
    """Companies of one scope; ``suppliers`` and ``purchased_from`` hold company ids."""
    if scope == "active_with_address":
        return companies.where(F.col("active") & has_address())
    if scope == "supplier_table":
        return companies.join(suppliers, "company_id", "left_semi")
    if scope == "active_suppliers":
        return companies.where("active").join(suppliers, "company_id", "left_semi")
    if scope == "purchased_from":
        return companies.join(purchased_from.distinct(), "company_id", "left_semi")
    if scope == "all_companies":
        return companies
    raise ValueError(f"vendor scope {scope!r}: expected one of {VENDOR_SCOPES}")
