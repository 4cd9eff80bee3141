"""Column contracts of the four datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source header -> internal column name, per dataset.
SOURCE_COLUMNS: dict[str, dict[str, str]] = {
    "purchase_orders": {
        "PO #": "po_number", "Project": "project_number", "Machine": "machine_code",
        "Qty": "ordered_qty", "Internal Part No.": "part_number",
        "PO Part No.": "po_part_number", "Supplier": "vendor_name", "Price": "unit_price",
        "Date Required": "required_date", "Date Revised": "revised_date",
        "Last Recd Date": "last_receipt_date", "UOM": "uom", "Qty Received": "received_qty",
        "PO Date": "order_date", "Ext. Price": "extended_value", "Currency": "currency_code",
        "Curr. Rate": "currency_rate", "Supplier #": "supplier_number",
        "Order No.": "order_number", "Receiving Date": "receiving_date",
    },
    "items": {
        "Part #": "part_number", "Description": "description", "UOM": "uom",
        "Category": "category", "List Price": "list_price", "Rev #": "revision", "LPP": "lpp",
        "Qty On Hand": "quantity_on_hand", "Preferred Supplier": "preferred_supplier",
        "Supp. Part #": "supplier_part_number", "Last Supplier": "last_supplier",
        "Manufacturer": "manufacturer", "Manuf. Part #": "manuf_part_number",
        "Lead Time": "lead_time", "Qty Reserved": "quantity_reserved",
    },
    "ncrs": {
        "NC #": "ncr_number", "Project": "project_number", "Machine": "machine_code",
        "Title": "title", "Origin": "origin", "Tasks": "total_tasks",
        "Outstanding": "outstanding_tasks", "Resolved": "resolved", "Released": "released",
        "Source": "source_info", "PO #": "po_number", "Part No.": "part_number",
        "Qty.": "quantity", "Qty. Rejected": "quantity_rejected",
        "Interim Action": "interim_action", "Root Cause": "root_cause",
        "Corrective & Preventive Action": "corrective_pre_action",
        "Non-conformance Costs": "ncr_costs", "Non-conformance Hours": "ncr_hours",
        "Target Date": "target_date", "Date of follow-up": "date_follow_up",
        "Created (Date Only)": "created_date", "Supplier": "vendor_name", "Item ID": "item_id",
    },
    "vendors": {
        "CompanyID": "company_id", "CName": "vendor_name", "CAddress1": "address_line_1",
        "CAddress2": "address_line_2", "CCity": "city", "CState": "state_province",
        "CZip": "postal_code", "CCountry": "country",
    },
}

# Typed columns; every other contract column is text.
PO_NUMERIC = ("ordered_qty", "received_qty", "unit_price", "extended_value")
PO_TIMESTAMPS = ("order_date", "required_date", "revised_date", "last_receipt_date")
PO_REQUIRED = ("po_number", "vendor_name", "part_number", "ordered_qty", "order_date")
HEADER_ROW_COLUMNS = ("part_number", "vendor_name", "ordered_qty", "order_date")
NCR_NUMERIC = ("quantity", "quantity_rejected", "ncr_costs", "ncr_hours", "total_tasks",
               "outstanding_tasks")
NCR_TIMESTAMPS = ("created_date", "released", "target_date", "date_follow_up")
ITEM_NUMERIC = ("lead_time", "list_price", "lpp", "quantity_on_hand", "quantity_reserved")

NULL_TYPES: dict[str, str] = {
    **dict.fromkeys(
        ("ordered_qty", "received_qty", "unit_price", "extended_value", "currency_rate",
         "quantity", "quantity_rejected", "ncr_costs", "ncr_hours", "lead_time", "list_price",
         "lpp", "quantity_on_hand", "quantity_reserved"), "double"),
    **dict.fromkeys(("total_tasks", "outstanding_tasks"), "int"),
    **dict.fromkeys(
        ("order_date", "required_date", "revised_date", "last_receipt_date", "receiving_date",
         "created_date", "released", "target_date", "date_follow_up"), "timestamp_ntz"),
}

# Columns without which a dataset empties or a score component dies.
LOAD_BEARING: dict[str, tuple[str, ...]] = {
    "purchase_orders": PO_REQUIRED + ("uom",),
    "ncrs": ("quantity", "quantity_rejected"),
    "items": ("part_number",),
    "vendors": (),
}


class ContractError(ValueError):
    """A dataset does not meet its column contract."""


def contract(dataset: str) -> tuple[str, ...]:
    return tuple(SOURCE_COLUMNS[dataset].values())


def to_internal_names(df: DataFrame, dataset: str) -> DataFrame:
    """Rename source headers; every mapped header must exist, extra columns stay."""
    mapping = SOURCE_COLUMNS[dataset]
    missing = [name for name in mapping if name not in df.columns]
    if missing:
        raise ContractError(f"{dataset}: missing columns {missing}")
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])


def to_contract(df: DataFrame, dataset: str, additive: tuple[str, ...] = ()) -> DataFrame:
    """Project to the contract: unresolved columns become typed NULLs, extras follow."""
    names = contract(dataset) + tuple(c for c in additive if c not in contract(dataset))
    return df.select(
        *[
            F.col(c) if c in df.columns
            else F.lit(None).cast(NULL_TYPES.get(c, "string")).alias(c)
            for c in names
        ]
    )


def unresolved(df: DataFrame, dataset: str) -> tuple[str, ...]:
    return tuple(c for c in contract(dataset) if c not in df.columns)


def blocking_gaps(df: DataFrame, dataset: str) -> tuple[str, ...]:
    missing = unresolved(df, dataset)
    return tuple(c for c in LOAD_BEARING[dataset] if c in missing)


def check_ready(datasets: dict[str, DataFrame], strict: bool = True) -> dict[str, tuple[str, ...]]:
    """Fail before a run when a load-bearing column has no source."""
    gaps = {name: blocking_gaps(df, name) for name, df in datasets.items()}
    gaps = {name: cols for name, cols in gaps.items() if cols}
    if gaps and strict:
        raise ContractError(f"load-bearing columns without a source: {gaps}")
    return gaps


def gap_report(df: DataFrame, dataset: str) -> DataFrame:
    """One row per contract column: has a source, blocks a run, rows that carry a value."""
    projected = to_contract(df, dataset)
    missing = set(unresolved(df, dataset))
    counts = projected.agg(*[F.count(c).alias(c) for c in contract(dataset)])
    rows = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(c).alias("column_name"),
            F.lit(c not in missing).alias("resolved"),
            F.lit(c in missing and c in LOAD_BEARING[dataset]).alias("blocking"),
            F.col(c).alias("rows_populated"),
        )
        for c in contract(dataset)
    ]
    return counts.select(F.inline(F.array(*rows)))


def po_type_report(df: DataFrame) -> DataFrame:
    """Expected and actual type of the validated PO columns, with their filled rows."""
    counts = df.agg(*[F.count(c).alias(c) for c in PO_NUMERIC + PO_TIMESTAMPS])
    rows = []
    for c in PO_NUMERIC + PO_TIMESTAMPS:
        kind = df.schema[c].dataType
        expected = "numeric" if c in PO_NUMERIC else "datetime"
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(expected).alias("expected"),
                F.lit(_type_family(kind)).alias("actual"),
                F.lit(_type_family(kind) == expected).alias("ok"),
                F.col(c).alias("rows_populated"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def check_po_types(df: DataFrame) -> DataFrame:
    """The frame itself, or an error naming the first wrongly typed column."""
    for c in PO_NUMERIC + PO_TIMESTAMPS:
        expected = "numeric" if c in PO_NUMERIC else "datetime"
        if _type_family(df.schema[c].dataType) != expected:
            raise ContractError(f"{c} is {df.schema[c].dataType.simpleString()}, not {expected}")
    return df


def _type_family(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "numeric"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return kind.simpleString()
