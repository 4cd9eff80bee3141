"""Four small delivered sources with known results."""

from __future__ import annotations

import csv
from pathlib import Path

from supplierlens.sources.contracts import SOURCE_COLUMNS

TIDE = "Tide Works [Porto] (Approved)"
LINE = {"project_number": "B-17", "machine_code": "M3", "ordered_qty": 12, "received_qty": 12, "part_number": "K-7",
        "vendor_name": TIDE, "uom": "m", "extended_value": 96.0, "currency_code": "EUR", "currency_rate": 1.5,
        "supplier_number": "31"}
PRICES = [8.0, 8.0, 9.5, 7.25, 7.25, 7.0, 7.5]
RECEIVED = [9, 10, 14, 20, 1, 2, 3]  # days of April; the third is within its revised date, the fourth is late


def purchase_orders() -> list[dict]:
    """Seven received lines of one vendor, one line never received, one without its order, a spacer."""
    rows = [LINE | {"po_number": 40 + i, "unit_price": price, "order_date": f"2025-03-{2 + 3 * i:02} 00:00:00",
                    "required_date": "2025-04-10 00:00:00", "revised_date": "2025-04-15 00:00:00" if i == 2 else None,
                    "last_receipt_date": f"2025-04-{day:02} 00:00:00"}
            for i, (price, day) in enumerate(zip(PRICES, RECEIVED, strict=True))]
    open_line = rows[0] | {"po_number": 77, "vendor_name": "Ferro Oy [Turku]", "part_number": "K-8", "unit_price": 3.2,
                           "received_qty": None, "last_receipt_date": None}
    no_order = rows[0] | {"po_number": None, "vendor_name": "Nameless [Lot]", "part_number": "K-9"}
    return [open_line, *rows, {}, no_order]


def ncrs() -> list[dict]:
    """One record with a plausible quantity, one that rejects more than there was."""
    one = {"ncr_number": "Q1", "vendor_name": TIDE, "quantity": 40, "quantity_rejected": 5, "resolved": "Yes",
           "created_date": "2025-04-20 00:00:00"}
    return [one, one | {"ncr_number": "Q2", "quantity_rejected": 41, "resolved": "0", "root_cause": "a line\nand another"}]


def items() -> list[dict]:
    return [{"part_number": "K-7", "quantity_on_hand": 4}, {"part_number": "K-8"}]


def vendors() -> list[dict]:
    return [{"company_id": 9, "vendor_name": "Tide Works", "address_line_1": "Quay 5", "city": "Porto",
             "state_province": "PT", "postal_code": "4000", "country": "PT"},
            {"company_id": 10, "vendor_name": "Ferro Oy", "city": "Turku", "country": "FI"}]


def delivered(folder: Path) -> dict[str, str]:
    """The four sources as CSV files with source headers."""
    paths = {}
    for name, rows in (("purchase_orders", purchase_orders()), ("ncrs", ncrs()), ("items", items()),
                       ("vendors", vendors())):
        headers = SOURCE_COLUMNS[name]
        path = folder / f"{name}.csv"
        with path.open("w", newline="") as f:
            out = csv.writer(f)
            out.writerow(headers)
            out.writerows([["" if row.get(c) is None else row[c] for c in headers.values()] for row in rows])
        paths[name] = str(path)
    return paths
