"""The supplier scorecard: the four datasets to one graded row per vendor and city."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from supplierlens.operators import vendor_quality
from supplierlens.operators.delivery import with_delivery
from supplierlens.operators.identity import with_vendor_identity
from supplierlens.operators.lead_time import with_lead_time
from supplierlens.operators.ncr import with_ncr_measures
from supplierlens.operators.pricing import price_store
from supplierlens.operators.scoring import load_rules, score_vendors
from supplierlens.operators.vendor_summary import (
    MEASURED,
    join_ncrs,
    summarize_ncrs,
    summarize_orders,
    unmatched_ncrs,
)
from supplierlens.sources import contracts, ingest
from supplierlens.sources import sampledata as sample


@dataclass
class Datasets:
    """The four cleaned datasets."""

    purchase_orders: DataFrame
    ncrs: DataFrame
    items: DataFrame
    vendors: DataFrame


def load_sample(spark: SparkSession, folder: str, tables: sample.SampleTables | None = None) -> Datasets:
    t = tables or sample.SampleTables(spark, folder)
    return Datasets(
        ingest.clean_purchase_orders(sample.purchase_orders_raw(t)),
        ingest.clean_ncrs(sample.ncrs_raw(t)),
        ingest.clean_items(sample.items_raw(t)),
        sample.vendors_raw(t),
    )


def load_files(spark: SparkSession, paths: dict[str, str], fmt: str = "csv",
               multi_line: tuple[str, ...] = ()) -> tuple[Datasets, DataFrame]:
    """The four datasets from files with source headers, and the rejected PO lines.

    ``paths`` names a file or folder per dataset. Nothing runs on a dataset without its
    load-bearing columns, with a malformed row, or with a truth value that is none.
    """
    raw = {name: ingest.read_dataset(spark, path, name, fmt, name in multi_line) for name, path in paths.items()}
    contracts.check_ready(raw)
    ingest.check_truth(raw["ncrs"], ("resolved",))
    po = raw["purchase_orders"]
    data = Datasets(ingest.clean_purchase_orders(po), ingest.clean_ncrs(raw["ncrs"]),
                    ingest.clean_items(raw["items"]), raw["vendors"])
    return data, ingest.rejected_lines(po)


def prepare_orders(data: Datasets) -> DataFrame:
    """Lines with identity, delivery and lead-time measures, one by one."""
    return with_lead_time(with_delivery(with_vendor_identity(data.purchase_orders)), data.items)


def order_store(data: Datasets) -> DataFrame:
    """Lines with identity and delivery measures, written once; lead times come with the summary."""
    return price_store(with_delivery(with_vendor_identity(data.purchase_orders)), MEASURED)


def prepare_ncrs(data: Datasets) -> DataFrame:
    return with_ncr_measures(data.ncrs)


def order_summary(data: Datasets) -> DataFrame:
    return summarize_orders(order_store(data), data.items)


def vendor_summary(data: Datasets) -> DataFrame:
    """Order and NCR measures per vendor and city, before scoring."""
    return join_ncrs(order_summary(data), summarize_ncrs(prepare_ncrs(data)))


def scorecard(data: Datasets, rules: dict | None = None) -> DataFrame:
    return score_vendors(vendor_summary(data), rules or load_rules())


def unmatched(data: Datasets) -> DataFrame:
    # Only identity is needed to know the vendors, so neither the item join nor the
    # price window runs for this list.
    return unmatched_ncrs(prepare_ncrs(data), with_vendor_identity(data.purchase_orders))


def assessed_vendors(data: Datasets) -> DataFrame:
    return vendor_quality.assess(data.vendors)
