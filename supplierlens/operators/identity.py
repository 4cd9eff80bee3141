"""Vendor identity on PO lines and NCRs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplierlens.functions.text import match_city, match_name

VENDOR_KEY = ["vendor_match_name", "vendor_match_city"]


def with_vendor_identity(df: DataFrame, name: str = "vendor_name") -> DataFrame:
    return df.withColumns({
        "vendor_match_name": match_name(F.col(name)),
        "vendor_match_city": match_city(F.col(name)),
    })
