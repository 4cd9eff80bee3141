"""Names, numbers, dates, delivery, lead time and grades on single rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from supplierlens.functions.dates import text_to_timestamp
from supplierlens.functions.numeric import part_key, text_to_double
from supplierlens.functions.text import status_suffix
from supplierlens.operators.delivery import with_delivery
from supplierlens.operators.identity import with_vendor_identity
from supplierlens.operators.lead_time import lead_time_reference, with_lead_time
from supplierlens.operators.scoring import grade, load_rules
from supplierlens.sources import ingest


@pytest.mark.parametrize(("name", "expected"), [
    ("Acme Steel [BRAMPTON] (APPROVED)", ("ACME STEEL", "BRAMPTON")),
    ("Acme Steel [BRAMPTON]", ("ACME STEEL", "BRAMPTON")),
    ("Acme Steel", ("ACME STEEL", None)),
    ("Acme [ON] Steel [BRAMPTON]", ("ACME [ON] STEEL", "ON")),
    ("\tAcme [X] ", ("ACME", "X")),
])
def test_vendor_identity(spark, name, expected):
    row = with_vendor_identity(spark.createDataFrame([(name,)], "vendor_name string")).first()
    assert (row["vendor_match_name"], row["vendor_match_city"]) == expected


def test_unusual_cities(spark):
    rows = with_vendor_identity(spark.createDataFrame([("Acme [ ]",), ("Acme []",), (None,)], "vendor_name string")).collect()
    assert [r["vendor_match_city"] for r in rows] == ["", None, None]


def test_number_text(spark):
    df = spark.createDataFrame([(x,) for x in (" 12 ", "12d", "nan", "1e3", "1,000", None)], "x string")
    assert [r[0] for r in df.select(text_to_double(F.col("x"))).collect()] == [12, None, None, 1000, None, None]


def test_part_keys(spark):
    text = spark.createDataFrame([("  ",), (" p-1 ",), (None,)], "part_number string")
    assert [r[0] for r in text.select(part_key(text)).collect()] == [None, "P-1", None]
    number = spark.createDataFrame([(12345.0,), (1.5,), (float("nan"),)], "part_number double")
    assert [r[0] for r in number.select(part_key(number)).collect()] == ["12345", "1.5", None]


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("2026-01-02 03:04:05",), ("week 2",), (None,)], "x string")
    assert [r[0] for r in df.select(text_to_timestamp(F.col("x"))).collect()] == [
        dt.datetime(2026, 1, 2, 3, 4, 5), None, None]


def test_whole_suffix(spark):
    name = "ACME (" + "very " * 20 + "long)"
    df = spark.createDataFrame([(name,), ("ACME",), (None,)], "n string")
    assert [r[0] for r in df.select(status_suffix(F.col("n"))).collect()] == [name[4:], "(none)", "(none)"]


LINES = "ordered_qty int, received_qty double, required_date timestamp_ntz, revised_date timestamp_ntz, last_receipt_date timestamp_ntz"


def day(text):
    return dt.datetime.fromisoformat(text)


def test_delivery(spark):
    need = day("2026-01-10")
    rows = with_delivery(spark.createDataFrame([
        (10, 10.0, need, None, day("2026-01-08")), (10, 10.0, need, None, day("2026-01-12")),
        (10, 5.0, need, None, day("2026-01-09")), (10, 10.0, need, day("2026-01-15"), day("2026-01-14")),
        (5, float("nan"), need, None, day("2026-01-09")),
        (10, 10.0, day("2026-01-10 18:00"), None, day("2026-01-11 06:00")),
    ], LINES).transform(ingest.without_nan)).collect()
    assert [(r["delivery_eligible"], r["on_time"], r["late"], r["days_late"]) for r in rows] == [
        (True, True, False, 0), (True, False, True, 2), (False, False, False, None), (True, True, False, 0),
        (False, False, False, None), (True, False, True, 0)]
    assert rows[3]["target_date"] == day("2026-01-15")


def test_lead_time(spark):
    items = spark.createDataFrame([("A", 5.0), ("a ", None), ("B", 5.0), ("B", 7.0)], "part_number string, lead_time double")
    assert {r["item_part_key"] if "item_part_key" in r else r[0]: r["item_lead_time_days"]
            for r in lead_time_reference(items).collect()}.get("A") == 5
    po = spark.createDataFrame([("A", day("2026-01-01 18:00"), day("2026-01-01 06:00"), True)],
                               "part_number string, order_date timestamp_ntz, last_receipt_date timestamp_ntz, fully_received boolean")
    row = with_lead_time(po, items).first()
    assert (row["actual_lead_time_days"], row["lead_time_eligible"]) == (-1, False)


def test_grades(spark):
    df = spark.createDataFrame([(90.0,), (89.999,), (0.0,), (None,)], "s double")
    rules = load_rules()
    assert [r[0] for r in df.select(grade(F.col("s"), rules)).collect()] == ["A", "B", "D", "N/A"]
    high = {**rules, "grade_thresholds": {"A": 90}}
    assert spark.createDataFrame([(10.0,)], "s double").select(grade(F.col("s"), high)).first()[0] == "N/A"
