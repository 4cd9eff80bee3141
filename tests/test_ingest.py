"""Loading: headers, rejected rows, malformed files, truth values, and the whole parity dataset."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from supplierlens.operators.scoring import load_rules
from supplierlens.operators.vendor_quality import assess
from supplierlens.plans import reconcile, scorecard
from supplierlens.sources import contracts, ingest
from tests.helpers import delivered


def test_nan_in_a_required_column_is_missing(spark):
    schema = "po_number long, vendor_name string, part_number string, ordered_qty double, order_date timestamp_ntz"
    po = spark.createDataFrame([(1, "A", "P", float("nan"), None), (2, "A", "P", 1.0, None)], schema).withColumn(
        "order_date", F.lit("2026-01-01").cast("timestamp_ntz"))
    assert [r[0] for r in ingest.rejected_lines(po).select("po_number").collect()] == [1]
    assert ingest.with_row_status(ingest.strip_header_rows(po)).where("row_status = 'VALID'").count() == 1


def test_malformed_rows_fail(spark, tmp_path):
    path = tmp_path / "vendors.csv"
    headers = ",".join(contracts.SOURCE_COLUMNS["vendors"])
    path.write_text(f'{headers}\n1,"A\nB",x,y,z,s,p,c\n')
    with pytest.raises((PySparkException, Py4JJavaError), match="(?i)malformed|FAILED_READ_FILE"):
        ingest.read_dataset(spark, str(path), "vendors").collect()
    row, = ingest.read_dataset(spark, str(path), "vendors", multi_line=True).collect()
    assert row["vendor_name"] == "A\nB"


def test_missing_columns_fail(spark, tmp_path):
    path = tmp_path / "vendors.csv"
    path.write_text("CompanyID\n1\n")
    with pytest.raises(contracts.ContractError):
        ingest.read_dataset(spark, str(path), "vendors")
    with pytest.raises(contracts.ContractError):
        contracts.check_ready({"items": spark.createDataFrame([(1,)], "description int")})


def test_unknown_truth_values_are_named(spark):
    df = spark.createDataFrame([(f"maybe {i}",) for i in range(12)] + [("yes",), (None,)], "resolved string")
    with pytest.raises(contracts.ContractError) as error:
        ingest.check_truth(df, ("resolved",))
    assert str(error.value).count("maybe") == 8
    with pytest.raises(PySparkException):
        ingest.coerce_truth(df, ("resolved",)).collect()
    words = spark.createDataFrame([(x,) for x in ("1", "TRUE", " y", "0", "No", "f")], "resolved string")
    assert [r[0] for r in ingest.coerce_truth(words, ("resolved",)).collect()] == [True] * 3 + [False] * 3


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    return scorecard.load_files(spark, delivered(tmp_path_factory.mktemp("delivered")), multi_line=("ncrs",))


def test_delivered_files(spark, loaded):
    data, rejected = loaded
    assert [r["part_number"] for r in rejected.collect()] == ["K-9"]
    rules = load_rules()
    cards = {(r["vendor_match_name"], r["vendor_match_city"]): r for r in scorecard.scorecard(data, rules).collect()}
    assert set(cards) == {("TIDE WORKS", "PORTO"), ("FERRO OY", "TURKU")}
    tide, ferro = cards["TIDE WORKS", "PORTO"], cards["FERRO OY", "TURKU"]
    assert (tide["po_transaction_count"], ferro["po_transaction_count"]) == (7, 1)
    assert (tide["delivery_eligible_count"], tide["on_time_count"], tide["late_count"], tide["average_days_late"]) == (7, 6, 1, 10)
    assert (tide["price_comparison_count"], tide["price_stable_count"], tide["price_increase_count"]) == (6, 4, 2)
    assert (tide["supplier_linked_ncr_count"], tide["quality_eligible_ncr_count"], tide["resolved_ncr_count"],
            tide["unresolved_ncr_count"]) == (2, 1, 1, 1)
    delivery, quality, price = 600 / 7, tide["quality_prototype_score"], 400 / 6
    assert [tide[f"{c}_prototype_grade"] for c in ("delivery", "lead_time", "responsiveness", "commercial")] == [
        "B", "N/A", "N/A", "D"]
    assert 0 <= quality < 50
    assert (tide["prototype_scored_component_count"], tide["prototype_weight_coverage_pct"]) == (3, 70)
    assert tide["prototype_overall_score"] == pytest.approx((25 * delivery + 25 * quality + 20 * price) / 70)
    assert (ferro["prototype_overall_grade"], ferro["prototype_overall_status"]) == ("N/A", "INSUFFICIENT COMPONENT COVERAGE")


def test_delivered_vendors(loaded):
    rows = {r["company_id"]: r for r in assess(loaded[0].vendors).collect()}
    assert rows["9"]["vendor_quality_status"] == "COMPLETE"
    assert rows["10"]["review_reason"] == "MISSING: ADDRESS, POSTAL CODE"


def test_blank_and_zero_receipts_are_the_documented_difference(spark):
    left = spark.createDataFrame([(1, None), (2, 3.0), (3, 0.0)], "k int, received_qty double")
    right = spark.createDataFrame([(1, 0.0), (2, 4.0), (3, 0.0)], "k int, received_qty double")
    row = reconcile.dataset_parity("purchase_orders", left, right, ["k"], ["received_qty"]).first()
    assert (row["compared"], row["documented"], row["undocumented"]) == (3, 1, 1)
