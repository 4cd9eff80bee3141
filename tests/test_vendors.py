"""Fuzzy candidates against brute force, match totals, reports and snapshots."""

import datetime as dt
import difflib
import random

import pytest
from pyspark.sql import functions as F

from supplierlens.operators import similarity, vendor_quality
from supplierlens.plans import reports, scorecard
from supplierlens.plans.registry import QUERIES


@pytest.mark.parametrize("least", [60.0, 85.0, 95.0, 100.0])
def test_look_alikes_lose_nothing(spark, least):
    rnd = random.Random(5)
    words = ["ACME", "STEEL", "WORKS", "PARTS", "EAST", "EE", "LTD", "INC"]
    rows = [(i, " ".join(rnd.sample(words, rnd.randint(1, 4))) + rnd.choice(["", "S", " E"]),
             f"{rnd.randint(1, 9)} MAIN ST" if i % 3 else None, rnd.choice(["X", "Y"]), "S", "Z1") for i in range(160)]
    vendors = spark.createDataFrame(
        rows, "company_id long, vendor_name string, address_line_1 string, city string, state_province string, postal_code string")
    keyed = vendor_quality.with_keys(vendor_quality.with_completeness(vendors))
    got = {(r["company_id_incomplete"], r["company_id_complete"]): r["name_similarity"]
           for r in similarity.look_alikes(keyed, least, heavy_rows=10).collect()}
    assert got == {(r["company_id_incomplete"], r["company_id_complete"]): r["name_similarity"]
                   for r in similarity.look_alikes(keyed, least).collect()}
    want = {}
    for i, a, street, city, *_ in rows:
        for j, b, other, where, *_ in rows:
            if street is None and other is not None and city == where:
                ratio = 100 * difflib.SequenceMatcher(None, a, b).ratio()
                if ratio >= least:
                    want[i, j] = ratio
    assert got == pytest.approx(want)


def test_totals_add_up(spark, sample):
    data = scorecard.load_sample(spark, sample)
    po = scorecard.prepare_orders(data)
    lines = po.agg(F.count(F.lit(1)).alias("n"), F.count_if("on_time").alias("on"), F.count_if("late").alias("late"),
                   F.count_if("delivery_eligible").alias("eligible")).first()
    assert lines["on"] + lines["late"] == lines["eligible"]
    vendors = scorecard.order_summary(data).agg(F.sum("po_transaction_count").alias("n")).first()
    assert vendors["n"] == lines["n"]
    totals = QUERIES["ncr_match_controls"](spark, sample).first()
    assert totals["matched"] + totals["unmatched_with_location"] + totals["missing_location"] == totals["accounted_for"]
    assert QUERIES["recon_vendor_diff"](spark, sample).count() > 0


def test_picker_order(spark):
    card = spark.createDataFrame([("A B", "X"), ("A", "Z"), ("A", None), (None, "Q")],
                                 "vendor_match_name string, vendor_match_city string")
    labels = [r[0] for r in reports.vendor_picker(card).collect()]
    assert [x.split(" |")[0] for x in labels] == ["A", "A", "A B", labels[3].split(" |")[0]]
    assert labels[0].endswith("Z")


def test_detail_keeps_all_rows_of_a_key(spark):
    card = spark.createDataFrame([("A", None), ("A", ""), ("B", "")], "vendor_match_name string, vendor_match_city string")
    assert reports.vendor_detail(card, "A").count() == 2


def test_snapshot_versions(spark, tmp_path):
    path, at = str(tmp_path / "snapshot"), dt.datetime(2026, 1, 1, 12)
    one, two = (spark.createDataFrame([(x,)], "v int") for x in (1, 2))
    assert not reports.snapshot_is_fresh(spark, path, at)
    first = reports.refresh_snapshot(spark, one, path, at)
    assert reports.refresh_snapshot(spark, two, path, at + dt.timedelta(minutes=5)).first()["v"] == 1
    assert reports.refresh_snapshot(spark, two, path, at + dt.timedelta(minutes=20)).first()["v"] == 2
    assert first.first()["v"] == 1
    assert reports.refresh_snapshot(spark, one, path, at + dt.timedelta(minutes=21), force=True).first()["v"] == 1
