"""A third of all rows under one key gives the same results as any other spread."""

import difflib

from pyspark.sql import functions as F

from supplierlens.operators import lead_time, similarity, skew, vendor_quality, vendor_summary
from supplierlens.operators.identity import with_vendor_identity


def test_hot_part_key(spark):
    n = F.col("id")
    po = spark.range(9000).select(
        F.when(n % 3 == 0, "P-HOT").otherwise(F.concat(F.lit("P-"), n % 50)).alias("part_number"),
        F.lit("2026-01-01").cast("timestamp_ntz").alias("order_date"),
        F.lit("2026-01-05").cast("timestamp_ntz").alias("last_receipt_date"), F.lit(True).alias("fully_received"))
    items = spark.createDataFrame([("P-HOT", 5.0), *[(f"P-{i}", float(i)) for i in range(50)]],
                                  "part_number string, lead_time double")
    out = lead_time.with_lead_time(po, items)
    hot = out.where("part_number = 'P-HOT'").agg(F.count(F.lit(1)), F.min("item_lead_time_days")).first()
    assert tuple(hot) == (3000, 5)
    assert out.count() == 9000


def test_hot_vendor_of_ncrs(spark):
    n = F.col("id")
    ncrs = with_vendor_identity(spark.range(6000).select(
        n.alias("ncr_number"), F.when(n % 3 == 0, "HOT [X]").otherwise(F.concat(F.lit("V"), n % 40, F.lit(" [Y]"))).alias("vendor_name"),
        F.lit(True).alias("supplier_linked")))
    keys = spark.createDataFrame([("HOT", "X"), ("V1", "Y")], "vendor_match_name string, vendor_match_city string")
    status = {r["match_status"]: r["n"] for r in vendor_summary.with_match_status(ncrs, keys).groupBy("match_status").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert status["MATCHED"] + status["UNMATCHED"] == 6000
    assert status["MATCHED"] == 2000 + ncrs.where("vendor_match_name = 'V1'").count()


def test_hot_duplicate_key(spark):
    n = F.col("id")
    vendors = spark.range(3000).select(
        n.alias("company_id"), F.when(n % 3 == 0, "SAME").otherwise(F.concat(F.lit("V"), n)).alias("vendor_name"),
        F.lit("1 Rd").alias("address_line_1"), F.lit("C").alias("city"), F.lit("S").alias("state_province"),
        F.lit("Z").alias("postal_code"))
    out = vendor_quality.with_exact_duplicates(vendor_quality.with_completeness(vendors))
    assert out.where("exact_duplicate_flag").count() == 1000


def test_heavy_keys_are_dealt_out(spark):
    """A third of the rows under one key: no salted key gets many more rows than the limit."""
    n = F.col("id")
    many = spark.range(30_000).select(F.when(n % 3 == 0, "HOT").otherwise(F.concat(F.lit("K"), n % 997)).alias("k"), n)
    few = many.select("k").distinct().withColumn("v", F.length("k"))
    heavy = skew.heavy_keys(many.groupBy("k").count(), ["k"], "count", 500)
    assert [tuple(r) for r in heavy.collect()] == [("HOT", 20)]
    out = skew.salted_join(many, few, ["k"], heavy, n)
    assert out.count() == 30_000 and out.where("v = length(k)").count() == 30_000
    dealt = many.join(F.broadcast(heavy), "k").groupBy(F.pmod(F.xxhash64("id"), "_salts").alias("s")).count()
    assert dealt.agg(F.max("count")).first()[0] < 700
    kept = skew.salted_join(many, few.where("k <> 'HOT'"), ["k"], heavy, n, "left")
    assert kept.count() == 30_000 and kept.where("v IS NULL").count() == 10_000


def test_a_third_of_vendors_in_one_city(spark):
    """Look-alikes of a large city: its frequent tokens are heavy keys, and the result is whole."""
    rows = [(i, f"{'ABCDEFGH'[i % 8]}{i % 40} STEEL WORKS {i % 7}", "1 RD" if i % 4 else None, "BIG" if i % 3 == 0 else f"C{i % 50}", "S", "Z")
            for i in range(1200)]
    vendors = spark.createDataFrame(rows, "company_id long, vendor_name string, address_line_1 string, city string, "
                                          "state_province string, postal_code string")
    keyed = vendor_quality.with_keys(vendor_quality.with_completeness(vendors))
    salted = similarity.look_alikes(keyed, 95.0, heavy_rows=50)
    want = sum(1 for i, a, x, c, *_ in rows if x is None for j, b, y, d, *_ in rows
               if y is not None and c == d and 100 * difflib.SequenceMatcher(None, a, b).ratio() >= 95)
    assert salted.count() == want


def rows_of_largest_task(spark, df):
    """Rows of the largest of 64 tasks after a join by shuffle, without adaptive execution."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        return df.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count")).first()[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_task_sizes_of_a_heavy_part(spark):
    """A third of the lines has one part, a third none: no task gets much more than its share."""
    n = F.col("id")
    po = spark.range(30_000).select(
        n.cast("string").alias("po_number"),
        F.when(n % 3 == 0, "P-HOT").when(n % 3 == 1, F.concat(F.lit("P-"), n % 997)).alias("part_number"),
        F.lit("2026-01-01").cast("timestamp_ntz").alias("order_date"),
        F.lit("2026-01-05").cast("timestamp_ntz").alias("last_receipt_date"), F.lit(True).alias("fully_received"))
    items = spark.createDataFrame([("P-HOT", 5.0), *[(f"P-{i}", float(i)) for i in range(997)]],
                                  "part_number string, lead_time double")
    dealt = lead_time.with_lead_time(po, items, heavy_rows=100)
    assert rows_of_largest_task(spark, dealt) < 1500
    assert rows_of_largest_task(spark, lead_time.with_lead_time(po, items)) >= 10_000
    plain = po.join(lead_time.lead_time_reference(items), F.col("part_number") == F.col("part_number_match_key"), "left")
    columns = ["po_number", "item_lead_time_days"]
    assert sorted(map(tuple, dealt.select(*columns).collect()), key=str) == sorted(
        map(tuple, plain.select(*columns).collect()), key=str)


def test_task_sizes_of_a_heavy_vendor(spark):
    n = F.col("id")
    ncrs = spark.range(30_000).select(
        n.alias("ncr_number"), F.lit(True).alias("supplier_linked"),
        F.when(n % 3 == 0, "HOT").otherwise(F.concat(F.lit("V"), n % 997)).alias("vendor_match_name"),
        F.when(n % 3 < 2, "X").alias("vendor_match_city"))
    keys = spark.createDataFrame([("HOT", "X"), ("V1", "X")], "vendor_match_name string, vendor_match_city string")
    dealt = vendor_summary.with_match_status(ncrs, keys, heavy_rows=100)
    assert rows_of_largest_task(spark, dealt) < 1500
    status = {r["match_status"]: r["count"] for r in dealt.groupBy("match_status").count().collect()}
    matched = sum(1 for i in range(30_000) if i % 3 == 0 or i % 3 == 1 and i % 997 == 1)
    assert status == {"MATCHED": matched, "MISSING LOCATION": 10_000, "UNMATCHED": 20_000 - matched}
