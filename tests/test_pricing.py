"""Price history against a plain window, wherever large groups are cut."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from supplierlens.operators import pricing
from supplierlens.session import written


def lines(spark, rows, groups=7, hot=0):
    """``rows`` lines in ``groups`` groups, one in three of them in the first if ``hot``."""
    n = F.col("id")
    group = F.when(F.lit(bool(hot)) & (n % 3 == 0), 0).otherwise(n % groups)
    return spark.range(rows).select(
        n.alias("po_number"), (n % 4).alias("line_no"), F.concat(F.lit("P"), group).alias("part_number"),
        F.when(n % 11 != 0, F.lit("V")).alias("vendor_match_name"), F.lit(None).cast("string").alias("vendor_match_city"),
        F.lit("CAD").alias("currency_code"), F.lit("EA").alias("uom"),
        F.when(n % 17 != 0, F.make_dt_interval(((n * 7919) % 400).cast("int")) + F.lit("2026-01-01").cast("timestamp_ntz")).alias("order_date"),
        F.when(n % 13 != 0, ((n * 31) % 50).cast("double")).alias("unit_price"))


def plain(po):
    po = pricing.with_price_keys(po)
    w = Window.partitionBy(*pricing.PRICE_GROUP).orderBy(
        F.col("order_date").asc_nulls_last(), "po_number", "line_no", "unit_price")
    return po.withColumn("previous_unit_price", F.lag("unit_price", 1).over(w))


def rows_of(df):
    return sorted(df.select("po_number", "previous_unit_price").collect())


@pytest.mark.parametrize("hot", [0, 1])
@pytest.mark.parametrize("part_rows", [20, 60, 1_000_000])
def test_cuts_change_nothing(spark, part_rows, hot):
    po = lines(spark, 3000, hot=hot)
    store = pricing.price_store(po)
    out = pricing.with_previous_price(store, part_rows=part_rows)
    assert rows_of(out) == rows_of(plain(po))
    cuts = pricing._cuts(store, pricing.PRICE_GROUP, part_rows).select(F.size("_cuts")).collect()
    assert (sum(r[0] for r in cuts) > 20) == (part_rows < 1_000_000)
    assert sum(r[0] for r in cuts) <= 1.5 * 3000 / part_rows + 1


def test_groups_that_share_a_hash(spark, monkeypatch):
    po = lines(spark, 2000)
    want, store = rows_of(plain(po)), pricing.price_store(po)
    monkeypatch.setattr(pricing.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    assert rows_of(pricing.with_previous_price(store, part_rows=40)) == want


def test_two_sources_in_one_pass(spark):
    one, two = lines(spark, 500), lines(spark, 700, groups=3)
    both = one.withColumn("source", F.lit("a")).unionByName(two.withColumn("source", F.lit("b")))
    out = pricing.with_price_history(pricing.price_store(both, ["source"]), ("source",))
    assert rows_of(out.where("source = 'a'")) == rows_of(plain(one))
    assert rows_of(out.where("source = 'b'")) == rows_of(plain(two))


def test_parts_of_a_hot_group_are_even(spark):
    """A group of all rows is cut into parts of about the wanted size."""
    store = pricing.price_store(lines(spark, 20_000, groups=1).withColumn("vendor_match_name", F.lit("V")))
    listed = written(pricing._cuts(store, pricing.PRICE_GROUP, 1000).select("_cuts"), "cuts")
    cuts, at = listed.first()["_cuts"], pricing._order_struct(store)
    sizes = store.join(F.broadcast(listed)).groupBy(pricing._part(F.col("_cuts"), at).alias("p")).count().collect()
    assert len(sizes) == len(cuts) + 1 and max(r["count"] for r in sizes) < 2500


def test_the_line_plan_runs_once(spark):
    """Lines are made for the store alone: the history reads only what is written."""
    store = pricing.price_store(lines(spark, 200))
    plan = pricing.with_price_history(store)._jdf.queryExecution().executedPlan().toString()
    assert "Range (" not in plan and "price-store" in plan


def test_missing_and_zero_prices(spark):
    rows = [(1, 5.0), (2, None), (3, 6.0), (4, 0.0), (5, 4.0)]
    po = spark.createDataFrame([(n, 1, "P", "V", "C", "CAD", "EA", p) for n, p in rows],
                               "po_number int, line_no int, part_number string, vendor_match_name string, "
                               "vendor_match_city string, currency_code string, uom string, unit_price double"
                               ).withColumn("order_date", F.lit("2026-01-01").cast("timestamp_ntz"))
    got = {r["po_number"]: (r["previous_unit_price"], r["price_comparison_eligible"])
           for r in pricing.with_price_history(pricing.price_store(po)).collect()}
    assert got == {1: (None, False), 2: (5.0, False), 3: (None, False), 4: (6.0, False), 5: (0.0, False)}
