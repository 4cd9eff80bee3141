"""Lines meet parts and prices in one shuffle, and sources share the lines that they are made from."""

from contextlib import contextmanager

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from supplierlens.operators import vendor_summary
from supplierlens.operators.identity import VENDOR_KEY
from supplierlens.operators.lead_time import with_lead_time
from supplierlens.operators.pricing import PRICE_GROUP, price_measures, price_store, with_price_keys
from supplierlens.plans import reconcile
from supplierlens.sources import extracts, sampledata


@contextmanager
def settings(spark, **values):
    values = {f"spark.sql.{k.replace('_', '.')}": v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def delivered(spark, rows=4000):
    """Lines of which a third has one part, some none, and most one vendor; orders repeat and are missing."""
    n = F.col("id")
    day = F.lit("2026-01-01").cast("timestamp_ntz")
    return spark.range(rows).select(
        F.when(n % 29 != 0, F.floor(n / 3)).alias("po_number"), (n % 4).alias("line_no"),
        F.when(n % 3 == 0, " p-hot").when(n % 31 != 0, F.concat(F.lit("P-"), n % 40)).alias("part_number"),
        F.when(n % 5 != 0, "HOT").otherwise(F.concat(F.lit("V"), n % 7)).alias("vendor_match_name"),
        F.when(n % 6 != 0, "X").alias("vendor_match_city"), F.lit("CAD").alias("currency_code"), F.lit("EA").alias("uom"),
        F.when(n % 17 != 0, day + F.make_dt_interval(((n * 7919) % 400).cast("int"))).alias("order_date"),
        (day + F.make_dt_interval(((n * 31) % 450).cast("int"))).alias("last_receipt_date"),
        F.when(n % 13 != 0, ((n * 37) % 50).cast("double")).alias("unit_price"),
        (n % 11).cast("double").alias("ordered_qty"), (n % 9).cast("double").alias("received_qty"),
        (n % 4 != 0).alias("fully_received"), (n % 4 == 1).alias("delivery_eligible"), (n % 8 == 1).alias("on_time"),
        (n % 8 == 5).alias("late"), F.when(n % 8 == 5, n % 10).alias("late_days_only"))


def parts(spark):
    return spark.createDataFrame([("P-HOT", 90.0), *[(f"P-{i}", float(7 * i)) for i in range(0, 40, 3)], ("P-5", 1.0), ("p-5", 2.0)],
                                 "part_number string, lead_time double")


def row_by_row(po, items, keys=VENDOR_KEY):
    """Some measures by a plain join and a plain window over all lines."""
    w = Window.partitionBy(*PRICE_GROUP).orderBy(F.col("order_date").asc_nulls_last(), "po_number", "line_no", "unit_price")
    timed = with_lead_time(with_price_keys(po), items)
    return price_measures(timed.withColumn("previous_unit_price", F.lag("unit_price", 1).over(w))).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("po_transaction_count"), F.sum("received_qty").alias("total_received_qty"),
        F.count_distinct("po_number").alias("distinct_po_count"), F.count_if("late").alias("late_count"),
        F.count_if("lead_time_adherent").alias("lead_time_adherent_count"),
        F.round(F.avg("lead_time_variance_days"), 6).alias("average_lead_time_variance_days"),
        F.count_if("price_comparison_eligible").alias("price_comparison_count"),
        F.round(F.avg("price_change_pct"), 6).alias("average_price_change_pct"))


def rows_of(df, columns):
    shown = [F.round(c, 6).alias(c) if c.startswith("average") else F.col(c) for c in columns]
    return sorted(map(tuple, df.select(*shown).collect()), key=str)


@pytest.mark.parametrize("heavy_rows, part_rows", [(500_000, 1_000_000), (50, 40)])
def test_one_shuffle_gives_the_same_summary(spark, heavy_rows, part_rows):
    po, items = delivered(spark), parts(spark)
    store = price_store(po, vendor_summary.MEASURED)
    want = row_by_row(po, items)
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        out = vendor_summary.summarize_orders(store, items, heavy_rows=heavy_rows, part_rows=part_rows)
        assert rows_of(out, want.columns) == rows_of(want, want.columns)
        both = vendor_summary.summarize_orders(store, items, True, heavy_rows, part_rows)
        assert rows_of(both.where("NOT is_total"), want.columns) == rows_of(want, want.columns)
        whole = row_by_row(po, items, ())
        assert rows_of(both.where("is_total"), whole.columns) == rows_of(whole, whole.columns)


def test_the_window_needs_no_shuffle_of_its_own(spark):
    store = price_store(delivered(spark, 300), vendor_summary.MEASURED)
    with settings(spark, autoBroadcastJoinThreshold="-1", adaptive_enabled="false"):
        plan = plan_of(vendor_summary.summarize_orders(store, parts(spark)))
    shuffles = [x for x in plan if "Exchange hashpartitioning" in x]
    # Only the ends of parts are shuffled by price group; lines are by part and salt.
    assert sum("_part#" in x for x in shuffles) == 1 and all("_group#" in x for x in shuffles if "_part#" in x)
    # Orders are counted on pairs, which hold no other measure.
    assert all("partial_sum" not in x and "partial_avg" not in x for x in plan if "po_number#" in x and "HashAggregate(keys" in x
               and "po_number#" in x.split("functions=")[0])


def test_lines_are_not_shuffled_by_supplier(spark, sample):
    with settings(spark, autoBroadcastJoinThreshold="10000", adaptive_enabled="false"):
        plan = plan_of(sampledata.order_lines(sampledata.SampleTables(spark, sample)))
    shuffles = [x for x in plan if "Exchange hashpartitioning" in x]
    assert len(shuffles) == 2 and not any("suppkey" in x for x in shuffles)


def test_sources_read_the_kept_lines(spark, sample):
    plain, kept = (sampledata.SampleTables(spark, sample) for _ in range(2))
    kept.keep_lines()
    one, two = sampledata.order_lines(plain), sampledata.order_lines(kept)
    assert one.columns == two.columns and one.exceptAll(two).count() == two.exceptAll(one).count() == 0
    for name in ("purchase_orders", "ncrs"):
        a, b = (getattr(reconcile.load_system(spark, sample, tables=t), name) for t in (None, kept))
        assert a.columns == b.columns and a.exceptAll(b).count() == b.exceptAll(a).count() == 0
        assert not any("orders.parquet" in x for x in plan_of(b))


def test_repeated_companies_and_projects_still_multiply_lines(spark, sample):
    """Joins in another order keep what repeated keys do to the number of lines."""
    t = sampledata.SampleTables(spark, sample).keep_lines()
    lines = sampledata.order_lines(t)
    twice = [df.unionAll(df) for df in (sampledata.companies(t), sampledata.display_names(t), sampledata.projects(t))]
    out = extracts.po_extract(lines, sampledata.receipts(t), *twice, reconcile.EVERYTHING)
    named = sampledata.display_names(t).select(F.col("company_id").alias("supplier_company_id"))
    assert out.count() == 8 * lines.join(named, "supplier_company_id", "left_semi").count() \
        + 4 * lines.join(named, "supplier_company_id", "left_anti").count()


def test_lines_are_shuffled_with_codes_and_days(spark):
    """No text of a vendor and no receipt date goes with the lines, nor the part twice."""
    store = price_store(delivered(spark, 300), vendor_summary.MEASURED)
    with settings(spark, autoBroadcastJoinThreshold="-1", adaptive_enabled="false"):
        plan = vendor_summary.summarize_orders(store, parts(spark))._jdf.queryExecution().executedPlan()
    todo, found = [plan], []
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Exchange" and "_salt#" in node.outputPartitioning().toString():
            found.append({node.output().apply(i).name() for i in range(node.output().size())})
    lines = [c for c in found if "unit_price" in c]
    assert len(lines) == 1 and {"_terms", "commercial_part_key", "actual_lead_time_days"} < lines[0]
    assert not lines[0] & {*VENDOR_KEY, "commercial_currency_key", "commercial_uom_key", "last_receipt_date",
                           "part_number", "part_number_match_key"}


def test_terms_that_share_a_code_are_told_apart(spark, monkeypatch):
    """A code that two terms or two vendors share is given up; nulls have codes of their own."""
    plain = vendor_summary._code
    monkeypatch.setattr(vendor_summary, "_code", lambda columns, seed: plain(columns, seed) % (2 if seed < 2 else 1 << 62))
    po, items = delivered(spark), parts(spark)
    store = price_store(po, vendor_summary.MEASURED)
    assert vendor_summary.coded_terms(store)[1] == 2
    want = row_by_row(po, items)
    assert rows_of(vendor_summary.summarize_orders(store, items), want.columns) == rows_of(want, want.columns)
    swapped = spark.createDataFrame([("A", None, "X", None), (None, "A", None, "X"), (None, "A", "X", None)],
                                    ", ".join(f"{c} string" for c in vendor_summary.TERMS))
    terms, seed = vendor_summary.coded_terms(swapped)
    assert seed == 2 and terms.count() == terms.select("_terms").distinct().count() == 3


@pytest.mark.parametrize("kind", ["string", "double"])
def test_blank_and_numeric_parts(spark, kind):
    """A blank part has prices but no lead time, a missing one neither; numeric parts match by whole number."""
    named = ["", None, " ", "7", "7.5", "x" if kind == "string" else "8"]
    n = F.col("id")
    po = delivered(spark, 600).withColumn("id", F.monotonically_increasing_id()).withColumn(
        "part_number", F.array(*map(F.lit, named))[(n % 6).cast("int")])
    po = po.drop("id").withColumn("part_number", F.col("part_number").try_cast(kind))
    items = spark.createDataFrame([("7", 30.0), ("7.5", 40.0), ("X", 50.0)], "part_number string, lead_time double")
    want = row_by_row(po, items)
    out = vendor_summary.summarize_orders(price_store(po, vendor_summary.MEASURED), items)
    assert rows_of(out, want.columns) == rows_of(want, want.columns)
    assert out.agg(F.sum("lead_time_adherent_count"), F.sum("price_comparison_count")).first()[0] > 0


def test_unused_projects_do_not_shuffle_lines(spark, sample):
    t = sampledata.SampleTables(spark, sample).keep_lines()
    with settings(spark, autoBroadcastJoinThreshold="-1", adaptive_enabled="false"):
        po = reconcile.load_system(spark, sample, tables=t).purchase_orders
        assert any("project_number" in x for x in plan_of(po) if "Exchange hashpartitioning" in x)
        narrow = po.select("po_number", "received_qty", "vendor_name")
        assert not any("project_number" in x for x in plan_of(narrow) if "Exchange hashpartitioning" in x)


def test_unused_receipts_do_not_shuffle_lines(spark, sample):
    """The parity of columns that are the line's own runs without the receipt log."""
    t = sampledata.SampleTables(spark, sample).keep_lines()
    with settings(spark, adaptive_enabled="false"):
        po = reconcile.load_system(spark, sample, tables=t).purchase_orders
        assert any("line_no" in x for x in plan_of(po) if "Exchange hashpartitioning" in x)
        own = po.select(*extracts.LINE_KEY, "unit_price", "uom", "order_date")
        assert not any("Exchange hashpartitioning" in x for x in plan_of(own))


def test_a_directory_with_a_key_twice_is_left_as_it_is(spark):
    some = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "k int, v string")
    asked = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    for directory, rows in ((some, 4), (some.unionAll(some), 6)):
        known = extracts.known_unique(directory, "k")
        assert asked.join(known, "k", "left").count() == rows
        assert rows_of(asked.join(known, "k", "left"), ["k", "v"]) == rows_of(asked.join(directory, "k", "left"), ["k", "v"])
