"""The star-schema test tables seen as a purchasing system.

Each function builds one source table from whole base tables, with the awkward cases
the cleaning rules exist for: missing keys, names without a city, status suffixes,
partial receipts, text numbers, conflicting lead times, duplicate vendors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplierlens.session import written

COMPANY_OFFSET = 1_000_000_000  # customers as companies, above every supplier key


class SampleTables:
    """The base tables below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.kept_lines: DataFrame | None = None

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_"):
            raise AttributeError(table)
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def keep_lines(self) -> SampleTables:
        """Writes the order lines; ``order_lines`` reads them from then on, so that several
        datasets made from lines do not join lines and headers each on their own."""
        self.kept_lines = written(order_lines(self), "order-lines", "zstd")
        return self


def _days(x: Column) -> Column:
    return F.make_dt_interval(x.cast("int"))


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _with_nation(s: DataFrame, t: SampleTables) -> DataFrame:
    # nation has 25 rows at every scale, which is what makes the broadcast safe.
    nation = F.broadcast(t.nation.select("n_nationkey", "n_name", "n_regionkey"))
    return s.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).withColumn(
        "status_text",
        F.when(F.col("s_suppkey") % 4 == 0, " (Approved)")
        .when(F.col("s_suppkey") % 4 == 1, "")
        .when(F.col("s_suppkey") % 4 == 2, " (APPROVED)")
        .otherwise(" (Inactive)"),
    )


def suppliers(t: SampleTables) -> DataFrame:
    return _with_nation(t.supplier, t)


def _with_supplier(lines: DataFrame, t: SampleTables) -> DataFrame:
    """Lines with their supplier. The supplier table meets them by itself: its size is known,
    so Spark broadcasts it while it is small, which it would not do with the result of a join."""
    return _with_nation(lines.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")), t)


def _line_vendor_name() -> Column:
    """Display name on a line; some suppliers ship almost everything from a depot."""
    place = (
        F.when(F.col("l_suppkey") % 11 == 0, "")
        .when((F.col("l_suppkey") % 10 == 9) & (F.col("l_orderkey") % 200 != 1), " [Central Depot]")
        .otherwise(_text(" [", F.col("n_name"), "]"))
    )
    return F.concat(F.col("s_name"), place, F.col("status_text"))


def order_headers(t: SampleTables) -> DataFrame:
    status, priority, date = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")
    return t.orders.select(
        F.col("o_orderkey").alias("po_number"),
        date.alias("order_date"),
        F.col("o_custkey").alias("project_number"),
        priority.alias("buyer"),
        (status != "P").alias("header_active"),
        priority.isin("1-URGENT", "2-HIGH").alias("printed"),
        (priority == "3-MEDIUM").alias("emailed"),
        F.when(priority != "5-LOW", date + F.expr("INTERVAL '35' DAY")).alias("header_required_date"),
        F.when(status == "P", date + F.expr("INTERVAL '45' DAY")).alias("header_revised_date"),
    )


def _order_details() -> list[Column]:
    """PO lines as stored with the order: no header fields, no receipt dates."""
    open_line, nr = F.col("l_linestatus") == "O", F.col("l_linenumber")
    return [
        F.col("l_orderkey").alias("po_number"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supplier_company_id"),
        F.when(F.col("l_orderkey") % 89 != 0, _text("P-", F.col("l_partkey"))).alias("part_number"),
        F.when(F.col("l_orderkey") % 97 != 0, _line_vendor_name()).alias("vendor_name"),
        F.col("l_quantity").alias("ordered_qty"),
        F.when(open_line & (nr % 3 == 1), F.col("l_quantity") - 1)
        .when(open_line & (nr % 3 == 0), None)
        .otherwise(F.col("l_quantity")).alias("received_qty"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("extended_value"),
        F.when(F.col("l_partkey") % 41 == 0, None)
        .when(F.col("l_partkey") % 2 == 0, "EA").otherwise(" kg").alias("uom"),
        F.when(F.col("l_suppkey") % 3 == 0, "USD").otherwise("cad ").alias("currency_code"),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 0)
        .alias("archived"),
        F.when(open_line & (nr % 3 == 0), None)
        .otherwise((F.col("l_partkey") * 31 + nr * 17) % (F.col("l_suppkey") % 40 + 20))
        .alias("receipt_lag_days"),
    ]


def _with_dates(lines: DataFrame) -> DataFrame:
    date = F.col("order_date")
    return lines.withColumns({
        "required_date": F.when(F.col("part_id") % 53 != 0, date + F.expr("INTERVAL '30' DAY")),
        "revised_date": F.when(F.col("line_no") % 5 == 0, date + F.expr("INTERVAL '40' DAY")),
        "last_receipt_date": date + _days(F.col("receipt_lag_days")),
    }).drop("receipt_lag_days")


def order_lines(t: SampleTables) -> DataFrame:
    """Every PO line with its header, as a spreadsheet extract would deliver it."""
    if t.kept_lines is not None:
        return t.kept_lines
    headers = order_headers(t)
    # The header comes first, so that only the stored, narrow columns of a line are shuffled.
    lines = _with_supplier(t.lineitem.join(headers, F.col("l_orderkey") == F.col("po_number")).drop("po_number"), t)
    return _with_dates(lines.select(*_order_details(), *[c for c in headers.columns if c != "po_number"]))


def purchase_orders_raw(t: SampleTables) -> DataFrame:
    """The spreadsheet form: all lines plus one spacer row per region."""
    lines = order_lines(t)
    spacers = t.region.select((F.col("r_regionkey") + F.lit(90_000_000)).cast("long").alias("po_number"),
                              F.lit(0).alias("line_no"))
    return lines.unionByName(spacers, allowMissingColumns=True)


def receipts(t: SampleTables) -> DataFrame:
    """Receipt events; later line numbers arrive in two deliveries three days apart, others
    in one that logs the whole quantity."""
    got = F.col("received_qty")
    twice = F.col("line_no") >= 6
    first = F.when(twice, F.floor(got / 2)).otherwise(0)
    slip = F.when(F.col("part_id") % 31 == 0, 1).when(F.col("part_id") % 37 == 0, -1).otherwise(0)
    late = F.struct(F.lit(2).alias("receipt_seq"), F.col("last_receipt_date").alias("receipt_date"),
                    (got - first + slip).cast("double").alias("qty"))
    early = F.struct(F.lit(1).alias("receipt_seq"),
                     (F.col("last_receipt_date") - F.expr("INTERVAL '3' DAY")).alias("receipt_date"),
                     first.cast("double").alias("qty"))
    deliveries = F.when(twice, F.array(early, late)).otherwise(F.array(late))
    return (
        order_lines(t).where(got > 0)
        .select("po_number", "line_no", "part_id", "supplier_company_id", F.inline(deliveries))
    )


def ncrs_raw(t: SampleTables) -> DataFrame:
    """Non-conformances: returned lines beyond the tolerance of the supplier's nation."""
    defect = F.round((F.col("l_discount") + F.col("l_tax")) * 100).cast("int") * 10
    lines = (
        _with_supplier(t.lineitem.where(F.col("l_returnflag") == "R"), t)
        .where(defect >= F.col("n_nationkey") * 3 + 100)
    )
    return lines.select(
        _text("NC-", F.col("l_orderkey"), "-", F.col("l_linenumber"), "-", F.col("l_partkey"),
              "-", F.col("l_suppkey")).alias("ncr_number"),
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_orderkey")).alias("po_number"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supplier_company_id"),
        _text("P-", F.col("l_partkey")).alias("part_number"),
        F.when(F.col("l_orderkey") % 7 == 0, None)
        .when(F.col("l_orderkey") % 23 == 0, _text(F.col("s_name"), " [ELSEWHERE]"))
        .otherwise(_line_vendor_name()).alias("vendor_name"),
        F.when(F.col("l_partkey") % 9 != 0, F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_partkey") % 10 != 0, (F.col("l_partkey") % 40).cast("double"))
        .alias("quantity_rejected"),
        F.when(F.col("l_linenumber") % 6 == 0, None)
        .when(F.col("l_linestatus") == "F", "Yes").otherwise(" no").alias("resolved"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("released"),
        F.col("l_shipdate").alias("created_date"),
        (F.col("l_tax") > 0.01).alias("ncr_active"),
    )


def items_raw(t: SampleTables) -> DataFrame:
    """Item master with text lead times; two sizes are listed twice under another spelling."""
    size = F.col("p_size")
    base = t.part.select(
        F.col("p_partkey").alias("item_id"),
        _text("P-", F.col("p_partkey")).alias("part_number"),
        F.col("p_name").alias("description"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("list_price"),
        F.when(size % 13 == 0, "n/a").when(size % 7 == 0, "0").when(size % 5 == 0, None)
        .otherwise(size.cast("string")).alias("lead_time"),
    )
    again = t.part.where(size.isin(48, 50)).select(
        F.col("p_partkey").alias("item_id"),
        _text(" p-", F.col("p_partkey")).alias("part_number"),
        F.col("p_name").alias("description"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("list_price"),
        (size + 5).cast("string").alias("lead_time"),
    )
    return base.unionByName(again)


def inventory(t: SampleTables) -> DataFrame:
    """Stock lots: one row per item and place."""
    return t.lineitem.where(F.col("l_linestatus") == "O").select(
        F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("place"),
        F.col("l_quantity").alias("qty_on_hand"))


def vendors_raw(t: SampleTables) -> DataFrame:
    """Vendor master: incomplete records, spelling-variant duplicates, near copies."""
    key = F.col("s_suppkey")
    name = F.concat(F.lit("Works "), F.substring(F.md5(F.col("s_name").cast("binary")), 1, 14))
    base = suppliers(t).select(
        key.alias("company_id"),
        name.alias("vendor_name"),
        F.when(key % 29 != 0, _text(key, " MAIN ST")).alias("address_line_1"),
        F.col("n_name").alias("city"),
        _text("R", F.col("n_regionkey")).alias("state_province"),
        F.when(key % 17 == 0, None).when(key % 19 == 0, "   ").otherwise(_text("Z", key))
        .alias("postal_code"),
        "s_acctbal",
    )
    twins = base.where(F.col("s_acctbal") > 8000).select(
        (F.col("company_id") + 100_000_000).alias("company_id"),
        F.concat(F.lit("  "), F.lower("vendor_name")).alias("vendor_name"),
        F.regexp_replace("address_line_1", "MAIN ST", "Main St").alias("address_line_1"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("state_province"),
        F.concat(F.lower("postal_code"), F.lit(" ")).alias("postal_code"),
    )
    near = base.where(F.col("address_line_1").isNull() | F.col("postal_code").isNull()).select(
        (F.col("company_id") + 200_000_000).alias("company_id"),
        F.concat(F.col("vendor_name"), F.lit(" Ltd")).alias("vendor_name"),
        F.lit("12 Dock Road").alias("address_line_1"),
        "city", "state_province",
        F.lit("Z0").alias("postal_code"),
    )
    return base.drop("s_acctbal").unionByName(twins).unionByName(near)


def companies(t: SampleTables) -> DataFrame:
    """One directory for suppliers and customers, as purchasing systems keep it."""
    s, k = suppliers(t), F.col("c_custkey")
    nation = F.broadcast(t.nation.select("n_nationkey", "n_name"))
    sellers = s.select(
        F.col("s_suppkey").alias("company_id"), F.col("s_name").alias("company_name"),
        F.when(F.col("s_suppkey") % 29 != 0, _text(F.col("s_suppkey"), " MAIN ST")).alias("address_line_1"),
        F.when(F.col("s_suppkey") % 11 != 0, F.col("n_name")).alias("city"),
        F.when(F.col("s_suppkey") % 17 != 0, _text("Z", F.col("s_suppkey"))).alias("postal_code"),
        (F.col("s_acctbal") > 1000).alias("active"),
        (F.col("s_acctbal") > 0).alias("supplier_record"),
        F.when(F.col("s_suppkey") % 6 != 0, F.concat(
            F.col("s_name"),
            F.when(F.col("s_suppkey") % 11 == 0, "").otherwise(_text(" [", F.col("n_name"), "]")),
            F.col("status_text"))).alias("directory_name"),
    )
    buyers = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        (k + COMPANY_OFFSET).alias("company_id"), F.col("c_name").alias("company_name"),
        F.when(k % 13 != 0, _text(k, " MARKET SQ")).alias("address_line_1"),
        F.col("n_name").alias("city"),
        F.when(k % 7 == 0, None).when(k % 23 == 0, " ").otherwise(_text("C", k)).alias("postal_code"),
        (F.col("c_acctbal") > 0).alias("active"),
        (F.col("c_mktsegment") == "MACHINERY").alias("supplier_record"),
        F.when(F.col("c_mktsegment") == "MACHINERY",
               _text(F.col("c_name"), " [", F.col("n_name"), "]")).alias("directory_name"),
    )
    return sellers.unionByName(buyers)


def display_names(t: SampleTables) -> DataFrame:
    return companies(t).where(F.col("directory_name").isNotNull()).select(
        "company_id", F.col("directory_name").alias("display_name"))


def supplier_records(t: SampleTables) -> DataFrame:
    return companies(t).where("supplier_record").select("company_id")


def projects(t: SampleTables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("project_number"),
                             F.col("c_name").alias("project_name"),
                             (F.col("c_custkey") + COMPANY_OFFSET).alias("customer_company_id"),
                             F.col("c_mktsegment").alias("project_type"))
