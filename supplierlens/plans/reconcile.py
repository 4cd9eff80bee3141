"""Comparing two sources of the same datasets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplierlens.functions.numeric import no_nan, text_to_double
from supplierlens.functions.text import strip
from supplierlens.operators.identity import VENDOR_KEY
from supplierlens.operators.scoring import score_vendors
from supplierlens.operators.vendor_summary import join_ncrs, summarize_ncrs, summarize_orders
from supplierlens.plans.reports import long_form
from supplierlens.plans.scorecard import Datasets, order_store, prepare_ncrs
from supplierlens.session import written
from supplierlens.sources import extracts, ingest
from supplierlens.sources import sampledata as sample

# Measures compared per vendor.
COMPARED = ["po_transaction_count", "delivery_eligible_count", "on_time_count", "late_count",
            "lead_time_eligible_count", "price_comparison_count", "price_stable_count"]

# Fixed value: a blank receipt in one source is a zero in the other; everything downstream agrees.
BLANK_IS_ZERO = {("purchase_orders", "received_qty")}

EVERYTHING = extracts.Scope(active_only=False, exclude_archived=False, issued_only=False)


def load_system(spark: SparkSession, folder: str, scope: extracts.Scope = EVERYTHING,
                receipt_basis: str = "log", vendor_scope: str = "active_with_address",
                tables: sample.SampleTables | None = None) -> Datasets:
    """The four datasets extracted from the purchasing system's own tables."""
    t = tables or sample.SampleTables(spark, folder)
    companies, bought = sample.companies(t), t.lineitem.select(F.col("l_suppkey").alias("company_id"))
    # Lines and NCRs meet only companies that lines name. These are written, so that Spark knows
    # how many they are and broadcasts them while they are few, in place of shuffling the lines.
    named = bought.distinct()
    sellers = written(companies.select("company_id", "company_name", "city", "supplier_record")
                      .join(named, "company_id", "left_semi"), "line-companies", "zstd")
    names = written(sample.display_names(t).join(named, "company_id", "left_semi"), "line-names", "zstd")
    projects = extracts.known_unique(sample.projects(t).select("project_number", "project_name"), "project_number")
    po = extracts.po_extract(sample.order_lines(t), sample.receipts(t), sellers, names, projects, scope,
                             receipt_basis)
    ncrs = extracts.ncr_extract(sample.ncrs_raw(t), sample.order_lines(t), sellers, names, scope)
    items = ingest.clean_items(extracts.item_extract(sample.items_raw(t), sample.inventory(t)))
    items = items.withColumn("lead_time", extracts.lead_time_or_unset(F.col("lead_time")))
    vendors = extracts.vendor_extract(companies, sample.supplier_records(t),
                                      bought, vendor_scope).withColumnRenamed("company_name", "vendor_name")
    return Datasets(ingest.clean_purchase_orders(po), ingest.clean_ncrs(ncrs), items, vendors)


def _tagged(sources: dict[str, Datasets], part: Callable[[str, Datasets], DataFrame]) -> DataFrame:
    """One part of every source, one below the other, with the name of the source."""
    out = None
    for name, data in sources.items():
        one = part(name, data).withColumn("source", F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def _summaries(sources: dict[str, Datasets], stores: dict[str, DataFrame]) -> DataFrame:
    """The vendors of every source."""
    return _tagged(sources, lambda name, data: summarize_orders(stores[name], data.items))


def _order_stores(sources: dict[str, Datasets]) -> dict[str, DataFrame]:
    return {name: order_store(data) for name, data in sources.items()}


def _per_source(*parts: DataFrame) -> DataFrame:
    """Rows of one source each, in long form."""
    out = None
    for part in parts:
        one = long_form(part, keep=("source",))
        out = one if out is None else out.unionByName(one)
    return out


def stage_totals(sources: dict[str, Datasets]) -> DataFrame:
    """18 control totals of each source, one row each."""
    stores = _order_stores(sources)
    vendors = _summaries(sources, stores)
    sums = {"PO rows (valid)": "po_transaction_count", "Delivery eligible": "delivery_eligible_count",
            "On-time": "on_time_count", "Late": "late_count", "Lead-time eligible": "lead_time_eligible_count",
            "Price comparisons": "price_comparison_count", "Price stable": "price_stable_count"}
    return _per_source(
        _tagged(sources, lambda _, d: d.items.agg(F.count(F.lit(1)).alias("Item Master rows"),
                                               F.count("lead_time").alias("Items with lead time"))),
        _tagged(sources, lambda _, d: d.vendors.agg(F.count(F.lit(1)).alias("Vendor Master rows"))),
        vendors.groupBy("source").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(m) for m, c in sums.items()],
                                      F.count(F.lit(1)).alias("Vendor+Location rows")),
        _tagged(sources, lambda name, _: stores[name].agg(
            F.count_if("commercial_base_eligible").alias("Commercial base-eligible"),
            F.count_distinct("po_number").alias("Distinct POs"))),
        _tagged(sources, lambda _, d: prepare_ncrs(d).agg(
            F.count(F.lit(1)).alias("NCR rows"),
            F.count_if("supplier_linked").alias("Supplier-linked NCRs"),
            F.count_if("quality_eligible").alias("Quality-eligible NCRs"),
            F.count_if("responsiveness_eligible").alias("Responsiveness-eligible NCRs"),
            F.count_if("resolved_flag").alias("Resolved NCRs"))))


def downstream_totals(sources: dict[str, Datasets], rules: dict) -> DataFrame:
    """Ten control totals of each source after the full pipeline."""
    orders = _summaries(sources, _order_stores(sources))
    ncrs = _tagged(sources, lambda _, d: prepare_ncrs(d))
    cards = score_vendors(join_ncrs(orders, summarize_ncrs(ncrs, ("source",)), extra_keys=("source",)), rules)
    return _per_source(
        cards.groupBy("source").agg(
            F.count(F.lit(1)).alias("vendor rows"),
            F.sum("delivery_eligible_count").alias("delivery eligible"),
            F.sum("on_time_count").alias("on-time"), F.sum("late_count").alias("late"),
            F.sum("price_comparison_count").alias("price comparisons")),
        ncrs.groupBy("source").agg(
            F.count_if("supplier_linked").alias("supplier-linked NCRs"),
            F.count_if("quality_eligible").alias("quality-eligible NCRs"),
            F.count_if("responsiveness_eligible").alias("responsiveness-eligible"),
            F.count_if("resolved_flag").alias("resolved NCRs"),
            F.count_if("unresolved_flag").alias("unresolved NCRs")))


def _of(source: str, value: str) -> Column:
    return F.max(F.when(F.col("source") == source, F.col(value)))


def totals_difference(totals: DataFrame) -> DataFrame:
    """Totals of the sources ``left`` and ``right`` side by side."""
    both = totals.groupBy("measure").agg(_of("left", "value").alias("left_value"), _of("right", "value").alias("right_value"))
    diff = F.coalesce("right_value", F.lit(0)) - F.col("left_value")
    return both.where("left_value IS NOT NULL").withColumns({"diff": diff, "differs": diff != 0})


def vendor_difference(sources: dict[str, Datasets]) -> DataFrame:
    """Full comparison of the vendors of ``left`` and ``right``; one without a city matches its like."""
    vendors = _summaries(sources, _order_stores(sources))
    both = vendors.groupBy(*VENDOR_KEY).agg(
        *[F.count_if(F.col("source") == s).alias(f"in_{s}") for s in ("left", "right")],
        *[_of(s, c).alias(f"{c}_{s}") for c in COMPARED for s in ("left", "right")])
    diffs = {
        f"{c}_diff": F.coalesce(f"{c}_right", F.lit(0)) - F.coalesce(f"{c}_left", F.lit(0))
        for c in COMPARED
    }
    total = F.lit(0)
    for d in diffs.values():
        total = total + F.abs(d)
    in_left, in_right = F.col("in_left") > 0, F.col("in_right") > 0
    return both.select(
        *VENDOR_KEY,
        F.when(in_left & in_right, "both").when(in_left, "left_only").otherwise("right_only")
        .alias("side"),
        *[F.col(f"{c}_{tag}") for c in COMPARED for tag in ("left", "right")],
        *[d.alias(n) for n, d in diffs.items()],
        total.alias("abs_diff"),
    )


def by_difference() -> list[Column]:
    return [F.col("abs_diff").desc(), *[F.col(c).asc_nulls_last() for c in VENDOR_KEY]]


def difference_summary(diff: DataFrame) -> DataFrame:
    side = F.col("side")
    return diff.agg(
        F.count_if(side == "both").alias("in_both"),
        F.count_if((side == "both") & (F.col("abs_diff") == 0)).alias("identical"),
        F.count_if(side == "left_only").alias("only_left"),
        F.count_if(side == "right_only").alias("only_right"))


def top_differences(diff: DataFrame, rows: int = 25) -> DataFrame:
    return diff.where((F.col("abs_diff") > 0) | (F.col("side") != "both")).orderBy(
        *by_difference()).limit(rows)


def canonical(df: DataFrame, name: str) -> Column:
    """A value as comparable text: numbers to nine digits, text without edge blanks."""
    kind = df.schema[name].dataType
    x = F.col(name)
    if isinstance(kind, T.BooleanType):
        return F.round(x.cast("int").cast("double"), 9).cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.round(no_nan(x.cast("double")), 9).cast("string")
    if isinstance(kind, T.NumericType):
        return F.round(x.cast("double"), 9).cast("string")
    text = x.cast("string")
    if isinstance(kind, T.StringType):
        return F.coalesce(F.round(text_to_double(text), 9).cast("string"), strip(text))
    return text


#: Ranges of the hash of the key by which two datasets are compared before any row is joined.
RANGES = 1 << 16


def _digests(side: DataFrame, key: list[str], columns: list[str], tag: str) -> DataFrame:
    """Per range: rows, and order-free digests of the keys and of each column's values."""
    nameless = F.lit(False)
    for k in key:
        nameless = nameless | F.col(k).isNull()
    # A row without a whole key meets none on the other side, so it must not look like one.
    own = F.when(nameless, F.lit(tag)).otherwise("")
    return side.groupBy("_range").agg(
        F.count(F.lit(1)).alias("_rows"), F.bit_xor(F.xxhash64(own, *key)).alias("_keys"),
        *[F.bit_xor(F.xxhash64(*key, F.lit(i), c)).alias(c) for i, c in enumerate(columns)]
    ).withColumn("_side", F.lit(tag))


def _compared_ranges(left: DataFrame, right: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Per range: whether its keys differ, which columns differ, and its rows on the left."""
    both = _digests(left, key, columns, "left").unionByName(_digests(right, key, columns, "right"))

    def differs(c: str) -> Column:
        a, b = (F.max(F.when(F.col("_side") == tag, F.col(c))) for tag in ("left", "right"))
        return ~a.eqNullSafe(b)

    found = written(both.groupBy("_range").agg(
        (differs("_rows") | differs("_keys")).alias("_keys_differ"),
        F.array(*[differs(c) for c in columns]).alias("_differ"),
        F.max(F.when(F.col("_side") == "left", F.col("_rows"))).alias("_rows")), "range-digests")
    # A key held twice meets itself crosswise in the join, which equal digests do not show. If
    # only the right side holds one twice, the numbers of rows differ already. Keys are counted
    # only in ranges of which something would count as equal.
    some_equal = found.where(~F.col("_keys_differ") | F.array_contains("_differ", False)).select("_range")
    twice = left.join(F.broadcast(some_equal), "_range", "left_semi").groupBy(
        "_range", F.xxhash64(*key).alias("_key")).count().where("count > 1").select(
        "_range", F.lit(True).alias("_twice")).distinct()
    twice_here = F.col("_twice").isNotNull()
    return found.join(twice, "_range", "left").select(
        "_range", (F.col("_keys_differ") | twice_here).alias("_keys_differ"),
        F.transform("_differ", lambda d: d | twice_here).alias("_differ"), "_rows")


def _mark(df: DataFrame, columns: list[str]) -> Column:
    """One digest of the canonical values of a row; each counts with its place, so that a null
    is not its neighbour's."""
    return F.xxhash64(F.lit(-1), *[x for i, c in enumerate(columns) for x in (F.lit(i), canonical(df, c))])


def _met(left: DataFrame, right: DataFrame, key: list[str], ranges: DataFrame) -> DataFrame:
    """Rows of some ranges joined by the key, each side with one digest for all columns."""
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.join(F.broadcast(ranges), "_range", "left_semi").select(*key, F.col("_row").alias(f"_{tag}"))

    return side(left, "left").join(side(right, "right"), key, "full_outer")


def _disagreements(pairs: DataFrame, columns: list[str], dataset: str) -> DataFrame:
    """Per column, pairs that differ and, of these, pairs that a known rule explains."""
    def differs(c: str) -> Column:
        return ~F.col(f"{c}_left").eqNullSafe(F.col(f"{c}_right"))

    def explained(c: str) -> Column:
        if (dataset, c) not in BLANK_IS_ZERO:
            return F.lit(False)
        a, b = (F.coalesce(F.col(f"{c}_{tag}").try_cast("double"), F.lit(0.0)) for tag in ("left", "right"))
        return (a == 0) & (b == 0)

    return pairs.agg(*[F.count_if(differs(c)).alias(f"{c}_all") for c in columns],
                     *[F.count_if(differs(c) & explained(c)).alias(f"{c}_known") for c in columns])


def dataset_parity(dataset: str, left: DataFrame, right: DataFrame, key: list[str],
                   columns: list[str], ranges: int = RANGES, apart: tuple[str, ...] = ()) -> DataFrame:
    """Per column, how many rows of the two datasets disagree; the key should be unique, and
    rows of one that is not are compared crosswise.

    Rows carry one digest of all their values. Both sides are first summed up to one digest per
    range of keys; all rows of a range that agrees count as compared and equal. Rows of the other
    ranges meet by key, still with their digest only, so that a row which one side lacks does not
    set the values of its whole range moving. Values are joined only for keys whose digests
    differ. There are at most ``ranges`` ranges, so their list is broadcast.

    Columns ``apart`` are expected to differ in many rows. They meet by key in a join of their
    own, each with its own digest, or with its value where a rule may explain a difference. A
    side that makes them by other joins than the rest runs each part with only its own joins.

    A difference is documented where a known rule explains that row: blank against zero.
    """
    sides = {"left": left, "right": right}
    together, alone = [c for c in columns if c not in apart], [c for c in columns if c in apart]
    rows = {tag: df.select(F.pmod(F.xxhash64(*key), F.lit(ranges)).alias("_range"), *key,
                           _mark(df, together).alias("_row")) for tag, df in sides.items()}
    compared = written(_compared_ranges(rows["left"], rows["right"], key, ["_row"]), "compared-ranges")
    is_open = F.col("_keys_differ") | F.array_contains("_differ", True)

    a, b = F.col("_left"), F.col("_right")
    kind = F.when(b.isNull(), "only_left").when(a.isNull(), "only_right").when(a == b, "alike").otherwise("unlike")
    # Only keys whose digests differ are held by name, once each; all else is four numbers.
    met = written(
        _met(rows["left"], rows["right"], key, compared.where(is_open).select("_range"))
        .groupBy(kind.alias("_kind"), *[F.when(kind == "unlike", F.col(k)).alias(k) for k in key])
        .agg(F.count(F.lit(1)).alias("_pairs")), "met-rows")

    # A handful of numbers; as literals they keep the plan of the result small.
    tally = met.select("_kind", "_pairs").unionByName(
        compared.where(~is_open).select(F.lit("closed").alias("_kind"), F.col("_rows").alias("_pairs")))
    rows_of = {r["_kind"]: r["_pairs"] for r in tally.groupBy("_kind").agg(F.sum("_pairs").alias("_pairs")).collect()}

    def count(*kinds: str) -> Column:
        return F.lit(sum(rows_of.get(k, 0) for k in kinds)).cast("long")

    def values(of: Callable[[DataFrame, str], Column], names: list[str], only: DataFrame | None) -> DataFrame:
        """Pairs of rows with ``of`` each side's columns."""
        one, two = (
            (df if only is None else df.join(only, key, "left_semi"))
            .select(*key, *[of(df, c).alias(f"{c}_{tag}") for c in names]) for tag, df in sides.items())
        return _disagreements(one.join(two, key), names, dataset)

    def own_mark(df: DataFrame, c: str) -> Column:
        return canonical(df, c) if (dataset, c) in BLANK_IS_ZERO else _mark(df, [c])

    known: list[DataFrame] = []
    if "unlike" in rows_of:
        known.append(values(canonical, together, met.where("_kind = 'unlike'").select(*key)))
    if alone:
        known.append(values(own_mark, alone, None))
    counts = known[0] if known else left.sparkSession.range(1)
    for more in known[1:]:
        counts = counts.join(F.broadcast(more))

    def pairs(name: str) -> Column:
        return F.col(name) if name in counts.columns else count()

    found = [
        F.struct(F.lit(dataset).alias("dataset"), F.lit(c).alias("column_name"),
                 F.lit(left.schema[c].dataType == right.schema[c].dataType).alias("same_type"),
                 pairs(f"{c}_known").alias("documented"),
                 (pairs(f"{c}_all") - pairs(f"{c}_known")).alias("undocumented"))
        for c in columns
    ]
    return counts.select(
        count("alike", "unlike", "closed").alias("compared"), count("only_left").alias("only_left"),
        count("only_right").alias("only_right"), F.inline(F.array(*found)))
