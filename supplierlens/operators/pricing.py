"""Price history: each line against the previous purchase of the same thing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplierlens.functions.numeric import flag, to_double
from supplierlens.functions.text import upper_key
from supplierlens.session import written

PRICE_GROUP = ["vendor_match_name", "vendor_match_city", "commercial_part_key",
               "commercial_currency_key", "commercial_uom_key"]
PRICE_ORDER = ["order_date", "po_number", "line_no", "unit_price"]  # line_no where the source has it


def with_price_keys(po: DataFrame) -> DataFrame:
    po = po.withColumns({
        "unit_price": to_double(po, "unit_price"),
        "commercial_part_key": upper_key(F.col("part_number")),
        "commercial_currency_key": upper_key(F.col("currency_code")),
        "commercial_uom_key": upper_key(F.col("uom")),
    })
    return po.withColumn(
        "commercial_base_eligible",
        flag(F.col("vendor_match_name").isNotNull() & F.col("commercial_part_key").isNotNull()
             & F.col("commercial_currency_key").isNotNull()
             & F.col("commercial_uom_key").isNotNull() & F.col("order_date").isNotNull()
             & (F.col("unit_price") > 0)),
    )


#: Rows of one group that a window sorts in one task; larger groups are cut into parts.
PART_ROWS = 1_000_000
#: Sampled rows per part, from which the cuts of large groups are taken.
SAMPLED = 20


def _order_columns(po: DataFrame) -> list[Column]:
    """Undated rows last, then the order columns that ``po`` has; nulls come first in these."""
    return [F.col("order_date").isNull(), *[F.col(c).asc() for c in PRICE_ORDER if c in po.columns]]


def _order_struct(po: DataFrame) -> Column:
    """The same order as one comparable value."""
    return F.struct(F.col("order_date").isNull().alias("undated"),
                    *[F.col(c) for c in PRICE_ORDER if c in po.columns])


def _cuts(store: DataFrame, keys: list[str], part_rows: int) -> DataFrame:
    """Per large group the ascending orders at which it is cut: group hash, cuts.

    A group has a cut for every SAMPLED of its sampled rows, that is about every ``part_rows``
    of its rows, so there are fewer cuts than rows divided by ``part_rows``, whatever the
    groups. Groups of a few sampled rows have none and are not listed.
    """
    sampled = store.select(F.xxhash64(*keys).alias("_group"), _order_struct(store).alias("_at")).sample(
        min(1.0, SAMPLED / part_rows), seed=11)
    ranked = sampled.withColumn("_nr", F.row_number().over(Window.partitionBy("_group").orderBy("_at")))
    return ranked.where(F.col("_nr") % SAMPLED == 0).groupBy("_group").agg(F.sort_array(F.collect_set("_at")).alias("_cuts"))


def _part(cuts: Column, at: Column) -> Column:
    """Number of ``cuts`` at or before ``at``, by binary search; 0 without cuts."""
    halvings = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cuts) + 1)).cast("int"))
    found = F.aggregate(
        halvings, F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high")),
        lambda s, _: F.when(s["low"] >= s["high"], s).otherwise(
            F.when(F.get(cuts, F.floor((s["low"] + s["high"]) / 2).cast("int")) <= at,
                   F.struct((F.floor((s["low"] + s["high"]) / 2) + 1).cast("int").alias("low"), s["high"].alias("high")))
            .otherwise(F.struct(s["low"].alias("low"), F.floor((s["low"] + s["high"]) / 2).cast("int").alias("high")))),
        lambda s: s["low"])
    return F.when(cuts.isNull(), 0).otherwise(found)


def with_parts(store: DataFrame, extra_keys: Sequence[str] = (), part_rows: int = PART_ROWS,
               group: Sequence[str] = PRICE_GROUP) -> tuple[DataFrame, DataFrame]:
    """``store`` with the ``_part`` of its group that a row is in, and the prices carried on
    from the ends of parts.

    A group of over ``part_rows`` rows is cut into consecutive parts at orders taken from a
    sample (``_cuts``). There are at most as many cuts, and ends of parts, as rows divided by
    ``part_rows``; that bound, not a size seen, is why both may be broadcast. ``group`` names
    columns that tell the same groups apart as PRICE_GROUP does.
    """
    keys = [*group, *extra_keys]
    cuts = F.broadcast(written(_cuts(store, keys, part_rows), "price-cuts"))
    at, price = _order_struct(store), F.col("unit_price")
    grouped = store.withColumn("_group", F.xxhash64(*keys))
    parted = grouped.join(cuts, "_group", "left").withColumn("_part", _part(F.col("_cuts"), at)).drop("_cuts", "_group")

    large = grouped.join(cuts, "_group").withColumn("_part", _part(F.col("_cuts"), at))
    ends = large.groupBy("_group", *keys, "_part").agg(F.max_by(price, at).alias("_end"))
    before = Window.partitionBy("_group", *keys).orderBy("_part")
    carried = ends.select(F.col("_group").alias("_of"), F.col("_part").alias("_at"), *[F.col(c).alias(f"_{c}") for c in keys],
                          F.lag("_end", 1).over(before).alias("_carried")).where("_carried IS NOT NULL")
    return parted, carried


def previous_prices(parted: DataFrame, carried: DataFrame, extra_keys: Sequence[str] = (),
                    within: Sequence[str] = (), group: Sequence[str] = PRICE_GROUP) -> DataFrame:
    """``previous_unit_price`` from what ``with_parts`` gives, to which columns may have been
    added: the window runs per part, whose first row takes the price from the part before.

    Columns ``within`` have one value per part. Where rows are spread by these already, say by
    a join, the window needs no shuffle.
    """
    keys, price = [*group, *extra_keys], F.col("unit_price")
    w = Window.partitionBy(*dict.fromkeys([*within, *keys, "_part"])).orderBy(*_order_columns(parted))
    lagged = parted.withColumns({"_lag": F.lag(price, 1).over(w), "_nr": F.row_number().over(w)})
    first = (F.when(F.col("_nr") == 1, F.col("_part")) == F.col("_at")) & (F.xxhash64(*keys) == F.col("_of"))
    for c in keys:  # hashes may be shared, keys may be null
        first = first & F.col(c).eqNullSafe(F.col(f"_{c}"))
    out = lagged.join(F.broadcast(carried), first, "left")
    previous = F.when(F.col("_nr") > 1, F.col("_lag")).otherwise(F.col("_carried"))
    return out.select(*[c for c in parted.columns if c != "_part"], previous.alias("previous_unit_price"))


def with_previous_price(store: DataFrame, extra_keys: tuple[str, ...] = (), part_rows: int = PART_ROWS) -> DataFrame:
    """``previous_unit_price``: price of the row before in its group, NULL price included.

    ``store`` should be a written table of no more columns than are wanted: it is read up to
    three times, but shuffled only once, for the window. ``extra_keys`` part the groups
    further (two sources in one pass, say).
    """
    return previous_prices(*with_parts(store, extra_keys, part_rows), extra_keys)


def price_columns(po: DataFrame, more: Sequence[str] = ()) -> list[str]:
    """The columns that the price history reads, and ``more``, where ``po`` has them."""
    wanted = dict.fromkeys([*PRICE_GROUP, *PRICE_ORDER, "commercial_base_eligible", *more])
    return [c for c in wanted if c in po.columns]


def price_store(po: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Lines with price keys, the order and ``carried`` columns alone, written once: the plan
    that makes the lines runs for this write and not again."""
    po = with_price_keys(po)
    return written(po.select(*price_columns(po, carried)), "price-store", "zstd")


def with_price_history(store: DataFrame, extra_keys: tuple[str, ...] = (), part_rows: int = PART_ROWS) -> DataFrame:
    """Price measures onto the rows of a store."""
    return price_measures(with_previous_price(store, extra_keys, part_rows))


def price_measures(po: DataFrame) -> DataFrame:
    price, before = F.col("unit_price"), F.col("previous_unit_price")
    po = po.withColumn("price_comparison_eligible", flag(F.col("commercial_base_eligible") & (before > 0)))
    eligible = F.col("price_comparison_eligible")
    return po.withColumns({
        "price_change_pct": F.when(eligible, (price - before) / before * 100),
        "price_stable": flag(eligible & (price <= before)),
        "price_increased": flag(eligible & (price > before)),
    })


def price_totals(po: DataFrame) -> DataFrame:
    return po.agg(
        F.count(F.lit(1)).alias("po_rows"),
        F.count_if("commercial_base_eligible").alias("commercial_base_eligible"),
        F.count_if("price_comparison_eligible").alias("price_comparisons"),
        F.count_if("price_stable").alias("price_stable"),
        F.count_if("price_increased").alias("price_increased"),
        F.count_if(F.col("price_stable") | F.col("price_increased")).alias("represented"),
    )
