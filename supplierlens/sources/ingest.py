"""Loading and cleaning of the four datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplierlens.functions.dates import text_to_timestamp
from supplierlens.functions.numeric import no_nan, text_to_double, to_double
from supplierlens.functions.text import strip
from supplierlens.sources import contracts

# Words accepted as a truth value.
TRUE_WORDS = ("1", "true", "yes", "y", "t")
FALSE_WORDS = ("0", "false", "no", "n", "f")


def read_dataset(spark: SparkSession, path: str, dataset: str, fmt: str = "csv",
                 multi_line: bool = False) -> DataFrame:
    """Read one dataset by its source headers and return it under internal names.

    Columns of a CSV file arrive as text and are coerced later; nothing is inferred. A row
    with more or fewer fields than the header fails the job. Set ``multi_line`` where quoted
    text may hold line breaks; such a file is then read by one task, so deliver it in parts.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = (reader.option("header", True).option("mode", "FAILFAST")
                  .option("multiLine", multi_line).option("escape", '"'))
    return contracts.to_internal_names(reader.load(path), dataset)


def coerce_numeric(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: to_double(df, c) for c in columns if c in df.columns})


def coerce_timestamps(df: DataFrame, columns: tuple[str, ...],
                      formats: tuple[str, ...] = ()) -> DataFrame:
    def one(c: str) -> Column:
        kind = df.schema[c].dataType
        if isinstance(kind, T.StringType):
            return text_to_timestamp(F.col(c), formats)
        return F.col(c).cast("timestamp_ntz")

    return df.withColumns({c: one(c) for c in columns if c in df.columns})


def truth(x: Column) -> Column:
    """Text or number to a boolean; anything unknown (or missing) is NULL."""
    text = x.cast("string")
    number = text_to_double(text)
    word = F.lower(strip(text))
    return (
        F.when(number == 1, True).when(number == 0, False)
        .when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    )


#: Values that an error message names at most.
NAMED = 8


def unknown_truth_values(x: Column, buckets: int = 64) -> Column:
    """Aggregate: up to NAMED distinct values that ``coerce_truth`` would not take, ascending.

    Each of ``buckets`` hash buckets keeps its smallest such value, so the state is bounded
    however many bad values there are. Of a few bad values two may share a bucket, and the
    larger is then not named; a single one always is.
    """
    text = x.cast("string")
    bad = F.when(truth(x).isNull() & x.isNotNull(), text)
    bucket = F.pmod(F.xxhash64(text), F.lit(buckets))
    kept = F.array(*[F.min(F.when(bucket == i, bad)) for i in range(buckets)])
    return F.slice(F.sort_array(F.array_compact(kept)), 1, NAMED)


def refuse(column: str, bad: list[str]) -> None:
    if bad:
        raise contracts.ContractError(f"{column}: not a truth value: {bad}")


def check_truth(df: DataFrame, columns: tuple[str, ...]) -> None:
    """Fail a load with up to eight of the values that are neither true nor false."""
    texts = [c for c in columns if c in df.columns and not isinstance(df.schema[c].dataType, T.BooleanType)]
    if texts:
        found = df.agg(*[unknown_truth_values(F.col(c)).alias(c) for c in texts]).first()
        for c in texts:
            refuse(c, found[c])


class TruthWatch:
    """Truth values as they are read: ``df`` has null for a value that is none, and after an
    action on it ``check`` fails with up to eight of those values. No pass is added."""

    def __init__(self, df: DataFrame, columns: tuple[str, ...]) -> None:
        self._columns = [c for c in columns if c in df.columns and not isinstance(df.schema[c].dataType, T.BooleanType)]
        self._seen = Observation()
        if self._columns:
            df = df.observe(self._seen, *[unknown_truth_values(F.col(c)).alias(c) for c in self._columns])
        self.df = df.withColumns({c: truth(F.col(c)) for c in self._columns})

    def check(self) -> None:
        for c in self._columns:
            refuse(c, self._seen.get[c])


def coerce_truth(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Nullable booleans; a value that is neither true nor false fails the job by name.

    The check runs inside the plan, so it costs no extra pass over the data.
    """
    def one(c: str) -> Column:
        if isinstance(df.schema[c].dataType, T.BooleanType):
            return F.col(c)
        known = truth(F.col(c))
        return (
            F.when(known.isNotNull() | F.col(c).isNull(), known)
            .otherwise(
                F.raise_error(
                    F.concat(F.lit(f"Column '{c}' holds a value that is neither true nor false: "),
                             F.col(c).cast("string"))
                ).cast("boolean")
            )
        )

    return df.withColumns({c: one(c) for c in columns if c in df.columns})


def is_header_row() -> Column:
    """A report spacer: part, vendor, quantity and order date are all missing."""
    missing = F.lit(True)
    for c in contracts.HEADER_ROW_COLUMNS:
        missing = missing & F.col(c).isNull()
    return missing


def is_incomplete_line() -> Column:
    missing = F.lit(False)
    for c in contracts.PO_REQUIRED:
        missing = missing | F.col(c).isNull()
    return missing


def without_nan(df: DataFrame) -> DataFrame:
    """NaN in a floating column is a missing value, before anything looks at it."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: no_nan(F.col(c)) for c in floats})


def strip_header_rows(po: DataFrame) -> DataFrame:
    return without_nan(po).where(~is_header_row())


def with_row_status(po: DataFrame) -> DataFrame:
    return po.withColumn("row_status", F.when(is_incomplete_line(), "REJECTED").otherwise("VALID"))


def valid_lines(po: DataFrame) -> DataFrame:
    return po.where(~is_incomplete_line())


def rejected_lines(po: DataFrame) -> DataFrame:
    """Raw lines, spacers aside, that lack a required value."""
    return strip_header_rows(po).where(is_incomplete_line())


def fill_receipts(po: DataFrame) -> DataFrame:
    """No recorded receipt means nothing was received."""
    return po.withColumn("received_qty", F.coalesce("received_qty", F.lit(0.0)))


def clean_purchase_orders(po: DataFrame, fill: bool = True) -> DataFrame:
    """Raw PO lines to valid, typed lines. The split looks at raw values on purpose."""
    po = valid_lines(strip_header_rows(po))
    po = coerce_numeric(po, contracts.PO_NUMERIC + ("currency_rate",))
    po = coerce_timestamps(po, contracts.PO_TIMESTAMPS + ("receiving_date",))
    po = fill_receipts(po) if fill else po
    return contracts.check_po_types(po)


def clean_ncrs(ncrs: DataFrame) -> DataFrame:
    ncrs = coerce_numeric(ncrs, contracts.NCR_NUMERIC)
    ncrs = coerce_timestamps(ncrs, contracts.NCR_TIMESTAMPS)
    return coerce_truth(ncrs, ("resolved",))


def clean_items(items: DataFrame) -> DataFrame:
    return coerce_numeric(items, contracts.ITEM_NUMERIC)
