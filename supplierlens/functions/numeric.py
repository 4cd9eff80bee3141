"""Number and flag rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplierlens.functions.text import upper_key

# Fixed value: text that counts as a number. Without the guard a cast would also
# accept '12d' and 'nan'.
NUMBER_TEXT = (
    r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"
)


def flag(predicate: Column) -> Column:
    """Two-valued predicate: an unknown comparison counts as False."""
    return F.coalesce(predicate, F.lit(False))


def no_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def text_to_double(x: Column) -> Column:
    return F.when(x.rlike(NUMBER_TEXT), F.trim(x).try_cast("double"))


def to_double(df: DataFrame, name: str) -> Column:
    """The column as a double with unusable values as NULL, whatever its type."""
    kind = df.schema[name].dataType
    x = F.col(name)
    if isinstance(kind, T.StringType):
        return text_to_double(x)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return no_nan(x.cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return x.cast("double")
    return F.lit(None).cast("double")


def pct(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100)


def clamp_score(x: Column) -> Column:
    # greatest/least skip NULLs, so the guard keeps a missing score missing.
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), x)))


def lead_time_days(df: DataFrame, name: str = "lead_time") -> Column:
    return to_double(df, name)


def part_key(df: DataFrame, name: str = "part_number") -> Column:
    """Join key of a part: whole numbers lose their '.0', blanks become NULL."""
    kind = df.schema[name].dataType
    x = F.col(name)
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        number = x.cast("double")
        return F.when(
            ~F.isnan(number),
            F.when(number == F.floor(number), number.cast("long").cast("string")).otherwise(
                F.upper(x.cast("string"))
            ),
        )
    key = upper_key(x)
    return F.when(key != "", key)


def rounded(df: DataFrame, stored: frozenset[str], digits: int = 6) -> DataFrame:
    """Round derived doubles, so that results compare across engines and plan shapes.

    Averages, percentages and scores depend on the order of additions in their last digits;
    ``stored`` values do not and stay as they are.
    """
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) and f.name not in stored else F.col(f.name)
        for f in df.schema.fields])
