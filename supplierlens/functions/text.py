"""Text rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The blanks and patterns that define a vendor's identity. Blanks are those of
# Unicode and the separators \x1c-\x1f, which Python also counts as blanks. They are listed one
# by one: trimming by a list of characters costs a tenth of a pattern at both ends.
BLANKS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
          "\u200a\u2028\u2029\u202f\u205f\u3000")
NAME_TAIL = rf"\[[^\]]+\][{BLANKS}]*(?:\(APPROVED\))?[{BLANKS}]*$"
BRACKET = r"\[([^\]]+)\]"

UNKNOWN_VENDOR = "UNKNOWN VENDOR"
NO_LOCATION = "NO LOCATION"


def strip(x: Column) -> Column:
    """Remove all Unicode blanks at both ends (Spark's trim only drops spaces)."""
    return F.btrim(x, F.lit(BLANKS))


def upper_key(x: Column) -> Column:
    return F.upper(strip(x.cast("string")))


def is_blank(x: Column) -> Column:
    """True for NULL and for text made of blanks only; never NULL."""
    return x.isNull() | (strip(x.cast("string")) == "")


def match_name(name: Column) -> Column:
    return strip(F.regexp_replace(F.upper(strip(name)), NAME_TAIL, ""))


def match_city(name: Column) -> Column:
    # regexp_extract gives '' for "no match", so the match itself is tested first:
    # "[ ]" is a real, empty city while a name without brackets has none.
    return F.when(name.rlike(BRACKET), F.upper(strip(F.regexp_extract(name, BRACKET, 1))))


def vendor_label(name: Column, city: Column) -> Column:
    return F.concat(
        F.coalesce(name, F.lit(UNKNOWN_VENDOR)),
        F.lit(" | "),
        F.coalesce(city, F.lit(NO_LOCATION)),
    )


def display_name(looked_up: Column, name: Column, city: Column) -> Column:
    """The directory's display name, else ``name [city]``, else the bare name."""
    located = F.when(
        F.coalesce(strip(city) != "", F.lit(False)), F.concat(F.lit(" ["), city, F.lit("]"))
    ).otherwise("")
    return F.coalesce(looked_up, F.concat(name, located))


def status_suffix(name: Column) -> Column:
    """Text from the first ' (' onwards, whole."""
    at = F.instr(name, " (")
    return F.when(at > 0, F.substring(name, at, F.length(name))).otherwise("(none)")
