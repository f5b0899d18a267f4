"""Column expressions for cleaning single values. All of them stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

# Fixed value: what counts as white space at either end of a text. (?U) covers the Unicode spaces,
# U+3000 among them; the four separators U+001C to U+001F are listed because \s leaves them out.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def stripped(text: Column) -> Column:
    """Text without white space at its ends; nothing left counts as missing."""
    return blank_to_null(F.regexp_replace(text.cast("string"), _EDGE_SPACE, ""))


def to_instant(text: Column) -> Column:
    """ISO text to an instant; no offset means UTC, unreadable text means null."""
    return F.try_to_timestamp(blank_to_null(text))


def day_of(instant: Column, offset_seconds: int = 0) -> Column:
    """Calendar day of an instant at a fixed offset from UTC: whole days since 1970.

    Plain arithmetic is right under any session time zone and several times faster than converting
    between time zones row by row.
    """
    seconds = F.unix_seconds(instant) + F.lit(offset_seconds)
    return F.date_from_unix_date(F.floor(seconds / F.lit(86_400)).cast("int"))


def to_utc_date(text: Column) -> Column:
    """The UTC calendar day of an ISO text."""
    return day_of(to_instant(text))


def to_float(text: Column) -> Column:
    """Number or null; text that is no number raises."""
    return blank_to_null(text).cast("double")


def to_whole(text: Column) -> Column:
    """Whole number or null, fractions cut off; text that is no number raises."""
    return blank_to_null(text).cast("decimal(38,6)").cast("bigint")


def to_flag(text: Column) -> Column:
    """True or false, from the two words or from a number that is or is not zero."""
    return F.when(text.isin("true", "false"), text == "true").otherwise(F.when(~text.isin("true", "false"), to_whole(text)) != 0)


def money(amount: Column) -> Column:
    """Exact two-decimal amount, so that sums do not depend on the order of the rows."""
    return amount.cast(MONEY)


def line_total(price: Column, units: Column) -> Column:
    """price x units, rounded half up to two decimals; null when either is null."""
    exact = blank_to_null(price).cast("decimal(20,4)") * to_whole(units).cast("decimal(12,0)")
    return F.round(exact, 2).cast("double")


def joined_zip(first: Column, second: Column) -> Column:
    return F.when((first != "") & (second != ""), F.concat_ws("-", first, second))
