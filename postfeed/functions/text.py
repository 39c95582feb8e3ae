"""Text cleaning, shortening and feed dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postfeed.functions.keys import _col

# Control characters the feed must not hold; tab, LF and CR stay.
CONTROL_CHARS = r"[\x00-\x08\x0B-\x0C\x0E-\x1F\x7F]"
CDATA_END = "]]>"
CDATA_END_ESCAPED = "]]]]><![CDATA[>"

# Display texts of the preview and the reports.
EMPTY_TEXT = "(vuoto)"
CUT_TEXT = "... [troncato]"
NOT_AVAILABLE = "N/A"

# What counts as white space around a text, Unicode spaces and separators included.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def clean_utf8(value: Column | str) -> Column:
    """Text with invalid byte sequences replaced by U+FFFD; takes text or binary, NULL gives ''."""
    return F.coalesce(F.make_valid_utf8(_col(value).cast("string")), F.lit(""))


def strip_control(value: Column | str) -> Column:
    return F.regexp_replace(_col(value), CONTROL_CHARS, "")


def escape_cdata(value: Column | str) -> Column:
    """Text safe inside a CDATA section. Control characters go first: removing one can form ``]]>``."""
    return F.replace(strip_control(clean_utf8(value)), F.lit(CDATA_END), F.lit(CDATA_END_ESCAPED))


def strip(value: Column | str) -> Column:
    return F.btrim(_col(value), F.lit(SPACES))


def ellipsis(value: Column | str, longest: int) -> Column:
    """Texts over ``longest`` characters keep all but two of them and end in '..'; blank gives N/A."""
    text = F.nullif(_col(value), F.lit(""))
    cut = F.concat(F.substring(text, 1, longest - 2), F.lit(".."))
    return F.when(F.length(text) > longest, cut).otherwise(F.coalesce(text, F.lit(NOT_AVAILABLE)))


def truncate_text(value: Column | str, longest: int = 500) -> Column:
    text = F.nullif(_col(value), F.lit(""))
    cut = F.concat(F.substring(text, 1, longest), F.lit(CUT_TEXT))
    return F.when(F.length(text) > longest, cut).otherwise(F.coalesce(text, F.lit(EMPTY_TEXT)))


def or_not_available(value: Column | str) -> Column:
    return F.coalesce(F.nullif(_col(value), F.lit("")), F.lit(NOT_AVAILABLE))


def rfc_date(value: Column | str, offset: str = "-0000") -> Column:
    """``Mon, 08 Jan 2024 11:34:23 -0000``. Built from fields, so the session zone plays no part."""
    ts = _col(value)
    clock = [F.lpad(part(ts).cast("string"), 2, "0") for part in (F.hour, F.minute, F.second)]
    day = F.date_format(ts.cast("date"), "EEE, dd MMM yyyy")
    return F.concat(day, F.lit(" "), F.concat(clock[0], F.lit(":"), clock[1], F.lit(":"), clock[2]), F.lit(f" {offset}"))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent to one decimal, the one nearest to the binary value; 0 where there is nothing to do."""
    rounded = F.replace(F.format_number(part / whole * 100, 1), F.lit(","), F.lit("")).cast("double")
    return F.when(whole > 0, rounded).otherwise(F.lit(0.0))
