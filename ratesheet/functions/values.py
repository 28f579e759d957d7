"""Value functions: product codes, dates, prices, object names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from ratesheet import fixed_values as fv
from ratesheet.functions.text import DIGIT, strip

_NUMBER_TEXT = r"(?i)^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf|infinity|nan)$"

_ISO_DAY = r"^((?!0000)\d{4}-(?:\d{1,2}-\d{1,2}$|\d{2}-\d{2}))"


def has_ndc(c: Column) -> Column:
    return c.rlike(DIGIT)


def keep_digits(c: Column) -> Column:
    return F.regexp_replace(c, rf"[^{DIGIT}]+", "")


def ndc_digits(c: Column) -> Column:
    """Digits only, as text; null when there are none."""
    return F.when(has_ndc(c), keep_digits(c))


def ndc_number(c: Column) -> Column:
    return ndc_digits(c).try_cast("bigint")


def ndc_range_bucket(ndc: Column, width: int = 1_000_000) -> Column:
    """Number of the range of ``width`` codes; whole-number division keeps long codes exact."""
    number = ndc.try_cast("bigint")
    return F.call_function("div", number, F.lit(width).cast("bigint"))


def parse_date(c: Column) -> Column:
    """Date in one of the accepted text forms, else null; impossible dates are null.

    Month-first and slash forms are rewritten to ISO, then the ISO day is cut out: a whole
    text of that form, or the first ten characters of a longer one. Each step reads the
    text once, and nothing fails by exception on the way. A text of ten bytes with hyphens in their
    places and a digit at its end can only be an ISO day or none, and skips the steps. Days that a
    64-bit count of nanoseconds can't hold are no dates, as in the source's conversion.
    """
    hyphens = (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-")
    in_form = (F.octet_length(c) == 10) & hyphens & F.substring(c, 10, 1).between("0", "9")
    plain = strip(c)
    slashed = F.regexp_replace(plain, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2")
    slashed = F.regexp_replace(slashed, r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "$1-$2-$3")
    iso = F.when(F.contains(c, F.lit("/")), slashed).otherwise(plain)
    day = F.when(in_form, c).otherwise(F.regexp_extract(iso, _ISO_DAY, 1)).try_cast("date")
    return F.when(day.between(*map(F.lit, fv.DATE_RANGE)), day)


def price_number(c: Column) -> Column:
    """Keep digits and dots, then a hard cast: an unusable price text is an error."""
    return F.regexp_replace(c, r"[^0-9.]", "").cast("double")


def price_safe(c: Column) -> Column:
    """Drop currency signs and separators; null when the rest is not a number."""
    s = strip(F.regexp_replace(c, r"[$,]", ""))
    return F.when(s.rlike(_NUMBER_TEXT), s.try_cast("double"))


def quarter_label(c: Column) -> Column:
    """``2024Q1`` for a date; sorts as text in time order."""
    return F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string"))


def quarter_text(day: dt.date) -> str:
    return f"{day.year}Q{(day.month + 2) // 3}"


def archive_path(
    c: Column, raw: str = fv.RAW_PREFIX, processed: str = fv.PROCESSED_PREFIX
) -> Column:
    """Name of a handled object: raw prefix swapped for the processed one."""
    return F.when(c.startswith(raw), F.replace(c, F.lit(raw), F.lit(processed)))


def page_file_name(page: Column, extracted_at: Column) -> Column:
    return F.format_string(
        fv.PAGE_FILE_FORMAT, page, F.date_format(extracted_at, fv.PAGE_FILE_TIME)
    )
