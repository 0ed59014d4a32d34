"""Column expressions: safe casts, date and region cleaning, ratios, exact means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendlake.schemas import RATIO_DIGITS

# A short date is year.day.month, with years 2000 to 2099.
SHORT_DATE = r"^\d{2}\.\d{2}\.\d{2}$"
SHORT_DATE_PLACES = (1, 4, 7)
SHORT_DATE_CENTURY = "20"

# Below the limit, a double's error is much smaller than the margin.
QUICK_ROUND_LIMIT = 1e9
QUICK_ROUND_MARGIN = 1e-6


def to_long(col: Column) -> Column:
    """Text to a whole number: '12' -> 12, '12.7' -> 12, anything else NULL."""
    whole = F.regexp_replace(col, r"\.\d*\s*$", "")
    return F.coalesce(col.try_cast("bigint"), whole.try_cast("bigint"))


def convert(col: Column, from_type: str, to_type: str) -> Column:
    """Convert to a canonical type; values that don't fit become NULL, never an error."""
    if from_type == to_type:
        return col
    if to_type == "string":
        if from_type.startswith("array<"):
            return F.array_join(col, "|")
        return col.cast("string")
    if to_type == "bigint" and from_type == "string":
        return to_long(col)
    return col.try_cast(to_type)


def trending_day(col: Column) -> Column:
    """Both date spellings to a date. Turning the short one into the long one keeps it to one
    cast; the length check spares the pattern for the long one."""
    short = (F.length(col) == 8) & col.rlike(SHORT_DATE)
    year, day, month = (F.substring(col, start, 2) for start in SHORT_DATE_PLACES)
    long = F.concat(F.lit(SHORT_DATE_CENTURY), year, F.lit("-"), month, F.lit("-"), day)
    return F.when(short, long).otherwise(col).try_cast("date")


def clean_region(col: Column) -> Column:
    return F.lower(F.trim(col))


def round_half_up(value: Column, digits: int) -> Column:
    """As Spark's own rounding, but without its decimal arithmetic for values that aren't
    close to a tie, which makes it several times as fast. Others go the exact way."""
    scaled = value * 10**digits
    nearest = F.rint(scaled)
    plain = scaled.between(0, QUICK_ROUND_LIMIT) & (
        F.abs(scaled - nearest) < 0.5 - QUICK_ROUND_MARGIN
    )
    return F.when(plain, nearest / 10**digits).otherwise(F.round(value, digits))


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, NULL for a whole of 0."""
    return F.try_divide(part, whole) * 100


def settled(pct: Column, whole: Column) -> Column:
    """A percentage rounded to RATIO_DIGITS; 0 where ``whole`` isn't positive.

    ``pct`` should be a column, not an expression: rounding mentions it several times.
    """
    return F.when(whole > 0, round_half_up(pct, RATIO_DIGITS)).otherwise(F.lit(0.0))


def fixed_point(ratio: Column) -> Column:
    """A ratio of RATIO_DIGITS places as a whole number of its last place, kept as a double.

    Sums of whole doubles are exact below 2**53, so that they don't depend on the order of
    addition, as sums of fractions do. A larger sum is rounded, where one of longs would fail.
    """
    return F.rint(ratio * 10**RATIO_DIGITS)


def fixed_point_mean(total: Column, n: Column) -> Column:
    """Mean ratio from a sum of :func:`fixed_point` values and their number."""
    return F.try_divide(total, n.cast("double")) / 10**RATIO_DIGITS


def region_of_path(path: Column, unknown: str) -> Column:
    """Region from the first ``region=`` folder of a file's URI."""
    # A file URI keeps '+' as it is, so it must not be decoded to a blank.
    plain = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    found = F.regexp_extract(plain, r"(?:^|/)region=([^/=]*)", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(unknown))
