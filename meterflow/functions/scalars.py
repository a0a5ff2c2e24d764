"""Column expressions: parsing, calendar arithmetic, display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_PATTERN = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf(inity)?))\z"
# Every character that Unicode counts as white space, and the four separators of ASCII.
WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
DAY_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MONTH_PATTERN = r"^[0-9]{4}-(0[1-9]|1[0-2])$"


def stripped(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(c, F.lit(WHITE))


def is_blank(c: Column) -> Column:
    return stripped(c) == ""


def to_number(c: Column) -> Column:
    """Double, or NULL where the text is not a plain number ('12d' is not one)."""
    text = stripped(c)
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def to_day(c: Column) -> Column:
    """Date from exactly yyyy-MM-dd, else NULL."""
    return F.when(c.rlike(DAY_PATTERN), F.try_to_date(c, "yyyy-MM-dd"))


def is_finite(c: Column) -> Column:
    """True for a real number; false for NaN and infinities; NULL stays NULL."""
    return ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def finite(c: Column) -> Column:
    """The value when it is a real number, else NULL."""
    return F.when(is_finite(c), c)


def flag(condition: Column) -> Column:
    """Comparison with a missing value counts as false."""
    return F.coalesce(condition, F.lit(False))


def month_ordinal(day: Column) -> Column:
    """Calendar month as an integer, so that t-1 and t+1 are plain arithmetic."""
    return (F.year(day) * 12 + F.month(day) - 1).cast("int")


def month_start(ordinal: Column) -> Column:
    return F.make_date(F.floor(ordinal / 12).cast("int"), F.pmod(ordinal, F.lit(12)) + 1, F.lit(1))


def month_end(ordinal: Column) -> Column:
    return F.last_day(month_start(ordinal))


def month_number(ordinal: Column) -> Column:
    return (F.pmod(ordinal, F.lit(12)) + 1).cast("int")


def period_text(ordinal: Column) -> Column:
    return F.date_format(month_start(ordinal), "yyyy-MM")


def period_ordinal(text: Column) -> Column:
    """Ordinal of a YYYY-MM text, NULL when it is not one."""
    year = F.substring(text, 1, 4).try_cast("int")
    month = F.substring(text, 6, 2).try_cast("int")
    return F.when(text.rlike(MONTH_PATTERN), (year * 12 + month - 1).cast("int"))


def period_kind(text: Column) -> Column:
    """'month' for YYYY-MM, 'month_end' for the last day of a month, else 'invalid'."""
    day = to_day(text)
    return (
        F.when(text.rlike(MONTH_PATTERN), "month")
        .when(day == F.last_day(day), "month_end")
        .otherwise("invalid")
    )


def normalize_period(text: Column) -> Column:
    """Month ordinal of a YYYY-MM text or a month-end date; NULL for anything else."""
    day = to_day(text)
    return F.coalesce(period_ordinal(text), F.when(day == F.last_day(day), month_ordinal(day)))


def financial_year(day: Column, first_month: int = 4) -> Column:
    """Label such as 2025-2026 of the April-March year that holds the day."""
    year = F.year(F.add_months(day, 1 - first_month))
    return F.concat_ws("-", year.cast("string"), (year + 1).cast("string"))


def financial_year_start(label: str, first_month: int = 4) -> int:
    """Ordinal of the first month of a financial year such as 2025-2026."""
    first, _, second = label.partition("-")
    if not (first.isdigit() and second.isdigit() and int(second) == int(first) + 1):
        raise ValueError(f"{label!r} is not a financial year")
    return int(first) * 12 + first_month - 1


def _round_half_even(value: Column, decimals: int) -> Column:
    """value * 10**decimals to the nearest integer, ties to even, judged on the exact double.

    10**decimals is a sum of powers of two, and scaling by a power of two is exact. The integer
    parts are added as integers; the fractions are added with the error of each addition kept, so
    that a value next to a tie is not taken for one.
    """
    powers = [1 << bit for bit in range((10**decimals).bit_length()) if (10**decimals >> bit) & 1]
    parts = [value * F.lit(float(power)) for power in powers]
    whole = F.floor(parts[0])
    rest, error = parts[0] - whole, F.lit(0.0)
    for part in parts[1:]:
        whole = whole + F.floor(part)
        fraction = part - F.floor(part)
        total = rest + fraction
        added = total - rest
        error = error + (rest - (total - added)) + (fraction - added)
        rest = total
    whole, rest = whole + F.floor(rest), rest - F.floor(rest)
    odd = F.pmod(whole, F.lit(2)) == 1
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & odd)))
    return whole + up.cast("bigint")


def format_indian(value: Column, decimals: int = 0) -> Column:
    """Digits grouped 3 then 2 (12,34,567.8); 'Not available' for a missing value."""
    value = value.cast("double")
    scaled = _round_half_even(F.abs(value), decimals)
    unit = F.lit(10**decimals)
    whole = F.floor(scaled / unit).cast("bigint").cast("string")
    text = F.concat(
        F.when(value < 0, "-").otherwise(""),
        F.regexp_replace(whole, r"(?<=\d)(?=(\d\d)+\d$)", ","),
    )
    if decimals:
        fraction = F.lpad(F.pmod(scaled, unit).cast("string"), decimals, "0")
        text = F.concat(text, F.lit("."), fraction)
    return F.when(value.isNull() | F.isnan(value), "Not available").otherwise(text)
