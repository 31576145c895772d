"""Safe casts as Column expressions: NULL instead of an error, so one bad value fails nothing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.contract import AMOUNT, ISO_DATE, ISO_TIMESTAMP


def try_numeric(text: Column) -> Column:
    """A finite number as AMOUNT, else NULL; digits beyond the 18th after the point are rounded."""
    return text.try_cast(AMOUNT)


def try_timestamp_utc(text: Column) -> Column:
    """An ISO date or timestamp; no offset means UTC (the session time zone)."""
    return F.when(text.rlike(ISO_TIMESTAMP), text.try_cast("timestamp"))


def try_iso_date(text: Column) -> Column:
    return F.when(text.rlike(ISO_DATE), text.try_cast("date"))


def utc_day(ts: Column) -> Column:
    return F.to_date(ts)


READERS = {
    "text": lambda c: c,
    "numeric": try_numeric,
    "timestamptz": try_timestamp_utc,
    "date": try_iso_date,
}


def problem(text: Column, kind: str) -> Column:
    """`missing`, `invalid <kind>`, or NULL when the text is readable."""
    missing = F.when(text.isNull(), F.lit("missing"))
    if kind == "text":
        return missing
    return missing.when(READERS[kind](text).isNull(), F.lit(f"invalid {kind}"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator to 4 digits, half away from zero; NULL on a zero or NULL divisor.

    The narrower types leave the quotient 16 digits after the point; totals too large for them use
    the wider division.
    """
    zero_safe = F.nullif(denominator, F.lit(0).cast(denominator_type()))
    narrow = numerator.try_cast("decimal(22,6)") / zero_safe.try_cast("decimal(22,6)")
    wide = numerator / zero_safe
    return F.coalesce(F.round(narrow, 4).cast("decimal(30,4)"), F.round(wide, 4).cast("decimal(30,4)"))


def denominator_type() -> str:
    return "decimal(28,6)"


def first_real_day(text: Column) -> Column:
    """The earliest calendar day not before an ISO text, as text order sees it (2026-02-30 -> 2026-03-01)."""
    y, m, d = _parts(text)
    month_start = F.make_date(y, m, F.lit(1))
    return (
        F.when(m < 1, F.make_date(y, F.lit(1), F.lit(1)))
        .when(m > 12, F.make_date(y + 1, F.lit(1), F.lit(1)))
        .when(d < 1, month_start)
        .when(d > F.dayofmonth(F.last_day(month_start)), F.add_months(month_start, 1))
        .otherwise(F.make_date(y, m, d))
    )


def last_real_day(text: Column) -> Column:
    """The latest calendar day not after an ISO text (2026-02-30 -> 2026-02-28)."""
    y, m, d = _parts(text)
    month_start = F.make_date(y, m, F.lit(1))
    return (
        F.when(m < 1, F.make_date(y - 1, F.lit(12), F.lit(31)))
        .when(m > 12, F.make_date(y, F.lit(12), F.lit(31)))
        .when(d < 1, F.date_sub(month_start, 1))
        .when(d > F.dayofmonth(F.last_day(month_start)), F.last_day(month_start))
        .otherwise(F.make_date(y, m, d))
    )


def _parts(text: Column) -> tuple[Column, Column, Column]:
    return (
        F.substring(text, 1, 4).cast("int"),
        F.substring(text, 6, 2).cast("int"),
        F.substring(text, 9, 2).cast("int"),
    )
