"""Date columns: textual bounds, tolerant parsing, age to date of birth."""

from __future__ import annotations

import datetime as dt
import re
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days per unit, as results must agree on them.
DAYS_PER_UNIT = {
    "day": Decimal("1"),
    "week": Decimal("7"),
    "month": Decimal("30"),
    "year": Decimal("365.25"),
}

# An amount is a number, whole or decimal, and a unit, singular or plural.
_AMOUNT = r"([0-9]+(?:[.][0-9]+)?)\s*(" + "|".join(DAYS_PER_UNIT) + r")s?(?![A-Za-z0-9_])"
_OFFSET = re.compile(rf"\s*([+-])\s*{_AMOUNT}")
_SHIFTED = re.compile(rf"^(?P<base>.+?)(?P<offsets>(?:\s*[+-]\s*{_AMOUNT})+)\s*$")
_ISO_START = re.compile(r"^\d{4}-\d{2}-\d{2}")


def _days(amount: str, unit: str) -> int:
    days = Decimal(amount) * DAYS_PER_UNIT[unit]
    return int(days.quantize(Decimal("1"), rounding=ROUND_HALF_UP))


def _iso_date(text: str) -> dt.date:
    try:
        return dt.datetime.strptime(text, "%Y-%m-%d").date()
    except ValueError:
        raise ValueError(f"Invalid date: {text!r}") from None


def date_bound(text: str | None) -> Column:
    """Column for a textual date instruction.

    ``None`` gives a null date. ``'2020-01-31'`` gives a date literal (checked against the calendar while the
    plan is built, so it folds to a constant and reaches the scan as a pushed filter). A trailing ``+ 5 days`` or
    ``- 7.5 weeks`` (units day, week, month = 30 days, year = 365.25 days, half days round up) shifts any base.
    Anything else is SQL text; amounts nested in it are replaced by whole days.
    """
    if text is None:
        return F.lit(None).cast("date")
    text = text.strip()
    shifted = _SHIFTED.match(text)
    base, days = text, 0
    if shifted:
        base = shifted["base"].strip()
        for sign, amount, unit in _OFFSET.findall(shifted["offsets"]):
            days += _days(amount, unit) * (1 if sign == "+" else -1)
    if _ISO_START.match(base):
        return F.lit(_iso_date(base) + dt.timedelta(days=days))
    base = re.sub(rf"\b{_AMOUNT}", lambda m: str(_days(m[1], m[2])), base)
    if not shifted:
        return F.expr(base)
    return F.date_add(F.expr(base).cast("date"), days)


def as_bound(bound: str | dt.date | Column) -> Column:
    """A bound given as text, date or Column."""
    if isinstance(bound, Column):
        return bound
    return date_bound(bound) if isinstance(bound, str) else F.lit(bound)


def dob_from_age(on_date: Column, age: Column, completed_years: bool = False) -> Column:
    """Approximate date of birth from the age on a date.

    Ages below one are fractional and used as they are; from one on they are completed years, so half a year is
    added. ``completed_years`` says that every age, also zero, counts completed years.
    """
    age = age.try_cast("double")
    years = age + 0.5 if completed_years else F.when(age < 1, age).otherwise(age + 0.5)
    return F.date_sub(on_date.cast("date"), F.round(years * 365.25).cast("int"))


def parsed_date(text: Column, pattern: str, shape: str | None = None) -> Column:
    """Date parsed by pattern, null where the text does not fit.

    ``shape`` is a regular expression that the whole text must match first.
    """
    value = F.try_to_date(text, pattern)
    return value if shape is None else F.when(text.rlike(f"^(?:{shape})$"), value)


def parsed_timestamp(text: Column, pattern: str) -> Column:
    """Timestamp parsed by pattern, null where the text does not fit."""
    return F.try_to_timestamp(text, F.lit(pattern))
