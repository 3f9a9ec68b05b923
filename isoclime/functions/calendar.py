"""Calendar and unit expressions, all built-in Spark functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOTS = 366


def day_slot(d: Column) -> Column:
    """Leap-safe day of year 1..366: 29 Feb is 60 and 1 Mar is 61 in every year."""
    return F.dayofyear(F.make_date(F.lit(2000), F.month(d), F.dayofmonth(d)))


def shift_slot(slot: Column, by: Column) -> Column:
    """The slot ``by`` days on, round the year."""
    return (F.pmod(slot - 1 + by, F.lit(SLOTS)) + 1).cast("int")


def day_number(d: Column) -> Column:
    return F.unix_date(d)


def is_leap(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def date_key(d: Column) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def season(d: Column, latitude: Column, regime: Column) -> Column:
    """Meteorological season of a place on a day.

    Temperate places follow their hemisphere; ``wet_dry`` places are wet in their hemisphere's six warmer
    months; ``none`` has no season. The equator counts as north. A null latitude gives null.
    """
    month = F.when(latitude >= 0, F.month(d)).when(latitude < 0, F.pmod(F.month(d) + 5, F.lit(12)) + 1)
    temperate = (
        F.when(month.isin(12, 1, 2), "winter").when(month.isin(3, 4, 5), "spring").when(month.isin(6, 7, 8), "summer").when(month.isin(9, 10, 11), "autumn")
    )
    wet_dry = F.when(month.between(5, 10), "wet").when(month.isNotNull(), "dry")
    return F.when(regime == "none", "all_year").when(regime == "wet_dry", wet_dry).otherwise(temperate)


def cyclic(slot: Column) -> tuple[Column, Column]:
    """Sine and cosine of the slot on the circle of the year."""
    angle = F.lit(2 * math.pi) * slot / SLOTS
    return F.sin(angle), F.cos(angle)


def convert(value: Column, unit: Column) -> Column:
    """Value in metric units by its unit: fahrenheit, knots, inches of mercury; metric units pass, unknown ones give null."""
    return (
        F.when(unit == "fahrenheit", (value - 32) * F.lit(5.0) / 9)
        .when(unit == "knots", value * F.lit(1852.0) / 3600)
        .when(unit == "inhg", value * F.lit(33.8638866667))
        .when(unit.isin("celsius", "mps", "hpa"), value)
    )
