"""Prices, valuation and strength tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradebinder.schemas import MONEY, NEW_PRODUCT_DAYS

# Lower bounds of the low and medium tier, and the number that
# only the high tier exceeds, in percent.
GROWTH_TIERS = (5, 10, 25)
SPIKE_TIERS = (10, 20, 40)
GAIN_LOSS_TIERS = (5, 15, 40)


def to_money(value: Column) -> Column:
    """Text to money; empty or malformed text becomes null and never fails the row."""
    return value.try_cast(MONEY)


def estimated_market_value(trend: Column, avg30: Column) -> Column:
    """Mean of trend and 30-day average, or whichever of the two is known."""
    return F.coalesce((trend + avg30) / F.lit(2), trend, avg30)


def percent_change(current: Column, reference: Column) -> Column:
    """Change relative to the reference in percent; null when the reference is null or 0."""
    return (current - reference) / F.nullif(reference, F.lit(0)) * F.lit(100)


def usable_price(trend: Column, avg30: Column) -> Column:
    return trend.isNotNull() | avg30.isNotNull()


def tier(percent: Column, bounds: tuple) -> Column:
    """low from the first bound, medium from the second, high strictly above the third."""
    low, medium, high = bounds
    return (
        F.when(percent > high, "high").when(percent >= medium, "medium").when(percent >= low, "low")
    )


def newness_tier(age_days: Column) -> Column:
    return F.when(age_days <= 3, "high").when(age_days <= 14, "medium").when(age_days <= 30, "low")


def gap_tier(gap_days: Column) -> Column:
    return F.when(gap_days > 30, "high").when(gap_days >= 14, "medium").otherwise("low")


def is_new_product(age_days: Column) -> Column:
    return age_days < NEW_PRODUCT_DAYS


def amount_text(value: Column) -> Column:
    """Two-digit text used in signal descriptions."""
    return value.cast("decimal(18,2)").cast("string")
