"""Amounts: abbreviations, rounding, amortisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

THOUSAND = 1000.0


def full_price(c: Column) -> Column:
    """Prices below a thousand are taken as thousands: 280 is 280,000."""
    return F.when(c < THOUSAND, c * THOUSAND).otherwise(c)


def full_price_value(v: float) -> float:
    return v * THOUSAND if v < THOUSAND else v


def price_detail(c: Column) -> Column:
    """Struct of value and whether it was changed."""
    return F.struct(full_price(c).alias("value"), (c < THOUSAND).alias("changed"))


def down_payment_detail(c: Column) -> Column:
    """Up to 100 a percentage, below a thousand thousands, else an amount."""
    return F.struct(
        F.when(c <= 100, c).when(c < THOUSAND, c * THOUSAND).otherwise(c).alias("value"),
        (c <= 100).alias("is_percent"),
        ((c > 100) & (c < THOUSAND)).alias("changed"),
    )


def half_up(c: Column) -> Column:
    """Halves go up, so -2.5 becomes -2."""
    return F.floor(c + 0.5)


def payment(amount: Column, months: Column, yearly_percent: Column) -> Column:
    """The annuity's monthly payment; null where nothing divides."""
    rate = yearly_percent / 100 / 12
    grown = F.pow(1 + rate, months.cast("double"))
    return F.when(rate == 0, F.try_divide(amount, months.cast("double"))).otherwise(F.try_divide(amount * rate * grown, grown - 1))


def quote(price: Column, down_percent: Column, months: Column, yearly_percent: Column) -> dict[str, Column]:
    """Unrounded parts of a quote; totals come from the unrounded payment."""
    down = price * down_percent / 100
    financed = price - down
    monthly = payment(financed, months, yearly_percent)
    total = monthly * months.cast("double") + down
    return {"down_payment": down, "financed": financed, "monthly": monthly, "total": total, "cost": total - price}
