"""Exact money, unit and loan arithmetic as Column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
UNITS = "decimal(18,5)"
NAV = "decimal(14,5)"
RATE = "decimal(6,3)"

# Card scheme fees and the share of an overdue amount set aside per risk stage.
INTERCHANGE_RATE = Decimal("0.015")
PROVISION_RATE = {1: Decimal("0.01"), 2: Decimal("0.10"), 3: Decimal("0.50")}


def cents(money: Column) -> Column:
    """Money as a whole number of cents (sums of longs stay in generated code)."""
    return (money.cast(MONEY) * F.lit(100)).cast("long")


def from_cents(value: Column) -> Column:
    return (value.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def unit_ticks(units: Column) -> Column:
    """Fund units as a whole number of 0.00001."""
    return (units.cast(UNITS) * F.lit(100000)).cast("long")


def from_unit_ticks(value: Column) -> Column:
    return (value.cast("decimal(18,0)") * F.lit(Decimal("0.00001"))).cast(UNITS)


def units_for(amount: Column, nav: Column) -> Column:
    """Units bought or sold for an amount, rounded half up to five places."""
    return F.round(amount.cast(MONEY) / nav.cast(NAV), 5).cast(UNITS)


def market_value(units: Column, nav: Column) -> Column:
    return F.round(units.cast(UNITS) * nav.cast(NAV), 2).cast(MONEY)


def level_instalment(principal: Column, annual_rate: Column, months: Column) -> Column:
    """Equal monthly instalment that clears ``principal`` in ``months``; plain division at rate 0."""
    p = principal.cast("double")
    r = annual_rate.cast("double") / F.lit(1200.0)
    growth = F.pow(F.lit(1.0) + r, months)
    with_interest = F.round(p * r * growth / F.nullif(growth - F.lit(1.0), F.lit(0.0)), 2)
    return F.when(annual_rate == 0, F.round(p / months, 2)).otherwise(with_interest).cast(MONEY)


def interest_cents(balance_cents: Column, rate_thousandths: Column) -> Column:
    """One month's interest in cents, half up, from a rate in thousandths of a percent a year."""
    doubled = F.lit(2) * balance_cents * rate_thousandths + F.lit(1200000)
    return F.floor(doubled.cast("decimal(38,0)") / F.lit(2400000)).cast("long")


def interchange_fee(amount: Column, txn_type: Column) -> Column:
    return F.when(txn_type == "purchase", F.round(amount.cast(MONEY) * F.lit(INTERCHANGE_RATE), 2)).cast(MONEY)


def reward_points(amount: Column, txn_type: Column) -> Column:
    return F.when(txn_type == "purchase", F.floor(amount.cast(MONEY) / F.lit(100))).cast("int")


def signed(amount: Column, negative: Column) -> Column:
    return F.when(negative, -amount).otherwise(amount)
