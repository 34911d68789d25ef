from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_amount(qty: Column, unit_price: Column) -> Column:
    """Value of one order line in its own currency."""
    return qty * unit_price


def eur_amount(amount: Column, currency: Column, rate: Column) -> Column:
    """EUR value; `rate` is units per 1 EUR. Whatever is not EUR is divided, a missing currency too."""
    return F.when(currency == "EUR", amount).otherwise(amount / rate)
