"""Order and line amounts, exact in decimal arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(38,6)"


def order_total(*parts: Column) -> Column:
    """Sum of the parts, 0 as soon as one part is missing."""
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return F.coalesce(total.cast(AMOUNT), F.lit(0).cast(AMOUNT))


def line_total_silver(price: Column, discount: Column, quantity: Column) -> Column:
    """Discounted price times quantity: every unit gets the discount."""
    return (price * (F.expr("1.0") - discount) * quantity).cast(AMOUNT)


def line_total_gold(price: Column, discount: Column, quantity: Column) -> Column:
    """Quantity times price less the discount of ONE unit.

    This is not the silver amount: the gold fact takes the discount off once per line.
    Both are kept because reports depend on either.
    """
    return (quantity * price - price * discount).cast(AMOUNT)
