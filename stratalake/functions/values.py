"""Defaults and derived text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(value: Column, default: Column) -> Column:
    return F.coalesce(value, default)


def random_uuid() -> Column:
    return F.expr("uuid()")


def stable_uuid(*parts: Column) -> Column:
    """A uuid-shaped digest of the parts: the same input row gets the same id in every run."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.substring(digest, 13, 4),
        F.substring(digest, 17, 4),
        F.substring(digest, 21, 12),
    )


def account_number(existing: Column, customer_id: Column) -> Column:
    """The stored account number, else ``AW`` and the customer id padded to nine digits."""
    return filled(existing, F.concat(F.lit("AW"), F.format_string("%09d", customer_id)))


def full_name(first: Column, last: Column) -> Column:
    """First and last name; missing when either is missing."""
    return F.concat(first, F.lit(" "), last)
